"""Check every registered query, or the named ones, at one scale: check_all.py SF_DIR [names]."""

from __future__ import annotations

import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from __spark_entry__ import oracle_sql, queries
from tests.compare import connect, difference
from tierline.session import build_session

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = difference(fn(spark, sf_dir), con, oracles[name])
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
            if names:
                traceback.print_exc()
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} bad")
    sys.exit(bool(bad))
