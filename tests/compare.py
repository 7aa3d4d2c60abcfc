"""Compare a Spark result with its SQL, the way the driver does: by name, in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(columns, values) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(v[i]) for i in order) for v in values)


def family(kind: str) -> str:
    """Type names of both engines on common ground."""
    kind = kind.lower()
    names = {
        "integer": "int", "varchar": "string", "timestamp_ntz": "timestamp", "long": "bigint",
        "text": "string",
    }
    return names.get(kind, kind)


def difference(df, con, sql: str) -> str:
    """Empty if equal, otherwise a description of what differs."""
    got_columns = df.columns
    got = rows(got_columns, df.collect())
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = rows(want_columns, result.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    types = con.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {t[0]: family(t[1]) for t in types}
    got_types = {f.name: family(f.dataType.simpleString()) for f in df.schema}
    if got_types != want_types:
        wrong = {c: (got_types[c], want_types[c]) for c in got_types if got_types[c] != want_types[c]}
        return f"types {wrong}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"only here {list(extra)[:3]}; only there {list(missing)[:3]}"
        )
    return ""
