"""Sharding and mixing: exact sizes, gapless slots, uniform draws, targets met."""

import collections
import math
import zlib

import pytest

from tierline.llm.mixing import MOST, SHARE, WEIGHTS, mix_documents, op10_mix_entropy
from tierline.llm.sharding import op3_shard_hypergeometric, shuffle_into_shards

DOCS = "doc_id long, text string, source string, shard int, size string, row_tag string"


def check_shards(rows, n, shards):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert sum(map(len, by.values())) == n
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    want = [n // shards + (s < n % shards) for s in range(shards)]
    assert [len(by[s]) for s in range(shards)] == want


@pytest.mark.parametrize("n", [0, 1, 5, 103])
def test_sizes_and_slots(spark, n):
    rows = [(None if i % 7 == 0 else i % 5, None if i % 3 == 0 else "x" * (i % 4), None, 9, "s", "t") for i in range(n)]
    out = shuffle_into_shards(spark.createDataFrame(rows, DOCS).repartition(3), 8)
    # The clashing column is replaced, all others are kept with their rows.
    assert out.columns == ["doc_id", "text", "source", "size", "row_tag", "shard", "slot"]
    got = out.collect()
    check_shards(got, n, 8)
    assert collections.Counter((r["doc_id"], r["text"]) for r in got) == collections.Counter(r[:2] for r in rows)


def test_uniform(spark):
    """Each pair of row and shard is equally likely over seeds, also for rows of one partition."""
    df = spark.range(24).repartition(2)
    seen = collections.Counter()
    for seed in range(12):
        for r in shuffle_into_shards(df, 2, seed).collect():
            seen[r["id"], r["shard"]] += 1
    chi = sum((seen[i, s] - 6) ** 2 / 6 for i in range(24) for s in range(2))
    # 24 rows with one degree of freedom each.
    assert chi < 24 + 4 * math.sqrt(48)


def test_query_shards(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op3_shard_hypergeometric(spark, sf_dir).collect()
    check_shards(got, len(docs), 8)
    for r in got:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert (r["law"], r["grown_shard"]) == ("rows", None)


def targets(sizes):
    """Water filling, one source at a time."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, out, open_ = SHARE * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if MOST * sizes[s] < weight[s] * level}
        if not over:
            return out | {s: weight[s] * level for s in open_}
        for s in over:
            out[s] = MOST * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def check_mix(rows, sources, largest):
    sizes = collections.Counter()
    taken = collections.Counter()
    for r in rows:
        s = sources[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    want = targets({s: sizes[s] for s in set(sources.values())})
    for r in rows:
        s = sources[r["doc_id"]]
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s])
    for s in want:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_query_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    first, again = (sorted(op10_mix_entropy(spark, sf_dir).collect()) for _ in range(2))
    assert first == again
    largest = collections.Counter()
    for d in docs:
        n = len((d["text"] or "").encode().split())
        largest[d["source"]] = max(largest[d["source"]], n)
    assert {r["doc_id"]: r["size"] for r in first} == {d["doc_id"]: len((d["text"] or "").encode().split()) for d in docs}
    check_mix(first, {d["doc_id"]: d["source"] for d in docs}, largest)


def test_mix_edges(spark):
    """Null source and texts, sources without words, equal rows, a hot source, clashing names."""
    rows = [(i, "w " * (1 + i % 9), "hot", 0, "s", "t") for i in range(60)]
    rows += [(100, None, None, 0, "s", "t"), (101, "a b c", None, 0, "s", "t"), (102, "", "empty", 0, "s", "t")]
    rows += [(103, "same text here", "z", 0, "s", "t")] * 3
    df = spark.createDataFrame(rows, DOCS)
    out = mix_documents(df)
    assert out.columns == df.columns
    copies = collections.Counter(tuple(r) for r in out.collect())
    assert set(copies) <= set(rows)
    for row, n in copies.items():
        assert n <= 2 * rows.count(row)
    assert mix_documents(df.where("false")).count() == 0


def test_no_python_in_plans(spark, sf_dir):
    for query in (op3_shard_hypergeometric, op10_mix_entropy):
        plan = query(spark, sf_dir)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
