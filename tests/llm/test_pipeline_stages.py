"""The corpus pipeline: every stage on what the stage before kept."""

import collections

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.compare import connect, difference
from tierline.llm.common import staged, table
from tierline.llm.registry import ORACLES, QUERIES
from tierline.llm.toxicity import op2_toxicity_knn


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 11))
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op5_warc_boundary_chain"}))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == ""


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        kept[name] = [r["doc_id"] for r in docs.collect()]
        assert docs.columns == columns or name == "sharding"
        assert docs.columns[: len(columns)] == columns
    toxic = {r["doc_id"] for r in op2_toxicity_knn(spark, sf_dir).collect() if r["predicted"]}
    assert sorted(kept["toxicity"]) == sorted(set(texts) - toxic)
    # Near-duplicates by brute force.
    sets = {}
    for i in kept["toxicity"]:
        w = (texts[i] or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            x = len(sets[a] & sets[b]) if a < b else 0
            if x and 100 * x >= 80 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    assert sorted(kept["near_duplicates"]) == sorted(i for i, g in group.items() if i == g)
    clean = [i for i in kept["near_duplicates"]]
    assert set(kept["decontamination"]) <= set(clean)
    items = [(r["text"] or "").lower().split() for r in table(spark, sf_dir, "benchmark").collect()]
    runs = {tuple(w[k : k + 20]) for w in items for k in range(len(w) - 19)}
    for i in clean:
        w = (texts[i] or "").lower().split()
        if any(tuple(w[k : k + 20]) in runs for k in range(len(w) - 19)):
            assert i not in kept["decontamination"]
    copies = collections.Counter(kept["mixing"])
    assert set(copies) <= set(kept["decontamination"]) and max(copies.values()) <= 2
    assert sorted(kept["sharding"]) == sorted(kept["mixing"])
    sizes = collections.Counter(r["shard"] for r in docs.collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1
