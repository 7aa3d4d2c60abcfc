"""Boosted trees against plain loops, held-out accuracy, and edge tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import quality
from tierline.llm.common import table
from tierline.llm.quality import (
    BINS, DEPTH, LEAST_WEIGHT, NAMES, RATE, RIDGE, TREES, UNIT, Forest, document_statistics, fit,
    op13_quality_boosted_trees, score_quality, statistics_of,
)

EVERYTHING = "true"


def test_statistics():
    got = dict(zip(NAMES, statistics_of("Éa b b b\n\nB2! | b.\nÉa b b b"), strict=True))
    assert got["words"] == pytest.approx(math.log1p(11)) and got["commonest_word"] == 6 / 11
    assert got["repeated_neighbours"] == 4 / 11 and got["no_letter_words"] == 1 / 11
    assert got["lines"] == pytest.approx(math.log1p(3)) and got["exclamations"] == 1 / 11
    assert got["distinct_words"] == 5 / 11 and got["repeated_lines"] == pytest.approx(9 / 29)
    assert statistics_of(None) == statistics_of("") == [0.0] * len(NAMES)
    assert all(map(math.isfinite, statistics_of(" \n \t")))
    assert all(map(math.isfinite, statistics_of("x" * 300_000 + "\ud800")))


def plain_forest(rows, labels, edges):
    """The same trees, grown row by row."""
    bins = [[sum(e < v for e in edge) for v, edge in zip(row, edges, strict=True)] for row in rows]
    base = math.log((sum(labels) + 0.5) / (len(labels) - sum(labels) + 0.5))
    total = [base] * len(rows)
    for _ in range(TREES):
        p = [1 / (1 + math.exp(-min(30, max(-30, t)))) for t in total]
        first = [round((y - q) * UNIT) / UNIT for y, q in zip(labels, p, strict=True)]
        second = [round(q * (1 - q) * UNIT) / UNIT for q in p]
        groups = [list(range(len(rows)))]
        for _ in range(DEPTH):
            below = []
            for group in groups:
                g, h = sum(first[i] for i in group), sum(second[i] for i in group)
                best = (1e-9, None)
                for f in range(len(edges)):
                    for b in range(BINS):
                        left = [i for i in group if bins[i][f] <= b]
                        gl, hl = sum(first[i] for i in left), sum(second[i] for i in left)
                        if hl < LEAST_WEIGHT or h - hl < LEAST_WEIGHT:
                            continue
                        gain = gl**2 / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g**2 / (h + RIDGE)
                        if gain > best[0] + 1e-12:
                            best = (gain, (f, b))
                f, b = best[1] or (0, BINS)
                below += [[i for i in group if bins[i][f] <= b], [i for i in group if bins[i][f] > b]]
            groups = below
        for group in groups:
            g, h = sum(first[i] for i in group), sum(second[i] for i in group)
            for i in group:
                total[i] += RATE * g / (h + RIDGE)
    return [1 / (1 + math.exp(-t)) for t in total]


def test_trees_match_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(quality, "TREES", 4)
    monkeypatch.setitem(plain_forest.__globals__, "TREES", 4)
    monkeypatch.setattr(quality, "TILE_ROWS", 17)
    monkeypatch.setattr(quality, "NAMES", ("a", "b", "c"))
    draw = random.Random(8)
    rows = [[float(np.float32(draw.gauss(0, 1))), float(draw.randrange(3)), 1.0] for _ in range(120)]
    labels = [int(r[0] + r[1] + draw.gauss(0, 0.6) > 1) for r in rows]
    stats = spark.createDataFrame(list(enumerate(rows)), "id long, stats array<float>").repartition(4)
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id long, quality int")
    forest = fit(stats, known, EVERYTHING)
    edges = []
    for column in zip(*rows, strict=True):
        order = sorted(column)
        edges.append(sorted({order[max(0, math.ceil((i + 1) / BINS * len(order)) - 1)] for i in range(BINS - 1)}))
    got = forest.score(np.array(rows))
    assert got == pytest.approx(plain_forest(rows, labels, edges), abs=1e-6)
    again = fit(stats.repartition(7), known.repartition(3), EVERYTHING)
    assert (again.score(np.array(rows)) == got).all()


def test_flat_trees_walk_like_nested_ones():
    draw = np.random.default_rng(2)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    forest = Forest(0.3, draw.integers(0, 4, (5, inner)), draw.normal(size=(5, inner)), draw.normal(size=(5, leaves)))
    x = draw.normal(size=(50, 4))
    for row, got in zip(x, forest.logits(x), strict=True):
        want = forest.base
        for feature, bound, value in zip(forest.feature, forest.bound, forest.value, strict=True):
            node = 0
            while node < inner:
                node = 2 * node + 1 + int(row[feature[node]] > bound[node])
            want += value[node - inner]
        assert got == pytest.approx(want)


def test_held_out_quality(spark):
    """On the held-out fifth nearly all labels come out right."""
    sf_dir = "/root/testdata/sf0.01"
    scored = op13_quality_boosted_trees(spark, sf_dir)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    known = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    test = [(known[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert sum(a == b for a, b in test) >= 0.95 * len(test)
    assert all(b == 1 for a, b in test if a == 1)


def test_edge_rows(spark):
    good = "Plain words stand here, and each line says something else. " * 3
    bad = "buy buy buy buy buy buy buy buy"
    docs = [(i, f"{good}{i} {i * 7}") for i in range(40)] + [(100 + i, f"{bad} {bad}") for i in range(40)]
    docs += [(None, good), (None, None), (200, None), (200, ""), (201, "x" * 200_000), (1, good), (1, good)]
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)]
    labels += [(None, 0), (3, None), (5, 7), (999, 1), (100, 1), (101, 0)]
    known = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("other"))
    frame = spark.createDataFrame(docs, "id long, text string")
    rows = score_quality(frame, known, EVERYTHING).collect()
    assert sorted(repr(r["id"]) for r in rows) == sorted(repr(d[0]) for d in docs)
    assert min(r["score"] for r in rows if r["id"] is not None and r["id"] < 40) > 0.5
    assert max(r["score"] for r in rows if r["id"] is not None and 100 <= r["id"] < 140) < 0.3
    assert len({r["score"] for r in rows if r["id"] == 200}) == 1
    nothing = score_quality(frame, known.limit(0), EVERYTHING).collect()
    assert {r["score"] for r in nothing} == {0.5}
    one = score_quality(frame, known.where("quality = 1"), EVERYTHING).collect()
    assert len({r["score"] for r in one}) == 1 and one[0]["score"] > 0.9
    assert score_quality(frame.limit(0), known, EVERYTHING).collect() == []
    assert document_statistics(frame).columns == ["id", "stats"]
