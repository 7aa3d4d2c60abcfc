"""Clustering against plain whole-number rounds, and its edge tables."""

import hashlib
import math
import random

import numpy as np
import pytest

from tierline.llm import centroids
from tierline.llm.centroids import cluster_vectors

NAMES = ("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def brute(rows, dims, k, rounds):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and None not in v and all(map(math.isfinite, v))]
    kept = [(i, v, [math.floor(1024 * x) for x in v]) for i, v in kept]

    def order(row):
        digest = hashlib.sha256(f"3:{row[0]}".encode()).hexdigest() if row[0] is not None else ""
        return (row[0] is None, digest, row[1])

    centers = [c for _, _, c in sorted(kept, key=order)[:k]]

    def assign():
        found = []
        for _, _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centers]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(rounds):
        found = assign()
        for j in range(len(centers)):
            own = [x for (_, _, x), (at, _) in zip(kept, found, strict=True) if at == j]
            if own:
                centers[j] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = assign()
    of = [sum(d for at, d in found if at == j) for j in range(len(centers))]
    return sorted(
        ((i, at, d, of[at], sum(of), centers[at]) for (i, _, _), (at, d) in zip(kept, found, strict=True)), key=repr
    )


def run(spark, rows, dims, k, rounds, kind="float"):
    df = spark.createDataFrame(rows, f"id long, vector array<{kind}>").repartition(3)
    out = cluster_vectors(df, dims, k, rounds)
    assert tuple(out.columns) == NAMES
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_rounds_match_whole_number_rounds(spark, monkeypatch):
    """Several blocks with a narrow last one, several tiles, a hot vector, repeated ids and unusable vectors."""
    monkeypatch.setattr(centroids, "TILE_ROWS", 40)
    draw = random.Random(4)
    rows = [(i, [float(np.float32(draw.gauss(i % 5, 0.7))) for _ in range(37)]) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(90)] + [rows[5]] * 2 + [(7, rows[9][1]), (None, rows[11][1])]
    rows += [(2000, None), (2001, []), (2002, rows[0][1][:-1]), (2003, [*rows[0][1], 0.0])]
    rows += [(2004 + i, [*rows[0][1][:-1], x]) for i, x in enumerate((None, math.nan, math.inf, -math.inf))]
    for k, rounds in ((8, 4), (3, 0), (5, 1)):
        assert run(spark, rows, 37, k, rounds) == brute(rows, 37, k, rounds)


def test_few_equal_and_no_vectors(spark):
    same = [(i, [0.5, -0.25]) for i in range(6)]
    assert run(spark, same, 2, 4, 3, "double") == brute(same, 2, 4, 3)
    assert {r[1] for r in run(spark, same, 2, 4, 3, "double")} == {0}
    two = [(1, [1.0, 2.0]), (2, [-3.0, 0.1])]
    assert run(spark, two, 2, 8, 2, "double") == brute(two, 2, 8, 2)
    assert run(spark, [], 2, 8, 2) == []
    assert run(spark, [(1, None), (2, [1.0])], 2, 8, 2) == []


def test_too_large_components_stop_the_run(spark):
    with pytest.raises(Exception, match="do not fit in 64 bits"):
        run(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])], 2, 2, 1, "double")
