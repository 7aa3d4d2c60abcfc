"""Near-duplicate texts and vectors, and toxicity, against brute force."""

import collections
import math
import random

import numpy as np
from pyspark.sql import functions as F

from tierline.llm.common import components
from tierline.llm.embeddings import near_vectors
from tierline.llm.minhash import BLOCK_SETS, drop_near_duplicates, near_duplicates
from tierline.llm.toxicity import Index, drop_toxic, held_out, op2_toxicity_knn, pick_examples, score_toxicity


def smallest(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    links += [(500, i) for i in range(501, 560)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = smallest({n for pair in links for n in pair}, links)
    assert all(got.get(n, n) == want[n] for n in want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, k):
    w = text.encode().lower().split() if text else []
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k):
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return sets, smallest(ids, links)


def test_near_duplicate_texts(spark, words):
    """Copies, edits of all sizes, a large group with many levels of similarity, short and empty texts."""
    draw = random.Random(9)
    rows, at = [], 0

    def add(text):
        nonlocal at
        rows.append((at, text))
        at += 1

    for _ in range(20):
        base = [draw.choice(words) for _ in range(120)]
        add(" ".join(base))
        for edits in (0, 1, 2, 3, 5, 8):
            changed = list(base)
            for _ in range(edits):
                changed[draw.randrange(120)] = draw.choice(words)
            add(" ".join(changed))
    hot = [draw.choice(words) for _ in range(100)]
    for i in range(2 * BLOCK_SETS + 40):
        changed = list(hot)
        for _ in range(draw.randrange(0, 9)):
            changed[draw.randrange(100)] = f"u{i}x{draw.randrange(99)}"
        add(" ".join(changed))
    for text in (None, "", " \n\t", "one", "ONE", "one two three", "One\ttwo three", "é É", "a b c d", "a b c d"):
        add(text)
    add(" ".join(draw.choice(words) for _ in range(20_000)))
    df = spark.createDataFrame(rows, "id long, text string")
    got = near_duplicates(df, 4, 80).collect()
    sets, want = brute(rows, 4)
    assert len(got) == len(rows)
    for r in got:
        assert r["n_shingles"] == len(sets[r["id"]])
        assert (r["id"], r["component_id"]) == (r["id"], want[r["id"]])
        assert r["kept"] == (want[r["id"]] == r["id"])
    full = df.select(F.col("id").alias("doc_id"), "text", F.lit("s").alias("digest"), F.lit(1).alias("id"))
    kept = drop_near_duplicates(full, 5, 80)
    assert kept.columns == full.columns
    _, five = brute(rows, 5)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in five if five[i] == i)


def test_near_duplicate_edges(spark):
    rows = [(None, "a b c d e f"), (None, None), (1, "a b c d e f"), (1, "a b c d e f"), (1, "x y z w v")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = sorted(((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df, 4).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 3, 1, True), (1, 3, 1, True), (None, 0, None, True), (None, 3, 1, False)]
    assert near_duplicates(df.where("false")).count() == 0


def test_near_vectors(spark):
    draw = np.random.default_rng(4)
    rows, dim = [], 16
    for label in (0, 1):
        for _ in range(60):
            base = draw.standard_normal(dim)
            rows += [(base + s * draw.standard_normal(dim), label) for s in (0, 0.03, 0.06, 0.1)]
    hot = draw.standard_normal(dim)
    rows += [(hot + 0.08 * draw.standard_normal(dim), 2) for _ in range(150)] + [(hot, 2)] * 5 + [(3 * hot, 2), (-hot, 2)]
    rows = [(i, [float(x) for x in v], lab) for i, (v, lab) in enumerate(rows)]
    n = len(rows)
    odd = [None, [], [0.0] * dim, [math.nan] * dim, [math.inf] + [0.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 20, rows[0][1], None), (n + 21, rows[0][1], None)]
    rows += [(n + 22, [1e-300] * dim, 3), (n + 23, [1e300] * dim, 3)]
    df = spark.createDataFrame(rows, "id long, vector array<double>, label int")
    got = {r["id"]: r for r in near_vectors(df).collect()}
    assert len(got) == len(rows)
    links = collections.defaultdict(set)
    good = {}
    for i, v, label in rows:
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            u = np.array(v) / np.abs(v).max()
            good[i] = (label, u / np.linalg.norm(u))
    for a, (la, va) in good.items():
        for b, (lb, vb) in good.items():
            if a < b and la == lb and len(va) == len(vb):
                cos = va @ vb
                if cos >= 0.98:
                    links[a].add(b)
                    links[b].add(a)
    want = smallest([r[0] for r in rows], [(a, b) for a in links for b in links[a]])
    total = sum(map(len, links.values()))
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * total
    assert all(r["n_links"] <= len(links[i]) for i, r in got.items())
    assert sum(r["component_id"] != want[i] for i, r in got.items()) <= 0.01 * len(rows)
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert near_vectors(df.where("false")).count() == 0


# Toxicity


def test_exact_neighbours():
    """The block-max index finds the same neighbours as a full product."""
    draw = np.random.default_rng(8)
    rows = []
    for _ in range(700):
        at = np.unique(draw.integers(0, 50, draw.integers(0, 6)))
        rows.append((at.tolist(), draw.integers(1, 4, len(at)).tolist()))
    toxic = draw.integers(0, 2, 700).astype(float)
    index = Index.build(draw.random(50) + 1, list(range(700)), toxic, rows)
    vectors = index.vectors(rows)
    cosines, who = index.nearest(vectors[:200])
    full = np.sort(vectors[:200] @ vectors.T, axis=1)[:, ::-1][:, : cosines.shape[1]]
    assert np.allclose(cosines, np.where(full > 0, full, 0))
    assert ((who >= 0) == (cosines > 0)).all()


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = op2_toxicity_knn(spark, sf_dir).collect()
    judged = [(labels[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)
    assert sum(a for a, b in judged if b) >= 0.6 * sum(a for a, _ in judged)


def test_toxic_edges(spark, words):
    draw = random.Random(2)
    rows, labels = [], []
    for i in range(120):
        text = [draw.choice(words) for _ in range(30)]
        bad = i % 3 == 0
        if bad:
            text[5] = text[9] = "vileword"
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(bad), 1))
    rows += [(200, None, "x"), (201, "", "x"), (None, "so vileword here", "x"), (5, rows[5][1], "x"), (202, "w " * 9000 + "vileword", "x")]
    labels += [(None, 1, 0), (900, 1, 0), (7, None, 0), (8, 5, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = score_toxicity(docs.select(F.col("doc_id").alias("id"), "text"), marks, ~held_out(F.col("id"))).collect()
    assert len(got) == len(rows)
    assert all((r["score"] >= 0.5) == (r["id"] in (None, 202) or (r["id"] < 120 and r["id"] % 3 == 0)) for r in got)
    kept = drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
        r[0] for r in rows if r[0] not in (None, 202) and (r[0] >= 120 or r[0] % 3)
    )
    assert score_toxicity(docs.select(F.col("doc_id").alias("id"), "text"), marks.where("false"), F.lit(True)).count() == len(rows)
    assert score_toxicity(docs.where("false").select(F.col("doc_id").alias("id"), "text"), marks, F.lit(True)).count() == 0


def test_every_term_of_the_examples_counts(spark, words):
    """A text without any telling term has its nearest examples by the other terms it shares with them."""
    rows = [(i, " ".join(words[3 * i : 3 * i + 12]) + (" vileword" if i % 3 == 0 else "")) for i in range(90)]
    docs = spark.createDataFrame([*rows, (500, " ".join(words[30:36])), (501, "zzzz yyyy")], "id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = {r["id"]: r["evidence"] for r in score_toxicity(docs, marks, F.lit(True)).collect()}
    for i, text in rows:
        assert got[i][0]["doc_id"] == i and abs(got[i][0]["cosine"] - 1) < 1e-9
        assert all(set(text.split()) & set(rows[e["doc_id"]][1].split()) for e in got[i])
    assert {e["doc_id"] for e in got[500]} <= {i for i, t in rows if set(t.split()) & set(words[30:36])} and got[500]
    assert got[501] == []


def test_dropping_near_duplicates_keeps_every_text(spark):
    """Rows that share a doc_id or have none go by their own text, and one row of each group stays."""
    t, u, v = "a b c d e f g h", "k l m n o p q r", "s t u v w x y z"
    rows = [(1, t), (2, t), (2, u), (7, u), (None, v), (None, v), (None, None), (3, None), (3, ""), (1, t), (None, t)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("gone", F.lit("x"))
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(1, t), (2, u), (None, v), (None, None), (3, None), (3, "")], key=repr)
    assert drop_near_duplicates(df.where("false")).collect() == []


def test_examples_are_bounded(spark, words):
    """Rows and bytes of the examples have bounds, also if all texts are long; the rest of the terms follow them."""
    rows = [(i, " ".join(words[(i * 7 + j) % 400] for j in range(400))) for i in range(60)]
    docs = spark.createDataFrame([*rows, (90, None)], "id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in [*range(60), 90]], "doc_id long, toxic int")
    size = len(rows[0][1])
    few = pick_examples(docs, marks, F.lit(True), 50, 10 * size)
    assert few.count() in (10, 11) and sum(len(r["text"] or "") for r in few.collect()) <= 10 * size
    assert pick_examples(docs, marks, F.lit(True), 7).count() == 7
    again = pick_examples(docs.repartition(5), marks.repartition(3), F.lit(True), 50, 10 * size)
    assert {r["id"] for r in again.collect()} == {r["id"] for r in few.collect()}
    assert pick_examples(docs, marks, F.lit(True), 50, size - 1).count() <= 1


def test_near_vectors_in_middling_groups(spark):
    """Groups with more links than a list holds, around one centre each: every link is counted."""
    draw = np.random.default_rng(11)
    groups = [(c + draw.normal(scale=0.016, size=(n, 64))) for n in range(10, 40, 2) for c in [draw.normal(size=64) / 8]]
    vectors = np.concatenate([*groups, draw.normal(size=(300, 64))])
    rows = [(int(i), 1, v.tolist()) for i, v in enumerate(vectors)]
    got = near_vectors(spark.createDataFrame(rows, "id long, label int, vector array<double>")).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    links = (unit @ unit.T >= 0.98) & ~np.eye(len(unit), dtype=bool)
    assert 2000 < links.sum() < sum(n * n for n in range(10, 40, 2))
    assert {r["id"]: r["n_links"] for r in got} == dict(enumerate(links.sum(axis=1).tolist()))
    want = smallest(range(len(rows)), list(zip(*np.nonzero(links), strict=True)))
    assert {r["id"]: r["component_id"] for r in got} == {i: int(w) for i, w in want.items()}
