"""Ranked search against scores computed one by one, and its edge tables."""

import math
import random
import re
from collections import Counter

import numpy as np

from tierline.llm import lexical
from tierline.llm.lexical import rank_documents, read_best, terms_of

PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return PATTERN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counts = [(i, Counter(split(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 25 + 75 * sum(c.values()) * n_docs // total if total else 0
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in split(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, rank, s[2], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, k):
    out = rank_documents(
        spark.createDataFrame(docs, "id long, text string").repartition(5),
        spark.createDataFrame(items, "id long, text string").repartition(3),
        k,
    )
    assert out.columns == ["item", "rank", "id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_terms():
    text = "Ab_c-D9 é'É\tx\x7f日本 ~z\x00q r"
    assert [t.decode() for t in terms_of(text)] == split(text)
    assert terms_of(None) == terms_of("") == terms_of("-_. ") == []


def corpus(words):
    draw = random.Random(12)
    often = words[:8]
    docs = [
        (i, " ".join(draw.choice(often if draw.random() < 0.6 else words) for _ in range(draw.randrange(1, 60))))
        for i in range(400)
    ]
    docs += [(1000 + i, docs[5][1]) for i in range(120)]
    docs += [(7, docs[9][1]), (3, docs[3][1]), (3, docs[3][1]), (None, docs[5][1]), (None, None), (2000, None), (2001, "")]
    docs += [(2002, "- _ !"), (2003, f"{'v' * 5000} " * 3 + " ".join(words) * 40), (2004, "Été naïve 東京")]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(1, 25)))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "zzz unseen"), (33, f"{words[1]} " * 7 + words[200]), (34, docs[5][1])]
    items += [(34, docs[5][1]), (None, docs[5][1]), (35, "v" * 5000), (36, "été Naïve 東京"), (37, docs[403][1].upper())]
    return docs, items


def test_best_documents_match_full_scores(spark, words, monkeypatch):
    """Hot terms, many equal scores at the cut, copies, repeated and null ids, long terms, several chunks and blocks."""
    docs, items = corpus(words)
    want = brute(docs, items, 10)
    assert run(spark, docs, items, 10) == want
    monkeypatch.setattr(lexical, "CHUNK_DOCS", 23)
    monkeypatch.setattr(lexical, "ITEM_TERMS", 90)
    monkeypatch.setattr(lexical, "DEPTH", 2)
    assert run(spark, docs, items, 10) == want
    assert run(spark, docs, items, 1) == brute(docs, items, 1)


def test_empty_tables(spark):
    docs, items = [(1, "a b"), (2, "b")], [(1, "b")]
    assert run(spark, docs, items, 5) == brute(docs, items, 5)
    assert run(spark, [], items, 5) == run(spark, docs, [], 5) == run(spark, [(1, None)], items, 5) == []


def test_reading_stops_early_and_exact():
    """The heads of long lists settle the best documents."""
    draw = np.random.default_rng(1)
    n = 20_000
    lists, full = [], np.zeros(n, np.int64)
    for _ in range(4):
        impact = draw.integers(1, 50, n)
        impact[17], impact[n - 1] = 1000, 900
        full += impact
        order = np.argsort(-impact, kind="stable")
        lists.append((order, impact[order]))

    class Reads(np.ndarray):
        deepest = 0

        def __getitem__(self, key):
            if isinstance(key, slice) and key.stop is not None:
                Reads.deepest = max(Reads.deepest, key.stop)
            return super().__getitem__(key)

    found, scores = read_best([(doc.view(Reads), impact) for doc, impact in lists], n, 2, 0)
    assert sorted(found.tolist()) == [17, n - 1] and sorted(scores.tolist()) == [3600, 4000]
    assert Reads.deepest == lexical.DEPTH
    everything, exact = read_best(lists, n, n, 0)
    assert (exact == full[everything]).all() and len(everything) == n
