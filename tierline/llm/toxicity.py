"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and their beginnings, so that inflected and compound words share terms. The vector space has
every term of the examples, and inverse document frequencies count the examples: both are part of what is fitted on
them. Terms that tell toxic examples from others weigh more: by what their counts say beyond chance, given the
number of terms. Examples are bounded in rows and in bytes, which bounds what the driver holds and what it sends.

Rare terms are postings, which are read in full. The commonest terms are dense columns of blocks of examples, with
the largest weight of each column in each block. A query visits the blocks that bound best, and then only those
whose bound (with its exact score on the rare terms) is above the nearest found, so the nearest examples are exact.

A score is the vote of the nearest examples, weighted by cosine over distance, against a fixed prior weight of
the base rate, and calibrated by isotonic regression on votes that leave the voter itself out.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import BATCH_ROWS, Columns, map_columns, small_batches, staged, table

# Bounds: examples that the classifier is fitted on, and the bytes of their texts. They go to every task, with all
# their terms.
EXAMPLES = 4096
EXAMPLE_BYTES = 32 << 20
# The commonest terms of the examples, which are dense columns.
COMMON = 1024
# Lengths of the beginnings of words that are terms.
BEGINNINGS = (3, 5)
NEIGHBOURS = 15
BLOCK = 64
# Blocks that give a query its first nearest examples.
FIRST = 2
PRIOR = 2.0
EVIDENCE = 3
CACHE = 1 << 18
FLUSH = 1 << 19

_WORD = re.compile(r"\w+")


def terms_of(word: str) -> list[str]:
    """The word and its beginnings (^...)."""
    return [word, *(f"^{word[:k]}" for k in BEGINNINGS if len(word) > k)]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class Terms(list):
    """Terms that travel compressed."""

    def __reduce__(self):
        return Terms._read, (zlib.compress("\n".join(self).encode("utf-8", "surrogatepass"), 1),)

    @staticmethod
    def _read(packed: bytes) -> Terms:
        text = zlib.decompress(packed).decode("utf-8", "surrogatepass")
        return Terms(text.split("\n") if text else ())


class TermsOfWords(dict):
    """Places of the space's terms by word, kept while the cache is small."""

    def __init__(self, terms: list[str]):
        super().__init__()
        self.place = {t: i for i, t in enumerate(terms)}

    def __missing__(self, word: str) -> np.ndarray:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = np.array([self.place[t] for t in terms_of(word) if t in self.place], np.int32)
        return value

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the terms in a text, and how often each occurs."""
        found = Counter(words_of(text))
        if not found:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        each = [self[w] for w in found]
        places = np.repeat(np.concatenate(each), np.repeat(list(found.values()), list(map(len, each))))
        return np.unique(places, return_counts=True)


def pick_examples(
    docs: DataFrame, labels: DataFrame, train: Column, most: int = EXAMPLES, most_bytes: int = EXAMPLE_BYTES
) -> DataFrame:
    """Up to ``most`` labelled rows (id, text, toxic) on which ``train`` (over id) holds, in order of a hash.

    Rows come while their texts have ``most_bytes`` or less together. A label of 1 is toxic and 0 is not; other
    labels are ignored. Of labels that contradict each other the toxic one counts. Ids without a document have
    no text and are left out.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    known = known.agg(F.max("toxic").alias("toxic")).where(train)
    # The bound is on rows, so the smaller side of the join is broadcast.
    chosen = staged(known.orderBy(F.xxhash64("id"), "id").limit(most), "chosen")
    rows = docs.join(F.broadcast(chosen), "id").select("id", "text", "toxic")
    rows = staged(rows.dropDuplicates(["id"]), "examples")
    # The window sees ids and lengths of at most ``most`` rows.
    order = Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    kept = rows.select("id", F.sum(size).over(order).alias("so_far")).where(F.col("so_far") <= most_bytes)
    return rows.join(F.broadcast(kept.select("id")), "id", "left_semi")


def term_counts(examples: DataFrame) -> DataFrame:
    """term, toxic, clean: in how many examples of each kind a term occurs; tasks send sums."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> Columns:
            terms = list(counts[0].keys() | counts[1].keys())
            out = {"term": terms, "toxic": [counts[1][t] for t in terms], "clean": [counts[0][t] for t in terms]}
            counts[0].clear()
            counts[1].clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                counts[toxic].update({t for w in set(words_of(text)) for t in terms_of(w)})
                if sum(map(len, counts)) > FLUSH:
                    yield flush()
        yield flush()

    parts = map_columns(examples, run, "term string, toxic bigint, clean bigint")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def telling(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Factors, 1 at least, by which terms weigh more: what their counts tell of toxic examples beyond chance.

    It is the logarithm of the bound (Chernoff's) on drawing so many toxic examples at their overall rate, less
    that of one over the number of terms, so that about one term at most gains by chance.
    """
    if not n_toxic or not n_clean:
        return np.ones(len(toxic))
    n, rate = toxic + clean, n_toxic / (n_toxic + n_clean)
    q = toxic / n
    some, rest = q > 0, q < 1
    bound = np.zeros(len(n))
    bound[some] += q[some] * np.log(q[some] / rate)
    bound[rest] += (1 - q[rest]) * np.log((1 - q[rest]) / (1 - rate))
    return 1 + np.where(q > rate, np.maximum(n * bound - math.log(max(2, len(n))), 0), 0)


def sparse_examples(examples: DataFrame, terms: Broadcast) -> tuple[list, np.ndarray, list[tuple]]:
    """Ids, labels, and places and counts of the terms of ``examples`` (id, text, toxic), by id."""
    kind = examples.schema["id"].dataType.simpleString()

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        cache = TermsOfWords(terms.value)
        for batch in batches:
            found = [cache.of(t) for t in batch["text"]]
            yield {
                "id": batch["id"],
                "toxic": batch["toxic"],
                "at": [at.astype(np.int32).tobytes() for at, _ in found],
                "times": [times.astype(np.int32).tobytes() for _, times in found],
            }

    sparse = map_columns(examples.select("id", "text", "toxic"), run, f"id {kind}, toxic int, at binary, times binary")
    rows = sorted((tuple(r.values()) for r in sparse.toArrow().to_pylist()), key=lambda r: r[0])
    vectors = [(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.int32)) for r in rows]
    return [r[0] for r in rows], np.array([r[1] for r in rows], float), vectors


@dataclass
class Vectors:
    """Sparse unit vectors in rows: entries of row i are those from ``start[i]`` to ``start[i + 1]``."""

    start: np.ndarray
    at: np.ndarray
    value: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.start) - 1

    def __getitem__(self, rows: slice) -> Vectors:
        a, b, _ = rows.indices(len(self))
        start = self.start[a : max(a, b) + 1]
        return Vectors(start - start[0], self.at[start[0] : start[-1]], self.value[start[0] : start[-1]], self.width)

    @property
    def T(self) -> Vectors:
        """Columns as rows: the postings of each term."""
        row = np.repeat(np.arange(len(self), dtype=np.int32), np.diff(self.start))
        order = np.argsort(self.at, kind="stable")
        start = np.concatenate([[0], np.cumsum(np.bincount(self.at, minlength=self.width))])
        return Vectors(start, row[order], self.value[order], len(self))

    def __matmul__(self, other: Vectors) -> np.ndarray:
        out = np.zeros((len(self), other.width))
        for i in range(len(self)):
            at, value = self.row(i)
            first, n = other.start[at], other.start[at + 1] - other.start[at]
            total = int(n.sum())
            if total:
                place = np.repeat(first - np.cumsum(n) + n, n) + np.arange(total)
                out[i] = np.bincount(other.at[place], np.repeat(value, n) * other.value[place], other.width)
        return out

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.at[self.start[i] : self.start[i + 1]], self.value[self.start[i] : self.start[i + 1]]

    def columns(self, slot: np.ndarray, n: int) -> np.ndarray:
        """Dense columns: term t is column ``slot[t]``, or none if that is negative."""
        out = np.zeros((len(self), n))
        row, to = np.repeat(np.arange(len(self)), np.diff(self.start)), slot[self.at]
        out[row[to >= 0], to[to >= 0]] = self.value[to >= 0]
        return out

    def where(self, keep: np.ndarray) -> Vectors:
        """The entries of terms that ``keep`` marks."""
        kept = keep[self.at]
        start = np.concatenate([[0], np.cumsum(kept)])[self.start]
        return Vectors(start, self.at[kept], self.value[kept], self.width)


@dataclass
class Index:
    """Examples as unit vectors: postings of rare terms, and common terms dense in blocks with their largest weights."""

    weight: np.ndarray
    ids: list
    toxic: np.ndarray
    base: float
    order: np.ndarray
    slot: np.ndarray
    dense: np.ndarray
    tops: np.ndarray
    rare: Vectors
    rows: list[tuple]
    steps: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.0]))

    @classmethod
    def build(cls, weight: np.ndarray, ids: list, toxic: np.ndarray, rows: list[tuple]) -> Index:
        base = (toxic.sum() + 0.5) / (len(toxic) + 1.0) if len(toxic) else 0.5
        none = np.empty(0)
        made = cls(weight, ids, toxic, base, none, none, none, none, Vectors(np.zeros(1, int), none, none, 0), rows)
        vectors = made.vectors(rows)
        seen = np.bincount(vectors.at, minlength=len(weight))
        common = np.argsort(-seen, kind="stable")[:COMMON]
        made.slot = np.full(len(weight), -1, np.int32)
        made.slot[common] = np.arange(len(common))
        dense = vectors.columns(made.slot, len(common))
        # Neighbouring examples share their heaviest common term, which makes bounds tight.
        heaviest = dense.argmax(axis=1) if dense.size else np.zeros(len(rows), int)
        made.order = np.lexsort((np.arange(len(rows)), heaviest))
        made.dense = dense[made.order]
        tops = [made.dense[i : i + BLOCK].max(axis=0) for i in range(0, len(rows), BLOCK)]
        made.tops = np.array(tops).reshape(len(tops), len(common))
        # Postings name examples by their place in the order of the blocks.
        rare = vectors.where(made.slot < 0).T
        made.rare = Vectors(rare.start, np.argsort(made.order)[rare.at].astype(np.int32), rare.value, rare.width)
        return made

    def __reduce__(self):
        """The index travels as its examples' terms and counts, compressed, and is built again."""
        n = [len(at) for at, _ in self.rows]
        flat = [np.concatenate([np.empty(0, np.int32), *(np.asarray(r[k], np.int32) for r in self.rows)]) for k in (0, 1)]
        steps = np.diff(flat[0], prepend=0).astype(np.int32)
        state = (self.weight, self.ids, self.toxic, n, steps, flat[1].astype(np.int32))
        return Index._read, (zlib.compress(pickle.dumps(state), 1), self.steps)

    @staticmethod
    def _read(packed: bytes, steps: tuple[np.ndarray, np.ndarray]) -> Index:
        weight, ids, toxic, n, moves, times = pickle.loads(zlib.decompress(packed))
        ends = np.cumsum(n)[:-1] if n else []
        at = np.cumsum(moves, dtype=np.int64).astype(np.int32)
        rows = list(zip(np.split(at, ends), np.split(times, ends), strict=True)) if n else []
        made = Index.build(weight, ids, toxic, rows)
        made.steps, made.rows = steps, []
        return made

    def vectors(self, rows: list[tuple]) -> Vectors:
        start = np.concatenate([[0], np.cumsum([len(at) for at, _ in rows], dtype=np.int64)]).astype(np.int64)
        at = np.concatenate([np.empty(0, np.int32), *(np.asarray(at, np.int32) for at, _ in rows)]).astype(np.int32)
        times = np.concatenate([np.empty(0), *(np.asarray(times, float) for _, times in rows)])
        value = (1 + np.log(times)) * self.weight[at]
        row = np.repeat(np.arange(len(rows)), np.diff(start))
        norm = np.sqrt(np.bincount(row, value * value, len(rows)))
        return Vectors(start, at, value / norm[row], len(self.weight))

    def nearest(self, queries: Vectors, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cosines and examples (-1: none) of the nearest, by query; ``skip``: an example that may not vote."""
        k, n, examples = NEIGHBOURS, len(queries), len(self.toxic)
        best, who = np.zeros((n, k)), np.full((n, k), -1)
        if not examples or not n:
            return best, who
        near = queries.where(self.slot < 0) @ self.rare
        common = queries.columns(self.slot, self.dense.shape[1])
        ends = np.arange(0, examples, BLOCK)
        bounds = np.maximum.reduceat(near, ends, axis=1) + common @ self.tops.T
        done = np.zeros(bounds.shape, bool)
        back = np.argsort(self.order)

        def visit(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(axis=0)):
                rows, own = np.flatnonzero(wanted[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
                near[rows, own] += common[rows] @ self.dense[own].T
            done[wanted] = True
            if skip is not None:
                near[np.arange(n), back[skip]] = 0

        def kth(known: np.ndarray) -> np.ndarray:
            return np.partition(known, -k, axis=1)[:, -k] if known.shape[1] >= k else np.zeros(n)

        first = np.zeros(bounds.shape, bool)
        best_blocks = np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST]
        np.put_along_axis(first, best_blocks, True, axis=1)
        visit(first)
        seen = (best_blocks[:, :, None] * BLOCK + np.arange(BLOCK)).reshape(n, -1)
        inside = seen < examples
        seen = np.where(inside, np.take_along_axis(near, np.where(inside, seen, 0), axis=1), 0)
        # A block whose bound is not above the k-th best so far changes nothing.
        visit(~done & (bounds > kth(seen)[:, None] + 1e-12))
        near[~np.repeat(done, BLOCK, axis=1)[:, :examples]] = 0
        least = kth(near)
        for i in range(n):
            some = np.flatnonzero((near[i] >= least[i]) & (near[i] > 0))
            # Ties go to the example that comes first.
            some = some[np.lexsort((self.order[some], -near[i, some]))][:k]
            best[i, : len(some)], who[i, : len(some)] = near[i, some], self.order[some]
        return best, who

    def votes(self, cosines: np.ndarray, who: np.ndarray) -> np.ndarray:
        weight = np.where(who >= 0, cosines / (1.1 - np.minimum(cosines, 1.0)), 0.0)
        voted = np.where(who >= 0, self.toxic[who] if len(self.toxic) else 0, 0)
        return ((weight * voted).sum(axis=1) + PRIOR * self.base) / (weight.sum(axis=1) + PRIOR)

    def calibrate(self, rows: list[tuple]) -> None:
        """Isotonic regression of the labels on the examples' votes without themselves."""
        if not len(self.toxic):
            self.steps = (np.array([0.0, 1.0]), np.array([self.base, self.base]))
            return
        found = [
            self.nearest(self.vectors(rows[i : i + BATCH_ROWS]), np.arange(i, min(i + BATCH_ROWS, len(rows))))
            for i in range(0, len(rows), BATCH_ROWS)
        ]
        cosines, who = (np.concatenate(part) for part in zip(*found, strict=True))
        votes = self.votes(cosines, who)
        values, back = np.unique(votes, return_inverse=True)
        ones = np.bincount(back, self.toxic)
        count = np.bincount(back).astype(float)
        pools: list[list[float]] = []
        for v, o, c in zip(values, ones, count, strict=True):
            pools.append([v, v, o, c])
            while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
                low = pools.pop()
                pools[-1] = [pools[-1][0], low[1], pools[-1][2] + low[2], pools[-1][3] + low[3]]
        x = [p for pool in pools for p in (pool[0], pool[1])]
        # A little of the base rate keeps scores off 0 and 1.
        y = [q for pool in pools for q in [(pool[2] + self.base) / (pool[3] + 1)] * 2]
        self.steps = (np.array(x), np.maximum.accumulate(np.array(y)))

    def score(self, queries: Vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cosines, who = self.nearest(queries)
        return np.clip(np.interp(self.votes(cosines, who), *self.steps), 0, 1), cosines, who


def fit(docs: DataFrame, labels: DataFrame, train: Column) -> tuple[Index, Broadcast]:
    """Index and terms from ``labels`` (doc_id, toxic) where ``train`` (over id) holds; ``docs``: id, text."""
    small_batches(docs.sparkSession)
    examples = pick_examples(docs, labels, train)
    counts = term_counts(examples.select("text", "toxic")).toArrow().sort_by("term")
    terms = docs.sparkSession.sparkContext.broadcast(Terms(counts["term"].to_pylist()))
    ids, toxic, vectors = sparse_examples(examples, terms)
    n_toxic, of_toxic, of_clean = int(toxic.sum()), counts["toxic"].to_numpy(), counts["clean"].to_numpy()
    idf = np.log((1 + len(toxic)) / (1 + of_toxic + of_clean)) + 1
    more = telling(of_toxic, of_clean, n_toxic, len(toxic) - n_toxic)
    index = Index.build(idf * more, ids, toxic, vectors)
    index.calibrate(vectors)
    return index, terms


def score_toxicity(docs: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """One row per row of ``docs`` (id, text): id, score and ``evidence``, the nearest examples.

    Examples come from ``labels`` (doc_id, toxic) where ``train`` (over id) holds. Only texts decide on scores.
    Null and empty texts, and texts without a term of any example, have no near example and get the calibrated
    base rate, as do all texts if there are no examples. Equal texts get equal scores; equal rows are each
    returned. Besides the examples, texts are read once.
    """
    index, terms = fit(docs, labels, train)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        own, cache = shared.value, TermsOfWords(terms.value)
        for batch in batches:
            score, cosines, who = own.score(own.vectors([cache.of(t) for t in batch["text"]]))
            evidence = [
                [(own.ids[i], int(own.toxic[i]), float(c)) for c, i in zip(cs, ws, strict=True) if i >= 0]
                for cs, ws in zip(cosines[:, :EVIDENCE], who[:, :EVIDENCE], strict=True)
            ]
            names = ("doc_id", "toxic", "cosine")
            yield {
                "id": batch["id"],
                "score": score,
                "evidence": [[dict(zip(names, e, strict=True)) for e in row] for row in evidence],
            }

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, score double, evidence array<struct<doc_id: {kind}, toxic: int, cosine: double>>"
    return map_columns(docs.select("id", "text"), run, schema)


def held_out(doc_id: Column) -> Column:
    """The fifth of all documents whose labels are not learned from; null ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any other columns) with a score below one half; no shuffle."""
    index, terms = fit(docs.select(F.col("doc_id").alias("id"), "text"), labels, ~held_out(F.col("id")))
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, cache = shared.value, TermsOfWords(terms.value)
        for batch in batches:
            score, _, _ = index.score(index.vectors([cache.of(t.as_py()) for t in batch.column("text")]))
            yield batch.filter(pa.array(score < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op2_toxicity_knn(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; labels are learned outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("id")))
    return scored.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence",
    )
