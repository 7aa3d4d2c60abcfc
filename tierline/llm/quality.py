"""Quality scores by histogram gradient-boosted trees over document statistics.

One pass reads the texts and writes a few statistics per document. Labels join those narrow rows; quantiles
of the labelled rows are the edges of the histograms. Trees grow level by level: each task sums the gradients of
its rows by node, statistic and bin, the sums are added over the tasks (``treeReduce``), and the driver, which
sees one histogram of fixed size, picks the splits. All labelled rows count. Gradients are rounded to whole
numbers, so that sums do not depend on the order of tasks and runs agree.

The finished trees are three flat arrays, which numpy walks for all rows of a batch at once.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Columns, map_columns, small_batches, staged, table
from tierline.llm.toxicity import held_out

TREES = 24
DEPTH = 3
BINS = 64
RATE = 0.3
# Ridge on leaf values, and the least second derivative of a leaf.
RIDGE = 1.0
LEAST_WEIGHT = 2.0
# Gradients are multiples of 1 / UNIT.
UNIT = 1 << 20
TILE_ROWS = 8192

NAMES = (
    "characters", "words", "word_length", "longest_word", "short_words", "no_letter_words", "distinct_words",
    "commonest_word", "repeated_neighbours", "capitals", "digits", "stops", "exclamations", "symbols", "white",
    "beyond_ascii", "lines", "line_words", "repeated_lines", "longest_line", "entropy",
)
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_STOPS = np.frombuffer(b".,;:?", np.uint8)
_MARKS = np.frombuffer(bytes(c for c in range(33, 127) if chr(c) not in ".,;:?!'\"-()" and not chr(c).isalnum()), np.uint8)


def statistics_of(text: str | None) -> list[float]:
    """The numbers in ``NAMES`` for a whole text; null counts as empty, and all are 0 for an empty text."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    if not raw:
        return [0.0] * len(NAMES)
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), [line for line in raw.split(b"\n") if line]
    n, n_words, n_lines = len(raw), max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    copies = Counter(lines)
    ascii_letters = int(byte[65:91].sum() + byte[97:123].sum())
    lead = int(byte[0xC0:].sum())
    share = byte[byte > 0] / n
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        float(lengths.sum()) / n_words,
        math.log1p(int(lengths.max(initial=0))),
        int((lengths <= 3).sum()) / n_words,
        sum(c for w, c in counts.items() if w.isascii() and not w.strip(_NOT_LETTERS)) / n_words,
        len(counts) / n_words,
        max(counts.values(), default=0) / n_words,
        sum(map(operator.eq, words, words[1:])) / n_words,
        int(byte[65:91].sum()) / max(1, ascii_letters),
        int(byte[48:58].sum()) / n,
        int(byte[_STOPS].sum()) / n_words,
        int(byte[33]) / n_words,
        int(byte[_MARKS].sum()) / n,
        int(byte[9:14].sum() + byte[32]) / n,
        lead / max(1, lead + ascii_letters),
        math.log1p(len(lines)),
        len(words) / n_lines,
        sum(len(line) * (c - 1) for line, c in copies.items()) / n,
        math.log1p(max(map(len, lines), default=0)),
        float(-(share * np.log2(share)).sum()),
    ]


# Stripping these from both ends of an ASCII word leaves nothing if it has no letter.
_NOT_LETTERS = bytes(c for c in range(128) if c not in _LETTERS)


def document_statistics(docs: DataFrame) -> DataFrame:
    """id and ``stats`` of each row of ``docs`` (id, text), from one pass over the texts."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            yield {"id": batch["id"], "stats": [statistics_of(t) for t in batch["text"]]}

    return map_columns(docs.select("id", "text"), run, f"id {docs.schema['id'].dataType.simpleString()}, stats array<float>")


def _walk(values: np.ndarray, feature: np.ndarray, bound: np.ndarray, depth: int) -> np.ndarray:
    """Numbers, from 0, of the nodes of level ``depth`` that rows reach: right where a value is above its bound."""
    rows, node = np.arange(len(values)), np.zeros(len(values), np.int64)
    for _ in range(depth):
        node = 2 * node + 1 + (values[rows, feature[node]] > bound[node])
    return node - (2**depth - 1)


@dataclass
class Forest:
    """Complete binary trees: by tree and inner node the statistic and its bound, by tree and leaf the value."""

    base: float
    feature: np.ndarray
    bound: np.ndarray
    value: np.ndarray

    def logits(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), self.base)
        for feature, bound, value in zip(self.feature, self.bound, self.value, strict=True):
            out += value[_walk(values, feature, bound, DEPTH)]
        return out

    def score(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(values), -30, 30)))


def _tiles(known: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """Labelled rows (stats, label) packed as matrices of bins, a byte each, and labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def tile() -> pa.RecordBatch:
            bins, label = (np.concatenate(p) for p in zip(*parts, strict=True))
            parts.clear()
            return pa.RecordBatch.from_pydict({"bins": [bins.tobytes()], "label": [label.tobytes()]})

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(edges))
            bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1).astype(np.uint8)
            parts.append((bins, batch.column("label").to_numpy(zero_copy_only=False).astype(np.uint8)))
            if sum(len(p[0]) for p in parts) >= TILE_ROWS:
                yield tile()
        if parts:
            yield tile()

    return staged(known.select("stats", "label").mapInArrow(run, "bins binary, label binary"), "tiles")


def _histogram(tile: tuple, forest: Forest, feature: np.ndarray, bound: np.ndarray, depth: int) -> np.ndarray:
    """First and second derivatives of a tile's rows, summed by node of a level, statistic and bin."""
    label = np.frombuffer(tile["label"], np.uint8)
    bins = np.frombuffer(tile["bins"], np.uint8).reshape(len(label), -1)
    p = forest.score(bins)
    first, second = np.rint((label - p) * UNIT), np.rint(p * (1 - p) * UNIT)
    node, width = _walk(bins, feature, bound, depth), bins.shape[1]
    out = np.empty((2, 2**depth, width, BINS))
    for f in range(width):
        at = node * BINS + bins[:, f]
        for part, weight in zip(out, (first, second), strict=True):
            part[:, f] = np.bincount(at, weight, 2**depth * BINS).reshape(-1, BINS)
    return out


def _split(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By node: the statistic and bin that gain most (255: none), and the values of both sides."""
    left = sums.cumsum(axis=-1)
    whole = left[..., -1:]
    right = whole - left

    def worth(part: np.ndarray) -> np.ndarray:
        return part[0] ** 2 / (part[1] + RIDGE)

    gain = worth(left) + worth(right) - worth(whole)
    gain[(left[1] < LEAST_WEIGHT) | (right[1] < LEAST_WEIGHT)] = 0
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    nodes = np.arange(len(gain))
    feature, at = np.divmod(best, BINS)
    sides = np.stack([left[:, nodes, feature, at], right[:, nodes, feature, at]], axis=-1)
    none = flat[nodes, best] <= 1e-9
    sides[:, none] = whole[:, none, 0]
    return np.where(none, 0, feature), np.where(none, 255, at), RATE * sides[0] / (sides[1] + RIDGE)


def fit(stats: DataFrame, labels: DataFrame, train: Column | str) -> Forest:
    """Trees from ``stats`` (id, stats) and ``labels`` (doc_id, quality) where ``train`` (over id) holds.

    A label of 1 is good and 0 is not; other labels are ignored. Of labels that contradict each other the 0
    counts. Without labels the forest is empty and scores are one half.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    known = known.agg(F.min("quality").alias("label")).where(train)
    known = staged(stats.join(known, "id").select("stats", "label"), "labelled")
    width = len(NAMES)
    at = [(i + 1) / BINS for i in range(BINS - 1)]
    cuts = [F.percentile_approx(F.col("stats")[f], at, 10_000).alias(f"q{f}") for f in range(width)]
    n, ones, *quantiles = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0)), *cuts).first()
    edges = [np.unique(np.array(q or [], np.float32)) for q in quantiles]
    nodes, leaves = 2**DEPTH - 1, 2**DEPTH
    base = math.log((ones + 0.5) / (n - ones + 0.5))
    forest = Forest(base, np.empty((0, nodes), int), np.empty((0, nodes)), np.empty((0, leaves)))
    if 0 < ones < n:
        tiles = _tiles(known, edges).rdd
        for _ in range(TREES):
            feature, bound = np.zeros(nodes, int), np.full(nodes, 255.0)
            for depth in range(DEPTH):
                sums = tiles.mapPartitions(_Sums(forest, feature, bound, depth)).treeReduce(operator.add)
                own = slice(2**depth - 1, 2 ** (depth + 1) - 1)
                feature[own], bound[own], value = _split(sums / UNIT)
            forest = Forest(
                base,
                np.vstack([forest.feature, feature]),
                np.vstack([forest.bound, bound]),
                np.vstack([forest.value, value.reshape(1, -1)]),
            )
    # Bins become values: a bin is above b exactly if the value is above edge b.
    raw = np.array([
        [edges[f][int(b)] if b < len(edges[f]) else np.inf for f, b in zip(fs, bs, strict=True)]
        for fs, bs in zip(forest.feature, forest.bound, strict=True)
    ]).reshape(forest.bound.shape)
    return Forest(base, forest.feature, raw, forest.value)


@dataclass
class _Sums:
    """Sums of a task's tiles; None stands for a task without tiles and adds nothing."""

    forest: Forest
    feature: np.ndarray
    bound: np.ndarray
    depth: int

    def __call__(self, tiles: Iterator) -> Iterator[np.ndarray]:
        total = None
        for tile in tiles:
            part = _histogram(tile, self.forest, self.feature, self.bound, self.depth)
            total = part if total is None else total + part
        if total is not None:
            yield total


def score_quality(docs: DataFrame, labels: DataFrame, train: Column | str) -> DataFrame:
    """One row per row of ``docs`` (id, text): id, score and its ``stats``.

    Trees come from ``labels`` (doc_id, quality) where ``train`` (over id) holds. Only texts decide on scores:
    null and empty texts have statistics of 0 and are scored like all others, equal texts get equal scores, and
    equal rows are each returned. Rows whose id is null or has no label are scored but teach nothing. An empty
    table gives no rows. Whole texts are read once; the statistics are written and read again.
    """
    stats = staged(document_statistics(docs), "statistics")
    forest = fit(stats, labels, train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            yield batch.append_column("score", pa.array(forest.score(x)))

    kind = stats.schema["id"].dataType.simpleString()
    return stats.mapInArrow(run, f"id {kind}, stats array<float>, score double").select("id", "score", "stats")


def op13_quality_boosted_trees(spark, sf_dir: str) -> DataFrame:
    """Quality of all documents; labels are learned outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    scored = score_quality(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("id")))
    return scored.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
