"""Benchmark decontamination by spaced seeds.

A seed is a mask over a window of words: hashes of the words at its chosen places ignore the others, so two
passages share a hash although words in between were replaced. Hashes of benchmark items and of training
texts are joined; around each hit the two texts are compared word by word on the hit's diagonal, and an
overlap counts if enough of its words are equal.

The items are read in blocks of a fixed number. A block's table of hashes goes to all tasks, and the training
texts are streamed past it, whole; more items mean more blocks.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Columns, map_columns, small_batches, staged, table
from tierline.llm.shingles import WordHashes, mixed

# Masks of weight 6 over at most 11 words; the first is solid.
MASKS = ("111111", "1101100101", "11001010011", "1010011011")
# An overlap has so many words (or the whole item, if shorter) and this percentage of them equal.
OVERLAP = 13
PERCENT = 80
BLOCK_ITEMS = 20_000
COLUMNS = ("doc_id", "item_id", "doc_word", "item_word", "words", "same")

# Scripts without white space (Chinese, Japanese, Thai, Lao, Burmese, Khmer), whose characters are words, and their marks.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_MARKS = re.compile("[\u3000-\u3004\u3008-\u303f\uff01-\uff0f\uff1a-\uff20]")
_DROP = string.punctuation.encode()
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def words(text: str | None, cache: WordHashes) -> np.ndarray:
    """Hashes of the words without case; ASCII punctuation is dropped, white space separates.

    In scripts that use no white space each character is a word, and their punctuation is dropped too.
    """
    if text and not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \1 ", _MARKS.sub(" ", text))
    raw = text.casefold().encode("utf-8", "surrogatepass") if text else b""
    return cache.of(raw.translate(None, _DROP).split())


def _seed(hashes: np.ndarray, mask: str) -> np.ndarray:
    """One hash per window of the mask's span."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, np.uint64(len(mask)), np.uint64)
    for i, use in enumerate(mask):
        if use == "1":
            h = h * _STEP + hashes[i : i + n]
    return mixed(h)


def short_masks(n: int, percent: int) -> list[str]:
    """Masks over an item of ``n`` words, one of which ignores all replaced words if ``percent`` are equal.

    Words are dealt to a few groups more than may be replaced, and each mask ignores as many groups.
    """
    spare = n * (100 - percent) // 100
    groups = min(n, spare + 2)
    return ["".join("0" if i % groups in left else "1" for i in range(n)) for left in combinations(range(groups), spare)]


class Index:
    """Hashes of a block of items under all masks, with a bit table in front."""

    def __init__(self, items: list[tuple[object, str | None]], masks=MASKS, overlap=OVERLAP, percent=PERCENT):
        cache = WordHashes()
        found = [(key, mixed(words(text, cache))) for key, text in items]
        self.items = [(key, w) for key, w in found if len(w)]
        self.overlap, self.percent = overlap, percent
        # Items shorter than an overlap get masks over their own length.
        lengths = {len(w) for _, w in self.items if len(w) < OVERLAP}
        short = {mask for n in sorted(lengths) for mask in short_masks(n, percent)}
        self.tables = []
        for mask in dict.fromkeys([*masks, *sorted(short)]):
            rows = [
                (h, i, at)
                for i, (_, w) in enumerate(self.items)
                if mask in masks or len(w) == len(mask)
                for at, h in enumerate(_seed(w, mask).tolist())
            ]
            if not rows:
                continue
            rows.sort()
            hashes = np.array([r[0] for r in rows], np.uint64)
            bits = np.zeros(1 << _BITS, bool)
            bits[hashes >> np.uint64(64 - _BITS)] = True
            self.tables.append((mask, hashes, np.array([r[1:] for r in rows], np.int64), bits))

    def overlaps(self, text: np.ndarray) -> list[tuple[object, int, int, int, int]]:
        """(item, first word in the text, first word in the item, words, equal words), the best of each item."""
        text = mixed(text)
        diagonals: set[tuple[int, int]] = set()
        for mask, hashes, places, bits in self.tables:
            seeds = _seed(text, mask)
            near = np.flatnonzero(bits[seeds >> np.uint64(64 - _BITS)])
            if not len(near):
                continue
            low = np.searchsorted(hashes, seeds[near], "left")
            high = np.searchsorted(hashes, seeds[near], "right")
            for at, a, b in zip(near[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
                diagonals.update((i, at - o) for i, o in places[a:b].tolist())
        best: dict[int, tuple] = {}
        for i, shift in diagonals:
            found = self._compare(text, i, shift)
            if found and (i not in best or (found[3], -found[0]) > (best[i][3], -best[i][0])):
                best[i] = found
        return [(self.items[i][0], *best[i]) for i in sorted(best)]

    def _compare(self, text: np.ndarray, i: int, shift: int) -> tuple[int, int, int, int] | None:
        item = self.items[i][1]
        start, end = max(0, shift), min(len(text), shift + len(item))
        width = min(self.overlap, len(item))
        if end - start < width:
            return None
        same = text[start:end] == item[start - shift : end - shift]
        total = np.concatenate([[0], np.cumsum(same)])
        good = np.flatnonzero(100 * (total[width:] - total[:-width]) >= self.percent * width)
        if not len(good):
            return None
        # From the first window that is similar enough to the end of the last one.
        first, last = int(good[0]), int(good[-1]) + width
        return start + first, start + first - shift, last - first, int(total[last] - total[first])


def _blocks(items: DataFrame, size: int) -> Iterator[list[tuple[object, str | None]]]:
    """The items (id, text) in blocks of about ``size`` rows, dealt by hash."""
    items = staged(items.select("id", "text"), "items")
    blocks = -(-items.count() // size)
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        yield [(r["id"], r["text"]) for r in rows]


def find_overlaps(docs: DataFrame, items: DataFrame, block: int = BLOCK_ITEMS) -> DataFrame:
    """Rows (doc_id, item_id, doc_word, item_word, words, same): the longest overlap of each pair.

    ``docs`` and ``items``: id, text. A pair overlaps if some 13 aligned words of them, or the whole item
    if it is shorter, are equal in at least 80 % of the places, and a seed meets there (a solid run of
    six equal words always does, and so does any place of an item of fewer than 13 words). Items of fewer than
    five words must be equal. Null and empty texts overlap with nothing. Equal rows are each returned. Word places count from 0.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ids = {"doc_id": docs.schema["id"].dataType, "item_id": items.schema["id"].dataType}
    schema = ", ".join(f"{k} {t.simpleString()}" for k, t in ids.items())
    schema += ", doc_word bigint, item_word bigint, words bigint, same bigint"
    found = spark.createDataFrame([], schema)
    for rows in _blocks(items, block):
        shared = spark.sparkContext.broadcast(Index(rows))

        def run(batches: Iterator[Columns], shared=shared) -> Iterator[Columns]:
            cache, index = WordHashes(), shared.value
            for batch in batches:
                rows = [
                    (key, *hit)
                    for key, text in zip(batch["id"], batch["text"], strict=True)
                    for hit in index.overlaps(words(text, cache))
                ]
                yield {c: [r[i] for r in rows] for i, c in enumerate(COLUMNS)}

        found = found.union(map_columns(docs.select("id", "text"), run, schema))
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame, block: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` (text and any other columns) that overlap with no item; nothing is shuffled."""
    spark = docs.sparkSession
    small_batches(spark)
    for rows in _blocks(items, block):
        shared = spark.sparkContext.broadcast(Index(rows))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            cache, index = WordHashes(), shared.value
            for batch in batches:
                clean = [not index.overlaps(words(t.as_py(), cache)) for t in batch.column("text")]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7_decontaminate_spaced_seeds(spark, sf_dir: str) -> DataFrame:
    """All overlaps of documents with benchmark items, one row per pair."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id AS id", "text")
    items = table(spark, sf_dir, "benchmark").selectExpr("item_id AS id", "text")
    return find_overlaps(docs, items)
