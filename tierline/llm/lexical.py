"""Ranked lexical search: the best documents of each item, by sequential reads of impact-sorted lists (NRA).

Texts are read once per block of items, into a written index: rows of chunks of documents with the counts of the items'
terms. Corpus statistics (documents, terms, documents per term) are sums over that index. A second pass reads
the chunks; each turns counts into impacts, sorts its list of every term by impact, and answers all items.

An item reads its lists from the top, all to the same depth, which grows. What was read of a document is the lower end
of its score; the last impacts read from the lists that did not show it yet bound the rest. Reading goes on until
every document whose upper end reaches the k-th best lower end (or the best that the task has seen in earlier
chunks) is known exactly, so that membership, ties and scores are settled. Tasks send k documents an item.

Scores are whole numbers. A task holds one chunk, which is bounded by documents and postings; items come in blocks
that are bounded by items and terms, and only their terms enter the index.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import Columns, map_columns, small_batches, staged, table

TOP = 10
# Bounds of a block of items, in expectation: items and their distinct terms. One item may be larger.
ITEMS = 5000
ITEM_TERMS = 200_000
# Bounds of a chunk of documents; one document may be larger.
CHUNK_DOCS = 1 << 14
CHUNK_POSTINGS = 1 << 21
# Longer terms are known by their 128-bit hash.
LONG = 32
# Postings first read from each list, and the growth of the depth.
DEPTH, GROWTH = 64, 4

# Bytes that end a term become spaces, capital letters small ones; bytes of other characters stay.
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII digits and letters and of all characters beyond ASCII, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _key(term: bytes) -> bytes:
    return term if len(term) <= LONG else b"\0" + xxhash.xxh3_128_digest(term)


def _counted(terms: list[bytes]) -> Counter:
    """Occurrences by key."""
    counts = Counter(terms)
    for term in [t for t in counts if len(t) > LONG]:
        counts[_key(term)] += counts.pop(term)
    return counts


def _read_items(items: DataFrame) -> DataFrame:
    """tag, id, keys and times of the terms of ``items`` (id, text) that have a term; the tag tells rows apart."""
    kind = items.schema["id"].dataType.simpleString()

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        tag = TaskContext.get().partitionId() << 40
        for batch in batches:
            counts = [_counted(terms_of(t)) for t in batch["text"]]
            yield {
                "tag": range(tag, tag + len(counts)),
                "id": batch["id"],
                "keys": [list(c) for c in counts],
                "times": [list(c.values()) for c in counts],
            }
            tag += len(counts)

    found = map_columns(items.select("id", "text"), run, f"tag bigint, id {kind}, keys array<binary>, times array<bigint>")
    return staged(found.where("size(keys) > 0"), "items")


@dataclass
class Chunk:
    """Documents of a chunk and their postings, while it is filled."""

    ids: list = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    at: list[np.ndarray] = field(default_factory=list)
    times: list[np.ndarray] = field(default_factory=list)
    postings: int = 0

    def add(self, doc: object, length: int, at: list[int], times: list[int]) -> None:
        self.ids.append(doc)
        self.lengths.append(length)
        self.at.append(np.array(at, np.int32))
        self.times.append(np.array(times, np.int64))
        self.postings += len(at)

    @property
    def full(self) -> bool:
        return len(self.ids) >= CHUNK_DOCS or self.postings >= CHUNK_POSTINGS

    def row(self) -> Columns:
        """The chunk by ascending id (nulls last), postings by term."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i]))
        at, times = (np.concatenate([part[i] for i in order]) for part in (self.at, self.times))
        doc = np.repeat(np.arange(len(order), dtype=np.int32), [len(self.at[i]) for i in order])
        by_term = np.argsort(at, kind="stable")
        return {
            "ids": [[self.ids[i] for i in order]],
            "lengths": [[self.lengths[i] for i in order]],
            "at": [at[by_term].tobytes()],
            "doc": [doc[by_term].tobytes()],
            "times": [times[by_term].tobytes()],
        }


def _index(docs: DataFrame, place: dict[bytes, int]) -> DataFrame:
    """Chunks of ``docs`` (id, text) with the postings of the terms in ``place``, written."""
    kind = docs.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        known, chunk = shared.value, Chunk()
        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"], strict=True):
                terms = terms_of(text)
                counts = _counted(terms)
                met = counts.keys() & known.keys()
                chunk.add(doc, len(terms), [known[t] for t in met], [counts[t] for t in met])
                if chunk.full:
                    yield chunk.row()
                    chunk = Chunk()
        if chunk.ids:
            yield chunk.row()

    schema = f"ids array<{kind}>, lengths array<bigint>, at binary, doc binary, times binary"
    return staged(map_columns(docs.select("id", "text"), run, schema), "index")


def _statistics(index: DataFrame, width: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms, and documents by term of the block."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        seen = np.zeros(width, np.int64)
        for batch in batches:
            for at in batch["at"]:
                seen += np.bincount(np.frombuffer(at, np.int32), minlength=width)
        some = np.flatnonzero(seen)
        yield {"at": some.tolist(), "df": seen[some].tolist()}

    length = F.explode("lengths").alias("n")
    docs, total = index.select(length).where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    sums = map_columns(index.select("at"), run, "at int, df bigint").groupBy("at").agg(F.sum("df").alias("df"))
    df = np.zeros(width, np.int64)
    for at, n in sums.collect():
        df[at] = n
    return docs, total, df


def read_best(lists: list[tuple[np.ndarray, np.ndarray]], docs: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and exact scores that may be among the best ``k``, by NRA over (documents, impacts) lists.

    Lists are sorted by falling impact and name a document once. Documents below ``least`` are not looked for.
    """
    lower = np.zeros(docs, np.int64)
    done, depth = 0, DEPTH
    while True:
        rest, shown = 0, np.zeros(docs, np.int64)
        for doc, impact in lists:
            lower[doc[done:depth]] += impact[done:depth]
            if depth < len(doc):
                rest += int(impact[depth - 1])
                shown[doc[:depth]] += impact[depth - 1]
        upper = lower + (rest - shown)
        kth = int(np.partition(lower, docs - k)[docs - k]) if docs >= k else 0
        found = np.flatnonzero(upper >= max(1, least, kth))
        if (lower[found] == upper[found]).all():
            return found, lower[found]
        done, depth = depth, depth * GROWTH


def _search(
    index: DataFrame, items: list[tuple], item_kind: str, weight: np.ndarray, docs: int, total: int, k: int
) -> DataFrame:
    """tag, item, id, score: the best ``k`` of every task. ``items``: (tag, id, terms, times)."""
    kind = index.schema["ids"].dataType.elementType.simpleString()
    shared = index.sparkSession.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        items, weight = shared.value
        best: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            for ids, lengths, at, doc, times in zip(*(batch[c] for c in _CHUNK), strict=True):
                at, doc, times = np.frombuffer(at, np.int32), np.frombuffer(doc, np.int32), np.frombuffer(times, np.int64)
                size = np.array([25 + 75 * n * docs // total if total else 0 for n in lengths], np.int64)
                impact = weight[at] * (1_000_000_000 * times // (1000 * times + 8 * size[doc]))
                order = np.lexsort((-impact, at))
                doc, impact = doc[order], impact[order]
                start = np.searchsorted(at, np.arange(len(weight) + 1))
                for own, (_, _, terms, repeats) in zip(best, items, strict=True):
                    spans = [(slice(start[t], start[t + 1]), q) for t, q in zip(terms, repeats, strict=True)]
                    lists = [(doc[s], impact[s] * q if q > 1 else impact[s]) for s, q in spans if s.start < s.stop]
                    least = -own[-1][0] if len(own) == k else 0
                    found, scores = read_best(lists, len(ids), k, least)
                    first = np.lexsort((found, -scores))[:k]
                    own += [(-int(scores[i]), ids[found[i]] is None, ids[found[i]]) for i in first]
                    own.sort()
                    del own[k:]
        rows = [(item[0], item[1], r[2], -r[0]) for item, own in zip(items, best, strict=True) for r in own]
        yield {name: [r[i] for r in rows] for i, name in enumerate(("tag", "item", "id", "score"))}

    return map_columns(index.select(*_CHUNK), run, f"tag bigint, item {item_kind}, id {kind}, score bigint")


_CHUNK = ("ids", "lengths", "at", "doc", "times")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item, rank, id, score: up to ``k`` documents of ``docs`` (id, text) for each row of ``items`` (id, text).

    A document scores the sum, over the item's terms with repeats, of ``w * (10**9 * tf // (1000 * tf + 8 * m))``,
    where ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 25 + 75 * n * N // L``; N counts documents with
    a term, L their terms, n the document's. Only scores above 0 are returned; equal scores go by ascending id, null
    ids last. Null and empty texts have no terms: such documents are never found, such items have no rows. Repeated
    rows count as often as they occur: documents may stand beside their copies, and each row of an item is answered.
    Empty tables give no rows. Texts are read once per block of items, whole.
    """
    small_batches(docs.sparkSession)
    asked = _read_items(items)
    rows, terms = asked.agg(F.count("*"), F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()
    blocks = max(1, -(-rows // ITEMS), -(-terms // ITEM_TERMS))
    docs = docs if rows else docs.limit(0)
    kind = items.schema["id"].dataType.simpleString()
    found = []
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("tag"), F.lit(blocks)) == b).orderBy("tag").collect()
        place = {t: i for i, t in enumerate(sorted({bytes(t) for r in block for t in r["keys"]}))}
        index = _index(docs, place)
        n, total, df = _statistics(index, len(place))
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for f in df.tolist()], np.int64)
        wanted = [(r["tag"], r["id"], [place[bytes(t)] for t in r["keys"]], r["times"]) for r in block]
        found.append(staged(_search(index, wanted, kind, weight, n, total, k), "best"))
    best = found[0]
    for more in found[1:]:
        best = best.union(more)
    # Each item has k rows per task here.
    order = Window.partitionBy("tag").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item", "rank", "id", "score")


def op12_search_nra(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return rank_documents(docs, items).select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
