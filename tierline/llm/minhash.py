"""Near-duplicate documents by MinHash with tensored banding.

A plain LSH index with L tables of 2k hashes computes 2kL minhashes. Here two collections of m groups of k
hashes are computed, and every pair of a group of one with a group of the other is a table: m * m tables
from 2mk hashes. Two texts of similarity s meet in a table if they agree in a group of each collection,
which has the probability ``(1 - (1 - s**k)**m)**2``: above 0.9999 for s = 0.8, k = 3, m = 16.

Group hashes that only one text has are dropped before tables are formed, so only texts with a
near-duplicate candidate pay for tables. Texts with equal shingle sets are one class from the start. Classes
that meet in tables form families. Within a family every two classes that are not yet connected are
compared exactly, block by block: two blocks of sets make a sparse matrix whose product counts common
shingles. Tasks return only links that connect, so a group of many copies costs no list of all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Columns, components, fresh, map_columns, small_batches, staged, table
from tierline.llm.shingles import WordHashes, mixed, shingle_set

GROUPS = 16
GROUP_HASHES = 3
SEED = 20
# Hashes of one set that are permuted together.
CHUNK = 1024


def _permutations(groups: int, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed)
    n = 2 * groups * width
    top = np.iinfo(np.uint64).max
    return draw.integers(0, top, n, np.uint64), draw.integers(0, top, n, np.uint64) | np.uint64(1)


def minhashes(hashes: np.ndarray, xor: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each permutation."""
    low = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), CHUNK):
        part = (hashes[i : i + CHUNK, None] ^ xor) * odd
        np.minimum(low, part.min(axis=0), out=low)
    return low


def sketches(docs: DataFrame, words: int, groups: int = GROUPS, width: int = GROUP_HASHES) -> DataFrame:
    """id, n_shingles, digest (of the whole set; null for none) and the group hashes a and b.

    ``docs``: id, text. Sets of equal digest (128 bits) are taken as equal.
    """
    xor, odd = _permutations(groups, width, SEED)

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        cache = WordHashes()
        step = np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            out = {"id": batch["id"], "n_shingles": [], "digest": [], "a": [], "b": []}
            for text in batch["text"]:
                found = shingle_set(text, words, cache)
                out["n_shingles"].append(len(found))
                if not len(found):
                    for c in ("digest", "a", "b"):
                        out[c].append(None)
                    continue
                low = minhashes(found, xor, odd).reshape(2 * groups, width)
                h = np.zeros(2 * groups, np.uint64)
                for i in range(width):
                    h = mixed(h * step + low[:, i])
                h = h.view(np.int64)
                out["digest"].append(xxhash.xxh3_128_digest(found.tobytes()))
                out["a"].append(h[:groups])
                out["b"].append(h[groups:])
            yield out

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_shingles bigint, digest binary, a array<bigint>, b array<bigint>"
    return map_columns(docs.select("id", "text"), run, schema)


def buckets(classes: DataFrame) -> DataFrame:
    """Rows (key, digest): the tables' buckets that hold at least two classes. ``classes``: digest, a, b."""
    half = lambda c: classes.select("digest", F.lit(c).alias("side"), F.posexplode(c).alias("i", "h"))
    members = half("a").union(half("b"))
    shared = members.groupBy("side", "i", "h").agg(F.count("*").alias("n")).where("n > 1")
    kept = members.join(staged(shared.drop("n"), "shared"), ["side", "i", "h"])
    of = lambda c: F.collect_list(F.when(F.col("side") == c, F.xxhash64("i", "h")))
    both = staged(kept.groupBy("digest").agg(of("a").alias("a"), of("b").alias("b")), "both")
    return both.withColumn("x", F.explode("a")).select(
        "digest", F.explode(F.transform("b", lambda y: F.xxhash64("x", y))).alias("key")
    )


def families(classes: DataFrame) -> DataFrame:
    """node, root: classes that meet in tables, directly or over others, and look alike.

    In each bucket all classes are paired with two of them, the smallest and the largest digest; these are
    the same classes in most buckets of a group of copies, so there are a few pairs per class. A pair
    stays if it shares at least ALIKE of all group hashes; a pair of similarity 0.8 shares half of them.
    """
    keys = staged(buckets(classes), "keys")
    ends = keys.groupBy("key").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high")
    met = keys.join(staged(ends, "ends"), "key")
    pair = lambda c: met.where(F.col("digest") != F.col(c)).select("digest", F.col(c).alias("end"))
    pairs = staged(pair("low").union(pair("high")).distinct(), "pairs")
    of = lambda c, s: classes.select(F.col("digest").alias(c), F.concat("a", "b").alias(s))
    both = pairs.join(of("digest", "p"), "digest").join(of("end", "q"), "end")
    equal = F.aggregate(F.zip_with("p", "q", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, e: s + e)
    return components(both.where(equal >= ALIKE).select(F.col("digest").alias("a"), F.col("end").alias("b")))


# Sets of up to so many classes are fetched with a broadcast of their ids (some 40 bytes each).
BROADCAST_ROWS = 200_000
# Group hashes of all (2 * GROUPS) that two classes of a family share at least.
ALIKE = 3
# Sets and shingles of a block, about, and columns of the matrix that counts common shingles.
BLOCK_SETS = 128
BLOCK_SHINGLES = 200_000
COLUMNS = 8192


def _sets(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """digest, n, hashes: the shingle set of each class, made again from the text of its first document."""
    ids = classes.select(F.col("id").alias("of"), "digest")
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    # Null ids are one id here.
    texts = docs.join(ids, F.col("id").eqNullSafe(F.col("of"))).select("digest", "text")

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        cache = WordHashes()
        for batch in batches:
            out = {"digest": [], "hashes": []}
            for text, digest in zip(batch["text"], batch["digest"], strict=True):
                found = shingle_set(text, words, cache)
                # Another text with the same id is another class: it is told apart by its digest.
                if xxhash.xxh3_128_digest(found.tobytes()) == digest:
                    out["digest"].append(digest)
                    out["hashes"].append(found.view(np.int64))
            yield out

    return map_columns(texts, run, "digest binary, hashes array<bigint>").dropDuplicates(["digest"])


def _confirmed(sets: list[np.ndarray], sides: list[int], percent: int) -> list[tuple[int, int]]:
    """Links between sets of side 0 and side 1 (sets of side 2 are on both), as many as connect the same sets."""
    sizes = np.array([len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    common = np.zeros((len(sets), len(sets)), np.float64)
    for start in range(0, len(values), COLUMNS):
        a, b = np.searchsorted(at, [start, start + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[a:b], at[a:b] - start] = 1
        common += part @ part.T
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    side = np.array(sides)
    linked &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        p, q = find(i), find(j)
        if p != q:
            root[q] = p
            links.append((i, j))
    return links


def _compare(blocks: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links a, b of the blocks' pairs. ``blocks``: family, block, digest; ``pairs``: family, p, q.

    A task's group holds the sets of two blocks.
    """
    one = pairs.where("p = q").select("family", "p", "q", F.col("p").alias("block"), F.lit(2).alias("side"))
    two = pairs.where("p <> q")
    sides = one.union(two.select("family", "p", "q", "p", F.lit(0))).union(two.select("family", "p", "q", "q", F.lit(1)))
    rows = blocks.join(sides, ["family", "block"]).join(sets, "digest")
    groups = rows.groupBy("family", "p", "q").agg(F.collect_list(F.struct("side", "digest", "hashes")).alias("members"))

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out: Columns = {"a": [], "b": []}
            for members in batch["members"]:
                found = [np.array(m["hashes"], np.int64) for m in members]
                for i, j in _confirmed(found, [m["side"] for m in members], percent):
                    out["a"].append(members[i]["digest"])
                    out["b"].append(members[j]["digest"])
            yield out

    return map_columns(groups.where(F.size("members") > 1).select("members"), run, "a binary, b binary")


def _blocks(members: DataFrame, keys: list[str]) -> DataFrame:
    """The members with ``cut``: a number below the blocks that their group needs, by sets and by shingles."""
    need = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = members.groupBy(*keys).agg(need.alias("cuts"))
    return members.join(sizes, keys).withColumn("cut", F.pmod(F.xxhash64("digest"), F.col("cuts")).cast("int"))


def link_families(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components (node, root) of the classes in ``members`` (family, digest, n), by confirmed links.

    A family is cut into blocks. First all blocks meet one block, which settles small families and links most
    of a large group of copies. Classes of large families that are still in different components then
    meet in all pairs of blocks; blocks within one large component do not meet each other.
    """
    first = staged(_blocks(members, ["family"]), "blocks")
    cuts = first.select("family", "cuts").distinct()
    every = F.sequence(F.lit(0), F.col("cuts") - 1).cast("array<string>")
    pairs = cuts.select("family", F.lit("0").alias("p"), F.explode(every).alias("q"))
    blocks = first.select("family", F.col("cut").cast("string").alias("block"), "digest")
    links = staged(_compare(blocks, pairs, sets, percent), "links")
    large = first.where("cuts > 1").select("family", "digest", "n")
    if large.isEmpty():
        return components(links)
    roots = components(links)
    rooted = large.join(roots, F.col("digest") == F.col("node"), "left").select(
        "family", "digest", "n", F.coalesce("root", "digest").alias("root")
    )
    # Large components have blocks of their own; the others share blocks.
    sizes = rooted.groupBy("family", "root").agg(F.count("*").alias("size"))
    rooted = rooted.join(staged(sizes, "sizes"), ["family", "root"])
    own = F.when(F.col("size") >= BLOCK_SETS, F.hex("root")).otherwise("")
    second = staged(_blocks(rooted.withColumn("own", own), ["family", "own"]), "blocks")
    blocks = second.select("family", F.concat_ws("/", "own", "cut").alias("block"), "digest")
    names = staged(second.select("family", "own", F.concat_ws("/", "own", "cut").alias("p")).distinct(), "names")
    other = names.select("family", F.col("own").alias("other"), F.col("p").alias("q"))
    pairs = names.join(other, "family").where("p <= q AND (own <> other OR own = '')").select("family", "p", "q")
    more = staged(_compare(blocks, pairs, sets, percent), "links")
    return components(links.union(more))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, groups: int = GROUPS, width: int = GROUP_HASHES
) -> DataFrame:
    """One row per row of ``docs`` (id, text): id, n_shingles, component_id, kept.

    Words are split at ASCII white space with A-Z lowered; the set of a text holds its distinct runs of
    ``words`` words. Texts are linked if 100 * intersection >= percent * union; component_id is the
    smallest id reachable by links, nulls only if there is no other. Null and empty texts, and texts of
    white space, have no shingles and no links: their component_id is their id. Equal rows are each
    returned; a row is kept if its id is its component_id (null ids: if all of the component are null).
    """
    small_batches(docs.sparkSession)
    sketched = staged(sketches(docs, words, groups, width), "sketches")
    classes = staged(
        sketched.where("digest IS NOT NULL").groupBy("digest").agg(
            F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("a").alias("a"), F.first("b").alias("b")
        ),
        "classes",
    )
    near = families(classes).select(F.col("root").alias("family"), F.col("node").alias("digest"))
    near = staged(near.join(classes.select("digest", "id", "n"), "digest"), "near")
    sets = staged(_sets(docs, near, words), "sets")
    roots = link_families(near.select("family", "digest", "n"), sets, percent)
    ids = staged(
        classes.select("digest", "id").join(roots, F.col("digest") == F.col("node"), "left")
        .select("digest", "id", F.coalesce("root", "digest").alias("root")),
        "ids",
    )
    first = staged(ids.groupBy("root").agg(F.min("id").alias("component_id")), "first")
    ids = staged(ids.join(first, "root").select("digest", "component_id"), "ids")
    out = sketched.select("id", "n_shingles", "digest").join(ids, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` (doc_id, text and any other columns) for each component.

    It is the one with the smallest doc_id, nulls last. Rows are told apart by a tag and not by their doc_id, which
    other rows may share or lack.
    """
    tag = fresh(docs, "tag")
    tagged = staged(docs.withColumn(tag, F.monotonically_increasing_id()), "tagged")
    found = near_duplicates(tagged.select(F.col(tag).alias("id"), "text"), words, percent)
    found = staged(found.select("id", "component_id"), "found")
    groups = found.groupBy("component_id").count().where("count > 1").select("component_id")
    members = staged(found.join(groups, "component_id"), "members")
    ids = tagged.select(F.col(tag).alias("id"), "doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("id")))
    first = members.join(ids, "id").groupBy("component_id").agg(first["id"].alias("first"))
    gone = members.join(first, "component_id").where("id <> first").select(F.col("id").alias("gone"))
    gone = staged(gone, "gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return tagged.join(gone, tagged[tag] == gone["gone"], "left_anti").select(*[f"`{c}`" for c in docs.columns])


CONTRACT_WORDS = 4


def op9_near_dup_tensored(spark, sf_dir: str) -> DataFrame:
    """All documents with the size of their set of 4-word shingles and their component at 80 %."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return near_duplicates(docs, CONTRACT_WORDS, 80).withColumnRenamed("id", "doc_id")
