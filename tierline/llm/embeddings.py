"""Embedding near-duplicates by NN-descent.

Every vector keeps a list of its nearest known neighbours. A round compares the neighbours of each vector
with each other and keeps the nearest of both; only lists with new entries bring comparisons. A list whose
members all reach the threshold is saturated: it may hide further links, so it is enlarged. First lists
come from sorted signatures (signs of random projections), where near vectors often lie side by side.

Vectors with equal labels and directions equal in all bits are one class and compared once. Lists that were
saturated once belong to a dense group. The components of dense groups are compared block
by block as matrix products that return counts and one link per vector and block, not pairs, so a group
of many copies costs no list of all its pairs.

Recall is audited: a sample is compared with all vectors, exactly, and rounds go on until the graph holds the
wanted share of the sample's links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import Columns, components, map_columns, small_batches, staged, table

THRESHOLD = 0.98
# Neighbours of a list, and its size after a saturated list was doubled a few times.
LIST = 8
LARGEST = 32
# Sorted signatures for the first lists: how many, of how many bits, and neighbours taken on each side.
SIGNATURES = 8
BITS = 30
NEXT = 4
ROUNDS = 8
# Vectors in the audit's sample, and the share of their links that must be found.
AUDIT = 256
RECALL = 0.99
BLOCK = 512
SEED = 6


def unit(vector: list | None) -> np.ndarray | None:
    """The vector in double precision at length 1; None if it is null, empty, zero or not finite."""
    if not vector or None in vector:
        return None
    v = np.asarray(vector, np.float64)
    if not np.isfinite(v).all():
        return None
    # Scaled first, so that squares neither overflow nor vanish; adding 0 turns -0 into 0.
    top = np.abs(v).max()
    if top == 0:
        return None
    v = v / top
    return v / np.sqrt((v * v).sum()) + 0.0


def _digests(rows: DataFrame) -> DataFrame:
    """id, label, digest of the usable vectors' directions (null for others), vector."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            units = [unit(v) for v in batch["vector"]]
            digests = [None if u is None else xxhash.xxh3_128_digest(u.tobytes()) for u in units]
            yield {"id": batch["id"], "label": batch["label"], "digest": digests, "vector": batch["vector"]}

    kind = {f: rows.schema[f].dataType.simpleString() for f in ("id", "label", "vector")}
    schema = f"id {kind['id']}, label {kind['label']}, digest binary, vector {kind['vector']}"
    return map_columns(rows.select("id", "label", "vector"), run, schema)


def _first_edges(nodes: DataFrame, dims: int) -> DataFrame:
    """x, y, cosine of vectors that stand side by side in the order of a signature, within a label."""
    axes = np.random.default_rng(SEED).standard_normal((SIGNATURES * BITS, max(1, dims)))
    weights = 1 << np.arange(BITS, dtype=np.int64)

    def sign(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            signatures = []
            for vector in batch["vector"]:
                v = np.asarray(vector, np.float64)[:dims]
                bits = (axes[:, : len(v)] @ v > 0).reshape(SIGNATURES, BITS)
                signatures.append(bits @ weights)
            yield {c: batch[c] for c in ("node", "label", "vector")} | {"signatures": signatures}

    kind = {f: nodes.schema[f].dataType.simpleString() for f in ("label", "vector")}
    signed = map_columns(
        nodes.select("node", "label", "vector"), sign,
        f"node bigint, label {kind['label']}, vector {kind['vector']}, signatures array<bigint>",
    ).select("node", "label", "vector", F.posexplode("signatures").alias("turn", "signature"))

    def link(batches: Iterator[Columns]) -> Iterator[Columns]:
        recent: list[tuple] = []
        for batch in batches:
            out: Columns = {"x": [], "y": [], "cosine": []}
            for node, label, turn, vector in zip(*(batch[c] for c in ("node", "label", "turn", "vector")), strict=True):
                u = unit(vector)
                for other, key, v in recent:
                    if key == (label, turn, len(u)) and other != node:
                        out["x"].append(min(node, other))
                        out["y"].append(max(node, other))
                        out["cosine"].append(float(u @ v))
                recent.append((node, (label, turn, len(u)), u))
                del recent[:-NEXT]
            yield out

    # Ranges of the order are tasks; ends of ranges are compared within their range only.
    keys = ("turn", "label", "signature", "node")
    ordered = signed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    found = map_columns(ordered.select("node", "label", "turn", "vector"), link, "x bigint, y bigint, cosine double")
    return found.groupBy("x", "y").agg(F.max("cosine").alias("cosine"))


def _lists(edges: DataFrame, limits: DataFrame) -> DataFrame:
    """node, other, cosine, fresh, limit: the nearest of each node, as many as its limit says."""
    cut = Window.partitionBy("node").orderBy(F.desc("cosine"), "other")
    both = edges.select(F.col("x").alias("node"), F.col("y").alias("other"), "cosine", "fresh").union(
        edges.select("y", "x", "cosine", "fresh")
    )
    near = both.withColumn("rank", F.row_number().over(cut)).where(F.col("rank") <= LARGEST)
    limit = F.coalesce("limit", F.lit(LIST))
    return near.join(limits, "node", "left").where(F.col("rank") <= limit).select(
        "node", "other", "cosine", "fresh", limit.alias("limit")
    )


def _round(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """x, y, cosine: pairs of neighbours of one node that one of them would take into its list.

    Full lists of links take nearer links only, so a dense group does not list all its pairs.
    """
    worst = lists.groupBy("node").agg(
        F.when(F.count("*") >= F.max("limit"), F.min("cosine")).otherwise(-2.0).alias("worst"),
    )
    known = nodes.join(worst, "node", "left").select(
        F.col("node").alias("other"), "vector", F.coalesce("worst", F.lit(-2.0)).alias("worst")
    )
    active = lists.groupBy("node").agg(F.max("fresh").alias("any")).where("any").select("node")
    member = F.struct("other", "worst", "fresh", "vector")
    groups = lists.join(active, "node").join(known, "other").groupBy("node").agg(F.collect_list(member).alias("members"))

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out: Columns = {"x": [], "y": [], "cosine": []}
            for members in batch["members"]:
                members.sort(key=lambda m: m["other"])
                near = np.stack([unit(m["vector"]) for m in members])
                cosines = near @ near.T
                worst = np.array([m["worst"] for m in members])
                fresh = np.array([m["fresh"] for m in members])
                wanted = (cosines > worst[:, None]) | (cosines > worst[None, :])
                wanted &= fresh[:, None] | fresh[None, :]
                for i, j in zip(*np.nonzero(np.triu(wanted, 1)), strict=True):
                    out["x"].append(members[i]["other"])
                    out["y"].append(members[j]["other"])
                    out["cosine"].append(float(cosines[i, j]))
            yield out

    found = map_columns(groups.select("members"), run, "x bigint, y bigint, cosine double")
    return found.groupBy("x", "y").agg(F.max("cosine").alias("cosine"))


def _recall(nodes: DataFrame, edges: DataFrame, threshold: float) -> float:
    """Share of the links of a sample of vectors, found by comparing them with all, that ``edges`` hold."""
    chosen = nodes.orderBy(F.xxhash64("node", F.lit(SEED))).limit(AUDIT).select("node", "label", "vector").collect()
    tables: dict[tuple, tuple[list, list]] = {}
    for r in chosen:
        ids, rows = tables.setdefault((r["label"], len(r["vector"])), ([], []))
        ids.append(r["node"])
        rows.append(unit(r["vector"]))
    shared = nodes.sparkSession.sparkContext.broadcast({k: (i, np.array(v)) for k, (i, v) in tables.items()})

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out: Columns = {"x": [], "y": []}
            for node, label, vector in zip(batch["node"], batch["label"], batch["vector"], strict=True):
                if (label, len(vector)) in shared.value:
                    ids, rows = shared.value[label, len(vector)]
                    for i in np.flatnonzero(rows @ unit(vector) >= threshold):
                        if ids[i] != node:
                            out["x"].append(min(node, ids[i]))
                            out["y"].append(max(node, ids[i]))
            yield out

    true = map_columns(nodes.select("node", "label", "vector"), run, "x bigint, y bigint").distinct()
    held = edges.where(F.col("cosine") >= threshold).select("x", "y", F.lit(1).alias("held"))
    total, found = true.join(held, ["x", "y"], "left").agg(F.count("*"), F.count("held")).first()
    return found / total if total else 1.0


def nn_descent(nodes: DataFrame, dims: int, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Edges (x, y, cosine) of the graph that reach the threshold, and the nodes whose lists were ever saturated.

    ``nodes``: node (a unique number), label, vector. Vectors of other labels or lengths are not compared.
    """
    spark = nodes.sparkSession
    edges = staged(_first_edges(nodes, dims).withColumn("fresh", F.lit(True)), "graph")
    limits = spark.createDataFrame([], "node bigint, limit int")
    for turn in range(ROUNDS):
        lists = staged(_lists(edges, limits), "lists")
        own = lists.groupBy("node").agg(
            F.max("limit").alias("limit"), F.count("*").alias("n"), F.min("cosine").alias("low")
        )
        saturated = (F.col("n") >= F.col("limit")) & (F.col("low") >= threshold)
        wider = F.least(F.col("limit") * 2, F.lit(LARGEST)).cast("int")
        limits = staged(own.select("node", F.when(saturated, wider).otherwise(F.col("limit")).alias("limit")), "limits")
        found = _round(lists, nodes)
        old = edges.select("x", "y", F.lit(True).alias("known"))
        new = found.join(old, ["x", "y"], "left_anti").withColumn("fresh", F.lit(True))
        # Entries of lists and links stay; the rest has been compared and is let go.
        listed = lists.select(F.least("node", "other").alias("x"), F.greatest("node", "other").alias("y"), "cosine")
        kept = listed.union(edges.where(F.col("cosine") >= threshold).select("x", "y", "cosine")).distinct()
        edges = staged(kept.withColumn("fresh", F.lit(False)).unionByName(new), "graph")
        quiet = edges.where("fresh").isEmpty()
        if quiet or (turn and _recall(nodes, edges, threshold) >= RECALL):
            break
    full = _lists(edges, limits).groupBy("node").agg(F.max("limit").alias("limit"), F.count("*").alias("n"), F.min("cosine").alias("low"))
    # Links that a full list let go are not compared again, so a list that was full of links once counts too.
    full = full.where((F.col("limit") > LIST) | ((F.col("n") >= F.col("limit")) & (F.col("low") >= threshold)))
    return edges.where(F.col("cosine") >= threshold).select("x", "y", "cosine"), staged(full.select("node"), "full")


def _dense_links(nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """x, links, y: per vector and block the number of linked vectors (classes by their size), and one of them.

    ``groups``: node, root. A group is cut into blocks by hash; each pair of blocks is a task's group of
    about twice BLOCK vectors.
    """
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cut = staged(
        nodes.join(groups.join(sizes, "root"), "node").select(
            "node", "root", "vector", "size", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
        ),
        "dense",
    )
    each = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sides = each.select("root", F.col("block").alias("p"), F.col("other").alias("q"), F.lit(0).alias("side"), "node", "size", "vector").union(
        each.select("root", F.col("other"), F.col("block"), F.lit(1), "node", "size", "vector")
    )
    member = F.struct("side", "node", "size", "vector")
    pairs = sides.groupBy("root", "p", "q").agg(F.collect_list(member).alias("members"))

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out: Columns = {"x": [], "links": [], "y": []}
            for members in batch["members"]:
                a, b = ([m for m in members if m["side"] == side] for side in (0, 1))
                if not a or not b:
                    continue
                x, y = (np.array([m["node"] for m in side]) for side in (a, b))
                near = np.stack([unit(m["vector"]) for m in a]) @ np.stack([unit(m["vector"]) for m in b]).T >= threshold
                near &= x[:, None] != y[None, :]
                some = near.any(axis=1)
                out["x"] += x[some].tolist()
                out["links"] += (near @ np.array([m["size"] for m in b]))[some].tolist()
                out["y"] += y[near.argmax(axis=1)][some].tolist()
            yield out

    return map_columns(pairs.select("members"), run, "x bigint, links bigint, y bigint")


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``rows`` (id, label, vector): id, n_links, component_id, kept.

    Vectors are linked if their labels are equal and not null and their cosine, in double precision, is at
    least the threshold. Vectors that are null, empty or zero, or hold nulls or values that are not
    finite, have no links, nor do vectors of different lengths with each other. Equal rows are rows
    like others: each counts as a link of the other. component_id is the smallest id reachable by
    links; an unlinked row has its own. A row is kept if its id is its component_id.
    """
    small_batches(rows.sparkSession)
    marked = staged(_digests(rows), "digests")
    usable = marked.where("label IS NOT NULL AND digest IS NOT NULL")
    classes = usable.groupBy("label", "digest").agg(
        F.first("vector").alias("vector"), F.count("*").alias("size"), F.min("id").alias("first")
    )
    nodes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    dims = nodes.agg(F.max(F.size("vector"))).first()[0] or 1
    edges, full = nn_descent(nodes.select("node", "label", "vector"), dims, threshold)
    edges = staged(edges, "edges")
    pairs = edges.select(F.col("x").alias("a"), F.col("y").alias("b"))
    roots = components(pairs)
    dense = staged(roots.join(full, "node").select("root").distinct(), "groups")
    groups = roots.join(dense, "root").select("node", "root")
    blocks = staged(_dense_links(nodes, groups, threshold), "blocks")
    roots = components(pairs.union(blocks.select("x", "y")))

    size = nodes.select(F.col("node").alias("other"), "size")
    both = edges.select(F.col("x").alias("node"), F.col("y").alias("other")).union(edges.select("y", "x"))
    counted = both.join(groups.select("node"), "node", "left_anti").join(size, "other").groupBy("node").agg(F.sum("size").alias("links"))
    counted = counted.union(blocks.groupBy("x").agg(F.sum("links")))
    whole = nodes.select("label", "digest", "node", "size", "first").join(counted, "node", "left").join(roots, "node", "left")
    whole = staged(whole.withColumn("root", F.coalesce("root", "node")), "whole")
    lowest = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    answer = staged(
        whole.join(lowest, "root").select(
            "label", "digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"
        ),
        "answer",
    )
    out = marked.select("id", "label", "digest").join(answer, ["label", "digest"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id"))
    )


def op6_near_vectors_nn_descent(spark, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.98."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vector"))
    return near_vectors(rows).withColumnRenamed("id", "vec_id")
