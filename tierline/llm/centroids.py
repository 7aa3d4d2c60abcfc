"""Centroid clustering by Lloyd's rounds whose work is divided by dimension.

Vectors are packed once into tiles: one row holds a block of columns of a few thousand vectors, as a matrix. A
round joins each tile with its block's slice of the centroids and computes exact partial squared distances. The
partial matrices of a bucket of vectors are added over the blocks (``reduceByKey``), which gives the
nearest centroid of each vector. Assignments go back to the tiles of every block, and each block sums its own
columns by cluster and updates its own slice. No task holds whole vectors or all centroids, and nothing is
collected but the ``k`` first centroids.

Tiles keep their place: they are dealt by (block, bucket) once and kept on disk, so that a round moves partial
distances, assignments and sums, not vectors. Slices are written after each round, which cuts the lineage;
lost tiles are made again from the written ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from tierline.llm.common import small_batches, staged, table

CLUSTERS = 8
ROUNDS = 10
# Components become floor(SCALE * x).
SCALE = 1024
# Columns of a block, and the most vectors and matrix entries of a tile.
WIDTH = 16
TILE_ROWS = 4096
TILE_ENTRIES = 1 << 19

_TILE = "block int, bucket bigint, n int, cells binary"


def _usable(vector: Column, dims: int) -> Column:
    """Whether a vector has exactly ``dims`` components, none null or non-finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def _largest(dims: int) -> int:
    """The largest scaled component for which squared distances fit in 64 bits."""
    return isqrt((2**63 - 1) // dims) // 2


def _matrix(cells: bytes, n: int) -> np.ndarray:
    return np.frombuffer(cells, np.int64).reshape(n, -1)


def _pack(rows: DataFrame, dims: int, k: int) -> DataFrame:
    """Tiles of ``rows`` (id, vector): block, bucket, n, cells, and ids in the tiles of block 0."""
    kind = rows.schema["id"].dataType
    size = max(1, min(TILE_ROWS, TILE_ENTRIES // max(k, WIDTH)))
    most = _largest(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = TaskContext.get().partitionId() << 32
        ids: list = []
        parts: list[np.ndarray] = []

        def tiles(count: int) -> pa.RecordBatch:
            nonlocal bucket
            whole = np.concatenate(parts)
            now, later, own = whole[:count], whole[count:], ids[:count]
            parts[:], ids[:] = [later], ids[count:]
            starts = range(0, dims, WIDTH)
            cells = [np.ascontiguousarray(now[:, s : s + WIDTH]).tobytes() for s in starts]
            made = {
                "block": range(len(starts)),
                "bucket": [bucket] * len(starts),
                "n": [len(now)] * len(starts),
                "cells": cells,
                "ids": [own] + [None] * (len(starts) - 1),
            }
            bucket += 1
            return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            scaled = np.floor(x * SCALE)
            if np.abs(scaled).max() > most:
                raise ValueError(f"a component times {SCALE} is beyond {most}: distances do not fit in 64 bits")
            parts.append(scaled.astype(np.int64))
            ids += batch.column("id").to_pylist()
            while len(ids) >= size:
                yield tiles(size)
        if ids:
            yield tiles(len(ids))

    out = T.StructType.fromDDL(f"{_TILE}, ids array<{kind.simpleString()}>")
    arrow = to_arrow_schema(out)
    clean = rows.where(_usable(F.col("vector"), dims)).select("id", F.col("vector").cast("array<double>").alias("vector"))
    return staged(clean.mapInArrow(run, out), "tiles")


def _first_slices(rows: DataFrame, dims: int, k: int, prefix: str) -> list[tuple[int, bytes]]:
    """(block, cells) of the ``k`` vectors with the smallest hashes; fewer if there are fewer vectors."""
    hashed = F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")).cast("binary"), 256)
    vector = F.col("vector").cast("array<double>")
    usable = rows.where(_usable(F.col("vector"), dims)).select(hashed.alias("hash"), vector.alias("vector"))
    chosen = [r["vector"] for r in usable.orderBy(F.asc_nulls_last("hash"), "vector").limit(k).collect()]
    cells = np.floor(np.array(chosen, np.float64).reshape(len(chosen), dims) * SCALE).astype(np.int64)
    blocks = enumerate(range(0, dims, WIDTH)) if chosen else ()
    return [(b, np.ascontiguousarray(cells[:, s : s + WIDTH]).tobytes()) for b, s in blocks]


def _partial(tile: tuple, k: int) -> tuple[int, np.ndarray]:
    """A tile's bucket, and squared distances over its columns to the slices of all centroids."""
    x, c = _matrix(tile["cells"], tile["n"]), _matrix(tile["slice"], k)
    d = np.empty((len(x), k), np.int64)
    for i in range(k):
        move = x - c[i]
        d[:, i] = np.einsum("ij,ij->i", move, move)
    return tile["bucket"], d


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a += b
    return a


def _nearest(d: np.ndarray) -> tuple[bytes, bytes]:
    """Nearest centroids, the smaller number of equally near ones, and their distances."""
    at = d.argmin(axis=1)
    return at.astype(np.int32).tobytes(), d[np.arange(len(d)), at].tobytes()


def _assign(tiles: DataFrame, slices: DataFrame, k: int) -> DataFrame:
    """bucket, clusters and distances of all vectors, packed as the tiles are."""
    pairs: RDD = tiles.join(slices, "block").select("bucket", "n", "cells", "slice").rdd
    sums = pairs.map(lambda t: _partial(t, k)).reduceByKey(_added)
    packed = sums.map(lambda s: (s[0], *map(bytearray, _nearest(s[1]))))
    return tiles.sparkSession.createDataFrame(packed, "bucket bigint, clusters binary, distances binary")


def _updated(tiles: DataFrame, slices: DataFrame, found: DataFrame, k: int, blocks: int) -> DataFrame:
    """The slices after a round: floors of the means, or the old values where a cluster is empty."""

    def sums(rows: Iterator) -> Iterator[tuple]:
        total: dict[int, np.ndarray] = {}
        for t in rows:
            x, at = _matrix(t["cells"], t["n"]), np.frombuffer(t["clusters"], np.int32)
            part = np.zeros((k, x.shape[1] + 1), np.int64)
            np.add.at(part[:, :-1], at, x)
            part[:, -1] = np.bincount(at, minlength=k)
            total[t["block"]] = total[t["block"]] + part if t["block"] in total else part
        yield from total.items()

    def moved(pair: tuple) -> tuple:
        block, (old, total) = pair
        old, count = _matrix(old, k), total[:, -1:]
        return block, bytearray(np.where(count > 0, total[:, :-1] // np.maximum(count, 1), old).tobytes())

    everywhere = found.select("bucket", "clusters", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    pairs = tiles.join(everywhere, ["block", "bucket"]).select("block", "n", "cells", "clusters")
    totals = pairs.rdd.mapPartitions(sums).reduceByKey(_added)
    new = slices.rdd.map(lambda s: (s["block"], s["slice"])).join(totals).map(moved)
    return staged(tiles.sparkSession.createDataFrame(new, slices.schema), "slices")


def cluster_vectors(rows: DataFrame, dims: int, k: int = CLUSTERS, rounds: int = ROUNDS, prefix: str = "3:") -> DataFrame:
    """One row per usable row of ``rows`` (id, vector): id, cluster, distance, cluster_inertia, inertia, centroid.

    Usable vectors have ``dims`` components, none null or non-finite; others are left out. Components are turned
    into ``floor(1024 * x)`` and everything after is exact in 64-bit integers: a component too large for that
    stops the run with an error. The first centroids are the ``k`` vectors with the smallest SHA-256 of
    ``prefix`` and id; rows with a null id come last, those with equal ids go by their components. With fewer
    vectors there are fewer centroids, without any the result is empty. Equally near centroids go to the smaller
    number; equal rows are each returned. Clusters that run empty keep their centroid. ``distance`` is squared.
    """
    spark = rows.sparkSession
    small_batches(spark)
    kind = rows.schema["id"].dataType.simpleString()
    packed = _pack(rows, dims, k)
    first = _first_slices(rows, dims, k, prefix)
    if not first:
        return spark.createDataFrame(
            [], f"id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
        )
    k = len(first[0][1]) // 8 // min(WIDTH, dims)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = packed.select("block", "bucket", "n", "cells").repartition(parts, "block", "bucket")
    tiles.persist(StorageLevel.DISK_ONLY)
    slices = staged(spark.createDataFrame([(b, bytearray(c)) for b, c in first], "block int, slice binary"), "slices")
    for _ in range(rounds):
        slices = _updated(tiles, slices, _assign(tiles, slices, k), k, len(first))
    found = _assign(tiles, slices, k)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, at, d in zip(*(batch.column(c) for c in ("ids", "clusters", "distances")), strict=True):
                columns = [ids.values, np.frombuffer(at.as_py(), np.int32), np.frombuffer(d.as_py(), np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "cluster", "distance"])

    members = packed.where("ids IS NOT NULL").select("bucket", "ids").join(found, "bucket")
    assigned = staged(members.mapInArrow(unpack, f"id {kind}, cluster int, distance bigint"), "clusters")
    tiles.unpersist()
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # The window sees at most k rows.
    sums = sums.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))
    about = staged(sums.join(_centroids(slices, k), "cluster"), "centroids")
    return assigned.join(about, "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def _centroids(slices: DataFrame, k: int) -> DataFrame:
    """cluster, centroid: the slices put together, one row per cluster."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, cells in zip(batch.column("block").to_pylist(), batch.column("slice").to_pylist(), strict=True):
                made = [[block] * k, range(k), _matrix(cells, k).tolist()]
                types = (pa.int32(), pa.int32(), pa.list_(pa.int64()))
                arrays = [pa.array(m, t) for m, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "cluster", "part"])

    cut = slices.mapInArrow(values, "block int, cluster int, part array<bigint>")
    whole = F.sort_array(F.collect_list(F.struct("block", "part")))
    return cut.groupBy("cluster").agg(F.flatten(F.transform(whole, lambda s: s["part"])).alias("centroid"))


def op11_dimension_sharded_lloyd(spark, sf_dir: str) -> DataFrame:
    """Eight clusters of all 64-dimensional embeddings after ten rounds."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    found = cluster_vectors(rows, dims=64)
    return found.withColumn("centroid_sha256", digest).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
