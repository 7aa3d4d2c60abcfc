"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

The rows of a table are split into partitions (those of its scan). The matrix says how many rows each
partition sends to each shard; it has the law of a uniform permutation of all rows. Then every partition
permutes its rows and deals them out by its row of the matrix, and every shard permutes what it got.

The matrix is drawn with counts only. Each row draws a shard, independently, which gives counts by
partition and shard; shards drawn too often give a random choice of their surplus draws to shards drawn
too rarely. Draws of rows are exchangeable and shard sizes exact, so every assignment with these sizes is
equally likely: the matrix is multivariate hypergeometric.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import fresh, staged, table, without

# Rows of one sort in the second permutation, about.
SORT_ROWS = 20_000
# Hashes are compared on this many bits where a share of them is meant.
BITS = 40


def _hash(row: str, seed: int, salt: int) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(salt), F.col(row))


def _surplus(draws: DataFrame, excess: dict[int, int], totals: dict[int, int]) -> DataFrame:
    """Of each shard drawn too often, as many random draws as it has too many: part, drawn, rank from 0.

    Only draws whose hash is below a threshold are ranked; it is raised until enough are below.
    """
    slack = 1
    while True:
        limit = F.lit(0)
        for s, e in excess.items():
            share = min(1.0, slack * (e + 8 * math.sqrt(e) + 64) / totals[s])
            limit = F.when(F.col("drawn") == s, math.ceil(share * 2**BITS)).otherwise(limit)
        low = draws.where(F.pmod("lot", F.lit(2**BITS)) < limit)
        place = Window.partitionBy("drawn").orderBy(F.pmod("lot", F.lit(2**BITS)), "lot", "row")
        most = F.lit(0)
        for s, e in excess.items():
            most = F.when(F.col("drawn") == s, e).otherwise(most)
        chosen = staged(
            low.select("part", "drawn", (F.row_number().over(place) - 1).alias("rank")).where(
                F.col("rank") < most
            ),
            "surplus",
        )
        if chosen.count() == sum(excess.values()):
            return chosen
        slack *= 4


def _matrix(narrow: DataFrame, rows: int, shards: int, seed: int) -> DataFrame:
    """One row per partition: ``ends``, by shard the number of its rows that go to this or a lower shard."""
    size = [rows // shards + (s < rows % shards) for s in range(shards)]
    draws = narrow.select(
        "part",
        "row",
        F.pmod(_hash("row", seed, 1), F.lit(shards)).cast("int").alias("drawn"),
        _hash("row", seed, 2).alias("lot"),
    )
    cells = staged(draws.groupBy("part", "drawn").count(), "draws")
    totals = {s: 0 for s in range(shards)}
    totals |= {r[0]: r[1] for r in cells.groupBy("drawn").agg(F.sum("count")).collect()}
    excess = {s: totals[s] - size[s] for s in range(shards) if totals[s] > size[s]}
    if excess:
        chosen = _surplus(draws, excess, totals)
        # Place of a surplus draw in the line of all of them; the line fills the gaps in order.
        start, line = 0, F.lit(0)
        for s, e in excess.items():
            line = F.when(F.col("drawn") == s, start).otherwise(line)
            start += e
        line, end, to = line + F.col("rank"), 0, F.lit(0)
        gaps = [(s, size[s] - totals[s]) for s in range(shards) if totals[s] < size[s]]
        for s, g in gaps:
            to = F.when(line >= end, s).otherwise(to)
            end += g
        moved = chosen.select("part", "drawn", to.cast("int").alias("to"))
        cells = cells.union(moved.groupBy("part", "drawn").agg(-F.count("*"))).union(
            moved.groupBy("part", F.col("to")).count()
        )
    cells = cells.groupBy("part", "drawn").agg(F.sum("count").alias("n"))
    so_far = Window.partitionBy("part").orderBy("drawn")
    ends = cells.select("part", F.struct("drawn", F.sum("n").over(so_far).alias("end")).alias("cell"))
    return ends.groupBy("part").agg(F.array_sort(F.collect_list("cell")).alias("ends"))


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """All rows of the frame with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Shard sizes differ by one row at most; lower shards are the larger ones. Values play no part: nulls,
    empty and long texts, ties and repeated rows are rows like any other. An empty frame gives no rows.
    Columns named shard or slot are replaced; all others are kept. The frame is written once to the
    shared scratch folder, so partitions and row numbers are fixed; only row numbers and hashes are
    shuffled, and rows are joined to their places at the end. The draw depends on seed and layout.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    df = without(df, "shard", "slot")
    tag = fresh(df, "row_tag")
    tagged = staged(df.withColumn(tag, F.monotonically_increasing_id()), "tagged")
    # The upper bits of the tag are the number of the partition that wrote the row.
    narrow = tagged.select(F.col(tag).alias("row"), F.shiftright(F.col(tag), 33).alias("part"))
    rows = narrow.count()
    ends = _matrix(narrow, rows, shards, seed)

    in_part = Window.partitionBy("part").orderBy("key", "row")
    placed = narrow.select("part", "row", _hash("row", seed, 3).alias("key")).select(
        "part", "row", F.row_number().over(in_part).alias("place")
    )
    subs = max(1, math.ceil(rows / shards / SORT_ROWS))
    dealt = staged(
        placed.join(ends, "part").select(
            "row",
            F.filter("ends", lambda c: c["end"] >= F.col("place"))[0]["drawn"].alias("shard"),
            _hash("row", seed, 4).alias("key"),
        )
        # Ranges of the upper key bits, in order, so that sorts of the ranges make one sort.
        .withColumn("sub", (F.shiftrightunsigned("key", 32) * subs / 2**32).cast("int")),
        "dealt",
    )
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "sub").count().select(
        "shard", "sub", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    in_sub = Window.partitionBy("shard", "sub").orderBy("key", "row")
    slots = (
        dealt.withColumn("rank", F.row_number().over(in_sub))
        .join(starts, ["shard", "sub"])
        .select(F.col("row").alias(tag), "shard", (F.col("start") + F.col("rank") - 1).alias("slot"))
    )
    return tagged.join(slots, tag).select(*[F.col(f"`{c}`") for c in df.columns], "shard", "slot")


SHARDS = 8


def op3_shard_hypergeometric(spark, sf_dir: str) -> DataFrame:
    """All documents in 8 shards; law ``rows``: counts at most one apart, so grown_shard is null."""
    text = F.coalesce("text", F.lit(""))
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    out = shuffle_into_shards(narrow, SHARDS)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
