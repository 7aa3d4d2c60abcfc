"""Repeated keys: keep-first flags and latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.operators.skew import SALT, salted

FIRST = "_kept_row"


def repeated_keys(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], row_id: str, keep: str = "first"
) -> DataFrame:
    """Keys that occur more than once, with the id of the row to keep.

    An aggregate rather than a window over all rows: copies of a hot key shrink to one
    partial row per input task before the shuffle.
    """
    # The row id closes every order, so the choice is the same on each evaluation.
    order = [c for c in order_by if c != row_id] + [row_id]
    position = F.col(row_id) if len(order) == 1 else F.struct(*order)
    best = F.min(position) if keep == "first" else F.max(position)
    kept = F.col("_best") if len(order) == 1 else F.col(f"_best.{row_id}")
    return (
        df.groupBy(*keys)
        .agg(best.alias("_best"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select(*[F.col(k).alias(f"_key_{k}") for k in keys], kept.alias(FIRST))
    )


def with_earlier(repeated: DataFrame, earlier: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``repeated_keys`` of a load together with its keys that earlier loads hold (``earlier``, each once).

    Their rows are all duplicates, so the row to keep is -1, which no row of this load is.
    """
    known = earlier.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    alone = repeated.join(known, known.columns, "left_anti")
    return alone.unionByName(known.withColumn(FIRST, F.lit(-1).cast(repeated.schema[FIRST].dataType)))


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    row_id: str,
    *,
    keep: str = "first",
    repeated: DataFrame | None = None,
    flag: str = "is_duplicate",
) -> DataFrame:
    """Flag all rows of a key but the first (or last) in ``order_by``; NULL keys equal each other.

    ``row_id`` is unique. Only repeated keys are joined back. ``repeated`` may be a stored result
    of ``repeated_keys``: its file size then lets Spark broadcast it and leave the wide rows where
    they are, or else split hot keys of the join. Without it the join is salted.
    """
    drop = [FIRST, *[f"_key_{k}" for k in keys]]
    left = df
    same = F.lit(True)
    if repeated is None:
        repeated = repeated_keys(df, keys, order_by, row_id, keep)
        left, repeated = salted(df, repeated, F.col(row_id))
        same = left[SALT] == repeated[SALT]
        drop += [left[SALT], repeated[SALT]]
    for k in keys:
        same = same & left[k].eqNullSafe(repeated[f"_key_{k}"])
    joined = left.join(repeated, same, "left")
    later = F.col(FIRST).isNotNull() & (F.col(FIRST) != F.col(row_id))
    return joined.withColumn(flag, later).drop(*drop)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order_by``, which should leave no ties.

    Spark keeps one row per key and input task before the shuffle, so a hot key stays small.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def newest_rows(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """All rows of each key that carry its highest value of ``by``, such as its last load day."""
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(by)))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
