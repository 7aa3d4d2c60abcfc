"""Slowly changing dimensions.

A versioned dimension has the columns of ``VERSION`` next to its attributes, and at most one
current row per natural key, which is always the one with the highest version number.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import surrogate_key, timestamp
from tierline.operators.dedupe import latest_per_key

VERSION = ("version_number", "effective_start_date", "effective_end_date", "is_current")


def differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True if any pair differs, NULL counting as a value."""
    return reduce(lambda x, y: x | y, [~a.eqNullSafe(b) for a, b in pairs])


def scd1(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Overwrite known keys, add new ones, keep keys the source does not mention."""
    kept = target.join(source.select(key), key, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def first_versions(
    rows: DataFrame, key: str, key_column: str, run_ts: dt.datetime | str, version: Column | int = 1
) -> DataFrame:
    """Attribute rows as open dimension rows with the given version number."""
    number = F.lit(version) if isinstance(version, int) else version
    return rows.withColumns(
        {
            "version_number": number.cast("int"),
            "effective_start_date": timestamp(run_ts),
            "effective_end_date": F.lit(None).cast("timestamp_ntz"),
            "is_current": F.lit(True),
        }
    ).withColumn(key_column, surrogate_key(F.col(key), F.col("version_number")))


ABSENT = "_absent"


def scd2_touched(
    target: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    order_by: Sequence[Column],
) -> DataFrame:
    """Keys to which a step does something: those that changed, and those without a current version (``_absent``).

    Only keys and 256-bit digests of the tracked columns meet, so the wide rows of the target stay where they are.
    """
    digest = F.sha2(F.to_json(F.struct(*tracked), {"ignoreNullFields": "false"}), 256)
    fresh = latest_per_key(source, [key], order_by).select(key, digest.alias("_new"))
    current = target.where("is_current").select(F.col(key).alias("_id"), digest.alias("_old"))
    pairs = fresh.join(current, F.col(key) == F.col("_id"), "left")
    return pairs.where(~F.col("_new").eqNullSafe(F.col("_old"))).select(key, F.col("_id").isNull().alias(ABSENT))


def scd2_changed(
    target: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    order_by: Sequence[Column],
) -> DataFrame:
    """Keys whose latest source row differs from the current version on a tracked column."""
    return scd2_touched(target, source, key, tracked, order_by).where(~F.col(ABSENT)).select(key)


def scd2_close(
    target: DataFrame, changed: DataFrame, key: str, run_ts: dt.datetime | str
) -> DataFrame:
    """End the current version of the changed keys; other rows stay as they are (D3)."""
    marked = target.join(changed.select(key, F.lit(True).alias("_changed")), key, "left")
    closing = F.col("is_current") & F.col("_changed").isNotNull()
    return marked.withColumns(
        {
            "effective_end_date": F.when(closing, timestamp(run_ts)).otherwise(
                F.col("effective_end_date")
            ),
            "is_current": F.col("is_current") & ~closing,
        }
    ).select(*target.columns)


def scd2_insert(
    closed: DataFrame,
    source: DataFrame,
    key: str,
    attributes: Sequence[str],
    order_by: Sequence[Column],
    run_ts: dt.datetime | str,
    key_column: str,
) -> DataFrame:
    """The new open rows: one per source key that has no current version."""
    fresh = latest_per_key(source, [key], order_by).select(key, *attributes)
    last = closed.groupBy(key).agg(F.max("version_number").alias("_last"))
    opened = fresh.join(closed.where("is_current").select(key), key, "left_anti").join(
        last, key, "left"
    )
    version = F.coalesce(F.col("_last"), F.lit(0)) + 1
    return first_versions(opened, key, key_column, run_ts, version).select(*closed.columns)


def scd2(
    target: DataFrame,
    source: DataFrame,
    *,
    key: str,
    tracked: Sequence[str],
    attributes: Sequence[str],
    order_by: Sequence[Column],
    run_ts: dt.datetime | str,
    key_column: str,
) -> DataFrame:
    """The whole step in one pass (D5): detect, close and insert with a single join.

    The target is read once and both sides are shuffled once, on the key. Each pair of last
    version and latest source row yields one or two rows. Keys the source lacks stay open.
    """
    columns = target.columns
    ids = Window.partitionBy(key)
    old = target.withColumn("_last", F.max("version_number").over(ids)).select(
        F.col(key).alias("_old_key"),
        (F.col("version_number") == F.col("_last")).alias("_is_last"),
        F.struct(*columns).alias("old"),
    )
    new = latest_per_key(source, [key], order_by).select(
        F.col(key).alias("_new_key"), F.struct(key, *attributes).alias("new")
    )
    pairs = old.join(new, (F.col("_old_key") == F.col("_new_key")) & F.col("_is_last"), "full")

    def row(values: dict[str, Column], default: str) -> Column:
        return F.struct(
            *[
                values.get(c, F.col(f"{default}.{c}"))
                .cast(target.schema[c].dataType)
                .alias(c)
                for c in columns
            ]
        )

    version = F.coalesce(F.col("old.version_number"), F.lit(0)) + 1
    opened = row(
        {
            key_column: surrogate_key(F.col("_new_key"), version),
            "version_number": version,
            "effective_start_date": timestamp(run_ts),
            "effective_end_date": F.lit(None),
            "is_current": F.lit(True),
        },
        "new",
    )
    kept = row({}, "old")
    closed = row({"effective_end_date": timestamp(run_ts), "is_current": F.lit(False)}, "old")
    changed = differs([(F.col(f"new.{c}"), F.col(f"old.{c}")) for c in tracked])
    rows = (
        F.when(F.col("_new_key").isNull(), F.array(kept))
        .when(F.col("_old_key").isNull(), F.array(opened))
        .when(~F.col("old.is_current"), F.array(kept, opened))
        .when(changed, F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    return pairs.select(F.inline(rows))
