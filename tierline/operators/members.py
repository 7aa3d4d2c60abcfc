"""Late-arriving dimension members."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions import inferred_id, timestamp
from tierline.operators.dedupe import latest_per_key
from tierline.operators.scd import first_versions


def missing_values(facts: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Distinct values of a fact column that a dimension does not hold.

    Distinct comes first, so the anti join sees each value once however often it occurs.
    """
    return facts.select(column).distinct().join(known.select(column), column, "left_anti")


def is_inferred() -> Column:
    """Whether a channel's id was made from its title; a real id may start with the same text."""
    return F.coalesce(F.col("channel_id") == inferred_id(F.col("channel_title")), F.lit(False))


def inferred_channels(
    items: DataFrame, dim: DataFrame, run_ts: dt.datetime | str
) -> DataFrame:
    """A row with default attributes for each group title without a current member.

    Version 1, or one more than the last version where the same title was inferred before.
    """
    titled = items.where(F.col("channel_title").isNotNull() & (F.col("channel_title") != ""))
    missing = missing_values(titled, dim.where("is_current"), "channel_title").withColumns(
        {
            "channel_id": inferred_id(F.col("channel_title")),
            "subscriber_count": F.lit(0).cast("bigint"),
            "country": F.lit("Unknown"),
            "total_videos": F.lit(0),
            "total_views": F.lit(0).cast("bigint"),
        }
    )
    earlier = (
        dim.where(is_inferred())
        .groupBy("channel_id")
        .agg(F.max("version_number").alias("_last"))
    )
    version = F.coalesce(F.col("_last"), F.lit(0)) + 1
    numbered = missing.join(earlier, "channel_id", "left")
    return first_versions(numbered, "channel_id", "dim_channel_key", run_ts, version).select(
        *dim.columns
    )


def inferred_items(
    items: DataFrame, dim: DataFrame, order_by: list, run_ts: dt.datetime | str
) -> DataFrame:
    """Items without a current member, with the attributes of their latest fact row.

    Version 1, or one more than the last version of an item that has only closed ones in ``dim``.
    """
    new = latest_per_key(items, ["video_id"], order_by).join(
        dim.where("is_current").select("video_id"), "video_id", "left_anti"
    )
    earlier = dim.groupBy("video_id").agg(F.max("version_number").alias("_last"))
    version = F.coalesce(F.col("_last"), F.lit(0)) + 1
    numbered = new.join(earlier, "video_id", "left")
    return first_versions(numbered, "video_id", "dim_video_key", run_ts, version).select(*dim.columns)


def inferred_categories(
    items: DataFrame, dim: DataFrame, run_ts: dt.datetime | str
) -> DataFrame:
    """A placeholder title for each unknown category id."""
    missing = missing_values(items, dim, "category_id")
    return missing.select(
        "category_id",
        F.concat(F.lit("Inferred Category "), F.col("category_id").cast("string")).alias(
            "category_title"
        ),
        timestamp(run_ts).alias("load_timestamp"),
    )


def replaced_inferred(dim: DataFrame) -> DataFrame:
    """Ids of current inferred members whose title a real current member now carries.

    Without closing them both would match the same facts and count them twice. Each inferred
    title occurs once on the left and, after ``distinct``, each real one once on the right.
    """
    current = dim.where("is_current")
    inferred = is_inferred()
    real = current.where(~inferred).select("channel_title").distinct()
    return current.where(inferred).join(real, "channel_title", "left_semi").select("channel_id")
