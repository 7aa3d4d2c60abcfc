"""Daily snapshot fact: star join and reload by date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import timestamp
from tierline.operators.skew import SALT, salted


def reload_by_key(
    target: DataFrame, new_rows: DataFrame, key_set: DataFrame, key: str
) -> DataFrame:
    """Replace all target rows whose key is in ``key_set`` by ``new_rows``."""
    keys = key_set.select(key).distinct()
    if isinstance(target.schema[key].dataType, T.DateType):
        # Distinct calendar days are few by nature, whatever the size of the tables.
        kept = target.join(F.broadcast(keys), key, "left_anti")
    else:
        spread, keys = salted(target, keys, F.struct(*target.columns))
        kept = spread.join(keys, [key, SALT], "left_anti").drop(SALT)
    return kept.unionByName(new_rows)


def star_join(
    items: DataFrame,
    dim_video: DataFrame,
    dim_category: DataFrame,
    dim_channel: DataFrame,
    run_ts: dt.datetime | str,
) -> DataFrame:
    """Items with the surrogate keys of their current members; the group is matched by title.

    Rows without a member drop out. Only key columns of the dimensions take part, and the small
    category join comes first, so that Spark can broadcast what its size check allows.
    """
    videos = dim_video.where("is_current").select("video_id", "dim_video_key")
    channels = dim_channel.where("is_current").select("channel_title", "dim_channel_key")
    return (
        items.join(dim_category.select("category_id"), "category_id")
        .join(videos, "video_id")
        .join(channels, "channel_title")
        .select(
            "video_id",
            "trending_date",
            "dim_video_key",
            F.col("category_id").alias("dim_category_id"),
            "dim_channel_key",
            "views",
            "likes",
            "dislikes",
            "comment_count",
            timestamp(run_ts).alias("load_timestamp"),
        )
    )
