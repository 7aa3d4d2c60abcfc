"""Marts from states of single dates (M1-M3, A2): a run computes the dates it reloads and merges the rest.

A date's state does not depend on other dates. Sums merge by adding. Distinct items of a channel over all dates
merge exactly as bitmaps, for which items have dense numbers: each bucket of ``gold.item_numbers`` counts its own
items, and its numbers are those that leave the bucket's number as the rest of a division. Bitmaps of a date and
channel are as many as the blocks of numbers that its items touch.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import average
from tierline.plans.marts import best_categories, trends_of_days
from tierline.sinks.warehouse import BUCKET, Warehouse

FACT = "gold.fact_video_metrics"
NUMBERS = "gold.item_numbers"
STATES = ("gold.day_totals", "gold.day_categories", "gold.day_channels")
# A sketch of 2**12 registers has a relative standard error of 1.04 / 2**6.
SKETCH_BITS = 12


def sketch_error(deviations: float = 3.0, bits: int = SKETCH_BITS) -> float:
    """Relative error that a sketch's estimate exceeds by chance only beyond so many standard deviations."""
    return deviations * 1.04 / 2 ** (bits / 2)


def number_items(wh: Warehouse, items: DataFrame) -> int:
    """Give numbers to items (``video_id``) that have none yet; returns how many are new.

    Numbers of a bucket follow each other, and only buckets with new items are read for their highest one.
    """
    new = items.select("video_id").where("video_id IS NOT NULL").distinct()
    new = new.join(wh.read(NUMBERS).select("video_id"), "video_id", "left_anti").withColumn(BUCKET, wh.bucket(NUMBERS))
    last = wh.read(NUMBERS).groupBy(wh.bucket(NUMBERS).alias(BUCKET)).agg(F.max("item_number").alias("_last"))
    buckets = wh.tables[NUMBERS].buckets
    # Before the first item of a bucket, the place is one below 0.
    before = F.coalesce(F.floor(F.col("_last") / buckets), F.lit(-1))
    order = Window.partitionBy(BUCKET).orderBy("video_id")
    number = (before + F.row_number().over(order)) * buckets + F.col(BUCKET)
    return wh.write_more(NUMBERS, new.join(last, BUCKET, "left").select("video_id", number.alias("item_number")))


def day_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("trending_date").agg(
        F.count_distinct("video_id").alias("total_trending_videos"),
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
    )


def day_categories(fact: DataFrame) -> DataFrame:
    return fact.groupBy("trending_date", "dim_category_id").agg(F.sum("views").alias("views"))


def day_channels(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """Sums and the items' bitmap of each date, channel and block of item numbers.

    A hot channel's rows meet in one partial row per task and block.
    """
    numbered = fact.join(numbers, "video_id")
    return numbered.groupBy(
        "trending_date", "dim_channel_key", F.bitmap_bucket_number("item_number").alias("item_block")
    ).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("item_number")).alias("items"),
        F.sum("views").alias("views"),
        F.sum("likes").alias("likes"),
        F.count("likes").alias("n"),
    )


def refresh(wh: Warehouse, dates: Collection[str]) -> list[str]:
    """Compute the states of ``dates``, and of all dates that have facts but no state yet; returns these dates."""
    have = {v["trending_date"] for v in wh.partitions(FACT)}
    known = set.intersection(*[{v["trending_date"] for v in wh.partitions(s)} for s in STATES])
    due = sorted({*dates} | (have - known) | (known - have))
    if due:
        fact = wh.read(FACT, {"trending_date": due})
        number_items(wh, fact)
        wh.write_dates(STATES[0], day_totals(fact), due)
        wh.write_dates(STATES[1], day_categories(fact), due)
        wh.write_dates(STATES[2], day_channels(fact, wh.read(NUMBERS)), due)
    return due


def channel_performance(states: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """The channel mart (M1) from ``gold.day_channels``: bitmaps are joined over dates and versions of a channel."""
    per_key = states.groupBy("dim_channel_key", "item_block").agg(
        F.bitmap_or_agg("items").alias("items"),
        *[F.sum(c).alias(c) for c in ("views", "likes", "n")],
    )
    titles = dim_channel.select("dim_channel_key", "channel_title")
    per_block = per_key.join(titles, "dim_channel_key").groupBy("channel_title", "item_block").agg(
        F.bitmap_count(F.bitmap_or_agg("items")).alias("items"),
        *[F.sum(c).alias(c) for c in ("views", "likes", "n")],
    )
    return per_block.groupBy("channel_title").agg(
        F.sum("items").alias("total_trending_videos"),
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
        average(F.sum("likes"), F.sum("n")).alias("avg_likes_per_video"),
    )


def daily_kpi(totals: DataFrame, categories: DataFrame, dim_category: DataFrame | None = None) -> DataFrame:
    """The daily mart (M2) from ``gold.day_totals`` and ``gold.day_categories``."""
    return totals.join(best_categories(categories, dim_category), "trending_date", "left").select(
        "trending_date", "total_trending_videos", "total_views", "total_likes", "most_trending_category"
    )


def daily_trends(totals: DataFrame) -> DataFrame:
    """The trends mart (M3) from ``gold.day_totals``, which has a row per day."""
    return trends_of_days(totals.select("trending_date", "total_views"))


def item_sketches(fact: DataFrame, by: Sequence[str], bits: int = SKETCH_BITS) -> DataFrame:
    """HyperLogLog sketches of the items of each group (A2, approximate): a few kilobytes however many items."""
    return fact.groupBy(*by).agg(F.hll_sketch_agg("video_id", bits).alias("items"))


def approximate_items(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Estimated distinct items per group from stored sketches of finer groups, such as single dates."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("items")).alias("approx_items"))
