"""Gold marts (M1-M3) and the top-k reports over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import average, pct_change


def channel_performance(fact: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """Totals per group title over all versions of the group (M1).

    The fact shrinks to one row per member key and item before it meets the dimension, so a hot
    group is spread over its items and the whole fact is never shuffled by group.
    """
    per_item = fact.groupBy("dim_channel_key", "video_id").agg(
        F.sum("views").alias("views"),
        F.sum("likes").alias("likes"),
        F.count("likes").alias("n"),
    )
    titles = dim_channel.select("dim_channel_key", "channel_title")
    return (
        per_item.join(titles, "dim_channel_key")
        .groupBy("channel_title")
        .agg(
            F.count_distinct("video_id").alias("total_trending_videos"),
            F.sum("views").alias("total_views"),
            F.sum("likes").alias("total_likes"),
            # The average is per fact row, that is per item and day.
            average(F.sum("likes"), F.sum("n")).alias("avg_likes_per_video"),
        )
    )


def top_category_per_day(fact: DataFrame, dim_category: DataFrame | None = None) -> DataFrame:
    """The category with most views on each day (W1, W2); equal totals go to the first title.

    Categories that share a title count as one. Sums per id come first, so that the join and the
    ranking see one row per day and category.
    """
    sums = fact.groupBy("trending_date", "dim_category_id").agg(F.sum("views").alias("views"))
    return best_categories(sums, dim_category)


def best_categories(sums: DataFrame, dim_category: DataFrame | None = None) -> DataFrame:
    """The first category of each day, from ``views`` by ``trending_date`` and ``dim_category_id``."""
    if dim_category is None:
        titled = sums.withColumn("category_title", F.col("dim_category_id"))
    else:
        titles = dim_category.select(F.col("category_id").alias("dim_category_id"), "category_title")
        titled = (
            sums.join(titles, "dim_category_id")
            .groupBy("trending_date", "category_title")
            .agg(F.sum("views").alias("views"))
        )
    best_first = Window.partitionBy("trending_date").orderBy(F.desc("views"), "category_title")
    return (
        titled.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") == 1)
        .select("trending_date", F.col("category_title").alias("most_trending_category"))
    )


def daily_kpi(fact: DataFrame, dim_category: DataFrame | None = None) -> DataFrame:
    """Daily totals with the top category of the day."""
    daily = fact.groupBy("trending_date").agg(
        F.count_distinct("video_id").alias("total_trending_videos"),
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
    )
    return daily.join(top_category_per_day(fact, dim_category), "trending_date", "left").select(
        "trending_date",
        "total_trending_videos",
        "total_views",
        "total_likes",
        "most_trending_category",
    )


def daily_trends(fact: DataFrame) -> DataFrame:
    """Running total and change against the previous present day.

    The windows have no partition, which is sound here: they follow the daily sums and so see
    one row per calendar day.
    """
    return trends_of_days(fact.groupBy("trending_date").agg(F.sum("views").alias("total_views")))


def trends_of_days(days: DataFrame) -> DataFrame:
    """Trends over one row per day (``trending_date``, ``total_views``)."""
    by_day = Window.orderBy("trending_date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    change = pct_change(F.col("total_views"), F.col("previous_day_views"))
    return days.withColumns(
        {
            "running_total_views": F.sum("total_views").over(so_far),
            "previous_day_views": F.lag("total_views", 1).over(by_day),
        }
    ).withColumn("pct_change_day_over_day", change)


def top_groups(mart: DataFrame, k: int, metric: str = "total_views") -> DataFrame:
    """The k groups with the highest metric (O1)."""
    return mart.orderBy(F.desc(metric), "channel_title").limit(k)


def top_categories(
    fact: DataFrame, dim_category: DataFrame, k: int, metric: str = "likes"
) -> DataFrame:
    """The k category titles with the highest sum of a metric."""
    sums = fact.groupBy("dim_category_id").agg(F.sum(metric).alias("_sum"))
    titles = dim_category.select(F.col("category_id").alias("dim_category_id"), "category_title")
    return (
        sums.join(titles, "dim_category_id")
        .groupBy("category_title")
        .agg(F.sum("_sum").alias(f"total_{metric}"))
        .orderBy(F.desc(f"total_{metric}"), "category_title")
        .limit(k)
    )


def trend_listing(mart: DataFrame, k: int = 10) -> DataFrame:
    """The first k days of the trends mart (O2)."""
    return mart.orderBy("trending_date").limit(k)


def with_load_timestamp(mart: DataFrame, now: Column) -> DataFrame:
    return mart.withColumn("load_timestamp", now)
