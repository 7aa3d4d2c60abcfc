"""Daily series and the three analyses over them, for all entities at once.

A series has one row per entity and day, so a window over an entity holds at most as many rows
as there are days, however many fact rows the entity has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import contains_ignoring_case

# Metrics a series can be built on, and limits of the analyses.
METRICS = ("views", "likes")
FORECAST_DAYS = 30
FORECAST_MIN_POINTS = 5
CONFIDENCE = 1.96
ANOMALY_Z = 2.0
DECLINE_MIN_POINTS = 3
STEEP_DECLINE = 0.05

INSUFFICIENT = "insufficient"


def daily_series(
    fact: DataFrame,
    metric: str,
    dim_channel: DataFrame | None = None,
    *,
    by: str | None = None,
    pattern: str | None = None,
    wildcards: bool = False,
) -> DataFrame:
    """Sum of a metric per day (X1): overall, per value of ``by``, or over all groups whose title
    contains ``pattern`` taken together."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, found {metric!r}")
    keys = ["trending_date"] if by is None else [by, "trending_date"]
    if dim_channel is not None:
        titles = dim_channel.select("dim_channel_key", "channel_title")
        if pattern is not None:
            titles = titles.where(
                contains_ignoring_case(F.col("channel_title"), pattern, wildcards)
            )
        # One row per member and day reaches the join, not one per fact row.
        fact = (
            fact.groupBy("dim_channel_key", "trending_date")
            .agg(F.sum(metric).alias(metric))
            .join(titles, "dim_channel_key")
        )
    elif pattern is not None:
        raise ValueError("a pattern needs the channel dimension")
    return fact.groupBy(*keys).agg(F.sum(metric).alias("val"))


def _ordered(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """The series with the ordinal of each day in its entity."""
    days = Window.partitionBy(*by).orderBy("trending_date")
    return series.withColumn("ordinal", F.row_number().over(days) - 1)


def _status(min_points: int) -> Column:
    return F.when(F.col("n") >= min_points, "ok").otherwise(INSUFFICIENT)


def _fitted(series: DataFrame, by: Sequence[str], min_points: int) -> DataFrame:
    """Row ordinal, and least squares of the value on it, per entity."""
    entity = Window.partitionBy(*by)
    y = F.col("val").cast("double")
    return _ordered(series, by).withColumns(
        {
            "n": F.count("val").over(entity),
            "slope": F.regr_slope(y, F.col("ordinal")).over(entity),
            "intercept": F.regr_intercept(y, F.col("ordinal")).over(entity),
            "mean": F.avg(y).over(entity),
        }
    ).withColumn("status", _status(min_points))


def forecast(
    series: DataFrame,
    by: Sequence[str] = (),
    *,
    horizon: int = FORECAST_DAYS,
    index_offset: int = 1,
) -> DataFrame:
    """Linear projection with a 95 % band per entity.

    The first future day has ordinal n + 1 by default although the fit used 0 to n - 1, and gaps
    between dates do not count. An entity with fewer than 5 points gives one row whose status is
    ``insufficient``. The entity columns are shuffled once; fit and residuals share that layout.
    """
    residual = F.col("val") - (F.col("slope") * F.col("ordinal") + F.col("intercept"))
    models = (
        _fitted(series, by, FORECAST_MIN_POINTS)
        .withColumn("residual", residual)
        .groupBy(*by)
        .agg(
            F.first("status").alias("status"),
            F.first("n").alias("n"),
            F.first("slope").alias("slope"),
            F.first("intercept").alias("intercept"),
            F.first("mean").alias("mean"),
            F.stddev_pop("residual").alias("spread"),
            F.max("trending_date").alias("last_date"),
        )
        .withColumn("status", F.coalesce("status", F.lit(INSUFFICIENT)))
    )
    enough = F.col("status") == "ok"
    days = F.when(enough, F.sequence(F.lit(1), F.lit(horizon))).otherwise(F.array(F.lit(0)))
    zero = F.lit(0.0)
    raw = F.col("slope") * (F.col("n") + (index_offset - 1) + F.col("i")) + F.col("intercept")
    return (
        models.withColumn("i", F.explode(days))
        .withColumn("predicted", F.when(enough, F.greatest(zero, raw)))
        .select(
            *by,
            "status",
            F.when(enough, F.date_add("last_date", F.col("i"))).alias("forecast_date"),
            F.round("predicted", 2).alias("predicted"),
            F.round(
                F.when(enough, F.greatest(zero, F.col("predicted") - CONFIDENCE * F.col("spread"))), 2
            ).alias("lower_bound"),
            F.round(F.col("predicted") + CONFIDENCE * F.col("spread"), 2).alias("upper_bound"),
            F.when(enough, F.round("mean", 2)).alias("historical_mean"),
            F.when(enough, F.round("slope", 2)).alias("historical_slope"),
        )
    )


def anomalies(
    series: DataFrame, by: Sequence[str] = (), threshold: float = ANOMALY_Z
) -> DataFrame:
    """Days more than ``threshold`` population deviations from the mean of their entity."""
    entity = Window.partitionBy(*by)
    y = F.col("val").cast("double")
    scored = series.withColumns(
        {"mean": F.avg(y).over(entity), "std": F.stddev_pop(y).over(entity)}
    ).withColumn("z", F.when(F.col("std") > 0, (y - F.col("mean")) / F.col("std")).otherwise(0.0))
    return scored.where(F.abs("z") > threshold).select(
        *by,
        "trending_date",
        F.col("val").alias("value"),
        F.round("z", 2).alias("z_score"),
        F.when(F.col("z") > 0, "Spike").otherwise("Drop").alias("type"),
        F.round("mean", 2).alias("mean"),
        F.round("std", 2).alias("std"),
    )


def decline(series: DataFrame, by: Sequence[str], history: bool = False) -> DataFrame:
    """How likely each entity is losing views, from the slope of its series.

    Steeper than 5 % of the mean per step is High, any other fall Medium, no fall Low; fewer
    than 3 points are ``insufficient``. ``history`` adds ``total_views_history``, the values by date.
    """
    y = F.col("val").cast("double")
    # Sums that merge: only the ordinal needs the days of an entity in order.
    one = _ordered(series, by).groupBy(*by).agg(
        F.count("val").alias("n"),
        F.regr_slope(y, F.col("ordinal")).alias("slope"),
        F.avg(y).alias("mean"),
        *([F.sort_array(F.collect_list(F.struct("trending_date", "val"))).alias("_days")] if history else []),
    ).withColumn("status", _status(DECLINE_MIN_POINTS))
    # A falling series around zero has no finite ratio and counts as steep.
    steep = F.when(F.col("mean") == 0, F.lit(True)).otherwise(
        F.abs("slope") / F.col("mean") > STEEP_DECLINE
    )
    rating = (
        F.when(F.col("slope") >= 0, "Low").when(steep, "High").otherwise("Medium")
    )
    enough = F.col("status") == "ok"
    return one.select(
        *by,
        "status",
        F.col("n").alias("days"),
        F.when(enough, F.round("slope", 2)).alias("slope"),
        F.when(enough, rating).alias("decline_likelihood"),
        *([F.when(enough, F.transform("_days", lambda d: d["val"].cast("bigint"))).alias("total_views_history")] if history else []),
    )
