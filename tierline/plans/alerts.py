"""Threshold alerts as rows of (severity, rule, subject, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits above which an alert is raised.
SLOW_RUN_SECONDS = 300
REJECTION_PERCENT = 10
DAILY_CHANGE_PERCENT = 50

# Texts of the alerts, which readers of alerts know and filter by.
SLOW_RUN = f"Pipeline run duration (%ss) exceeds warning threshold ({SLOW_RUN_SECONDS}s)."
FAILED_RUN = "Pipeline run failed for run %s."
MANY_REJECTIONS = "High data quality rejection rate (%s%%) in run %s."
DAILY_CHANGE = "Daily KPI deviation of %s%% detected on %s."
ANOMALY = "ML Anomaly detected on %s - %s (z-score: %s)."
DECLINE = "High decline likelihood detected for channel %s (Slope: %s)."


def _text(message: str, *values: Column) -> Column:
    """The message with its values; null if one of them is null."""
    parts = [F.lit(p.replace("\0", "%")) for p in message.replace("%%", "\0").split("%s")]
    texts = [v.cast("string") for v in values]
    return F.concat(parts[0], *[c for pair in zip(texts, parts[1:], strict=True) for c in pair])


def _alert(df: DataFrame, severity: str, rule: str, subject: Column, message: Column) -> DataFrame:
    return df.select(
        F.lit(severity).alias("severity"),
        F.lit(rule).alias("rule"),
        subject.cast("string").alias("subject"),
        message.alias("message"),
    )


def alerts_runs(runs: DataFrame) -> DataFrame:
    """Slow runs (G1) and failed runs."""
    slow = _alert(
        runs.where(F.col("duration_seconds") > SLOW_RUN_SECONDS),
        "WARNING",
        "run_duration",
        F.col("run_id"),
        _text(SLOW_RUN, F.col("duration_seconds")),
    )
    failed = _alert(
        runs.where(F.col("status") == "FAILED"),
        "CRITICAL",
        "run_failed",
        F.col("run_id"),
        _text(FAILED_RUN, F.col("run_id")),
    )
    return slow.unionByName(failed)


def rejection_rate(runs: DataFrame) -> DataFrame:
    """Share of rejected records per run in percent; NULL counts are 0, empty runs are left out."""
    inserted = F.coalesce(F.col("records_inserted"), F.lit(0)).cast("decimal(20,0)")
    rejected = F.coalesce(F.col("records_rejected"), F.lit(0)).cast("decimal(20,0)")
    total = inserted + rejected
    return runs.where(total > 0).select("run_id", (rejected * 100 / total).alias("rate"))


def alerts_rejection(runs: DataFrame) -> DataFrame:
    """Runs that rejected more than a tenth of their records."""
    return _alert(
        rejection_rate(runs).where(F.col("rate") > REJECTION_PERCENT),
        "CRITICAL",
        "rejection_rate",
        F.col("run_id"),
        _text(MANY_REJECTIONS, F.round("rate", 1).cast("decimal(20,1)"), F.col("run_id")),
    )


def alerts_trends(trends: DataFrame) -> DataFrame:
    """Days that moved by more than half against the day before."""
    pct = F.col("pct_change_day_over_day")
    return _alert(
        trends.where(F.abs(pct) > DAILY_CHANGE_PERCENT),
        "WARNING",
        "daily_change",
        F.col("trending_date"),
        _text(DAILY_CHANGE, pct, F.col("trending_date")),
    )


def alerts_anomaly(anomalies: DataFrame) -> DataFrame:
    """One alert per anomalous day."""
    return _alert(
        anomalies,
        "WARNING",
        "anomaly",
        F.col("trending_date"),
        _text(ANOMALY, F.col("trending_date"), F.col("type"), F.col("z_score")),
    )


def alerts_decline(declines: DataFrame, entity: str) -> DataFrame:
    """Entities whose decline is rated High."""
    return _alert(
        declines.where(F.col("decline_likelihood") == "High"),
        "WARNING",
        "decline",
        F.col(entity),
        _text(DECLINE, F.col(entity), F.col("slope")),
    )


def alerts_all(*alerts: DataFrame) -> DataFrame:
    """All alerts, numbered by the order in which the rules were given."""
    numbered = [a.withColumn("rule_order", F.lit(i)) for i, a in enumerate(alerts, start=1)]
    return reduce(DataFrame.unionByName, numbered)
