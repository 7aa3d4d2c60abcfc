"""Series, forecasts, anomalies, declines and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import feed, query
from registry.reports import _RUNS, _runs, _trends
from tierline.plans import alerts, analytics, marts

_BY_GROUP = """
SELECT channel_title, trending_date, CAST(sum(views) AS BIGINT) AS val
FROM {facts} f JOIN {groups} g ON f.dim_channel_key = g.dim_channel_key
GROUP BY channel_title, trending_date"""
_BY_TYPE = """
SELECT dim_category_id, trending_date, CAST(sum(views) AS BIGINT) AS val
FROM {event_facts} f GROUP BY dim_category_id, trending_date"""
_OVERALL = """
SELECT 1 AS one, trending_date, CAST(sum(views) AS BIGINT) AS val
FROM {event_facts} f GROUP BY trending_date"""


def _group_series(spark, sf_dir):
    return analytics.daily_series(
        feed(spark, sf_dir, "facts"), "views", feed(spark, sf_dir, "groups"), by="channel_title"
    )


def _type_series(spark, sf_dir):
    return analytics.daily_series(feed(spark, sf_dir, "event_facts"), "views", by="dim_category_id")


def _overall_series(spark, sf_dir):
    return analytics.daily_series(feed(spark, sf_dir, "event_facts"), "views")


@query("daily_series_by_group", _BY_GROUP)
def daily_series_by_group(spark, sf_dir):
    return _group_series(spark, sf_dir)


@query(
    "like_filter_series",
    """
SELECT trending_date, CAST(sum(likes) AS BIGINT) AS val
FROM {facts} f JOIN {groups} g ON f.dim_channel_key = g.dim_channel_key
WHERE channel_title ILIKE '%SUPPLIER#0000000%' GROUP BY trending_date""",
)
def like_filter_series(spark, sf_dir):
    """One series over all suppliers whose name contains a text, in any case."""
    return analytics.daily_series(
        feed(spark, sf_dir, "facts"),
        "likes",
        feed(spark, sf_dir, "groups"),
        pattern="SUPPLIER#0000000",
    )


def _models(series: str, by: str) -> str:
    return f"""
SELECT {by}, count(*) AS n, regr_slope(CAST(val AS DOUBLE), x) AS slope,
       regr_intercept(CAST(val AS DOUBLE), x) AS intercept, avg(CAST(val AS DOUBLE)) AS mean,
       max(trending_date) AS last_date
FROM ({_ordinal(series, by)}) o GROUP BY {by}"""


def _ordinal(series: str, by: str) -> str:
    return f"""
SELECT *, CAST(row_number() OVER (PARTITION BY {by} ORDER BY trending_date) - 1 AS DOUBLE) AS x
FROM ({series}) s"""


def _forecast(series: str, by: str, shown: str) -> str:
    return f"""
SELECT {shown} 'ok' AS status, CAST(last_date + CAST(i AS INT) AS DATE) AS forecast_date,
       round(predicted, 2) AS predicted,
       round(greatest(CAST(0 AS DOUBLE), predicted - CAST(1.96 AS DOUBLE) * spread), 2) AS lower_bound,
       round(predicted + CAST(1.96 AS DOUBLE) * spread, 2) AS upper_bound,
       round(mean, 2) AS historical_mean, round(slope, 2) AS historical_slope
FROM (SELECT *, greatest(CAST(0 AS DOUBLE), slope * (n + i) + intercept) AS predicted
      FROM (SELECT m.*, spread, unnest(range(1, 31)) AS i
            FROM ({_models(series, by)}) m JOIN (
              SELECT o.{by}, stddev_pop(val - (slope * x + intercept)) AS spread
              FROM ({_ordinal(series, by)}) o JOIN ({_models(series, by)}) q ON o.{by} = q.{by}
              GROUP BY o.{by}) r ON m.{by} = r.{by}
            WHERE n >= 5) d) p"""


@query("forecast_30d", _forecast(_BY_TYPE, "dim_category_id", "dim_category_id,"))
def forecast_30d(spark, sf_dir):
    """Thirty days ahead for each event type."""
    return analytics.forecast(_type_series(spark, sf_dir), ["dim_category_id"])


@query("forecast_overall", _forecast(_OVERALL, "one", ""))
def forecast_overall(spark, sf_dir):
    """Thirty days ahead for all events together."""
    return analytics.forecast(_overall_series(spark, sf_dir))


@query("forecast_by_group", _forecast(_BY_GROUP, "channel_title", "channel_title,"))
def forecast_by_group(spark, sf_dir):
    """Thirty days ahead for every supplier in one plan."""
    return analytics.forecast(_group_series(spark, sf_dir), ["channel_title"])


def _anomalies(series: str, by: str, shown: str) -> str:
    return f"""
SELECT {shown} trending_date, val AS value, round(z, 2) AS z_score,
       CASE WHEN z > 0 THEN 'Spike' ELSE 'Drop' END AS type, round(mean, 2) AS mean,
       round(std, 2) AS std
FROM (SELECT *, CASE WHEN std > 0 THEN (val - mean) / std ELSE 0 END AS z
      FROM (SELECT *, avg(CAST(val AS DOUBLE)) OVER (PARTITION BY {by}) AS mean,
                   stddev_pop(CAST(val AS DOUBLE)) OVER (PARTITION BY {by}) AS std
            FROM ({series}) s) t) u
WHERE abs(z) > 2"""


@query("anomalies_z", _anomalies(_OVERALL, "one", ""))
def anomalies_z(spark, sf_dir):
    return analytics.anomalies(_overall_series(spark, sf_dir))


@query("anomalies_by_group", _anomalies(_BY_GROUP, "channel_title", "channel_title,"))
def anomalies_by_group(spark, sf_dir):
    return analytics.anomalies(_group_series(spark, sf_dir), ["channel_title"])


def _decline(series: str, by: str) -> str:
    return f"""
SELECT {by}, CASE WHEN n >= 3 THEN 'ok' ELSE 'insufficient' END AS status, n AS days,
       CASE WHEN n >= 3 THEN round(slope, 2) END AS slope,
       CASE WHEN n < 3 THEN NULL WHEN slope >= 0 THEN 'Low'
            WHEN abs(slope) / mean > 0.05 THEN 'High' ELSE 'Medium' END AS decline_likelihood
FROM ({_models(series, by)}) m"""


@query("decline_likelihood", _decline(_BY_GROUP, "channel_title"))
def decline_likelihood(spark, sf_dir):
    """The rating of every supplier in one plan."""
    return analytics.decline(_group_series(spark, sf_dir), ["channel_title"])


_BY_ITEM = """
SELECT video_id, trending_date, CAST(sum(views) AS BIGINT) AS val
FROM {event_facts} f GROUP BY video_id, trending_date"""


@query("decline_by_item", _decline(_BY_ITEM, "video_id"))
def decline_by_item(spark, sf_dir):
    series = analytics.daily_series(feed(spark, sf_dir, "event_facts"), "views", by="video_id")
    return analytics.decline(series, ["video_id"])


@query(
    "decline_history",
    f"""
SELECT video_id, count(*) AS days,
       CASE WHEN count(*) >= 3 THEN string_agg(CAST(val AS STRING), ',' ORDER BY trending_date) END AS total_views_history
FROM ({_BY_ITEM}) s GROUP BY video_id""",
)
def decline_history(spark, sf_dir):
    """The values that each item's rating rests on, by date."""
    series = analytics.daily_series(feed(spark, sf_dir, "event_facts"), "views", by="video_id")
    rated = analytics.decline(series, ["video_id"], history=True)
    return rated.select("video_id", "days", F.array_join(F.col("total_views_history").cast("array<string>"), ",").alias("total_views_history"))


# Alerts

_SLOW = f"""
SELECT 'WARNING' AS severity, 'run_duration' AS rule, run_id AS subject,
       concat('Pipeline run duration (', CAST(CAST(duration_seconds AS BIGINT) AS STRING),
              '.00s) exceeds warning threshold (300s).') AS message
FROM ({_RUNS}) r WHERE duration_seconds > 300"""
_FAILED = f"""
SELECT 'CRITICAL', 'run_failed', run_id, concat('Pipeline run failed for run ', run_id, '.')
FROM ({_RUNS}) r WHERE status = 'FAILED'"""
# Tenths of a percent, rounded half up in integers.
_REJECTION = f"""
SELECT 'CRITICAL' AS severity, 'rejection_rate' AS rule, run_id AS subject,
       concat('High data quality rejection rate (', CAST(tenths // 10 AS STRING), '.',
              CAST(tenths % 10 AS STRING), '%) in run ', run_id, '.') AS message
FROM (SELECT *, (records_rejected * 2000 + total) // (2 * total) AS tenths
      FROM (SELECT *, records_inserted + records_rejected AS total FROM ({_RUNS}) r) s
      WHERE total > 0) t
WHERE records_rejected * 100 > 10 * total"""


def _money(x: str) -> str:
    """Two digits always, as a decimal prints."""
    return f"printf('%.2f', {x})"


def _trend_alerts(source: str) -> str:
    return f"""
SELECT 'WARNING' AS severity, 'daily_change' AS rule, CAST(trending_date AS STRING) AS subject,
       concat('Daily KPI deviation of ', {_money("pct_change_day_over_day")}, '% detected on ',
              CAST(trending_date AS STRING), '.') AS message
FROM ({_trends(source)}) t WHERE abs(pct_change_day_over_day) > 50"""


_ANOMALY_ALERTS = f"""
SELECT 'WARNING' AS severity, 'anomaly' AS rule, CAST(trending_date AS STRING) AS subject,
       concat('ML Anomaly detected on ', CAST(trending_date AS STRING), ' - ', type,
              ' (z-score: ', CAST(z_score AS STRING), ').') AS message
FROM ({_anomalies(_OVERALL, "one", "")}) a"""
_DECLINE_ALERTS = f"""
SELECT 'WARNING' AS severity, 'decline' AS rule, CAST(video_id AS STRING) AS subject,
       concat('High decline likelihood detected for channel ', CAST(video_id AS STRING),
              ' (Slope: ', CAST(slope AS STRING), ').') AS message
FROM ({_decline(_BY_ITEM, "video_id")}) d WHERE decline_likelihood = 'High'"""


@query("alerts_runs", f"{_SLOW} UNION ALL {_FAILED}")
def alerts_runs(spark, sf_dir):
    return alerts.alerts_runs(_runs(spark, sf_dir))


@query("alerts_rejection", _REJECTION)
def alerts_rejection(spark, sf_dir):
    return alerts.alerts_rejection(_runs(spark, sf_dir))


@query(
    "rejection_rate",
    f"""
SELECT run_id, round(records_rejected * CAST(100 AS DOUBLE) / (records_inserted + records_rejected), 4)
         AS rate
FROM ({_RUNS}) r WHERE records_inserted + records_rejected > 0""",
)
def rejection_rate(spark, sf_dir):
    rates = alerts.rejection_rate(_runs(spark, sf_dir))
    return rates.select("run_id", F.round(F.col("rate").cast("double"), 4).alias("rate"))


@query("alerts_trends", _trend_alerts("{facts}"))
def alerts_trends(spark, sf_dir):
    return alerts.alerts_trends(marts.daily_trends(feed(spark, sf_dir, "facts")))


@query("alerts_anomaly", _ANOMALY_ALERTS)
def alerts_anomaly(spark, sf_dir):
    return alerts.alerts_anomaly(analytics.anomalies(_overall_series(spark, sf_dir)))


def _item_declines(spark, sf_dir):
    series = analytics.daily_series(feed(spark, sf_dir, "event_facts"), "views", by="video_id")
    return analytics.decline(series, ["video_id"])


@query("alerts_decline", _DECLINE_ALERTS)
def alerts_decline(spark, sf_dir):
    return alerts.alerts_decline(_item_declines(spark, sf_dir), "video_id")


@query(
    "alerts_all",
    " UNION ALL ".join(
        f"SELECT *, {i} AS rule_order FROM ({text}) a{i}"
        for i, text in enumerate(
            [
                f"{_SLOW} UNION ALL {_FAILED}",
                _REJECTION,
                _trend_alerts("{facts}"),
                _ANOMALY_ALERTS,
                _DECLINE_ALERTS,
            ],
            start=1,
        )
    ),
)
def alerts_all(spark, sf_dir):
    """All rules together, numbered in their order."""
    runs = _runs(spark, sf_dir)
    return alerts.alerts_all(
        alerts.alerts_runs(runs),
        alerts.alerts_rejection(runs),
        alerts.alerts_trends(marts.daily_trends(feed(spark, sf_dir, "facts"))),
        alerts.alerts_anomaly(analytics.anomalies(_overall_series(spark, sf_dir))),
        alerts.alerts_decline(_item_declines(spark, sf_dir), "video_id"),
    )
