"""Marts, top-k reports, ledger and ad-hoc SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from registry.base import feed, query, table
from tierline.plans import ledger, marts
from tierline.plans.adhoc import query as run_sql
from tierline.plans.listings import rows_per_source
from tierline.session import scratch_dir
from tierline.sinks import Warehouse

_CHANNEL_MART = """
SELECT channel_title, count(DISTINCT video_id) AS total_trending_videos,
       CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
       round(avg(likes), 2) AS avg_likes_per_video
FROM {facts} f JOIN {groups} g ON f.dim_channel_key = g.dim_channel_key GROUP BY channel_title"""


def as_double(df, column):
    """The SQL side divides in doubles, so exact decimals are compared as doubles."""
    return df.withColumn(column, F.col(column).cast("double"))


@query("mart_group_performance", _CHANNEL_MART)
def mart_group_performance(spark, sf_dir):
    mart = marts.channel_performance(feed(spark, sf_dir, "facts"), feed(spark, sf_dir, "groups"))
    return as_double(mart, "avg_likes_per_video")


def _kpi(source: str, title: str, join: str = "") -> str:
    return f"""
SELECT d.trending_date, total_trending_videos, total_views, total_likes, most_trending_category
FROM (SELECT trending_date, count(DISTINCT video_id) AS total_trending_videos,
             CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes
      FROM {source} f GROUP BY trending_date) d
LEFT JOIN (
  SELECT trending_date, title AS most_trending_category,
         row_number() OVER (PARTITION BY trending_date ORDER BY views DESC, title) AS place
  FROM (SELECT trending_date, {title} AS title, sum(views) AS views FROM {source} f {join}
        GROUP BY trending_date, {title}) s) t
  ON d.trending_date = t.trending_date AND place = 1"""


@query("mart_daily_kpi", _kpi("{event_facts}", "dim_category_id"))
def mart_daily_kpi(spark, sf_dir):
    return marts.daily_kpi(feed(spark, sf_dir, "event_facts"))


@query(
    "mart_daily_kpi_by_title",
    _kpi("{facts}", "category_title", "JOIN {categories} c ON f.dim_category_id = c.category_id"),
)
def mart_daily_kpi_by_title(spark, sf_dir):
    """With a category dimension in which several ids share a title."""
    return marts.daily_kpi(feed(spark, sf_dir, "facts"), feed(spark, sf_dir, "categories"))


def _trends(source: str) -> str:
    return f"""
SELECT trending_date, CAST(total_views AS BIGINT) AS total_views,
       CAST(running_total_views AS BIGINT) AS running_total_views,
       CAST(previous_day_views AS BIGINT) AS previous_day_views,
       CASE WHEN coalesce(previous_day_views, 0) = 0 THEN CAST(0 AS DOUBLE)
            ELSE round((total_views - previous_day_views) * CAST(100 AS DOUBLE) / previous_day_views, 2)
       END AS pct_change_day_over_day
FROM (SELECT trending_date, total_views,
             sum(total_views) OVER (ORDER BY trending_date ROWS UNBOUNDED PRECEDING)
               AS running_total_views,
             lag(total_views) OVER (ORDER BY trending_date) AS previous_day_views
      FROM (SELECT trending_date, sum(views) AS total_views FROM {source} f
            GROUP BY trending_date) d) w"""


@query("mart_daily_trends", _trends("{event_facts}"))
def mart_daily_trends(spark, sf_dir):
    trends = marts.daily_trends(feed(spark, sf_dir, "event_facts"))
    return as_double(trends, "pct_change_day_over_day")


@query("mart_daily_trends_lines", _trends("{facts}"))
def mart_daily_trends_lines(spark, sf_dir):
    trends = marts.daily_trends(feed(spark, sf_dir, "facts"))
    return as_double(trends, "pct_change_day_over_day")


@query(
    "top_groups",
    f"SELECT * FROM ({_CHANNEL_MART}) m ORDER BY total_views DESC, channel_title LIMIT 10",
)
def top_groups(spark, sf_dir):
    """The ten suppliers with most views."""
    mart = marts.channel_performance(feed(spark, sf_dir, "facts"), feed(spark, sf_dir, "groups"))
    return as_double(marts.top_groups(mart, 10), "avg_likes_per_video")


@query(
    "top_categories",
    """
SELECT category_title, CAST(sum(likes) AS BIGINT) AS total_likes
FROM {facts} f JOIN {categories} c ON f.dim_category_id = c.category_id
GROUP BY category_title ORDER BY total_likes DESC, category_title LIMIT 3""",
)
def top_categories(spark, sf_dir):
    """The three category titles with most likes."""
    return marts.top_categories(feed(spark, sf_dir, "facts"), feed(spark, sf_dir, "categories"), 3)


@query("trend_listing", f"SELECT * FROM ({_trends('{event_facts}')}) t ORDER BY trending_date LIMIT 10")
def trend_listing(spark, sf_dir):
    """The first ten days of the trends mart."""
    listed = marts.trend_listing(marts.daily_trends(feed(spark, sf_dir, "event_facts")))
    return as_double(listed, "pct_change_day_over_day")


@query(
    "bronze_counts",
    "SELECT source AS source_system, count(*) AS n FROM documents GROUP BY source",
)
def bronze_counts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").withColumnRenamed("source", "source_system")
    return rows_per_source(documents)


_RUNS = """
SELECT run_id, 'orders' AS pipeline_name, execution_date, status, start_time, end_time,
       CAST(date_diff('second', start_time, end_time) AS DOUBLE) AS duration_seconds,
       records_inserted, records_updated, records_rejected
FROM (
  SELECT run_id, min(execution_date) AS execution_date, max_by(status, event_time) AS status,
         max(start_time) AS start_time,
         max(CASE WHEN event_time = last_event THEN end_time END) AS end_time,
         CAST(sum(coalesce(records_inserted, 0)) AS BIGINT) AS records_inserted,
         CAST(sum(records_updated) AS BIGINT) AS records_updated,
         CAST(sum(coalesce(records_rejected, 0)) AS BIGINT) AS records_rejected
  FROM (SELECT *, max(event_time) OVER (PARTITION BY run_id) AS last_event FROM {run_events} e) v
  GROUP BY run_id) r"""


def _runs(spark, sf_dir):
    return ledger.current_runs(feed(spark, sf_dir, "run_events"))


@query("run_ledger_latest", _RUNS)
def run_ledger_latest(spark, sf_dir):
    """The state of each run after its last event."""
    return as_double(_runs(spark, sf_dir), "duration_seconds")


@query(
    "runs_by_status",
    f"SELECT pipeline_name, status, count(*) AS n FROM ({_RUNS}) r GROUP BY pipeline_name, status",
)
def runs_by_status(spark, sf_dir):
    return ledger.runs_by_status(_runs(spark, sf_dir))


@query(
    "latest_runs",
    f"""
SELECT run_id, status, execution_date, records_inserted FROM ({_RUNS}) r
ORDER BY execution_date DESC, run_id DESC LIMIT 20""",
)
def latest_runs(spark, sf_dir):
    """The twenty most recent runs."""
    latest = ledger.latest_rows(_runs(spark, sf_dir), "execution_date", "run_id")
    return latest.select("run_id", "status", "execution_date", "records_inserted")


@query(
    "audit_log_steps",
    """
SELECT 'gold' AS task_name, 'daily_trends' AS step_name, 'STARTED' AS status,
       CAST(0 AS BIGINT) AS affected_rows, '' AS log_message
UNION ALL
SELECT 'gold', 'daily_trends', 'COMPLETED', count(DISTINCT CAST(ts AS DATE)),
       concat('Days: ', count(DISTINCT CAST(ts AS DATE))) FROM events""",
)
def audit_log_steps(spark, sf_dir):
    """An audited step: its audit lines hold the row count of the mart it wrote."""
    wh = Warehouse(spark, scratch_dir(spark, "audit"))
    book = ledger.RunLedger(wh, "run-1", "orders", dt.datetime(2024, 2, 1))
    trends = marts.daily_trends(feed(spark, sf_dir, "event_facts"))

    @book.audited("gold", "daily_trends")
    def build():
        now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
        n = wh.write_full("gold.trending_trends_mart", marts.with_load_timestamp(trends, now))
        return n, f"Days: {n}"

    build()
    return ledger.ordered_audit(wh.read(ledger.AUDIT))


_ADHOC = """
SELECT o_orderpriority, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
FROM {source} GROUP BY o_orderpriority"""


@query(
    "safe_sql",
    """
SELECT o_orderpriority, count(*) AS n,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders GROUP BY o_orderpriority""",
)
def safe_sql(spark, sf_dir):
    """A read-only text over a registered view."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("tierline_orders")
    return run_sql(spark, _ADHOC.format(source="tierline_orders"))


@query("safe_sql_many_rows", "SELECT o_orderkey, o_orderstatus FROM orders")
def safe_sql_many_rows(spark, sf_dir):
    """A read-only text returns all of its rows."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("tierline_orders")
    return run_sql(spark, "SELECT o_orderkey, o_orderstatus FROM tierline_orders")
