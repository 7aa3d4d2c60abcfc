"""A run from landed raw items to the marts (all of V, D6, D7, M1-M3, K1-K5, R1, R2 together)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from registry.base import feed, query, table
from registry.bronze import as_csv
from registry.reports import _kpi, as_double
from registry.silver import _CLASSIFIED
from tierline.model import CHANNEL_FEED, ITEM_FEED
from tierline.plans import mart_states
from tierline.plans.ledger import RUNS
from tierline.plans.pipeline import Feeds, Pipeline, run_pipeline
from tierline.session import scratch_dir
from tierline.sinks import Warehouse
from tierline.sources import with_lineage

RUN_TS = dt.datetime(2024, 2, 1, 6, 0, 0)

# No source describes channels or categories, so all of them are inferred; items without a
# channel title have no member and drop out of the facts.
_FACTS = f"""(
SELECT p_date AS trending_date, trim(video_id) AS video_id, p_views AS views, p_likes AS likes,
       concat('Inferred Category ', p_category) AS category
FROM ({_CLASSIFIED}) c WHERE reason IS NULL AND trim(channel_title) <> '')"""


def _landed_run(spark, sf_dir):
    """A warehouse with the raw items landed, and a run over it."""
    raw = feed(spark, sf_dir, "raw_items").drop("source_system")
    wh = Warehouse(spark, scratch_dir(spark, "run"))
    wh.create()
    raw = raw.withColumn("thumbnail_link", F.lit(None).cast("string"))
    landed = with_lineage(raw, "events", RUN_TS)
    wh.write_replace_partition("bronze.raw_videos", landed, RUN_TS.date())
    return wh, Pipeline(spark, wh, "run-1", RUN_TS)


@query("run_from_bronze", _kpi(_FACTS, "category"))
def run_from_bronze(spark, sf_dir):
    """The daily KPI mart of a whole run over the raw items."""
    wh, run = _landed_run(spark, sf_dir)
    run.clean()
    run.historize()
    run.build()
    return wh.read("gold.trending_kpi_summary_mart").drop("load_timestamp")


@query(
    "run_counts",
    f"""
SELECT 'run-1' AS run_id, 'SUCCESS' AS status, CAST(count(*) - count(reason) AS BIGINT) AS records_inserted,
       CAST(count(reason) AS BIGINT) AS records_rejected
FROM ({_CLASSIFIED}) c""",
)
def run_counts(spark, sf_dir):
    """What the ledger says about a run that validated the raw items."""
    wh, run = _landed_run(spark, sf_dir)
    run.ledger.start()
    run.clean()
    run.ledger.finish("SUCCESS", **run.counts)
    return wh.read(RUNS).select("run_id", "status", "records_inserted", "records_rejected")


# The same items in three loads: a row is a duplicate of rows of earlier loads, and of those before it in its own.
_LOADS = 3
_IN_LOADS = _CLASSIFIED.replace("ORDER BY row_seq", f"ORDER BY row_seq % {_LOADS}, row_seq")


@query(
    "run_full_equals_daily",
    f"""
SELECT run, trim(video_id) AS video_id, p_date AS trending_date, p_views AS views, p_likes AS likes
FROM ({_IN_LOADS}) c, (VALUES ('daily'), ('full')) v(run) WHERE reason IS NULL""",
)
def run_full_equals_daily(spark, sf_dir):
    """Valid items of daily runs that know the keys of earlier loads, and of one run over all loads (V3)."""
    raw = feed(spark, sf_dir, "raw_items").drop("source_system").withColumn("thumbnail_link", F.lit(None).cast("string"))
    wh = Warehouse(spark, scratch_dir(spark, "loads"))
    wh.create()
    days = [RUN_TS + dt.timedelta(days=i) for i in range(_LOADS)]
    for i, day in enumerate(days):
        landed = with_lineage(raw.where(F.col("row_seq") % _LOADS == i), "events", day)
        wh.write_replace_partition("bronze.raw_videos", landed, day.date())
        Pipeline(spark, wh, f"daily-{i}", day, across_loads=True).clean_items()
    last = days[-1] + dt.timedelta(days=1)
    Pipeline(spark, wh, "full", last, full=True).clean_items()
    run = F.when(F.col("load_date") == F.lit(last.date()), "full").otherwise("daily").alias("run")
    return wh.read("silver.videos").select(run, "video_id", "trending_date", "views", "likes")


# The same items as files of two days, each with all four feeds. A date and item of both days is that of the second.
# Short categories are described, others inferred. A channel of the second extract is inferred on the first day.
_TWO_DAYS = f"""(
SELECT * FROM (
  SELECT p_date AS trending_date, trim(video_id) AS video_id, p_views AS views, p_likes AS likes,
         trim(channel_title) AS channel,
         CASE WHEN p_category <= 5 THEN concat('Length ', p_category) ELSE concat('Inferred Category ', p_category) END AS category,
         rank() OVER (PARTITION BY trim(video_id), p_date ORDER BY row_seq % 2 DESC) AS newest
  FROM ({_CLASSIFIED.replace("ORDER BY row_seq", "ORDER BY row_seq % 2, row_seq")}) c WHERE reason IS NULL) v
WHERE newest = 1 AND channel <> '')"""


def _two_days(spark, sf_dir):
    """A warehouse after the runs of two days, from CSV, JSON and XML files and a growing table."""
    raw = feed(spark, sf_dir, "raw_items").withColumn("thumbnail_link", F.lit(None).cast("string"))
    kinds = table(spark, sf_dir, "events").select("event_type", F.length("event_type").alias("n")).distinct()
    root = scratch_dir(spark, "days")

    short = kinds.where("n <= 5").select(F.col("n").cast("string").alias("id")).distinct()
    entry = F.struct("id", F.struct(F.concat(F.lit("Length "), "id").alias("title")).alias("snippet"))
    short.agg(F.collect_list(entry).alias("items")).write.json(f"{root}/categories")

    channel = {c: F.lit("7") for c in CHANNEL_FEED} | {
        "channel_id": F.concat(F.lit("UC-"), "event_type"),
        "channel_title": F.concat(F.lit("Channel "), "event_type"),
        "last_updated": F.lit("2024-01-01T00:00:00"),
    }
    even = kinds.where("n % 2 = 0").select(*[value.alias(c) for c, value in channel.items()])
    even.write.format("xml").option("rootTag", "channels").option("rowTag", "channel").save(f"{root}/channels")
    # The table names the channels of the file otherwise, but the file comes first.
    extract = kinds.selectExpr(
        "concat('UC-', event_type) AS channel_id",
        "concat(if(n % 2 = 0, 'Other ', 'Channel '), event_type) AS channel_title",
        "n AS total_videos",
        "CAST(n AS BIGINT) AS total_views",
        "if(event_type < 'd', TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2024-01-02 00:00:00') AS last_updated",
    )
    wh = f"{root}/warehouse"
    for i in range(2):
        day = RUN_TS + dt.timedelta(days=i)
        rows = raw.where(F.col("row_seq") % 2 == i).orderBy("row_seq").select(*ITEM_FEED)
        seen = extract.where(F.col("last_updated") <= F.lit(dt.datetime(2024, 1, 1 + i)).cast("timestamp_ntz"))
        feeds = Feeds(as_csv(rows), f"{root}/categories", f"{root}/channels", seen)
        run_pipeline(spark, wh, feeds, f"day-{i}", day, across_loads=True)
    return Warehouse(spark, wh)


@query(
    "run_two_days_marts",
    f"""
SELECT trending_date, total_trending_videos, total_views, total_likes, most_trending_category AS title
FROM ({_kpi(_TWO_DAYS, "category")}) k
UNION ALL
SELECT NULL, count(DISTINCT video_id), CAST(sum(views) AS BIGINT), CAST(sum(likes) AS BIGINT), channel
FROM {_TWO_DAYS} f GROUP BY channel""",
)
def run_two_days_marts(spark, sf_dir):
    """Daily and channel marts after two whole runs over all four feeds."""
    wh = _two_days(spark, sf_dir)
    totals = ["total_trending_videos", "total_views", "total_likes"]
    daily = wh.read("gold.trending_kpi_summary_mart").select(
        "trending_date", *totals, F.col("most_trending_category").alias("title")
    )
    channels = wh.read("gold.channel_performance_mart").select(
        F.lit(None).cast("date").alias("trending_date"), *totals, F.col("channel_title").alias("title")
    )
    return daily.unionByName(channels)


# The event facts as facts of a warehouse, in two loads: the second brings the last days again, with more views.
_LATER = "(SELECT max(trending_date) - 9 FROM {event_facts} m)"
_RELOADED = f"""(
SELECT trending_date, video_id, dim_category_id, CASE WHEN trending_date >= {_LATER} THEN views + 1 ELSE views END AS views,
       likes FROM {{event_facts}} f)"""


def _two_loads(spark, sf_dir):
    """A warehouse after two loads of facts, with the states of the dates each brought."""
    facts = feed(spark, sf_dir, "event_facts").select(
        F.col("video_id").cast("string"), F.col("dim_category_id").alias("dim_channel_key"), "trending_date", "views", "likes",
        F.length("dim_category_id").alias("dim_category_id"), F.lit(None).cast("string").alias("dim_video_key"),
        F.lit(0).alias("dislikes"), F.lit(0).alias("comment_count"), F.lit(RUN_TS).cast("timestamp_ntz").alias("load_timestamp"),
    )
    wh = Warehouse(spark, scratch_dir(spark, "loads"))
    wh.write_dates(mart_states.FACT, facts, facts.select("trending_date"))
    mart_states.refresh(wh, [])
    last = facts.agg(F.max("trending_date")).first()[0]
    again = facts.where(F.col("trending_date") >= F.lit(last - dt.timedelta(days=9))).withColumn("views", F.col("views") + 1)
    wh.write_dates(mart_states.FACT, again, again.select("trending_date"))
    mart_states.refresh(wh, [r[0].isoformat() for r in again.select("trending_date").distinct().collect()])
    return wh


@query(
    "mart_states_channels",
    f"""
SELECT concat('Channel ', dim_category_id) AS channel_title, count(DISTINCT video_id) AS total_trending_videos,
       CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
       round(avg(likes), 2) AS avg_likes_per_video
FROM {_RELOADED} r GROUP BY dim_category_id""",
)
def mart_states_channels(spark, sf_dir):
    """The channel mart from states of dates, of which the last ones were computed again (M1)."""
    wh = _two_loads(spark, sf_dir)
    states = wh.read("gold.day_channels")
    titles = states.select("dim_channel_key").distinct().withColumn("channel_title", F.concat(F.lit("Channel "), "dim_channel_key"))
    return as_double(mart_states.channel_performance(states, titles), "avg_likes_per_video")


@query(
    "mart_states_trends",
    f"""
SELECT trending_date, total_views, CAST(sum(total_views) OVER (ORDER BY trending_date) AS BIGINT) AS running_total_views,
       lag(total_views) OVER (ORDER BY trending_date) AS previous_day_views
FROM (SELECT trending_date, CAST(sum(views) AS BIGINT) AS total_views FROM {_RELOADED} r GROUP BY trending_date) d""",
)
def mart_states_trends(spark, sf_dir):
    """The trends mart from the same states (M3)."""
    wh = _two_loads(spark, sf_dir)
    return mart_states.daily_trends(wh.read("gold.day_totals")).drop("pct_change_day_over_day")


@query(
    "approximate_items",
    """
SELECT dim_category_id, count(DISTINCT video_id) AS exact_items, true AS within_bound
FROM {event_facts} f GROUP BY dim_category_id""",
)
def approximate_items(spark, sf_dir):
    """Distinct items per category from sketches of single dates, beside the exact number and the stated bound (A2)."""
    facts = feed(spark, sf_dir, "event_facts")
    sketches = mart_states.item_sketches(facts, ["trending_date", "dim_category_id"])
    path = scratch_dir(spark, "sketches")
    sketches.write.parquet(path)
    guess = mart_states.approximate_items(spark.read.parquet(path), ["dim_category_id"])
    exact = facts.groupBy("dim_category_id").agg(F.count_distinct("video_id").alias("exact_items"))
    error = F.abs(F.col("approx_items") - F.col("exact_items"))
    bound = F.lit(mart_states.sketch_error()) * F.col("exact_items")
    return guess.join(exact, "dim_category_id").select("dim_category_id", "exact_items", (error <= bound).alias("within_bound"))
