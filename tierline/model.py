"""Tables of the warehouse: schemas and layouts.

Layouts
  append   rows are only ever added
  daily    one directory per load day (and date); a run replaces its own day
  run      one directory per run and source table; a repeated run replaces its own rows
  full     replaced as a whole
  keyed    a dimension in hash buckets of its key; a step replaces the buckets it changes
  versions a versioned dimension in such buckets: current rows are replaced, closed rows are added
  dated    one directory per value of the date column; a reload replaces the dates it brings
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    layout: str
    schema: T.StructType
    partition: tuple[str, ...] = ()
    key: str | None = None
    buckets: int = 1


# Buckets of a dimension: a step rewrites those it changes, so large dimensions want thousands.
BUCKETS = 16
# Folders of a load day's item keys; a date has all its keys in one of them.
KEY_BUCKETS = 64

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal": T.DecimalType(20, 2),
    "binary": T.BinaryType(),
}


def _table(layout: str, columns: str, *partition: str, key: str | None = None) -> Table:
    """``columns`` lists names with types; unlike ``fromDDL`` this needs no session."""
    pairs = [c.split() for c in columns.split(",")]
    schema = T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs])
    return Table(layout, schema, partition, key, BUCKETS)


# Column names and order of the raw feeds.
ITEM_FEED = (
    "video_id",
    "trending_date",
    "title",
    "channel_title",
    "category_id",
    "publish_time",
    "tags",
    "views",
    "likes",
    "dislikes",
    "comment_count",
    "thumbnail_link",
    "comments_disabled",
    "ratings_disabled",
    "video_error_or_removed",
    "description",
)
CHANNEL_FEED = ("channel_id", "channel_title", "subscriber_count", "country", "last_updated")
EXTRACT = ("channel_id", "channel_title", "total_videos", "total_views", "last_updated")

# Attributes of the versioned dimensions and those whose change opens a version.
ITEM_ATTRIBUTES = (
    "title",
    "channel_title",
    "category_id",
    "publish_time",
    "tags",
    "comments_disabled",
    "ratings_disabled",
    "video_error_or_removed",
    "description",
)
ITEM_TRACKED = tuple(c for c in ITEM_ATTRIBUTES if c != "publish_time")
CHANNEL_ATTRIBUTES = (
    "channel_title",
    "subscriber_count",
    "country",
    "total_videos",
    "total_views",
)
CHANNEL_TRACKED = CHANNEL_ATTRIBUTES


def _strings(columns: tuple[str, ...]) -> str:
    return ", ".join(f"{c} string" for c in columns)


_LINEAGE = "source_system string, load_timestamp timestamp_ntz"
_VERSION = (
    "version_number int, effective_start_date timestamp_ntz,"
    " effective_end_date timestamp_ntz, is_current boolean"
)
_COUNTS = "records_inserted bigint, records_updated bigint, records_rejected bigint"

TABLES = {
    "bronze.raw_videos": _table(
        "daily",
        f"{_strings(ITEM_FEED)}, {_LINEAGE}, row_seq bigint, ingestion_date date",
        "ingestion_date",
    ),
    "bronze.raw_categories": _table(
        "full", f"category_id string, category_title string, {_LINEAGE}, row_seq bigint"
    ),
    "bronze.raw_channels": _table("full", f"{_strings(CHANNEL_FEED)}, {_LINEAGE}"),
    "bronze.raw_channels_extra": _table("append", f"{_strings(EXTRACT)}, {_LINEAGE}"),
    "silver.rejected_records": _table(
        "run",
        "raw_record_json string, rejection_reason string, rejected_at timestamp_ntz,"
        " run_id string, table_name string",
        "run_id",
        "table_name",
    ),
    "silver.videos": _table(
        "daily",
        "video_id string, trending_date date, title string, channel_title string,"
        " category_id int, publish_time timestamp_ntz, tags string, views bigint, likes bigint,"
        " dislikes bigint, comment_count bigint, comments_disabled boolean,"
        " ratings_disabled boolean, video_error_or_removed boolean, description string,"
        f" {_LINEAGE}, load_date date",
        "load_date",
        "trending_date",
    ),
    # Keys as the feed spells them, of every load day, by the hash of their date.
    "silver.item_keys": _table(
        "daily",
        "video_id string, trending_date string, load_date date, date_bucket int",
        "load_date",
        "date_bucket",
    ),
    "silver.categories": _table("full", f"category_id int, category_title string, {_LINEAGE}"),
    "silver.channels": _table(
        "full",
        "channel_id string, channel_title string, subscriber_count bigint, country string,"
        f" total_videos int, total_views bigint, {_LINEAGE}",
    ),
    "gold.dim_video": _table(
        "versions",
        "dim_video_key string, video_id string, title string, channel_title string,"
        " category_id int, publish_time timestamp_ntz, tags string, comments_disabled boolean,"
        f" ratings_disabled boolean, video_error_or_removed boolean, description string, {_VERSION}",
        key="video_id",
    ),
    "gold.dim_category": _table(
        "keyed", "category_id int, category_title string, load_timestamp timestamp_ntz", key="category_id"
    ),
    "gold.dim_channel": _table(
        "versions",
        "dim_channel_key string, channel_id string, channel_title string,"
        f" subscriber_count bigint, country string, total_videos int, total_views bigint, {_VERSION}",
        key="channel_id",
    ),
    "gold.fact_video_metrics": _table(
        "dated",
        "video_id string, dim_video_key string, dim_category_id int, dim_channel_key string,"
        " views bigint, likes bigint, dislikes bigint, comment_count bigint,"
        " load_timestamp timestamp_ntz, trending_date date",
        "trending_date",
    ),
    # What the marts need of each date, so that a run computes the dates it reloads.
    "gold.item_numbers": _table("keyed", "video_id string, item_number bigint", key="video_id"),
    "gold.day_totals": _table(
        "dated", "total_trending_videos bigint, total_views bigint, total_likes bigint, trending_date date", "trending_date"
    ),
    "gold.day_categories": _table("dated", "dim_category_id int, views bigint, trending_date date", "trending_date"),
    "gold.day_channels": _table(
        "dated",
        "dim_channel_key string, item_block bigint, items binary, views bigint, likes bigint, n bigint, trending_date date",
        "trending_date",
    ),
    "gold.channel_performance_mart": _table(
        "full",
        "channel_title string, total_trending_videos bigint, total_views bigint,"
        " total_likes bigint, avg_likes_per_video decimal, load_timestamp timestamp_ntz",
    ),
    "gold.trending_kpi_summary_mart": _table(
        "full",
        "trending_date date, total_trending_videos bigint, total_views bigint,"
        " total_likes bigint, most_trending_category string, load_timestamp timestamp_ntz",
    ),
    "gold.trending_trends_mart": _table(
        "full",
        "trending_date date, total_views bigint, running_total_views bigint,"
        " previous_day_views bigint, pct_change_day_over_day decimal,"
        " load_timestamp timestamp_ntz",
    ),
    "metadata.pipeline_run_events": _table(
        "keyed",
        "run_id string, pipeline_name string, execution_date timestamp_ntz, status string,"
        " event_time timestamp_ntz, start_time timestamp_ntz, end_time timestamp_ntz,"
        f" {_COUNTS}",
        key="run_id",
    ),
    "metadata.pipeline_runs": _table(
        "keyed",
        "run_id string, pipeline_name string, execution_date timestamp_ntz, status string,"
        " start_time timestamp_ntz, end_time timestamp_ntz, duration_seconds decimal,"
        f" {_COUNTS}",
        key="run_id",
    ),
    "metadata.audit_log": _table(
        "append",
        "log_id bigint, run_id string, task_name string, step_name string, status string,"
        " affected_rows bigint, log_message string, log_timestamp timestamp_ntz",
    ),
}
