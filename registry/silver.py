"""Validation, duplicates and consolidation."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import feed, landed, query, table
from tierline.operators.dedupe import flag_duplicates, latest_per_key
from tierline.operators.validate import REASON, counted, rejected_records
from tierline.plans import silver
from tierline.plans.listings import rejections_per_reason

RUN_TS = "2024-02-01 06:00:00"
RUN_ID = "run-1"

# The reason for each raw item, restated over the feed.
_NUMBER = "'[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?'"


def _int(c: str, to: str = "BIGINT") -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({c}), {_NUMBER})"
        f" THEN TRY_CAST(trunc(TRY_CAST(trim({c}) AS DOUBLE)) AS {to}) END"
    )


_CLASSIFIED = f"""
SELECT *, CASE
         WHEN trim(coalesce(video_id, '')) IN ('', 'nan') THEN 'MISSING_VIDEO_ID'
         WHEN trim(coalesce(trending_date, '')) IN ('', 'nan') THEN 'MISSING_TRENDING_DATE'
         WHEN place > 1 THEN 'DUPLICATE_VIDEO_ID_AND_TRENDING_DATE'
         WHEN p_category IS NULL
           THEN concat('INVALID_CATEGORY_ID_DATATYPE: ''', trim(coalesce(category_id, '')), '''')
         WHEN p_views IS NULL OR p_likes IS NULL OR p_dislikes IS NULL OR p_comments IS NULL
           THEN 'INVALID_METRIC_DATATYPES'
         WHEN p_time IS NULL OR p_date IS NULL THEN 'INVALID_DATE_FORMATS' END AS reason
FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id, trending_date ORDER BY row_seq) AS place,
         {_int("category_id", "INT")} AS p_category, {_int("views")} AS p_views,
         {_int("likes")} AS p_likes, {_int("dislikes")} AS p_dislikes,
         {_int("comment_count")} AS p_comments,
         TRY_CAST(concat('20', substr(trending_date, 1, 2), '-', substr(trending_date, 7, 2), '-',
                         substr(trending_date, 4, 2)) AS DATE) AS p_date,
         CASE WHEN publish_time LIKE '%+02:00'
              THEN TRY_CAST(substr(publish_time, 1, 19) AS TIMESTAMP) - INTERVAL 2 HOUR
              ELSE TRY_CAST(substr(publish_time, 1, 19) AS TIMESTAMP) END AS p_time
  FROM {{raw_items}} r) p"""


def _classified(spark, sf_dir):
    raw = landed(spark, sf_dir, "raw_items")
    return counted(silver.classify_items(raw, ["row_seq"], "row_seq"))[0]


@query(
    "validate_items_reasons",
    f"""
SELECT 'raw_videos' AS table_name, reason AS rejection_reason, count(*) AS n
FROM ({_CLASSIFIED}) c WHERE reason IS NOT NULL GROUP BY reason""",
)
def validate_items_reasons(spark, sf_dir):
    """Rejected items per reason."""
    classified = _classified(spark, sf_dir).where(F.col(REASON).isNotNull())
    rejects = rejected_records(classified, RUN_ID, "raw_videos", F.lit(None).cast("string"))
    return rejections_per_reason(rejects)


@query(
    "validate_items_valid",
    f"""
SELECT trim(video_id) AS video_id, p_date AS trending_date, trim(coalesce(title, '')) AS title,
       trim(coalesce(channel_title, '')) AS channel_title, p_category AS category_id,
       p_time AS publish_time, trim(coalesce(tags, '')) AS tags, p_views AS views,
       p_likes AS likes, p_dislikes AS dislikes, p_comments AS comment_count,
       coalesce(lower(trim(comments_disabled)) IN ('true', 'yes'), false) AS comments_disabled,
       ratings_disabled = '1' AS ratings_disabled, false AS video_error_or_removed,
       trim(coalesce(description, '')) AS description, source_system,
       TIMESTAMP '2024-02-01 06:00:00' AS load_timestamp
FROM ({_CLASSIFIED}) c WHERE reason IS NULL""",
)
def validate_items_valid(spark, sf_dir):
    """Valid items with their types."""
    return silver.typed_items(_classified(spark, sf_dir), RUN_TS)


_PAYLOAD = ", ".join(
    f"{c} := {c}"
    for c in (
        "video_id", "trending_date", "title", "channel_title", "category_id", "publish_time",
        "tags", "views", "likes", "dislikes", "comment_count", "comments_disabled",
        "ratings_disabled", "video_error_or_removed", "description", "source_system",
    )
)


@query(
    "rejected_payload_json",
    f"""
SELECT 'run-1' AS run_id, 'raw_videos' AS table_name,
       CAST(to_json(struct_pack({_PAYLOAD})) AS STRING) AS raw_record_json,
       reason AS rejection_reason
FROM ({_CLASSIFIED}) c WHERE reason IS NOT NULL""",
)
def rejected_payload_json(spark, sf_dir):
    """Quarantined items with the raw row as JSON text."""
    classified = _classified(spark, sf_dir)
    payload = silver.item_payload([c for c in classified.columns if c in silver.RAW_COLUMNS])
    rejected = classified.where(F.col(REASON).isNotNull())
    return rejected_records(rejected, RUN_ID, "raw_videos", payload)


_LINE = (
    "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


@query(
    "dup_keep_first",
    f"""
SELECT {", ".join(_LINE)},
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(_LINE[2:])}) > 1
         AS is_duplicate
FROM lineitem""",
)
def dup_keep_first(spark, sf_dir):
    """Lines that repeat an order and line number; the scan position tells exact copies apart."""
    lines = table(spark, sf_dir, "lineitem").select(
        *_LINE, F.struct("_metadata.file_path", "_metadata.row_index").alias("position")
    )
    flagged = flag_duplicates(lines, ["l_orderkey", "l_linenumber"], _LINE[2:], "position")
    return flagged.drop("position")


@query(
    "latest_rows",
    """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
  FROM events) e WHERE place = 1""",
)
def latest_rows(spark, sf_dir):
    """The last event of each user."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])


_RAW_CATEGORIES = """
SELECT p_partkey AS row_seq,
       CASE WHEN p_size = 50 THEN 'x' WHEN p_size = 49 THEN '' WHEN p_size = 48 THEN NULL
            WHEN p_size < 20 THEN concat(CAST(p_partkey AS STRING), '.0')
            ELSE CAST(p_size AS STRING) END AS category_id,
       CASE WHEN p_type = 'SMALL' THEN '  ' WHEN p_type = 'ECONOMY' THEN concat(' ', p_name)
            ELSE p_name END AS category_title,
       'parts' AS source_system
FROM {part}"""

_CATEGORIES = f"""
SELECT *, CASE WHEN p_id IS NULL THEN 'INVALID_OR_MISSING_CATEGORY_ID'
               WHEN trim(category_title) = '' THEN 'MISSING_CATEGORY_TITLE'
               WHEN row_seq > first_good THEN 'DUPLICATE_CATEGORY_ID' END AS reason
FROM (SELECT *, min(CASE WHEN trim(category_title) <> '' THEN row_seq END)
                OVER (PARTITION BY p_id) AS first_good
      FROM (SELECT *, {_int("category_id", "INT")} AS p_id FROM ({_RAW_CATEGORIES}) r) p) q"""


def _categories(spark, sf_dir):
    raw = spark.sql(_RAW_CATEGORIES, part=table(spark, sf_dir, "part"))
    return silver.classify_categories(raw, ["row_seq"], "row_seq")


@query(
    "validate_categories",
    f"""
SELECT p_id AS category_id, trim(category_title) AS category_title, source_system,
       TIMESTAMP '2024-02-01 06:00:00' AS load_timestamp
FROM ({_CATEGORIES}) c WHERE reason IS NULL""",
)
def validate_categories(spark, sf_dir):
    return silver.typed_categories(_categories(spark, sf_dir), RUN_TS)


@query(
    "validate_categories_rejects",
    f"""
SELECT 'run-1' AS run_id, 'raw_categories' AS table_name,
       CAST(to_json(struct_pack(category_id := category_id, category_title := category_title,
                                source_system := source_system)) AS STRING) AS raw_record_json,
       reason AS rejection_reason
FROM ({_CATEGORIES}) c WHERE reason IS NOT NULL""",
)
def validate_categories_rejects(spark, sf_dir):
    rejected = _categories(spark, sf_dir).where(F.col(REASON).isNotNull())
    payload = silver.raw_json(["category_id", "category_title", "source_system"])
    return rejected_records(rejected, RUN_ID, "raw_categories", payload)


def _newest(feed_name: str) -> str:
    return f"""
SELECT * FROM (
  SELECT *, trim(channel_id) AS id,
         row_number() OVER (PARTITION BY trim(channel_id) ORDER BY last_updated DESC, row_seq DESC)
           AS place
  FROM {{{feed_name}}} f) g
WHERE place = 1 OR trim(coalesce(channel_id, '')) IN ('', 'nan')"""


# Rows without a usable id never meet: their join key is made unique per row and side.
_MERGED = f"""
SELECT coalesce(x.id, d.id) AS channel_id, x.channel_title AS title_x, d.channel_title AS title_d,
       x.subscriber_count, x.country, x.last_updated AS updated_x, d.last_updated AS updated_d,
       x.source_system AS source_x, d.source_system AS source_d, x.row_seq AS seq_x,
       d.row_seq AS seq_d, d.total_videos, d.total_views,
       trim(coalesce(x.channel_title, d.channel_title, '')) AS title
FROM (SELECT *, CASE WHEN coalesce(id, 'nan') = 'nan' THEN concat('x', row_seq) ELSE id END AS j
      FROM ({_newest("channels_xml")}) x0) x
FULL JOIN
     (SELECT *, CASE WHEN coalesce(id, 'nan') = 'nan' THEN concat('d', row_seq) ELSE id END AS j
      FROM ({_newest("channels_db")}) d0) d ON x.j = d.j"""


def _channels(spark, sf_dir):
    newest = [F.desc("last_updated"), F.desc("row_seq")]
    return silver.classify_channels(
        silver.latest_channels(feed(spark, sf_dir, "channels_xml"), newest),
        silver.latest_channels(feed(spark, sf_dir, "channels_db"), newest),
    )


@query(
    "consolidate_outer",
    f"""
SELECT channel_id, title AS channel_title, CAST(subscriber_count AS BIGINT) AS subscriber_count,
       coalesce(trim(country), 'Unknown') AS country, CAST(total_videos AS INT) AS total_videos,
       CAST(trunc(CAST(total_views AS DOUBLE)) AS BIGINT) AS total_views,
       'channels_consolidated' AS source_system,
       TIMESTAMP '2024-02-01 06:00:00' AS load_timestamp
FROM ({_MERGED}) m WHERE coalesce(channel_id, 'nan') <> 'nan' AND title <> ''""",
)
def consolidate_outer(spark, sf_dir):
    """Channels described by either or both sources."""
    return silver.typed_channels(_channels(spark, sf_dir), RUN_TS)


_FIELDS = (
    ("channel_id", "channel_id"), ("channel_title_xml", "title_x"),
    ("subscriber_count", "subscriber_count"), ("country", "country"),
    ("last_updated_xml", "updated_x"), ("source_system_xml", "source_x"),
    ("row_seq_xml", "CAST(seq_x AS STRING)"), ("channel_title_db", "title_d"),
    ("total_videos", "total_videos"), ("total_views", "total_views"),
    ("last_updated_db", "updated_d"), ("source_system_db", "source_d"),
    ("row_seq_db", "CAST(seq_d AS STRING)"),
)
_PARTS = ", ".join(
    f"""CASE WHEN {sql} IS NOT NULL THEN concat('"{name}":', to_json({sql})) END"""
    for name, sql in _FIELDS
)


@query(
    "consolidate_rejects",
    f"""
SELECT 'run-1' AS run_id, 'consolidated_channels' AS table_name,
       concat('{{', concat_ws(',', {_PARTS}), '}}') AS raw_record_json,
       CASE WHEN coalesce(channel_id, 'nan') = 'nan' THEN 'MISSING_CHANNEL_ID'
            ELSE 'MISSING_CHANNEL_TITLE' END AS rejection_reason
FROM ({_MERGED}) m WHERE coalesce(channel_id, 'nan') = 'nan' OR title = ''""",
)
def consolidate_rejects(spark, sf_dir):
    """Channels without an id or with a blank title, with the merged row as JSON text."""
    classified = _channels(spark, sf_dir)
    rejected = classified.where(F.col(REASON).isNotNull())
    payload = silver.channel_payload(classified)
    return rejected_records(rejected, RUN_ID, "consolidated_channels", payload)
