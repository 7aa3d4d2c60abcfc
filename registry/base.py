"""Registration, table access and the feeds derived from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierline.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query under a name together with its SQL; feeds in the SQL appear as ``{name}``."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        ORACLES[name] = expand(sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Feed times with a zone become wall time in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``FEEDS`` as a frame."""
    text = FEEDS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A feed written to a table and read back, as a run finds its raw rows."""
    path = scratch_dir(spark, name)
    feed(spark, sf_dir, name).write.parquet(path)
    return spark.read.parquet(path)


def expand(sql: str) -> str:
    """Put the feeds into an SQL text as subqueries over the plain tables."""
    for name, text in FEEDS.items():
        sql = sql.replace(f"{{{name}}}", f"({text})")
    for t in TABLES:
        sql = sql.replace(f"{{{t}}}", t)
    return sql


# Both engines read these texts. The tables are clean, so the number k in ``props`` (0 to 99)
# decides which rows carry which defect; every row of the table takes part.
_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
_DAY = "CAST(CAST(ts AS DATE) AS STRING)"

FEEDS = {
    # Raw item rows with every kind of defect.
    "raw_items": f"""
SELECT event_id AS row_seq,
       CASE WHEN k = 0 THEN NULL WHEN k = 1 THEN '   ' WHEN k = 2 THEN 'nan'
            WHEN k < 50 THEN concat('item-', CAST(user_id AS STRING))
            ELSE concat(' item-', CAST(user_id AS STRING), ' ') END AS video_id,
       CASE WHEN k = 3 THEN '' WHEN k = 4 THEN 'corrupted_date' WHEN k = 5 THEN '24.31.02'
            ELSE concat(substr(d, 3, 2), '.', substr(d, 9, 2), '.', substr(d, 6, 2)) END
         AS trending_date,
       CASE WHEN k < 30 THEN concat(' ', event_type, ' by ', CAST(user_id AS STRING), ' ')
            WHEN k < 95 THEN event_type ELSE NULL END AS title,
       CASE WHEN k < 98 THEN concat('Channel ', event_type) ELSE '' END AS channel_title,
       CASE WHEN k = 6 THEN 'not_int_cat' WHEN k = 7 THEN '' WHEN k = 8 THEN NULL
            WHEN k < 20 THEN concat(CAST(length(event_type) AS STRING), '.9')
            ELSE concat(' ', CAST(length(event_type) AS STRING), ' ') END AS category_id,
       CASE WHEN k = 9 THEN 'bad' WHEN k = 10 THEN NULL
            WHEN k < 40 THEN concat(substr(t, 1, 10), 'T', substr(t, 12, 8), '+02:00')
            ELSE concat(substr(t, 1, 10), 'T', substr(t, 12, 8), '.000Z') END AS publish_time,
       CASE WHEN k = 11 THEN NULL ELSE concat(event_type, '|', CAST(k AS STRING)) END AS tags,
       CASE WHEN k = 12 THEN 'not_a_number' WHEN k = 13 THEN '1e3' WHEN k = 14 THEN '1d'
            ELSE CAST(CAST(round(value * 100) AS BIGINT) AS STRING) END AS views,
       CASE WHEN k = 15 THEN '' WHEN k = 16 THEN '-3.7'
            ELSE CAST(k * 3 AS STRING) END AS likes,
       CASE WHEN k = 17 THEN 'inf' ELSE CAST(k AS STRING) END AS dislikes,
       CASE WHEN k = 18 THEN NULL ELSE concat(CAST(k AS STRING), '.5') END AS comment_count,
       CASE WHEN k < 30 THEN 'True' WHEN k < 60 THEN 'f' WHEN k < 80 THEN ' YES '
            WHEN k < 95 THEN 'maybe' ELSE NULL END AS comments_disabled,
       CASE WHEN k < 50 THEN '1' ELSE '0' END AS ratings_disabled,
       CASE WHEN k < 50 THEN 'no' ELSE 'y' END AS video_error_or_removed,
       CASE WHEN k < 90 THEN concat('said "', event_type, '" at ', t) ELSE NULL END
         AS description,
       'events' AS source_system
FROM (SELECT event_id, user_id, event_type, value, {_K} AS k, {_DAY} AS d,
             CAST(date_trunc('second', ts) AS STRING) AS t FROM {{events}}) e""",
    # Daily facts: part as item, supplier as group, line number as category.
    "facts": """
SELECT CAST(l_shipdate AS DATE) AS trending_date, l_partkey AS video_id,
       l_suppkey AS dim_channel_key, l_linenumber AS dim_category_id,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS views,
       CAST(round(l_quantity) AS BIGINT) AS likes
FROM {lineitem}""",
    "groups": "SELECT s_suppkey AS dim_channel_key, s_name AS channel_title FROM {supplier}",
    # Several nations share a region, so several category ids share a title.
    "categories": """
SELECT n_nationkey AS category_id, r_name AS category_title
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    # Daily facts of events: user as item, event type as category.
    "event_facts": f"""
SELECT CAST(ts AS DATE) AS trending_date, user_id AS video_id, event_type AS dim_category_id,
       CAST(round(value * 100) AS BIGINT) AS views, CAST({_K} AS BIGINT) AS likes
FROM {{events}}""",
    # State of each customer as its orders show it; the price is stored but not tracked.
    "states": """
SELECT o_custkey AS id, nullif(o_orderstatus, 'P') AS status, o_orderpriority AS priority,
       CAST(round(o_totalprice * 100) AS BIGINT) AS price, CAST(o_orderdate AS DATE) AS seen,
       o_orderkey AS seq
FROM {orders}""",
    # Typed items: part, ship date, supplier title and line number as category.
    "items": """
SELECT concat('P', CAST(l_partkey AS STRING)) AS video_id, CAST(l_shipdate AS DATE) AS trending_date,
       concat('Supplier#', lpad(CAST(l_suppkey AS STRING), 9, '0')) AS channel_title,
       l_linenumber AS category_id,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS views,
       CAST(round(l_quantity) AS BIGINT) AS likes,
       CAST(round(l_discount * 100) AS BIGINT) AS dislikes,
       CAST(round(l_tax * 100) AS BIGINT) AS comment_count,
       l_returnflag AS title, l_linestatus AS tags
FROM {lineitem}""",
    # Dimensions that miss members: small suppliers, large parts, categories beyond the regions.
    "known_channels": """
SELECT concat('S', CAST(s_suppkey AS STRING)) AS channel_id, s_name AS channel_title
FROM {supplier} WHERE s_acctbal >= 0""",
    "known_parts": """
SELECT concat('P', CAST(p_partkey AS STRING)) AS video_id, p_name AS title, p_brand AS tags
FROM {part} WHERE p_size <= 40""",
    "known_categories": "SELECT r_regionkey AS category_id, r_name AS category_title FROM {region}",
    # Two descriptions of customers as channels: orders of the upper and of the lower priorities; all are read.
    "channels_xml": """
SELECT CASE WHEN o_totalprice < 5000 THEN NULL
            ELSE concat(' ', CAST(o_custkey AS STRING), ' ') END AS channel_id,
       CASE WHEN o_orderstatus = 'F' THEN concat(' Customer ', CAST(o_custkey AS STRING))
            WHEN o_orderstatus = 'O' THEN NULL ELSE '' END AS channel_title,
       CAST(CAST(round(o_totalprice) AS BIGINT) AS STRING) AS subscriber_count,
       CASE WHEN o_totalprice < 200000 THEN 'DE ' ELSE NULL END AS country,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS last_updated,
       'urgent' AS source_system, o_orderkey AS row_seq
FROM {orders} WHERE o_orderpriority < '3'""",
    "channels_db": """
SELECT CASE WHEN o_totalprice < 5000 THEN 'nan' ELSE CAST(o_custkey AS STRING) END AS channel_id,
       concat('Low ', CAST(o_custkey AS STRING)) AS channel_title,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey AS STRING) END AS total_videos,
       CAST(o_totalprice AS STRING) AS total_views,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS last_updated,
       'low' AS source_system, o_orderkey AS row_seq
FROM {orders} WHERE o_orderpriority >= '3'""",
    # One ledger event per order: a customer's orders are the events of one run.
    "run_events": """
SELECT CAST(o_custkey AS STRING) AS run_id, 'orders' AS pipeline_name,
       o_orderdate AS execution_date,
       CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCESS' ELSE 'RUNNING' END AS status,
       o_orderkey AS event_time,
       CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS start_time,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS end_time,
       CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END
         AS records_inserted,
       CAST(0 AS BIGINT) AS records_updated,
       CASE WHEN o_orderpriority = '5-LOW' THEN CAST(floor(o_totalprice / 2) AS BIGINT) END
         AS records_rejected
FROM {orders}""",
}
