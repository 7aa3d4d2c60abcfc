"""Sources, landing and field parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from registry.base import feed, query, table
from tierline.functions import parse_bool, parse_feed_date, parse_int, parse_iso_timestamp
from tierline.model import Table
from tierline.operators.dedupe import flag_duplicates
from tierline.session import scratch_dir
from tierline.sinks import Warehouse
from tierline.sources import (
    all_strings,
    read_csv_bronze,
    read_csv_split,
    read_incremental,
    read_json_items,
    read_xml_bronze,
    with_lineage,
)
from tierline.sources.files import flatten_items

RUN_TS = dt.datetime(2024, 2, 1, 6, 0, 0)


@query(
    "bronze_csv_roundtrip",
    """
SELECT CAST(doc_id AS STRING) AS doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
       coalesce(source, '') AS source, coalesce(CAST(n_chars AS STRING), '') AS n_chars,
       'documents_csv' AS source_system, TIMESTAMP '2024-02-01 06:00:00' AS load_timestamp
FROM documents""",
)
def bronze_csv_roundtrip(spark, sf_dir):
    """Texts with quotes and line breaks, written as CSV files and landed as strings."""
    documents = table(spark, sf_dir, "documents")
    path = as_csv(documents)
    return with_lineage(read_csv_bronze(spark, path, documents.columns), "documents_csv", RUN_TS)


def as_csv(rows):
    """The rows as quoted CSV files with headers; returns their folder."""
    path = scratch_dir(rows.sparkSession, "csv")
    (
        rows.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _small_blocks(spark):
    """A session that cuts files into blocks of 128 kB, so that small tables have block borders in their fields."""
    session = spark.newSession()
    for name, value in (("maxPartitionBytes", "128k"), ("openCostInBytes", "16k")):
        session.conf.set(f"spark.sql.files.{name}", value)
    return session


@query(
    "csv_split_roundtrip",
    """
SELECT CAST(doc_id AS STRING) AS doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
       coalesce(source, '') AS source, coalesce(CAST(n_chars AS STRING), '') AS n_chars
FROM documents""",
)
def csv_split_roundtrip(spark, sf_dir):
    """The same texts, each file read by many tasks; block borders fall into quoted line breaks."""
    documents = table(spark, sf_dir, "documents")
    return read_csv_split(_small_blocks(spark), as_csv(documents), documents.columns)


@query(
    "csv_many_files_first_row",
    """
SELECT coalesce(video_id, '') AS video_id, coalesce(trending_date, '') AS trending_date, min(row_seq) AS row_seq
FROM {raw_items} r GROUP BY coalesce(video_id, ''), coalesce(trending_date, '')""",
)
def csv_many_files_first_row(spark, sf_dir):
    """Raw items in many files, read in blocks: of each id and date the first row by file and line stays (V3)."""
    raw = feed(spark, sf_dir, "raw_items").select("row_seq", "video_id", "trending_date", "title", "description")
    # Names of files follow the ranges, so that the place in the files is the order of the numbers.
    path = as_csv(raw.repartitionByRange(6, "row_seq").sortWithinPartitions("row_seq"))
    rows = read_csv_split(_small_blocks(spark), path, raw.columns, place="place")
    kept = flag_duplicates(rows, ["video_id", "trending_date"], ["place"], "place").where("NOT is_duplicate")
    return kept.select("video_id", "trending_date", F.col("row_seq").cast("bigint"))


@query(
    "bronze_xml_roundtrip",
    """
SELECT CAST(c_custkey AS STRING) AS c_custkey, c_name, CAST(c_nationkey AS STRING) AS c_nationkey,
       CAST(c_acctbal AS STRING) AS c_acctbal, nullif(c_mktsegment, 'FURNITURE') AS c_mktsegment
FROM customer""",
)
def bronze_xml_roundtrip(spark, sf_dir):
    """Customers as XML elements; one segment is written as an empty element."""
    path = scratch_dir(spark, "xml")
    customers = all_strings(table(spark, sf_dir, "customer")).withColumn(
        "c_mktsegment",
        F.when(F.col("c_mktsegment") == "FURNITURE", "").otherwise(F.col("c_mktsegment")),
    )
    (
        customers.write.format("xml")
        .option("rootTag", "channels")
        .option("rowTag", "channel")
        .save(path)
    )
    return read_xml_bronze(spark, path, "channel", customers.columns)


@query(
    "bronze_json_items",
    """
SELECT CAST(p_partkey AS STRING) AS category_id, p_name AS category_title FROM part
UNION ALL
SELECT p_brand, nullif(p_type, 'SMALL') FROM part WHERE p_type <> 'SMALL'""",
)
def bronze_json_items(spark, sf_dir):
    """One document per part with four items, two of which lack an id or a title."""
    path = scratch_dir(spark, "json")

    def item(key, title):
        return F.struct(key.alias("id"), F.struct(title.alias("title")).alias("snippet"))

    title = F.when(F.col("p_type") != "SMALL", F.col("p_type"))
    table(spark, sf_dir, "part").select(
        F.lit("list").alias("kind"),
        F.array(
            item(F.col("p_partkey").cast("string"), F.col("p_name")),
            item(F.lit(""), F.col("p_name")),
            item(F.col("p_name"), F.lit("")),
            item(F.col("p_brand"), title),
        ).alias("items"),
    ).write.json(path)
    return read_json_items(spark, path, multi_line=False)


@query(
    "bronze_json_documents",
    """
SELECT CAST(event_id AS STRING) AS category_id,
       regexp_extract(props, '([0-9]+)', 1) AS category_title FROM events""",
)
def bronze_json_documents(spark, sf_dir):
    """JSON text in a column: field access on the parsed value, then the same flattening."""
    parsed = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int").alias("p")
    )
    entry = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(F.col("p.k").cast("string").alias("title")).alias("snippet"),
    )
    return flatten_items(parsed.select(F.array(entry).alias("items")))


@query(
    "incremental_watermark",
    """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup')""",
)
def incremental_watermark(spark, sf_dir):
    """Events newer than all sign-ups already landed as text."""
    source = table(spark, sf_dir, "events")
    landed = all_strings(source.where(F.col("event_type") == "signup"))
    return read_incremental(source, landed, "ts")


@query(
    "incremental_load",
    """
SELECT CAST(o_orderkey AS STRING) AS o_orderkey, CAST(o_totalprice AS STRING) AS o_totalprice,
       CAST(o_orderdate AS STRING) AS o_orderdate, 'orders_db' AS source_system
FROM orders""",
)
def incremental_load(spark, sf_dir):
    """Two loads of a growing source: the second one lands what the first did not see."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    tables = {
        "bronze.orders": Table(
            "append",
            with_lineage(all_strings(orders), "orders_db", RUN_TS).schema,
        )
    }
    wh = Warehouse(spark, scratch_dir(spark, "incremental"), tables)
    wh.create()
    middle = dt.datetime(1998, 6, 1)
    for source in (orders.where(F.col("o_orderdate") < F.lit(middle).cast("timestamp_ntz")), orders):
        new = read_incremental(source, wh.read("bronze.orders"), "o_orderdate")
        wh.write_append("bronze.orders", with_lineage(all_strings(new), "orders_db", RUN_TS))
    return wh.read("bronze.orders").drop("load_timestamp")


@query(
    "incremental_inclusive",
    """
SELECT CAST(o_orderkey AS STRING) AS o_orderkey, CAST(o_totalprice AS STRING) AS o_totalprice,
       CAST(o_orderdate AS STRING) AS o_orderdate, 'orders_db' AS source_system
FROM orders""",
)
def incremental_inclusive(spark, sf_dir):
    """A first load sees half of its last day; the second lands the other half, the third finds nothing new."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    landed = with_lineage(all_strings(orders), "orders_db", RUN_TS)
    wh = Warehouse(spark, scratch_dir(spark, "inclusive"), {"bronze.orders": Table("append", landed.schema)})
    wh.create()
    day = F.lit(dt.datetime(1998, 6, 1)).cast("timestamp_ntz")
    half = (F.col("o_orderdate") == day) & (F.col("o_orderkey") % 2 == 0)
    for source in (orders.where((F.col("o_orderdate") < day) | half), orders, orders):
        new = read_incremental(source, wh.read("bronze.orders"), "o_orderdate", keys=["o_orderkey"])
        wh.write_append("bronze.orders", with_lineage(all_strings(new), "orders_db", RUN_TS))
    return wh.read("bronze.orders").drop("load_timestamp")


@query(
    "replace_day_partition",
    """
SELECT event_id, event_type,
       CASE WHEN CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) THEN value + 1
            ELSE value END AS value,
       CAST(ts AS DATE) AS ingestion_date
FROM events""",
)
def replace_day_partition(spark, sf_dir):
    """All days landed, then the last one landed again with new values."""
    days = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.col("ts").cast("date").alias("ingestion_date")
    )
    tables = {"bronze.events": Table("daily", days.schema, ("ingestion_date",))}
    wh = Warehouse(spark, scratch_dir(spark, "daily"), tables)
    wh.write_dates("bronze.events", days, days.select("ingestion_date"))
    last = days.agg(F.max("ingestion_date")).first()[0]
    again = days.where(F.col("ingestion_date") == F.lit(last)).withColumn("value", F.col("value") + 1)
    wh.write_replace_partition("bronze.events", again, last)
    return wh.read("bronze.events")


def _landed_days(spark, sf_dir):
    """All events in a table by day, the events and their last day."""
    days = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.col("ts").cast("date").alias("ingestion_date")
    )
    wh = Warehouse(
        spark, scratch_dir(spark, "days"), {"bronze.events": Table("daily", days.schema, ("ingestion_date",))}
    )
    every = days.select("ingestion_date")
    wh.write_dates("bronze.events", days, every)
    return wh, days, days.agg(F.max("ingestion_date")).first()[0]


@query(
    "failed_day_keeps_rows",
    "SELECT event_id, event_type, value, CAST(ts AS DATE) AS ingestion_date FROM events",
)
def failed_day_keeps_rows(spark, sf_dir):
    """All days landed; landing the last one again fails in its last row and changes nothing."""
    wh, days, last = _landed_days(spark, sf_dir)
    bad = F.when(F.col("event_id") >= 0, F.raise_error(F.lit("bad row")).cast("double"))
    again = days.where(F.col("ingestion_date") == F.lit(last)).withColumn("value", bad)
    try:
        wh.write_replace_partition("bronze.events", again, last)
    except Exception as e:  # noqa: BLE001
        if "bad row" not in str(e):
            raise
        return wh.read("bronze.events")
    raise AssertionError("the write was expected to fail")


@query(
    "fact_dates_replaced",
    """
SELECT event_id, event_type, CASE WHEN day >= middle THEN value + 1 ELSE value END AS value, day AS ingestion_date
FROM (SELECT *, CAST(ts AS DATE) AS day FROM events) e,
     (SELECT max(CAST(ts AS DATE)) AS last, min(CAST(ts AS DATE)) + 3 AS middle FROM events) b
WHERE day < last""",
)
def fact_dates_replaced(spark, sf_dir):
    """All days loaded, then those from the fourth on again with new values; the last has no rows any more."""
    wh, days, last = _landed_days(spark, sf_dir)
    middle = days.agg(F.min("ingestion_date") + F.expr("INTERVAL 3 DAYS")).first()[0]
    later = days.where(F.col("ingestion_date") >= F.lit(middle))
    new = later.where(F.col("ingestion_date") < F.lit(last)).withColumn("value", F.col("value") + 1)
    wh.write_dates("bronze.events", new, later.select("ingestion_date"))
    return wh.read("bronze.events")


@query(
    "repeated_run_rejects",
    """
SELECT event_type AS rejection_reason, 'run:2' AS run_id, count(*) AS n FROM events GROUP BY event_type""",
)
def repeated_run_rejects(spark, sf_dir):
    """Two runs reject all events; the first is repeated without rejects, and its old ones go."""
    wh = Warehouse(spark, scratch_dir(spark, "rejects"))
    wh.create()
    rejects = table(spark, sf_dir, "events").select(
        F.col("props").alias("raw_record_json"),
        F.col("event_type").alias("rejection_reason"),
        F.col("ts").cast("timestamp_ntz").alias("rejected_at"),
    )
    for run_id, rows in (("run:1", rejects), ("run:2", rejects), ("run:1", rejects.limit(0))):
        wh.write_run("silver.rejected_records", rows, run_id=run_id, table_name="events")
    seen = wh.read("silver.rejected_records")
    return seen.groupBy("rejection_reason", "run_id").agg(F.count(F.lit(1)).alias("n"))


_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
_NUMBER_TEXT = f"""
CASE WHEN {_K} < 5 THEN NULL WHEN {_K} < 10 THEN '' WHEN {_K} < 15 THEN 'nan'
     WHEN {_K} < 20 THEN 'inf' WHEN {_K} < 25 THEN '1d' WHEN {_K} < 30 THEN '0x1p3'
     WHEN {_K} < 35 THEN 'abc' WHEN {_K} < 40 THEN '1e3' WHEN {_K} < 45 THEN '.5'
     WHEN {_K} < 50 THEN '5.' WHEN {_K} < 60 THEN concat('-', CAST(value AS STRING))
     WHEN {_K} < 70 THEN concat('  ', CAST(value AS STRING), ' ')
     WHEN {_K} < 75 THEN '1e30' WHEN {_K} < 80 THEN '- 5'
     ELSE CAST(user_id AS STRING) END"""


@query(
    "parse_int_cases",
    f"""
SELECT event_id, text, CASE
         WHEN regexp_full_match(trim(text), '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?')
         THEN TRY_CAST(trunc(TRY_CAST(trim(text) AS DOUBLE)) AS BIGINT) END AS parsed
FROM (SELECT event_id, {_NUMBER_TEXT} AS text FROM events) t""",
)
def parse_int_cases(spark, sf_dir):
    texts = table(spark, sf_dir, "events").select("event_id", F.expr(_NUMBER_TEXT).alias("text"))
    return texts.withColumn("parsed", parse_int(F.col("text")))


_FLAG_TEXT = f"""
CASE WHEN {_K} < 10 THEN 'True' WHEN {_K} < 20 THEN ' t' WHEN {_K} < 30 THEN '1'
     WHEN {_K} < 40 THEN 'YES ' WHEN {_K} < 50 THEN 'FALSE' WHEN {_K} < 60 THEN 'f'
     WHEN {_K} < 65 THEN '0' WHEN {_K} < 70 THEN 'No' WHEN {_K} < 75 THEN 'y'
     WHEN {_K} < 80 THEN 'n' WHEN {_K} < 85 THEN '' WHEN {_K} < 90 THEN NULL
     ELSE event_type END"""


@query(
    "parse_bool_cases",
    f"""
SELECT event_id, text,
       CASE WHEN lower(trim(text)) IN ('true', 't', '1', 'yes') THEN true
            WHEN lower(trim(text)) IN ('false', 'f', '0', 'no') THEN false END AS parsed
FROM (SELECT event_id, {_FLAG_TEXT} AS text FROM events) t""",
)
def parse_bool_cases(spark, sf_dir):
    texts = table(spark, sf_dir, "events").select("event_id", F.expr(_FLAG_TEXT).alias("text"))
    return texts.withColumn("parsed", parse_bool(F.col("text")))


_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
# Status P gives days without leading zeros, F the century rule, O impossible days among good ones.
_DATE_TEXT = f"""
CASE WHEN o_orderpriority = '5-LOW'
     THEN concat(substr({_DAY}, 3, 2), '.31.', substr({_DAY}, 6, 2))
     WHEN o_orderstatus = 'P'
     THEN concat(substr({_DAY}, 3, 2), '.', CAST(CAST(substr({_DAY}, 9, 2) AS INT) AS STRING), '.',
                 CAST(CAST(substr({_DAY}, 6, 2) AS INT) AS STRING))
     WHEN o_orderstatus = 'F'
     THEN concat(' ', substr(CAST(o_orderkey + 100 AS STRING), 2, 2), '.', substr({_DAY}, 9, 2), '.',
                 substr({_DAY}, 6, 2), ' ')
     ELSE concat(substr({_DAY}, 1, 4), '.', substr({_DAY}, 9, 2), '.', substr({_DAY}, 6, 2)) END"""


@query(
    "parse_feed_date",
    f"""
SELECT o_orderkey, text, CASE
         WHEN regexp_full_match(trim(text), '[0-9][0-9][.][0-9][0-9]?[.][0-9][0-9]?')
         THEN TRY_CAST(concat(CASE WHEN substr(trim(text), 1, 2) >= '69' THEN '19' ELSE '20' END,
                              substr(trim(text), 1, 2), '-', split_part(trim(text), '.', 3), '-',
                              split_part(trim(text), '.', 2)) AS DATE) END AS parsed
FROM (SELECT o_orderkey, {_DATE_TEXT} AS text FROM orders) t""",
)
def parse_feed_dates(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_DATE_TEXT).alias("text"))
    return texts.withColumn("parsed", parse_feed_date(F.col("text")))


_SECOND = "CAST(date_trunc('second', ts) AS STRING)"
_TIME_TEXT = f"""
CASE WHEN {_K} < 20 THEN concat(substr({_SECOND}, 1, 10), 'T', substr({_SECOND}, 12, 8), '.000Z')
     WHEN {_K} < 40 THEN concat(' ', substr({_SECOND}, 1, 10), 'T', substr({_SECOND}, 12, 8), '+02:00')
     WHEN {_K} < 60 THEN {_SECOND} WHEN {_K} < 80 THEN substr({_SECOND}, 1, 10)
     WHEN {_K} < 85 THEN 'bad' WHEN {_K} < 90 THEN '' WHEN {_K} < 95 THEN NULL
     ELSE substr({_SECOND}, 12, 8) END"""


@query(
    "parse_iso_ts",
    f"""
SELECT event_id, text,
       CASE WHEN k < 20 OR (k >= 40 AND k < 60) THEN date_trunc('second', ts)
            WHEN k < 40 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
            WHEN k < 80 THEN date_trunc('day', ts) END AS parsed
FROM (SELECT event_id, ts, {_K} AS k, {_TIME_TEXT} AS text FROM events) t""",
)
def parse_iso_ts(spark, sf_dir):
    texts = table(spark, sf_dir, "events").select("event_id", F.expr(_TIME_TEXT).alias("text"))
    return texts.withColumn("parsed", parse_iso_timestamp(F.col("text")))
