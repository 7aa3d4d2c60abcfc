import json
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import as_dicts
from tierline import model
from tierline.operators.dedupe import flag_duplicates, latest_per_key, repeated_keys
from tierline.operators.validate import REASON, counted, split
from tierline.plans import silver

RAW = ", ".join(f"{c} string" for c in model.ITEM_FEED) + ", source_system string, row_seq bigint"
GOOD = {
    "video_id": "v1", "trending_date": "17.14.11", "title": " T ", "channel_title": "C", "category_id": "22",
    "publish_time": "2017-11-13T17:13:01.000Z", "tags": None, "views": "100", "likes": "10.9", "dislikes": "0",
    "comment_count": "3", "thumbnail_link": None, "comments_disabled": "True", "ratings_disabled": "x",
    "video_error_or_removed": None, "description": None, "source_system": "s",
}


def raw(frame, *changes):
    rows = [tuple((GOOD | c)[k] for k in (*model.ITEM_FEED, "source_system")) + (i,) for i, c in enumerate(changes)]
    return frame(RAW, rows)


def reasons(df, **kw):
    classified = silver.classify_items(df, ["row_seq"], "row_seq", **kw)
    return [r[0] for r in classified.orderBy("row_seq").select(REASON).collect()]


def test_injected_dirty_rows(frame):
    dirty = raw(
        frame,
        {"video_id": None},
        {"video_id": "dirty_vid_01", "trending_date": "corrupted_date"},
        {"video_id": "dirty_vid_02", "views": "not_a_number"},
        {"video_id": "dirty_vid_03", "category_id": "not_int_cat"},
        {},
    )
    assert reasons(dirty) == [
        "MISSING_VIDEO_ID", "INVALID_DATE_FORMATS", "INVALID_METRIC_DATATYPES",
        "INVALID_CATEGORY_ID_DATATYPE: 'not_int_cat'", None]


def test_first_failure_wins_and_every_metric_counts(frame):
    rows = raw(
        frame,
        {"video_id": " nan ", "trending_date": None},
        {"video_id": "a", "trending_date": " ", "category_id": "x"},
        {"video_id": "b", "category_id": None, "views": "x"},
        *[{"video_id": m, m: None, "publish_time": "bad"} for m in silver.METRICS],
        {"video_id": "c", "publish_time": ""},
        {"video_id": "d", "category_id": "3000000000"},
    )
    assert reasons(rows) == [
        "MISSING_VIDEO_ID", "MISSING_TRENDING_DATE", "INVALID_CATEGORY_ID_DATATYPE: ''",
        *["INVALID_METRIC_DATATYPES"] * 4, "INVALID_DATE_FORMATS",
        "INVALID_CATEGORY_ID_DATATYPE: '3000000000'"]


def test_duplicates_are_judged_on_raw_keys_over_all_rows(frame):
    rows = raw(frame, {"views": "bad"}, {}, {"video_id": " v1"}, {"trending_date": "17.15.11"}, {})
    d = "DUPLICATE_VIDEO_ID_AND_TRENDING_DATE"
    assert reasons(rows) == ["INVALID_METRIC_DATATYPES", d, None, None, d]
    assert reasons(rows, keep="last") == [d, d, None, None, None]


def test_typed_items(frame):
    df = raw(frame, {}, {"video_id": None})
    classified, seen = counted(silver.classify_items(df, ["row_seq"], "row_seq"))
    (row,) = as_dicts(silver.typed_items(classified, "2024-01-01 00:00:00"))
    assert seen.get == {"valid": 1, "rejected": 1}
    assert (row["title"], row["tags"], row["description"]) == ("T", "", "")
    assert (row["likes"], row["comments_disabled"], row["ratings_disabled"]) == (10, True, False)
    assert str(row["trending_date"]) == "2017-11-14" and str(row["publish_time"]) == "2017-11-13 17:13:01"
    valid, rejected = split(classified)
    assert valid.count() + rejected.count() == 2
    payload = json.loads(rejected.select(silver.item_payload()).first()[0])
    assert payload == GOOD | {"video_id": None}


def test_hot_key_of_a_third_of_all_rows(spark):
    n = 30000
    df = spark.range(n).select(
        F.col("id").alias("row_seq"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")
    )
    flagged = flag_duplicates(df, ["k"], ["row_seq"], "row_seq")
    assert flagged.count() == n
    assert flagged.where("is_duplicate").count() == n // 3 - 1
    # Before the shuffle each task holds one row per key.
    plan = repeated_keys(df, ["k"], ["row_seq"], "row_seq")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_hot_key_in_a_shuffled_join_is_split(spark, tmp_path):
    """With copies too many to broadcast the join splits the hot key and stays exact."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000)
        wide = F.sha2(F.col("id").cast("string"), 512).alias("wide")
        df = spark.range(0, 30000, 1, 8).select(F.col("id").alias("row_seq"), hot.alias("k"), wide)
        copies = 30000 - df.select("k").distinct().count()
        salted = flag_duplicates(df, ["k"], ["row_seq"], "row_seq")
        assert salted.where("is_duplicate").count() == copies
        repeated_keys(df, ["k"], ["row_seq"], "row_seq").write.parquet(str(tmp_path / "repeated"))
        stored = spark.read.parquet(str(tmp_path / "repeated"))
        split = flag_duplicates(df, ["k"], ["row_seq"], "row_seq", repeated=stored)
        assert split.where("is_duplicate").count() == copies
        split.collect()
        assert "skew=true" in split._jdf.queryExecution().executedPlan().toString()
        tasks = Counter(r.task for r in salted.withColumn("task", F.spark_partition_id()).collect())
        assert max(tasks.values()) < 10000  # no task holds the whole hot key
        assert salted.columns == split.columns == ["row_seq", "k", "wide", "is_duplicate"]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_null_keys_equal_each_other(frame):
    df = frame("a string, b string, i int", [(None, "x", 1), (None, "x", 2), (None, None, 3), (None, None, 4)])
    rows = flag_duplicates(df, ["a", "b"], ["i"], "i").orderBy("i").collect()
    assert [r.is_duplicate for r in rows] == [False, True, False, True]


def test_latest_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    latest = latest_per_key(df, ["k"], [F.desc("id")])
    assert sorted(r.id for r in latest.collect()) == [997, 998, 999]
    assert "WindowGroupLimit" in latest._jdf.queryExecution().executedPlan().toString()


def test_categories(frame):
    df = frame(
        "category_id string, category_title string, source_system string, row_seq bigint",
        [("1", " ", "s", 0), ("1.0", "One ", "s", 1), ("1", "Uno", "s", 2), ("x", "X", "s", 3), (None, "N", "s", 4),
         ("2", None, "s", 5), ("34", "One", "s", 6)],
    )
    classified = silver.classify_categories(df, [], "row_seq")
    got = [r[0] for r in classified.orderBy("row_seq").select(REASON).collect()]
    bad = "INVALID_OR_MISSING_CATEGORY_ID"
    assert got == ["MISSING_CATEGORY_TITLE", None, "DUPLICATE_CATEGORY_ID", bad, bad, "MISSING_CATEGORY_TITLE", None]
    typed = silver.typed_categories(classified, "2024-01-01 00:00:00").orderBy("category_id").collect()
    assert [(r.category_id, r.category_title) for r in typed] == [(1, "One"), (34, "One")]


XML = "channel_id string, channel_title string, subscriber_count string, country string, last_updated string, source_system string"
DB = "channel_id string, channel_title string, total_videos string, total_views string, last_updated string, source_system string"


def test_channels(frame):
    xml = frame(XML, [
        (" both ", "A", "5", None, "2026-01-01", "x"), ("xml", None, "x", " DE ", "2026-01-01", "x"),
        ("blank", "", "1", "DE", "2026-01-01", "x"), (None, "n1", "1", "DE", "2026-01-01", "x"),
        (None, "n2", "1", "DE", "2026-01-01", "x"), ("both", "old", "4", "US", "2025-01-01", "x")])
    db = frame(DB, [
        ("both", "B", "7", "8.9", "2026-01-01", "d"), ("db", " D ", None, "9", "2026-01-01", "d"),
        ("blank", "B", "1", "1", "2026-01-01", "d"), ("nan", "n3", "1", "1", "2026-01-01", "d")])
    newest = [F.desc("last_updated")]
    classified = silver.classify_channels(silver.latest_channels(xml, newest), silver.latest_channels(db, newest))
    typed = {r["channel_id"]: r for r in as_dicts(silver.typed_channels(classified, "2024-01-01 00:00:00"))}
    assert set(typed) == {"both", "db"}
    both, only_db = typed["both"], typed["db"]
    assert (both["channel_title"], both["subscriber_count"], both["country"]) == ("A", 5, "Unknown")
    assert (both["total_videos"], both["total_views"]) == (7, 8)
    assert (only_db["channel_title"], only_db["subscriber_count"], only_db["total_videos"]) == ("D", None, None)
    rejected = classified.where(F.col(REASON).isNotNull())
    got = sorted((r[0] or "", r[1]) for r in rejected.select("channel_id", REASON).collect())
    # Rows without an id stay single: 2 + 1 of them, not 2 * 1 pairs.
    assert got == [("", "MISSING_CHANNEL_ID")] * 2 + [
        ("blank", "MISSING_CHANNEL_TITLE"), ("nan", "MISSING_CHANNEL_ID"), ("xml", "MISSING_CHANNEL_TITLE")]
    payloads = [json.loads(r[0]) for r in rejected.where("channel_id = 'xml'").select(silver.channel_payload(classified)).collect()]
    assert payloads == [{"channel_id": "xml", "subscriber_count": "x", "country": " DE ",
                         "last_updated_xml": "2026-01-01", "source_system_xml": "x"}]
