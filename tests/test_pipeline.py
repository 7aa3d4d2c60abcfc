"""Whole runs over small feeds: two days, repeated runs, late members and failures."""

import csv
import dataclasses
import datetime as dt
import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_dicts
from tierline import model, session
from tierline.plans import ledger, mart_states, marts
from tierline.plans.adhoc import query
from tierline.plans.pipeline import Feeds, Pipeline, run_pipeline
from tierline.sinks import Warehouse, manifest
from tierline.sinks.manifest import KEEP_LISTS, Files, Manifest, values_of

DAY1 = dt.datetime(2026, 8, 19, 6, 0)
DAY2 = dt.datetime(2026, 8, 20, 6, 0)


def item(video_id, date, **changes):
    base = {
        "video_id": video_id, "trending_date": date, "title": f"Title {video_id}", "channel_title": "Alpha",
        "category_id": "23", "publish_time": "2017-11-13T17:13:01.000Z", "tags": 'a|"b"', "views": "100",
        "likes": "10", "dislikes": "1", "comment_count": "2", "thumbnail_link": "http://x",
        "comments_disabled": "False", "ratings_disabled": "False", "video_error_or_removed": "False",
        "description": "two\nlines",
    }
    return base | changes


def write_csv(path, items):
    with open(path, "w", newline="") as f:
        out = csv.DictWriter(f, model.ITEM_FEED)
        out.writeheader()
        out.writerows(items)
    return str(path)


@pytest.fixture
def feeds(tmp_path, frame):
    categories = {"items": [{"id": i, "snippet": {"title": t}} for i, t in (("10", "Music"), ("23", "Comedy"), ("34", "Comedy"))]}
    (tmp_path / "c.json").write_text(json.dumps(categories, indent=1))
    channel = (
        "<channel><channel_id>{}</channel_id><channel_title>{}</channel_title><subscriber_count>{}</subscriber_count>"
        "<country>{}</country><last_updated>2026-08-19T00:00:00</last_updated></channel>"
    )

    def make(day, items, channels=(("UC1", "Alpha", 5, "DE"), ("UC2", "", 7, "US")), extra=(("UC1", "Alfa", 3, 30, DAY1),)):
        xml = tmp_path / f"{day}.xml"
        xml.write_text("<channels>" + "".join(channel.format(*c) for c in channels) + "</channels>")
        table = frame("channel_id string, channel_title string, total_videos int, total_views bigint, last_updated timestamp_ntz", list(extra))
        return Feeds(write_csv(tmp_path / f"{day}.csv", items), str(tmp_path / "c.json"), str(xml), table)

    return make


ITEMS1 = [
    item("v1", "26.18.08", views="100"),
    item("v1", "26.18.08", views="999"),
    item("v1", "26.19.08", views="200"),
    item("v2", "26.18.08", views="50", category_id="34", channel_title="Beta"),
    item("v3", "26.19.08", views="30", category_id="99"),
    item("v4", "26.18.08", channel_title=""),
    item("", "26.18.08"),
    item("d1", "corrupted_date"),
    item("d2", "26.18.08", views="not_a_number"),
    item("d3", "26.18.08", category_id="not_int_cat"),
]

MARTS = ("gold.channel_performance_mart", "gold.trending_kpi_summary_mart", "gold.trending_trends_mart")


def content(wh, name):
    df = wh.read(name)
    return sorted(str(r) for r in df.drop("load_timestamp", "row_seq").collect())


def invariants(wh):
    for name, key in (("gold.dim_video", "video_id"), ("gold.dim_channel", "channel_id")):
        dim = wh.read(name)
        bad = dim.groupBy(key).agg(
            F.count_if("is_current").alias("open"), F.max("version_number").alias("top"), F.count("*").alias("n"),
            F.count_distinct("version_number").alias("distinct"))
        assert bad.where("open > 1 OR top <> n OR n <> distinct").count() == 0
        assert wh.current(name).groupBy("channel_title").count().where("count > 1").count() == 0 or key == "video_id"
    fact = wh.read("gold.fact_video_metrics")
    assert fact.groupBy("video_id", "trending_date").count().where("count > 1").count() == 0
    for name, key in (("gold.dim_video", "dim_video_key"), ("gold.dim_channel", "dim_channel_key")):
        assert fact.join(wh.read(name), key, "left_anti").count() == 0


def test_two_days(spark, tmp_path, feeds):
    root = str(tmp_path / "wh")
    wh = Warehouse(spark, root)
    counts = run_pipeline(spark, root, feeds(1, ITEMS1), "manual__2026-08-19T06:00:00+00:00", DAY1)
    # 5 items, 3 categories and 1 channel are valid; 5 items and the untitled channel are not.
    assert counts == {"inserted": 9, "updated": 0, "rejected": 6}
    reasons = wh.read("silver.rejected_records").groupBy("table_name", "rejection_reason").count().collect()
    assert {(r[0], r[1]): r[2] for r in reasons} == {
        ("raw_videos", "DUPLICATE_VIDEO_ID_AND_TRENDING_DATE"): 1, ("raw_videos", "MISSING_VIDEO_ID"): 1,
        ("raw_videos", "INVALID_DATE_FORMATS"): 1, ("raw_videos", "INVALID_METRIC_DATATYPES"): 1,
        ("raw_videos", "INVALID_CATEGORY_ID_DATATYPE: 'not_int_cat'"): 1,
        ("consolidated_channels", "MISSING_CHANNEL_TITLE"): 1}
    assert wh.read("bronze.raw_videos").count() == 10
    assert wh.read("silver.videos").where("video_id = 'v1'").first().description == "two\nlines"
    titles = {r.channel_title: r.channel_id for r in wh.current("gold.dim_channel").collect()}
    assert titles["Alpha"] == "UC1" and titles["Beta"].startswith("inferred_") and len(titles) == 2
    assert wh.read("gold.dim_category").where("category_id = 99").first().category_title == "Inferred Category 99"
    # The item without a group has no member to join and drops out.
    assert wh.read("gold.fact_video_metrics").count() == 4
    kpi = {str(r["trending_date"]): r for r in as_dicts(wh.read("gold.trending_kpi_summary_mart"))}
    assert (kpi["2026-08-18"]["total_views"], kpi["2026-08-18"]["most_trending_category"]) == (150, "Comedy")
    assert (kpi["2026-08-19"]["total_views"], kpi["2026-08-19"]["total_trending_videos"]) == (230, 2)
    trends = wh.read("gold.trending_trends_mart").orderBy("trending_date").collect()
    assert [str(r.pct_change_day_over_day) for r in trends] == ["0.00", "53.33"]
    invariants(wh)

    # Validation repeated within the run replaces its rejects and rows.
    gold = [n for n in model.TABLES if n.startswith(("gold", "silver", "bronze"))]
    before = {n: content(wh, n) for n in gold}
    again = feeds(1, ITEMS1)
    Pipeline(spark, wh, "manual__2026-08-19T06:00:00+00:00", DAY1).clean_items()
    for n in ("silver.rejected_records", "silver.videos"):
        assert content(wh, n) == before[n], n

    # The same day once more under a new run changes nothing but adds its rejects.
    run_pipeline(spark, root, again, "later", DAY1 + dt.timedelta(hours=1))
    for n in gold:
        if n != "silver.rejected_records":
            assert content(wh, n) == before[n], n
    assert wh.read("silver.rejected_records").count() == 12

    # Next day: a changed title, a real channel for an inferred one, a corrected date with fewer
    # rows, and a newer extract row.
    day2 = feeds(
        2,
        [item("v1", "26.19.08", views="250", title="New title"), item("v5", "26.20.08", views="500", channel_title="Beta")],
        channels=(("UC1", "Alpha", 6, "DE"), ("UC3", "Beta", 1, "FR")),
        extra=(("UC1", "Alfa", 3, 30, DAY1), ("UC3", "Beta", 9, 90, DAY2)),
    )
    counts = run_pipeline(spark, root, day2, "day2", DAY2)
    assert wh.read("bronze.raw_channels_extra").count() == 2  # only the newer row was read
    assert wh.read("bronze.raw_videos").count() == 12
    versions = wh.read("gold.dim_video").where("video_id = 'v1'").orderBy("version_number").collect()
    assert [(r.title, r.version_number, r.is_current) for r in versions] == [("Title v1", 1, False), ("New title", 2, True)]
    assert versions[0].effective_end_date == versions[1].effective_start_date == DAY2
    alpha = wh.read("gold.dim_channel").where("channel_id = 'UC1'").orderBy("version_number").collect()
    assert [(r.subscriber_count, r.is_current) for r in alpha] == [(5, False), (6, True)]
    titles = [(r.channel_title, r.channel_id) for r in wh.current("gold.dim_channel").collect()]
    assert sorted(titles) == [("Alpha", "UC1"), ("Beta", "UC3")]
    fact = {(r.video_id, str(r.trending_date)): r.views for r in wh.read("gold.fact_video_metrics").collect()}
    assert fact == {("v1", "2026-08-18"): 100, ("v2", "2026-08-18"): 50, ("v1", "2026-08-19"): 250,
                    ("v3", "2026-08-19"): 30, ("v5", "2026-08-20"): 500}
    mart = {r.channel_title: r for r in wh.read("gold.channel_performance_mart").collect()}
    # Facts of the retired inferred member and of the real one count under their common title.
    assert (mart["Beta"].total_trending_videos, mart["Beta"].total_views) == (2, 550)
    assert (mart["Alpha"].total_trending_videos, mart["Alpha"].total_views) == (2, 380)
    invariants(wh)

    runs = {r["run_id"]: r for r in as_dicts(wh.read(ledger.RUNS))}
    assert runs["day2"]["status"] == "SUCCESS" and runs["day2"]["records_updated"] == counts["updated"] == 3
    steps = [r.step_name for r in wh.read(ledger.AUDIT).where("run_id = 'day2' AND status = 'COMPLETED'").orderBy("log_id").collect()]
    assert steps == ["ingest_csv", "ingest_json", "ingest_xml", "ingest_db", "validate_clean_videos", "validate_clean_categories",
                     "validate_clean_channels", "check_channel_titles", "scd1_categories", "scd2_videos", "scd2_channels", "load_fact_table",
                     "mart_states", "channel_performance_mart", "trending_kpi_summary_mart", "trending_trends_mart"]

    wh.register()
    listed = query(spark, "SELECT video_id, version_number FROM dim_video WHERE is_current ORDER BY video_id").collect()
    assert [tuple(r) for r in listed] == [("v1", 2), ("v2", 1), ("v3", 1), ("v4", 1), ("v5", 1)]
    assert query(spark, "SELECT count(*) AS n FROM silver.videos v JOIN categories c USING (category_id)").first().n == 6

    # All landed days validated together: a day's copy of an earlier row is a duplicate.
    full = Pipeline(spark, wh, "full", DAY2 + dt.timedelta(days=1), full=True)
    full.clean_items()
    loaded = wh.read("silver.videos").where("load_date = '2026-08-21'")
    assert {(r.video_id, str(r.trending_date), r.views) for r in loaded.collect()} == {
        ("v1", "2026-08-18", 100), ("v1", "2026-08-19", 200), ("v2", "2026-08-18", 50), ("v3", "2026-08-19", 30),
        ("v4", "2026-08-18", 100), ("v5", "2026-08-20", 500)}


def test_duplicates_across_loads(spark, tmp_path, feeds):
    """Daily runs that know earlier keys keep what one run over all days keeps, also when a day is repeated."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create()
    days = {
        DAY1: [item("v1", "26.18.08"), item("v1", "26.19.08", views="bad"), item("", "26.18.08")],
        DAY2: [item("v1", "26.18.08", views="7"), item("v1", "26.19.08"), item(" v1", "26.19.08", views="8"), item("", "26.18.08"),
               *[item("v2", "26.20.08", views=str(n)) for n in range(40)]],
    }

    def daily(day):
        run = Pipeline(spark, wh, f"daily-{day.day}", day, across_loads=True)
        run.land_items(feeds(day.day, days[day]))
        run.clean_items()

    def kept(*loads):
        rows = wh.read("silver.videos", {"load_date": [d.date() for d in loads]})
        return sorted((r.video_id, str(r.trending_date), r.views) for r in rows.collect())

    for day in (DAY1, DAY2, DAY2, DAY1):
        daily(day)
    # A rejected row makes later ones duplicates as well; keys are compared as the feed spells them.
    assert kept(DAY1) == [("v1", "2026-08-18", 100)]
    assert kept(DAY2) == [("v1", "2026-08-19", 8), ("v2", "2026-08-20", 0)]
    last = DAY2 + dt.timedelta(days=1)
    Pipeline(spark, wh, "full", last, full=True).clean_items()
    assert kept(last) == sorted(kept(DAY1) + kept(DAY2))
    rejects = wh.read("silver.rejected_records").where("rejection_reason LIKE 'DUPLICATE%'").groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in rejects} == {"daily-20": 41, "full": 41}
    # Each key of a day once, in one folder per date.
    assert wh.read("silver.item_keys").count() == 3 + 5
    assert len(wh.partitions("silver.item_keys", {"load_date": [DAY2.date()]})) <= 3


def test_failed_run_is_recorded(spark, tmp_path, feeds):
    root = str(tmp_path / "wh")
    shared = feeds(1, ITEMS1, channels=(("UC1", "Alpha", 5, "DE"), ("UC9", "Alpha", 7, "US")))
    with pytest.raises(ValueError, match="share a title"):
        run_pipeline(spark, root, shared, "bad", DAY1)
    wh = Warehouse(spark, root)
    (run,) = as_dicts(wh.read(ledger.RUNS))
    assert run["status"] == "FAILED"
    (line,) = as_dicts(wh.read(ledger.AUDIT).where("status = 'FAILED'"))
    assert line["step_name"] == "check_channel_titles" and "Alpha" in line["log_message"]
    assert not any(wh.version(n) for n in model.TABLES if n.startswith("gold"))
    run_pipeline(spark, root, shared, "first", DAY1, on_shared_title="first")
    facts = wh.read("gold.fact_video_metrics").join(wh.read("gold.dim_channel"), "dim_channel_key")
    assert {r.channel_id for r in facts.where("channel_title = 'Alpha'").collect()} == {"UC1"}


def test_missing_file_fails_the_step(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_pipeline(spark, str(tmp_path / "wh"), Feeds(items_csv=str(tmp_path / "none.csv")), "r", DAY1)


def test_sql_names_of_versions_and_of_empty_tables(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create()
    schema = model.TABLES["gold.dim_channel"].schema
    rows = [("k1", 1, True)], [("k1", 1, False), ("k2", 2, True)]
    for step in rows:
        values = [(k, "c", "T", 1, "DE", 1, 1, v, DAY1, None, now) for k, v, now in step]
        wh.write_versions("gold.dim_channel", spark.createDataFrame(values, schema))
    wh.register()
    text = "SELECT dim_channel_key, is_current FROM {} ORDER BY version_number"
    for name in ("gold.dim_channel", "dim_channel"):
        assert [tuple(r) for r in query(spark, text.format(name)).collect()] == [("k1", False), ("k2", True)]
    for name in ("silver.videos", "gold.dim_category", "metadata.audit_log", "fact_video_metrics"):
        assert query(spark, f"SELECT count(*) AS n FROM {name}").first().n == 0


def test_warehouse_writes(spark, frame, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), aliases={"gold.dim_category": "gold.categories_by_id"})
    wh.create()
    row = "category_id int, category_title string, load_timestamp timestamp_ntz"
    assert wh.write_full("gold.dim_category", frame(row, [(1, "a", DAY1), (2, "b", DAY1)])) == 2
    # A table may feed its own replacement, and an empty one replaces it too.
    assert wh.write_full("gold.dim_category", wh.read("gold.dim_category").where("category_id = 2")) == 1
    assert [r.category_id for r in wh.read("gold.dim_category").collect()] == [2]
    assert (tmp_path / "wh/gold/categories_by_id").exists()
    assert wh.write_full("gold.dim_category", frame(row, [])) == 0 and wh.read("gold.dim_category").count() == 0

    fact = "gold.fact_video_metrics"
    ddl = ("video_id string, dim_video_key string, dim_category_id int, dim_channel_key string, views bigint, likes bigint,"
           " dislikes bigint, comment_count bigint, load_timestamp timestamp_ntz, trending_date date")  # fmt: skip
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    facts = lambda *rows: frame(ddl, [(v, "k", 1, "c", n, 0, 0, 0, DAY1, day) for v, n, day in rows])
    dates = lambda *days: frame("trending_date date", [(x,) for x in days])
    assert wh.write_dates(fact, facts(("a", 1, d[0]), ("b", 2, d[1]), ("c", 3, d[2])), dates(*d)) == 3
    # The second date is reloaded without rows, so it is cleared; the third is not touched.
    assert wh.write_dates(fact, facts(("a", 9, d[0])), dates(d[0], d[1], d[1])) == 1
    assert {(r.video_id, r.views) for r in wh.read(fact).collect()} == {("a", 9), ("c", 3)}

    day = "silver.videos"
    empty = wh.read(day)
    assert wh.write_replace_partition(day, empty, d[0]) == 0
    assert wh.read(day).count() == 0


def test_many_writes_keep_few_files(spark, tmp_path):
    """A few lists and the folders they name, however often a table was replaced."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create()
    table = "silver.categories"
    for n in range(KEEP_LISTS + 4):
        rows = spark.range(n + 1).selectExpr(
            "CAST(id AS INT) AS category_id", "'t' AS category_title", "'s' AS source_system",
            "CAST(NULL AS TIMESTAMP_NTZ) AS load_timestamp",
        )
        assert wh.write_full(table, rows) == n + 1
        assert wh.read(table).count() == n + 1
    kept = [p for p in os.listdir(wh.path(table)) if p.startswith("write=")]
    lists = [p for p in os.listdir(f"{wh.path(table)}/_manifest") if p.isdigit()]
    assert (len(kept), len(lists)) == (KEEP_LISTS, KEEP_LISTS) and wh.version(table) == KEEP_LISTS + 4


def test_failed_write_keeps_rows(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create()
    name = "silver.rejected_records"
    rows = spark.createDataFrame([("{}", "R", None)] * 3, "raw_record_json string, rejection_reason string, rejected_at timestamp_ntz")
    assert wh.write_run(name, rows, run_id="a:1", table_name="t") == 3
    with pytest.raises(Exception, match="broken"):
        wh.write_run(name, rows.withColumn("rejection_reason", F.raise_error(F.lit("broken"))), run_id="a:1", table_name="t")
    assert [tuple(r) for r in wh.read(name).select("run_id", "table_name").distinct().collect()] == [("a:1", "t")]
    assert wh.read(name).count() == 3
    assert wh.write_run(name, rows.limit(0), run_id="a:1", table_name="t") == 0
    assert wh.read(name).count() == 0


FACT = "gold.fact_video_metrics"
FACT_ROW = ("video_id string, dim_video_key string, dim_category_id int, dim_channel_key string, views bigint, likes bigint,"
            " dislikes bigint, comment_count bigint, load_timestamp timestamp_ntz, trending_date date")  # fmt: skip


class Killed(BaseException):
    """The process ends: nothing after the point of failure runs."""


def kill_at(monkeypatch, owner, name, call):
    """End the ``call``-th call of a function, before it does anything."""
    whole, calls = getattr(owner, name), []

    def run(*args, **kwargs):
        calls.append(name)
        if len(calls) == call:
            raise Killed
        return whole(*args, **kwargs)

    monkeypatch.setattr(owner, name, run)


@pytest.mark.parametrize("owner, name, call", [
    (Warehouse, "_leaves", 1), (Warehouse, "_leaves", 3), (Manifest, "exchange", 1), (Manifest, "latest", 1),
    (Files, "create", 1), (Manifest, "_forget", 1), (Files, "delete", 1), (Files, "delete", 2),
])
def test_killed_reload_leaves_all_old_or_all_new_rows(spark, frame, tmp_path, monkeypatch, owner, name, call):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    days = [dt.date(2024, 1, i) for i in range(1, 6)]
    load = lambda n, some: frame(FACT_ROW, [("v", "k", 1, "c", n, 0, 0, 0, DAY1, day) for day in some])
    for n in range(KEEP_LISTS):
        wh.write_dates(FACT, load(n, days), days)
    old = {(day, KEEP_LISTS - 1) for day in days}
    new = {(days[0], KEEP_LISTS - 1), *((day, 99) for day in days[1:4])}
    with monkeypatch.context() as patched:
        kill_at(patched, owner, name, call)
        with pytest.raises(Killed):
            wh.write_dates(FACT, load(99, days[1:4]), days[1:])
            raise AssertionError("the write ended")
    seen = lambda: {(r.trending_date, r.views) for r in Warehouse(spark, wh.root).read(FACT).collect()}
    assert seen() == (new if name in ("_forget", "delete") else old)
    # The next writer starts from there, and what the dead one left goes.
    assert Warehouse(spark, wh.root).write_dates(FACT, load(7, days[:1]), days[:1]) == 1
    assert (days[0], 7) in seen() and len(seen()) == (4 if name in ("_forget", "delete") else 5)
    wh.clean(older_than=0)
    named = {f.split("/")[0] for n in wh.manifest(FACT)._numbers() for f in wh.manifest(FACT)._content(n)}
    assert {p for p in os.listdir(wh.path(FACT)) if p.startswith("write=")} == named


def test_list_of_a_dead_writer_is_passed_over(spark, frame, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    day = dt.date(2024, 1, 1)
    load = lambda n: frame(FACT_ROW, [("v", "k", 1, "c", n, 0, 0, 0, DAY1, day)])
    wh.write_dates(FACT, load(1), [day])
    (tmp_path / "wh/gold/fact_video_metrics/_manifest/0000000002").write_text('["write=w')
    assert [r.views for r in wh.read(FACT).collect()] == [1]
    monkeypatch.setattr(manifest, "GRACE", 0.0)
    wh.write_dates(FACT, load(2), [day])
    assert [r.views for r in wh.read(FACT).collect()] == [2] and wh.version(FACT) == 2


def test_concurrent_writers_lose_nothing(spark, tmp_path):
    """Every list is made by one writer, from the list before it."""
    files = Files(spark, str(tmp_path))
    made = [(k, i) for k in range(4) for i in range(8)]

    def write(k):
        own = manifest.Manifest(files, str(tmp_path / "t"))
        for i in range(8):
            own.exchange(lambda folders, i=i: [*folders, f"write=w{k}/i={i}"])

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    last, folders = manifest.Manifest(files, str(tmp_path / "t")).latest()
    assert last == len(made) and sorted(folders) == sorted(f"write=w{k}/i={i}" for k, i in made)


def versions(frame, *rows):
    schema = model.TABLES["gold.dim_channel"].schema
    return frame(schema, [(f"{k}|{v}", k, "T" + k, n, "DE", 1, 1, v, DAY1, None, True) for k, n, v in rows])


def test_step_writes_changed_buckets_only(spark, frame, tmp_path):
    """An unchanged source writes no bucket, a changed key its own, and the wide rows of the others are not shuffled."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create()
    run = Pipeline(spark, wh, "r", DAY1)
    source = lambda *rows: frame("channel_id string, channel_title string, subscriber_count bigint, country string,"  # noqa: E731
                                 " total_videos int, total_views bigint, source_system string, load_timestamp timestamp_ntz",
                                 [(k, "T" + k, n, "DE", 1, 1, "s", DAY1) for k, n in rows])
    wh.write_full("silver.channels", source(*[(f"c{i}", i) for i in range(60)]))
    assert run.scd2_channels()[0] == 60
    first = set(wh.manifest("gold.dim_channel").folders())
    assert len(wh.partitions("gold.dim_channel")) == model.BUCKETS
    number = wh.version("gold.dim_channel")
    assert run.scd2_channels()[0] == 0 and wh.version("gold.dim_channel") == number

    wh.write_full("silver.channels", source(("c7", 700), ("new", 1), ("c8", 8)))
    again = Pipeline(spark, wh, "r2", DAY2)
    assert again.scd2_channels()[0] == 2 and again.counts["updated"] == 1
    hit = set(wh.buckets_of("gold.dim_channel", frame("channel_id string", [("c7",), ("new",)])))
    after = set(wh.manifest("gold.dim_channel").folders())
    rewritten = {int(values_of(f)["bucket"]) for f in first - after}
    assert hit - rewritten <= {b for b in hit if not any(values_of(f)["bucket"] == str(b) for f in first)}
    assert rewritten <= hit and after - first and {int(values_of(f)["bucket"]) for f in after - first} <= hit
    c7 = wh.read("gold.dim_channel").where("channel_id = 'c7'").orderBy("version_number").collect()
    assert [(r.subscriber_count, r.is_current) for r in c7] == [(7, False), (700, True)]
    assert wh.current("gold.dim_channel").count() == 61 and wh.history("gold.dim_channel").count() == 1
    # Inferred members go beside the others.
    kept = set(wh.manifest("gold.dim_channel").folders())
    again.add_rows("gold.dim_channel", versions(frame, ("late", 1, 1)))
    assert kept < set(wh.manifest("gold.dim_channel").folders()) and wh.current("gold.dim_channel").count() == 62
    # A bucket's plan reads the folders of that bucket alone.
    (bucket,) = wh.buckets_of("gold.dim_channel", frame("channel_id string", [("c7",)]))
    read = wh.current("gold.dim_channel", [bucket])
    assert all(f"is_current=true/bucket={bucket}/" in f for f in read.inputFiles()) and read.inputFiles()


def test_reload_reads_only_its_dates(spark, tmp_path, feeds):
    """Silver is laid out by load and date; the reload's plan names files of the run's dates alone."""
    root = str(tmp_path / "wh")
    run_pipeline(spark, root, feeds(1, ITEMS1), "a", DAY1)
    second = [item("v1", "26.19.08", views="250"), item("v9", "26.20.08", views="1")]
    run_pipeline(spark, root, feeds(2, second), "b", DAY2)
    wh = Warehouse(spark, root)
    reload = Pipeline(spark, wh, "b", DAY2)
    assert reload.loaded_dates() == ["2026-08-19", "2026-08-20"]
    items = reload.items_to_reload()
    dates = {f.split("trending_date=")[1].split("/")[0] for f in items.inputFiles()}
    assert dates == {"2026-08-19", "2026-08-20"} and len({f.split("load_date=")[1][:10] for f in items.inputFiles()}) == 2
    assert {(r.video_id, r.views) for r in items.collect()} == {("v1", 250), ("v3", 30), ("v9", 1)}


def test_run_leaves_no_scratch(spark, tmp_path, feeds, monkeypatch):
    made = []
    whole = session.scratch_dir
    monkeypatch.setattr(session, "scratch_dir", lambda *a: made.append(whole(*a)) or made[-1])
    root = str(tmp_path / "wh")
    run_pipeline(spark, root, feeds(1, ITEMS1), "a", DAY1)
    (space,) = made
    assert not os.path.exists(space) and os.path.exists(os.path.dirname(space))


def marts_of(spark, wh):
    """The marts computed from all facts, and the stored ones."""
    fact = wh.read(FACT)
    whole = {
        "gold.channel_performance_mart": marts.channel_performance(fact, wh.read("gold.dim_channel")),
        "gold.trending_kpi_summary_mart": marts.daily_kpi(fact, wh.read("gold.dim_category")),
        "gold.trending_trends_mart": marts.daily_trends(fact),
    }
    for name, frame in whole.items():
        stored = wh.read(name).drop("load_timestamp")
        yield sorted(map(tuple, frame.select(stored.columns).collect())), sorted(map(tuple, stored.collect()))


def test_marts_from_states_equal_marts_from_all_facts(spark, tmp_path, feeds, monkeypatch):
    """Only dates that a run reloads get new states; items keep their numbers; facts without states are found."""
    root = str(tmp_path / "wh")
    run_pipeline(spark, root, feeds(1, ITEMS1), "a", DAY1)
    wh = Warehouse(spark, root)
    first = {f for s in mart_states.STATES for f in wh.manifest(s).folders()}
    numbers = {r.video_id: r.item_number for r in wh.read(mart_states.NUMBERS).collect()}
    second = [item("v1", "26.19.08", views="250"), item("v9", "26.20.08", views="7", channel_title="Beta")]
    run_pipeline(spark, root, feeds(2, second), "b", DAY2)
    for got, want in marts_of(spark, wh):
        assert got == want and got
    kept = first & {f for s in mart_states.STATES for f in wh.manifest(s).folders()}
    assert {values_of(f)["trending_date"] for f in kept} == {"2026-08-18"} and len(kept) == 3
    after = {r.video_id: r.item_number for r in wh.read(mart_states.NUMBERS).collect()}
    assert numbers.items() <= after.items() and len(set(after.values())) == len(after) == len(numbers) + 1
    assert all(n % model.BUCKETS == b for n, b in wh.read(mart_states.NUMBERS).select("item_number", wh.bucket(mart_states.NUMBERS)).collect())
    # A date cleared by a reload, and one that was written without its state, are both taken up.
    assert mart_states.refresh(wh, []) == []
    wh.write_dates(FACT, wh.read(FACT).where("trending_date = '2026-08-20'").withColumn("trending_date", F.lit(dt.date(2026, 8, 21))),
                   [dt.date(2026, 8, 18), dt.date(2026, 8, 21)])
    assert mart_states.refresh(wh, []) == ["2026-08-18", "2026-08-21"]
    run = Pipeline(spark, wh, "c", DAY2)
    for step in (run.channel_mart, run.kpi_mart, run.trends_mart):
        step()
    for got, want in marts_of(spark, wh):
        assert got == want and got


def test_ledger_reads_as_many_files_however_many_runs(spark, tmp_path, monkeypatch):
    """Events of a bucket are put together, and an event touches its own bucket only."""
    monkeypatch.setattr(ledger, "MOST_FOLDERS", 3)
    tables = {n: dataclasses.replace(model.TABLES[n], buckets=2) for n in (ledger.EVENTS, ledger.RUNS)}
    wh = Warehouse(spark, str(tmp_path / "wh"), tables)
    for n in range(7):
        book = ledger.RunLedger(wh, f"run{n}", "p", DAY1)
        book.start()
        before = {f for f in wh.manifest(ledger.RUNS).folders() if f"bucket={book.bucket[0]}" not in f}
        book.finish("SUCCESS", inserted=n)
        assert before <= set(wh.manifest(ledger.RUNS).folders())
        assert len(wh.read(ledger.EVENTS).inputFiles()) <= 2 * 4 and len(wh.read(ledger.RUNS).inputFiles()) <= 2
    runs = {r.run_id: (r.status, r.records_inserted) for r in wh.read(ledger.RUNS).collect()}
    assert runs == {f"run{n}": ("SUCCESS", n) for n in range(7)}
    assert wh.read(ledger.EVENTS).count() == 14
