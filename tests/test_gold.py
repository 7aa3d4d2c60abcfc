import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import as_dicts
from tierline.operators.fact import reload_by_key, star_join
from tierline.operators.members import inferred_categories, inferred_channels, inferred_items, replaced_inferred
from tierline.operators.scd import (
    VERSION,
    first_versions,
    scd1,
    scd2,
    scd2_changed,
    scd2_close,
    scd2_insert,
)

SOURCE = "id string, a string, b int, seen int"
DIM = (
    "dim_key string, id string, a string, b int, version_number int, effective_start_date timestamp_ntz,"
    " effective_end_date timestamp_ntz, is_current boolean"
)


def newest():
    return [F.desc("seen"), F.desc("a"), F.desc("b")]


def step(dim, source, run_ts):
    # ``a`` is tracked, ``b`` is stored only.
    return scd2(dim, source, key="id", tracked=["a"], attributes=["a", "b"], order_by=newest(), run_ts=run_ts,
                key_column="dim_key")


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_scd1(frame):
    target = frame("id int, t string", [(1, "a"), (2, "b")])
    source = frame("id int, t string, extra int", [(2, "B", 0), (3, "c", 0)])
    assert sorted(tuple(r) for r in scd1(target, source, "id").collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_scd2_cases(frame):
    dim = step(frame(DIM, []), frame(SOURCE, [("same", "x", 1, 1), ("changed", "x", 1, 1), ("null", None, 1, 1),
                                              ("untracked", "x", 1, 1), ("gone", "x", 1, 1)]), day(0))
    assert {(r.id, r.version_number, r.is_current) for r in dim.collect()} == {
        (i, 1, True) for i in ("same", "changed", "null", "untracked", "gone")}
    arrived = frame(SOURCE, [("same", "x", 1, 2), ("changed", "y", 2, 2), ("changed", "old", 9, 1), ("null", "x", 1, 2),
                             ("untracked", "x", 5, 2), ("new", "x", 1, 2)])
    rows = {(r["id"], r["version_number"]): r for r in as_dicts(step(dim, arrived, day(1)))}
    assert len(rows) == 8
    assert rows["changed", 1]["effective_end_date"] == day(1) and not rows["changed", 1]["is_current"]
    assert (rows["changed", 2]["a"], rows["changed", 2]["b"], rows["changed", 2]["is_current"]) == ("y", 2, True)
    assert rows["changed", 2]["effective_start_date"] == day(1)
    assert rows["null", 2]["is_current"] and not rows["null", 1]["is_current"]
    assert rows["untracked", 1]["is_current"] and rows["untracked", 1]["b"] == 1
    assert rows["gone", 1]["is_current"] and rows["new", 1]["is_current"]
    assert len({r["dim_key"] for r in rows.values()}) == 8
    # A key whose last version was closed without a successor opens the next one.
    reopened = step(frame(DIM, [("k", "z", "x", 1, 3, day(0), day(1), False)]), frame(SOURCE, [("z", "x", 1, 1)]), day(2))
    assert sorted((r.version_number, r.is_current) for r in reopened.collect()) == [(3, False), (4, True)]


def test_scd2_plan_has_one_join_and_reads_the_target_once(spark, frame, tmp_path):
    frame(DIM, [("k", "z", "x", 1, 1, day(0), None, True)]).write.parquet(str(tmp_path / "dim"))
    frame(SOURCE, [("z", "y", 1, 1)]).write.parquet(str(tmp_path / "src"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = step(spark.read.parquet(str(tmp_path / "dim")), spark.read.parquet(str(tmp_path / "src")), day(1))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 1 and plan.count("FileScan") == 2 and plan.count("Exchange hash") == 2


def loop_scd2(snapshots):
    """One key at a time, as a ledger clerk would do it."""
    dim = {}
    for n, rows in enumerate(snapshots):
        latest = {}
        for key, a, b, seen in rows:
            candidate = (seen, (a is not None, a or ""), b)
            if key not in latest or candidate > latest[key][0]:
                latest[key] = (candidate, a, b)
        for key, (_, a, b) in latest.items():
            versions = dim.setdefault(key, [])
            if versions and versions[-1]["a"] == a:
                continue
            if versions:
                versions[-1]["end"] = day(n)
            versions.append({"a": a, "b": b, "start": day(n), "end": None})
    return {
        (key, i, v["a"], v["b"], v["start"], v["end"], v["end"] is None)
        for key, versions in dim.items()
        for i, v in enumerate(versions, start=1)
    }


row = st.tuples(st.sampled_from("pqrs"), st.sampled_from([None, "x", "y"]), st.integers(0, 2), st.integers(0, 2))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(row, max_size=6), min_size=1, max_size=3))
def test_scd2_equals_a_loop_over_keys(spark, snapshots):
    dim = spark.createDataFrame([], DIM)
    stepwise = dim
    for n, rows in enumerate(snapshots):
        source = spark.createDataFrame(rows, SOURCE)
        dim = step(dim, source, day(n))
        changed = scd2_changed(stepwise, source, "id", ["a"], newest())
        closed = scd2_close(stepwise, changed, "id", day(n))
        stepwise = closed.unionByName(scd2_insert(closed, source, "id", ["a", "b"], newest(), day(n), "dim_key"))
        # Keep the plans of the test short.
        dim, stepwise = (spark.createDataFrame(d.collect(), DIM) for d in (dim, stepwise))
    got = {tuple(r)[1:] for r in dim.select("dim_key", "id", "version_number", "a", "b", *VERSION[1:]).collect()}
    assert got == loop_scd2(snapshots)
    assert sorted(map(str, dim.collect())) == sorted(map(str, stepwise.collect()))


CHANNEL_DIM = (
    "dim_channel_key string, channel_id string, channel_title string, subscriber_count bigint, country string,"
    " total_videos int, total_views bigint, version_number int, effective_start_date timestamp_ntz,"
    " effective_end_date timestamp_ntz, is_current boolean"
)


def test_inferred_channels_and_their_end(frame):
    known = ("k1", "UC1", "Known", 5, "DE", 1, 1, 1, day(0), None, True)
    closed = ("k2", "UC2", "Former", 5, "DE", 1, 1, 1, day(0), day(1), False)
    dim = frame(CHANNEL_DIM, [known, closed])
    items = frame("channel_title string", [("Known",), ("Former",), ("New",), ("New",), ("",), (None,)])
    new = as_dicts(inferred_channels(items, dim, day(2)))
    assert {r["channel_title"] for r in new} == {"Former", "New"}
    assert all(r["channel_id"].startswith("inferred_") and r["country"] == "Unknown" and r["total_views"] == 0
               and r["version_number"] == 1 and r["is_current"] for r in new)
    grown = dim.unionByName(frame(CHANNEL_DIM, [tuple(r.values()) for r in new]))
    real = frame(CHANNEL_DIM, [("k3", "UC3", "New", 1, "DE", 1, 1, 1, day(3), None, True)])
    grown = grown.unionByName(real)
    after = scd2_close(grown, replaced_inferred(grown), "channel_id", day(3))
    current = {r.channel_id: r.channel_title for r in after.where("is_current").collect()}
    assert sorted(current.values()) == ["Former", "Known", "New"] and current["UC3"] == "New"
    # Inferred again after the real one is gone, the member gets its next version.
    gone = after.withColumn("is_current", F.col("is_current") & (F.col("channel_id") != "UC3"))
    (again,) = as_dicts(inferred_channels(items, gone, day(4)))
    assert (again["channel_title"], again["version_number"]) == ("New", 2)


def test_inferred_items_and_categories(frame):
    dim = first_versions(frame("video_id string, title string", [("a", "A")]), "video_id", "dim_video_key", day(0))
    items = frame("video_id string, title string, category_id int, seen int",
                  [("a", "A2", 1, 1), ("b", "old", 1, 1), ("b", "new", 7, 2)])
    (new,) = as_dicts(inferred_items(items, dim, [F.desc("seen")], day(1)))
    assert (new["video_id"], new["title"], new["version_number"]) == ("b", "new", 1)
    categories = frame("category_id int, category_title string, load_timestamp timestamp_ntz", [(1, "One", day(0))])
    assert as_dicts(inferred_categories(items, categories, day(1))) == [
        {"category_id": 7, "category_title": "Inferred Category 7", "load_timestamp": day(1)}]


def test_star_join_matches_titles_and_drops_what_has_no_member(frame):
    items = frame(
        "video_id string, trending_date date, channel_title string, category_id int, views bigint, likes bigint,"
        " dislikes bigint, comment_count bigint",
        [("a", day(0).date(), "T", 1, 5, 1, 0, 0), ("a", day(0).date(), "", 1, 5, 1, 0, 0),
         ("b", day(0).date(), "T", 9, 5, 1, 0, 0)],
    )
    videos = frame("dim_video_key string, video_id string, is_current boolean",
                   [("va1", "a", False), ("va2", "a", True), ("vb", "b", True)])
    channels = frame("dim_channel_key string, channel_title string, is_current boolean",
                     [("c1", "T", True), ("c0", "T", False)])
    categories = frame("category_id int", [(1,)])
    (row,) = as_dicts(star_join(items, videos, categories, channels, day(1)))
    assert (row["dim_video_key"], row["dim_channel_key"], row["dim_category_id"]) == ("va2", "c1", 1)


def test_hot_title_in_the_star_join_is_split(spark, tmp_path):
    """A title of a third of all rows, and stored dimensions too large to broadcast."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    n = F.col("id")
    title = F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), n % 500))
    spark.range(0, 20000, 1, 8).select(
        n.cast("string").alias("video_id"), F.lit("2024-01-01").cast("date").alias("trending_date"),
        title.alias("channel_title"), (n % 7).cast("int").alias("category_id"), n.alias("views"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("likes", "dislikes", "comment_count")],
    ).write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))

    def stored(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    current = F.lit(True).alias("is_current")
    videos = stored("v", items.select("video_id", F.md5("video_id").alias("dim_video_key"), current))
    titles = items.select("channel_title").distinct()
    channels = stored("c", titles.select("channel_title", F.md5("channel_title").alias("dim_channel_key"), current))
    categories = stored("k", items.select("category_id").distinct())
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        facts = star_join(items, videos, categories, channels, day(0))
        assert facts.agg(F.sum("views")).first()[0] == sum(range(20000))
        facts.collect()
        assert "skew=true" in facts._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["date", "int"])
def test_reload_clears_keys_without_new_rows(frame, kind):
    k = (lambda i: day(i).date()) if kind == "date" else (lambda i: i)
    ddl = f"d {kind}, v int"
    target = frame(ddl, [(k(1), 1), (k(1), 1), (k(2), 2), (k(3), 3)])
    out = reload_by_key(target, frame(ddl, [(k(1), 9)]), frame(f"d {kind}", [(k(1),), (k(2),), (k(2),)]), "d")
    assert sorted(r.v for r in out.collect()) == [3, 9]
    assert out.columns == ["d", "v"]
