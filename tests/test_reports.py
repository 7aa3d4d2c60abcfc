import datetime as dt
import decimal

import numpy as np
import pytest

from tests.conftest import as_dicts
from tierline.plans import adhoc, alerts, analytics, ledger, listings, marts
from tierline.sinks import Warehouse


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


FACT = "trending_date date, video_id string, dim_channel_key string, dim_category_id int, views bigint, likes bigint"


@pytest.fixture
def fact(frame):
    return frame(FACT, [
        (day(0), "a", "c1", 23, 60, 1), (day(0), "b", "c1", 34, 60, 2), (day(0), "c", "c3", 1, 100, 4),
        (day(1), "a", "c2", 23, 330, 8), (day(3), "a", "c2", 1, 165, 8), (day(3), "b", "c3", 2, 165, 8)])


def test_marts(frame, fact):
    categories = frame("category_id int, category_title string",
                       [(1, "Music"), (2, "Autos"), (23, "Comedy"), (34, "Comedy")])
    channels = frame("dim_channel_key string, channel_title string, is_current boolean",
                     [("c1", "T", False), ("c2", "T", True), ("c3", "U", True), ("c4", "V", True)])
    got = {r["channel_title"]: r for r in as_dicts(marts.channel_performance(fact, channels))}
    # Both versions of T count as one; its item a is counted once and averaged per row.
    assert got["T"] == {"channel_title": "T", "total_trending_videos": 2, "total_views": 615, "total_likes": 19,
                        "avg_likes_per_video": decimal.Decimal("4.75")}
    assert set(got) == {"T", "U"}
    kpi = marts.daily_kpi(fact, categories).orderBy("trending_date").collect()
    # Two ids named Comedy together beat Music; equal views on the last day go to the first title.
    assert [r.most_trending_category for r in kpi] == ["Comedy", "Comedy", "Autos"]
    assert [(r.total_trending_videos, r.total_views) for r in kpi] == [(3, 220), (1, 330), (2, 330)]
    trends = [tuple(r) for r in marts.daily_trends(fact).orderBy("trending_date").collect()]
    d = decimal.Decimal
    assert trends == [(day(0), 220, 220, None, d("0.00")), (day(1), 330, 550, 220, d("50.00")),
                      (day(3), 330, 880, 330, d("0.00"))]
    assert alerts.alerts_trends(marts.daily_trends(fact)).count() == 0  # exactly 50 raises none
    top = marts.top_categories(fact, categories, 2).collect()
    assert [tuple(r) for r in top] == [("Music", 12), ("Comedy", 11)]
    assert [r.channel_title for r in marts.top_groups(marts.channel_performance(fact, channels), 1).collect()] == ["T"]


def test_series_modes(frame, fact):
    channels = frame("dim_channel_key string, channel_title string",
                     [("c1", "5-Minute Crafts"), ("c2", "5-minute crafts KIDS"), ("c3", "Other_")])
    all_days = analytics.daily_series(fact, "views")
    assert [r.val for r in all_days.orderBy("trending_date").collect()] == [220, 330, 330]
    matching = analytics.daily_series(fact, "likes", channels, pattern="MINUTE")
    assert [r.val for r in matching.orderBy("trending_date").collect()] == [3, 8, 8]
    assert analytics.daily_series(fact, "views", channels, pattern="her_").count() == 2
    assert analytics.daily_series(fact, "views", channels, pattern="r%").count() == 0
    with pytest.raises(ValueError, match="metric"):
        analytics.daily_series(fact, "views; DROP TABLE x")
    with pytest.raises(ValueError, match="dimension"):
        analytics.daily_series(fact, "views", pattern="x")


def series(frame, **values):
    rows = [(k, day(2 * i), v) for k, vs in values.items() for i, v in enumerate(vs)]
    return frame("e string, trending_date date, val bigint", rows)


def test_forecast_equals_numpy(frame):
    ys = {"up": [10, 30, 20, 50, 60, 55], "down": [90, 70, 40, 20, 5], "few": [1, 2, 3, 4], "line": [5, 10, 15, 20, 25, 30]}
    out = as_dicts(analytics.forecast(series(frame, **ys), ["e"]).orderBy("e", "forecast_date"))
    assert [r["status"] for r in out if r["e"] == "few"] == ["insufficient"]
    for name in ("up", "down", "line"):
        y = np.array(ys[name], float)
        x = np.arange(len(y))
        slope, intercept = np.polyfit(x, y, 1)
        spread = np.std(y - (slope * x + intercept))
        got = [r for r in out if r["e"] == name]
        assert [r["forecast_date"] for r in got] == [day(2 * (len(y) - 1) + i) for i in range(1, 31)]
        for i, r in enumerate(got, start=1):
            pred = max(0.0, slope * (len(y) + i) + intercept)
            assert r["predicted"] == pytest.approx(pred, abs=0.006)
            assert r["lower_bound"] == pytest.approx(max(0.0, pred - 1.96 * spread), abs=0.006)
            assert r["upper_bound"] == pytest.approx(pred + 1.96 * spread, abs=0.006)
            assert r["historical_mean"] == pytest.approx(np.mean(y), abs=0.006)
            assert r["historical_slope"] == pytest.approx(slope, abs=0.006)
    assert all(r["predicted"] == 0.0 for r in out if r["e"] == "down")
    first = analytics.forecast(series(frame, line=ys["line"]), ["e"], horizon=1, index_offset=0).first()
    assert first.predicted == pytest.approx(35.0)


def test_forecast_of_one_series_without_entities(frame):
    out = analytics.forecast(series(frame, x=[1, 2, 3, 4, 5]).drop("e"))
    assert out.count() == 30 and out.orderBy("forecast_date").first().predicted == pytest.approx(7.0)


def test_anomalies(frame):
    # |z| of 10 in the second series is exactly 2 and raises nothing; a flat series has no deviation.
    data = series(frame, spike=[10] * 9 + [100], edge=[0, 0, 0, 0, 10], drop=[100] * 9 + [1], flat=[5, 5, 5])
    out = {r["e"]: r for r in as_dicts(analytics.anomalies(data, ["e"]))}
    assert {k: (r["type"], r["value"], r["z_score"]) for k, r in out.items()} == {
        "spike": ("Spike", 100, 3.0), "drop": ("Drop", 1, -3.0)}
    message = alerts.alerts_anomaly(analytics.anomalies(data, ["e"])).where("message like '%Spike%'").first().message
    assert message == f"ML Anomaly detected on {day(18)} - Spike (z-score: 3.0)."


def test_decline(frame):
    data = series(frame, up=[1, 2, 3], flat=[4, 4, 4], medium=[105, 100, 95], steep=[110, 100, 89], few=[9, 1], zero=[0, 0, 0])
    out = {r["e"]: r for r in as_dicts(analytics.decline(data, ["e"]))}
    # A slope of exactly 5 % of the mean is not yet High.
    assert {k: r["decline_likelihood"] for k, r in out.items()} == {
        "up": "Low", "flat": "Low", "medium": "Medium", "steep": "High", "few": None, "zero": "Low"}
    assert out["few"]["status"] == "insufficient" and out["few"]["days"] == 2
    high = as_dicts(alerts.alerts_decline(analytics.decline(data, ["e"]), "e"))
    assert [r["message"] for r in high] == ["High decline likelihood detected for channel steep (Slope: -10.5)."]


RUNS = "run_id string, status string, duration_seconds decimal(20,2), records_inserted bigint, records_rejected bigint"


def test_run_alerts(frame):
    d = decimal.Decimal
    runs = frame(RUNS, [("r1", "SUCCESS", d("300.00"), 90, 10), ("r2", "FAILED", d("300.01"), 899, 101),
                        ("r3", "FAILED", None, None, None), ("r4", "RUNNING", None, None, 1)])
    assert sorted(r.message for r in alerts.alerts_runs(runs).collect()) == [
        "Pipeline run duration (300.01s) exceeds warning threshold (300s).",
        "Pipeline run failed for run r2.", "Pipeline run failed for run r3."]
    assert sorted(r.message for r in alerts.alerts_rejection(runs).collect()) == [
        "High data quality rejection rate (10.1%) in run r2.", "High data quality rejection rate (100.0%) in run r4."]
    both = alerts.alerts_all(alerts.alerts_runs(runs), alerts.alerts_rejection(runs))
    assert both.columns == ["severity", "rule", "subject", "message", "rule_order"] and both.count() == 5


@pytest.mark.parametrize(
    "sql, accepted",
    [
        ("SELECT 1", True), ("  with x as (select 1) select * from x;", True), ("```sql\nSELECT 1\n```", True),
        ("DROP TABLE x", False), ("SELECT 1; DROP TABLE x", False), ("SELECT 'please update'", False),
        ("EXPLAIN SELECT 1", False), ("select updated_at from t", True), ("Insert into t select 1", False),
    ],
)
def test_read_only_gate(sql, accepted):
    assert adhoc.is_read_only(adhoc.clean(sql)) is accepted


def test_adhoc_rows(spark):
    spark.range(2000).createOrReplaceTempView("many")
    assert adhoc.query(spark, "```sql\nSELECT * FROM many;\n```").count() == 2000
    assert adhoc.query(spark, "SELECT * FROM many LIMIT 1000").count() == 1000
    assert adhoc.query(spark, "SELECT * FROM many", max_rows=500).count() == 500
    assert adhoc.truncated(spark, "SELECT * FROM many", 500) and not adhoc.truncated(spark, "SELECT * FROM many", 2000)
    text = "WITH x AS (SELECT id FROM many), y (k) AS (SELECT id FROM x) SELECT k FROM y WHERE k IN (SELECT id FROM many)"
    assert adhoc.query(spark, text).count() == 2000
    text = "SELECT transform(array(id), x -> x + 1)[0] AS v FROM many a JOIN many b USING (id)"
    assert adhoc.query(spark, text).count() == 2000
    assert spark.conf.get(adhoc.RUN_ON_FILES) == "true"
    with pytest.raises(ValueError, match="read-only"):
        adhoc.query(spark, "TRUNCATE TABLE many")


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')", "SELECT java_method('a', 'b')",
        "SELECT try_reflect('a', 'b') FROM many", "SELECT * FROM text.`/etc/hostname`", "SELECT * FROM parquet.`/tmp/x` t",
        "SELECT * FROM nothing_known", "WITH x AS (SELECT * FROM text.`/etc/hostname`) SELECT * FROM x",
        "SELECT TRANSFORM(id) USING 'cat' AS (a) FROM many", "SELECT transform (id) using\n\"cat\" FROM many",
        "WITH x AS (SELECT TRANSFORM(id) USING r'cat' AS (a) FROM many) SELECT * FROM x",
        "SELECT TRANSFORM(id) USING /* ( */ 'cat' AS (a) FROM many", "SELECT * FROM identifier('text.`/etc/hostname`')",
        "SELECT (SELECT max(value) FROM text.`/etc/hostname`) AS v", "SELECT 1 WHERE EXISTS (SELECT * FROM csv.`/etc/hosts`)",
    ],
)
def test_adhoc_refuses(spark, sql):
    spark.range(5).createOrReplaceTempView("many")
    with pytest.raises(ValueError):
        adhoc.query(spark, sql)


def test_forecast_of_nothing(frame):
    (row,) = analytics.forecast(frame("trending_date date, val long", [])).collect()
    assert row["status"] == analytics.INSUFFICIENT and row["predicted"] is None


def test_ledger(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.create()
    book = ledger.RunLedger(wh, "run:1", "etl", dt.datetime(2024, 1, 1))
    times = iter(dt.datetime(2024, 1, 1, 0, m) for m in range(30))
    book.clock = lambda: next(times)
    book.start()
    with pytest.raises(RuntimeError):
        book.audited("t", "bad")(lambda: (_ for _ in ()).throw(RuntimeError("boom")))()
    assert book.audited("t", "good")(lambda: (7, "seven"))() == (7, "seven")
    book.finish("SUCCESS", inserted=5, rejected=2)
    (run,) = as_dicts(wh.read(ledger.RUNS))
    assert (run["status"], run["records_inserted"], run["records_updated"], run["records_rejected"]) == ("SUCCESS", 5, 0, 2)
    assert run["end_time"] > run["start_time"] and run["duration_seconds"] > 0
    lines = [tuple(r) for r in ledger.ordered_audit(wh.read(ledger.AUDIT)).collect()]
    assert lines == [("t", "bad", "STARTED", 0, ""), ("t", "bad", "FAILED", 0, "Error: boom"),
                     ("t", "good", "STARTED", 0, ""), ("t", "good", "COMPLETED", 7, "seven")]
    assert ledger.latest_rows(wh.read(ledger.AUDIT), "log_timestamp", "log_id", 1).first().log_message == "seven"
    assert [tuple(r) for r in ledger.runs_by_status(wh.read(ledger.RUNS)).collect()] == [("etl", "SUCCESS", 1)]
    broken = ledger.RunLedger(Warehouse(spark, "/proc/none"), "r", "etl", dt.datetime(2024, 1, 1))
    broken.audit("t", "s", "STARTED")  # is logged and does not raise


def test_listings(frame):
    dim = frame("id string, title string, version_number int, effective_start_date timestamp_ntz,"
                " effective_end_date timestamp_ntz, is_current boolean",
                [("a", "1", 2, None, None, True), ("a", "0", 1, None, None, False), ("b", "x", 1, None, None, True)])
    got = listings.version_history(dim, "id", ["a"], "title").collect()
    assert [(r.id, r.title, r.version_number) for r in got] == [("a", "0", 1), ("a", "1", 2)]
    counts = listings.rows_per_source(frame("source_system string", [("x",), ("x",), ("y",)])).orderBy("n").collect()
    assert [tuple(r) for r in counts] == [("y", 1), ("x", 2)]
    per_reason = listings.rejections_per_reason(frame("table_name string, rejection_reason string", [("t", "R")] * 2))
    assert [tuple(r) for r in per_reason.collect()] == [("t", "R", 2)]
