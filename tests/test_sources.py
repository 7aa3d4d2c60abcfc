import csv
import datetime as dt
import random

import pytest

from tests.conftest import as_dicts
from tierline.model import CHANNEL_FEED
from tierline.sources import (
    all_strings,
    high_watermark,
    read_csv_bronze,
    read_csv_split,
    read_incremental,
    read_json_items,
    read_xml_bronze,
    with_lineage,
)
from tierline.sources import split_csv

RUN_TS = dt.datetime(2024, 2, 1, 6, 30)


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,n\n1,"two\nlines, ""quoted""",\n2, padded ,007\n3,,""\n')
    rows = read_csv_bronze(spark, str(tmp_path / "a.csv"), ["id", "text", "n"]).collect()
    assert [tuple(r) for r in rows] == [
        ("1", 'two\nlines, "quoted"', ""), ("2", " padded ", "007"), ("3", "", "")]


COLUMNS = ["id", "text", "n"]


@pytest.fixture
def blocks(spark):
    """A session that cuts files into small blocks."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "500")
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    return session


def write_files(folder, files, line_end="\n"):
    folder.mkdir()
    for name, rows in files.items():
        with open(folder / name, "w", newline="") as f:
            out = csv.writer(f, lineterminator=line_end)
            out.writerow(COLUMNS)
            out.writerows(rows)
    return str(folder)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_split_csv_equals_the_files(blocks, tmp_path, monkeypatch, line_end):
    """Fields with breaks, quotes and separators; some are longer than a block, so that blocks lie within a field."""
    draw = random.Random(6)
    parts = ["a", 'b"c', "\n", "\r\n", ",", " x", "é", '"', "\n\n"]

    def field():
        return "".join(draw.choice(parts) for _ in range(draw.choice([0, 1, 2, 5, 40]))) if draw.random() < 0.6 else "plain"

    files = {f"{k}.csv": [(f"{k}-{i}", field(), str(i)) for i in range(60)] for k in range(3)}
    files["1.csv"].insert(30, ("long", "x\n" * 5000 + '"', "7"))
    files["3.csv"] = []
    path = write_files(tmp_path / "feed", files, line_end)
    want = [row for name in sorted(files) for row in files[name]]
    got = read_csv_split(blocks, path, COLUMNS, "place")
    assert got.rdd.getNumPartitions() > 3 * len(files)
    rows = sorted(map(tuple, got.collect()), key=lambda r: r[3])
    assert [r[:3] for r in rows] == want
    assert len({r[3] for r in rows}) == len(rows)
    monkeypatch.setattr(split_csv, "SENT_BLOCKS", 0)
    assert sorted(map(tuple, read_csv_split(blocks, path, COLUMNS, "place").collect()), key=lambda r: r[3]) == rows


def test_split_csv_puts_small_blocks_into_one_task(blocks, tmp_path, monkeypatch):
    """Tasks follow the bytes and not the blocks; rows and their order stay."""
    rows = [(f"{i}", 'x,"\n' * (i % 60), "a\r\nb") for i in range(3000)]
    path = write_files(tmp_path / "feed", {"a.csv": rows[:2000], "b.csv": rows[2000:], "c.csv": []})
    assert sum(f.stat().st_size for f in (tmp_path / "feed").iterdir()) > 600 * 500
    at_least = 4 * blocks.sparkContext.defaultParallelism
    for size, low, high in ((1 << 20, at_least, at_least), (2000, 150, 600)):
        monkeypatch.setattr(split_csv, "TASK_BYTES", size, raising=False)
        assert low <= split_csv._lines(blocks, path).rdd.getNumPartitions() <= high
        got = read_csv_split(blocks, path, COLUMNS, "place")
        assert got.rdd.getNumPartitions() <= high + 4  # and those of the records across borders
        found = sorted(map(tuple, got.collect()), key=lambda r: r[3])
        assert [r[:3] for r in found] == rows
        assert len({r[3] for r in found}) == len(rows)


def test_split_csv_equals_the_whole_file_reader(spark, blocks, tmp_path):
    text = '\ufeffid,text,n\n1,"two\nlines, ""quoted""",\n\n2, padded ,007\n3,,""\n4,"",last'
    (tmp_path / "a.csv").write_text(text)
    rows = sorted(map(tuple, read_csv_split(blocks, str(tmp_path / "a.csv"), COLUMNS).collect()))
    assert rows == [("1", 'two\nlines, "quoted"', ""), ("2", " padded ", "007"), ("3", "", ""), ("4", "", "last")]
    assert rows == sorted(map(tuple, read_csv_bronze(spark, str(tmp_path / "a.csv"), COLUMNS).collect()))


def test_split_csv_refuses_what_it_cannot_read(spark, tmp_path):
    for name, text, match in (
        ("open.csv", 'id,text,n\n1,"no end,3\n', "end inside a quoted field"),
        ("short.csv", "id,text,n\n1,2\n", "MALFORMED"),
        ("head.csv", "id,other,n\n1,2,3\n", "header"),
        ("stray.csv", 'id,text,n\n1,5" disk,3\n2,6" disk,3\n', "MALFORMED"),
    ):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match=match):
            read_csv_split(spark, str(tmp_path / name), COLUMNS).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv_split(spark, str(tmp_path / "none.csv"), COLUMNS)


def test_csv_with_other_columns_or_no_file_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,other\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_bronze(spark, str(tmp_path / "a.csv"), ["id", "text"]).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv_bronze(spark, str(tmp_path / "none.csv"), ["id"])


def test_json_items_need_id_and_title(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        """{"kind": "list", "etag": "x", "items": [
        {"kind": "k", "id": "23", "snippet": {"channelId": "c", "title": "Comedy", "assignable": true}},
        {"id": "34", "snippet": {"title": "Comedy"}}, {"id": "", "snippet": {"title": "No id"}},
        {"id": "1", "snippet": {"title": ""}}, {"id": "2"}, {"snippet": {"title": "No id"}},
        {"id": 7, "snippet": {"title": "Number"}}]}"""
    )
    rows = read_json_items(spark, str(tmp_path / "c.json")).collect()
    assert [tuple(r) for r in rows] == [("23", "Comedy"), ("34", "Comedy"), ("7", "Number")]


def test_xml_children_are_strings(spark, tmp_path):
    (tmp_path / "c.xml").write_text(
        """<?xml version='1.0' encoding='utf-8'?>
<channels><channel><channel_id> UC1 </channel_id><channel_title>A &amp; B</channel_title>
<subscriber_count>007</subscriber_count><country></country><last_updated>2026-08-19T00:00:00</last_updated>
</channel><channel><channel_id>UC2</channel_id><channel_title/><subscriber_count>x</subscriber_count>
<country>US</country><last_updated>2026-08-18T00:00:00</last_updated></channel></channels>"""
    )
    rows = as_dicts(read_xml_bronze(spark, str(tmp_path / "c.xml"), "channel", CHANNEL_FEED))
    assert rows == [
        {"channel_id": " UC1 ", "channel_title": "A & B", "subscriber_count": "007", "country": None,
         "last_updated": "2026-08-19T00:00:00"},
        {"channel_id": "UC2", "channel_title": None, "subscriber_count": "x", "country": "US",
         "last_updated": "2026-08-18T00:00:00"}]


def test_xml_without_a_child_fails(spark, tmp_path):
    (tmp_path / "c.xml").write_text("<channels><channel><channel_id>UC1</channel_id></channel></channels>")
    with pytest.raises(Exception, match="has no <channel_title>"):
        read_xml_bronze(spark, str(tmp_path / "c.xml"), "channel", CHANNEL_FEED).collect()


def test_incremental_reads_above_the_watermark(frame, tmp_path, spark):
    t = dt.datetime
    source = frame("id int, ts timestamp_ntz", [(1, t(2026, 8, 18)), (2, t(2026, 8, 19)), (3, t(2026, 8, 20))])
    landed = frame("id string, ts string", [("1", "2026-08-18 00:00:00"), ("2", "2026-08-19 00:00:00"), ("9", "bad")])
    assert high_watermark(landed, "ts") == t(2026, 8, 19)
    assert [r.id for r in read_incremental(source, landed, "ts").collect()] == [3]
    assert [r.id for r in read_incremental(source, landed, "ts", inclusive=True).collect()] == [2, 3]
    assert read_incremental(source, landed.limit(0), "ts").count() == 3
    # Rows at the watermark that are not landed yet, under whatever key, come along once.
    late = source.union(frame("id int, ts timestamp_ntz", [(4, t(2026, 8, 19)), (None, t(2026, 8, 19)), (2, t(2026, 8, 20))]))
    new = read_incremental(late, landed, "ts", keys=["id"])
    assert sorted((r.id for r in new.collect()), key=str) == [2, 3, 4, None]
    again = landed.union(all_strings(new))
    assert [(r.id, r.ts) for r in read_incremental(late, again, "ts", keys=["id"]).collect()] == []
    path = str(tmp_path / "source")
    source.write.parquet(path)
    plan = read_incremental(spark.read.parquet(path), landed, "ts")._jdf.queryExecution().toString()
    assert "GreaterThan(ts" in plan  # the watermark reaches the scan


def test_lineage_and_string_cast(frame):
    df = with_lineage(all_strings(frame("a int, b double", [(1, None)])), "src", RUN_TS, ingestion_date=True)
    assert as_dicts(df) == [{"a": "1", "b": None, "source_system": "src", "load_timestamp": RUN_TS,
                             "ingestion_date": RUN_TS.date()}]
    assert dict(all_strings(df, except_=["load_timestamp"]).dtypes)["load_timestamp"] == "timestamp_ntz"


def test_rows_are_numbered_by_file_and_line(spark, tmp_path):
    """The larger file is read first by its task, but its rows come second."""
    from tierline.sources import in_scan_order, read_csv_bronze

    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv").write_text("k,v\n1,a\n2,b\n")
    (folder / "b.csv").write_text("k,v\n" + "".join(f"{i},{'x' * 50}\n" for i in range(3, 203)))
    for multi_line in (True, False):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000" if not multi_line else "128m")
        path = str(tmp_path / f"stored-{multi_line}")
        read_csv_bronze(spark, str(folder), ["k", "v"], multi_line, place=True).write.parquet(path)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        rows = in_scan_order(spark.read.parquet(path), "row_seq").orderBy("row_seq").collect()
        assert [int(r["k"]) for r in rows] == list(range(1, 203))
        assert rows[0].asDict().keys() == {"k", "v", "row_seq"}
