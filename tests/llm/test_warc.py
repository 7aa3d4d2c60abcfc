"""WARC: round trips, magic lines inside payloads, broken files."""

import base64
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tierline.llm.registry import ORACLES
from tierline.llm.warc import MAGIC, op5_warc_boundary_chain, plan_revisits, read_warc, write_warc

PAGES = "page_id long, url string, html string, digest string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_query(spark, sf_dir):
    assert difference(op5_warc_boundary_chain(spark, sf_dir), connect(sf_dir), ORACLES["op5_warc_boundary_chain"]) == ""


@pytest.fixture
def small_blocks(spark):
    """Files are read in many blocks, so that records and magic lines lie across them."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_payloads_with_records_inside(spark, tmp_path, small_blocks):
    inner = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 40), "x") for i in range(60)]
    rows += [(100, "http://h/x", "before " + inner, "x"), (101, None, inner * 3 + "after", "x")]
    rows += [(102, "a\r\nWARC-Type: evil", MAGIC, "x"), (103, "u", MAGIC * 2 + "tail \r\n\r\n", "x")]
    rows += [(None, "u", "no id", "x"), (104, "u", None, "x"), (105, "u", "", "x"), (106, "u", "é" * 50, "x")]
    # Copies: the smallest id is the response, also if a row has none.
    rows += [(107, "u", "copy", "x"), (99, "u", "copy", "x"), (99, "v", "copy", "x"), (None, "w", "copy", "x")]
    path = str(tmp_path / "warc")
    write_warc(spark.createDataFrame(rows, PAGES).repartition(2), path)
    got = read_warc(spark, path).collect()
    assert len(got) == len(rows)
    found = sorted(
        (r["header"].split("<urn:page:")[1].split(">")[0], "WARC-Type: revisit" in r["header"], r["payload_digest"])
        for r in got
        if "WARC-Type: response" in r["header"]
    )
    want = sorted(
        ("none" if p is None else str(p), False, digest(h)) for p, _, h, _ in rows if h not in ("copy", "", None)
    )
    responses = [x for x in found if x[2] not in (digest("copy"), digest(""))]
    assert responses == want
    # One of the empty payloads and one of the copies is a response.
    assert [x[0] for x in found if x[2] == digest("")] == ["0"]
    assert [x[0] for x in found if x[2] == digest("copy")] == ["99"]


def test_rows_in_changing_order(spark):
    """Each payload has one response, although a shuffled input is read in another order by each job."""
    rows = spark.range(2000).selectExpr("CAST(NULL AS BIGINT) AS page_id", "'u' AS url", "concat('p', id % 50) AS html")
    planned = plan_revisits(rows.repartition(7))
    assert planned.where("NOT revisit").count() == 50
    assert planned.count() == 2000 and planned.where("bytes IS NULL OR digest IS NULL").count() == 0
    assert planned.groupBy("digest").agg(F.sum(F.expr("int(NOT revisit)")).alias("n")).where("n <> 1").count() == 0


def test_empty_and_broken(spark, tmp_path):
    path = str(tmp_path / "none")
    write_warc(spark.createDataFrame([], PAGES), path)
    assert read_warc(spark, path).count() == 0
    broken = tmp_path / "broken"
    os.makedirs(broken)
    record = MAGIC + "WARC-Type: response\r\nContent-Length: {}\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc\r\n\r\n"
    (broken / "a.warc").write_bytes(record.format(22).encode() + record.format(9999).encode() + record.format(22).encode())
    (broken / "b.warc").write_bytes(b"junk" + record.format(22).encode())
    got = read_warc(spark, str(broken)).collect()
    # The chain of the first file ends at the record that claims too much; the second has no start.
    assert [(r["start"], r["payload_bytes"]) for r in got] == [(0, 3)]
