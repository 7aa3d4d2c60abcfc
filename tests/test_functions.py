import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tierline.functions import (
    average,
    contains_ignoring_case,
    duration_seconds,
    inferred_id,
    is_missing,
    parse_bool,
    parse_feed_date,
    parse_int,
    parse_iso_timestamp,
    pct_change,
    raw_json,
    strip,
    surrogate_key,
    timestamp,
)

D = dt.date


def evaluate(frame, fn, values):
    df = frame("i int, x string", list(enumerate(values)))
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "fn, cases",
    [
        (
            parse_int,
            {
                "12.9": 12, "-3.7": -3, "1e3": 1000, " 7 ": 7, "\t4\n": 4, "0": 0, "+5": 5, ".5": 0,
                "5.": 5, " 8 ": 8, "": None, None: None, "nan": None, "inf": None,
                "1d": None, "1f": None, "0x1p3": None, "abc": None, "1_000": None, "1e400": None,
                "1e30": None, "- 5": None, "5 5": None, "5\n5": None, "9007199254740993": 9007199254740992,
            },
        ),
        (
            parse_bool,
            {
                "True": True, "t": True, "1": True, " YES ": True, "False": False, "f": False,
                "0": False, "no": False, "y": None, "n": None, "on": None, "": None, None: None,
                "true story": None,
            },
        ),
        (
            parse_feed_date,
            {
                "17.14.11": D(2017, 11, 14), "17.1.2": D(2017, 2, 1), "70.14.11": D(1970, 11, 14),
                "69.14.11": D(1969, 11, 14), "68.14.11": D(2068, 11, 14), " 17.14.11\t": D(2017, 11, 14),
                "17. 1.11": D(2017, 11, 1), "17.29.02": None, "16.29.02": D(2016, 2, 29),
                "17.14.13": None, "17.31.02": None, "17. 14.11": None, "2017.14.11": None,
                "17.00.11": None, "17-11-14": None, "corrupted_date": None, "": None, None: None,
            },
        ),
        (
            parse_iso_timestamp,
            {
                "2017-11-13T17:13:01.000Z": dt.datetime(2017, 11, 13, 17, 13, 1),
                "2017-11-13T17:13:01+02:00": dt.datetime(2017, 11, 13, 15, 13, 1),
                " 2017-11-13 17:13:01 ": dt.datetime(2017, 11, 13, 17, 13, 1),
                "2017-11-13": dt.datetime(2017, 11, 13), "12:13:01": None, "bad": None, "": None,
                "2017-13-45": None, None: None,
            },
        ),
        (is_missing, {None: True, "": True, "  ": True, "nan": True, " nan ": True, "NaN": False, "x": False}),
        (strip, {" a b ": "a b", "\x1c　x": "x", "": "", None: None}),
    ],
)
def test_text_builders(frame, fn, cases):
    assert evaluate(frame, fn, list(cases)) == list(cases.values())


def test_parse_int_narrow_range(frame):
    assert evaluate(frame, lambda c: parse_int(c, "int"), ["2147483647", "2147483648"]) == [2147483647, None]


def test_substring_match_escapes_wildcards(frame):
    titles = ["100% Pure", "100 Pure", "a_b", "aXb"]
    assert evaluate(frame, lambda c: contains_ignoring_case(c, "100% p"), titles) == [True, False, False, False]
    assert evaluate(frame, lambda c: contains_ignoring_case(c, "A_B"), titles) == [False, False, True, False]
    assert evaluate(frame, lambda c: contains_ignoring_case(c, "A_B", wildcards=True), titles)[2:] == [True, True]


def test_raw_json_keeps_or_drops_nulls(frame):
    df = frame("a string, b string", [('q"é', None)])
    assert df.select(raw_json(["a", "b"])).first()[0] == '{"a":"q\\"é","b":null}'
    assert df.select(raw_json(["a", "b"], keep_nulls=False)).first()[0] == '{"a":"q\\"é"}'


def test_keys_depend_on_their_row_alone(frame):
    df = frame("k string, v int", [("x", 1)])
    key, again = df.select(surrogate_key(F.col("k"), F.col("v")), F.md5(F.lit("x|1"))).first()
    assert key == again
    assert df.select(inferred_id(F.col("k"))).first()[0] == "inferred_9dd4e461268c8034f5c8564e155c67a6"


@pytest.mark.parametrize(
    "value, previous, expected",
    [(150, None, "0.00"), (150, 0, "0.00"), (150, 100, "50.00"), (15001, 10000, "50.01"), (50, 100, "-50.00"),
     (2, 3, "-33.33"), (10**15, 3, "33333333333333233.33")],
)
def test_pct_change(frame, value, previous, expected):
    df = frame("v bigint, p bigint", [(value, previous)])
    assert df.select(pct_change(F.col("v"), F.col("p"))).first()[0] == decimal.Decimal(expected)


def test_average_rounds_half_up(frame):
    df = frame("s bigint, n bigint", [(96700818, 25), (1, 8), (5, 1000)])
    assert [str(r[0]) for r in df.select(average(F.col("s"), F.col("n"))).collect()] == ["3868032.72", "0.13", "0.01"]


def test_times(frame):
    df = frame("x int", [(1,)]).select(
        timestamp(dt.datetime(2024, 1, 1, 0, 0, 0)).alias("a"), timestamp("2024-01-01 00:05:00.255").alias("b")
    )
    assert df.select(duration_seconds(F.col("a"), F.col("b"))).first()[0] == decimal.Decimal("300.26")


def test_other_times(frame):
    from tierline.functions.text import parse_time

    cases = {
        "2024-01-02T03:04:05.000Z": "2024-01-02 03:04:05", "1/2/2024 3:04": "2024-01-02 03:04:00", "2 Jan 2024": "2024-01-02 00:00:00",
        "Tue, 02 Jan 2024 03:04:05 GMT": "2024-01-02 03:04:05", "January 2, 2024": "2024-01-02 00:00:00", "20240102": "2024-01-02 00:00:00",
        "2024/1/2": "2024-01-02 00:00:00", "12:30": None, "bad": None, "13/45/2024": None, "": None, None: None,
    }
    rows = frame("t string", [(t,) for t in cases]).select("t", parse_time(F.col("t")).cast("string").alias("v")).collect()
    assert {r["t"]: r["v"] for r in rows} == cases
