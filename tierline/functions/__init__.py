from tierline.functions.numbers import average, pct_change
from tierline.functions.text import (
    contains_ignoring_case,
    inferred_id,
    is_missing,
    parse_bool,
    parse_feed_date,
    parse_int,
    parse_iso_timestamp,
    parse_time,
    raw_json,
    strip,
    surrogate_key,
)
from tierline.functions.times import duration_seconds, timestamp

__all__ = [
    "average",
    "contains_ignoring_case",
    "duration_seconds",
    "inferred_id",
    "is_missing",
    "parse_bool",
    "parse_feed_date",
    "parse_int",
    "parse_iso_timestamp",
    "parse_time",
    "pct_change",
    "raw_json",
    "strip",
    "surrogate_key",
    "timestamp",
]
