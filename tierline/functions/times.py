"""Run times and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def naive_utc(run_ts: dt.datetime) -> dt.datetime:
    """The time in UTC without a zone; a time without a zone is taken as UTC."""
    return run_ts.astimezone(dt.timezone.utc).replace(tzinfo=None) if run_ts.tzinfo else run_ts


def timestamp(run_ts: dt.datetime | str) -> Column:
    """The run's own clock as a literal, so that a rerun gives the same rows."""
    text = run_ts if isinstance(run_ts, str) else naive_utc(run_ts).isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def duration_seconds(start: Column, end: Column) -> Column:
    """Seconds between two instants to two digits."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.round(micros.cast("decimal(20,0)") / 1000000, 2).cast("decimal(20,2)")
