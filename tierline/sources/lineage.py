"""Columns added while landing raw rows (K7, K8)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions import timestamp


def with_lineage(
    df: DataFrame, source_system: str, run_ts: dt.datetime, ingestion_date: bool = False
) -> DataFrame:
    """Stamp where and when the rows were landed; the run's clock is a parameter."""
    columns = {"source_system": F.lit(source_system), "load_timestamp": timestamp(run_ts)}
    if ingestion_date:
        columns["ingestion_date"] = timestamp(run_ts).cast("date")
    return df.withColumns(columns)


def all_strings(df: DataFrame, except_: Collection[str] = ()) -> DataFrame:
    """Every column as a string, NULL kept (K8)."""
    return df.select(
        [F.col(c) if c in except_ else F.col(c).cast("string").alias(c) for c in df.columns]
    )
