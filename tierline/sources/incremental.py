"""Incremental table scans above a high watermark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions import parse_iso_timestamp, timestamp


def high_watermark(target: DataFrame, ts_col: str) -> dt.datetime | None:
    """Largest timestamp already landed; the landed column may be text."""
    return target.agg(F.max(_time(target, ts_col)).alias("wm")).first()["wm"]


def _time(rows: DataFrame, ts_col: str) -> Column:
    ts = F.col(ts_col)
    if rows.schema[ts_col].dataType.typeName() == "string":
        ts = parse_iso_timestamp(ts)
    return ts.cast("timestamp_ntz")


def read_incremental(
    source: DataFrame,
    target: DataFrame,
    ts_col: str,
    inclusive: bool = False,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Source rows newer than everything in ``target``; all rows while the target is empty.

    The watermark is one scalar, so the comparison reaches the source scan as a pushed filter.
    ``inclusive`` also reads rows that share the watermark. With ``keys`` it leaves out those that the target
    already holds under the same key, so that rows which arrive late with the watermark's own time are
    landed once; the boundary set is the target's rows at the watermark, not the whole target.
    """
    wm = high_watermark(target, ts_col)
    if wm is None:
        return source
    bound = timestamp(wm).cast(source.schema[ts_col].dataType)
    if keys is None:
        return source.where(F.col(ts_col) >= bound if inclusive else F.col(ts_col) > bound)
    new = source.where(F.col(ts_col) >= bound)
    landed = target.where(_time(target, ts_col) == timestamp(wm))
    known = landed.select([F.col(k).cast("string").alias(f"_landed_{k}") for k in keys]).distinct()
    at_bound = new[ts_col] == bound
    same = reduce(and_, [new[k].cast("string").eqNullSafe(F.col(f"_landed_{k}")) for k in keys])
    return new.join(known, at_bound & same, "left_anti")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A database table as a frame; give a partition column to read it with parallel tasks.

    Filters placed on the frame, such as the watermark of ``read_incremental``, go to the database.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.load()
