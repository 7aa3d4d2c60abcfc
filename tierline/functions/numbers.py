"""Exact two-digit ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(20,0)"


def average(total: Column, n: Column) -> Column:
    """``total / n`` rounded half up on decimals; ``avg`` of a bigint would be a double."""
    return F.round(total.cast(EXACT) / n.cast(EXACT), 2).cast("decimal(20,2)")


def pct_change(value: Column, previous: Column) -> Column:
    """Percentage change; 0.00 where there is no previous value or it is zero."""
    change = F.round((value.cast(EXACT) - previous.cast(EXACT)) / previous.cast(EXACT) * 100, 2)
    return (
        F.when(previous.isNull() | (previous == 0), F.lit(0))
        .otherwise(change)
        .cast("decimal(20,2)")
    )
