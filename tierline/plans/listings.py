"""Small reports used to verify a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_source(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("source_system").agg(F.count(F.lit(1)).alias("n"))


def rejections_per_reason(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("table_name", "rejection_reason").agg(F.count(F.lit(1)).alias("n"))


def version_history(
    dim: DataFrame, key: str, ids: Sequence[str] | None, attribute: str
) -> DataFrame:
    """All versions of the named members, or of all members, in order."""
    named = dim if ids is None else dim.where(F.col(key).isin(*ids))
    return (
        named.select(
            key,
            attribute,
            "version_number",
            "effective_start_date",
            "effective_end_date",
            "is_current",
        )
        .orderBy(key, "version_number")
    )
