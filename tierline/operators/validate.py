"""Ordered rules that name the first failure of a row, and the valid/reject split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASON = "rejection_reason"

Rule = tuple[Column, Column | str]


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``rejection_reason``: the reason of the first rule that holds, NULL for a valid row.

    A reason may be a column, so it can quote the offending value. All rules are read in one pass.
    """
    reason = F.lit(None).cast("string")
    for failed, text in reversed(rules):
        reason = F.when(failed, F.lit(text) if isinstance(text, str) else text).otherwise(reason)
    return df.withColumn(REASON, reason)


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows of a validated frame."""
    valid = df.where(F.col(REASON).isNull()).drop(REASON)
    return valid, df.where(F.col(REASON).isNotNull())


def rejected_records(rejected: DataFrame, run_id: str, table_name: str, payload: Column) -> DataFrame:
    """Quarantine rows: who rejected what, why, and the raw row as JSON text."""
    return rejected.select(
        F.lit(run_id).alias("run_id"),
        F.lit(table_name).alias("table_name"),
        payload.alias("raw_record_json"),
        REASON,
    )


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count valid and rejected rows while some other action computes them.

    Filters on the result stay above the count, so a split does not evaluate the rules twice.
    """
    seen = Observation()
    valid = F.count_if(F.col(REASON).isNull()).alias("valid")
    rejected = F.count_if(F.col(REASON).isNotNull()).alias("rejected")
    return df.observe(seen, valid, rejected), seen
