"""Spreading a hot join key over several tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
SALTS = 16


def salted(
    left: DataFrame, right: DataFrame, spread_by: Column, salts: int = SALTS
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt column to add to an equi-join that keeps all rows of the left side.

    Left rows of one key fall into ``salts`` groups by ``spread_by``; each right row is repeated
    once per group. Meant for a right side with one narrow row per key. Adaptive execution alone
    does not split such a join when the right side is an aggregate already placed by the key.
    """
    place = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return left.withColumn(SALT, place), right.withColumn(SALT, numbers)
