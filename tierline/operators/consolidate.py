"""Merge two descriptions of the same entities into one row per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions import is_missing, strip


def consolidate(
    left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str]
) -> DataFrame:
    """Full outer join on the stripped key; columns of both sides get the suffixes.

    Rows without a key identify nothing, so they are passed on one by one instead of being
    paired with each other: n and m such rows stay n + m rows and not n * m.
    """
    shared = [c for c in left.columns if c in right.columns and c != key]
    sides = []
    for frame, suffix in zip((left, right), suffixes, strict=True):
        named = frame.select(
            strip(F.col(key)).alias(key),
            *[F.col(c).alias(c + suffix if c in shared else c) for c in frame.columns if c != key],
        )
        sides.append(named)
    a, b = sides
    keyed = a.where(~is_missing(F.col(key))).join(b.where(~is_missing(F.col(key))), key, "full")
    for frame in sides:
        keyed = keyed.unionByName(frame.where(is_missing(F.col(key))), allowMissingColumns=True)
    return keyed
