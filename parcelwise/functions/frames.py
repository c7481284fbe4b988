"""Combining frames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name, paired up level by level.

    Spark analyses the plan at every union; pairing keeps each frame in a few unions only,
    where a chain would analyse the first one again for every later one.
    """
    level = list(frames)
    if not level:
        raise ValueError("nothing to combine")
    while len(level) > 1:
        level = [level[i].unionByName(level[i + 1]) if i + 1 < len(level) else level[i]
                 for i in range(0, len(level), 2)]
    return level[0]


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row: distinct values that are not NULL.  Several such counts in one aggregate
    would copy every row once for each."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().agg(
        F.count("*").alias(name))
