"""Distinct counts that can be merged, exactly.

Every distinct key gets a number; a group's keys become bitmaps of 32,768 numbers each.
Bitmaps of several groups are merged by OR, so months give quarters, categories give totals,
and no key is counted again from the rows.  A group's bitmaps are spread over tasks by
bucket, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import Scratch


def numbered(rows: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(key, number): stored, one row per distinct key that is not NULL.  Numbers are dense
    within each task that assigned them, so bitmaps are well filled."""
    keys = rows.where(F.col(key).isNotNull()).select(key).distinct()
    return scratch.save(keys.withColumn("number", F.monotonically_increasing_id()), "numbers")


def bitmaps(rows: DataFrame, by: Sequence[str], key: str, scratch: Scratch) -> DataFrame:
    """(by..., bucket, bits): stored.  Rows are reduced to distinct pairs of group and key
    before they meet the numbers, so a key has one row a group there."""
    pairs = rows.select(*by, key).distinct()
    number = F.col("number")
    placed = pairs.join(numbered(rows, key, scratch), key)
    return scratch.save(placed.groupBy(*by, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")), "bitmaps")


def merged(bits: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups, or of everything for no `by`."""
    return bits.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def cardinality(bits: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """(by..., name): distinct keys of each group; unlike counts, groups cannot be added up."""
    return merged(bits, by).groupBy(*by).agg(
        F.sum(F.bitmap_count("bits")).cast("bigint").alias(name))
