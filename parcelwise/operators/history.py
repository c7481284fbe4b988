"""Type-2 history by comparing check columns, with deletions closed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def _local(instant: datetime) -> Column:
    return F.lit(instant.isoformat(sep=" ")).cast("timestamp_ntz")


def single_rows(current: DataFrame, key: str) -> DataFrame:
    """The frame, failing while it runs if a key stands in two rows: each would open a
    version of its own."""
    n = F.count(F.lit(1))
    once = current.groupBy(key).agg(*[F.first(c).alias(c) for c in current.columns if c != key],
                                    n.alias("_rows"))
    said = F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string"))
    return once.withColumn(key, F.when(F.col("_rows") > 1, F.raise_error(said))
                           .otherwise(F.col(key))).select(*current.columns)


def snapshot(current: DataFrame, history: DataFrame | None, key: str,
             check: Sequence[str], run_at: datetime, close_deleted: bool = True) -> DataFrame:
    """Next version of the history; the caller stores it as a new version.

    One full outer join of the open rows with the current table decides every key, and
    each key emits its closed row, its new row, or both.  Rows closed earlier pass by.
    """
    now = _local(run_at)
    payload = current.columns
    open_ended = F.lit(None).cast("timestamp_ntz")
    if history is None:
        return current.select("*", now.alias("valid_from"), open_ended.alias("valid_to"))

    live = history.where("valid_to is null").select(
        F.col(key).alias("_k"), F.struct(*payload, "valid_from").alias("old"))
    fresh = current.select(F.col(key).alias("_f"), F.struct(*payload).alias("new"))
    both = live.join(fresh, F.col("_k").eqNullSafe(F.col("_f")), "full_outer")

    old, new = F.col("old"), F.col("new")
    changed = F.lit(False)
    for c in check:
        changed = changed | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    deleted = new.isNull() & F.lit(close_deleted)
    ends = old.isNotNull() & (deleted | (new.isNotNull() & changed))
    kept_row = F.struct(*[F.col(f"old.{c}").alias(c) for c in payload],
                        F.col("old.valid_from").alias("valid_from"),
                        F.when(ends, now).alias("valid_to"))
    new_row = F.struct(*[F.col(f"new.{c}").alias(c) for c in payload],
                       now.alias("valid_from"), open_ended.alias("valid_to"))
    rows = F.array_compact(F.array(
        F.when(old.isNotNull(), kept_row),
        F.when(new.isNotNull() & (old.isNull() | changed), new_row)))
    decided = both.select(F.explode(rows).alias("r")).select("r.*")
    return history.where("valid_to is not null").select(*decided.columns).unionByName(decided)


def as_of(history: DataFrame, instant: datetime) -> DataFrame:
    """Rows valid at ``instant``; the end is exclusive."""
    at = _local(instant)
    return history.where((F.col("valid_from") <= at)
                         & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
