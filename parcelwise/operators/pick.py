"""Top-1 per key as an aggregate.

``row_number() = 1`` sorts every row of a key in one task.  The least struct of ordering and
wanted columns is a single candidate per key, combines on the map side, and lets counts over
the whole key ride in the same shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def ascending(name: str) -> list[Column]:
    """NULLs first, which is how a struct compares."""
    return [F.col(name)]


def descending(df: DataFrame, name: str) -> list[Column]:
    """Largest first, NULLs last."""
    dtype, c = df.schema[name].dataType, F.col(name)
    if isinstance(dtype, T.NumericType):
        flipped = -c
    elif isinstance(dtype, T.DateType):
        flipped = -F.unix_date(c)
    elif isinstance(dtype, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        flipped = -(c - epoch)  # an interval, so no time zone takes part
    elif isinstance(dtype, T.TimestampType):
        flipped = -F.unix_micros(c)
    else:
        raise TypeError(f"cannot order {name} ({dtype.simpleString()}) downwards")
    return [c.isNull(), flipped]


def first_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  order: Sequence[Column], extra: Sequence[Column] = ()) -> DataFrame:
    """``columns`` of the first row per key under ``order``, plus aggregates over the key.

    Rows that are equal under ``order`` are ordered by ``columns``, so a state holds them once."""
    by = [c.alias(f"_by{i}") for i, c in enumerate(order)]
    first = F.min(F.struct(*by, *columns)).alias("_first")
    grouped = df.groupBy(*keys).agg(first, *extra)
    kept = [c for c in grouped.columns if c not in keys and c != "_first"]
    return grouped.select(*keys, *[f"_first.{c}" for c in columns], *kept)
