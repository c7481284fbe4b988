"""Exact discrete quantiles of any number of groups and measures, spread over all tasks.

`percentile_disc` keeps a map of values per group, and one task merges such a map from every
map task.  Here rows become counts per (group, measure, value), combined on the map side;
the counts are range-partitioned by that key and stored; the counts of each partition say
which one holds the wanted rank; and only that partition's part of the group is searched.
No group, however many rows or distinct values it has, meets in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import fixed
from ..sources.scratch import Scratch

GROUP = ["g", "m"]


class Quantile(NamedTuple):
    """`measure` is a SQL expression, `percent` a whole number; NULLs are ignored."""
    measure: str
    percent: int
    places: int | None = None


def value_counts(rows: DataFrame, keys: Sequence[str], measures: Sequence[str],
                 scratch: Scratch) -> DataFrame:
    """(g, m, v, n, part): stored counts of a group's values, `part` in the order of
    (g, m, v).  g holds the keys, m the position of the measure."""
    values = F.array(*[F.struct(F.lit(i).alias("m"), F.expr(x).cast("double").alias("v"))
                       for i, x in enumerate(measures)])
    long = rows.select(_group(keys), F.inline(values)).where("v is not null")
    counted = long.groupBy(*GROUP, "v").agg(F.count("*").alias("n"))
    return scratch.save(counted.repartitionByRange(*GROUP, "v")
                        .withColumn("part", F.spark_partition_id()), "value_counts")


def _group(keys: Sequence[str]) -> Column:
    """One column for all keys; structs with equal fields are equal, nulls included."""
    return F.struct(F.lit(0).alias("_"), *keys).alias("g")


def at_ranks(counts: DataFrame, percents: Sequence[Sequence[int]]) -> DataFrame:
    """(g, m, percent, v): the smallest value with at least that share of the group's rows
    at or below it, for the percents of each measure."""
    by_part = Window.partitionBy(*GROUP).orderBy("part")
    sizes = counts.groupBy(*GROUP, "part").agg(F.sum("n").alias("size")).select(
        *GROUP, "part", "size", (F.sum("size").over(by_part) - F.col("size")).alias("before"),
        F.sum("size").over(Window.partitionBy(*GROUP)).alias("total"))
    of_measure = F.array(*[F.array(*map(F.lit, p)) for p in percents])
    rank = F.greatest(F.lit(1), F.expr("(percent * total + 99) div 100"))
    hit = sizes.withColumn("percent", F.explode(F.get(of_measure, F.col("m")))) \
        .withColumn("nth", rank - F.col("before")).where("nth > 0 and nth <= size") \
        .select(*GROUP, "part", "percent", "nth")
    in_order = Window.partitionBy(*GROUP, "part", "percent").orderBy("v")
    upto = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return counts.join(hit, [*GROUP, "part"]).withColumn("upto", upto) \
        .where("upto >= nth and upto - n < nth").select(*GROUP, "percent", "v")


def with_quantiles(summary: DataFrame, rows: DataFrame, keys: Sequence[str],
                   wanted: Mapping[str, Quantile]) -> DataFrame:
    """`summary`, one row per `keys`, and a column for each wanted quantile of the rows of
    its group; NULL for a group without values.  Keys may be NULL."""
    measures = list(dict.fromkeys(q.measure for q in wanted.values()))
    percents = [sorted({q.percent for q in wanted.values() if q.measure == x}) for x in measures]
    counts = value_counts(rows, keys, measures, Scratch(rows.sparkSession, "quantiles"))
    found = at_ranks(counts, percents)

    def column(name: str, q: Quantile) -> Column:
        here = (F.col("m") == measures.index(q.measure)) & (F.col("percent") == q.percent)
        value = F.max(F.when(here, F.col("v")))
        return (value if q.places is None else fixed(value, q.places)).alias(name)

    wide = found.groupBy("g").agg(*[column(name, q) for name, q in wanted.items()])
    return summary.withColumn("g", _group(keys)).join(wide, "g", "left").drop("g")
