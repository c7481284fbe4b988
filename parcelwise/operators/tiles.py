"""Equal-count tiles over a whole table without a single-task window.

``ntile(5) over (order by x)`` sorts everything in one task.  Only the last row of each
tile matters, so the sort columns alone are range-partitioned and stored; partition
counts say which partitions hold the wanted ranks; the boundary rows (tiles - 1 per
ordering) are read from those; and tiles are then assigned by comparing each row with
the boundaries, without moving the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import Scratch


def tile_boundaries(df: DataFrame, orderings: Mapping[str, Sequence[str]], unique: str,
                    tiles: int, scratch: Scratch) -> dict[str, list[tuple]]:
    """Last row of tiles 1..tiles-1 per ordering, as tuples of the sort columns.

    All orderings share one range shuffle.  ``unique`` ends every ordering, so equal
    values never pile up in one partition.  NULLs sort first.
    """
    depth = max(len(cols) for cols in orderings.values())
    parts = None
    for name, cols in orderings.items():
        padded = [F.col(c) for c in cols] + [F.lit(None)] * (depth - len(cols))
        one = df.select(F.lit(name).alias("o"),
                        *[c.alias(f"v{i}") for i, c in enumerate(padded)],
                        F.col(unique).alias("u"))
        parts = one if parts is None else parts.unionByName(one)
    sort = [f"v{i}" for i in range(depth)] + ["u"]
    stored = scratch.save(
        parts.repartitionByRange("o", *sort).withColumn("part", F.spark_partition_id()),
        "tile_keys")

    # A few rows per partition and ordering from here on.
    by_part = Window.partitionBy("o").orderBy("part")
    sizes = stored.groupBy("o", "part").agg(F.count("*").alias("n")).select(
        "o", "part", "n",
        (F.sum("n").over(by_part) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("o")).alias("total"))
    i = F.col("tile")
    last_rank = i * F.floor(F.col("total") / tiles) + F.least(i, F.col("total") % tiles)
    wanted = (
        sizes.withColumn("tile", F.explode(F.sequence(F.lit(1), F.lit(tiles - 1))))
        .withColumn("nth", last_rank - F.col("before"))
        .where((F.col("nth") > 0) & (F.col("nth") <= F.col("n")))
        .select("o", "part", "tile", "nth")
    )
    row = F.row_number().over(Window.partitionBy("o", "part", "tile").orderBy(*sort))
    boundary_rows = (
        stored.join(F.broadcast(wanted), ["o", "part"])  # (tiles - 1) rows per ordering
        .withColumn("row", row).where("row = nth")
        .select("o", "tile", *sort).collect()
    )
    found = {(r["o"], r["tile"]): r for r in boundary_rows}
    return {
        name: [tuple(found[name, t][f"v{i}"] for i in range(len(cols))) + (found[name, t]["u"],)
               for t in range(1, tiles) if (name, t) in found]
        for name, cols in orderings.items()
    }


def _after(columns: Sequence[str], bound: Sequence) -> Column:
    """Row sorts after ``bound`` lexicographically, NULLs first."""
    verdict = F.lit(False)
    for name, value in reversed(list(zip(columns, bound))):
        c = F.col(name)
        later = c.isNotNull() if value is None else c > F.lit(value)
        verdict = F.coalesce(later, F.lit(False)) | (c.eqNullSafe(F.lit(value)) & verdict)
    return verdict


def tile_of(columns: Sequence[str], boundaries: Sequence[tuple]) -> Column:
    """1 + how many tile ends lie before the row."""
    tile = F.lit(1)
    for bound in boundaries:
        tile = tile + _after(columns, bound).cast("int")
    return tile
