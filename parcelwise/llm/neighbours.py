"""The row that follows each row in the order of an id, without one window over all rows.

Approximate quantiles of the id cut the order into at most QUANTILES ranges of about as many
rows each; within a range, groups are cut by the leading bits of the distance from its start.
So an outlying id widens only its own range, and an id that many rows share (or null) is cut
by the leading bits of the tie instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

GROUP = 256  # rows that share a window on average
QUANTILES = 1024
STEP = 32  # range starts that are compared at once
SUB_BITS = 48  # of a group number, for the groups of a range
NULL = -2 ** 63  # stands for null ids, which come first


def bits_for(rows: float) -> int:
    """Bits that number the groups of so many rows."""
    return (int(rows) // GROUP).bit_length()


class Ranges:
    """Starts of the ranges, and how each is cut: `shift` bits are dropped from the distance
    of an id; `bits` leading bits of the tie number the groups of the start itself."""

    def __init__(self, borders: list[int], highest: int, n: int):
        each = n / QUANTILES
        self.starts = sorted(set(borders))
        self.bits = [bits_for(borders.count(s) * each) if borders.count(s) > 1 else 0
                     for s in self.starts]
        self.shift = [min(63, max(0, (e - s).bit_length() - bits_for(each)))
                      for s, e in zip(self.starts, [*self.starts[1:], highest + 1])]

    def group(self, key: Column, tie: Column) -> Column:
        """A number that rises with (key, tie)."""
        def upto(starts: Column) -> Column:
            return F.size(F.filter(starts, lambda s: s <= key)) - 1

        def shifted(way: str, x: Column, by: Column) -> Column:
            return F.call_function(way, x.cast("long"), by.cast("int"))

        chunks = [self.starts[i:i + STEP] for i in range(0, len(self.starts), STEP)]
        chunks = [c + [2 ** 63 - 1] * (STEP - len(c)) for c in chunks]
        chunk = upto(F.lit([c[0] for c in chunks]))
        q = F.least(chunk * STEP + upto(F.get(F.lit(chunks), chunk)), F.lit(len(self.starts) - 1))
        start, bits, shift = (F.get(F.lit(x), q) for x in (self.starts, self.bits, self.shift))
        of_tie = shifted("shiftright", tie, 64 - bits) + shifted("shiftleft", F.lit(1), bits - 1)
        beyond = shifted("shiftleft", F.lit(1), bits) \
            + shifted("shiftright", key, shift) - shifted("shiftright", start, shift)
        sub = F.when(key > start, beyond).when(bits > 0, of_tie).otherwise(F.lit(0).cast("long"))
        return shifted("shiftleft", q, F.lit(SUB_BITS)) + sub


def ranges(rows: DataFrame, key: Column) -> Ranges | None:
    """None without rows."""
    shares = [i / QUANTILES for i in range(QUANTILES)]
    lowest, highest, n, borders = rows.agg(
        F.min(key), F.max(key), F.count(F.lit(1)), F.percentile_approx(key, shares)).first()
    return Ranges([lowest, *borders], highest, n) if n else None


def with_next(rows: DataFrame, key: Column, tie: Column, carried: list[str],
              prefix: str = "next_", derive=lambda df: df) -> DataFrame:
    """Add the `carried` columns of the row with the next larger (key, tie); the last row
    gets those of the first.  Null keys come first.  `derive` adds columns that are costly to
    compute: once for every row, and again only for the first rows of groups.

    Only the first row of a group travels to the group before it.
    """
    # The two lowest ids share a number, so that null has one of its own.
    whole = F.when(key.isNull(), NULL).otherwise(F.greatest(key.cast("long"), F.lit(NULL + 1)))
    cuts = ranges(rows, whole)
    if cuts is None:
        rows = derive(rows)
        return rows.select("*", *[F.col(c).alias(prefix + c) for c in carried])
    order = Window.partitionBy("_g").orderBy("_key", "_tie")
    placed = rows.select("*", key.alias("_key"), tie.alias("_tie"), cuts.group(whole, tie).alias("_g"))
    inner = derive(placed).withColumn("_next", F.lead(F.struct(*carried)).over(order))
    heads = derive(placed.withColumn("_n", F.row_number().over(order)).where("_n = 1")) \
        .select("_g", F.struct(*carried).alias("_head"))

    # Groups in order: inside a range, then from range to range, at most QUANTILES rows.
    groups = heads.select("_g", F.shiftright("_g", SUB_BITS).alias("_q"))
    inside = groups.withColumn("_to", F.lead("_g").over(Window.partitionBy("_q").orderBy("_g")))
    first = groups.groupBy("_q").agg(F.min("_g").alias("_first"))
    ring = Window.partitionBy(F.lit(0))
    turn = first.select("_q", F.coalesce(
        F.lead("_first").over(ring.orderBy("_q")), F.min("_first").over(ring)).alias("_turn"))
    onto = inside.join(turn, "_q").select("_g", F.coalesce("_to", "_turn").alias("_to")) \
        .join(heads.withColumnRenamed("_g", "_to"), "_to").select("_g", "_head")
    got = F.coalesce("_next", "_head")
    mine = [c for c in inner.columns if c not in ("_g", "_key", "_tie", "_next")]
    return inner.join(onto, "_g", "left").select(
        *mine, *[got.getField(c).alias(prefix + c) for c in carried])
