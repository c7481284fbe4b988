"""Joins of a fact with a frame that is unique on the key, and reductions of a fact to a row
per key, where few keys own many rows.

A mergeable frequent-items sketch over the fact's keys names the heavy ones.  Their rows get
a salt from a hash of the row, and the other side's row of a heavy key is there once for each
salt; all other keys are joined as they are.  This does not depend on adaptive settings, and a
fact without heavy keys keeps its plain plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

TRACKED = 10_000  # keys that the sketch of a task holds
MOST = 1_000  # keys that can be heavy
PIECES = 8  # salts per even share of rows


def heavy_keys(facts: DataFrame, key: str) -> dict:
    """key -> number of salts, for keys with more rows than an even share of a task.

    A key above an even share is among the first MOST of the sketch, as long as there are
    fewer than MOST shuffle partitions; NULL stands for rows without a key."""
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, top = facts.agg(F.count("*"), F.expr(f"approx_top_k(`{key}`, {MOST}, {TRACKED})")).first()
    return {r["item"]: PIECES * -(-r["count"] * tasks // n)
            for r in top or [] if r["count"] * tasks > n}


def join_unique(facts: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """`facts` left join `other`, which has one row a key."""
    heavy = heavy_keys(facts, key)
    if not heavy:
        return facts.join(other, key, "left")
    salts = F.lit(1)
    for value, pieces in heavy.items():
        here = F.col(key).isNull() if value is None else F.col(key) == value
        salts = F.when(here, pieces).otherwise(salts)
    of_row = F.xxhash64(*[c for c, kind in facts.dtypes if not kind.startswith("map")])
    salted = facts.withColumn("_salt", F.pmod(of_row, salts).cast("int"))
    copies = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def reduced(facts: DataFrame, key: str, light: Callable[[DataFrame], DataFrame],
            hot: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows per key: `light` of the facts with the rows of a key in one task, and `hot` of the
    rows of heavy keys as they lie, which should combine them before they are shuffled."""
    heavy = heavy_keys(facts, key)
    if not heavy:
        return light(facts.repartition(key))
    known = [k for k in heavy if k is not None]
    is_heavy = F.when(F.col(key).isNull(), F.lit(None in heavy)).otherwise(
        F.col(key).isin(known) if known else F.lit(False))
    return light(facts.where(~is_heavy).repartition(key)).unionByName(hot(facts.where(is_heavy)))
