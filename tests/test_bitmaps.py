"""Mergeable distinct counts against sets."""

import random

from parcelwise.operators import bitmaps
from parcelwise.plans import analysis, profiling
from parcelwise.quality import invariants
from parcelwise.sources.scratch import Scratch

rng = random.Random(6)


def test_counts_equal_sets_and_can_be_merged(spark):
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, *map(str, range(900))]))
            for _ in range(4000)] + [(4, None), (5, "only")] * 3
    df = spark.createDataFrame(rows, "m int, k string").repartition(4)
    bits = bitmaps.bitmaps(df, ["m"], "k", Scratch(spark, "test"))
    got = {r["m"]: r["n"] for r in bitmaps.cardinality(bits, ["m"], "n").collect()}
    keys = {m: {k for x, k in rows if x == m and k is not None} for m in {x for x, _ in rows}}
    assert got == {m: len(k) for m, k in keys.items() if k}
    halves = bits.selectExpr("m <= 2 as low", "bucket", "bits")
    got = {r["low"]: r["n"] for r in bitmaps.cardinality(halves, ["low"], "n").collect()}
    assert got == {True: len(keys[1] | keys[2]), False: len(keys[3] | keys[5]), None: len(keys[None])}
    assert bitmaps.cardinality(bits, [], "n").first()["n"] == len(set.union(*keys.values()))


def test_a_large_group_is_spread_over_buckets(spark):
    df = spark.range(0, 200_000, 1, 8).selectExpr("1 as m", "id * 7919 as k")
    bits = bitmaps.bitmaps(df, ["m"], "k", Scratch(spark, "test"))
    assert bits.count() >= 7
    assert bitmaps.cardinality(bits, ["m"], "n").first()["n"] == 200_000
    none = bitmaps.bitmaps(df.limit(0), ["m"], "k", Scratch(spark, "test"))
    assert bitmaps.cardinality(none, ["m"], "n").collect() == []


def test_no_distinct_count_copies_rows(spark, shop):
    for df in (profiling.review_duplication(shop["raw.order_reviews"]),
               invariants.rfm_at_person_grain(shop, shop.params), shop.build("agg_monthly_sales"),
               analysis.customers_by_period(shop["fct_orders"])):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
