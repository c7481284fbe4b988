"""Distributed quantiles against sorted lists."""

import random

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import quantiles, staging
from parcelwise.operators.quantiles import Quantile, with_quantiles
from parcelwise.sources.layout import schema_of
from parcelwise.sources.scratch import Scratch

rng = random.Random(3)
PERCENTS = (1, 33, 50, 90, 99, 100)


def disc(values, percent):
    """Smallest value with at least that share of the values at or below it."""
    kept = sorted(v for v in values if v is not None)
    return kept[-(-percent * len(kept) // 100) - 1] if kept else None


@pytest.fixture()
def many_parts(spark):
    kept = {k: spark.conf.get(k, None) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_equal_sorted_lists(spark, many_parts):
    """Groups of 0 to 3,000 rows, null keys and values, ties, negative and equal values."""
    rows = [(k, s, rng.choice([None, float(rng.randrange(-9, 9)), rng.uniform(-1e3, 1e3)]),
             rng.randrange(4) if k else None)
            for k in (None, 1, 2, 3, 4) for s in (None, "a") for _ in range((k or 0) ** 4 * 10 + 1)]
    df = spark.createDataFrame(rows, "k int, s string, x double, y int").repartition(5)
    wanted = {f"x{p}": Quantile("x", p) for p in PERCENTS} | {
        f"y{p}": Quantile("y * 2", p, 1) for p in PERCENTS}
    got = with_quantiles(df.groupBy("k", "s").agg(F.count("*").alias("n")), df, ["k", "s"],
                         wanted).collect()
    assert len(got) == 10
    for r in got:
        own = [q for q in rows if q[0] == r["k"] and q[1] == r["s"]]
        assert r["n"] == len(own)
        for p in PERCENTS:
            assert r[f"x{p}"] == disc([q[2] for q in own], p)
            assert r[f"y{p}"] == disc([None if q[3] is None else 2.0 * q[3] for q in own], p)


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(None,), (2.0,), (1.0,)], "x double")
    count = F.count("*").alias("n")
    assert with_quantiles(df.agg(count), df, [], {"m": Quantile("x", 50)}).first().asDict() == {
        "n": 3, "m": 1.0}
    none = df.limit(0)
    assert with_quantiles(none.agg(count), none, [], {"m": Quantile("x", 50)}).first()["m"] is None
    assert with_quantiles(none.groupBy("x").agg(count), none, ["x"],
                          {"m": Quantile("x", 50)}).collect() == []


def test_prefix_with_many_points_has_the_exact_median(spark, many_parts):
    n = 50_001
    points = spark.range(n).select(
        F.lit(100).cast("long").alias("geolocation_zip_code_prefix"),
        (F.pmod(F.col("id") * 7919, n) / 1e6 - 23).alias("geolocation_lat"),
        (F.pmod(F.col("id") * 104729, n) / 1e6 - 46).alias("geolocation_lng"),
        F.lit("sp").alias("geolocation_city"), F.lit("SP").alias("geolocation_state"))
    assert set(points.columns) <= {f.name for f in schema_of("geolocation")}
    row, = staging.geolocation(points).collect()
    assert row["geolocation_point_count"] == n
    assert row["latitude"] == (n // 2) / 1e6 - 23 and row["longitude"] == (n // 2) / 1e6 - 46


def test_one_group_of_many_map_tasks_is_spread(spark, many_parts):
    """200 map tasks, one group, distinct values: no task counts or searches more than its
    part, and no aggregate keeps a map of values."""
    df = spark.range(0, 60_000, 1, 200).selectExpr("id / 7D as x")
    counts = quantiles.value_counts(df, [], ["x"], Scratch(spark, "test"))
    parts = [r["count"] for r in counts.groupBy("part").count().collect()]
    assert len(parts) == 16 and max(parts) < 3 * 60_000 / 16
    found = quantiles.at_ranks(counts, [[50]])
    assert found.first()["v"] == 29_999 / 7.0
    plan = found._jdf.queryExecution().executedPlan().toString()
    for single in ("SinglePartition", "percentile", "collect_list", "NestedLoop"):
        assert single not in plan


def test_models_keep_no_value_maps(spark, shop):
    for name in ("agg_delivery_by_route", "agg_delivery_monthly", "agg_product_performance",
                 "stg_geolocation"):
        plan = shop.build(name)._jdf.queryExecution().toString()
        assert "percentile" not in plan
