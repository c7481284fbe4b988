"""Tiles against a sort in plain Python."""

import random
from decimal import Decimal

import pytest

from parcelwise.operators.tiles import tile_boundaries, tile_of
from parcelwise.sources.scratch import Scratch


def expected(rows, key, tiles):
    ranked = sorted(rows, key=key)
    q, r = divmod(len(rows), tiles)
    out, i = {}, 0
    for t in range(1, tiles + 1):
        for row in ranked[i:i + q + (t <= r)]:
            out[row[0]] = t
        i += q + (t <= r)
    return out


def low_null(v):
    return (v is not None, v if v is not None else 0)


def make(n, seed, hot):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        recency = 7 if rng.random() < hot else rng.randrange(40)
        money = None if rng.random() < 0.1 else Decimal(rng.randrange(10 ** 6)) / 100
        rows.append((f"k{rng.randrange(10 ** 9)}-{i}", recency, money))
    return rows


@pytest.mark.parametrize("n, tiles, hot", [(1, 5, 0), (3, 5, 0), (5, 5, 0.5), (503, 5, 0.34),
                                           (1000, 4, 0.97), (777, 10, 0)])
def test_tiles_match_a_sort(spark, n, tiles, hot):
    rows = make(n, n, hot)
    df = spark.createDataFrame(rows, "k string, recency bigint, money decimal(20,2)")
    orderings = {"a": ["recency"], "b": ["recency", "money"], "c": ["money"]}
    ends = tile_boundaries(df, orderings, "k", tiles, Scratch(spark, "tiles"))
    got = df.select("k", *[tile_of([*cols, "k"], ends[o]).alias(o)
                           for o, cols in orderings.items()]).collect()
    for name, key in (("a", lambda r: (r[1], r[0])),
                      ("b", lambda r: (r[1], low_null(r[2]), r[0])),
                      ("c", lambda r: (low_null(r[2]), r[0]))):
        assert {r.k: r[name] for r in got} == expected(rows, key, tiles)


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, v bigint")
    ends = tile_boundaries(df, {"a": ["v"]}, "k", 5, Scratch(spark, "tiles"))
    assert ends == {"a": []}
    assert df.select(tile_of(["v", "k"], ends["a"])).count() == 0


def test_assignment_moves_no_rows(spark):
    df = spark.createDataFrame(make(100, 1, 0), "k string, recency bigint, money decimal(20,2)")
    ends = tile_boundaries(df, {"a": ["money"]}, "k", 5, Scratch(spark, "tiles"))
    plan = df.select(tile_of(["money", "k"], ends["a"]))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan
