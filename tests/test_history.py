from datetime import datetime

import pytest
from conftest import rows_by

from parcelwise.operators.history import as_of, single_rows, snapshot

T1, T2, T3, T4, T5 = (datetime(2020, m, 1) for m in range(1, 6))


def products(spark, rows):
    return spark.createDataFrame(rows, "k string, category string, weight int")


def test_snapshot_life_cycle(spark):
    def run(rows, history, at):
        return snapshot(products(spark, rows), history, "k", ["category"], at)

    h1 = run([("a", "x", 1), ("b", "x", 1), ("c", None, 1)], None, T1)
    assert h1.count() == 3 and h1.where("valid_to is null").count() == 3

    # An unchanged rerun, and a change outside the check columns, add nothing.
    h2 = run([("a", "x", 99), ("b", "x", 1), ("c", None, 1)], h1, T2)
    assert sorted(map(tuple, h2.collect())) == sorted(map(tuple, h1.collect()))

    # a changes, b is deleted, c gains a value, d is new.
    h3 = run([("a", "y", 1), ("c", "z", 1), ("d", "x", 1)], h2, T3)
    open_rows = rows_by(h3.where("valid_to is null"), "k")
    assert set(open_rows) == {"a", "c", "d"} and open_rows["a"].valid_from == T3
    closed = rows_by(h3.where("valid_to is not null"), "k")
    assert set(closed) == {"a", "b", "c"} and {r.valid_to for r in closed.values()} == {T3}

    # b comes back as a second version; closed rows never change again.
    h4 = run([("a", "y", 1), ("b", "x", 1), ("c", "z", 1), ("d", "x", 1)], h3, T4)
    assert [(r.valid_from, r.valid_to) for r in
            h4.where("k = 'b'").orderBy("valid_from").collect()] == [(T1, T3), (T4, None)]
    assert h4.count() == 7

    assert rows_by(as_of(h4, T2), "k")["a"].category == "x"
    assert rows_by(as_of(h4, T3), "k")["a"].category == "y"
    assert "b" not in rows_by(as_of(h4, T3), "k")


def test_deletions_can_stay_open(spark):
    first = snapshot(products(spark, [("a", "x", 1)]), None, "k", ["category"], T1)
    second = snapshot(products(spark, [("b", "x", 1)]), first, "k", ["category"], T2,
                      close_deleted=False)
    assert second.where("valid_to is null").count() == 2


def test_a_key_in_two_rows_stops_the_snapshot(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="k is not unique: 1"):
        single_rows(rows, "k").collect()
    assert single_rows(rows.where("v <> 'c'"), "k").count() == 2
