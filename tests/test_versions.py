"""History in storage: buckets that did not change are referred to, not written."""

from datetime import datetime

import pytest

from parcelwise.operators.history import snapshot
from parcelwise.sources import sinks, versions

KIND = "k string, category string, note string, weight int"
CHECK = ["category", "note"]


def state(spark, changes=(), gone=(), n=200):
    rows = {f"k{i}": (f"k{i}", "x", None, i) for i in range(n) if i not in gone}
    rows.update({r[0]: r for r in changes})
    return spark.createDataFrame(list(rows.values()), KIND)


def run(spark, root, day, current, **more):
    base = sinks.released(spark, root)
    changed = versions.write_versions(current, root, f"r{day:02}", "t", "k", CHECK,
                                      datetime(2020, 1, day), **more)
    sinks.mark_released(spark, root, f"r{day:02}", base)
    return changed


def parts(spark, root, day):
    return set(sinks.parts_of(spark, f"{root}/r{day:02}/t"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_only_changed_buckets_are_written(spark, tmp_path):
    root = str(tmp_path / "r")
    assert run(spark, root, 1, state(spark), buckets=16) == list(range(16))
    # A change outside the check columns is none; nothing is written but the digests.
    assert run(spark, root, 2, state(spark, [("k3", "x", None, -1)])) == []
    assert parts(spark, root, 2) == parts(spark, root, 1)
    assert not sinks.storage.exists(spark, f"{root}/r02/t/{versions.PIECES}")

    later = state(spark, [("k3", "y", None, 3)])
    changed = run(spark, root, 3, later, buckets=5)  # the first number of buckets stays
    assert len(changed) == 1
    new = parts(spark, root, 3) - parts(spark, root, 1)
    assert {p.rsplit("=", 1)[1] for p in new} == {f"open-{changed[0]}", "closed"}
    assert len(parts(spark, root, 1) - parts(spark, root, 3)) == 1
    # A value that goes from one check column to the other is a change.
    assert run(spark, root, 4, state(spark, [("k3", None, "y", 3)])) == changed

    whole = snapshot(state(spark), None, "k", CHECK, datetime(2020, 1, 1))
    for day, now in ((3, later), (4, state(spark, [("k3", None, "y", 3)]))):
        whole = snapshot(now, whole, "k", CHECK, datetime(2020, 1, day))
    got = sinks.read_released(spark, root, "t")
    assert got.columns == whole.columns and rows(got) == rows(whole)


def test_all_states_agree_with_the_whole_history(spark, tmp_path):
    root, whole = str(tmp_path / "r"), None
    for day, now in enumerate((
            state(spark, n=0), state(spark, [(None, "x", None, 1)], n=40),
            state(spark, [("k7", "z", None, 7), (None, "x", None, 1)], gone=(1, 2), n=40),
            state(spark, gone=(1,), n=40), state(spark, n=0), state(spark, n=3)), 1):
        run(spark, root, day, now, buckets=8, merge_after=2)
        whole = snapshot(now, whole, "k", CHECK, datetime(2020, 1, day))
        assert rows(sinks.read_released(spark, root, "t")) == rows(whole), day
    closed = [p for p in parts(spark, root, 6) if p.endswith("=closed")]
    assert len(closed) <= 2


def test_deleted_keys_can_stay_open_and_a_repeated_key_fails(spark, tmp_path):
    root = str(tmp_path / "r")
    run(spark, root, 1, state(spark, n=10), buckets=4)
    run(spark, root, 2, state(spark, gone=(4,), n=10), close_deleted=False)
    assert sinks.read_released(spark, root, "t").where("valid_to is null").count() == 10
    twice = state(spark, n=10).union(state(spark, n=1))
    with pytest.raises(Exception, match="k is not unique: k0"):
        versions.write_versions(twice, root, "r03", "t", "k", CHECK, datetime(2020, 1, 3))
    assert sinks.released(spark, root) == "r02"


def test_a_history_stored_whole_is_taken_over(spark, tmp_path):
    root = str(tmp_path / "r")
    first = snapshot(state(spark, n=9), None, "k", CHECK, datetime(2020, 1, 1))
    first = snapshot(state(spark, gone=(5,), n=9), first, "k", CHECK, datetime(2020, 1, 2))
    first.write.parquet(f"{root}/r02/t")
    sinks.mark_released(spark, root, "r02", None)
    now = state(spark, [("k1", "y", None, 1)], gone=(5,), n=9)
    run(spark, root, 3, now, buckets=4)
    want = snapshot(now, first, "k", CHECK, datetime(2020, 1, 3))
    assert rows(sinks.read_released(spark, root, "t")) == rows(want)


def test_expiry_keeps_the_pieces_and_deletes_the_other_tables(spark, tmp_path):
    root = str(tmp_path / "r")
    for day in range(1, 5):
        spark.range(day).write.parquet(f"{root}/r{day:02}/other")
        run(spark, root, day, state(spark, [("k3", f"c{day}", None, 3)]), buckets=16)
    before = rows(sinks.read_released(spark, root, "t"))
    assert sinks.expire(spark, root, 1) == []  # closed versions of r02, r03; buckets of r01
    assert sinks.storage.folders(spark, f"{root}/r01") == ["t"]
    assert rows(sinks.read_released(spark, root, "t")) == before
    assert sinks.read_released(spark, root, "other").count() == 4
