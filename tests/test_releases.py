"""Loads that read changed files only, releases of runs that overlap, and what is kept."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parcelwise.plans import build as runs
from parcelwise.quality import gate, rules
from parcelwise.sources import layout, scratch, sinks

HEAD = ",".join(layout.columns_of("sellers")) + "\n"
COUNTS = {"sellers": 4}


def part(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEAD + "".join(f"{s},1,x,SP\n" for s in rows))


def load(spark, src, root, day, **more):
    return runs.load_raw(spark, runs.csv_paths(str(src), ["sellers"]), COUNTS, root,
                         datetime(2020, 1, day), **more)


def sellers(spark, root):
    return sorted(r[0] for r in sinks.read_released(spark, root, "sellers").select("seller_id")
                  .collect())


def test_only_changed_files_are_read(spark, tmp_path):
    src, root = tmp_path / "src", str(tmp_path / "raw")
    src.mkdir()
    folder = src / "sellers.csv"
    part(folder, "a b.csv", ["s1", "s2"])
    part(folder, "empty.csv", [])
    first = load(spark, src, root, 1)
    assert [os.path.basename(u) for u in first.parsed["sellers"]] == ["a b.csv", "empty.csv"]

    part(folder, "c.csv", ["s3"])
    second = load(spark, src, root, 2)
    assert [os.path.basename(u) for u in second.parsed["sellers"]] == ["c.csv"]
    assert sellers(spark, root) == ["s1", "s2", "s3"]
    listed = sinks.read_released(spark, root, runs.FILES).collect()
    assert sorted((r["rows"], first.release in (r["stored"] or "")) for r in listed) == [
        (0, False), (1, False), (2, True)]
    whole, = second.manifest
    assert whole["rows"] == 3 and whole["bytes"] == sum(f.stat().st_size for f in folder.iterdir())

    assert load(spark, src, root, 3).parsed == {} and sellers(spark, root) == ["s1", "s2", "s3"]
    part(folder, "c.csv", ["s4", "s5"])  # changed
    os.unlink(folder / "empty.csv")
    fourth = load(spark, src, root, 4)
    assert [os.path.basename(u) for u in fourth.parsed["sellers"]] == ["c.csv"]
    assert sellers(spark, root) == ["s1", "s2", "s4", "s5"]
    rows = sinks.read_released(spark, root, "sellers").select("_batch_id", "_source_digest")
    assert rows.distinct().count() == 2 and rows.where("_source_digest is null").count() == 0

    # A key of a kept file in a new file is seen: rules hold for the table, not for files.
    part(folder, "d.csv", ["s1"])
    twice = rules.unique("sellers", "seller_id")
    with pytest.raises(gate.GateRed, match="unique"):
        load(spark, src, root, 5, rules=twice)
    assert sellers(spark, root) == ["s1", "s2", "s4", "s5"]


def test_content_sums_of_files_add_up(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    for src, parts in ((one, [["s1", "s2", "s3"]]), (two, [["s3"], ["s2", "s1"]])):
        src.mkdir()
        for k, rows in enumerate(parts):
            part(src / "sellers.csv", f"{k}.csv", rows)
    digests = {load(spark, src, str(tmp_path / f"raw{k}"), 1).manifest[0]["content_digest"]
               for k, src in enumerate((one, two))}
    assert len(digests) == 1


def test_other_tables_stay_known(spark, tmp_path):
    src, root = tmp_path / "src", str(tmp_path / "raw")
    src.mkdir()
    part(src / "sellers.csv", "a.csv", ["s1"])
    (src / "customers.csv").write_text(",".join(layout.columns_of("customers")) + "\nc,p,1,x,SP\n")
    both = runs.csv_paths(str(src), ["sellers", "customers"])
    runs.load_raw(spark, both, {}, root, datetime(2020, 1, 1))
    load(spark, src, root, 2)
    assert runs.load_raw(spark, both, {}, root, datetime(2020, 1, 3)).parsed == {}
    assert sinks.read_released(spark, root, "customers").count() == 1


def write_release(spark, root, name, value):
    spark.createDataFrame([(value,)], "x string").write.parquet(f"{root}/{name}/t")


def test_of_two_runs_with_one_base_the_later_loses(spark, tmp_path):
    root = str(tmp_path / "marts")
    write_release(spark, root, "1", "first")
    sinks.mark_released(spark, root, "1", None)
    base = sinks.released(spark, root)
    for name in ("2", "3"):
        write_release(spark, root, name, name)
    sinks.mark_released(spark, root, "3", base)
    with pytest.raises(sinks.ReleaseConflict, match="2 is not released"):
        sinks.mark_released(spark, root, "2", base)
    assert sinks.read_released(spark, root, "t").first().x == "3"
    with pytest.raises(sinks.ReleaseConflict):
        sinks.mark_released(spark, root, "4", None)
    # A claim without its release, left by a run that ended in between, is not taken over.
    sinks.storage.create(spark, f"{root}/{sinks.CLAIMS}/3")
    with pytest.raises(sinks.ReleaseConflict):
        sinks.mark_released(spark, root, "2", "3")


def test_old_releases_expire_but_not_what_newer_ones_refer_to(spark, tmp_path):
    src, root = tmp_path / "src", str(tmp_path / "raw")
    src.mkdir()
    names = []
    for day in range(1, 6):  # the first file stays, another one changes every day
        part(src / "sellers.csv", "a.csv", ["s1"]) if day == 1 else None
        part(src / "sellers.csv", "b.csv", [f"t{n}" for n in range(day)])
        names.append(load(spark, src, root, day).release)
    assert sinks.expire(spark, root, 2) == names[1:3]
    assert sinks.marked(spark, root) == [names[0], *names[3:]]
    assert sellers(spark, root) == ["s1", *[f"t{n}" for n in range(5)]]
    assert sinks.expire(spark, root, 2) == [] == sinks.expire(spark, str(tmp_path / "no"), 1)


def test_scratch_is_empty_after_success_only(spark):
    rows = spark.range(3)
    with scratch.cleared(spark):
        one = scratch.Scratch(spark, "cleared")
        one.save(rows, "x")
        assert sinks.storage.exists(spark, one.root)
    assert not sinks.storage.exists(spark, one.root)
    with pytest.raises(ValueError):
        with scratch.cleared(spark):
            two = scratch.Scratch(spark, "failed")
            two.save(rows.select(F.col("id") + 1), "x")
            raise ValueError
    assert sinks.storage.exists(spark, two.root)
