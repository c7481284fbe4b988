"""CSV files to released marts."""

import csv
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import RAW

from parcelwise.plans import build as runs
from parcelwise.params import Params
from parcelwise.quality import gate
from parcelwise.quality.suites import MODEL_RULES
from parcelwise.sources import layout, sinks


@pytest.fixture
def folder(tmp_path):
    """The edge tables as files, without the rows a file gate refuses."""
    tables = {t: list(rows) for t, rows in RAW.items()}
    tables["orders"] = [(*r[:2], r[2].strip().lower(), *r[3:]) for r in tables["orders"]]
    tables["order_payments"] = [(*r[:2], r[2].strip().lower(), *r[3:])
                                for r in tables["order_payments"]]
    tables["customers"] = [r for r in tables["customers"] if r[4]]
    tables["sellers"] = [(*r[:3], r[3].strip()) for r in tables["sellers"]]
    tables["geolocation"] = [r for r in tables["geolocation"] if r[0] and r[1] < 6]
    tables["order_reviews"].append(("r9", "o5", 2, None, 'two\nlines, "quoted"',
                                    datetime(2018, 3, 9), None))
    for t, rows in tables.items():
        with open(tmp_path / f"{t}.csv", "w", newline="") as fh:
            out = csv.writer(fh)
            out.writerow(layout.columns_of(t))
            out.writerows(["" if v is None else v for v in r] for r in rows)
    return tmp_path, {t: len(rows) for t, rows in tables.items()}


def test_load_is_idempotent_and_keeps_types(spark, folder, tmp_path):
    src, counts = folder
    root = str(tmp_path / "raw")
    paths = runs.csv_paths(str(src))
    first = runs.load_raw(spark, paths, counts, root, datetime(2020, 1, 1))
    assert {r["table"]: r["rows"] for r in first.manifest} == counts
    assert all(r["rows_match_expected"] for r in first.manifest)
    items = sinks.read_released(spark, root, "order_items")
    assert items.schema["price"].dataType.simpleString() == "decimal(18,9)"
    note = sinks.read_released(spark, root, "order_reviews").where("review_id = 'r9'").first()
    assert note.review_comment_message == 'two\nlines, "quoted"'
    def content(table):
        return sorted(map(str, sinks.read_released(spark, root, table).select(
            *layout.columns_of(table)).collect()))

    some = ("order_items", "order_reviews")
    before = [content(t) for t in some]
    runs.load_raw(spark, {t: paths[t] for t in some}, counts, root, datetime(2020, 1, 2))
    assert before == [content(t) for t in some]


def test_red_file_gate_loads_nothing(spark, folder, tmp_path):
    src, counts = folder
    with open(src / "order_items.csv", "a", newline="") as fh:
        csv.writer(fh).writerow(["o1", 4, "p1", "s1", "", "-3.00", "1.00"])
    root = str(tmp_path / "raw")
    with pytest.raises(gate.GateRed, match="price"):
        runs.load_raw(spark, runs.csv_paths(str(src)), counts, root)
    assert sinks.released(spark, root) is None


def test_marts_from_loaded_files(spark, folder, tmp_path):
    src, counts = folder
    root = str(tmp_path / "raw")
    runs.load_raw(spark, runs.csv_paths(str(src)), counts, root)
    w = runs.raw_warehouse(spark, root, Params())
    assert "_batch_id" in w["stg_orders"].columns
    assert w["fct_orders"].where("order_id = 'o1'").first().order_revenue == Decimal("20.00")
    # The edge rows break rules at error severity, so nothing is released from them.
    with pytest.raises(gate.GateRed):
        gate.release(spark, w, str(tmp_path / "marts"), Params(),
                     [r for r in MODEL_RULES if r.table == "int_order_delivery"])
    assert sinks.released(spark, str(tmp_path / "marts")) is None


def test_only_requested_tables(tmp_path):
    assert runs.csv_paths("/x/", ["sellers"], {"sellers": "s.csv"}) == {"sellers": "/x/s.csv"}


def test_a_bad_value_in_a_column_without_rules_is_a_verdict(spark, folder, tmp_path):
    src, counts = folder
    with open(src / "sellers.csv", "a", newline="") as fh:
        csv.writer(fh).writerow(["s9", "abc", "x", "SP"])
    root = str(tmp_path / "raw")
    with pytest.raises(gate.GateRed) as red:
        runs.load_raw(spark, runs.csv_paths(str(src), ["sellers"]), counts, root)
    assert [r["rule"] for r in red.value.report.failures if r["severity"] == "error"] == [
        "readable(_bad_record)"]
    assert sinks.released(spark, root) is None


def test_a_later_file_with_another_header_is_a_verdict(spark, tmp_path):
    names = layout.columns_of("sellers")
    (tmp_path / "sellers.csv").mkdir()
    for k, cols in enumerate((names, names[::-1])):
        (tmp_path / "sellers.csv" / f"{k}.csv").write_text(",".join(cols) + "\ns1,1,x,SP\n")
    with pytest.raises(gate.GateRed, match="columns"):
        runs.load_raw(spark, runs.csv_paths(str(tmp_path), ["sellers"]), {}, str(tmp_path / "r"))


def test_subset_reload_and_stored_manifest(spark, folder, tmp_path):
    src, counts = folder
    root = str(tmp_path / "raw")
    paths = runs.csv_paths(str(src), ["sellers", "products"])
    runs.load_raw(spark, paths, counts, root, datetime(2020, 1, 1))
    stored = sinks.read_released(spark, root, runs.MANIFEST)
    assert {r["table"]: r["rows"] for r in stored.collect()} == {
        t: counts[t] for t in paths}
    one = {"sellers": paths["sellers"]}
    runs.load_raw(spark, one, counts, root, datetime(2020, 1, 2), stored)
    assert sinks.read_released(spark, root, "products").count() == counts["products"]

    with open(src / "sellers.csv", "a", newline="") as fh:
        csv.writer(fh).writerow(["s9", 1, "x", "SP"])
    with pytest.raises(gate.GateRed, match="unchanged"):
        runs.load_raw(spark, one, counts, root, datetime(2020, 1, 3), stored)
    short = runs.load_raw(spark, one, counts, root, datetime(2020, 1, 4))
    assert [(r["rule"], r["severity"]) for r in short.verdicts.failures] == [
        ("row_count(*)", "warn")]


def test_files_in_another_encoding(spark, tmp_path):
    head = ",".join(layout.columns_of("sellers"))
    (tmp_path / "sellers.csv").write_text(f"{head}\ns1,1,São Paulo,SP\n", encoding="latin-1")
    root = str(tmp_path / "raw")
    runs.load_raw(spark, runs.csv_paths(str(tmp_path), ["sellers"]), {"sellers": 1}, root,
                  encoding="ISO-8859-1")
    assert sinks.read_released(spark, root, "sellers").first().seller_city == "São Paulo"
