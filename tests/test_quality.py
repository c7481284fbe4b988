from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import RAW
from pyspark.sql import functions as F

from parcelwise.params import Params
from parcelwise.plans import warehouse
from parcelwise.plans.warehouse import MARTS, Warehouse
from parcelwise.quality import gate, invariants
from parcelwise.quality.rules import WARN, Rule, evaluate, failing_rows, refers, unique
from parcelwise.quality.suites import FILE_RULES, MODEL_RULES
from parcelwise.sources import sinks
from parcelwise.sources.layout import TABLES, schema_of
from parcelwise.sources.scratch import Scratch


def test_declared_rules():
    assert Counter(r.kind for r in MODEL_RULES) == {
        "not_null": 70, "accepted_range": 30, "unique": 28, "accepted_values": 16,
        "relationships": 8}
    assert len(FILE_RULES) + 2 * len(TABLES) == 56  # and columns, row count per table
    assert Counter(r.severity for r in MODEL_RULES)[WARN] == 2
    assert len(invariants.INVARIANTS) == 10


@pytest.fixture(scope="module")
def frames(spark):
    t = spark.createDataFrame(
        [(1, "a", 10), (1, "b", 11), (2, None, None), (None, "zz", -1), (3, "a", 5)],
        "id int, code string, n int")
    return {"t": t, "p": spark.createDataFrame([(1,), (2,), (2,)], "id int")}


@pytest.mark.parametrize("rule, failing, checked", [
    (Rule("t", "not_null", "id"), 1, 5),
    (Rule("t", "unique", "id"), 1, 4),
    (Rule("t", "unique", "id", also=("code",)), 0, 3),
    (Rule("t", "accepted_values", "code", values=("a", "b")), 1, 4),
    (Rule("t", "accepted_range", "n", low=0), 1, 4),
    (Rule("t", "accepted_range", "n", low=5, high=10), 2, 4),
    (Rule("t", "accepted_range", "n", low=5, high=10, inclusive=False), 4, 4),
    (Rule("t", "length", "code", values=(1,)), 1, 4),
    (Rule("t", "relationships", "id", parent="p", parent_key="id"), 1, 4),
])
def test_rule_counts(frames, rule, failing, checked):
    r = evaluate([rule], frames).first()
    assert (r.failing, r.checked, r.passed) == (failing, checked, failing == 0)
    evidence = failing_rows(rule, frames)
    assert evidence.count() == failing


def test_rules_about_one_key_share_one_shuffle(spark, frames):
    more = {**frames, "u": spark.createDataFrame([(2, 1), (9, 1), (None, 3)], "a int, b int")}
    rules = [*unique("p", "id"), *unique("t", "id"), *refers("t", "id", "p", "id"),
             *refers("u", "a", "p", "id"), *refers("u", "b", "p", "id"),
             *refers("p", "id", "p", "id"), *unique("u", "a", "b")]
    about_p = [r for r in rules if r.parent == "p" or r.table == "p"]
    got = {(r.table_name, r.rule): (r.failing, r.checked) for r in evaluate(rules, more).collect()}
    assert got == {
        ("p", "unique(id)"): (1, 3), ("t", "unique(id)"): (1, 4),
        ("t", "relationships(id)"): (1, 4), ("u", "relationships(a)"): (1, 2),
        ("u", "relationships(b)"): (1, 3), ("p", "relationships(id)"): (0, 3),
        ("u", "unique(a, b)"): (0, 2)}
    plan = evaluate(about_p, more)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    empty = {t: df.limit(0) for t, df in more.items()}
    assert {(r.failing, r.checked, r.passed) for r in evaluate(rules, empty).collect()} == {
        (0, 0, True)}


def test_row_rules_share_one_scan(frames):
    rules = [Rule("t", "not_null", c) for c in ("id", "code", "n")]
    plan = evaluate(rules, frames)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") == 1


@pytest.mark.parametrize("bad, passed", [(1, True), (2, False)])
def test_mostly_threshold(spark, bad, passed):
    points = spark.range(1000).select(
        F.when(F.col("id") < bad, 50.0).otherwise(-20.0).alias("lat"))
    nulls = points.unionByName(spark.range(500).select(F.lit(None).cast("double").alias("lat")))
    rule = Rule("g", "accepted_range", "lat", low=-35, high=6, mostly=0.999)
    r = evaluate([rule], {"g": nulls}).first()
    assert (r.failing, r.checked, r.passed) == (bad, 1000, passed)


def test_invariants_on_edge_rows(shop):
    got = {r.rule: r.failing for r in
           invariants.evaluate_invariants(shop, shop.params).collect()}
    assert got == {
        "revenue_reconciles": 0, "order_count_reconciles": 0, "payments_not_multiplied": 0,
        "flag_matches_delay": 0, "chronology": 1, "recording_order": 1,
        "status_matches_timestamp": 2, "payment_matches_value": 1, "dates_in_window": 1,
        "rfm_at_person_grain": 0}


def test_invariants_can_fail(shop):
    """A fanned-out fact is caught by each check that should see it."""
    orders = shop["fct_orders"]
    fanned = {n: shop[n] for n in ("stg_orders", "stg_order_items", "stg_order_payments",
                                   "fct_order_items", "agg_customer_rfm")}
    fanned["fct_orders"] = orders.unionByName(orders.where("order_id = 'o1'"))
    p = shop.params
    assert invariants.revenue_reconciles(fanned, p).first().difference == Decimal("20.00")
    assert "grain" in invariants.order_count_reconciles(fanned, p).first().violation
    fanned["fct_orders"] = orders.where("order_id <> 'o1'")
    assert "dropped" in invariants.order_count_reconciles(fanned, p).first().violation
    fanned["fct_orders"] = orders.withColumn("is_late", F.coalesce("is_late", F.lit(False)))
    assert invariants.flag_matches_delay(fanned, p).count() == 2
    fanned["fct_orders"] = orders.withColumn(
        "order_payment_total", (F.col("order_payment_total") * 2).cast("decimal(22,2)"))
    assert invariants.payments_not_multiplied(fanned, p).count() == 3
    fanned["fct_orders"] = orders
    fanned["agg_customer_rfm"] = shop["agg_customer_rfm"].where("frequency = 1")
    assert "row count" in invariants.rfm_at_person_grain(fanned, p).first().violation


def clean_warehouse(spark, change=None):
    """The edge tables without their defects, optionally with one injected."""
    tables = {t: list(rows) for t, rows in RAW.items()}
    good = {"o1", "o2"}
    tables["orders"] = [r for r in tables["orders"] if r[0] in good]
    for t in ("order_items", "order_payments"):
        tables[t] = [r for r in tables[t] if r[0] in good]
    tables["customers"] = [r for r in tables["customers"] if r[0] in ("c1", "c2")]
    tables["sellers"] = tables["sellers"][:2]
    tables["geolocation"] = tables["geolocation"][:4]
    tables["order_payments"] = [
        (o, n, kind.strip().lower(), i, v) for o, n, kind, i, v in tables["order_payments"]]
    if change:
        change(tables)
    raw = {t: (lambda t=t: spark.createDataFrame(tables[t], schema_of(t))) for t in TABLES}
    return Warehouse(spark, raw, Params(), Scratch(spark, "gate"))


def test_release_and_fault_injection(spark, tmp_path):
    root = str(tmp_path / "marts")
    ok = gate.release(spark, clean_warehouse(spark), root, Params(),
                      run_at=datetime(2020, 1, 1))
    assert not ok.blocked and {r["severity"] for r in ok.failures} <= {WARN}
    first = sinks.released(spark, root)
    assert sinks.read_released(spark, root, "fct_orders").count() == 2
    assert all(sinks.read_released(spark, root, t).columns for t in MARTS)

    def break_it(tables):
        line = tables["order_items"][0]
        tables["order_items"] += [line, (*line[:5], Decimal("-5.00"), line[6])]

    with pytest.raises(gate.GateRed) as red:
        gate.release(spark, clean_warehouse(spark, break_it), root, Params(),
                     run_at=datetime(2020, 1, 2))
    failed = {(r["table_name"], r["rule"]) for r in red.value.report.failures}
    assert ("stg_order_items", "unique(order_item_key)") in failed
    assert ("stg_order_items", "accepted_range(item_price)") in failed
    assert ("fct_order_items", "unique(order_item_key)") in failed
    # The red run left its tables unmarked; readers still see the first release.
    assert sinks.released(spark, root) == first
    assert sinks.read_released(spark, root, "fct_orders").count() == 2

    gate.release(spark, clean_warehouse(spark), root, Params(), run_at=datetime(2020, 1, 3))
    assert sinks.released(spark, root) > first


def test_release_writes_a_mart_once_and_keeps_the_history(spark, tmp_path, monkeypatch):
    root, written = str(tmp_path / "marts"), []
    write = warehouse.write_table
    monkeypatch.setattr(warehouse, "write_table",
                        lambda name, df, path: (written.append(name), write(name, df, path)))
    rules = [r for r in MODEL_RULES if r.table == "fct_orders"]

    def change(tables):
        first, *rest = tables["products"]
        tables["products"] = [(first[0], "perfumaria", *first[2:]), *rest]

    gate.release(spark, clean_warehouse(spark), root, Params(), rules, datetime(2020, 1, 1))
    marts = [t for t in written if t in MARTS]
    assert sorted(marts) == sorted(MARTS)
    before = sinks.read_released(spark, root, gate.HISTORY)
    assert before.where("valid_to is not null").count() == 0
    gate.release(spark, clean_warehouse(spark, change), root, Params(), rules,
                 datetime(2020, 1, 2))
    after = sinks.read_released(spark, root, gate.HISTORY)
    closed = after.where("valid_to is not null").collect()
    assert [r.product_key for r in closed] == [RAW["products"][0][0]]
    assert closed[0].valid_to == datetime(2020, 1, 2)
    assert after.count() == before.count() + 1


def test_no_rules_are_refused():
    with pytest.raises(ValueError):
        evaluate([], {})


def test_report_counts_tables(spark):
    frames = {"a": spark.createDataFrame([(1,), (1,)], "k int"),
              "b": spark.createDataFrame([(1,), (2,)], "k int")}
    r = gate.report(evaluate([*unique("a", "k"), *unique("b", "k")], frames))
    assert r.blocked and r.summary().startswith("1/2 tables passed")



def test_keys_are_counted_one_after_another(spark, frames):
    """Several keys are not counted in one plan: what is left of it reads their verdicts."""
    rules = [*unique("t", "id"), *unique("p", "id"), *refers("t", "id", "p", "id"),
             Rule("t", "not_null", "id")]
    got = evaluate(rules, frames)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text
    assert got.dtypes == evaluate(rules[:1], frames).dtypes
    assert {(r.table_name, r.rule, r.failing, r.checked, r.passed) for r in got.collect()} == {
        ("t", "unique(id)", 1, 4, False), ("p", "unique(id)", 1, 3, False),
        ("t", "relationships(id)", 1, 4, False), ("t", "not_null(id)", 1, 5, False)}
    assert got.count() == 4
