"""Singular checks.  Each returns the rows that break it, none when it holds."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import months_shift
from ..functions.frames import distinct_count, union_all
from ..params import Params
from ..plans.aggregates import TOTAL, money
from .rules import ERROR, WARN

Frames = Mapping[str, DataFrame]


def revenue_reconciles(f: Frames, _: Params) -> DataFrame:
    """Exact decimal revenue of the items against both facts."""
    staged = f["stg_order_items"].agg(money("item_price")).scalar()

    def against(fact: str, column: str) -> DataFrame:
        return f[fact].agg(money(column).alias("mart_revenue")).select(
            F.lit(f"stg_order_items vs {fact}").alias("comparison"),
            staged.alias("staging_revenue"), "mart_revenue",
        ).withColumn("difference", F.col("mart_revenue") - F.col("staging_revenue"))

    both = against("fct_order_items", "item_price").unionByName(
        against("fct_orders", "order_revenue"))
    return both.where("staging_revenue <> mart_revenue")


def order_count_reconciles(f: Frames, _: Params) -> DataFrame:
    mart = f["fct_orders"].agg(F.count_distinct("order_id").alias("mart_orders"),
                               F.count("*").alias("mart_rows"))
    staged = f["stg_orders"].agg(F.count_distinct("order_id")).scalar()
    s, m, n = F.col("staging_orders"), F.col("mart_orders"), F.col("mart_rows")
    label = (F.when(n != m, "fct_orders is not at order grain")
             .when(m < s, "orders were dropped")
             .when(m > s, "orders were invented"))
    return mart.select(staged.alias("staging_orders"), "mart_orders", "mart_rows").withColumn(
        "violation", label).where("violation is not null")


def payments_not_multiplied(f: Frames, _: Params) -> DataFrame:
    """Both sides are one row per order before they meet."""
    staged = f["stg_order_payments"].groupBy("order_id").agg(
        money("payment_value").alias("staging_payment_total"))
    mart = f["fct_orders"].where("order_payment_total is not null").select(
        "order_id", F.col("order_payment_total").cast(TOTAL).alias("mart_payment_total"))
    return mart.join(staged, "order_id").select(
        "order_id", "staging_payment_total", "mart_payment_total",
        (F.col("mart_payment_total") - F.col("staging_payment_total")).alias("difference"),
    ).where("difference <> 0")


def flag_matches_delay(f: Frames, _: Params) -> DataFrame:
    """A flag without a delay, a delay without a flag, or the two at odds."""
    broken = ~F.col("is_late").eqNullSafe(F.col("delay_vs_promise_days") > 0)
    return f["fct_orders"].where(broken).select(
        "order_id", "delay_vs_promise_days", "is_late", "lateness_bucket")


def _first_of(*cases: tuple[Column, str]) -> Column:
    label = F.when(*cases[0])
    for cond, text in cases[1:]:
        label = label.when(cond, text)
    return label


def chronology(f: Frames, _: Params) -> DataFrame:
    bought = F.col("order_purchased_at")
    label = _first_of((F.col("order_approved_at") < bought, "approved before purchase"),
                      (F.col("order_delivered_at") < bought, "delivered before purchase"))
    return f["int_order_delivery"].select(
        "order_id", "order_purchased_at", "order_approved_at", "order_delivered_at",
        label.alias("violation")).where("violation is not null")


def recording_order(f: Frames, _: Params) -> DataFrame:
    handed = F.col("order_handed_to_carrier_at")
    label = _first_of(
        (handed < F.col("order_approved_at"),
         "carrier handover recorded before payment approval"),
        (F.col("order_delivered_at") < handed,
         "delivered before carrier handover"))
    return f["int_order_delivery"].select(
        "order_id", "order_approved_at", "order_handed_to_carrier_at", "order_delivered_at",
        label.alias("anomaly")).where("anomaly is not null")


def status_matches_timestamp(f: Frames, _: Params) -> DataFrame:
    done, missing = F.col("is_delivered"), F.col("order_delivered_at").isNull()
    label = _first_of(
        (done & missing, "status is delivered but no delivery timestamp"),
        (~done & ~missing, "has a delivery timestamp but status is not delivered"))
    return f["int_order_delivery"].select(
        "order_id", "order_status", "order_delivered_at",
        label.alias("violation")).where("violation is not null")


def payment_matches_value(f: Frames, _: Params) -> DataFrame:
    """Vouchers reduce what is charged, so orders with one are left out."""
    gap = F.col("order_payment_total") - F.col("order_gross_value")
    voucher = F.contains(F.coalesce("payment_type_mix", F.lit("")), F.lit("voucher"))
    return f["fct_orders"].where((F.abs(gap) > 0.01) & ~voucher).select(
        "order_id", "order_revenue", "order_freight", "order_gross_value",
        "order_payment_total", F.round(gap, 2).alias("difference"), "payment_type_mix")


def dates_in_window(f: Frames, p: Params) -> DataFrame:
    bought = F.col("order_purchase_date")
    outside = (bought < months_shift(p.window_start, -3)) | (
        bought > months_shift(p.window_end, 3))
    return f["fct_orders"].where(outside).select(
        "order_id", "order_purchase_date", "order_status")


def rfm_at_person_grain(f: Frames, _: Params) -> DataFrame:
    orders = f["fct_orders"].where("not is_excluded_from_kpis")
    kept = distinct_count(orders, "customer_key", "people_with_kept_orders").crossJoin(
        distinct_count(orders, "source_customer_id", "distinct_customer_ids"))  # one row each
    scored = f["agg_customer_rfm"]
    rows = F.col("customer_rows")
    label = _first_of(
        (rows != F.col("people_with_kept_orders"),
         "row count does not match the number of people with a kept order"),
        (rows >= F.col("distinct_customer_ids"),
         "as many rows as customer_ids: RFM is probably keyed on the per-order id"),
        (F.col("max_frequency") <= 1,
         "no repeat customers: RFM is probably keyed on the per-order id"))
    return kept.select(
        scored.agg(F.count("*")).scalar().alias("customer_rows"),
        "people_with_kept_orders", "distinct_customer_ids",
        scored.agg(F.max("frequency")).scalar().alias("max_frequency"),
    ).withColumn("violation", label).where("violation is not null")


INVARIANTS: dict[str, tuple[str, Callable[[Frames, Params], DataFrame]]] = {
    "revenue_reconciles": (ERROR, revenue_reconciles),
    "order_count_reconciles": (ERROR, order_count_reconciles),
    "payments_not_multiplied": (ERROR, payments_not_multiplied),
    "flag_matches_delay": (ERROR, flag_matches_delay),
    "chronology": (ERROR, chronology),
    "recording_order": (WARN, recording_order),
    "status_matches_timestamp": (WARN, status_matches_timestamp),
    "payment_matches_value": (WARN, payment_matches_value),
    "dates_in_window": (ERROR, dates_in_window),
    "rfm_at_person_grain": (ERROR, rfm_at_person_grain),
}


def evaluate_invariants(frames: Frames, params: Params) -> DataFrame:
    """One row per invariant, in the shape of the rule results."""
    return union_all(
        check(frames, params).agg(F.count("*").alias("failing")).select(
            F.lit("-").alias("table_name"), F.lit(name).alias("rule"),
            F.lit(severity).alias("severity"), "failing",
            F.lit(None).cast("bigint").alias("checked"),
            (F.col("failing") == 0).alias("passed"))
        for name, (severity, check) in INVARIANTS.items())
