"""Profiling of the raw layer: volume, coverage, NULLs, fan-out, identity, orphans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import days_between
from ..functions.frames import distinct_count, union_all
from ..functions.numbers import mean, safe_ratio, tally


def coverage_by_month(raw_orders: DataFrame, floor: int) -> DataFrame:
    month = F.date_format("order_purchase_timestamp", "yyyy-MM").alias("year_month")
    return raw_orders.groupBy(month).agg(F.count("*").alias("orders")).withColumn(
        "is_sparse", F.col("orders") < floor)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls, pct_of_rows) from a single pass."""
    counts = df.agg(F.count("*").alias("_rows"),
                    *[tally(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot("_rows", list(columns), "column_name", "null_count")
    return long.select("column_name", "null_count",
                       safe_ratio(F.col("null_count") * 100, "_rows", 2).alias("pct_of_rows"))


MILESTONES = ("order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date")


def milestone_nulls(raw_orders: DataFrame) -> DataFrame:
    approved, carrier, delivered, promised = (F.col(c).isNull() for c in MILESTONES)
    return raw_orders.agg(
        F.count("*").alias("orders"),
        tally(approved).alias("null_approved"),
        tally(carrier).alias("null_carrier"),
        tally(delivered).alias("null_delivered"),
        tally(promised).alias("null_promised"),
        tally((F.col("order_status") == "delivered") & delivered)
        .alias("delivered_but_no_date"))


def missing_delivery_by_status(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.groupBy("order_status").agg(
        F.count("*").alias("orders"),
        tally(F.col("order_delivered_customer_date").isNull()).alias("missing_delivery_date"))


def payment_fanout(raw_items: DataFrame, raw_payments: DataFrame) -> DataFrame:
    """Rows a direct join of items to payments would produce, from counts per order only."""
    items = raw_items.groupBy("order_id").agg(F.count("*").alias("i"))
    pays = raw_payments.groupBy("order_id").agg(F.count("*").alias("p"))
    one = items.join(pays, "order_id").agg(
        F.sum("i").alias("correct_item_rows"),
        F.sum(F.col("i") * F.col("p")).alias("rows_after_naive_join"),
        tally(F.col("p") > 1).alias("orders_with_multiple_payments"),
        F.max("p").alias("max_payment_lines"))
    return one.withColumn("inflation",
                          safe_ratio("rows_after_naive_join", "correct_item_rows", 2))


def review_duplication(raw_reviews: DataFrame) -> DataFrame:
    counts = raw_reviews.agg(F.count("*").alias("review_rows"))
    for column, name in (("review_id", "distinct_review_ids"), ("order_id", "distinct_orders")):
        counts = counts.crossJoin(distinct_count(raw_reviews, column, name))  # one row each
    return counts.withColumn("excess_rows_per_order",
                             F.col("review_rows") - F.col("distinct_orders"))


def identity(raw_customers: DataFrame) -> DataFrame:
    people = F.count_distinct("customer_unique_id")
    return raw_customers.agg(
        F.count("*").alias("customer_id_rows"),
        people.alias("actual_people"),
        (F.count("*") - people).alias("duplicate_identities"))


def orders_per_person(raw_customers: DataFrame) -> DataFrame:
    placed = raw_customers.groupBy("customer_unique_id").agg(
        F.count("*").alias("orders_placed"))
    return placed.groupBy("orders_placed").agg(F.count("*").alias("customers"))


def geo_cardinality(raw_geolocation: DataFrame) -> DataFrame:
    prefixes = F.count_distinct("geolocation_zip_code_prefix")
    return raw_geolocation.agg(
        F.count("*").alias("geolocation_rows"),
        prefixes.alias("distinct_prefixes"),
        safe_ratio(F.count("*"), prefixes, 1).alias("avg_rows_per_prefix"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str,
            label: str) -> DataFrame:
    """Child rows without a parent.  The child is counted per key first, so a key shared
    by a large part of the rows is one row when it meets the parent."""
    children = child.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
    parents = parent.select(F.col(parent_key).alias("_k")).where("_k is not null").distinct()
    known = children.join(parents.withColumn("_known", F.lit(True)), "_k", "left")
    return known.agg(
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0))
        .alias("orphans"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
    ).select(F.lit(label).alias("relationship"), "orphans", "total",
             safe_ratio(F.col("orphans") * 100, "total", 3).alias("orphan_pct"))


def orphan_report(orders: DataFrame, items: DataFrame, products: DataFrame,
                  sellers: DataFrame, customers: DataFrame) -> DataFrame:
    pairs = [
        (items, "order_id", orders, "order_id", "order_items -> orders"),
        (items, "product_id", products, "product_id", "order_items -> products"),
        (items, "seller_id", sellers, "seller_id", "order_items -> sellers"),
        (orders, "customer_id", customers, "customer_id", "orders -> customers"),
        (orders, "order_id", items, "order_id", "orders without any item line"),
    ]
    return union_all(orphans(*pair) for pair in pairs)


def raw_delivery_sanity(raw_orders: DataFrame) -> DataFrame:
    bought, arrived = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    delay = days_between(promised, arrived)
    one = raw_orders.where("order_status = 'delivered'").agg(
        F.count("*").alias("delivered_orders"),
        mean(days_between(bought, arrived), 2).alias("avg_delivery_days"),
        mean(delay, 2).alias("avg_delay_vs_promise"),
        tally(delay > 0).alias("late_orders"),
        tally(arrived < bought).alias("impossible_delivered_before_purchase"),
        tally(F.col("order_delivered_carrier_date") < F.col("order_approved_at"))
        .alias("impossible_carrier_before_approval"))
    return one.withColumn("late_rate", safe_ratio("late_orders", "delivered_orders", 4))


def sparse_months(coverage: DataFrame) -> DataFrame:
    return coverage.where("is_sparse")

