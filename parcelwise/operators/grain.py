"""Fan-out controls: everything that is many-per-order or many-per-person becomes one row.

Groupings start with a map-side partial aggregate, so a single order, person or prefix that
owns a large share of the rows reaches a reducer already reduced.  Where hardly a row is
reduced that way, as for lines of an order, only the keys with such a share are; rows of all
others are narrower than the states made of them, and move as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .heavy import reduced
from .pick import ascending, descending, first_per_key


def payments_per_order(payments: DataFrame) -> DataFrame:
    """The set of payment types per order is bounded by the type domain.

    The type of the largest payment ends its own ordering, so a state holds it once.
    """
    types = F.sort_array(F.collect_set("payment_type"))
    largest = F.struct(*descending(payments, "payment_value"),
                       *ascending("payment_type"))
    return payments.groupBy("order_id").agg(
        F.count("*").alias("payment_record_count"),
        F.sum("payment_value").alias("order_payment_total"),
        F.max("payment_installments").alias("max_payment_installments"),
        F.min(largest)["payment_type"].alias("primary_payment_type"),
        F.when(F.size(types) > 0, F.array_join(types, " + ")).alias("payment_type_mix"),
        F.count_if(F.col("payment_type") == "voucher").alias("voucher_payment_count"),
    )


def order_payments(payments: DataFrame) -> DataFrame:
    """`payments_per_order` over rows, not states, but for orders with very many payments."""
    needed = payments.select("order_id", "payment_type", "payment_value",
                             "payment_installments")
    return reduced(needed, "order_id", payments_per_order, payments_per_order)


def latest_review(reviews: DataFrame) -> DataFrame:
    """Most recent review per order and how many the order had."""
    columns = ["review_id", "review_score", "review_created_at", "review_answered_at",
               "has_comment"]
    order = descending(reviews, "review_created_at")
    return first_per_key(reviews, ["order_id"], columns, order,
                         [F.count("*").alias("source_review_count")])


def items_per_order(items: DataFrame, together: bool = False) -> DataFrame:
    """Order totals, distinct products and sellers, and the seller with most revenue.

    Reducing to (order, seller) first makes the seller count a plain count and gives the
    primary seller without a window; products are reduced to (order, product) beside it.
    Rows per seller then move as they are: states of the second step are twice as wide, and
    an order has at most a row for each seller.
    Both second steps hash by order, so the join of the two adds no shuffle.  Lines that are
    ``together``, those of an order in one task, are not shuffled at all.
    """
    per_seller = items.groupBy("order_id", "seller_key").agg(
        F.count("*").alias("lines"),
        F.sum("item_price").alias("revenue"),
        F.sum("freight_value").alias("freight"),
        F.sum("item_gross_value").alias("gross"),
        F.max("shipping_limit_at").alias("ship_by"),
    )
    if not together:
        per_seller = per_seller.repartition("order_id")
    totals = per_seller.groupBy("order_id").agg(
        F.sum("lines").alias("order_item_count"),
        F.count("seller_key").alias("order_seller_count"),
        F.sum("revenue").cast("decimal(28,9)").alias("order_revenue"),
        F.sum("freight").cast("decimal(28,9)").alias("order_freight"),
        F.sum("gross").cast("decimal(28,9)").alias("order_gross_value"),
        F.max("ship_by").alias("order_shipping_limit_at"),
        F.min_by("seller_key", F.struct(*descending(per_seller, "revenue"),
                                        *ascending("seller_key")))
        .alias("primary_seller_key"),
    )
    products = (
        items.where("product_key is not null").select("order_id", "product_key").distinct()
        .groupBy("order_id").agg(F.count("*").alias("order_product_count"))
    )
    return (
        totals.join(products, "order_id", "left")
        .withColumn("order_product_count", F.coalesce("order_product_count", F.lit(0)))
        .withColumn("is_multi_seller_order", F.col("order_seller_count") > 1)
        .select("order_id", "order_item_count", "order_product_count", "order_seller_count",
                "order_revenue", "order_freight", "order_gross_value",
                "order_shipping_limit_at", "primary_seller_key", "is_multi_seller_order")
    )


def order_items(items: DataFrame) -> DataFrame:
    """`items_per_order` with one shuffle for each branch, but for orders with very many lines.

    Gross values are made where the lines have arrived."""
    needed = items.select("order_id", "seller_key", "product_key", "shipping_limit_at",
                          "item_price", "freight_value")
    gross = F.col("item_price") + F.col("freight_value")
    return reduced(
        needed, "order_id",
        lambda lines: items_per_order(lines.withColumn("item_gross_value", gross), True),
        lambda lines: items_per_order(lines.withColumn("item_gross_value", gross)))


def persons(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per person: address of the latest order, activity span, id count.

    Orders are reduced to one row per customer id before the join.
    """
    activity = orders.groupBy("customer_id").agg(
        F.min("order_purchase_date").alias("_first"),
        F.max("order_purchase_date").alias("_last"),
    )
    joined = customers.join(activity, "customer_id", "left")
    address = ["customer_city", "customer_state", "customer_region",
               "customer_zip_code_prefix"]
    order = [*descending(joined, "_last"), *ascending("customer_id")]
    return first_per_key(
        joined, ["customer_key"], address, order,
        [F.min("_first").alias("first_order_date"),
         F.max("_last").alias("latest_order_date"),
         F.count_distinct("customer_id").alias("source_customer_id_count")],
    ).withColumn("is_repeat_customer", F.col("source_customer_id_count") > 1)
