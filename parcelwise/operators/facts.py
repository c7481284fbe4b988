"""Fact tables.  Every right-hand side is unique on its join key, so no join adds rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import safe_ratio
from ..functions.text import composite_key, route_label, same_place
from . import delivery as milestones
from .heavy import join_unique


def order_measures() -> list[dict[str, Column]]:
    """Columns of the order fact that its other columns determine, each step from those before."""
    origin, destination = F.col("seller_state"), F.col("customer_state")
    gross = F.col("order_gross_value")
    return [{
        "order_key": F.col("order_id"), "order_date_key": F.col("order_purchase_date"),
        "order_delivered_date": F.to_date("order_delivered_at"),
        "order_promised_date": F.to_date("order_promised_at"),
        "delivery_route": route_label(origin, destination),
        "is_intra_state_route": same_place(origin, destination),
        "is_multi_seller_order": F.col("order_seller_count") > 1,
        "freight_share_of_order": F.when(gross > 0, safe_ratio("order_freight", gross, 4)),
        **milestones.stages(),
    }, milestones.verdicts(), {
        "late_order_revenue": F.when(F.col("is_late"), F.col("order_revenue"))}]


def item_measures() -> list[dict[str, Column]]:
    """Columns of the item fact that its other columns determine."""
    return [{
        "order_item_key": composite_key("order_id", "order_item_id"),
        "order_key": F.col("order_id"), "order_date_key": F.col("order_purchase_date"),
        "item_gross_value": F.col("item_price") + F.col("freight_value")}]


def with_places(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """The roll-up of items by order, with the place of its seller.

    Where the sellers are too many to be sent to every task, this narrow frame travels by
    seller and not the wide order."""
    shops = sellers.select("seller_key", "seller_state", "seller_region", "seller_city")
    return items.withColumnRenamed("primary_seller_key", "seller_key").join(
        shops, "seller_key", "left")


def fct_orders(delivery: DataFrame, customers: DataFrame, persons: DataFrame,
               sellers: DataFrame, items: DataFrame, payments: DataFrame,
               reviews: DataFrame) -> DataFrame:
    """One row per order.

    The address of the person is joined to the narrow bridge first, so that the wide
    order rows travel twice only: by customer id, then by order id for the three
    order-grain frames, which are already partitioned that way.  Items `with_places` do not
    meet the sellers again.
    """
    bridge = customers.select("customer_id", "customer_key").join(
        persons.select("customer_key", "customer_state", "customer_region", "customer_city"),
        "customer_key", "left")
    placed = "seller_state" in items.columns
    joined = (
        delivery.join(bridge, "customer_id", "left")
        .join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .join(reviews, "order_id", "left")
    )
    joined = joined if placed else with_places(joined, sellers)
    origin, destination = F.col("seller_state"), F.col("customer_state")
    gross = F.col("order_gross_value")
    return joined.select(
        F.col("order_id").alias("order_key"), "order_id", "customer_key", "seller_key",
        F.col("order_purchase_date").alias("order_date_key"),
        F.col("customer_id").alias("source_customer_id"),
        "order_status", "is_delivered", "is_excluded_from_kpis",
        "customer_state", "customer_region", "customer_city",
        "seller_state", "seller_region", "seller_city",
        route_label(origin, destination).alias("delivery_route"),
        same_place(origin, destination).alias("is_intra_state_route"),
        "order_purchased_at", "order_approved_at", "order_handed_to_carrier_at",
        "order_delivered_at", "order_promised_at",
        "order_purchase_date", "order_delivered_date", "order_promised_date",
        "approval_days", "seller_handover_days", "carrier_transit_days",
        "total_delivery_days", "promised_delivery_days", "delay_vs_promise_days",
        "promise_slack_days", "is_late", "lateness_bucket",
        "order_item_count", "order_product_count", "order_seller_count",
        "is_multi_seller_order", "order_revenue", "order_freight", "order_gross_value",
        "order_shipping_limit_at",
        "order_payment_total", "payment_record_count", "primary_payment_type",
        "payment_type_mix", "max_payment_installments",
        "review_id", "review_score", F.col("has_comment").alias("review_has_comment"),
        "source_review_count",
        F.when(gross > 0, safe_ratio("order_freight", gross, 4))
        .alias("freight_share_of_order"),
        F.when(F.col("is_late"), F.col("order_revenue")).alias("late_order_revenue"),
    )


def fct_order_items(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per item line, without delivery measures.

    Person and order context meet at order grain, so the item lines shuffle once; an order
    with very many lines is spread over tasks.
    """
    context = orders.select("order_id", "customer_id", "order_status", "order_purchase_date",
                            "is_delivered", "is_excluded_from_kpis").join(
        customers.select("customer_id", "customer_key"), "customer_id", "left")
    return join_unique(items, context, "order_id").select(
        "order_item_key", F.col("order_id").alias("order_key"), "order_id", "order_item_id",
        "product_key", "seller_key", "customer_key",
        F.col("order_purchase_date").alias("order_date_key"),
        "order_status", "is_delivered", "is_excluded_from_kpis", "order_purchase_date",
        "shipping_limit_at", "item_price", "freight_value", "item_gross_value")


def fct_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    context = orders.select("order_id", "order_status",
                            F.col("order_purchase_date").alias("order_date_key"))
    return join_unique(payments, context, "order_id").select(
        "payment_key", F.col("order_id").alias("order_key"), "order_id",
        "payment_sequential", "order_date_key", "order_status", "payment_type",
        "payment_installments", "payment_value")
