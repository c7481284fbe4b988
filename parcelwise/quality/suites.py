"""The declared rules: raw-file suites, and rules on raw, staging, intermediate and marts.

Bounds and value sets are fixed values.
"""

from __future__ import annotations

from ..params import (
    LATENESS_BUCKETS, NOT_DELIVERED, ORDER_STATUSES, PAYMENT_TYPES, REGIONS, SEGMENTS,
    UNKNOWN_REGION, UNKNOWN_WEIGHT, WEIGHT_BANDS,
)
from ..sources.layout import KEYS
from .rules import WARN, Rule, accepted, in_range, key, not_null, refers, unique

SCORES = (1, 2, 3, 4, 5)
REGION_LABELS = (*REGIONS, UNKNOWN_REGION)
BUCKET_LABELS = (NOT_DELIVERED, *[label for _, label in LATENESS_BUCKETS])
BAND_LABELS = (UNKNOWN_WEIGHT, *[label for _, label in WEIGHT_BANDS])
MAX_PRICE, MAX_FREIGHT = 100_000, 10_000


def _nonnegative(table: str, *columns: str) -> list[Rule]:
    return [r for c in columns for r in in_range(table, c, low=0)]


def _length(table: str, column: str, n: int) -> list[Rule]:
    return [Rule(table, "length", column, values=(n,))]


# Columns that must be present in a file before it is loaded, beside its declared key.
REQUIRED = {
    "orders": ("customer_id", "order_status", "order_purchase_timestamp"),
    "order_items": ("product_id", "seller_id"),
    "order_payments": ("payment_type",),
    "order_reviews": ("order_id", "review_score"),
    "customers": ("customer_unique_id", "customer_state"),
    "sellers": ("seller_state",),
    "geolocation": ("geolocation_lat", "geolocation_lng"),
    "product_category_translation": ("product_category_name_english",),
}
FILE_KEYS = {table: (*keys, *REQUIRED.get(table, ())) for table, keys in KEYS.items()}
FILE_RULES: list[Rule] = [
    *[r for table, cols in FILE_KEYS.items() for r in not_null(table, *cols)],
    *accepted("orders", "order_status", ORDER_STATUSES),
    *in_range("order_items", "price", 0, MAX_PRICE),
    *in_range("order_items", "freight_value", 0, MAX_FREIGHT),
    *in_range("order_items", "order_item_id", 1),
    *accepted("order_payments", "payment_type", PAYMENT_TYPES),
    *in_range("order_payments", "payment_value", 0, MAX_PRICE),
    *in_range("order_payments", "payment_installments", 0),
    *in_range("order_reviews", "review_score", 1, 5),
    *_length("customers", "customer_state", 2),
    *_length("sellers", "seller_state", 2),
    *in_range("geolocation", "geolocation_lat", -35.0, 6.0, mostly=0.999),
    *in_range("geolocation", "geolocation_lng", -75.0, -32.0, mostly=0.999),
    *unique("products", *KEYS["products"]),
]

# The coordinate thresholds, and two looser ones that the star-schema points can meet.
THRESHOLD_RULES: list[Rule] = [
    *[r for r in FILE_RULES if r.mostly < 1],
    *in_range("geolocation", "geolocation_lat", 0, 400, mostly=0.9),
    *in_range("geolocation", "geolocation_lat", 0, 1, inclusive=False, mostly=0.5),
]

# Entities whose declared key is one column that the source promises to be unique.
SINGLE_KEYS = ("orders", "customers", "products", "sellers", "product_category_translation")

RAW_RULES: list[Rule] = [
    *[r for table in SINGLE_KEYS for r in key(f"raw.{table}", *KEYS[table])],
    *not_null("raw.orders", "customer_id", "order_purchase_timestamp"),
    *accepted("raw.orders", "order_status", ORDER_STATUSES),
    *not_null("raw.order_items", "order_id", "order_item_id", "product_id", "seller_id",
              "price"),
    *not_null("raw.order_payments", "order_id"),
    *accepted("raw.order_payments", "payment_type", PAYMENT_TYPES),
    *not_null("raw.order_reviews", "order_id"),
    *not_null("raw.customers", "customer_unique_id", "customer_state"),
    *not_null("raw.sellers", "seller_state"),
    *not_null("raw.geolocation", "geolocation_zip_code_prefix"),
    *not_null("raw.product_category_translation", "product_category_name_english"),
]

STAGING_RULES: list[Rule] = [
    *key("stg_orders", "order_id"),
    *not_null("stg_orders", "customer_id", "order_purchased_at", "order_purchase_date"),
    *accepted("stg_orders", "order_status", ORDER_STATUSES),
    *key("stg_order_items", "order_item_key"),
    *not_null("stg_order_items", "order_id", "product_key", "seller_key", "item_price",
              "freight_value"),
    *_nonnegative("stg_order_items", "item_price", "freight_value"),
    *key("stg_order_payments", "payment_key"),
    *not_null("stg_order_payments", "order_id"),
    *accepted("stg_order_payments", "payment_type", PAYMENT_TYPES),
    *_nonnegative("stg_order_payments", "payment_value"),
    *not_null("stg_order_reviews", "order_id", "review_score"),
    *accepted("stg_order_reviews", "review_score", SCORES),
    *key("stg_customers", "customer_id"),
    *not_null("stg_customers", "customer_key", "customer_state"),
    *accepted("stg_customers", "customer_region", REGION_LABELS),
    *key("stg_sellers", "seller_key"),
    *not_null("stg_sellers", "seller_state"),
    *accepted("stg_sellers", "seller_region", REGION_LABELS),
    *key("stg_products", "product_key"),
    *not_null("stg_products", "product_category"),
    *_nonnegative("stg_products", "product_weight_g"),
    *key("stg_geolocation", "zip_code_prefix"),
    *in_range("stg_geolocation", "latitude", -35, 6, severity=WARN),
    *in_range("stg_geolocation", "longitude", -75, -32, severity=WARN),
]

INTERMEDIATE_RULES: list[Rule] = [
    *key("int_order_payments", "order_id"),
    *_nonnegative("int_order_payments", "order_payment_total"),
    *accepted("int_order_payments", "primary_payment_type", PAYMENT_TYPES),
    *key("int_order_reviews", "order_id"),
    *accepted("int_order_reviews", "review_score", SCORES),
    *key("int_order_items_rollup", "order_id"),
    *not_null("int_order_items_rollup", "order_revenue", "primary_seller_key"),
    *_nonnegative("int_order_items_rollup", "order_revenue", "order_freight"),
    *in_range("int_order_items_rollup", "order_item_count", 1),
    *key("int_order_delivery", "order_id"),
    *in_range("int_order_delivery", "total_delivery_days", 0, 240),
    *in_range("int_order_delivery", "approval_days", 0, 365),
    *in_range("int_order_delivery", "seller_handover_days", -200, 365),
    *in_range("int_order_delivery", "carrier_transit_days", -30, 365),
    *in_range("int_order_delivery", "delay_vs_promise_days", -200, 200),
    *accepted("int_order_delivery", "lateness_bucket", BUCKET_LABELS),
]

MART_RULES: list[Rule] = [
    *key("dim_customer", "customer_key"),
    *not_null("dim_customer", "customer_state"),
    *accepted("dim_customer", "customer_region", REGION_LABELS),
    *in_range("dim_customer", "source_customer_id_count", 1),
    *key("dim_seller", "seller_key"),
    *not_null("dim_seller", "seller_state"),
    *accepted("dim_seller", "seller_region", REGION_LABELS),
    *key("dim_product", "product_key"),
    *not_null("dim_product", "product_category"),
    *accepted("dim_product", "product_weight_band", BAND_LABELS),
    *key("dim_date", "date_key"),
    *not_null("dim_date", "year_month"),
    *key("fct_orders", "order_key"),
    *refers("fct_orders", "customer_key", "dim_customer", "customer_key"),
    *refers("fct_orders", "seller_key", "dim_seller", "seller_key"),
    *refers("fct_orders", "order_date_key", "dim_date", "date_key"),
    *not_null("fct_orders", "order_status"),
    *accepted("fct_orders", "order_status", ORDER_STATUSES),
    *_nonnegative("fct_orders", "order_revenue", "order_freight"),
    *in_range("fct_orders", "total_delivery_days", 0, 240),
    *accepted("fct_orders", "review_score", SCORES),
    *key("fct_order_items", "order_item_key"),
    *refers("fct_order_items", "order_key", "fct_orders", "order_key"),
    *not_null("fct_order_items", "product_key", "seller_key", "item_price"),
    *refers("fct_order_items", "product_key", "dim_product", "product_key"),
    *refers("fct_order_items", "seller_key", "dim_seller", "seller_key"),
    *refers("fct_order_items", "customer_key", "dim_customer", "customer_key"),
    *_nonnegative("fct_order_items", "item_price", "freight_value"),
    *key("fct_payments", "payment_key"),
    *refers("fct_payments", "order_key", "fct_orders", "order_key"),
    *_nonnegative("fct_payments", "payment_value"),
    *key("agg_delivery_by_route", "delivery_route"),
    *in_range("agg_delivery_by_route", "late_rate", 0, 1),
    *key("agg_delivery_monthly", "year_month"),
    *in_range("agg_delivery_monthly", "late_rate", 0, 1),
    *key("agg_monthly_sales", "year_month"),
    *not_null("agg_monthly_sales", "revenue"),
    *_nonnegative("agg_monthly_sales", "revenue", "order_count"),
    *key("agg_product_performance", "product_category"),
    *not_null("agg_product_performance", "revenue"),
    *_nonnegative("agg_product_performance", "revenue"),
    *key("agg_customer_rfm", "customer_key"),
    *_nonnegative("agg_customer_rfm", "recency_days", "monetary"),
    *in_range("agg_customer_rfm", "frequency", 1),
    *not_null("agg_customer_rfm", "rfm_segment"),
    *accepted("agg_customer_rfm", "rfm_segment", SEGMENTS),
]

MODEL_RULES: list[Rule] = RAW_RULES + STAGING_RULES + INTERMEDIATE_RULES + MART_RULES
