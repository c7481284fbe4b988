"""The nine raw tables expressed over an order / line-item star schema.

Columns the star schema lacks (milestones, freight, payment lines, reviews, coordinates)
are derived from the ones it has, row by row, so every table grows with its source.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..params import Params

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events")

# Cut-offs that suit the dates and volumes of these tables.  The calendar covers every order
# and the window trims the first and last month.
STAR_PARAMS = Params(
    as_of=date(2001, 12, 31),
    window_start=date(1995, 2, 1),
    window_end=date(2001, 6, 30),
    calendar_start=date(1995, 1, 1),
    calendar_end=date(2001, 8, 2),
    min_orders=8,
    min_month_orders=125,
    top_categories=3,
    region_of_state={},
)


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in SOURCE_TABLES}


def raw_orders(t: Mapping[str, DataFrame]) -> DataFrame:
    shipped = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("last_ship"))
    return t["orders"].join(shipped, "o_orderkey", "left").selectExpr(
        "o_orderkey as order_id",
        "o_orderkey as customer_id",
        "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped'"
        " else 'canceled' end as order_status",
        "o_orderdate as order_purchase_timestamp",
        "o_orderdate + make_dt_interval(0, cast(o_orderkey % 72 as int),"
        " cast(o_orderkey % 60 as int)) as order_approved_at",
        "o_orderdate + make_dt_interval(0, cast(24 + (o_orderkey * 7) % 168 as int),"
        " cast((o_orderkey * 11) % 60 as int)) as order_delivered_carrier_date",
        "case when o_orderstatus = 'F' and o_orderkey % 97 <> 0 then o_orderdate"
        " + make_dt_interval(pmod(datediff(last_ship, o_orderdate), 45),"
        " cast(o_orderkey % 24 as int), cast((o_orderkey * 17) % 60 as int))"
        " end as order_delivered_customer_date",
        "o_orderdate + make_dt_interval(7 * cast(substr(o_orderpriority, 1, 1) as int))"
        " as order_estimated_delivery_date",
    )


def raw_order_items(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["lineitem"].selectExpr(
        "l_orderkey as order_id",
        "cast(l_linenumber as bigint) as order_item_id",
        "l_partkey as product_id",
        "l_suppkey as seller_id",
        "l_shipdate as shipping_limit_date",
        "cast(l_extendedprice as decimal(18,9)) as price",
        "cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))"
        " as decimal(12,2)) as freight_value",
    )


def raw_order_payments(t: Mapping[str, DataFrame]) -> DataFrame:
    """A line pays its gross value, or the price alone where the discount is 5 % or more."""
    return t["lineitem"].selectExpr(
        "l_orderkey as order_id",
        "cast(l_linenumber as bigint) as payment_sequential",
        "case l_returnflag when 'A' then 'credit_card' when 'N' then 'boleto'"
        " else 'voucher' end as payment_type",
        "cast(l_quantity as bigint) as payment_installments",
        "cast(cast(l_extendedprice as decimal(12,2)) * case when l_discount < 0.05"
        " then 1 + cast(l_tax as decimal(4,2)) else 1 end as decimal(12,2))"
        " as payment_value",
    )


def raw_order_reviews(t: Mapping[str, DataFrame]) -> DataFrame:
    """Half of the order ids, in turn, receive one review per event."""
    half = F.floor(t["orders"].agg(F.count("*")).scalar() / 2)
    return t["events"].select(
        F.col("event_id").alias("review_id"),
        (F.col("event_id") % half).alias("order_id"),
        (F.col("event_id") % 5 + 1).alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.expr("case when event_type <> 'view' then props end").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        F.expr("ts + make_dt_interval(0, cast(event_id % 72 as int))")
        .alias("review_answer_timestamp"),
    )


def raw_customers(t: Mapping[str, DataFrame]) -> DataFrame:
    """Every other order of a person ships to the next nation."""
    buyers = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "left")
    return (
        buyers.withColumn("n_nationkey", F.expr("cast((c_nationkey + o_orderkey % 2) % 25 as int)"))
        .join(t["nation"].select("n_nationkey", "n_name"), "n_nationkey", "left")
        .selectExpr("o_orderkey as customer_id", "o_custkey as customer_unique_id",
                    "c_custkey as customer_zip_code_prefix", "c_mktsegment as customer_city",
                    "n_name as customer_state")
    )


def raw_products(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["part"].selectExpr(
        "p_partkey as product_id",
        "p_type as product_category_name",
        "cast(length(p_name) as bigint) as product_name_lenght",
        "cast(length(p_brand) as bigint) as product_description_lenght",
        "cast(p_partkey % 6 as bigint) as product_photos_qty",
        "case when p_partkey % 101 <> 0 then cast(p_size * 250 as bigint) end"
        " as product_weight_g",
        "cast(p_size as bigint) as product_length_cm",
        "cast(p_size % 7 + 1 as bigint) as product_height_cm",
        "cast(p_size % 11 + 1 as bigint) as product_width_cm",
    )


def raw_sellers(t: Mapping[str, DataFrame]) -> DataFrame:
    shops = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return shops.selectExpr(
        "s_suppkey as seller_id", "s_suppkey as seller_zip_code_prefix",
        "concat('city of ', lower(n_name)) as seller_city", "n_name as seller_state")


def raw_geolocation(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["events"].selectExpr(
        "user_id as geolocation_zip_code_prefix", "value as geolocation_lat",
        "-value / 4 as geolocation_lng", "event_type as geolocation_city",
        "substr(event_type, 1, 2) as geolocation_state")


def raw_translation(t: Mapping[str, DataFrame]) -> DataFrame:
    """Spelled with other case and spaces than the products use."""
    return t["part"].select("p_type").distinct().selectExpr(
        "concat(' ', lower(p_type)) as product_category_name",
        "concat(p_type, ' goods ') as product_category_name_english")


def state_regions(t: Mapping[str, DataFrame]) -> DataFrame:
    """Nation to region."""
    return t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")) \
        .selectExpr("n_name as state", "r_name as region")


RAW_BUILDERS = {
    "orders": raw_orders,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
    "customers": raw_customers,
    "products": raw_products,
    "sellers": raw_sellers,
    "geolocation": raw_geolocation,
    "product_category_translation": raw_translation,
    "state_regions": state_regions,
}
