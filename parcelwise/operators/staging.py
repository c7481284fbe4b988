"""Raw tables to typed, renamed staging frames.  All lazy projections over one scan.

Rows without a key are dropped; nothing is deduplicated here except exact copies of
reviews, so that a uniqueness rule can still see a broken load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import composite_key, has_text, lower_code, title_name, upper_code
from ..params import UNKNOWN_REGION, Params
from .quantiles import Quantile, with_quantiles

LINEAGE = ("_batch_id", "_loaded_at")
MONEY = "decimal(18,9)"


def _lineage(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in LINEAGE if c in df.columns]


def region_lookup(spark: SparkSession, params: Params) -> DataFrame:
    """(state, region): as many rows as the parameter has states, so safe to broadcast."""
    return spark.createDataFrame(sorted(params.region_of_state.items()),
                                 "state string, region string")


def with_region(df: DataFrame, state: str, region: str, lookup: DataFrame) -> DataFrame:
    """Attach the macro-region of a state; unmapped and missing states are Unknown."""
    lk = lookup.select(upper_code("state").alias("_state"), F.col("region").alias("_region"))
    return (
        df.join(lk, F.col(state) == F.col("_state"), "left")
        .withColumn(region, F.coalesce("_region", F.lit(UNKNOWN_REGION)))
        .drop("_state", "_region")
    )


def orders(raw: DataFrame, params: Params) -> DataFrame:
    status = lower_code("order_status")
    return raw.where("order_id is not null").select(
        "order_id",
        "customer_id",
        status.alias("order_status"),
        F.col("order_purchase_timestamp").alias("order_purchased_at"),
        "order_approved_at",
        F.col("order_delivered_carrier_date").alias("order_handed_to_carrier_at"),
        F.col("order_delivered_customer_date").alias("order_delivered_at"),
        F.col("order_estimated_delivery_date").alias("order_promised_at"),
        F.to_date("order_purchase_timestamp").alias("order_purchase_date"),
        F.to_date("order_delivered_customer_date").alias("order_delivered_date"),
        F.to_date("order_estimated_delivery_date").alias("order_promised_date"),
        (status == params.delivered_status).alias("is_delivered"),
        status.isin(*params.excluded_statuses).alias("is_excluded_from_kpis"),
        *_lineage(raw),
    )


def order_items(raw: DataFrame) -> DataFrame:
    price, freight = F.col("price").cast(MONEY), F.col("freight_value").cast(MONEY)
    return raw.where("order_id is not null and order_item_id is not null").select(
        composite_key("order_id", "order_item_id").alias("order_item_key"),
        "order_id",
        "order_item_id",
        F.col("product_id").alias("product_key"),
        F.col("seller_id").alias("seller_key"),
        F.col("shipping_limit_date").alias("shipping_limit_at"),
        price.alias("item_price"),
        freight.alias("freight_value"),
        (price + freight).alias("item_gross_value"),
        *_lineage(raw),
    )


def order_payments(raw: DataFrame) -> DataFrame:
    return raw.where("order_id is not null and payment_sequential is not null").select(
        composite_key("order_id", "payment_sequential").alias("payment_key"),
        "order_id",
        "payment_sequential",
        lower_code("payment_type").alias("payment_type"),
        "payment_installments",
        F.col("payment_value").cast(MONEY).alias("payment_value"),
        *_lineage(raw),
    )


def order_reviews(raw: DataFrame) -> DataFrame:
    """Exact copies are removed; map-side combining keeps a mass of copies off one task."""
    return raw.where("order_id is not null").distinct().select(
        "review_id",
        "order_id",
        "review_score",
        F.col("review_comment_title").alias("review_title"),
        F.col("review_comment_message").alias("review_message"),
        F.col("review_creation_date").alias("review_created_at"),
        F.col("review_answer_timestamp").alias("review_answered_at"),
        has_text("review_comment_message").alias("has_comment"),
        *_lineage(raw),
    )


def customers(raw: DataFrame, regions: DataFrame) -> DataFrame:
    """Bridge from the per-order customer id to the person."""
    named = raw.where("customer_id is not null").select(
        "customer_id",
        F.col("customer_unique_id").alias("customer_key"),
        "customer_zip_code_prefix",
        title_name("customer_city").alias("customer_city"),
        upper_code("customer_state").alias("customer_state"),
        *_lineage(raw),
    )
    return with_region(named, "customer_state", "customer_region", regions)


def sellers(raw: DataFrame, regions: DataFrame) -> DataFrame:
    named = raw.where("seller_id is not null").select(
        F.col("seller_id").alias("seller_key"),
        "seller_zip_code_prefix",
        title_name("seller_city").alias("seller_city"),
        upper_code("seller_state").alias("seller_state"),
        *_lineage(raw),
    )
    return with_region(named, "seller_state", "seller_region", regions)


def products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """English category by normalised name; misspelt source columns are renamed here."""
    names = translation.select(
        lower_code("product_category_name").alias("product_category_pt"),
        lower_code("product_category_name_english").alias("_english"),
    )
    typed = raw.where("product_id is not null").select(
        F.col("product_id").alias("product_key"),
        lower_code("product_category_name").alias("product_category_pt"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        F.col("product_photos_qty").alias("product_photo_count"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"))
        .alias("product_volume_cm3"),
        *_lineage(raw),
    )
    return (
        typed.join(names, "product_category_pt", "left")
        .withColumn("product_category", F.coalesce("_english", F.lit("unknown")))
        .drop("_english")
    )


def geolocation(raw: DataFrame) -> DataFrame:
    """One row per zip prefix: median coordinates, modal place.

    The medians are exact and no prefix is gathered in one task; the modal place combines
    on the map side.
    """
    points = raw.where("geolocation_zip_code_prefix is not null").withColumnRenamed(
        "geolocation_zip_code_prefix", "zip_code_prefix")
    coordinates = with_quantiles(
        points.groupBy("zip_code_prefix").agg(F.count("*").alias("geolocation_point_count")),
        points, ["zip_code_prefix"], {"latitude": Quantile("geolocation_lat", 50),
                                      "longitude": Quantile("geolocation_lng", 50)})
    place = modal_row(
        points.select("zip_code_prefix",
                      title_name("geolocation_city").alias("geolocation_city"),
                      upper_code("geolocation_state").alias("geolocation_state")),
        ["zip_code_prefix"], ["geolocation_city", "geolocation_state"])
    return coordinates.join(place, "zip_code_prefix", "left")


def modal_row(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Most frequent value combination per key; ties go to the smallest combination."""
    counted = df.groupBy(*keys, *values).agg(F.count("*").alias("_n"))
    best = F.min_by(F.struct(*values), F.struct(-F.col("_n"), *values))
    return counted.groupBy(*keys).agg(best.alias("_v")).select(*keys, "_v.*")
