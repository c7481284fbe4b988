"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.bands import weight_band
from ..functions.dates import month_of, sunday_week, week_start
from ..params import Params


def _with_coordinates(df: DataFrame, prefix: str, who: str, geo: DataFrame) -> DataFrame:
    """No join hint: the prefix table is broadcast only if its measured size allows it."""
    spots = geo.select(F.col("zip_code_prefix").alias(prefix),
                       F.col("latitude").alias(f"{who}_latitude"),
                       F.col("longitude").alias(f"{who}_longitude"))
    return df.join(spots, prefix, "left")


def dim_customer(persons: DataFrame, geo: DataFrame) -> DataFrame:
    return _with_coordinates(persons, "customer_zip_code_prefix", "customer", geo).select(
        "customer_key", "customer_city", "customer_state", "customer_region",
        "customer_zip_code_prefix", "customer_latitude", "customer_longitude",
        "first_order_date", "latest_order_date", "source_customer_id_count",
        "is_repeat_customer")


def dim_seller(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    return _with_coordinates(sellers, "seller_zip_code_prefix", "seller", geo).select(
        "seller_key", "seller_city", "seller_state", "seller_region",
        "seller_zip_code_prefix", "seller_latitude", "seller_longitude")


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_key", "product_category", "product_category_pt", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm", "product_volume_cm3",
        weight_band(F.col("product_weight_g")).alias("product_weight_band"),
        "product_photo_count", "product_name_length", "product_description_length")


def day_spine(spark: SparkSession, params: Params) -> DataFrame:
    days = F.sequence(F.lit(params.calendar_start), F.date_sub(F.lit(params.calendar_end), 1))
    return spark.range(1).select(F.explode(days).alias("date_key"))


def dim_date(spark: SparkSession, params: Params) -> DataFrame:
    d = F.col("date_key")
    return day_spine(spark, params).select(
        d,
        F.year(d).cast("bigint").alias("calendar_year"),
        F.quarter(d).cast("bigint").alias("calendar_quarter"),
        F.month(d).cast("bigint").alias("calendar_month"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        sunday_week(d).alias("week_of_year"),
        F.dayofweek(d).cast("bigint").alias("day_of_week"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.date_format(d, "MMM yyyy").alias("month_label"),
        F.date_format(d, "EEEE").alias("day_name"),
        month_of(d).alias("month_start_date"),
        week_start(d).alias("week_start_date"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        d.between(F.lit(params.window_start), F.lit(params.window_end))
        .alias("is_in_analysis_window"),
    )
