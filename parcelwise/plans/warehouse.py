"""The table graph: raw, staging and intermediate frames stay lazy, marts are written once.

Marts are stored as Parquet below the shared folder and read back, so each analysis reads
only the columns it needs.  Facts are laid out by purchase month.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators import delivery, dims, facts, grain, staging
from ..params import Params
from ..sources import sinks
from ..sources.scratch import Scratch, freed
from ..sources.storage import PACKED
from . import aggregates as agg

MARTS = ("dim_customer", "dim_seller", "dim_product", "dim_date", "fct_orders",
         "fct_order_items", "fct_payments", "agg_delivery_by_route", "agg_delivery_monthly",
         "agg_monthly_sales", "agg_product_performance", "agg_customer_rfm")


class Warehouse:
    """``raw`` maps the nine source tables, and optionally ``state_regions``, to frames.

    ``stored`` names raw or intermediate frames that are worth writing as well because
    they are joins rather than projections.
    """

    def __init__(self, spark: SparkSession, raw: Mapping[str, Callable[[], DataFrame]],
                 params: Params, scratch: Scratch, stored: frozenset[str] = frozenset(),
                 target: str | None = None):
        self.spark, self.params, self.scratch, self.target = spark, params, scratch, target
        self._raw, self._stored = raw, stored
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            df = self.build(name)
            self._frames[name] = self._keep(name, df) if self._is_written(name) else df
        return self._frames[name]

    def into(self, folder: str) -> Warehouse:
        """The same tables, with the marts written below ``folder``."""
        return Warehouse(self.spark, self._raw, self.params, self.scratch, self._stored, folder)

    def _is_written(self, name: str) -> bool:
        return name in MARTS and (name != "dim_date" or self.target is not None) \
            or name in self._stored

    def set_down(self, df: DataFrame, name: str) -> DataFrame:
        """Rows per order, stored, so that the shuffles of their lines are gone before the wide
        rows of the order fact move."""
        return self.scratch.save(df, name, **PACKED)

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        root = self.target if self.target and name in MARTS else self.scratch.root
        path = f"{root}/{name}"
        with freed(self.spark):
            write_table(name, df, path)
        return self.spark.read.parquet(path)

    def build(self, name: str) -> DataFrame:
        """The plan of one table, over the tables below it."""
        if name.startswith("raw."):
            return self._raw[name[4:]]()
        return _MODELS[name](self)


def write_table(name: str, df: DataFrame, path: str) -> None:
    if name == "fct_orders":
        sinks.write_by_month(df, path, sinks.ORDER_LAYOUT, again=facts.order_measures())
    elif name == "fct_order_items":
        sinks.write_by_month(df, path, sinks.ITEM_LAYOUT, again=facts.item_measures())
    elif name == "fct_payments":
        sinks.write_clustered(df, path, sinks.PAYMENT_LAYOUT)
    else:
        df.write.options(**PACKED).parquet(path)


def _regions(w: Warehouse) -> DataFrame:
    if "state_regions" in w._raw:
        return w["raw.state_regions"]
    return staging.region_lookup(w.spark, w.params)


_MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "stg_orders": lambda w: staging.orders(w["raw.orders"], w.params),
    "stg_order_items": lambda w: staging.order_items(w["raw.order_items"]),
    "stg_order_payments": lambda w: staging.order_payments(w["raw.order_payments"]),
    "stg_order_reviews": lambda w: staging.order_reviews(w["raw.order_reviews"]),
    "stg_customers": lambda w: staging.customers(w["raw.customers"], _regions(w)),
    "stg_sellers": lambda w: staging.sellers(w["raw.sellers"], _regions(w)),
    "stg_products": lambda w: staging.products(
        w["raw.products"], w["raw.product_category_translation"]),
    "stg_geolocation": lambda w: staging.geolocation(w["raw.geolocation"]),
    "int_order_payments": lambda w: grain.order_payments(w["stg_order_payments"]),
    "int_order_reviews": lambda w: grain.latest_review(w["stg_order_reviews"]),
    "int_order_items_rollup": lambda w: grain.order_items(w["stg_order_items"]),
    "int_order_delivery": lambda w: delivery.delivery(w["stg_orders"]),
    "persons": lambda w: grain.persons(w["stg_customers"], w["stg_orders"]),
    "dim_customer": lambda w: dims.dim_customer(w["persons"], w["stg_geolocation"]),
    "dim_seller": lambda w: dims.dim_seller(w["stg_sellers"], w["stg_geolocation"]),
    "dim_product": lambda w: dims.dim_product(w["stg_products"]),
    "dim_date": lambda w: dims.dim_date(w.spark, w.params),
    "fct_orders": lambda w: facts.fct_orders(
        w["int_order_delivery"], w["stg_customers"], w["dim_customer"], w["dim_seller"],
        w.set_down(facts.with_places(w["int_order_items_rollup"], w["dim_seller"]), "items"),
        w.set_down(w["int_order_payments"], "payments"), w["int_order_reviews"]),
    "fct_order_items": lambda w: facts.fct_order_items(
        w["stg_order_items"], w["stg_orders"], w["stg_customers"]),
    "fct_payments": lambda w: facts.fct_payments(w["stg_order_payments"], w["stg_orders"]),
    "agg_delivery_by_route": lambda w: agg.delivery_by_route(w["fct_orders"], w.params),
    "agg_delivery_monthly": lambda w: agg.delivery_monthly(w["fct_orders"], w["dim_date"]),
    "agg_monthly_sales": lambda w: agg.monthly_sales(
        w["fct_order_items"], w["fct_orders"], w["agg_delivery_monthly"], w["dim_date"]),
    "agg_product_performance": lambda w: agg.product_performance(
        w["fct_order_items"], w["dim_product"], w["fct_orders"], w.params),
    "agg_customer_rfm": lambda w: agg.customer_rfm(w["fct_orders"], w.params, w.scratch),
}
TABLES = tuple(_MODELS)
