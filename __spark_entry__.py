"""Registered queries over the driver tables and their DuckDB counterparts."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import cache

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T  # noqa: E402

import oracle_sql as _statements  # noqa: E402
from parcelwise.operators import history, staging  # noqa: E402
from parcelwise.functions.frames import union_all  # noqa: E402
from parcelwise.plans import analysis as an, build as runs, profiling as pr  # noqa: E402
from parcelwise.plans.warehouse import Warehouse  # noqa: E402
from parcelwise.quality import gate, invariants, suites  # noqa: E402
from parcelwise.quality.rules import WARN, Rule, evaluate, failing_rows  # noqa: E402
from parcelwise.session import star_warehouse  # noqa: E402
from parcelwise.sources import files, layout, sinks, versions  # noqa: E402
from parcelwise.sources.scratch import Scratch  # noqa: E402

try:  # the text operators can be taken out as a whole
    import corpus_pipeline as _corpus
    from parcelwise.llm import queries as _text
except ImportError:  # or a library that only they need is not there
    _corpus = _text = None

_warehouses: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One per session and folder, so marts are written once and then read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        _warehouses[key] = star_warehouse(spark, sf_dir)
    return _warehouses[key]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and whole numbers as bigint, the types the SQL side returns."""
    wide = {T.DecimalType: "double", T.FloatType: "double", T.IntegerType: "bigint",
            T.ShortType: "bigint", T.ByteType: "bigint"}
    return df.select(*[F.col(f"`{f.name}`").cast(wide[type(f.dataType)]).alias(f.name)
                       if type(f.dataType) in wide else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# --- definitions that need more than one call -------------------------------
HISTORY_CHECK = ["product_category", "product_category_pt"]


def _two_states(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """The products, and a later state: every tenth has another category, every 97th is gone
    and a hundredth as many are brand new."""
    cols = ["product_key", "product_category", "product_category_pt", "product_weight_g",
            "product_volume_cm3"]
    before = w["dim_product"].select(*cols)
    moved = F.when(F.col("product_key") % 10 == 0, F.lit("moved")).otherwise(
        F.col("product_category"))
    kept = before.withColumn("product_category", moved).where("product_key % 97 <> 0")
    added = before.where("product_key % 100 = 0").withColumn(
        "product_key", F.col("product_key") + 1_000_000_000)
    return before, kept.unionByName(added)


def _scd2(w: Warehouse) -> DataFrame:
    before, after = _two_states(w)
    first = history.snapshot(before, None, "product_key", HISTORY_CHECK, datetime(2001, 1, 1))
    return history.snapshot(after, first, "product_key", HISTORY_CHECK, datetime(2001, 2, 1))


def _stored_history(w: Warehouse) -> DataFrame:
    """The same history as four releases of it, the last of which changes nothing, and the
    third only the buckets of products whose key ends in 000."""
    before, after = _two_states(w)
    late = F.col("product_key") % 1000 == 0
    third = after.withColumn("product_category", F.when(late, F.lit("late")).otherwise(
        F.col("product_category")))
    root = f"{Scratch(w.spark, 'history').root}/releases"
    for day, state in enumerate((before, after, third, third), 1):
        name, base = f"2001-0{day}", sinks.released(w.spark, root)
        versions.write_versions(state, root, name, "products", "product_key", HISTORY_CHECK,
                                datetime(2001, day, 1))
        sinks.mark_released(w.spark, root, name, base)
    return sinks.read_released(w.spark, root, "products")


def _rules(*kinds: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: evaluate([r for r in suites.MODEL_RULES if r.kind in kinds], w)


def _mostly(w: Warehouse) -> DataFrame:
    return evaluate(suites.THRESHOLD_RULES, {"geolocation": w["raw.geolocation"]})


@dataclass(frozen=True)
class Loaded:
    paths: dict[str, str]
    root: str
    load: runs.Load

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {t: sinks.read_released(spark, self.root, t) for t in layout.TABLES}

    def manifest(self, spark: SparkSession) -> DataFrame:
        return sinks.read_released(spark, self.root, runs.MANIFEST)


@cache
def _loaded(w: Warehouse) -> Loaded:
    """The nine raw tables written out as CSV files, whole, and loaded from them.

    The load is held to the presence, value-set and key rules; lengths and bounds are those of
    other data and are reported by `file_gate_verdicts`."""
    folder, root = Scratch(w.spark, "csv").root, Scratch(w.spark, "raw").root
    paths = runs.csv_paths(folder)
    for t, path in paths.items():
        sinks.write_csv(w[f"raw.{t}"].select(*[
            F.col(f.name).cast(f.dataType) for f in layout.schema_of(t).fields]), path)
    rules = [r for r in suites.FILE_RULES if r.kind not in ("length", "accepted_range")]
    return Loaded(paths, root, runs.load_raw(w.spark, paths, layout.EXPECTED_ROWS, root,
                                             rules=rules))


def _verdicts(w: Warehouse) -> DataFrame:
    found = _loaded(w)
    return gate.file_results(w.spark, found.paths, layout.EXPECTED_ROWS, WARN,
                             found.load.staged)


def _raw(w: Warehouse) -> dict[str, DataFrame]:
    return {t: w[f"raw.{t}"] for t in layout.TABLES}


def _months(w: Warehouse) -> DataFrame:
    return an.usable_months(w["agg_delivery_monthly"], "orders_placed",
                            w.params.min_month_orders)


def _sales(w: Warehouse) -> DataFrame:
    return an.usable_months(w["agg_monthly_sales"], "order_count", w.params.min_month_orders)


def _window(w: Warehouse, **more):
    return an.scope(w.params.window_start, w.params.window_end, **more)


REGION_COLUMNS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown"]
STATES = [f"NATION_{i}" for i in range(5)]
CORRELATED = ["order_count", "late_rate", "median_delivery_days"]

_QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    # files
    "csv_round_trip": lambda w: union_all(
        files.column_profile(t, df) for t, df in _loaded(w).tables(w.spark).items()),
    "load_manifest": lambda w: _loaded(w).manifest(w.spark).selectExpr(
        "table", "rows", "expected_rows", "rows_match_expected", "bytes > 0 as has_bytes",
        "length(content_digest) as digest_length"),
    "load_reconciliation": lambda w: files.reconcile(
        _loaded(w).manifest(w.spark), _loaded(w).tables(w.spark)),
    "file_gate_verdicts": _verdicts,
    "acceptance_readout": lambda w: files.acceptance(
        _loaded(w).tables(w.spark), layout.EXPECTED_ROWS),
    # staging
    "stg_orders": lambda w: w["stg_orders"],
    "stg_order_items": lambda w: w["stg_order_items"],
    "stg_order_payments": lambda w: w["stg_order_payments"],
    "stg_order_reviews": lambda w: w["stg_order_reviews"],
    "stg_customers": lambda w: w["stg_customers"],
    "stg_sellers": lambda w: w["stg_sellers"],
    "stg_products": lambda w: w["stg_products"],
    "geo_collapse": lambda w: w["stg_geolocation"],
    "modal_value": lambda w: staging.modal_row(
        w["raw.order_payments"], ["order_id"], ["payment_type"]),
    # grain control and measures
    "payments_to_order_grain": lambda w: w["int_order_payments"],
    "latest_review_per_order": lambda w: w["int_order_reviews"],
    "items_rollup_primary_seller": lambda w: w["int_order_items_rollup"],
    "delivery_measures": lambda w: w["int_order_delivery"],
    # dimensions and facts
    "person_dimension": lambda w: w["dim_customer"],
    "seller_dimension": lambda w: w["dim_seller"],
    "product_dimension": lambda w: w["dim_product"],
    "calendar_dimension": lambda w: an.orders_by_day(w["fct_orders"], w["dim_date"]),
    "fct_orders": lambda w: w["fct_orders"],
    "fct_order_items": lambda w: w["fct_order_items"],
    "fct_payments": lambda w: w["fct_payments"],
    # aggregates
    "delivery_by_route": lambda w: w["agg_delivery_by_route"],
    "delivery_monthly": lambda w: w["agg_delivery_monthly"],
    "monthly_sales": lambda w: w["agg_monthly_sales"],
    "product_performance": lambda w: w["agg_product_performance"],
    "customer_rfm": lambda w: w["agg_customer_rfm"],
    "scd2_snapshot": _scd2,
    "history_by_bucket": _stored_history,
    # profiling
    "table_row_counts": lambda w: files.row_counts(_raw(w)),
    "coverage_by_month": lambda w: pr.coverage_by_month(
        w["raw.orders"], w.params.min_month_orders),
    "null_profile": lambda w: pr.null_profile(w["raw.orders"], pr.MILESTONES),
    "milestone_nulls": lambda w: pr.milestone_nulls(w["raw.orders"]),
    "missing_delivery_by_status": lambda w: pr.missing_delivery_by_status(w["raw.orders"]),
    "fanout_multiplier": lambda w: pr.payment_fanout(
        w["raw.order_items"], w["raw.order_payments"]),
    "review_duplication": lambda w: pr.review_duplication(w["raw.order_reviews"]),
    "customer_identity": lambda w: pr.identity(w["raw.customers"]),
    "orders_per_person": lambda w: pr.orders_per_person(w["raw.customers"]),
    "geo_cardinality": lambda w: pr.geo_cardinality(w["raw.geolocation"]),
    "orphan_report": lambda w: pr.orphan_report(
        w["raw.orders"], w["raw.order_items"], w["raw.products"], w["raw.sellers"],
        w["raw.customers"]),
    "raw_delivery_sanity": lambda w: pr.raw_delivery_sanity(w["raw.orders"]),
    # where
    "headline_kpis": lambda w: an.headline(w["fct_orders"]),
    "headline_kpis_filtered": lambda w: an.headline(
        w["fct_orders"], _window(w, regions=["ASIA", "EUROPE"], all_regions=REGION_COLUMNS)),
    "filter_options": lambda w: an.filter_options(
        w["agg_delivery_monthly"], w["dim_customer"]),
    "late_by_state": lambda w: an.late_by_state(
        w["agg_delivery_by_route"], w.params.min_orders),
    "state_board": lambda w: an.late_board(
        w["fct_orders"], ["customer_state", "customer_region"], _window(w),
        w.params.min_orders),
    "ordered_state_board": lambda w: an.ordered_board(
        an.late_board(w["fct_orders"], ["customer_state", "customer_region"], _window(w),
                      w.params.min_orders), "customer_state"),
    "region_board": lambda w: an.late_board(
        w["fct_orders"], ["seller_region", "customer_region"],
        _window(w) & F.col("seller_region").isNotNull(), w.params.min_orders),
    "busiest_late_routes": lambda w: an.busiest_late_routes(w["agg_delivery_by_route"]),
    "worst_routes_by_rate": lambda w: an.worst_of_busiest(w["agg_delivery_by_route"]),
    "route_board": lambda w: an.route_board(w["fct_orders"], _window(w), w.params.min_orders),
    "region_pairs": lambda w: an.region_pairs(w["agg_delivery_by_route"], w.params.min_orders),
    "region_matrix": lambda w: an.region_matrix(
        an.region_pairs(w["agg_delivery_by_route"], w.params.min_orders), REGION_COLUMNS),
    # when
    "usable_months": _months,
    "excluded_months": lambda w: an.excluded_months(
        w["agg_delivery_monthly"], "orders_placed", w.params.min_month_orders),
    "half_window_comparison": lambda w: an.half_window(
        w["agg_delivery_monthly"].where("is_in_analysis_window")),
    "worst_months": lambda w: an.worst_months(_months(w)),
    "stage_decomposition": lambda w: an.stage_decomposition(w["fct_orders"]),
    "stage_months_long": lambda w: an.stage_months(
        w["agg_delivery_monthly"].where("is_in_analysis_window")),
    # cost
    "lateness_bucket_curve": lambda w: an.bucket_curve(w["fct_orders"]),
    "controlled_penalty": lambda w: an.penalty_matrix(w["fct_orders"], STATES),
    "penalty_by_state": lambda w: an.penalty_by_state(
        w["fct_orders"], _window(w), w.params.min_orders),
    "revenue_exposure": lambda w: an.revenue_exposure(w["fct_orders"]),
    "promise_accuracy": lambda w: an.promise_accuracy(w["fct_orders"]),
    "delay_histogram": lambda w: an.delay_histogram(w["fct_orders"]),
    "month_pruned_state_days": lambda w: an.state_days(
        w["fct_orders"], w.params.window_start, w.params.window_end),
    # sales, products, people
    "customers_by_period": lambda w: an.customers_by_period(w["fct_orders"]),
    "sales_totals": lambda w: an.sales_totals(_sales(w)),
    "strongest_months": lambda w: an.sales_extremes(_sales(w)),
    "weakest_months": lambda w: an.sales_extremes(_sales(w), strongest=False),
    "volume_late_correlation": lambda w: an.correlations(
        w["agg_monthly_sales"].where("is_in_analysis_window"), CORRELATED),
    "top_categories_by_revenue": lambda w: an.top_categories(
        w["agg_product_performance"], "revenue"),
    "top_categories_by_units": lambda w: an.top_categories(
        w["agg_product_performance"], "units_sold"),
    "rank_gap": lambda w: an.rank_gaps(w["agg_product_performance"]),
    "category_median_late_rate": lambda w: an.median_late_rate(w["agg_product_performance"]),
    "poor_delivery_categories": lambda w: an.poor_delivery(w["agg_product_performance"]),
    "rfm_segment_summary": lambda w: an.segment_summary(w["agg_customer_rfm"]),
    "frequency_distribution": lambda w: an.frequency_distribution(w["agg_customer_rfm"]),
    "repeat_share": lambda w: an.repeat_share(w["agg_customer_rfm"]),
    "at_risk_exposure": lambda w: an.at_risk(w["agg_customer_rfm"]),
    "reconciliation_readout": lambda w: an.reconciliation(
        w["stg_order_items"], w["stg_orders"], w["fct_order_items"], w["fct_orders"],
        w["dim_customer"], w["agg_customer_rfm"]),
    "metric_agreement": lambda w: an.metric_agreement(
        w["agg_delivery_monthly"], w["fct_orders"], w.params, tolerance=1e-4),
    # rules
    "rule_not_null": _rules("not_null"),
    "rule_unique": _rules("unique"),
    "rule_accepted_values": _rules("accepted_values"),
    "rule_accepted_range": _rules("accepted_range"),
    "rule_relationships": _rules("relationships"),
    "rule_keys": _rules("unique", "relationships"),
    "rule_mostly_between": _mostly,
    "duplicate_item_keys": lambda w: failing_rows(
        Rule("stg_order_items", "unique", "order_id", also=("order_item_id",)), w),
    "invariant_summary": lambda w: invariants.evaluate_invariants(w, w.params),
    "revenue_reconciliation": lambda w: invariants.revenue_reconciles(w, w.params),
    "order_count_reconciliation": lambda w: invariants.order_count_reconciles(w, w.params),
    "payment_fanout_check": lambda w: invariants.payments_not_multiplied(w, w.params),
    "flag_measure_agreement": lambda w: invariants.flag_matches_delay(w, w.params),
    "milestone_chronology": lambda w: invariants.chronology(w, w.params),
    "milestone_recording_order": lambda w: invariants.recording_order(w, w.params),
    "status_timestamp_agreement": lambda w: invariants.status_matches_timestamp(w, w.params),
    "payment_value_agreement": lambda w: invariants.payment_matches_value(w, w.params),
    "purchase_date_window": lambda w: invariants.dates_in_window(w, w.params),
    "rfm_person_grain": lambda w: invariants.rfm_at_person_grain(w, w.params),
}


def entry(spark: SparkSession) -> DataFrame:
    """Where are deliveries late: one row per route."""
    return queries()["delivery_by_route"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Warehouse], DataFrame]):
        return lambda spark, sf_dir: plain(build(warehouse(spark, sf_dir)))

    found = {name: bind(build) for name, build in _QUERIES.items()}
    if _text:
        found |= _text.QUERIES | {"pipeline": _corpus.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = _statements.oracle_sql()
    if _text:
        found |= _text.ORACLE_SQL
        if _corpus.ORACLE_SQL:
            found["pipeline"] = _corpus.ORACLE_SQL
    return found
