"""Analyst queries over the marts.

Every function returns a DataFrame small enough to show.  Order and limit appear only
where the question is a top-k; ties end in a unique column.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import purchased_between
from ..functions.frames import union_all
from ..functions.numbers import (
    fixed, floored_ratio, mean, mean_if, safe_ratio, tally,
)
from ..operators import bitmaps
from ..operators.quantiles import Quantile, with_quantiles
from ..params import Params
from ..sources.scratch import Scratch
from .aggregates import IN_SCOPE, KEPT, TOTAL, money, on_time


def _total(name: str, places: int) -> Column:
    return F.round(F.sum(name), places).cast(TOTAL)


def _or(where: Column | None, default: str = IN_SCOPE) -> Column:
    return F.expr(default) if where is None else where


def scope(first: date | None = None, last: date | None = None,
          regions: Sequence[str] | None = None,
          all_regions: Sequence[str] | None = None) -> Column:
    """Headline scope, optionally limited to purchase dates and destination regions.

    The region predicate is left out when every region is chosen.
    """
    pred = F.expr(IN_SCOPE)
    if first is not None and last is not None:
        pred = pred & purchased_between(first, last)
    if regions and set(regions) != set(all_regions or ()):
        pred = pred & F.col("customer_region").isin(*regions)
    return pred


def filter_options(agg_delivery_monthly: DataFrame, dim_customer: DataFrame) -> DataFrame:
    months = agg_delivery_monthly.where("is_in_analysis_window").select(
        F.lit("year_month").alias("filter"), F.col("year_month").alias("choice"))
    regions = dim_customer.where("customer_region is not null").select(
        F.lit("customer_region").alias("filter"), F.col("customer_region").alias("choice"))
    return months.distinct().unionByName(regions.distinct())


# --- headline ----------------------------------------------------------------
def headline(fct_orders: DataFrame, where: Column | None = None) -> DataFrame:
    late, revenue = F.sum("late_order_revenue"), F.sum("order_revenue")
    scoped = fct_orders.where(_or(where))
    one = scoped.agg(
        F.count("*").alias("delivered_orders"),
        tally("is_late").alias("late_orders"),
        safe_ratio(tally("is_late"), F.count("*"), 4).alias("late_rate"),
        _total("order_revenue", 2).alias("revenue"),
        _total("late_order_revenue", 2).alias("revenue_delivered_late"),
        safe_ratio(late, revenue, 4).alias("late_revenue_share"),
        mean_if("is_late", "review_score", 2).alias("avg_review_when_late"),
        mean_if(on_time(), "review_score", 2).alias("avg_review_when_on_time"),
        mean("promise_slack_days", 2).alias("avg_promise_slack_days"),
    )
    one = with_quantiles(one, scoped, [], {
        "median_delivery_days": Quantile("total_delivery_days", 50, 1),
        "p90_delivery_days": Quantile("total_delivery_days", 90, 1)})
    gap = F.col("avg_review_when_on_time") - F.col("avg_review_when_late")
    return one.withColumn("satisfaction_penalty", fixed(gap, 2))


# --- where -------------------------------------------------------------------
def late_by_state(routes: DataFrame, floor: int) -> DataFrame:
    """States from routes: sums of sums and a ratio of sums, never a mean of ratios."""
    return routes.groupBy("customer_state", "customer_region").agg(
        F.sum("delivered_orders").alias("delivered_orders"),
        F.sum("late_orders").alias("late_orders"),
        safe_ratio(F.sum("late_orders"), F.sum("delivered_orders"), 4).alias("late_rate"),
        _total("delivered_revenue", 0).alias("revenue"),
    ).where(F.col("delivered_orders") >= floor)


def late_board(fct_orders: DataFrame, keys: Sequence[str], where: Column,
               floor: int) -> DataFrame:
    """Late rate, median days and money of any grouping of the orders in scope."""
    scoped = fct_orders.where(where)
    board = scoped.groupBy(*keys).agg(
        F.count("*").alias("delivered_orders"),
        tally("is_late").alias("late_orders"),
        safe_ratio(tally("is_late"), F.count("*"), 4).alias("late_rate"),
        money("order_revenue").alias("revenue"),
        money("late_order_revenue").alias("late_revenue"),
    ).where(F.col("delivered_orders") >= floor)
    return with_quantiles(board, scoped, keys,
                          {"median_days": Quantile("total_delivery_days", 50)})


def ordered_board(board: DataFrame, key: str) -> DataFrame:
    """A board from worst to best, with the place of each row; ties end in the key."""
    worst = Window.orderBy(F.desc("late_rate"), F.desc("delivered_orders"), key)
    return board.withColumn("place", F.row_number().over(worst).cast("bigint")).orderBy("place")


def busiest_late_routes(routes: DataFrame, k: int = 20) -> DataFrame:
    return routes.where("is_reportable").orderBy(
        F.desc("late_orders"), "delivery_route").limit(k).select(
        "delivery_route", "seller_region", "customer_region", "delivered_orders",
        "late_orders", "late_rate", "median_delivery_days", "p90_delivery_days",
        F.round("delivered_revenue", 0).cast(TOTAL).alias("revenue"),
        "review_score_penalty_when_late")


def worst_of_busiest(routes: DataFrame, busiest: int = 20, k: int = 10) -> DataFrame:
    return busiest_late_routes(routes, busiest).orderBy(
        F.desc("late_rate"), "delivery_route").limit(k).select(
        "delivery_route", "delivered_orders", "late_rate", "median_delivery_days", "revenue")


def route_board(fct_orders: DataFrame, where: Column, floor: int, k: int = 15) -> DataFrame:
    board = late_board(fct_orders, ["delivery_route"],
                       where & F.col("seller_state").isNotNull(), floor)
    return board.drop("revenue").orderBy(F.desc("late_orders"), "delivery_route").limit(k)


def region_pairs(routes: DataFrame, floor: int) -> DataFrame:
    return routes.groupBy("seller_region", "customer_region").agg(
        F.sum("delivered_orders").alias("orders"),
        safe_ratio(F.sum("late_orders"), F.sum("delivered_orders"), 4).alias("late_rate"),
    ).where(F.col("orders") >= floor)


def region_matrix(pairs: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Origin by destination; listing the columns keeps the pivot to one pass."""
    return pairs.groupBy("seller_region").pivot("customer_region", list(regions)).agg(
        F.first("late_rate"))


# --- when --------------------------------------------------------------------
def usable_months(monthly: DataFrame, volume: str, floor: int) -> DataFrame:
    return monthly.where(_usable(volume, floor))


def excluded_months(monthly: DataFrame, volume: str, floor: int) -> DataFrame:
    """The complement, including months whose flag or volume is NULL."""
    return monthly.where(~F.coalesce(_usable(volume, floor), F.lit(False)))


def _usable(volume: str, floor: int) -> Column:
    return F.col("is_in_analysis_window") & (F.col(volume) >= floor)


def half_window(months: DataFrame) -> DataFrame:
    """Late rate of the first and the last n // 2 months; an odd middle month is dropped."""
    everything = Window.partitionBy()  # one row per month
    half = F.floor(F.count("*").over(everything) / 2)
    rank = F.row_number().over(Window.orderBy("month_start_date"))
    placed = months.select(
        "late_orders", "orders_delivered",
        (rank <= half).alias("first"),
        (rank > F.count("*").over(everything) - half).alias("second"))
    rate = lambda side: floored_ratio(
        F.sum(F.when(F.col(side), F.col("late_orders"))),
        F.coalesce(F.sum(F.when(F.col(side), F.col("orders_delivered"))), F.lit(0)))
    one = placed.agg(rate("first").alias("a"), rate("second").alias("b"))
    return one.select(
        fixed("a", 4).alias("first_half_rate"), fixed("b", 4).alias("second_half_rate"),
        fixed((F.col("b") - F.col("a")) * 100, 2).alias("change_pp"),
        F.when(F.col("b") < F.col("a"), "improving").otherwise("worsening").alias("trend"))


def worst_months(months: DataFrame, k: int = 5) -> DataFrame:
    return months.orderBy(F.desc("late_rate"), "month_start_date").limit(k).select(
        "year_month", "orders_placed", "late_rate", "median_delivery_days")


STAGES = {
    "median_approval_days": "1. payment approval",
    "median_handover_days": "2. seller handover",
    "median_transit_days": "3. carrier transit",
}


def stage_decomposition(fct_orders: DataFrame, where: Column | None = None) -> DataFrame:
    """Median of each stage and its share of the median total."""
    scoped = fct_orders.where(_or(where))
    one = scoped.agg(F.count("*").alias("_orders"))
    medians = with_quantiles(one, scoped, [], {
        "median_approval_days": Quantile("approval_days", 50, 2),
        "median_handover_days": Quantile("seller_handover_days", 50, 2),
        "median_transit_days": Quantile("carrier_transit_days", 50, 2),
        "total": Quantile("total_delivery_days", 50, 2)})
    return _stages_long(medians, ["total"]).select(
        "stage", "days", safe_ratio("days", "total", 3).alias("share_of_total"))


def stage_months(months: DataFrame) -> DataFrame:
    return _stages_long(months.select("year_month", "month_start_date", *STAGES),
                        ["year_month", "month_start_date"])


def _stages_long(df: DataFrame, ids: list[str]) -> DataFrame:
    label = F.col("stage")
    for column, name in STAGES.items():
        label = F.when(F.col("stage") == column, name).otherwise(label)
    return df.unpivot(ids, list(STAGES), "stage", "days").withColumn("stage", label)


# --- cost --------------------------------------------------------------------
def bucket_curve(fct_orders: DataFrame, where: Column | None = None) -> DataFrame:
    return fct_orders.where(_or(where) & F.col("review_score").isNotNull()).groupBy(
        "lateness_bucket").agg(
        F.count("*").alias("orders"),
        mean("review_score", 3).alias("avg_review_score"),
        _total("order_revenue", 0).alias("revenue"))


def penalty_matrix(fct_orders: DataFrame, states: Sequence[str]) -> DataFrame:
    """Chosen states against lateness, pivoted by value so a NULL never makes a column."""
    reviewed = fct_orders.where(F.expr(IN_SCOPE) & F.col("review_score").isNotNull()
                                & F.col("customer_state").isin(*states))
    cells = reviewed.groupBy("customer_state").pivot("is_late", [False, True]).agg(
        mean("review_score", 3))
    return cells.select(
        "customer_state", F.col("false").alias("on_time"), F.col("true").alias("late"),
        fixed(F.col("false") - F.col("true"), 2).alias("penalty"))


def penalty_by_state(fct_orders: DataFrame, where: Column, floor: int,
                     k: int = 10) -> DataFrame:
    return fct_orders.where(where & F.col("review_score").isNotNull()).groupBy(
        "customer_state").agg(
        mean_if(on_time(), "review_score", 4).alias("on_time"),
        mean_if("is_late", "review_score", 4).alias("late"),
        F.count("*").alias("orders"),
    ).where(F.col("orders") >= max(floor, 100)).orderBy(
        F.desc("orders"), "customer_state").limit(k).withColumn(
        "penalty", fixed(F.col("on_time") - F.col("late"), 4))


def revenue_exposure(fct_orders: DataFrame, where: Column | None = None) -> DataFrame:
    return fct_orders.where(_or(where)).groupBy("customer_region").agg(
        _total("order_revenue", 0).alias("total_revenue"),
        _total("late_order_revenue", 0).alias("late_revenue"),
        safe_ratio(F.sum("late_order_revenue"), F.sum("order_revenue"), 4)
        .alias("late_revenue_share"))


def promise_accuracy(fct_orders: DataFrame, where: Column | None = None) -> DataFrame:
    slack = F.col("promise_slack_days")
    scoped = fct_orders.where(_or(where, f"is_delivered and {KEPT}") & slack.isNotNull())
    one = scoped.agg(
        mean(slack, 2).alias("avg_slack_days"),
        tally(slack > 0).alias("delivered_early"),
        tally(slack < 0).alias("delivered_late"),
        F.count("*").alias("orders"))
    one = with_quantiles(one, scoped, [], {
        "median_promised_days": Quantile("promised_delivery_days", 50, 1),
        "median_actual_days": Quantile("total_delivery_days", 50, 1)})
    return one.withColumns({
        "promise_is": F.when(F.col("avg_slack_days") > 0, "padded").otherwise("optimistic"),
        "early_share": safe_ratio("delivered_early", "orders", 4)})


def delay_histogram(fct_orders: DataFrame, low: int = -60, high: int = 30,
                    where: Column | None = None) -> DataFrame:
    days = F.col("delay_vs_promise_days")
    return fct_orders.where(_or(where, "is_delivered") & days.between(low, high)).groupBy(
        "delay_vs_promise_days").agg(F.count("*").alias("orders")).withColumn(
        "outcome", F.when(days > 0, "late").otherwise("on time or early"))


# --- partition pruning -------------------------------------------------------
def state_days(fct_orders: DataFrame, first: date, last: date) -> DataFrame:
    return fct_orders.where(purchased_between(first, last)).groupBy("customer_state").agg(
        F.count("*").alias("orders"), mean("total_delivery_days", 3).alias("avg_days"))


def scan_facts(df: DataFrame) -> dict[str, list[str]]:
    """What reaches the file scan: partition filters, pushed filters, columns."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    facts: dict[str, list[str]] = {"PartitionFilters": [], "PushedFilters": [], "ReadSchema": []}
    for line in text.splitlines():
        name, _, value = line.partition(": ")
        if name in facts and value not in ("[]", ""):
            facts[name].append(value)
    return facts


# --- sales -------------------------------------------------------------------
def sales_totals(months: DataFrame) -> DataFrame:
    return months.agg(
        F.sum("revenue").cast(TOTAL).alias("total_revenue"),
        F.sum("order_count").alias("total_orders"),
        fixed(floored_ratio(F.sum("revenue"), F.sum("order_count")), 2)
        .alias("avg_order_value"))


def sales_extremes(months: DataFrame, k: int = 5, strongest: bool = True) -> DataFrame:
    order = F.desc("revenue") if strongest else F.asc("revenue")
    return months.orderBy(order, "month_start_date").limit(k).select(
        "year_month", "revenue", "order_count", "avg_order_value", "late_rate")


def customers_by_period(fct_orders: DataFrame) -> DataFrame:
    """Distinct customers with a kept order by month, by quarter and ever, all from the
    bitmaps of the months."""
    month = F.trunc("order_purchase_date", "month").alias("period")
    months = bitmaps.bitmaps(fct_orders.where(KEPT).select(month, "customer_key"), ["period"],
                             "customer_key", Scratch(fct_orders.sparkSession, "customers"))
    quarters = months.withColumn("period", F.trunc("period", "quarter"))
    kinds = {"month": months, "quarter": quarters,
             "ever": months.withColumn("period", F.lit(None).cast("date"))}
    return union_all(
        bitmaps.cardinality(bits, ["period"], "customers").select(
            F.lit(kind).alias("kind"), "period", "customers")
        for kind, bits in kinds.items())


def correlations(months: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise Pearson correlation in long form."""
    pairs = [(a, b) for a in columns for b in columns]
    one = months.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
                       .alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], one.columns, "pair", "r")
    name = F.split("pair", "\\|")
    return long.select(name[0].alias("metric_a"), name[1].alias("metric_b"),
                       F.round("r", 3).alias("correlation"))


# --- products ----------------------------------------------------------------
def top_categories(products: DataFrame, by: str, k: int = 15) -> DataFrame:
    return products.where("is_reportable").orderBy(F.desc(by), "product_category").limit(k).select(
        "product_category", "revenue", "units_sold", "order_count", "avg_item_price",
        "revenue_share", "revenue_rank", "volume_rank", "late_rate",
        "median_delivery_days", "avg_review_score", "is_high_value_poor_delivery")


def rank_gaps(products: DataFrame, k: int = 8) -> DataFrame:
    gap = F.abs(F.col("revenue_rank") - F.col("volume_rank"))
    return products.where("is_reportable").withColumn("rank_gap", gap).orderBy(
        F.desc("rank_gap"), "product_category").limit(k).select(
        "product_category", "revenue_rank", "volume_rank", "rank_gap", "revenue",
        "units_sold", "avg_item_price")


def poor_delivery(products: DataFrame) -> DataFrame:
    return products.where("is_reportable and is_high_value_poor_delivery").select(
        "product_category", "revenue", "revenue_rank", "units_sold", "late_rate",
        "median_delivery_days", "avg_review_score")


def median_late_rate(products: DataFrame) -> DataFrame:
    """Each category against the median late rate of all: the middle value, or the mean of
    the two middle ones.  One row per category comes in."""
    middle = products.agg(F.median("late_rate")).scalar()
    gap = F.col("late_rate") - F.col("median_late_rate")
    return products.select("product_category", "revenue", "late_rate").withColumn(
        "median_late_rate", fixed(middle, 6)).withColumn("above_median", gap > 0)


# --- people ------------------------------------------------------------------
def segment_summary(rfm: DataFrame) -> DataFrame:
    totals = rfm.groupBy("rfm_segment").agg(
        F.count("*").alias("customers"),
        mean("recency_days", 0).alias("avg_recency_days"),
        mean("frequency", 2).alias("avg_frequency"),
        mean("monetary", 2).alias("avg_monetary"),
        _total("monetary", 0).alias("total_revenue"),
        F.sum("monetary").alias("_money"),
        mean("late_rate", 4, "decimal(18,4)").alias("avg_late_rate"),
        mean("avg_review_score", 2).alias("avg_review_score"),
        tally("is_high_value_with_late_delivery").alias("high_value_served_late"))
    everyone = F.sum("_money").over(Window.partitionBy())  # one row per segment
    return totals.withColumn("revenue_share", safe_ratio("_money", everyone, 4)).drop("_money")


def frequency_distribution(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("frequency").agg(
        F.count("*").alias("customers"), _total("monetary", 0).alias("revenue"))


def repeat_share(rfm: DataFrame) -> DataFrame:
    return rfm.agg(F.count("*").alias("customers"),
                   tally(F.col("frequency") > 1).alias("repeat_customers"),
                   safe_ratio(tally(F.col("frequency") > 1), F.count("*"), 4)
                   .alias("repeat_share"))


def at_risk(rfm: DataFrame) -> DataFrame:
    exposed = F.when(F.col("is_high_value_with_late_delivery"), F.col("monetary"))
    return rfm.agg(
        tally("is_high_value_with_late_delivery").alias("at_risk_customers"),
        F.round(F.sum(exposed), 0).cast(TOTAL).alias("at_risk_revenue"),
        _total("monetary", 0).alias("total_revenue"),
        safe_ratio(F.sum(exposed), F.sum("monetary"), 4).alias("at_risk_share"))


# --- calendar ----------------------------------------------------------------
def orders_by_day(fct_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Orders of every calendar day with the fields of the day; days without orders stay."""
    placed = fct_orders.groupBy(F.col("order_purchase_date").alias("date_key")).agg(
        F.count("*").alias("orders_placed"),
        F.count_if(F.expr(KEPT)).alias("orders_kept"),
        money("order_revenue").alias("revenue"))
    return dim_date.join(placed, "date_key", "left").fillna(
        0, ["orders_placed", "orders_kept"])


# --- reconciliation ----------------------------------------------------------
def reconciliation(stg_order_items: DataFrame, stg_orders: DataFrame,
                   fct_order_items: DataFrame, fct_orders: DataFrame,
                   dim_customer: DataFrame, rfm: DataFrame) -> DataFrame:
    """Independent totals side by side.

    The segmentation is compared with people who have a kept order, since people with
    only excluded orders are in the dimension but are not scored.
    """
    kept_people = fct_orders.where("not is_excluded_from_kpis").agg(
        F.count_distinct("customer_key"))
    facts = fct_orders.agg(F.sum("order_revenue").cast(TOTAL).alias("fact_order_revenue"),
                           F.count("*").alias("fact_order_rows"))
    one = facts.select(
        stg_order_items.agg(money("item_price")).scalar().alias("staging_revenue"),
        fct_order_items.agg(money("item_price")).scalar().alias("fact_item_revenue"),
        "fact_order_revenue",
        stg_orders.agg(F.count_distinct("order_id")).scalar().alias("staging_orders"),
        "fact_order_rows",
        dim_customer.agg(F.count("*")).scalar().alias("dim_customers"),
        kept_people.scalar().alias("people_with_kept_orders"),
        rfm.agg(F.count("*")).scalar().alias("rfm_rows"))
    same = lambda a, b: F.col(a) == F.col(b)
    return one.withColumns({
        "revenue_ok": same("staging_revenue", "fact_item_revenue")
        & same("staging_revenue", "fact_order_revenue"),
        "orders_ok": same("staging_orders", "fact_order_rows"),
        "people_ok": same("people_with_kept_orders", "rfm_rows")})


def metric_agreement(monthly: DataFrame, fct_orders: DataFrame, params: Params,
                     tolerance: float = 1e-4) -> DataFrame:
    """Late rate by two paths.  The monthly model divides by all delivered orders, the
    recomputation by those with a known delay, hence a tolerance."""
    model = monthly.where("is_in_analysis_window").agg(
        safe_ratio(F.sum("late_orders"), F.sum("orders_delivered"), 6).alias("model_rate"))
    again = fct_orders.where(scope(params.window_start, params.window_end)).agg(
        safe_ratio(tally("is_late"), F.count("*"), 6))
    return model.withColumn("recomputed_rate", again.scalar()).withColumn(
        "agrees", F.abs(F.col("model_rate") - F.col("recomputed_rate")) < tolerance)
