"""Aggregate models over the facts.

Group keys here (routes, months, categories) are few and may be very uneven, so only
functions with a map-side combine and a small state are used on fact rows.  Windows
without partitions appear only after aggregation, over one row per month or category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.bands import rfm_segment
from ..functions.dates import month_of
from ..functions.numbers import fixed, mean, mean_if, safe_ratio, tally
from ..operators.heavy import join_unique, reduced
from ..operators.quantiles import Quantile, with_quantiles
from ..operators.tiles import tile_boundaries, tile_of
from ..params import Params
from ..sources.scratch import Scratch

ROUTE = ["delivery_route", "seller_state", "seller_region", "customer_state",
         "customer_region", "is_intra_state_route"]
MONTH = ["year_month", "month_label", "month_start_date", "is_in_analysis_window"]
TOTAL = "decimal(28,9)"

KEPT = "not is_excluded_from_kpis"
# The headline scope: delivered, kept, and with a known delay.
IN_SCOPE = f"is_delivered and {KEPT} and delay_vs_promise_days is not null"


def on_time():
    """NULL for orders without a known delay, so they count on neither side."""
    return ~F.col("is_late")


def money(name: str):
    return F.sum(name).cast(TOTAL)


def _review_metrics():
    return [
        mean("review_score", 3).alias("avg_review_score"),
        mean_if("is_late", "review_score", 3).alias("avg_review_score_when_late"),
        mean_if(on_time(), "review_score", 3).alias("avg_review_score_when_on_time"),
    ]


def _penalty(places: int = 3):
    """Difference of the averages as published, that is after rounding."""
    gap = F.col("avg_review_score_when_on_time") - F.col("avg_review_score_when_late")
    return fixed(gap, places).alias("review_score_penalty_when_late")


def _stage_quantiles(measured: str = "{}") -> dict[str, Quantile]:
    """Quantiles of the stages, over the rows that `measured` lets through; a promise is known
    for every order."""
    total = measured.format("total_delivery_days")
    return {
        "median_delivery_days": Quantile(total, 50, 2),
        "p90_delivery_days": Quantile(total, 90, 2),
        "median_approval_days": Quantile(measured.format("approval_days"), 50, 2),
        "median_handover_days": Quantile(measured.format("seller_handover_days"), 50, 2),
        "median_transit_days": Quantile(measured.format("carrier_transit_days"), 50, 2),
        "median_promised_days": Quantile("promised_delivery_days", 50, 2)}


def delivery_by_route(fct_orders: DataFrame, params: Params) -> DataFrame:
    """WHERE deliveries are late."""
    late_money, all_money = F.sum("late_order_revenue"), F.sum("order_revenue")
    scoped = fct_orders.where(IN_SCOPE)
    by_route = scoped.groupBy(*ROUTE).agg(
        F.count("*").alias("delivered_orders"),
        all_money.cast(TOTAL).alias("delivered_revenue"),
        tally("is_late").alias("late_orders"),
        safe_ratio(tally("is_late"), F.count("*"), 4).alias("late_rate"),
        late_money.cast(TOTAL).alias("late_revenue"),
        safe_ratio(late_money, all_money, 4).alias("late_revenue_share"),
        mean("total_delivery_days", 2).alias("avg_delivery_days"),
        *_review_metrics(),
        mean("freight_share_of_order", 4, "decimal(18,4)").alias("avg_freight_share"),
    )
    by_route = with_quantiles(by_route, scoped, ROUTE, {
        **_stage_quantiles(),
        "median_delay_vs_promise_days": Quantile("delay_vs_promise_days", 50, 2)})
    return by_route.select(
        "*", _penalty(),
        (F.col("delivered_orders") >= params.min_orders).alias("is_reportable"))


def delivery_monthly(fct_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """WHEN deliveries are late, by purchase month.

    Orders outside the calendar stay, in a group without a month.
    """
    calendar = dim_date.select(F.col("date_key").alias("order_purchase_date"), *MONTH)
    dated = fct_orders.where(KEPT).join(calendar, "order_purchase_date", "left")
    monthly = dated.groupBy(*MONTH).agg(
        F.count("*").alias("orders_placed"),
        tally("is_delivered").alias("orders_delivered"),
        money("order_revenue").alias("revenue"),
        money("order_freight").alias("freight"),
        tally("is_late").alias("late_orders"),
        safe_ratio(tally("is_late"), tally("is_delivered"), 4).alias("late_rate"),
        money("late_order_revenue").alias("late_revenue"),
        mean("promise_slack_days", 2).alias("avg_promise_slack_days"),
        *_review_metrics(),
    )
    monthly = with_quantiles(monthly, dated, MONTH, _stage_quantiles(
        "case when is_delivered then {} end"))
    before = F.lag("late_rate").over(Window.orderBy("month_start_date"))
    return monthly.select(
        "*", _penalty(), fixed(F.col("late_rate") - before, 4).alias("late_rate_mom_change"))


def monthly_sales(fct_order_items: DataFrame, fct_orders: DataFrame,
                  agg_delivery_monthly: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Items and orders are each reduced to months at their own grain, then joined.

    Each pass counts one kind of distinct key, so no line is expanded, and carries nothing
    else, so that what is shuffled per month and key is the key alone."""
    month = month_of("order_purchase_date").alias("month_start_date")
    sold = fct_order_items.where(KEPT).groupBy(month).agg(
        money("item_price").alias("revenue"),
        money("freight_value").alias("freight"),
        money("item_gross_value").alias("gross_value"),
        F.count("*").alias("items_sold"),
    )
    products = fct_order_items.where(KEPT).groupBy(month).agg(
        F.count_distinct("product_key").alias("distinct_products_sold"))
    sellers = fct_order_items.where(KEPT).groupBy(month).agg(
        F.count_distinct("seller_key").alias("active_sellers"))
    placed = fct_orders.where(KEPT).groupBy(month).agg(
        F.count("*").alias("order_count"))
    customers = fct_orders.where(KEPT).groupBy(month).agg(
        F.count_distinct("customer_key").alias("active_customers"))
    service = agg_delivery_monthly.select("month_start_date", "late_rate",
                                          "median_delivery_days", "avg_review_score")
    months = dim_date.select(*MONTH).distinct()
    combined = (
        months.join(sold, "month_start_date")
        .join(products, "month_start_date", "left")
        .join(sellers, "month_start_date", "left")
        .join(placed, "month_start_date", "left")
        .join(customers, "month_start_date", "left")
        .join(service, "month_start_date", "left")
    )
    before = F.lag("revenue").over(Window.orderBy("month_start_date"))
    return combined.select(
        *MONTH, "revenue", "freight", "gross_value", "items_sold", "distinct_products_sold",
        "active_sellers", "order_count", "active_customers", "late_rate",
        "median_delivery_days", "avg_review_score",
        safe_ratio("revenue", "order_count", 2).alias("avg_order_value"),
        safe_ratio("items_sold", "order_count", 3).alias("avg_items_per_order"),
        safe_ratio("freight", "gross_value", 4).alias("freight_share_of_gross"),
        fixed(safe_ratio("revenue", before) - 1, 4).alias("revenue_mom_growth"),
    )


def with_category(lines: DataFrame, category_of: DataFrame) -> DataFrame:
    """Distinct rows of the lines, with the category of their product.

    The products grow with the lines, so they are not sent to every task: lines move once, by
    product, are reduced there and meet the products there.  Those of a product with more than
    an even share of a task's rows are reduced before they move, and then spread."""
    return reduced(lines, "product_key",
                   lambda rows: rows.distinct().join(category_of, "product_key", "left"),
                   lambda rows: join_unique(rows.distinct(), category_of, "product_key"))


def categories_bought(items: DataFrame, category_of: DataFrame) -> DataFrame:
    """Distinct (order, category, customer); lines of one product meet the products once."""
    pairs = items.select("order_id", "product_key", "customer_key")
    return with_category(pairs, category_of).select(
        "order_id", "product_category", "customer_key").distinct()


def product_performance(fct_order_items: DataFrame, dim_product: DataFrame,
                        fct_orders: DataFrame, params: Params) -> DataFrame:
    """Sales per category from item lines; delivery from distinct (order, category) pairs,
    so an order with two categories counts once in each.

    Lines are reduced before they meet the products, and each distinct count has its own
    pass, so no line is expanded: sums per product, pairs of product and seller, and
    triples of order, category and customer (an order has one customer).
    """
    items = fct_order_items.where(KEPT)
    category_of = dim_product.select("product_key", "product_category")
    per_product = items.groupBy("product_key").agg(
        F.sum("item_price").alias("_price"), F.sum("freight_value").alias("_freight"),
        F.count("*").alias("_units"), F.count("item_price").alias("_priced"))
    price, freight = F.sum("_price"), F.sum("_freight")
    sales = per_product.join(category_of, "product_key", "left").groupBy(
        "product_category").agg(
        price.cast(TOTAL).alias("revenue"),
        freight.cast(TOTAL).alias("freight"),
        F.sum("_units").alias("units_sold"),
        F.count("product_key").alias("distinct_products"),
        safe_ratio(price, F.sum("_priced"), 2).alias("avg_item_price"),
        safe_ratio(freight, price + freight, 4).alias("freight_share_of_gross"),
    )
    sellers = with_category(items.select("product_key", "seller_key"), category_of).groupBy(
        "product_category").agg(F.count_distinct("seller_key").alias("distinct_sellers"))
    scratch = Scratch(fct_orders.sparkSession, "shipped")
    bought = scratch.save(categories_bought(items, category_of), "bought")
    buyers = bought.groupBy("product_category").agg(
        F.count("order_id").alias("order_count"),
        F.count_distinct("customer_key").alias("distinct_customers"))
    for counts in (sellers, buyers):  # one row per category; items without a product included
        other = counts.withColumnRenamed("product_category", "_category")
        sales = sales.join(other, F.col("product_category").eqNullSafe(F.col("_category")),
                           "left").drop("_category")
    scored = fct_orders.where("is_delivered and delay_vs_promise_days is not null").select(
        "order_id", "is_late", "total_delivery_days", "review_score")
    shipped = scratch.save(bought.join(scored, "order_id"), "shipped")
    service = shipped.groupBy("product_category").agg(
        F.count("*").alias("delivered_orders"),
        tally("is_late").alias("late_orders"),
        safe_ratio(tally("is_late"), F.count("*"), 4).alias("late_rate"),
        *_review_metrics(),
    )
    service = with_quantiles(service, shipped, ["product_category"], {
        "median_delivery_days": Quantile("total_delivery_days", 50, 2),
        "p90_delivery_days": Quantile("total_delivery_days", 90, 2)})

    # One row per category from here on.  The threshold is the plain average of their rates.
    everything = Window.partitionBy()
    rates = F.col("late_rate").cast("decimal(18,4)")
    service = service.withColumn("_typical", safe_ratio(
        F.sum(rates).over(everything), F.count(rates).over(everything)))
    combined = sales.join(service, "product_category", "left").select("*", _penalty())
    by_revenue = F.dense_rank().over(Window.orderBy(F.desc("revenue")))
    return combined.select(
        "*",
        safe_ratio("revenue", F.sum("revenue").over(everything), 4).alias("revenue_share"),
        by_revenue.cast("bigint").alias("revenue_rank"),
        F.dense_rank().over(Window.orderBy(F.desc("units_sold"))).cast("bigint")
        .alias("volume_rank"),
        ((by_revenue <= params.top_categories) & (F.col("late_rate") > F.col("_typical")))
        .alias("is_high_value_poor_delivery"),
        (F.col("order_count") >= params.min_orders).alias("is_reportable"),
    ).drop("_typical")


def person_activity(fct_orders: DataFrame, params: Params) -> DataFrame:
    """Recency, frequency, monetary value and delivery experience per person."""
    return fct_orders.where(f"{KEPT} and customer_key is not null").groupBy(
        "customer_key").agg(
        F.datediff(F.lit(params.as_of), F.max("order_purchase_date")).cast("bigint")
        .alias("recency_days"),
        F.count("*").alias("frequency"),
        money("order_revenue").alias("monetary"),
        F.min("order_purchase_date").alias("first_order_date"),
        F.max("order_purchase_date").alias("latest_order_date"),
        mean("order_revenue", 2, TOTAL).alias("avg_order_value"),
        F.sum("order_item_count").alias("total_items_purchased"),
        tally("is_delivered").alias("delivered_orders"),
        tally("is_late").alias("late_orders"),
        safe_ratio(tally("is_late"), tally("is_delivered"), 4).alias("late_rate"),
        money("late_order_revenue").alias("revenue_delivered_late"),
        mean("total_delivery_days", 2).alias("avg_delivery_days"),
        mean("review_score", 3).alias("avg_review_score"),
    )


RFM_ORDERINGS = {"r": ["recency_days"], "f": ["frequency", "monetary"], "m": ["monetary"]}


def customer_rfm(fct_orders: DataFrame, params: Params, scratch: Scratch) -> DataFrame:
    """Scores and segment per person.  Equal values are ordered by person, so the tiles
    are reproducible."""
    people = scratch.save(person_activity(fct_orders, params), "person_activity")
    ends = tile_boundaries(people, RFM_ORDERINGS, "customer_key", params.tiles, scratch)
    tile = {k: tile_of([*cols, "customer_key"], ends[k]) for k, cols in RFM_ORDERINGS.items()}
    r, f, m = (F.col(c) for c in ("r_score", "f_score", "m_score"))
    scored = people.withColumns({
        "r_score": params.tiles + 1 - tile["r"], "f_score": tile["f"], "m_score": tile["m"]})
    return scored.select(
        "customer_key", "recency_days", "frequency", "monetary", "avg_order_value",
        "total_items_purchased", "first_order_date", "latest_order_date",
        "r_score", "f_score", "m_score",
        F.concat(*[c.cast("string") for c in (r, f, m)]).alias("rfm_cell"),
        (r + f + m).alias("rfm_total"),
        rfm_segment(r, f, m).alias("rfm_segment"),
        "delivered_orders", "late_orders", "late_rate", "revenue_delivered_late",
        "avg_delivery_days", "avg_review_score",
        ((m >= 4) & (F.col("late_orders") > 0)).alias("is_high_value_with_late_delivery"),
    )
