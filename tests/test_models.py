"""The edge rows through staging, grain control, facts and aggregates."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows_by
from pyspark.sql import functions as F

from parcelwise.operators import grain, staging
from parcelwise.plans import aggregates as agg
from parcelwise.sources.layout import schema_of


def test_staging_normalises_before_it_flags(shop):
    o = rows_by(shop["stg_orders"], "order_id")
    assert o["o4"].order_status == "canceled" and o["o4"].is_excluded_from_kpis
    assert o["o1"].is_delivered and not o["o6"].is_delivered


def test_regions_and_categories(shop):
    c = rows_by(shop["stg_customers"], "customer_id")
    assert (c["c1"].customer_state, c["c1"].customer_region) == ("SP", "Sudeste")
    assert c["c1"].customer_city == "São Paulo"
    assert c["c4"].customer_region == c["c5"].customer_region == "Unknown"
    p = rows_by(shop["stg_products"], "product_key")
    assert p["p1"].product_category == p["p4"].product_category == "health_beauty"
    assert p["p2"].product_category == p["p3"].product_category == "unknown"
    assert p["p1"].product_volume_cm3 == 24 and p["p2"].product_volume_cm3 is None


def test_geolocation_median_and_mode(shop):
    g = rows_by(shop["stg_geolocation"], "zip_code_prefix")
    assert set(g) == {100, 200}
    assert (g[100].latitude, g[100].longitude) == (-23.4, -46.5)
    assert (g[100].geolocation_city, g[100].geolocation_point_count) == ("Sao Paulo", 3)


def test_payments_collapse(shop):
    p = rows_by(shop["int_order_payments"], "order_id")["o1"]
    assert p.order_payment_total == Decimal("23.00")
    assert p.primary_payment_type == "boleto"  # equal values: first by name
    assert p.payment_type_mix == "boleto + voucher"
    assert (p.payment_record_count, p.voucher_payment_count) == (2, 1)
    assert p.max_payment_installments == 3


def test_latest_review(shop):
    r = rows_by(shop["int_order_reviews"], "order_id")["o1"]
    assert (r.review_id, r.review_score, r.has_comment) == ("r1", 3, False)
    assert r.source_review_count == 3  # the exact copy is gone


def test_items_collapse(shop):
    i = rows_by(shop["int_order_items_rollup"], "order_id")["o1"]
    assert i.primary_seller_key == "s1"  # s1 and s2 both sold 10
    assert (i.order_item_count, i.order_product_count, i.order_seller_count) == (3, 2, 2)
    assert i.is_multi_seller_order and i.order_revenue == Decimal("20.00")
    assert i.order_shipping_limit_at == datetime(2018, 1, 13)


def test_items_collapse_with_missing_keys(spark):
    rows = [("o", 1, None, "s", None, Decimal(1), Decimal(0)),
            ("o", 2, None, None, None, Decimal(5), Decimal(0))]
    items = staging.order_items(spark.createDataFrame(rows, schema_of("order_items")))
    r = grain.items_per_order(items).first()
    assert (r.order_product_count, r.order_seller_count, r.primary_seller_key) == (0, 1, None)


def test_delivery_measures(shop):
    d = rows_by(shop["int_order_delivery"], "order_id")
    assert d["o1"].delay_vs_promise_days == 0 and d["o1"].is_late is False
    assert d["o1"].lateness_bucket.startswith("3.") and d["o1"].approval_days == 0.042
    assert d["o2"].is_late is True and d["o2"].seller_handover_days == -1.0
    assert d["o3"].is_late is None and d["o3"].lateness_bucket == "Not delivered"
    assert d["o2"].promise_slack_days == round(10 - 10.625, 3)


def test_one_row_per_person(shop):
    c = rows_by(shop["dim_customer"], "customer_key")
    assert len(c) == 5
    # Both orders of anna are of one day: the smaller per-order id decides.
    assert (c["anna"].customer_state, c["anna"].source_customer_id_count) == ("SP", 2)
    assert c["anna"].is_repeat_customer and not c["bela"].is_repeat_customer
    assert c["carl"].customer_state == "PE" and c["carl"].first_order_date == date(2018, 3, 1)


def test_fct_orders(shop, raw):
    f = rows_by(shop["fct_orders"], "order_id")
    assert len(f) == raw["orders"].count()
    assert len(shop["fct_orders"].columns) == 54  # 53 and the month partition
    assert f["o1"].order_revenue == Decimal("20.00") and f["o1"].delivery_route == "SP -> SP"
    assert f["o1"].is_intra_state_route and f["o1"].freight_share_of_order == 0.1304
    assert f["o6"].order_revenue is None and f["o6"].delivery_route == "?? -> PE"
    assert f["o7"].delivery_route == "?? -> SP"  # its seller is not in the dimension
    assert f["o2"].late_order_revenue == Decimal("100.00")
    assert f["o1"].late_order_revenue is None and f["o3"].late_order_revenue is None


def test_item_and_payment_facts(shop):
    i = rows_by(shop["fct_order_items"], "order_item_key")
    assert i["o1-2"].customer_key == "anna" and i["o1-2"].order_date_key == date(2018, 1, 10)
    assert "is_late" not in shop["fct_order_items"].columns
    p = rows_by(shop["fct_payments"], "payment_key")
    assert p["o1-1"].payment_type == "voucher" and p["o1-1"].order_status == "delivered"


def test_calendar(shop):
    d = shop["dim_date"]
    assert d.count() == 1096
    first = rows_by(d, "date_key")[date(2017, 1, 1)]
    assert (first.week_of_year, first.day_of_week, first.is_weekend) == (1, 1, True)
    assert (first.month_label, first.day_name) == ("Jan 2017", "Sunday")
    assert not rows_by(d, "date_key")[date(2018, 11, 1)].is_in_analysis_window


def test_route_and_month_denominators_differ(shop):
    routes = rows_by(shop["agg_delivery_by_route"], "delivery_route")
    assert sum(r.delivered_orders for r in routes.values()) == 4  # o3 has no known delay
    assert routes["SP -> SP"].delivered_orders == 2 and routes["SP -> SP"].is_reportable
    assert routes["SP -> SP"].review_score_penalty_when_late == 2.0
    months = rows_by(shop["agg_delivery_monthly"], "year_month")
    assert months["2018-02"].orders_delivered == 1 and months["2018-02"].late_rate == 0.0
    assert months[None].orders_placed == 1  # outside the calendar, kept
    assert months["2018-03"].orders_placed == 2 and months["2018-03"].orders_delivered == 1


def test_monthly_sales_drops_months_outside_the_calendar(shop):
    s = rows_by(shop["agg_monthly_sales"], "year_month")
    assert set(s) == {"2018-01", "2018-02", "2018-03"}
    assert s["2018-01"].revenue == Decimal("120.00") and s["2018-01"].items_sold == 4
    assert s["2018-01"].revenue_mom_growth is None
    assert s["2018-02"].revenue_mom_growth == round(7 / 120 - 1, 4)


def test_growth_after_a_month_without_revenue_is_null(spark, shop):
    items = shop["fct_order_items"].withColumn(
        "item_price", F.when(F.col("order_id").isin("o1", "o2"), 0)
        .otherwise(F.col("item_price")).cast("decimal(12,2)"))
    s = rows_by(agg.monthly_sales(items, shop["fct_orders"], shop["agg_delivery_monthly"],
                                  shop["dim_date"]), "year_month")
    assert s["2018-01"].revenue == 0 and s["2018-02"].revenue_mom_growth is None


def test_category_counts_an_order_once_per_category(shop):
    p = rows_by(shop["agg_product_performance"], "product_category")
    assert p["health_beauty"].delivered_orders == 2  # o1, o5
    assert p["unknown"].delivered_orders == 2  # o1, o2
    assert p["unknown"].order_count == 3 and p[None].delivered_orders is None
    assert {p[c].revenue_rank for c in p} == {1, 2, 3}
    # The rates are 0, 0.5 and, for the lines without a product, 1: 0.5 is not above average.
    assert p["unknown"].late_rate == 0.5 and not p["unknown"].is_high_value_poor_delivery


def test_rfm_leaves_out_people_with_only_excluded_orders(shop):
    r = rows_by(shop["agg_customer_rfm"], "customer_key")
    assert set(r) == {"anna", "bela", "carl", "dora"}
    assert r["anna"].frequency == 2 and r["anna"].monetary == Decimal("120.00")
    assert sorted(x.m_score for x in r.values()) == [1, 2, 3, 4]
    assert r["anna"].m_score == 4 and r["anna"].is_high_value_with_late_delivery


def test_reportable_floor_is_inclusive(spark, shop):
    many = shop["fct_orders"].where("order_id = 'o1'").crossJoin(spark.range(30)).drop("id")
    from parcelwise.params import Params
    at = agg.delivery_by_route(many, Params()).first()
    below = agg.delivery_by_route(many.limit(29), Params()).first()
    assert at.is_reportable and not below.is_reportable


@pytest.mark.parametrize("table, key", [
    ("int_order_payments", "order_id"), ("int_order_reviews", "order_id"),
    ("int_order_items_rollup", "order_id"), ("int_order_delivery", "order_id"),
    ("dim_customer", "customer_key"), ("fct_orders", "order_key"),
])
def test_grain(shop, table, key):
    assert shop[table].groupBy(key).count().where("count > 1").count() == 0
