"""DuckDB statements that recompute every registered query from the same tables.

Named fragments are assembled into one WITH statement per query.  They are written
independently of the Spark plans: window functions instead of ordering structs, ordered-set
quantiles instead of histograms, ``ntile`` instead of tile boundaries.
"""

from __future__ import annotations

import re

from parcelwise.params import (
    LATENESS_BUCKETS, NOT_DELIVERED, SEGMENTS, UNKNOWN_REGION, UNKNOWN_WEIGHT, WEIGHT_BANDS,
)
from parcelwise.quality.suites import FILE_RULES, MODEL_RULES, THRESHOLD_RULES
from parcelwise.sources.layout import TABLES, types_of
from parcelwise.sources.star_schema import STAR_PARAMS as P


def fx(expr: str, k: int) -> str:
    return f"round(cast({expr} as decimal(28,8)), {k})::double"


def ra(num: str, den: str, k: int | None = None) -> str:
    value = f"({num})::double / nullif(({den})::double, 0)"
    return fx(value, k) if k is not None else f"({value})"


def av(x: str, k: int | None = None, unit: str = "decimal(18,3)") -> str:
    return ra(f"sum(({x})::{unit})", f"count({x})", k)


def avif(cond: str, x: str, k: int) -> str:
    return av(f"case when {cond} then {x} end", k)


def n(cond: str) -> str:
    return f"count(*) filter ({cond})"


def q(x: str, p: float, k: int) -> str:
    return fx(f"quantile_disc({x}, {p})", k)


def hours(a: str, b: str) -> str:
    return fx(f"date_sub('hour', {a}, {b}) / 24.0::double", 3)


def days(a: str, b: str) -> str:
    return f"date_diff('day', ({a})::date, ({b})::date)"


def case(x: str, bands, op: str, null_label: str) -> str:
    arms = " ".join(f"when {x} {op} {b} then '{t}'" for b, t in bands if b is not None)
    return f"case when {x} is null then '{null_label}' {arms} else '{bands[-1][1]}' end"


def title(x: str) -> str:
    breaks = r"\s\[\](){}/|\\<>!?@\"^#$&~_,.:;*%+\-"
    parts = f"regexp_extract_all(trim({x}), '[^{breaks}]+|[{breaks}]+')"
    return (f"array_to_string(list_transform({parts}, "
            "lambda p: upper(p[1]) || lower(p[2:])), '')")


MONTH = "year_month, month_label, month_start_date, is_in_analysis_window"
KEPT = "not is_excluded_from_kpis"
SCOPE = f"is_delivered and {KEPT} and delay_vs_promise_days is not null"
WINDOW = f"order_purchase_date between date '{P.window_start}' and date '{P.window_end}'"
REVIEWS = f"""{av('review_score', 3)} as avg_review_score,
    {avif('is_late', 'review_score', 3)} as avg_review_score_when_late,
    {avif('not is_late', 'review_score', 3)} as avg_review_score_when_on_time"""
PENALTY = fx("avg_review_score_when_on_time - avg_review_score_when_late", 3) + \
    " as review_score_penalty_when_late"

FRAGMENTS = {
    # ---- raw ---------------------------------------------------------------
    "r_orders": """
    select o_orderkey as order_id, o_orderkey as customer_id,
      case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'canceled' end
        as order_status,
      o_orderdate as order_purchase_timestamp,
      o_orderdate + to_hours(o_orderkey % 72) + to_minutes(o_orderkey % 60)
        as order_approved_at,
      o_orderdate + to_hours(24 + (o_orderkey * 7) % 168) + to_minutes((o_orderkey * 11) % 60)
        as order_delivered_carrier_date,
      case when o_orderstatus = 'F' and o_orderkey % 97 <> 0 then
        o_orderdate
        + to_days(((date_diff('day', o_orderdate::date, last_ship::date) % 45 + 45) % 45)::int)
        + to_hours(o_orderkey % 24) + to_minutes((o_orderkey * 17) % 60) end
        as order_delivered_customer_date,
      o_orderdate + to_days(7 * left(o_orderpriority, 1)::int) as order_estimated_delivery_date
    from orders left join
      (select l_orderkey, max(l_shipdate) as last_ship from lineitem group by 1)
      on l_orderkey = o_orderkey""",
    "r_order_items": """
    select l_orderkey as order_id, l_linenumber::bigint as order_item_id,
      l_partkey as product_id, l_suppkey as seller_id, l_shipdate as shipping_limit_date,
      l_extendedprice::decimal(12,2) as price,
      (l_extendedprice::decimal(12,2) * l_tax::decimal(4,2))::decimal(12,2) as freight_value
    from lineitem""",
    "r_order_payments": """
    select l_orderkey as order_id, l_linenumber::bigint as payment_sequential,
      case l_returnflag when 'A' then 'credit_card' when 'N' then 'boleto' else 'voucher' end
        as payment_type,
      l_quantity::bigint as payment_installments,
      (l_extendedprice::decimal(12,2) * case when l_discount < 0.05
        then 1 + l_tax::decimal(4,2) else 1 end)::decimal(12,2) as payment_value
    from lineitem""",
    "r_order_reviews": """
    select event_id as review_id,
      event_id % (select count(*) // 2 from orders) as order_id,
      event_id % 5 + 1 as review_score, event_type as review_comment_title,
      case when event_type <> 'view' then props end as review_comment_message,
      ts as review_creation_date, ts + to_hours(event_id % 72) as review_answer_timestamp
    from events""",
    "r_customers": """
    select o_orderkey as customer_id, o_custkey as customer_unique_id,
      c_custkey as customer_zip_code_prefix, c_mktsegment as customer_city,
      n_name as customer_state
    from orders left join customer on o_custkey = c_custkey
    left join nation on n_nationkey = (c_nationkey + o_orderkey % 2) % 25""",
    "r_products": """
    select p_partkey as product_id, p_type as product_category_name,
      length(p_name) as product_name_lenght, length(p_brand) as product_description_lenght,
      p_partkey % 6 as product_photos_qty,
      case when p_partkey % 101 <> 0 then p_size * 250 end::bigint as product_weight_g,
      p_size::bigint as product_length_cm, (p_size % 7 + 1)::bigint as product_height_cm,
      (p_size % 11 + 1)::bigint as product_width_cm
    from part""",
    "r_sellers": """
    select s_suppkey as seller_id, s_suppkey as seller_zip_code_prefix,
      'city of ' || lower(n_name) as seller_city, n_name as seller_state
    from supplier left join nation on s_nationkey = n_nationkey""",
    "r_geolocation": """
    select user_id as geolocation_zip_code_prefix, value as geolocation_lat,
      -value / 4 as geolocation_lng, event_type as geolocation_city,
      left(event_type, 2) as geolocation_state
    from events""",
    "r_product_category_translation": """
    select distinct ' ' || lower(p_type) as product_category_name,
      p_type || ' goods ' as product_category_name_english
    from part""",
    "regions": """
    select n_name as state, r_name as region from nation join region on n_regionkey = r_regionkey""",
    # ---- staging -----------------------------------------------------------
    "s_orders": f"""
    select order_id, customer_id, order_status,
      order_purchase_timestamp as order_purchased_at, order_approved_at,
      order_delivered_carrier_date as order_handed_to_carrier_at,
      order_delivered_customer_date as order_delivered_at,
      order_estimated_delivery_date as order_promised_at,
      order_purchase_timestamp::date as order_purchase_date,
      order_delivered_customer_date::date as order_delivered_date,
      order_estimated_delivery_date::date as order_promised_date,
      order_status = '{P.delivered_status}' as is_delivered,
      order_status in {P.excluded_statuses} as is_excluded_from_kpis
    from r_orders""",
    "s_order_items": """
    select order_id || '-' || order_item_id as order_item_key, order_id, order_item_id,
      product_id as product_key, seller_id as seller_key,
      shipping_limit_date as shipping_limit_at, price as item_price, freight_value,
      price + freight_value as item_gross_value
    from r_order_items""",
    "s_order_payments": """
    select order_id || '-' || payment_sequential as payment_key, order_id,
      payment_sequential, payment_type, payment_installments, payment_value
    from r_order_payments""",
    "s_order_reviews": """
    select distinct review_id, order_id, review_score, review_comment_title as review_title,
      review_comment_message as review_message, review_creation_date as review_created_at,
      review_answer_timestamp as review_answered_at,
      length(trim(coalesce(review_comment_message, ''))) > 0 as has_comment
    from r_order_reviews""",
    "s_customers": f"""
    select customer_id, customer_unique_id as customer_key, customer_zip_code_prefix,
      {title('customer_city')} as customer_city, customer_state,
      coalesce(region, '{UNKNOWN_REGION}') as customer_region
    from r_customers left join regions on customer_state = state""",
    "s_sellers": f"""
    select seller_id as seller_key, seller_zip_code_prefix,
      'City Of ' || {title("substr(seller_city, 9)")} as seller_city, seller_state,
      coalesce(region, '{UNKNOWN_REGION}') as seller_region
    from r_sellers left join regions on seller_state = state""",
    "s_products": """
    select p.product_id as product_key, lower(p.product_category_name) as product_category_pt,
      coalesce(lower(trim(t.product_category_name_english)), 'unknown') as product_category,
      product_name_lenght as product_name_length,
      product_description_lenght as product_description_length,
      product_photos_qty as product_photo_count, product_weight_g, product_length_cm,
      product_height_cm, product_width_cm,
      product_length_cm * product_height_cm * product_width_cm as product_volume_cm3
    from r_products p left join r_product_category_translation t
      on lower(trim(p.product_category_name)) = lower(trim(t.product_category_name))""",
    "s_geolocation": f"""
    with mid as (
      select geolocation_zip_code_prefix as zip, quantile_disc(geolocation_lat, 0.5) as lat,
        quantile_disc(geolocation_lng, 0.5) as lng, count(*) as points
      from r_geolocation group by 1),
    place as (
      select geolocation_zip_code_prefix as zip, {title('geolocation_city')} as city,
        upper(geolocation_state) as st, row_number() over (
          partition by geolocation_zip_code_prefix
          order by count(*) desc, {title('geolocation_city')}, upper(geolocation_state)) as rn
      from r_geolocation group by 1, 2, 3, geolocation_city, geolocation_state)
    select zip as zip_code_prefix, lat as latitude, lng as longitude,
      points as geolocation_point_count, city as geolocation_city, st as geolocation_state
    from mid left join (select * from place where rn = 1) using (zip)""",
    # ---- one row per order -------------------------------------------------
    "i_payments": """
    select order_id, count(*) as payment_record_count,
      sum(payment_value) as order_payment_total,
      max(payment_installments) as max_payment_installments,
      first(payment_type order by payment_value desc nulls last, payment_type)
        as primary_payment_type,
      string_agg(distinct payment_type, ' + ' order by payment_type) as payment_type_mix,
      count(*) filter (payment_type = 'voucher') as voucher_payment_count
    from s_order_payments group by 1""",
    "i_reviews": """
    select order_id, review_id, review_score, review_created_at, review_answered_at,
      has_comment, source_review_count
    from (select *, count(*) over (partition by order_id) as source_review_count,
            row_number() over (partition by order_id
              order by review_created_at desc nulls last, review_id) as rn
          from s_order_reviews)
    where rn = 1""",
    "i_items": """
    with lead as (
      select order_id, seller_key, row_number() over (
        partition by order_id order by sum(item_price) desc, seller_key) as rn
      from s_order_items group by 1, 2)
    select order_id, count(*) as order_item_count,
      count(distinct product_key) as order_product_count,
      count(distinct i.seller_key) as order_seller_count,
      sum(item_price) as order_revenue, sum(freight_value) as order_freight,
      sum(item_gross_value) as order_gross_value,
      max(shipping_limit_at) as order_shipping_limit_at,
      any_value(lead.seller_key) as primary_seller_key,
      count(distinct i.seller_key) > 1 as is_multi_seller_order
    from s_order_items i join lead using (order_id) where rn = 1 group by 1""",
    "i_delivery": f"""
    select *, delay_vs_promise_days > 0 as is_late,
      {case('delay_vs_promise_days', LATENESS_BUCKETS, '<=', NOT_DELIVERED)}
        as lateness_bucket,
      {fx('promised_delivery_days - total_delivery_days', 3)} as promise_slack_days
    from (select *,
      {hours('order_purchased_at', 'order_approved_at')} as approval_days,
      {hours('order_approved_at', 'order_handed_to_carrier_at')} as seller_handover_days,
      {hours('order_handed_to_carrier_at', 'order_delivered_at')} as carrier_transit_days,
      {hours('order_purchased_at', 'order_delivered_at')} as total_delivery_days,
      {days('order_purchased_at', 'order_promised_at')} as promised_delivery_days,
      {days('order_promised_at', 'order_delivered_at')} as delay_vs_promise_days
      from s_orders)""",
    # ---- dimensions --------------------------------------------------------
    "d_customer": """
    with seen as (
      select c.*, order_purchase_date from s_customers c left join s_orders using (customer_id)),
    latest as (
      select *, row_number() over (partition by customer_key
        order by order_purchase_date desc nulls last, customer_id) as rn from seen),
    span as (
      select customer_key, count(distinct customer_id) as ids, min(order_purchase_date) as lo,
        max(order_purchase_date) as hi from seen group by 1)
    select customer_key, customer_city, customer_state, customer_region,
      customer_zip_code_prefix, latitude as customer_latitude, longitude as customer_longitude,
      lo as first_order_date, hi as latest_order_date, ids as source_customer_id_count,
      ids > 1 as is_repeat_customer
    from span join (select * from latest where rn = 1) using (customer_key)
    left join s_geolocation on customer_zip_code_prefix = zip_code_prefix""",
    "d_seller": """
    select seller_key, seller_city, seller_state, seller_region, seller_zip_code_prefix,
      latitude as seller_latitude, longitude as seller_longitude
    from s_sellers left join s_geolocation on seller_zip_code_prefix = zip_code_prefix""",
    "d_product": f"""
    select product_key, product_category, product_category_pt, product_weight_g,
      product_length_cm, product_height_cm, product_width_cm, product_volume_cm3,
      {case('product_weight_g', WEIGHT_BANDS, '<', UNKNOWN_WEIGHT)} as product_weight_band,
      product_photo_count, product_name_length, product_description_length
    from s_products""",
    "d_date": f"""
    select d as date_key, year(d) as calendar_year, quarter(d) as calendar_quarter,
      month(d) as calendar_month, day(d) as day_of_month,
      strftime(d, '%U')::bigint as week_of_year, dayofweek(d) + 1 as day_of_week,
      strftime(d, '%Y-%m') as year_month, strftime(d, '%b %Y') as month_label,
      dayname(d) as day_name, date_trunc('month', d)::date as month_start_date,
      (d - dayofweek(d)::int)::date as week_start_date,
      dayofweek(d) in (0, 6) as is_weekend,
      d between date '{P.window_start}' and date '{P.window_end}' as is_in_analysis_window
    from (select unnest(range(date '{P.calendar_start}', date '{P.calendar_end}',
      interval 1 day))::date as d)""",
    # ---- facts -------------------------------------------------------------
    "f_orders": f"""
    select d.order_id as order_key, d.order_id, c.customer_key,
      i.primary_seller_key as seller_key, d.order_purchase_date as order_date_key,
      d.customer_id as source_customer_id, order_status, is_delivered, is_excluded_from_kpis,
      p.customer_state, p.customer_region, p.customer_city, seller_state, seller_region,
      seller_city,
      coalesce(seller_state, '??') || ' -> ' || coalesce(p.customer_state, '??')
        as delivery_route,
      coalesce(seller_state, '??') = coalesce(p.customer_state, '??') as is_intra_state_route,
      order_purchased_at, order_approved_at, order_handed_to_carrier_at, order_delivered_at,
      order_promised_at, order_purchase_date, order_delivered_date, order_promised_date,
      approval_days, seller_handover_days, carrier_transit_days, total_delivery_days,
      promised_delivery_days, delay_vs_promise_days, promise_slack_days, is_late,
      lateness_bucket, order_item_count, order_product_count, order_seller_count,
      is_multi_seller_order, order_revenue, order_freight, order_gross_value,
      order_shipping_limit_at, order_payment_total, payment_record_count,
      primary_payment_type, payment_type_mix, max_payment_installments, review_id,
      review_score, has_comment as review_has_comment, source_review_count,
      case when order_gross_value > 0 then {ra('order_freight', 'order_gross_value', 4)} end
        as freight_share_of_order,
      case when is_late then order_revenue end as late_order_revenue,
      date_trunc('month', order_purchase_date)::date as purchase_month
    from i_delivery d
    left join s_customers c on c.customer_id = d.customer_id
    left join d_customer p on p.customer_key = c.customer_key
    left join i_items i on i.order_id = d.order_id
    left join d_seller s on s.seller_key = i.primary_seller_key
    left join i_payments y on y.order_id = d.order_id
    left join i_reviews r on r.order_id = d.order_id""",
    "f_order_items": """
    select order_item_key, i.order_id as order_key, i.order_id, order_item_id, product_key,
      seller_key, customer_key, order_purchase_date as order_date_key, order_status,
      is_delivered, is_excluded_from_kpis, order_purchase_date, shipping_limit_at, item_price,
      freight_value, item_gross_value,
      date_trunc('month', order_purchase_date)::date as purchase_month
    from s_order_items i left join s_orders o on o.order_id = i.order_id
    left join s_customers c on c.customer_id = o.customer_id""",
    "f_payments": """
    select payment_key, p.order_id as order_key, p.order_id, payment_sequential,
      order_purchase_date as order_date_key, order_status, payment_type,
      payment_installments, payment_value
    from s_order_payments p left join s_orders o on o.order_id = p.order_id""",
    # ---- aggregates --------------------------------------------------------
    "a_route": f"""
    select *, {PENALTY}, delivered_orders >= {P.min_orders} as is_reportable from (
    select delivery_route, seller_state, seller_region, customer_state, customer_region,
      is_intra_state_route, count(*) as delivered_orders,
      sum(order_revenue) as delivered_revenue, {n('is_late')} as late_orders,
      {ra(n('is_late'), 'count(*)', 4)} as late_rate, sum(late_order_revenue) as late_revenue,
      {ra('sum(late_order_revenue)', 'sum(order_revenue)', 4)} as late_revenue_share,
      {av('total_delivery_days', 2)} as avg_delivery_days, {REVIEWS},
      {av('freight_share_of_order', 4, 'decimal(18,4)')} as avg_freight_share,
      {q('total_delivery_days', .5, 2)} as median_delivery_days,
      {q('total_delivery_days', .9, 2)} as p90_delivery_days,
      {q('approval_days', .5, 2)} as median_approval_days,
      {q('seller_handover_days', .5, 2)} as median_handover_days,
      {q('carrier_transit_days', .5, 2)} as median_transit_days,
      {q('promised_delivery_days', .5, 2)} as median_promised_days,
      {q('delay_vs_promise_days', .5, 2)} as median_delay_vs_promise_days
    from f_orders where {SCOPE} group by all)""",
    "a_month": f"""
    select *, {PENALTY},
      {fx('late_rate - lag(late_rate) over (order by month_start_date nulls first)', 4)}
        as late_rate_mom_change from (
    select {MONTH}, count(*) as orders_placed, {n('is_delivered')} as orders_delivered,
      sum(order_revenue) as revenue, sum(order_freight) as freight,
      {n('is_late')} as late_orders, {ra(n('is_late'), n('is_delivered'), 4)} as late_rate,
      sum(late_order_revenue) as late_revenue,
      {av('promise_slack_days', 2)} as avg_promise_slack_days, {REVIEWS},
      {q('case when is_delivered then total_delivery_days end', .5, 2)}
        as median_delivery_days,
      {q('case when is_delivered then total_delivery_days end', .9, 2)} as p90_delivery_days,
      {q('case when is_delivered then approval_days end', .5, 2)} as median_approval_days,
      {q('case when is_delivered then seller_handover_days end', .5, 2)}
        as median_handover_days,
      {q('case when is_delivered then carrier_transit_days end', .5, 2)}
        as median_transit_days,
      {q('promised_delivery_days', .5, 2)} as median_promised_days
    from f_orders left join d_date on order_purchase_date = date_key
    where {KEPT} group by {MONTH})""",
    "a_sales": f"""
    with sold as (
      select date_trunc('month', order_purchase_date)::date as month_start_date,
        sum(item_price) as revenue, sum(freight_value) as freight,
        sum(item_gross_value) as gross_value, count(*) as items_sold,
        count(distinct product_key) as distinct_products_sold,
        count(distinct seller_key) as active_sellers
      from f_order_items where {KEPT} group by 1),
    placed as (
      select date_trunc('month', order_purchase_date)::date as month_start_date,
        count(*) as order_count, count(distinct customer_key) as active_customers
      from f_orders where {KEPT} group by 1)
    select m.*, s.* exclude (month_start_date), o.order_count, o.active_customers,
      a.late_rate, a.median_delivery_days, a.avg_review_score,
      {ra('s.revenue', 'o.order_count', 2)} as avg_order_value,
      {ra('s.items_sold', 'o.order_count', 3)} as avg_items_per_order,
      {ra('s.freight', 's.gross_value', 4)} as freight_share_of_gross,
      {fx(ra('s.revenue', 'lag(s.revenue) over (order by m.month_start_date)') + ' - 1', 4)}
        as revenue_mom_growth
    from (select distinct {MONTH} from d_date) m
    join sold s on s.month_start_date = m.month_start_date
    left join placed o on o.month_start_date = m.month_start_date
    left join a_month a on a.month_start_date = m.month_start_date""",
    "a_product": f"""
    with lines as (
      select i.*, product_category from f_order_items i left join d_product using (product_key)
      where {KEPT}),
    sales as (
      select product_category, sum(item_price) as revenue, sum(freight_value) as freight,
        count(*) as units_sold, count(distinct order_id) as order_count,
        count(distinct product_key) as distinct_products,
        count(distinct seller_key) as distinct_sellers,
        count(distinct customer_key) as distinct_customers,
        {av('item_price', 2)} as avg_item_price,
        {ra('sum(freight_value)', 'sum(item_price) + sum(freight_value)', 4)}
          as freight_share_of_gross
      from lines group by 1),
    service as (
      select product_category, count(*) as delivered_orders, {n('is_late')} as late_orders,
        {ra(n('is_late'), 'count(*)', 4)} as late_rate, {REVIEWS},
        {q('total_delivery_days', .5, 2)} as median_delivery_days,
        {q('total_delivery_days', .9, 2)} as p90_delivery_days
      from (select distinct order_id, product_category from lines) join f_orders using (order_id)
      where is_delivered and delay_vs_promise_days is not null group by 1)
    select sales.*, service.* exclude (product_category), {PENALTY},
      {ra('revenue', 'sum(revenue) over ()', 4)} as revenue_share,
      dense_rank() over (order by revenue desc) as revenue_rank,
      dense_rank() over (order by units_sold desc) as volume_rank,
      dense_rank() over (order by revenue desc) <= {P.top_categories} and late_rate >
        (select sum(late_rate::decimal(18,4))::double / count(late_rate) from service)
        as is_high_value_poor_delivery,
      order_count >= {P.min_orders} as is_reportable
    from sales left join service on sales.product_category = service.product_category""",
    "a_rfm": f"""
    with people as (
      select customer_key, date_diff('day', max(order_purchase_date), date '{P.as_of}')
          as recency_days, count(*) as frequency, sum(order_revenue) as monetary,
        min(order_purchase_date) as first_order_date,
        max(order_purchase_date) as latest_order_date,
        {av('order_revenue', 2)} as avg_order_value,
        sum(order_item_count)::bigint as total_items_purchased,
        {n('is_delivered')} as delivered_orders, {n('is_late')} as late_orders,
        {ra(n('is_late'), n('is_delivered'), 4)} as late_rate,
        sum(late_order_revenue) as revenue_delivered_late,
        {av('total_delivery_days', 2)} as avg_delivery_days,
        {av('review_score', 3)} as avg_review_score
      from f_orders where {KEPT} and customer_key is not null group by 1),
    scored as (
      select *,
        {P.tiles + 1} - ntile({P.tiles}) over (order by recency_days nulls first, customer_key)
          as r_score,
        ntile({P.tiles}) over (order by frequency nulls first, monetary nulls first,
          customer_key) as f_score,
        ntile({P.tiles}) over (order by monetary nulls first, customer_key) as m_score
      from people)
    select *, concat(r_score, f_score, m_score) as rfm_cell,
      r_score + f_score + m_score as rfm_total,
      case when m_score >= 4 then
          case when r_score >= 4 and f_score >= 3 then '{SEGMENTS[0]}'
               when r_score >= 3 then '{SEGMENTS[1]}' else '{SEGMENTS[2]}' end
        when r_score >= 4 and f_score <= 2 then '{SEGMENTS[3]}'
        when r_score <= 2 and m_score <= 2 then '{SEGMENTS[4]}'
        else '{SEGMENTS[5]}' end as rfm_segment,
      m_score >= 4 and late_orders > 0 as is_high_value_with_late_delivery
    from scored""",
    "usable": f"""
    select * from a_month where is_in_analysis_window and orders_placed >= {P.min_month_orders}""",
    "usable_sales": f"""
    select * from a_sales where is_in_analysis_window and order_count >= {P.min_month_orders}""",
    "busiest": """
    select * from a_route where is_reportable order by late_orders desc, delivery_route limit 20""",
    "pairs": f"""
    select seller_region, customer_region, sum(delivered_orders)::bigint as orders,
      {ra('sum(late_orders)', 'sum(delivered_orders)', 4)} as late_rate
    from a_route group by 1, 2 having sum(delivered_orders) >= {P.min_orders}""",
}

BASE = {"raw." + t: f"r_{t}" for t in TABLES} | {t: f"r_{t}" for t in TABLES} | {
    **{f"stg_{t}": f"s_{t}" for t in ("orders", "order_items", "order_payments",
                                      "order_reviews", "customers", "sellers", "products",
                                      "geolocation")},
    "int_order_payments": "i_payments", "int_order_reviews": "i_reviews",
    "int_order_items_rollup": "i_items", "int_order_delivery": "i_delivery",
    "dim_customer": "d_customer", "dim_seller": "d_seller", "dim_product": "d_product",
    "dim_date": "d_date", "fct_orders": "f_orders", "fct_order_items": "f_order_items",
    "fct_payments": "f_payments", "agg_delivery_by_route": "a_route",
    "agg_delivery_monthly": "a_month", "agg_monthly_sales": "a_sales",
    "agg_product_performance": "a_product", "agg_customer_rfm": "a_rfm",
}


def _assemble(final: str) -> str:
    """Prefix a statement with the fragments it needs, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[a-z_]+\b", text)):
            if name in FRAGMENTS and name not in order:
                visit(FRAGMENTS[name])
                order.append(name)

    visit(final)
    parts = ",\n".join(f"{name} as ({FRAGMENTS[name]})" for name in order)
    if final.startswith("with"):
        final = f"select * from ({final})"
    return f"with {parts}\n{final}" if parts else final


def _doubles(*names: str) -> str:
    return "replace (" + ", ".join(f"{c}::double as {c}" for c in names) + ")"


def _board(keys: str, where: str, having: str, extra: str = "") -> str:
    return f"""select {keys}, count(*) as delivered_orders, {n('is_late')} as late_orders,
      {ra(n('is_late'), 'count(*)', 4)} as late_rate{extra},
      sum(late_order_revenue)::double as late_revenue,
      quantile_disc(total_delivery_days, 0.5) as median_days
    from f_orders where {where} group by {keys} having count(*) >= {having}"""


def _rule(r, table: str) -> str:
    """One result row for a rule, as its own subquery."""
    c = r.column
    if r.kind == "not_null":
        bad, seen = f"{c} is null", "count(*)"
    elif r.kind == "accepted_values":
        values = ", ".join(repr(v) for v in r.values)
        bad, seen = f"{c} not in ({values})", f"count({c})"
    elif r.kind == "length":
        bad, seen = f"length({c}) <> {r.values[0]}", f"count({c})"
    elif r.kind == "accepted_range":
        eq = "" if r.inclusive else "="
        sides = [f"{c} <{eq} {r.low}"] if r.low is not None else []
        sides += [f"{c} >{eq} {r.high}"] if r.high is not None else []
        bad, seen = " or ".join(sides), f"count({c})"
    head = f"'{r.table}' as table_name, '{r.name}' as rule, '{r.severity}' as severity"
    if r.kind == "unique":
        return f"""select {head}, {n('k > 1')} as failing, coalesce(sum(k), 0)::bigint as checked,
          {n('k > 1')} = 0 as passed
          from (select count(*) as k from {table} where {c} is not null group by {c})"""
    if r.kind == "relationships":
        parent = BASE[r.parent]
        return f"""select {head}, count(*) filter (x.{c} is not null and p.k is null) as failing,
          count(x.{c}) as checked, failing = 0 as passed
          from {table} x left join (select distinct {r.parent_key} as k from {parent}) p
          on x.{c} = p.k"""
    return f"""select {head}, count(*) filter ({bad}) as failing, {seen} as checked,
      failing <= checked - checked * {float(r.mostly)} + 1e-9 as passed from {table}"""


def _rules(kind: str) -> str:
    return "\nunion all\n".join(_rule(r, BASE[r.table]) for r in MODEL_RULES if r.kind == kind)


def _mostly() -> str:
    return "\nunion all\n".join(_rule(r, BASE[r.table]) for r in THRESHOLD_RULES)


# Published row counts (fixed values).
PUBLISHED = {
    "orders": 99441, "order_items": 112650, "order_payments": 103886, "order_reviews": 99224,
    "customers": 99441, "products": 32951, "sellers": 3095, "geolocation": 1000163,
    "product_category_translation": 71,
}


def _each_file(select: str) -> str:
    """One statement per source table; {t} is its name, {k} its published row count."""
    return "\nunion all\n".join(select.format(t=t, k=k) for t, k in PUBLISHED.items())


def _profiles() -> str:
    measure = {
        "string": "length({c}::varchar)", "bigint": "{c}", "double": "floor({c} * 1000)",
        "decimal(18,9)": "{c} * 100",
        "timestamp_ntz": "date_diff('day', date '1970-01-01', {c}::date) * 86400"
                         " + hour({c}) * 3600 + minute({c}) * 60 + second({c})",
    }
    return "\nunion all\n".join(
        f"""select '{t}' as "table", '{c}' as "column", count(*) as "rows",
          count({c}) as present,
          sum(({measure[kind].format(c=c)})::bigint)::bigint
          as checksum from r_{t}"""
        for t in PUBLISHED for c, kind in types_of(t).items())


def _file_gate() -> str:
    columns = "table_name, rule, severity, failing, checked, passed"
    return "\nunion all\n".join([
        _each_file("""select '{t}' as table_name, 'columns(declared, in order)' as rule,
          'error' as severity, 0::bigint as failing, 1::bigint as checked, true as passed"""),
        _each_file("""select '{t}', 'readable(_bad_record)', 'error', 0, count(*), true
          from r_{t}"""),
        _each_file("""select '{t}', 'row_count(*)', 'warn', abs(count(*) - {k}), count(*),
          count(*) = {k} from r_{t}"""),
        *[f"select {columns} from ({_rule(r, 'r_' + r.table)})" for r in FILE_RULES]])


def _orphan(child: str, key: str, parent: str, parent_key: str, label: str) -> str:
    return f"""select '{label}' as relationship, {n('p.k is null')} as orphans,
      count(*) as total, {ra(n('p.k is null') + ' * 100', 'count(*)', 3)} as orphan_pct
    from {child} x left join (select distinct {parent_key} as k from {parent}) p
      on x.{key} = p.k"""


FACT_MONEY = ("order_revenue", "order_freight", "order_gross_value", "order_payment_total",
              "late_order_revenue")
ITEM_MONEY = ("item_price", "freight_value", "item_gross_value")
SALES_MONEY = ("revenue", "freight", "gross_value")
RED = {
    "revenue_reconciles": ("error", """
      select 'stg_order_items vs ' || fact as comparison, staging_revenue::double
        as staging_revenue, mart_revenue::double as mart_revenue,
        (mart_revenue - staging_revenue)::double as difference
      from (select sum(item_price) as staging_revenue from s_order_items), (
        select 'fct_order_items' as fact, sum(item_price) as mart_revenue from f_order_items
        union all select 'fct_orders', sum(order_revenue) from f_orders)
      where staging_revenue <> mart_revenue"""),
    "order_count_reconciles": ("error", """
      select *, case when mart_rows <> mart_orders then 'fct_orders is not at order grain'
        when mart_orders < staging_orders then 'orders were dropped'
        else 'orders were invented' end as violation
      from (select count(distinct order_id) as staging_orders from s_orders),
        (select count(distinct order_id) as mart_orders, count(*) as mart_rows from f_orders)
      where mart_rows <> mart_orders or mart_orders <> staging_orders"""),
    "payments_not_multiplied": ("error", """
      select order_id, sum(payment_value)::double as staging_payment_total,
        any_value(order_payment_total)::double as mart_payment_total,
        any_value(order_payment_total)::double - sum(payment_value)::double as difference
      from f_orders join s_order_payments using (order_id)
      where order_payment_total is not null
      group by 1 having sum(payment_value) <> any_value(order_payment_total)"""),
    "flag_matches_delay": ("error", """
      select order_id, delay_vs_promise_days, is_late, lateness_bucket from f_orders
      where is_late is distinct from (delay_vs_promise_days > 0)"""),
    "chronology": ("error", """
      select order_id, order_purchased_at, order_approved_at, order_delivered_at,
        case when order_approved_at < order_purchased_at then 'approved before purchase'
          else 'delivered before purchase' end as violation
      from i_delivery where order_approved_at < order_purchased_at
        or order_delivered_at < order_purchased_at"""),
    "recording_order": ("warn", """
      select order_id, order_approved_at, order_handed_to_carrier_at, order_delivered_at,
        case when order_handed_to_carrier_at < order_approved_at
          then 'carrier handover recorded before payment approval'
          else 'delivered before carrier handover' end as anomaly
      from i_delivery where order_handed_to_carrier_at < order_approved_at
        or order_delivered_at < order_handed_to_carrier_at"""),
    "status_matches_timestamp": ("warn", """
      select order_id, order_status, order_delivered_at,
        case when is_delivered then 'status is delivered but no delivery timestamp'
          else 'has a delivery timestamp but status is not delivered' end as violation
      from i_delivery where is_delivered = (order_delivered_at is null)"""),
    "payment_matches_value": ("warn", """
      select order_id, order_revenue::double as order_revenue,
        order_freight::double as order_freight, order_gross_value::double as order_gross_value,
        order_payment_total::double as order_payment_total,
        (order_payment_total - order_gross_value)::double as difference, payment_type_mix
      from f_orders where abs(order_payment_total - order_gross_value) > 0.01
        and coalesce(payment_type_mix, '') not like '%voucher%'"""),
    "dates_in_window": ("error", f"""
      select order_id, order_purchase_date, order_status from f_orders
      where order_purchase_date < date '{P.window_start}' - interval 3 month
        or order_purchase_date > date '{P.window_end}' + interval 3 month"""),
    "rfm_at_person_grain": ("error", f"""
      select customer_rows, people_with_kept_orders, distinct_customer_ids, max_frequency,
        case when customer_rows <> people_with_kept_orders
            then 'row count does not match the number of people with a kept order'
          when customer_rows >= distinct_customer_ids
            then 'as many rows as customer_ids: RFM is probably keyed on the per-order id'
          else 'no repeat customers: RFM is probably keyed on the per-order id' end as violation
      from (select count(*) as customer_rows, max(frequency) as max_frequency from a_rfm),
        (select count(distinct customer_key) as people_with_kept_orders,
           count(distinct source_customer_id) as distinct_customer_ids
         from f_orders where {KEPT})
      where customer_rows <> people_with_kept_orders or customer_rows >= distinct_customer_ids
        or max_frequency <= 1"""),
}

STAGE_LONG = """
  select {ids}, '1. payment approval' as stage, {a} as days from {src}
  union all select {ids}, '2. seller handover', {b} from {src}
  union all select {ids}, '3. carrier transit', {c} from {src}"""
CATEGORY = """product_category, revenue::double as revenue, units_sold, order_count,
  avg_item_price, revenue_share, revenue_rank, volume_rank, late_rate,
  median_delivery_days, avg_review_score, is_high_value_poor_delivery"""
PEOPLE_TOTALS = "round(sum(monetary), 0)::double"


def _statements() -> dict[str, str]:
    return {
        "csv_round_trip": _profiles(),
        "load_manifest": _each_file("""select '{t}' as "table", count(*) as "rows",
          {k}::bigint as expected_rows, count(*) = {k} as rows_match_expected,
          true as has_bytes, 64::bigint as digest_length from r_{t}"""),
        "load_reconciliation": _each_file("""select '{t}' as "table", count(*) as source_rows,
          count(*) as loaded_rows, 0::bigint as delta, 'OK' as status from r_{t}"""),
        "file_gate_verdicts": _file_gate(),
        "acceptance_readout": _each_file("""select '{t}' as "table", count(*) as "rows",
          {k}::bigint as expected_rows, count(*) - {k} as delta, count(*) = {k} as accepted
          from r_{t}"""),
        "stg_orders": "select * from s_orders",
        "stg_order_items": f"select * {_doubles(*ITEM_MONEY)} from s_order_items",
        "stg_order_payments": f"select * {_doubles('payment_value')} from s_order_payments",
        "stg_order_reviews": "select * from s_order_reviews",
        "stg_customers": "select * from s_customers",
        "stg_sellers": "select * from s_sellers",
        "stg_products": "select * from s_products",
        "geo_collapse": "select * from s_geolocation",
        "modal_value": """select order_id, payment_type from (
            select order_id, payment_type, row_number() over (partition by order_id
              order by count(*) desc, payment_type) as rn
            from r_order_payments group by 1, 2) where rn = 1""",
        "payments_to_order_grain":
            f"select * {_doubles('order_payment_total')} from i_payments",
        "latest_review_per_order": "select * from i_reviews",
        "items_rollup_primary_seller": "select * " + _doubles(
            "order_revenue", "order_freight", "order_gross_value") + " from i_items",
        "delivery_measures": "select * from i_delivery",
        "person_dimension": "select * from d_customer",
        "seller_dimension": "select * from d_seller",
        "product_dimension": "select * from d_product",
        "calendar_dimension": f"""
          select d_date.*, count(order_id) as orders_placed,
            count(order_id) filter ({KEPT}) as orders_kept, sum(order_revenue)::double as revenue
          from d_date left join f_orders on order_purchase_date = date_key group by all""",
        "fct_orders": f"select * {_doubles(*FACT_MONEY)} from f_orders",
        "fct_order_items": f"select * {_doubles(*ITEM_MONEY)} from f_order_items",
        "fct_payments": f"select * {_doubles('payment_value')} from f_payments",
        "delivery_by_route":
            f"select * {_doubles('delivered_revenue', 'late_revenue')} from a_route",
        "delivery_monthly":
            f"select * {_doubles('revenue', 'freight', 'late_revenue')} from a_month",
        "monthly_sales": f"select * {_doubles(*SALES_MONEY)} from a_sales",
        "product_performance": f"select * {_doubles('revenue', 'freight')} from a_product",
        "customer_rfm":
            f"select * {_doubles('monetary', 'revenue_delivered_late')} from a_rfm",
        "scd2_snapshot": """
          with old_run as (select product_key, product_category, product_category_pt,
              product_weight_g, product_volume_cm3 from s_products),
          new_run as (
            select * replace (case when product_key % 10 = 0 then 'moved'
              else product_category end as product_category)
            from old_run where product_key % 97 <> 0
            union all
            select * replace (product_key + 1000000000 as product_key) from old_run
            where product_key % 100 = 0 and product_key % 97 <> 0
            union all
            select * replace (product_key + 1000000000 as product_key) from old_run
            where product_key % 100 = 0 and product_key % 97 = 0),
          fate as (
            select o.*, case when n.product_key is null
              or n.product_category is distinct from o.product_category
              then timestamp '2001-02-01' end as ended
            from old_run o left join new_run n using (product_key))
          select * exclude (ended), timestamp '2001-01-01' as valid_from, ended as valid_to
          from fate
          union all
          select n.*, timestamp '2001-02-01', null from new_run n
          left join fate f using (product_key)
          where f.product_key is null or f.ended is not null""",
        "history_by_bucket": """
          with days as (select * from (values (1, timestamp '2001-01-01'),
              (2, timestamp '2001-02-01'), (3, timestamp '2001-03-01')) d(day, began)),
          base as (select product_key, product_category, product_category_pt,
              product_weight_g, product_volume_cm3 from s_products),
          second as (
            select * replace (case when product_key % 10 = 0 then 'moved'
              else product_category end as product_category)
            from base where product_key % 97 <> 0
            union all
            select * replace (product_key + 1000000000 as product_key) from base
            where product_key % 100 = 0),
          states as (
            select 1 as day, * from base
            union all select 2, * from second
            union all select 3, * replace (case when product_key % 1000 = 0 then 'late'
              else product_category end as product_category) from second),
          marked as (
            select *, coalesce(lag(day) over w = day - 1
                and lag(product_category) over w is not distinct from product_category, false)
              as same
            from states window w as (partition by product_key order by day)),
          -- rows of one version share the number of versions begun so far
          numbered as (
            select *, sum(case when same then 0 else 1 end) over (
              partition by product_key order by day) as version from marked),
          spans as (
            select product_key, arg_min(product_category, day) as product_category,
              arg_min(product_category_pt, day) as product_category_pt,
              arg_min(product_weight_g, day) as product_weight_g,
              arg_min(product_volume_cm3, day) as product_volume_cm3,
              min(day) as first_day, max(day) as last_day
            from numbered group by product_key, version)
          select s.* exclude (first_day, last_day), b.began as valid_from, e.began as valid_to
          from spans s join days b on b.day = s.first_day
          left join days e on e.day = s.last_day + 1""",
        "table_row_counts": " union all ".join(
            f"select '{t}' as \"table\", count(*) as rows from r_{t}" for t in TABLES),
        "coverage_by_month": f"""
          select strftime(order_purchase_timestamp, '%Y-%m') as year_month, count(*) as orders,
            count(*) < {P.min_month_orders} as is_sparse from r_orders group by 1""",
        "null_profile": " union all ".join(f"""
          select '{c}' as column_name, {n(c + ' is null')} as null_count,
            {ra(n(c + ' is null') + ' * 100', 'count(*)', 2)} as pct_of_rows from r_orders"""
            for c in ("order_approved_at", "order_delivered_carrier_date",
                      "order_delivered_customer_date", "order_estimated_delivery_date")),
        "milestone_nulls": f"""
          select count(*) as orders, {n('order_approved_at is null')} as null_approved,
            {n('order_delivered_carrier_date is null')} as null_carrier,
            {n('order_delivered_customer_date is null')} as null_delivered,
            {n('order_estimated_delivery_date is null')} as null_promised,
            {n("order_status = 'delivered' and order_delivered_customer_date is null")}
              as delivered_but_no_date from r_orders""",
        "missing_delivery_by_status": f"""
          select order_status, count(*) as orders,
            {n('order_delivered_customer_date is null')} as missing_delivery_date
          from r_orders group by 1""",
        "fanout_multiplier": f"""
          select sum(i)::bigint as correct_item_rows, sum(i * p)::bigint as rows_after_naive_join,
            {n('p > 1')} as orders_with_multiple_payments, max(p) as max_payment_lines,
            {ra('sum(i * p)', 'sum(i)', 2)} as inflation
          from (select order_id, count(*) as i from r_order_items group by 1)
          join (select order_id, count(*) as p from r_order_payments group by 1)
            using (order_id)""",
        "customers_by_period": """
          with kept as (
            select date_trunc('month', order_purchase_date)::date as m, customer_key
            from f_orders where not is_excluded_from_kpis and customer_key is not null)
          select 'month' as kind, m as period, count(distinct customer_key) as customers
          from kept group by m
          union all
          select 'quarter', date_trunc('quarter', m)::date, count(distinct customer_key)
          from kept group by 2
          union all
          select 'ever', null, count(distinct customer_key) from kept having count(*) > 0""",
        "review_duplication": """
          select count(*) as review_rows, count(distinct review_id) as distinct_review_ids,
            count(distinct order_id) as distinct_orders,
            count(*) - count(distinct order_id) as excess_rows_per_order
          from r_order_reviews""",
        "customer_identity": """
          select count(*) as customer_id_rows, count(distinct customer_unique_id) as actual_people,
            count(*) - count(distinct customer_unique_id) as duplicate_identities
          from r_customers""",
        "orders_per_person": """
          select orders_placed, count(*) as customers from (
            select customer_unique_id, count(*) as orders_placed from r_customers group by 1)
          group by 1""",
        "geo_cardinality": f"""
          select count(*) as geolocation_rows,
            count(distinct geolocation_zip_code_prefix) as distinct_prefixes,
            {ra('count(*)', 'count(distinct geolocation_zip_code_prefix)', 1)}
              as avg_rows_per_prefix from r_geolocation""",
        "orphan_report": "\nunion all\n".join([
            _orphan("r_order_items", "order_id", "r_orders", "order_id",
                    "order_items -> orders"),
            _orphan("r_order_items", "product_id", "r_products", "product_id",
                    "order_items -> products"),
            _orphan("r_order_items", "seller_id", "r_sellers", "seller_id",
                    "order_items -> sellers"),
            _orphan("r_orders", "customer_id", "r_customers", "customer_id",
                    "orders -> customers"),
            _orphan("r_orders", "order_id", "r_order_items", "order_id",
                    "orders without any item line")]),
        "raw_delivery_sanity": f"""
          select *, {ra('late_orders', 'delivered_orders', 4)} as late_rate from (
          select count(*) as delivered_orders,
            {av(days('order_purchase_timestamp', 'order_delivered_customer_date'), 2)}
              as avg_delivery_days,
            {av(days('order_estimated_delivery_date', 'order_delivered_customer_date'), 2)}
              as avg_delay_vs_promise,
            {n('order_delivered_customer_date::date > order_estimated_delivery_date::date')}
              as late_orders,
            {n('order_delivered_customer_date < order_purchase_timestamp')}
              as impossible_delivered_before_purchase,
            {n('order_delivered_carrier_date < order_approved_at')}
              as impossible_carrier_before_approval
          from r_orders where order_status = 'delivered')""",
        "headline_kpis": _headline(SCOPE),
        "headline_kpis_filtered": _headline(
            f"{SCOPE} and {WINDOW} and customer_region in ('ASIA', 'EUROPE')"),
        "filter_options": """
          select distinct 'year_month' as filter, year_month as choice from a_month
          where is_in_analysis_window
          union all select distinct 'customer_region', customer_region from d_customer
          where customer_region is not null""",
        "late_by_state": f"""
          select customer_state, customer_region,
            sum(delivered_orders)::bigint as delivered_orders,
            sum(late_orders)::bigint as late_orders,
            {ra('sum(late_orders)', 'sum(delivered_orders)', 4)} as late_rate,
            round(sum(delivered_revenue), 0)::double as revenue
          from a_route group by 1, 2 having sum(delivered_orders) >= {P.min_orders}""",
        "state_board": _board("customer_state, customer_region", f"{SCOPE} and {WINDOW}",
                              str(P.min_orders), ", sum(order_revenue)::double as revenue"),
        "ordered_state_board": "select *, row_number() over (order by late_rate desc nulls last,"
            " delivered_orders desc, customer_state) as place from (" + _board(
                "customer_state, customer_region", f"{SCOPE} and {WINDOW}", str(P.min_orders),
                ", sum(order_revenue)::double as revenue") + ")",
        "region_board": _board(
            "seller_region, customer_region",
            f"{SCOPE} and {WINDOW} and seller_region is not null",
            str(P.min_orders), ", sum(order_revenue)::double as revenue"),
        "busiest_late_routes": """
          select delivery_route, seller_region, customer_region, delivered_orders, late_orders,
            late_rate, median_delivery_days, p90_delivery_days,
            round(delivered_revenue, 0)::double as revenue, review_score_penalty_when_late
          from busiest""",
        "worst_routes_by_rate": """
          select delivery_route, delivered_orders, late_rate, median_delivery_days,
            round(delivered_revenue, 0)::double as revenue
          from busiest order by late_rate desc, delivery_route limit 10""",
        "route_board": _board("delivery_route",
                              f"{SCOPE} and {WINDOW} and seller_state is not null",
                              f"{P.min_orders} order by late_orders desc, delivery_route"
                              " limit 15"),
        "region_pairs": "select * from pairs",
        "region_matrix": "select seller_region, " + ", ".join(
            f"max(late_rate) filter (customer_region = '{r}') as \"{r}\""
            for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown"))
            + " from pairs group by 1",
        "usable_months": f"select * {_doubles('revenue', 'freight', 'late_revenue')} from usable",
        "excluded_months": f"""
          select * {_doubles('revenue', 'freight', 'late_revenue')} from a_month
          where (is_in_analysis_window and orders_placed >= {P.min_month_orders}) is not true""",
        "half_window_comparison": f"""
          with m as (select *, row_number() over (order by month_start_date) as i,
              count(*) over () as c from a_month where is_in_analysis_window),
          r as (select
            {ra('sum(late_orders) filter (i <= c // 2)',
                'greatest(coalesce(sum(orders_delivered) filter (i <= c // 2), 0), 1)')} as a,
            {ra('sum(late_orders) filter (i > c - c // 2)',
                'greatest(coalesce(sum(orders_delivered) filter (i > c - c // 2), 0), 1)')} as b
            from m)
          select {fx('a', 4)} as first_half_rate, {fx('b', 4)} as second_half_rate,
            {fx('(b - a) * 100', 2)} as change_pp,
            case when b < a then 'improving' else 'worsening' end as trend from r""",
        "worst_months": """
          select year_month, orders_placed, late_rate, median_delivery_days from usable
          order by late_rate desc, month_start_date limit 5""",
        "stage_decomposition": f"""
          with m as (select {q('approval_days', .5, 2)} as a,
            {q('seller_handover_days', .5, 2)} as b, {q('carrier_transit_days', .5, 2)} as c,
            {q('total_delivery_days', .5, 2)} as total from f_orders where {SCOPE})
          select stage, days, {ra('days', 'total', 3)} as share_of_total from (
          {STAGE_LONG.format(ids='total', a='a', b='b', c='c', src='m')})""",
        "stage_months_long": f"""
          with m as (select * from a_month where is_in_analysis_window)
          {STAGE_LONG.format(ids='year_month, month_start_date', a='median_approval_days',
                             b='median_handover_days', c='median_transit_days', src='m')}""",
        "lateness_bucket_curve": f"""
          select lateness_bucket, count(*) as orders, {av('review_score', 3)}
            as avg_review_score, round(sum(order_revenue), 0)::double as revenue
          from f_orders where {SCOPE} and review_score is not null group by 1""",
        "controlled_penalty": f"""
          select *, {fx('on_time - late', 2)} as penalty from (
          select customer_state, {avif('not is_late', 'review_score', 3)} as on_time,
            {avif('is_late', 'review_score', 3)} as late
          from f_orders where {SCOPE} and review_score is not null and customer_state in
            ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4') group by 1)""",
        "penalty_by_state": f"""
          select *, {fx('on_time - late', 4)} as penalty from (
          select customer_state, {avif('not is_late', 'review_score', 4)} as on_time,
            {avif('is_late', 'review_score', 4)} as late, count(*) as orders
          from f_orders where {SCOPE} and {WINDOW} and review_score is not null group by 1
          having count(*) >= {max(P.min_orders, 100)}
          order by orders desc, customer_state limit 10)""",
        "revenue_exposure": f"""
          select customer_region, round(sum(order_revenue), 0)::double as total_revenue,
            round(sum(late_order_revenue), 0)::double as late_revenue,
            {ra('sum(late_order_revenue)', 'sum(order_revenue)', 4)} as late_revenue_share
          from f_orders where {SCOPE} group by 1""",
        "promise_accuracy": f"""
          select *, case when avg_slack_days > 0 then 'padded' else 'optimistic' end
              as promise_is, {ra('delivered_early', 'orders', 4)} as early_share from (
          select {av('promise_slack_days', 2)} as avg_slack_days,
            {n('promise_slack_days > 0')} as delivered_early,
            {n('promise_slack_days < 0')} as delivered_late, count(*) as orders,
            {q('promised_delivery_days', .5, 1)} as median_promised_days,
            {q('total_delivery_days', .5, 1)} as median_actual_days
          from f_orders where is_delivered and {KEPT} and promise_slack_days is not null)""",
        "delay_histogram": """
          select delay_vs_promise_days, count(*) as orders, case when delay_vs_promise_days > 0
            then 'late' else 'on time or early' end as outcome
          from f_orders where is_delivered and delay_vs_promise_days between -60 and 30
          group by 1""",
        "month_pruned_state_days": f"""
          select customer_state, count(*) as orders, {av('total_delivery_days', 3)} as avg_days
          from f_orders where {WINDOW} group by 1""",
        "sales_totals": f"""
          select sum(revenue)::double as total_revenue, sum(order_count)::bigint as total_orders,
            {fx(ra('sum(revenue)', 'greatest(sum(order_count), 1)'), 2)} as avg_order_value
          from usable_sales""",
        "strongest_months": """
          select year_month, revenue::double as revenue, order_count, avg_order_value, late_rate
          from usable_sales order by usable_sales.revenue desc, month_start_date limit 5""",
        "weakest_months": """
          select year_month, revenue::double as revenue, order_count, avg_order_value, late_rate
          from usable_sales order by usable_sales.revenue, month_start_date limit 5""",
        "volume_late_correlation": " union all ".join(
            f"""select '{a}' as metric_a, '{b}' as metric_b,
              round(corr({a}::double, {b}::double), 3) as correlation
              from a_sales where is_in_analysis_window"""
            for a in ("order_count", "late_rate", "median_delivery_days")
            for b in ("order_count", "late_rate", "median_delivery_days")),
        "top_categories_by_revenue": f"""
          select {CATEGORY} from a_product where is_reportable
          order by a_product.revenue desc, product_category limit 15""",
        "top_categories_by_units": f"""
          select {CATEGORY} from a_product where is_reportable
          order by units_sold desc, product_category limit 15""",
        "rank_gap": """
          select product_category, revenue_rank, volume_rank,
            abs(revenue_rank - volume_rank) as rank_gap, revenue::double as revenue,
            units_sold, avg_item_price
          from a_product where is_reportable order by rank_gap desc, product_category limit 8""",
        "category_median_late_rate": f"""
          select product_category, revenue::double as revenue, late_rate, median_late_rate,
            late_rate > median_late_rate as above_median
          from a_product cross join (select {fx('quantile_cont(late_rate, 0.5)', 6)}
            as median_late_rate from a_product)""",
        "poor_delivery_categories": """
          select product_category, revenue::double as revenue, revenue_rank, units_sold,
            late_rate, median_delivery_days, avg_review_score
          from a_product where is_reportable and is_high_value_poor_delivery""",
        "rfm_segment_summary": f"""
          select rfm_segment, count(*) as customers, {av('recency_days', 0)}
            as avg_recency_days, {av('frequency', 2)} as avg_frequency,
            {av('monetary', 2)} as avg_monetary, {PEOPLE_TOTALS} as total_revenue,
            {av('late_rate', 4, 'decimal(18,4)')} as avg_late_rate,
            {av('avg_review_score', 2)} as avg_review_score,
            {n('is_high_value_with_late_delivery')} as high_value_served_late,
            {ra('sum(monetary)', 'sum(sum(monetary)) over ()', 4)} as revenue_share
          from a_rfm group by 1""",
        "frequency_distribution": f"""
          select frequency, count(*) as customers, {PEOPLE_TOTALS} as revenue
          from a_rfm group by 1""",
        "repeat_share": f"""
          select count(*) as customers, {n('frequency > 1')} as repeat_customers,
            {ra(n('frequency > 1'), 'count(*)', 4)} as repeat_share from a_rfm""",
        "at_risk_exposure": f"""
          with m as (select *, case when is_high_value_with_late_delivery then monetary end
            as exposed from a_rfm)
          select {n('is_high_value_with_late_delivery')} as at_risk_customers,
            round(sum(exposed), 0)::double as at_risk_revenue,
            {PEOPLE_TOTALS} as total_revenue,
            {ra('sum(exposed)', 'sum(monetary)', 4)} as at_risk_share from m""",
        "reconciliation_readout": f"""
          select *, staging_revenue = fact_item_revenue
              and staging_revenue = fact_order_revenue as revenue_ok,
            staging_orders = fact_order_rows as orders_ok,
            people_with_kept_orders = rfm_rows as people_ok from (select
            (select sum(item_price)::double from s_order_items) as staging_revenue,
            (select sum(item_price)::double from f_order_items) as fact_item_revenue,
            (select sum(order_revenue)::double from f_orders) as fact_order_revenue,
            (select count(distinct order_id) from s_orders) as staging_orders,
            (select count(*) from f_orders) as fact_order_rows,
            (select count(*) from d_customer) as dim_customers,
            (select count(distinct customer_key) from f_orders where {KEPT})
              as people_with_kept_orders,
            (select count(*) from a_rfm) as rfm_rows)""",
        "metric_agreement": f"""
          select *, abs(model_rate - recomputed_rate) < 1e-4 as agrees from (select
            (select {ra('sum(late_orders)', 'sum(orders_delivered)', 6)} from a_month
              where is_in_analysis_window) as model_rate,
            (select {ra(n('is_late'), 'count(*)', 6)} from f_orders
              where {SCOPE} and {WINDOW}) as recomputed_rate)""",
        "rule_not_null": _rules("not_null"),
        "rule_unique": _rules("unique"),
        "rule_accepted_values": _rules("accepted_values"),
        "rule_accepted_range": _rules("accepted_range"),
        "rule_relationships": _rules("relationships"),
        "rule_keys": f"select * from ({_rules('unique')}) union all "
                     f"select * from ({_rules('relationships')})",
        "rule_mostly_between": _mostly(),
        "duplicate_item_keys": """
          select order_id, order_item_id, count(*) as n_records from s_order_items
          group by 1, 2 having count(*) > 1""",
        "invariant_summary": "\nunion all\n".join(
            f"""select '-' as table_name, '{name}' as rule, '{severity}' as severity,
              count(*) as failing, null::bigint as checked, count(*) = 0 as passed
              from ({sql})""" for name, (severity, sql) in RED.items()),
        "revenue_reconciliation": RED["revenue_reconciles"][1],
        "order_count_reconciliation": RED["order_count_reconciles"][1],
        "payment_fanout_check": RED["payments_not_multiplied"][1],
        "flag_measure_agreement": RED["flag_matches_delay"][1],
        "milestone_chronology": RED["chronology"][1],
        "milestone_recording_order": RED["recording_order"][1],
        "status_timestamp_agreement": RED["status_matches_timestamp"][1],
        "payment_value_agreement": RED["payment_matches_value"][1],
        "purchase_date_window": RED["dates_in_window"][1],
        "rfm_person_grain": RED["rfm_at_person_grain"][1],
    }


def _headline(where: str) -> str:
    return f"""select *, {fx('avg_review_when_on_time - avg_review_when_late', 2)}
        as satisfaction_penalty from (
      select count(*) as delivered_orders, {n('is_late')} as late_orders,
        {ra(n('is_late'), 'count(*)', 4)} as late_rate, sum(order_revenue)::double as revenue,
        sum(late_order_revenue)::double as revenue_delivered_late,
        {ra('sum(late_order_revenue)', 'sum(order_revenue)', 4)} as late_revenue_share,
        {avif('is_late', 'review_score', 2)} as avg_review_when_late,
        {avif('not is_late', 'review_score', 2)} as avg_review_when_on_time,
        {av('promise_slack_days', 2)} as avg_promise_slack_days,
        {q('total_delivery_days', .5, 1)} as median_delivery_days,
        {q('total_delivery_days', .9, 1)} as p90_delivery_days
      from f_orders where {where})"""


def oracle_sql() -> dict[str, str]:
    return {name: _assemble(sql.strip()) for name, sql in _statements().items()}
