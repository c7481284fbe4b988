"""Physical plans: pruning, no single-task stage over raw rows, hot keys."""

import re
import time
from contextlib import contextmanager
from datetime import date
from pathlib import Path

from pyspark.sql import functions as F

from parcelwise import session
from parcelwise.operators import facts, grain, heavy
from parcelwise.params import Params
from parcelwise.plans import aggregates as agg, analysis as an
from parcelwise.plans.warehouse import Warehouse
from parcelwise.sources import sinks
from parcelwise.sources.scratch import FREE_KEY, Scratch

PACKAGE = Path(__file__).resolve().parents[1] / "parcelwise"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    before = {}
    for name, value in values.items():
        key = name.replace("__", ".")
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1",
                "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}


def test_month_predicate_prunes_and_columns_are_pruned(shop):
    q = an.state_days(shop["fct_orders"], date(2018, 1, 1), date(2018, 1, 31))
    seen = an.scan_facts(q)
    assert any("purchase_month" in f for f in seen["PartitionFilters"])
    assert any("order_purchase_date" in f for f in seen["PushedFilters"])
    (columns,) = seen["ReadSchema"]
    assert columns.count(":") == 3  # state, days, date
    # The date alone reaches row groups but no folder is skipped.
    only_date = shop["fct_orders"].where(F.col("order_purchase_date") <= date(2018, 1, 31))
    assert not any("purchase_month" in f for f in an.scan_facts(only_date)["PartitionFilters"])


def test_no_row_level_work_in_one_task(shop):
    for df in (shop["int_order_payments"], shop["int_order_reviews"],
               shop["int_order_items_rollup"], shop["stg_geolocation"], shop["persons"],
               agg.delivery_by_route(shop["fct_orders"], shop.params),
               agg.person_activity(shop["fct_orders"], shop.params),
               shop.build("fct_orders"), shop.build("fct_order_items")):
        text = plan(df)
        assert "SinglePartition" not in text
        # Ranks are searched in one stored part of a group's value counts at a time.
        windows = [x for x in text.splitlines() if re.search(r"\bWindow \[", x)]
        assert all("part#" in x or "sum(size#" in x for x in windows) and "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text


def test_distinct_counts_do_not_expand_lines(shop):
    sales = agg.monthly_sales(shop["fct_order_items"], shop["fct_orders"],
                              shop["agg_delivery_monthly"], shop["dim_date"])
    products = agg.product_performance(shop["fct_order_items"], shop["dim_product"],
                                       shop["fct_orders"], shop.params)
    for df in (sales, products):
        assert "Expand" not in plan(df)


def test_item_collapse_joins_without_further_shuffle(spark, shop):
    with settings(spark, **NO_BROADCAST):
        text = plan(grain.items_per_order(shop["stg_order_items"]))
    # Two per branch, each after a partial aggregate; the join of the branches adds none.
    assert text.count("Exchange hashpartitioning") == 4
    assert len(re.findall(r"partial_sum\(item_price", text)) >= 1


def test_item_collapse_sends_rows_per_seller_as_they_are(spark, shop):
    """States of the aggregate by order are wider than the rows that they are made of."""
    with settings(spark, **NO_BROADCAST):
        text = plan(grain.items_per_order(shop["stg_order_items"]))
    moved = text.split("REPARTITION_BY_COL")
    assert len(moved) > 1 and "partial_min_by" not in moved[1].split("+- HashAggregate")[1]


def test_tasks_stay_small_as_the_tables_grow(spark, tmp_path, monkeypatch):
    """A bigger table means more tasks, for scans and shuffles, not bigger ones."""
    folder = tmp_path / "many"
    spark.range(40_000).repartition(4).write.parquet(str(folder))
    monkeypatch.setattr(session, "TASK_BYTES", 8 << 10)
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    keys = ("spark.sql.files.maxPartitionBytes", first,
            "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    with settings(spark, **{k.replace(".", "__"): "1" for k in keys}):
        session.sized(spark, [str(folder)])
        stored = sum(f.stat().st_size for f in folder.glob("*.parquet"))
        assert int(spark.conf.get(first)) >= stored * session.SHUFFLED // (8 << 10) > 8
        assert spark.read.parquet(str(folder)).rdd.getNumPartitions() >= stored // (8 << 10)
        session.sized(spark, [])
        assert spark.conf.get(first) == spark.conf.get("spark.sql.shuffle.partitions")


def test_order_facts_share_the_order_partitioning(spark, shop):
    with settings(spark, **NO_BROADCAST):
        text = plan(facts.fct_orders(
            shop["int_order_delivery"], shop["stg_customers"], shop["dim_customer"],
            shop["dim_seller"], shop["int_order_items_rollup"], shop["int_order_payments"],
            shop["int_order_reviews"]))
    by_order = re.findall(r"Exchange hashpartitioning\(order_id#\w+, \d+\)", text)
    # Orders, two item branches, payments, reviews: once each.
    assert len(by_order) == 5


def rows_per_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_hot_order_is_spread_without_adaptive_execution(spark):
    """A third of all lines belong to one order, and a sixth to none."""
    lines = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None)
        .otherwise(F.col("id")).alias("order_id"),
        F.concat(F.col("id").cast("string"), F.lit("-1")).alias("order_item_key"),
        F.lit(1).alias("order_item_id"), F.col("id").alias("product_key"),
        (F.col("id") % 50).alias("seller_key"),
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_at"),
        F.lit(2).cast("decimal(12,2)").alias("item_price"),
        F.lit(1).cast("decimal(12,2)").alias("freight_value"),
        F.lit(3).cast("decimal(12,2)").alias("item_gross_value"))
    orders = spark.range(60_000).select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit(date(2018, 1, 1)).alias("order_purchase_date"),
        F.lit(True).alias("is_delivered"), F.lit(False).alias("is_excluded_from_kpis"))
    customers = orders.select("customer_id", F.col("customer_id").alias("customer_key"))
    with settings(spark, **NO_BROADCAST, spark__sql__adaptive__enabled="false",
                  spark__sql__shuffle__partitions="16"):
        fact = facts.fct_order_items(lines, orders, customers)
        sizes = rows_per_task(fact)
        assert sum(sizes) == 60_000 and len(sizes) == 16 and sizes[-1] < 2 * sizes[8]
        assert heavy.heavy_keys(lines, "order_id").keys() == {7, None}
        assert fact.where("customer_key is null").count() == 10_000
        assert fact.where("order_id = 7 and customer_key = 7").count() == 20_000
        assert fact.select("order_item_key").distinct().count() == 60_000
        even = lines.where("order_id <> 7")
        assert "_salt" not in plan(facts.fct_order_items(even, orders, customers))
        assert heavy.heavy_keys(lines.limit(0), "order_id") == {}


def test_hot_keys_reach_the_shuffle_reduced(spark, shop):
    """Payments of one order: the map side sends a row per task, not per payment."""
    pays = spark.range(0, 40_000, 1, 8).select(
        F.lit("hot").alias("order_id"), F.lit("boleto").alias("payment_type"),
        F.col("id").alias("payment_installments"),
        F.lit(1).cast("decimal(12,2)").alias("payment_value"))
    one = grain.payments_per_order(pays)
    assert one.first().payment_record_count == 40_000
    assert "partial_count" in plan(one)


def test_lines_of_an_order_move_once_and_as_they_are(spark, shop):
    """One shuffle for each item branch and one for payments, of rows and not of states."""
    with settings(spark, **NO_BROADCAST):
        lines = plan(grain.order_items(shop["stg_order_items"]))
        pays = plan(grain.order_payments(shop["stg_order_payments"]))
    assert lines.count("Exchange hashpartitioning") == 2
    assert pays.count("Exchange hashpartitioning") == 1
    for text in (lines, pays):
        assert all("partial" not in x for x in text.split("Exchange hashpartitioning")[-1:])
        assert text.count("REPARTITION_BY_COL") == text.count("Exchange hashpartitioning")
    assert "item_gross_value" not in lines.split("Exchange hashpartitioning")[-1]


def test_hot_orders_are_reduced_before_they_move(spark):
    """Half of the rows are of one order and a sixth of none; rollups stay what they were."""
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id"))
    lines = spark.range(0, 6_000, 1, 8).select(
        key.alias("order_id"), (F.col("id") % 11).alias("product_key"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 50).alias("seller_key"),
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_at"),
        F.when(F.col("id") % 9 > 0, F.col("id")).cast("decimal(18,9)").alias("item_price"),
        F.lit(1).cast("decimal(18,9)").alias("freight_value"))
    lines = lines.withColumn("item_gross_value", F.col("item_price") + F.col("freight_value"))
    pays = lines.select("order_id", F.concat(F.lit("t"), F.col("seller_key") % 3).alias(
        "payment_type"), F.col("item_price").alias("payment_value"),
        F.col("product_key").alias("payment_installments"))
    with settings(spark, **NO_BROADCAST, spark__sql__shuffle__partitions="16"):
        for got, want in ((grain.order_items(lines), grain.items_per_order(lines)),
                          (grain.order_payments(pays), grain.payments_per_order(pays))):
            assert got.dtypes == want.dtypes and "Union" in plan(got)
            assert got.count() == want.count() == 2_002
            assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
        light = lines.where("order_id <> 7")
        assert "Union" not in plan(grain.order_items(light))
        nobody = spark.range(64).select(F.lit(None).cast("long").alias("k"), "id").union(
            spark.range(64).select("id", "id"))
        found = heavy.reduced(nobody, "k", lambda d: d.select("k"),
                              lambda d: d.select("k").distinct())
        assert found.where("k is null").count() == 1 and found.count() == 65


def test_distinct_counts_of_months_carry_keys_alone(shop):
    """No sum travels once for each product or customer of a month."""
    text = plan(agg.monthly_sales(shop["fct_order_items"], shop["fct_orders"],
                                  shop["agg_delivery_monthly"], shop["dim_date"]))
    for key in ("product_key", "seller_key", "customer_key"):
        per_key = [x for x in text.splitlines()
                   if re.search(rf"Aggregate\(keys=\[[^\]]*{key}#", x)]
        assert per_key and not any("sum(" in x or "count(1)" in x for x in per_key)


def test_candidates_of_a_key_hold_each_column_once(shop):
    for df in (shop["int_order_reviews"], grain.persons(shop["stg_customers"],
                                                        shop["stg_orders"])):
        assert "min_by" not in plan(df)


def test_hot_month_is_written_by_more_than_one_task(spark, shop, tmp_path):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.lit(date(2018, 1, 5)).alias("order_purchase_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("customer_state"),
        F.lit("x").alias("seller_state"), F.lit("y").alias("order_status"))
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB"):
        sinks.write_by_month(rows, str(tmp_path / "m"), sinks.ORDER_LAYOUT)
    written = list((tmp_path / "m" / "purchase_month=2018-01-01").glob("*.parquet"))
    assert len(written) > 1
    assert spark.read.parquet(str(tmp_path / "m")).count() == 60_000


def test_months_are_shuffled_without_columns_that_others_determine(spark, shop):
    """Rows and types stay; what the shuffles carry is narrower."""
    for name, layout, again in (("fct_orders", sinks.ORDER_LAYOUT, facts.order_measures()),
                                ("fct_order_items", sinks.ITEM_LAYOUT, facts.item_measures())):
        whole = shop.build(name)
        spread = sinks.by_month(whole, layout, again=again)
        assert spread.drop("purchase_month").dtypes == whole.dtypes
        node = spread._jdf.queryExecution().optimizedPlan()
        while node.nodeName() != "RebalancePartitions":
            node = node.children().apply(0)
        carried = {node.output().apply(i).name() for i in range(node.output().size())}
        assert not carried & {c for step in again for c in step}
        back = spread.drop("purchase_month")
        assert whole.exceptAll(back).count() == back.exceptAll(whole).count() == 0


def test_categories_bought_are_made_once(spark, shop):
    """Buyers and deliveries of a category read the same stored pairs."""
    with settings(spark, **NO_BROADCAST):
        text = plan(agg.product_performance(shop["fct_order_items"], shop["dim_product"],
                                            shop["fct_orders"], shop.params))
    assert not re.search(r"Exchange hashpartitioning\(order_id#", text)


def test_state_of_payments_holds_a_type_once(shop):
    assert "min_by" not in plan(grain.payments_per_order(shop["stg_order_payments"]))


def test_source_rules():
    """No row-at-a-time Python, no local checkpoints, no collecting beyond verdicts.

    The text operators may use Python in tasks; for them only local checkpoints are out.
    """
    assert not any("localCheckpoint" in p.read_text() for p in PACKAGE.rglob("*.py"))
    text = {p.name: p.read_text() for p in PACKAGE.rglob("*.py") if p.parent.name != "llm"}
    whole = "\n".join(text.values())
    for banned in ("localCheckpoint", "toPandas", "F.udf", "pandas_udf", ".rdd", "foreach("):
        assert banned not in whole
    collecting = {n for n, t in text.items() if ".collect()" in t}
    # Tile boundaries, rule verdicts, the manifest with one row per source file, the folders of
    # a table, and the numbers of changed buckets.
    assert collecting == {"tiles.py", "gate.py", "build.py", "sinks.py", "versions.py"}


def joins(plan):
    """Names of the leaves and aggregates below each side of every join of a logical plan."""
    def below(node):
        name = node.nodeName()
        if name == "Aggregate" or not node.children().size():
            return [name]
        return [x for i in range(node.children().size()) for x in below(node.children().apply(i))]

    if plan.nodeName() == "Join":
        yield below(plan.left()), below(plan.right())
    for i in range(plan.children().size()):
        yield from joins(plan.children().apply(i))


def test_lines_are_reduced_before_they_meet_the_products(shop):
    bought = agg.categories_bought(shop["fct_order_items"], shop["dim_product"].select(
        "product_key", "product_category"))
    found = list(joins(bought._jdf.queryExecution().optimizedPlan()))
    assert [left for left, _ in found] == [["Aggregate"]]


def test_shuffles_of_a_written_table_are_freed(spark, tmp_path):
    """A table written from a shuffle leaves no shuffle file behind, and the setting of the
    session stays what it was."""
    made = Scratch(spark, "freed")
    spread = spark.range(0, 10_000, 1, 4).repartition(3, "id")
    tracker = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        blocks = tracker.getAllBlocks()
        return {x for i in range(blocks.size()) if (x := blocks.apply(i).name()).startswith("shuffle")}

    def left(write):
        before = shuffles()
        write()
        for _ in range(100):  # files go in the background
            if not shuffles() - before:
                return 0
            time.sleep(0.1)
        return len(shuffles() - before)

    for setting in (None, "false"):
        with settings(spark, **({FREE_KEY.replace(".", "__"): setting} if setting else {})):
            assert left(lambda: made.save(spread, "rows")) == 0
            assert spark.conf.get(FREE_KEY) == (setting or "false")
    models = Warehouse(spark, {"orders": lambda: spread}, Params(), made,
                       stored=frozenset({"raw.orders"}))
    assert left(lambda: models["raw.orders"]) == 0
    assert models["raw.orders"].count() == 10_000
    assert left(lambda: spread.write.parquet(str(tmp_path / "plain"))) > 0


def test_tables_that_store_little_are_not_sent_whole(spark, tmp_path, monkeypatch):
    """A table of many rows that compress well is shuffled; small ones, and shuffled rows that
    turn out to be small, are sent to every task as before."""
    sizes = {}
    for name, n in (("many", 200_000), ("few", 10)):
        spark.range(n).select("id", F.lit("the same long text for every row").alias("text")) \
            .repartition(1).sortWithinPartitions("id").write.option("compression", "zstd") \
            .parquet(str(tmp_path / name))
        sizes[name] = sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))
    rows = spark.range(100_000).withColumn("id", F.col("id") * 3 % 1_000)
    monkeypatch.setattr(session, "SENT_BYTES", sizes["many"] // 10)
    stored, moved = (k for k in NO_BROADCAST)
    held = {k: "1" for k in ("spark__sql__files__maxPartitionBytes",
                             "spark__sql__adaptive__advisoryPartitionSizeInBytes",
                             "spark__sql__adaptive__coalescePartitions__initialPartitionNum")}

    def joined(name):
        return plan(rows.join(spark.read.parquet(str(tmp_path / name)), "id", "left"))

    with settings(spark, **held, **{stored: "10MB", moved: "10MB"}):
        spark.conf.unset(moved.replace("__", "."))
        assert sizes["many"] < 10 << 20 and "BroadcastHashJoin" in joined("many")
        session.sized(spark, [])
        assert "BroadcastHashJoin" not in joined("many")
        assert "BroadcastHashJoin" in joined("few")
        assert spark.conf.get(moved.replace("__", ".")) == "10MB"
        session.sized(spark, [])  # a second warehouse of the session changes nothing
        assert spark.conf.get(moved.replace("__", ".")) == "10MB"
    with settings(spark, **held, **NO_BROADCAST):
        session.sized(spark, [])
        assert spark.conf.get(stored.replace("__", ".")) == "-1"


def test_lines_meet_products_where_they_are_reduced(spark):
    """Lines move once, by product; a product with half of the lines is spread, and rows are
    those of a plain join.  Lines and products without a key, and products that come twice, too."""
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(
        F.col("id") % 400)
    lines = spark.range(0, 6_000, 1, 8).select(
        key.alias("product_key"), (F.col("id") % 1_500).alias("order_id"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 50).alias("customer_key"))
    products = spark.range(300).select(
        F.col("id").alias("product_key"), F.concat(F.lit("c"), F.col("id") % 9).alias(
            "product_category")).union(spark.createDataFrame(
                [(3, "twice"), (7, "twice"), (None, "none")], "k long, c string"))
    want = lines.distinct().join(products, "product_key", "left")
    with settings(spark, **NO_BROADCAST, spark__sql__shuffle__partitions="16"):
        got = agg.with_category(lines, products)
        assert "_salt" in plan(got)
        assert got.count() == want.count()
        assert got.select(want.columns).exceptAll(want).count() == 0
        even = lines.where("product_key <> 7")
        text = plan(agg.with_category(even, products))
        assert "_salt" not in text and text.count("Exchange hashpartitioning") == 2


def test_sellers_meet_the_narrow_roll_up(spark, shop):
    """Where sellers are shuffled, the wide rows of the order fact are not moved by seller."""
    with settings(spark, **NO_BROADCAST):
        whole = shop.build("fct_orders")
        text = plan(facts.with_places(shop["int_order_items_rollup"], shop["dim_seller"]))
        wide = facts.fct_orders(
            shop["int_order_delivery"], shop["stg_customers"], shop["dim_customer"],
            shop["dim_seller"], shop["int_order_items_rollup"], shop["int_order_payments"],
            shop["int_order_reviews"])
        assert text.count("Exchange hashpartitioning(seller_key#") == 2  # roll-up and sellers
        assert "Exchange hashpartitioning(seller_key#" not in plan(whole)
        assert whole.dtypes == wide.dtypes
        assert whole.exceptAll(wide).count() == wide.exceptAll(whole).count() == 0
