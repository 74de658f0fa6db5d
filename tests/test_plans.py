"""Physical plans: pruned scans, few shuffles, split hot keys."""

import re

import pytest

from lakemart.operators import sales
from lakemart.session import materialize, materialize_by
from lakemart.sources import tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    from lakemart.plans.registry import Silver
    source = Silver(spark, FOLDER)
    tables.create_database(spark, "planned")
    for name in ("orders", "items", "products", "reviews"):
        parts = ["purchase_year_month"] if name == "orders" else []
        tables.write_table(getattr(source, name), f"planned.{name}", partition_by=parts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {n: spark.table(f"planned.{n}") for n in ("orders", "items", "products", "reviews")}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("DROP DATABASE planned CASCADE")


def test_daily_sales_reads_few_columns_and_shuffles_reduced_rows(silver):
    plan = plan_of(sales.agg_daily_sales(silver["orders"], silver["items"], silver["reviews"]))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert not any(re.search("product_id|comment|shipping|estimated", s) for s in scans)
    # Every shuffle of items is preceded by a partial aggregate, and no row is copied per distinct count.
    assert "Expand" not in plan
    for exchange, below in re.findall(r"Exchange hashpartitioning\(order_id[^\n]*\n[^\n]*?(\w+)\(?([^\n]*)", plan):
        assert exchange in ("HashAggregate", "Project", "Filter"), exchange


def test_daily_sales_from_raw_reads_no_review_text(spark):
    from lakemart.plans.registry import QUERIES, Silver
    for name in ("agg_daily_sales", "agg_category_performance", "delay_vs_score"):
        plan = plan_of(QUERIES[name](Silver(spark, FOLDER)))
        scans = re.findall(r"documents.parquet[^\n]*ReadSchema: struct<([^>]*)>", plan)
        assert all(s == "doc_id:bigint" for s in scans), (name, scans)


@pytest.mark.parametrize("name", ["reconcile_gold", "incremental_months", "customer_360"])
def test_entities_read_by_several_branches_are_cleaned_once(spark, name):
    from lakemart.plans.registry import QUERIES, Silver
    plan = plan_of(QUERIES[name](Silver(spark, FOLDER)))
    assert "lineitem.parquet" not in plan and "customer.parquet" not in plan


def test_stored_buckets_are_not_shuffled_by_their_key(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    right = spark.createDataFrame([("a", 10), ("c", 30), (None, 40)], "k string, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x, y = (materialize_by(df, "side", "k", 4) for df in (left, right))
        joined = x.groupBy("k").agg({"v": "sum"}).join(y, "k", "full")
        assert "Exchange hashpartitioning" not in plan_of(joined)
        expected = {("a", 3, 10), ("b", 3, None), ("c", None, 30), (None, 4, None), (None, None, 40)}
        assert {tuple(r) for r in joined.collect()} == expected
        assert x.count() == 4 and not [t for t in spark.catalog.listTables() if t.name.startswith("stored_")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_month_filter_prunes_partitions(silver):
    orders = tables.filter_period(silver["orders"], "1998-01", "1998-03")
    plan = plan_of(sales.agg_monthly_sales(orders, silver["items"], silver["reviews"]))
    assert re.search(r"PartitionFilters: \[isnotnull\(purchase_year_month[^\]]*1998-01", plan)


def test_refresh_reads_the_affected_months_of_orders_and_items(spark, silver):
    from lakemart.operators import upsert
    by_month = silver["items"].join(silver["orders"].select("order_id", "purchase_year_month"), "order_id")
    tables.write_table(by_month, "planned.items_by_month", partition_by=["purchase_year_month"])
    months = materialize(spark.createDataFrame([("1998-03",), (None,)], "purchase_year_month string"), "months")
    fresh = upsert.refresh_months(sales.agg_category_performance, silver["orders"], spark.table("planned.items_by_month"),
                                  silver["products"], silver["reviews"], months=months)
    lines = plan_of(fresh).splitlines()
    pruned = [above for above, line in zip(lines, lines[1:]) if "Subquery" in line and "dynamicpruning#" in line]
    assert {name for name in ("items_by_month", "orders") for line in pruned if f"planned.{name}[" in line} == {"items_by_month", "orders"}
    whole = sales.agg_category_performance(silver["orders"], silver["items"], silver["products"], silver["reviews"])
    key = ["purchase_year_month", "category", "total_revenue", "order_count"]
    assert sorted(fresh.select(*key).collect()) == sorted(whole.filter("purchase_year_month = '1998-03'").select(*key).collect())


def test_referential_rules_take_one_shuffle_of_keys(silver):
    from lakemart.operators import quality
    rules = [("items", "orders", "order_id"), ("items", "products", "product_id"), ("reviews", "orders", "order_id")]
    plan = plan_of(quality.check_references(silver, rules))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Join" not in plan
    assert len(re.findall(r"FileScan", plan)) == 4


def test_category_sales_have_no_expand(silver):
    plan = plan_of(sales.agg_category_performance(silver["orders"], silver["items"], silver["products"], silver["reviews"]))
    assert "Expand" not in plan and "SinglePartition" not in plan


def test_a_hot_order_is_split_and_keeps_its_rows(spark):
    """A third of all items belong to one order: the item-level join splits it, the marts reduce it first."""
    from pyspark.sql import functions as F

    from lakemart.operators import joins
    from lakemart.session import materialize, materialize_by

    orders = materialize(spark.range(2000).select(
        F.col("id").cast("string").alias("order_id"), F.concat(F.lit("c"), "id").alias("customer_id"),
        F.lit(None).cast("timestamp").alias("order_purchase_timestamp"), F.lit("2020-01-01").cast("date").alias("purchase_date"),
        F.lit("2020-01").alias("purchase_year_month"), F.lit("shipped").alias("order_status"),
        *[F.lit(False).alias(c) for c in ("is_delivered", "is_cancelled", "is_late_delivery")],
        *[F.lit(None).cast("int").alias(c) for c in ("delivery_duration_days", "delivery_delay_days")]), "hot-orders")
    i = F.col("id")
    items = materialize(spark.range(0, 300_000, 1, 16).select(
        F.when(i % 3 == 0, F.lit("7")).otherwise((i % 2000).cast("string")).alias("order_id"), i.cast("int").alias("order_item_id"),
        F.sha2(i.cast("string"), 256).alias("product_id"), (i % 90).cast("string").alias("seller_id"),
        *[F.lit(1).cast("decimal(18,2)").alias(c) for c in ("price", "freight_value", "total_item_amount")]), "hot-items")
    reviews = spark.createDataFrame([], "order_id string, review_score int")
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        base = joins.item_base(orders, items, reviews)
        joined = base.select("order_id", "product_id", "review_score")
        assert len(joined.collect()) == 300_000
        assert "skew=true" in plan_of(joined)
        daily = sales.agg_daily_sales(orders, items, reviews)
        row = daily.first()
        assert (row.order_count, row.items_sold, float(row.gross_revenue), row.unique_sellers) == (2000, 300_000, 300_000.0, 90)
        rows = daily.collect()
        assert len(rows) == 1 and "skew=true" not in plan_of(daily)
    finally:
        for key in small:
            spark.conf.unset(key)
