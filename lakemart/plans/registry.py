"""Named queries over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from lakemart.operators import (
    clean, customers, dedup, enrich, joins, performance, quality, ranking, sales, scale, scorecards, skew, star, upsert,
)
from lakemart.operators.rules import entity_rules
from lakemart.schemas import KEYS, SCHEMAS
from lakemart.session import materialize, materialize_by, work_path
from lakemart.functions import row_hash
from lakemart.sources import audit, files, tables
from lakemart.sources.adapters import RawEntities
from lakemart.sources.ledger import table_location
from lakemart.streaming import ingest, latest

class Silver:
    """Lazily built cleaned entities over one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.raw = RawEntities(spark, folder)

    def __getattr__(self, name: str):
        built = self._build(name)
        setattr(self, name, built)
        return built

    def _build(self, name: str):
        if name == "regions":  # state to region; a nation is a row, so there are few
            places = self.raw.table("nation").join(self.raw.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            return {r.state: r.r_name for r in places.select(F.upper(F.trim("n_name")).alias("state"), "r_name").collect()}
        if name == "products":
            return clean.clean_products(self.raw["products"], self.raw["category_translation"])
        if name == "items":
            return clean.clean_order_items(self.raw["order_items"])
        if name == "scores":
            return clean.clean_scores(self.raw["reviews"])
        if name == "translation":
            return clean.clean_translation(self.raw["category_translation"])
        return getattr(clean, f"clean_{name}")(self.raw[name])

    #: Key by which the branches of a query join or add up a stored entity.
    STORED_BY = {"orders": "order_id", "items": "order_id", "scores": "order_id", "payments": "order_id", "customers": "customer_id"}
    #: One bucket of the stored entities for so many bytes of the largest raw table, up to the partitions of a shuffle.
    BUCKET_BYTES = 4 << 20

    def store(self, *names: str) -> None:
        """Clean these entities once for a query that reads them in several branches or jobs. From here on
        the stored rows are read, of them only the columns a branch needs, and not shuffled again by their key."""
        sizes = [int(str(self.raw.table(t)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in ("orders", "lineitem")]
        most = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(most, max(self.spark.sparkContext.defaultParallelism, -(-max(sizes) // self.BUCKET_BYTES)))
        for name in names:
            df, key = getattr(self, name), self.STORED_BY.get(name)
            setattr(self, name, materialize_by(df, name, key, buckets) if key else materialize(df, name))


def publish(df: DataFrame) -> DataFrame:
    """Result types for exchange: exact decimals as doubles, times without a zone."""
    casts = {"decimal": "double", "timestamp": "timestamp_ntz"}
    return df.select(*[
        F.col(f.name).cast(casts[f.dataType.typeName()]).alias(f.name)
        if f.dataType.typeName() in casts else F.col(f.name)
        for f in df.schema
    ])


QUERIES: dict[str, Callable[[Silver], DataFrame]] = {}


def query(build: Callable[[Silver], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, folder: publish(build(Silver(spark, folder)))
    return {name: bind(build) for name, build in QUERIES.items()}


# --- cleaned entities -------------------------------------------------------------------

for _entity in ["customers", "orders", "sellers", "payments", "reviews", "geolocation", "transactions"]:
    QUERIES[f"clean_{_entity}"] = lambda s, e=_entity: getattr(s, e)


@query
def clean_order_items(s):
    return s.items


@query
def clean_products(s):
    return s.products


@query
def translate_categories(s):
    return s.translation


# --- further silver ---------------------------------------------------------------------

@query
def geolocation_by_zip(s):
    return enrich.geolocation_by_zip(s.raw["geolocation"])


@query
def order_extras(s):
    return enrich.with_order_extras(s.orders).select(
        "order_id", "purchase_year", "purchase_month", "purchase_day_of_week", "purchase_hour",
        "approval_delay_hours", "estimated_delivery_days", "carrier_handling_days")


@query
def product_bands(s):
    return enrich.with_product_bands(s.products).select(
        "product_id", "product_category_name_en", "product_weight_band", "product_size_band", "has_complete_dimensions")


@query
def review_extras(s):
    return enrich.with_review_extras(s.reviews).select(
        "review_id", "order_id", "has_review_title", "review_response_delay_days")


@query
def customer_extras(s):
    return enrich.with_customer_extras(s.customers, s.regions).select(
        "customer_id", "customer_city_key", "customer_region", "has_valid_zip", "has_valid_state")


@query
def seller_place(s):
    zips = enrich.geolocation_by_zip(s.raw["geolocation"])
    return enrich.with_seller_place(s.sellers, zips, s.regions)


@query
def payment_summary(s):
    return enrich.payment_summary(s.payments)


@query
def review_summary(s):
    return enrich.review_summary(s.reviews)


@query
def order_details(s):
    return enrich.order_details(s.orders, s.items, s.customers, s.products, s.sellers).select(
        "order_id", "order_item_id", "customer_unique_id", "customer_state", "product_category_name_en",
        "product_volume_cm3", "seller_state", "purchase_date", "order_status", "is_late_delivery", "price",
        "total_item_amount")


# --- sales ------------------------------------------------------------------------------

@query
def agg_daily_sales(s):
    return sales.agg_daily_sales(s.orders, s.items, s.scores)


@query
def agg_daily_sales_item_grain(s):
    return sales.agg_daily_sales(s.orders, s.items, s.scores, grain="item")


@query
def agg_daily_sales_all_orders(s):
    return sales.agg_daily_sales(s.orders, s.items, s.scores, include_empty_orders=True)


@query
def agg_monthly_sales(s):
    return sales.agg_monthly_sales(s.orders, s.items, s.scores)


@query
def agg_monthly_sales_item_grain(s):
    return sales.agg_monthly_sales(s.orders, s.items, s.scores, grain="item")


@query
def agg_category_performance(s):
    return sales.agg_category_performance(s.orders, s.items, s.products, s.scores)


@query
def agg_category_performance_item_grain(s):
    return sales.agg_category_performance(s.orders, s.items, s.products, s.scores, grain="item")


@query
def category_revenue_share(s):
    perf = sales.agg_category_performance(s.orders, s.items, s.products, s.scores)
    return sales.with_revenue_share(perf).select("purchase_year_month", "category", "category_revenue_share")


@query
def hourly_client_spend(s):
    return sales.hourly_client_spend(s.raw["transactions"])


# --- seller, delivery, payment, state, customer -----------------------------------------

def _seller_performance(s):
    return performance.agg_seller_performance(s.orders, s.items, s.scores)


def _stored_seller_performance(s):
    """For queries that read it more than once."""
    return materialize(_seller_performance(s), "seller-performance")


def _placed_orders(s):
    """All orders with items, also those without a customer record."""
    return performance.person_orders(s.orders, s.items, s.customers, s.scores, known_only=False)


@query
def agg_seller_performance(s):
    return _seller_performance(s)


@query
def seller_score(s):
    return performance.seller_score(_seller_performance(s))


for _grain in [["date"], ["state"], ["seller"], ["category"], ["month", "state"]]:
    QUERIES["agg_delivery_by_" + "_".join(_grain)] = lambda s, by=_grain: performance.agg_delivery_performance(
        s.orders, s.items, by, s.customers, s.products)


@query
def agg_payment_performance(s):
    return performance.agg_payment_performance(s.orders, s.payments)


@query
def agg_state_performance(s):
    return performance.agg_state_performance(s.orders, s.items, s.scores, s.customers)


@query
def agg_customer_value(s):
    return performance.agg_customer_value(s.orders, s.items, s.customers)


@query
def agg_customer_value_by_state(s):
    return performance.agg_customer_value(s.orders, s.items, s.customers, by="state")


@query
def agg_person_sales(s):
    return performance.agg_person_sales(s.orders, s.items, s.customers)


# --- star schema ------------------------------------------------------------------------

@query
def dim_date(s):
    return star.dim_date(s.orders)


@query
def dim_customer(s):
    return star.dim_customer(s.orders, s.items, s.customers, s.regions)


@query
def dim_product(s):
    return star.dim_product(s.products)


@query
def dim_seller(s):
    return star.dim_seller(s.sellers, s.regions)


@query
def dim_geography(s):
    return star.dim_geography(enrich.geolocation_by_zip(s.raw["geolocation"]), s.regions)


@query
def dim_payment_type(s):
    return star.dim_payment_type(s.payments)


@query
def fact_order_items(s):
    return star.fact_order_items(s.orders, s.items, s.scores, s.customers, s.sellers)


@query
def fact_orders(s):
    return star.fact_orders(s.orders, s.items, s.scores, s.customers)


@query
def fact_payments(s):
    return star.fact_payments(s.orders, s.payments)


@query
def fact_reviews(s):
    return star.fact_reviews(s.orders, s.reviews)


# --- customers --------------------------------------------------------------------------

@query
def customer_rfm(s):
    return customers.customer_rfm(s.orders, s.items, s.customers)


@query
def customer_rfm_tied(s):
    return customers.customer_rfm(s.orders, s.items, s.customers, ties="together")


@query
def rfm_segments(s):
    rfm = customers.customer_rfm(s.orders, s.items, s.customers)
    return rfm.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary_value").alias("monetary_value"))


@query
def customer_360(s):
    s.store("orders", "items", "customers")
    rfm = customers.customer_rfm(s.orders, s.items, s.customers)
    return customers.customer_360(s.orders, s.items, s.customers, s.products, s.payments, s.scores, rfm)


@query
def repeat_customers(s):
    return customers.customer_kpis(s.orders, s.items, s.customers)


@query
def first_versus_repeat(s):
    return customers.first_versus_repeat(s.orders, s.items, s.customers)


@query
def cohort_retention(s):
    return customers.cohort_retention(s.orders, s.items, s.customers)


@query
def category_affinity(s):
    return customers.category_affinity(s.items, s.products)


@query
def churn_risk(s):
    return customers.churn_risk(s.orders, s.items, s.customers)


# --- scorecards and dashboards ----------------------------------------------------------

@query
def seller_scorecard(s):
    perf = _stored_seller_performance(s)
    return scorecards.seller_scorecard(perf, performance.seller_score(perf))


@query
def product_scorecard(s):
    return scorecards.product_scorecard(s.orders, s.items, s.products, s.scores)


@query
def executive_kpis(s):
    return scorecards.executive_kpis(_placed_orders(s))


@query
def sales_dashboard(s):
    return scorecards.sales_dashboard(_placed_orders(s))


@query
def orders_by_status(s):
    return scorecards.orders_by_status(s.orders)


@query
def revenue_by_state(s):
    return scorecards.revenue_by_state(_placed_orders(s))


@query
def top_categories(s):
    return scorecards.top_categories(
        sales.agg_category_performance(s.orders, s.items, s.products, s.scores))


@query
def top_sellers_by_month(s):
    return scorecards.top_sellers_by_month(_seller_performance(s))


@query
def late_seller_ranking(s):
    return scorecards.late_seller_ranking(_seller_performance(s))


@query
def delay_vs_score(s):
    return scorecards.delay_vs_score(s.orders, s.scores)


@query
def delay_score_correlation(s):
    return scorecards.delay_score_correlation(s.orders, s.scores)


@query
def seller_growth(s):
    return scorecards.seller_growth(_seller_performance(s))


@query
def seller_kpis(s):
    perf = _stored_seller_performance(s)
    return scorecards.seller_kpis(perf, performance.seller_score(perf))


# --- quality ----------------------------------------------------------------------------

def _cleaned(s) -> dict[str, DataFrame]:
    return {"customers": s.customers, "orders": s.orders, "order_items": s.items, "products": s.products,
            "sellers": s.sellers, "payments": s.payments, "reviews": s.reviews}


@query
def dq_uniqueness(s):
    names = ["customers", "orders", "products", "sellers", "order_items", "payments"]
    return quality.union_all([quality.check_unique(s.raw[n], n, KEYS[n]) for n in names])


@query
def dq_referential(s):
    return quality.check_references(_cleaned(s), quality.REFERENCES)


@query
def dq_domain(s):
    rules = {n: entity_rules(n) for n in ["customers", "orders", "order_items", "payments", "reviews"]}
    rules["orders"].update(quality.status_rule())
    rules["products"] = {**entity_rules("products"), "weight_not_negative": F.col("product_weight_g") >= 0}
    return quality.union_all([quality.check_rows(s.raw[n], n, r, "domain") for n, r in rules.items()])


@query
def dq_timestamps(s):
    return quality.check_rows(s.orders, "orders", quality.time_rules(), "timestamp")


@query
def order_time_flags(s):
    flagged = quality.flag_time_violations(s.orders)
    return flagged.select("order_id", F.array_join("time_violations", ",").alias("violations"), "has_time_violation")


@query
def reject_split(s):
    _, rejected = quality.split_rejects(s.raw["order_items"], entity_rules("order_items"))
    return rejected.select("order_id", "order_item_id", "product_id", "seller_id", "price",
                           F.array_join("_validation_errors", ",").alias("errors"))


@query
def reconcile_silver(s):
    names = ["customers", "orders", "order_items", "products", "sellers", "payments", "reviews"]
    return quality.union_all([quality.reconcile(s.raw[n], entity_rules(n), KEYS[n], n) for n in names])


@query
def reconcile_gold(s):
    s.store("orders", "items", "customers", "scores")
    daily = materialize(sales.agg_daily_sales(s.orders, s.items, s.scores), "daily")
    monthly = sales.agg_monthly_sales(s.orders, s.items, s.scores)
    facts = star.fact_order_items(s.orders, s.items, s.scores, s.customers, s.sellers)
    orders = materialize(star.fact_orders(s.orders, s.items, s.scores, s.customers), "fact-orders")
    people = star.dim_customer(s.orders, s.items, s.customers, s.regions)
    placed = materialize(_placed_orders(s), "placed-orders")
    marts = {
        "executive": (scorecards.executive_kpis(placed), "total_revenue", "orders"),
        "dashboard": (scorecards.sales_dashboard(placed), "total_revenue", "orders"),
        "states": (scorecards.revenue_by_state(placed), "revenue", "orders"),
    }
    return quality.reconcile_gold(daily, monthly, facts, orders, people, marts)


# --- upsert, history, replication -------------------------------------------------------

@query
def upsert_orders(s):
    """Orders known before a date, then a late batch: open orders of its last quarter delivered, and new ones."""
    columns = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]
    orders = s.orders.select(*columns)
    bought = F.to_date("order_purchase_timestamp")
    target = orders.filter(bought < F.lit("2000-01-01"))
    arrived = F.when(F.col("order_status") == "shipped", "delivered").otherwise(F.col("order_status"))
    source = orders.filter(bought >= F.lit("1999-10-01")).withColumn("order_status", arrived)
    return upsert.upsert(target, source, ["order_id"]).withColumnRenamed("_change", "change")


@query
def incremental_months(s):
    """A category mart whose orders before 2000 are loaded, then brought up to date by month."""
    s.store("orders", "items", "products", "scores")
    late = s.orders.filter(F.col("purchase_date") >= F.lit("1999-12-15"))
    known = s.orders.filter(F.col("purchase_date") < F.lit("1999-12-15"))
    months = materialize(upsert.affected_months(late), "months")
    before = sales.agg_category_performance(known, s.items, s.products, s.scores)
    by_month = {}
    for name, df in (("orders", s.orders), ("items", s.items.join(s.orders.select("order_id", "purchase_year_month"), "order_id"))):
        by_month[name] = work_path(s.spark, f"{name}-by-month")
        tables.arrange(df, ["purchase_year_month"]).write.partitionBy("purchase_year_month").parquet(by_month[name])
    orders, items = (s.spark.read.parquet(p).withColumn("purchase_year_month", F.col("purchase_year_month").cast("string"))
                     for p in by_month.values())
    fresh = upsert.refresh_months(sales.agg_category_performance, orders, items, s.products, s.scores, months=months)
    return upsert.replace_months(before, fresh, months)


@query
def scd2_customer(s):
    seen = s.orders.select("customer_id", "order_purchase_timestamp").join(s.customers, "customer_id")
    return upsert.customer_history(seen, "customer_unique_id", "order_purchase_timestamp",
                                   ["customer_zip_code_prefix", "customer_city", "customer_state"])


@query
def replicate_orders(s):
    return scale.replicate_orders(s.raw["orders"], 3, bad_status_per_thousand=20)


@query
def replicate_items(s):
    return scale.replicate_items(s.raw["order_items"], 2, negative_price_per_thousand=5)


# --- streaming --------------------------------------------------------------------------

def _transaction_stream(s, batches: int = 3):
    """The transactions as JSON messages in files, read as a stream in about so many micro-batches."""
    messages = s.raw["transactions"].select(F.to_json(F.struct("*")).alias("value"))
    source = work_path(s.spark, "messages")
    messages.write.text(source)
    per_batch = max(1, len(s.spark.read.text(source).inputFiles()) // batches)
    stream = ingest.read_stream(s.spark, "text", {"maxFilesPerTrigger": str(per_batch)}, schema=messages.schema, path=source)
    return ingest.decode_json(stream, SCHEMAS["transactions"])


@query
def stream_bronze(s):
    out = work_path(s.spark, "bronze")
    ingest.run_available(ingest.write_stream(
        _transaction_stream(s), work_path(s.spark, "bronze-log"), path=out, trigger={"availableNow": True}))
    return s.spark.read.schema(SCHEMAS["transactions"]).parquet(out)


@query
def stream_latest(s):
    """Upserted batch by batch; then a new checkpoint reads all of it again into the same table."""
    t = _new_table(s, "latest")
    stream = _transaction_stream(s)
    for log in ("latest-log", "latest-log-again"):
        ingest.run_available(latest.stream_latest(stream, t["table"], work_path(s.spark, log), {"availableNow": True}, t["path"]))
    return _read_and_forget(s, t["table"]).drop(latest.LATEST_DATE)


@query
def stream_hourly_spend(s):
    t = _new_table(s, "spend")
    ingest.run_available(latest.stream_hourly_spend(
        _transaction_stream(s), t["table"], work_path(s.spark, "spend-log"), {"availableNow": True}, t["path"]))
    return sales.total_spend(_read_and_forget(s, t["table"]))


# --- joins, duplicates, hashes, skew ----------------------------------------------------

@query
def item_base(s):
    return joins.item_base(s.orders, s.items, s.scores).select(
        "order_id", "customer_id", "order_purchase_timestamp", "purchase_date", "purchase_year_month", "order_status",
        "is_delivered", "is_cancelled", "is_late_delivery", "delivery_duration_days", "delivery_delay_days", "order_item_id",
        "product_id", "seller_id", "price", "freight_value", "total_item_amount", "review_score")


@query
def item_categories(s):
    names = s.products.select("product_id", F.col("product_category_name_en").alias("category"))
    joined = joins.broadcast_lookup(s.items, names, ["product_id"])
    return joins.with_default(joined, "category", "unknown").select("order_id", "order_item_id", "category")


@query
def missing_orders(s):
    return joins.missing_parents(s.items, s.orders, "order_id")


@query
def exact_duplicates(s):
    """Whole rows once each, with the counts observed while they were written."""
    counts = Observation()
    unique = materialize(dedup.drop_exact_duplicates(s.raw["order_items"], counts), "unique-items")
    return unique.withColumns({name: F.lit(n) for name, n in counts.get.items()})


@query
def record_hashes(s):
    customers = s.raw["customers"]
    return customers.select("customer_id", row_hash(*customers.columns).alias("record_hash"))


@query
def customer_record_times(s):
    loaded = enrich.with_record_times(s.customers, "2002-01-01 00:00:00", ["customer_city", "customer_state"])
    return loaded.select("customer_id", "record_hash", "record_created_at", "record_updated_at")


@query
def salted_join(s):
    """Items with the state of their seller; sellers with many items are spread over tasks."""
    states = s.sellers.select("seller_id", "seller_state")
    return skew.salted_join(s.items, states, ["seller_id"], "left", share=0.002, salts=8).select(
        "order_id", "order_item_id", "seller_state")


@query
def salted_aggregate(s):
    return skew.salted_aggregate(
        s.items, ["seller_id"], {"revenue": F.sum("price"), "items": F.count("price")},
        {"revenue": F.sum("revenue"), "items": F.sum("items")}, salts=8)


@query
def daily_batches(s):
    return scale.daily_batches(s.raw["orders"], 7).groupBy("batch_number").agg(F.count(F.lit(1)).alias("orders"))


# --- files and tables -------------------------------------------------------------------

def _new_table(s, name: str) -> dict:
    """Name and place of a table of its own."""
    return {"table": f"{name}_{uuid.uuid4().hex}", "path": work_path(s.spark, name)}


def _read_and_forget(s, table: str) -> DataFrame:
    """The table's files, without leaving its names in the catalog (they stay: the location is external)."""
    s.spark.catalog.refreshTable(table)
    place, schema = table_location(s.spark, table), s.spark.table(table).schema
    for name in (table, upsert.index_table(table)):
        tables.drop_table(s.spark, name)
    return s.spark.read.schema(schema).parquet(place)


@query
def csv_reviews(s):
    """Reviews written as CSV with quotes and line breaks, read back with the declared schema and cleaned."""
    place = work_path(s.spark, "reviews")
    s.raw["reviews"].write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
                                   ignoreTrailingWhiteSpace=False).csv(place)
    return clean.clean_reviews(files.read_entity(s.spark, place, "reviews"))


@query
def orders_table(s):
    """Orders as a table partitioned by month, with the months of one year replaced."""
    t = _new_table(s, "orders_table")
    tables.write_table(s.orders, t["table"], path=t["path"], partition_by=["purchase_year_month"],
                       sort_by=["order_purchase_timestamp", "customer_id"])
    tables.overwrite_partitions(tables.filter_period(s.orders, "1998-01", "1998-12"), t["table"])
    return _read_and_forget(s, t["table"])


@query
def hourly_spend_table(s):
    """Hourly spend partitioned by hour (the hour of unreadable times is a partition too) with clients in four
    buckets, and in a second table of four buckets the spend of each client: joined bucket by bucket."""
    hourly, total = _new_table(s, "hourly_spend"), _new_table(s, "client_spend")
    spend = sales.spend_parts(s.raw["transactions"])
    tables.write_table(spend.withColumn("hour", F.date_format("transaction_hour", "yyyy-MM-dd-HH")), hourly["table"],
                       path=hourly["path"], partition_by=["hour"], bucket_by=("client", 4))
    per_client = s.spark.table(hourly["table"]).groupBy("client").agg(F.sum("transaction_count").alias("client_transactions"))
    tables.write_table(per_client, total["table"], path=total["path"], bucket_by=("client", 4))
    joined = s.spark.table(hourly["table"]).join(s.spark.table(total["table"]), "client")
    out = materialize(sales.total_spend(joined, "client_transactions"), "hourly-of-clients")
    for t in (hourly, total):
        tables.drop_table(s.spark, t["table"])
    return out


@query
def upsert_orders_table(s):
    """The upsert applied to a partitioned table: only the months it touches are rewritten."""
    t = _new_table(s, "upserted")
    columns = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "purchase_year_month"]
    orders = s.orders.select(*columns)
    bought = F.to_date("order_purchase_timestamp")
    tables.write_table(orders.filter(bought < F.lit("2000-01-01")), t["table"], path=t["path"],
                       partition_by=["purchase_year_month"])
    arrived = F.when(F.col("order_status") == "shipped", "delivered").otherwise(F.col("order_status"))
    batch = orders.filter(bought >= F.lit("1999-10-01")).withColumn("order_status", arrived)
    upsert.upsert_table(s.spark, t["table"], batch, ["order_id"])
    return _read_and_forget(s, t["table"])


@query
def batches_run_once(s):
    """Orders loaded year by year, every batch asked for twice: the audit has one successful run of each."""
    loaded, audit_name = _new_table(s, "loaded"), _new_table(s, "runs")
    years = [str(y) for y in range(1995, 2002)]
    orders = materialize(s.orders.select("order_id", F.year("order_purchase_timestamp").cast("string").alias("year")), "loaded-orders")
    tables.create_table(s.spark, loaded["table"], orders.schema, location=loaded["path"])

    def load(year):
        part = orders.filter(F.col("year") == year)
        part.write.insertInto(loaded["table"])
        return {"source_rows": part.count(), "target_rows": part.count()}

    for year in years + years:
        upsert.run_batch_once(s.spark, audit_name["table"], "load_orders", year, lambda y=year: load(y))
    in_table = s.spark.table(loaded["table"]).groupBy(F.col("year").alias("batch_id")).agg(F.count(F.lit(1)).alias("rows_in_table"))
    runs = s.spark.table(audit_name["table"]).select("job_name", "batch_id", "status", "source_rows", "target_rows")
    out = materialize(runs.join(in_table, "batch_id", "left"), "batches-run-once")
    for t in (loaded, audit_name):
        tables.drop_table(s.spark, t["table"])
    return out


@query
def bronze_load(s):
    """Customers as CSV beside lines that do not fit, loaded twice: the second time as copies under other names."""
    columns = s.raw["customers"].columns
    folders = [work_path(s.spark, "landing") for _ in range(2)]
    for folder in folders:
        s.raw["customers"].repartition(4, "customer_id").write.option("header", True).csv(folder)
    too_many = [F.col("s_suppkey").alias(columns[0]), *[F.lit("x").alias(c) for c in [*columns[1:], "extra"]]]
    s.raw.table("supplier").select(*too_many).write.mode("append").option("header", True).csv(folders[0])
    t, registry = _new_table(s, "raw_customers"), _new_table(s, "source_files")
    for batch, folder in zip(("first", "second"), folders):
        files.load_new_files(s.spark, folder, "customers", t["table"], registry["table"], batch)
    by = ["_batch_id", files.MALFORMED]
    out = materialize(s.spark.table(t["table"]).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("_is_valid").alias("valid_rows"),
        F.count_distinct("_record_hash").alias("records")).withColumnsRenamed({"_batch_id": "batch_id", files.MALFORMED: "malformed"}), "bronze-load")
    for name in (t, registry):
        tables.drop_table(s.spark, name["table"])
    return out


@query
def quality_results(s):
    """Checks appended to the result table under a run."""
    t = _new_table(s, "quality")
    for run, found in (("run-1", dq_uniqueness(s)), ("run-2", dq_timestamps(s))):
        quality.append_results(quality.stamp(found, run, "2002-01-01 00:00:00"), t["table"])
    out = materialize(s.spark.table(t["table"]).drop("checked_at", "details"), "quality-results")
    tables.drop_table(s.spark, t["table"])
    return out


@query
def replaced_table(s):
    """A typed empty table in a namespace of its own, replaced whole by sellers with the time of processing."""
    database = f"shop_{uuid.uuid4().hex}"
    tables.create_database(s.spark, database)
    t = f"{database}.sellers"
    tables.create_table(s.spark, t, s.sellers.schema)
    empty = s.spark.table(t).count()
    written = tables.write_table(s.sellers, t, with_processed_at=True)["target_rows"]
    recent = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("processed_at")) < 3600
    out = materialize(s.spark.table(t).select("seller_id", "seller_state", recent.alias("processed_now"), F.lit(empty).alias("rows_before"),
                                              F.lit(written).alias("rows_written")), "replaced")
    s.spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


@query
def sql_model(s):
    """A SQL text kept as a table."""
    view, t = f"raw_transactions_{uuid.uuid4().hex}", f"model_{uuid.uuid4().hex}"
    s.raw["transactions"].createOrReplaceTempView(view)
    tables.materialize_sql(s.spark, f"SELECT upper(client) AS client_name, count(*) AS transactions, max(prix) AS highest_price FROM {view} GROUP BY 1", t)
    out = materialize(s.spark.table(t), "sql-model")
    tables.drop_table(s.spark, t)
    s.spark.catalog.dropTempView(view)
    return out


@query
def sorted_daily_sales(s):
    """Daily sales written in order of the date; the position is that of the row in the files."""
    t = _new_table(s, "daily_sorted")
    daily = sales.agg_daily_sales(s.orders, s.items, s.scores).select("purchase_date", "order_count")
    tables.write_table(daily, t["table"], path=t["path"], global_order=["purchase_date"])
    written = s.spark.table(t["table"]).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    # One row per day: the calendar bounds this window.
    position = F.row_number().over(Window.orderBy("file", "row")).cast("bigint")
    out = materialize(written.select("purchase_date", "order_count", position.alias("position")), "sorted-days")
    tables.drop_table(s.spark, t["table"])
    return out


@query
def compacted_payments(s):
    """Payments in many small files, rewritten in few, sorted by value."""
    many, few = work_path(s.spark, "many-files"), work_path(s.spark, "few-files")
    s.payments.select("order_id", "payment_sequential", "payment_value").repartition(16).write.parquet(many)
    number = tables.compact_folder(s.spark, many, few, sort_by=["payment_value"])
    files_now = F.col("_metadata.file_name")
    return s.spark.read.parquet(few).agg(
        F.count(F.lit(1)).alias("payments"), F.sum("payment_value").alias("paid"),
        (F.count_distinct(files_now) <= number).alias("as_few_files_as_said"))


@query
def layout_comparison(s):
    """One month from a plain and from a partitioned layout: the same rows."""
    plain, parts = _new_table(s, "plain"), _new_table(s, "by_month")
    tables.write_table(s.orders, plain["table"], path=plain["path"])
    tables.write_table(s.orders, parts["table"], path=parts["path"], partition_by=["purchase_year_month"])
    found = [tables.filter_period(s.spark.table(t["table"]), "1998-03", "1998-03").agg(
        F.lit(name).alias("layout"), F.count(F.lit(1)).alias("orders"), F.max("order_purchase_timestamp").alias("latest"))
        for name, t in (("plain", plain), ("by month", parts))]
    out = materialize(quality.union_all(found), "layouts")
    for t in (plain, parts):
        tables.drop_table(s.spark, t["table"])
    return out


@query
def order_freshness(s):
    return audit.freshness(s.orders, "order_purchase_timestamp", "2001-08-01 12:00:00", 24.0)


@query
def load_anomalies(s):
    """Orders loaded year by year under the run audit, and the runs whose row count left the one before by over a tenth."""
    t = _new_table(s, "year_runs")
    per_year = {r.year: r.n for r in s.orders.groupBy(F.year("order_purchase_timestamp").alias("year")).agg(F.count(F.lit(1)).alias("n")).collect()}
    for year in sorted(per_year):
        with audit.run_audit(s.spark, t["table"], "load_year", str(year)) as run:
            run["target_rows"] = per_year[year]
    out = materialize(audit.row_count_changes(s.spark.table(t["table"]), 0.1).select(
        "batch_id", "target_rows", "previous_rows", "relative_change"), "load-anomalies")
    tables.drop_table(s.spark, t["table"])
    return out


@query
def order_value_ranks(s):
    """Rank of every order by its total among all orders: one group, cut into ranges."""
    totals = materialize(joins.item_totals(s.items).select("order_id", "total"), "order-totals")
    below = ranking.value_positions(totals, [], "total").select("total", (F.col("rows_below") + 1).alias("value_rank"))
    return totals.join(below, "total")
