"""Whole jobs: files or streams in, layered tables out.

Layers are databases. Every job goes through the run audit and returns the row counts taken
while writing, so nothing is computed a second time to be counted.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.operators import clean, quality, sales
from lakemart.operators.rules import entity_rules
from lakemart.operators.upsert import run_batch_once
from lakemart.schemas import KEYS, SCHEMAS
from lakemart.session import materialize
from lakemart.sources import files, tables
from lakemart.sources.audit import run_audit
from lakemart.streaming import ingest, latest

#: Tables read mostly by one attribute are sorted by it first; all are sorted by their keys.
SORTED_BY = {"customers": "customer_state", "sellers": "seller_state", "orders": "order_purchase_timestamp"}
SORT_KEYS = {e: [*([SORTED_BY[e]] if e in SORTED_BY else []), *k] for e, k in KEYS.items() if e not in ("transactions", "category_translation")}
SORT_KEYS["geolocation"] = ["state", "zip_code_prefix"]
ORDER_PARTITION = "purchase_year_month"
RUNS, QUALITY, FILES = "governance.pipeline_runs", "governance.data_quality_results", "governance.source_files"


def clean_entity(entity: str, raw: DataFrame, translation: DataFrame | None = None) -> DataFrame:
    if entity == "products":
        return clean.clean_products(raw, translation)
    return getattr(clean, f"clean_{entity}")(raw)


def load_bronze(spark: SparkSession, folder: str, batch_id: str, bronze: str = "bronze", runs: str = RUNS,
                registry: str = FILES, file_names: dict[str, str] | None = None) -> dict[str, dict]:
    """New CSV files of a folder to raw tables with technical columns, each batch and entity once.

    ``file_names`` maps entities to files or folders where they are not called ``<entity>.csv``.
    """
    names = file_names or {}
    for name in (bronze, runs.split(".")[0], registry.split(".")[0]):
        tables.create_database(spark, name)
    counts: dict[str, dict] = {}
    for entity in [*SORT_KEYS, "category_translation"]:
        def load(e=entity):
            counts[e] = files.load_new_files(spark, f"{folder}/{names.get(e, e + '.csv')}", e, f"{bronze}.{e}", registry, batch_id)
            return counts[e]
        run_batch_once(spark, runs, f"bronze_{entity}", batch_id, load)
    return counts


def build_silver(spark: SparkSession, bronze: str = "bronze", database: str = "silver", runs: str = RUNS,
                 results: str = QUALITY, fmt: str = "parquet") -> dict[str, dict]:
    """Raw tables to cleaned tables, the category names and the rejected rows, then the quality checks."""
    for name in (database, runs.split(".")[0]):
        tables.create_database(spark, name)

    def raw(entity):
        return files.fitting_rows(spark, f"{bronze}.{entity}", entity)

    counts = {}
    for entity, sort_by in SORT_KEYS.items():
        with run_audit(spark, runs, f"silver_{entity}") as run:
            source = raw(entity)
            translation = raw("category_translation") if entity == "products" else None
            parts = [ORDER_PARTITION] if entity == "orders" else []
            run.update(tables.write_table(clean_entity(entity, source, translation), f"{database}.{entity}", fmt,
                                          parts, sort_by, with_processed_at=True))
            _, rejected = quality.split_rejects(source, entity_rules(entity))
            lost = tables.write_table(rejected, f"{database}.{entity}_rejected", fmt)
            run["rejected_rows"] = lost["target_rows"]
            counts[entity] = dict(run)
    tables.write_table(clean.clean_translation(raw("category_translation")), f"{database}.product_categories", fmt)
    with run_audit(spark, runs, "silver_quality") as run:
        run["target_rows"] = check_silver(spark, database, results, run["run_id"])
    return counts


def check_silver(spark: SparkSession, database: str = "silver", results: str = QUALITY, run_id: str = "manual") -> int:
    """Uniqueness, references, order of times and freshness of the cleaned tables to the result table."""
    tables.create_database(spark, results.split(".")[0])
    silver = {e: tables.read_table(spark, f"{database}.{e}") for e in SORT_KEYS}
    found = quality.union_all([
        *[quality.check_unique(silver[e], e, KEYS[e]) for e in SORT_KEYS if e in KEYS],
        quality.check_references(silver, quality.REFERENCES),
        quality.check_rows(silver["orders"], "orders", quality.time_rules(), "timestamp")])
    stored = materialize(found, "quality-results")
    quality.append_results(quality.stamp(stored, run_id, datetime.datetime.now()), results)
    return stored.count()


def build_gold(spark: SparkSession, silver: str = "silver", gold: str = "gold", runs: str = RUNS,
               grain: str = "order", fmt: str = "parquet", location: str | None = None) -> dict[str, dict]:
    """The three sales marts from cleaned tables; small results, so each is written sorted in one file."""
    for name in (gold, runs.split(".")[0]):
        tables.create_database(spark, name)
    orders, items, products, reviews = (
        tables.read_table(spark, f"{silver}.{t}") for t in ("orders", "order_items", "products", "reviews"))
    marts = {
        "agg_daily_sales": (sales.agg_daily_sales(orders, items, reviews, grain), ["purchase_date"]),
        "agg_monthly_sales": (sales.agg_monthly_sales(orders, items, reviews, grain), ["purchase_year_month"]),
        "agg_category_performance": (sales.with_revenue_share(sales.agg_category_performance(
            orders, items, products, reviews, grain)), ["purchase_year_month", "category"]),
    }
    counts = {}
    for name, (mart, order) in marts.items():
        with run_audit(spark, runs, name) as run:
            place = f"{location}/{name}" if location else None
            run.update(tables.write_table(mart, f"{gold}.{name}", fmt, global_order=order, path=place,
                                          with_processed_at=True))
            counts[name] = dict(run)
    return counts


def start_bronze(spark: SparkSession, fmt: str, options: dict[str, str], checkpoint: str,
                 table: str = "bronze.transactions", from_start: bool = False, trigger: dict | None = None,
                 schema=None, path: str | None = None) -> StreamingQuery:
    """Messages to the typed, append-only transactions table."""
    tables.create_database(spark, table.split(".")[0])
    tables.create_table(spark, table, SCHEMAS["transactions"])
    stream = ingest.read_stream(spark, fmt, options, schema, path, from_start)
    return ingest.write_stream(ingest.decode_json(stream, SCHEMAS["transactions"]), checkpoint, table=table, trigger=trigger)


def build_transactions(spark: SparkSession, bronze: str = "bronze.transactions", target: str = "silver.transactions",
                       fmt: str = "parquet") -> dict:
    """Latest row per transaction, as a full replacement."""
    tables.create_database(spark, target.split(".")[0])
    return tables.write_table(clean.clean_transactions(tables.read_table(spark, bronze)), target, fmt,
                              with_processed_at=True)


def start_latest(spark: SparkSession, fmt: str, options: dict[str, str], checkpoint: str, table: str = "silver.transactions_live",
                 from_start: bool = False, trigger: dict | None = None, schema=None, path: str | None = None) -> StreamingQuery:
    """Messages to the table of latest transactions, kept up to date by every micro-batch."""
    tables.create_database(spark, table.split(".")[0])
    stream = ingest.read_stream(spark, fmt, options, schema, path, from_start)
    return latest.stream_latest(ingest.decode_json(stream, SCHEMAS["transactions"]), table, checkpoint, trigger)


def build_hourly_spend(spark: SparkSession, bronze: str = "bronze.transactions",
                       target: str = "silver.hourly_client_spend", buckets: int = 4) -> dict:
    """Hourly spend per client, partitioned by hour and bucketed by client."""
    tables.create_database(spark, target.split(".")[0])
    hourly = sales.hourly_client_spend(tables.read_table(spark, bronze))
    named = hourly.withColumn("hour", F.date_format("transaction_hour", "yyyy-MM-dd-HH"))
    return tables.write_table(named, target, partition_by=["hour"], bucket_by=("client", buckets))
