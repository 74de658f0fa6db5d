"""Files and streams to layered tables, end to end."""

import json

from pyspark.sql import functions as F

from lakemart.operators import quality
from lakemart.operators.rules import entity_rules
from lakemart.plans import pipeline
from lakemart.schemas import KEYS, SCHEMAS
from lakemart.sources import files
from lakemart.sources.adapters import RawEntities
from lakemart.streaming import ingest

FOLDER = "/root/testdata/sf0.001"


def test_files_to_gold(spark, tmp_path):
    raw = RawEntities(spark, FOLDER)
    for entity in [*pipeline.SORT_KEYS, "category_translation"]:
        raw[entity].coalesce(1).write.option("header", True).option("escape", '"').csv(f"{tmp_path}/in/{entity}.csv")
    (tmp_path / "in" / "orders.csv" / "extra.csv").write_text(
        ",".join(SCHEMAS["orders"].fieldNames()) + "\nx1,c1,shipped,1998-03-04 00:00:00,,,,,too,many\n")
    bronze = pipeline.load_bronze(spark, f"{tmp_path}/in", "monday")
    assert bronze["orders"] == {"source_rows": 1501, "malformed_rows": 1, "target_rows": 1500,
                                "rejected_rows": 1 + raw["orders"].filter("order_purchase_timestamp = 'not a date'").count()}
    assert pipeline.load_bronze(spark, f"{tmp_path}/in", "monday") == {}  # this batch is done
    copy = next((tmp_path / "in" / "orders.csv").glob("part-*.csv"))
    (copy.parent / "renamed.csv").write_bytes(copy.read_bytes())
    assert {c["source_rows"] for c in pipeline.load_bronze(spark, f"{tmp_path}/in", "tuesday").values()} == {0}
    assert files.fitting_rows(spark, "bronze.orders", "orders").count() == 1500
    bad = files.malformed_rows(spark, "bronze.orders").first()
    assert bad.raw_text.startswith("x1,c1") and bad._source_file.endswith("extra.csv") and bad._batch_id == "monday"
    silver = pipeline.build_silver(spark)
    assert silver["geolocation"]["rejected_rows"] > 0
    for entity in KEYS.keys() & pipeline.SORT_KEYS.keys():
        row = quality.reconcile(raw[entity], entity_rules(entity), KEYS[entity], entity).first()
        assert silver[entity]["target_rows"] == row.target_rows, entity
        assert silver[entity]["rejected_rows"] == row.rejected_rows, entity
    gold = pipeline.build_gold(spark)
    again = pipeline.build_gold(spark, location=f"{tmp_path}/gold")
    assert {k: v["target_rows"] for k, v in gold.items()} == {k: v["target_rows"] for k, v in again.items()}
    # Files and table frames give the same marts.
    items = spark.table("silver.order_items").agg(F.sum("price")).first()[0]
    kept = spark.table("silver.order_items").join(spark.table("silver.orders"), "order_id")
    daily = spark.table("gold.agg_daily_sales").agg(F.sum("gross_revenue")).first()[0]
    assert daily == kept.agg(F.sum("price")).first()[0] <= items
    assert spark.table("silver.orders").filter("purchase_year_month = '1998-03'").inputFiles()
    runs = spark.table("governance.pipeline_runs")
    # Two batches of nine raw tables, eight cleaned ones with their checks, three marts twice.
    assert runs.filter("status = 'succeeded'").count() == 2 * 9 + 8 + 1 + 3 + 3
    written = spark.table("governance.data_quality_results")
    assert {(r.rule_type, r["count"]) for r in written.groupBy("rule_type").count().collect()} == \
        {("uniqueness", 7), ("referential", 6), ("timestamp", 5)}
    assert written.filter("rule_type = 'uniqueness' and status = 'failed'").isEmpty()
    results = quality.stamp(quality.check_unique(spark.table("silver.orders"), "orders", ["order_id"]), "r", "2020-01-01")
    for _ in range(2):
        quality.append_results(results, "governance.data_quality_results")
    assert spark.table("governance.data_quality_results").count() == 18 + 2
    rates = quality.check_reject_rate(quality.reconcile(
        raw["reviews"], entity_rules("reviews"), KEYS["reviews"], "reviews"), 5.0).first()
    assert rates.status == "failed" and rates.rejected_percentage > 50


def test_stream_to_silver(spark, tmp_path):
    keys = SCHEMAS["transactions"].fieldNames()
    rows = [("1", "ana", "x", 1.0, "2024-01-01 10:05:00"), ("1", "ana", "x", 2.0, "2024-01-01 11:05:00")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("\n".join(json.dumps(dict(zip(keys, r))) for r in rows))
    ingest.run_available(pipeline.start_bronze(
        spark, "text", {}, f"{tmp_path}/log", path=f"{tmp_path}/in", from_start=True, trigger={"availableNow": True}))
    assert pipeline.build_transactions(spark) == {"target_rows": 1}
    assert pipeline.build_hourly_spend(spark) == {"target_rows": 2}
    one = spark.table("silver.hourly_client_spend").filter("hour = '2024-01-01-11'")
    assert "PartitionFilters: [isnotnull(hour" in one._jdf.queryExecution().executedPlan().toString()
    assert float(one.first().total_spending) == 2.0
