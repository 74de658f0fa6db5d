import datetime
import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakemart.operators import quality, scale, upsert
from lakemart.schemas import SCHEMAS
from lakemart.sources import audit, files, tables
from tests.test_clean import frame


@pytest.fixture
def db(spark):
    name = "shop"
    tables.create_database(spark, name)
    yield name
    for t in spark.catalog.listTables(name):
        tables.drop_table(spark, f"{name}.{t.name}")


def sample(spark):
    return spark.createDataFrame(
        [("1", "2020-01", 5), ("2", "2020-01", 3), ("3", "2020-02", 9)], "id string, purchase_year_month string, v int")


def test_write_and_replace(spark, db):
    counts = tables.write_table(sample(spark), f"{db}.t", partition_by=["purchase_year_month"], sort_by=["v"])
    assert counts == {"target_rows": 3} and tables.read_table(spark, f"{db}.t").count() == 3
    assert tables.partition_columns(spark, f"{db}.t") == ["purchase_year_month"]
    tables.overwrite_partitions(sample(spark).filter("id = '2'"), f"{db}.t")
    assert sorted(r.id for r in tables.read_table(spark, f"{db}.t").collect()) == ["2", "3"]
    tables.write_table(sample(spark).filter("id = '3'"), f"{db}.t", partition_by=["purchase_year_month"])
    assert tables.read_table(spark, f"{db}.t").count() == 1  # whole table replaced
    tables.drop_table(spark, f"{db}.t")
    assert not spark.catalog.tableExists(f"{db}.t")


def test_partition_filter_reaches_the_scan(spark, db):
    tables.write_table(sample(spark), f"{db}.p", partition_by=["purchase_year_month"])
    part = tables.filter_period(tables.read_table(spark, f"{db}.p"), "2020-02", "2020-03")
    assert "PartitionFilters: [isnotnull(purchase_year_month" in part._jdf.queryExecution().executedPlan().toString()
    assert part.count() == 1


def test_bucketed_table_joins_without_a_shuffle(spark, db):
    for name in ("b1", "b2"):
        tables.write_table(sample(spark), f"{db}.{name}", bucket_by=("id", 4))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tables.read_table(spark, f"{db}.b1").join(tables.read_table(spark, f"{db}.b2"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_location_ddl_and_sql_model(spark, db, tmp_path):
    place = str(tmp_path / "gold")
    tables.write_table(sample(spark), f"{db}.g", path=place, with_processed_at=True)
    assert os.path.isdir(place) and "processed_at" in tables.read_table(spark, f"{db}.g").columns
    tables.create_table(spark, f"{db}.e", SCHEMAS["transactions"])
    tables.create_table(spark, f"{db}.e", SCHEMAS["transactions"])
    assert tables.read_table(spark, f"{db}.e").schema == SCHEMAS["transactions"]
    assert tables.materialize_sql(spark, f"SELECT sum(v) AS s FROM {db}.g", f"{db}.m") == {"target_rows": 1}


def test_compaction_sorts_no_more_than_a_bounded_part_in_one_task(spark, tmp_path):
    src, out = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(20000).selectExpr("CAST(id AS STRING) AS name", "CAST((id * 7919) % 20011 AS DECIMAL(18,2)) AS v").repartition(5).write.parquet(src)
    number = tables.compact_folder(spark, src, out, sort_by=["v"], sort_bytes=200_000)
    # A row takes 48 bytes and the four or five of its name at least.
    assert 5 <= number <= 7
    per_file = spark.read.parquet(out).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("lo").collect()
    assert len(per_file) <= number and sum(r.n for r in per_file) == 20000
    assert all(a.hi <= b.lo for a, b in zip(per_file, per_file[1:])) and max(r.n for r in per_file) < 10000


def test_compaction(spark, db, tmp_path):
    src, out = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(1000).repartition(20).write.parquet(src)
    assert tables.compact_folder(spark, src, out, sort_by=["id"]) == 1
    assert spark.read.parquet(out).agg(F.sum("id")).first()[0] == 499500
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 1
    tables.write_table(sample(spark), f"{db}.c", partition_by=["purchase_year_month"])
    tables.compact_partitions(spark, f"{db}.c", F.col("purchase_year_month") == "2020-01", ["v"])
    assert sorted(r.id for r in tables.read_table(spark, f"{db}.c").collect()) == ["1", "2", "3"]


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_changes_and_record_times(spark):
    ddl = "id string, v string, record_created_at timestamp, record_updated_at timestamp"
    old, new = datetime.datetime(2020, 1, 1), datetime.datetime(2021, 1, 1)
    target = spark.createDataFrame([("1", "a", old, old), ("2", "b", old, old), ("3", None, old, old)], ddl)
    source = spark.createDataFrame([("2", "B", new, new), ("3", None, new, new), ("4", "d", new, new)], ddl)
    out = {r.id: r for r in upsert.upsert(target, source, ["id"]).collect()}
    assert {k: r._change for k, r in out.items()} == {"1": "unchanged", "2": "update", "3": "unchanged", "4": "insert"}
    assert (out["2"].v, out["2"].record_created_at, out["2"].record_updated_at) == ("B", old, new)
    assert out["3"].record_updated_at == old and out["4"].record_created_at == new
    again = upsert.upsert(upsert.upsert(target, source, ["id"]).drop("_change"), source, ["id"])
    assert {r._change for r in again.collect()} == {"unchanged"}


versions = st.dictionaries(st.sampled_from("abcd"), st.one_of(st.none(), st.integers(0, 2)), max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(versions, versions)
def test_upsert_twice_is_upsert_once(spark, old, new):
    target = spark.createDataFrame(list(old.items()), "id string, v int")
    source = spark.createDataFrame(list(new.items()), "id string, v int")
    once = upsert.upsert(target, source, ["id"])
    twice = upsert.upsert(once.drop("_change"), source, ["id"])
    assert {(r.id, r.v) for r in once.collect()} == {(k, v) for k, v in {**old, **new}.items()}
    assert {(r.id, r.v, r._change) for r in twice.collect()} == {(k, v, "unchanged") for k, v in {**old, **new}.items()}


def test_upsert_table_moves_rows_between_partitions(spark, db):
    t = f"{db}.u"
    tables.write_table(sample(spark), t, partition_by=["purchase_year_month"])
    change = spark.createDataFrame([("3", "2020-01", 9), ("2", "2020-01", 4), ("9", "2020-03", 1)],
                                   "id string, purchase_year_month string, v int")
    counts = upsert.upsert_table(spark, t, change, ["id"])
    want = [("1", "2020-01", 5), ("2", "2020-01", 4), ("3", "2020-01", 9), ("9", "2020-03", 1)]
    assert rows(spark.table(t), "id", "purchase_year_month", "v") == want
    assert (counts["inserted_rows"], counts["updated_rows"]) == (1, 2)
    again = upsert.upsert_table(spark, t, change, ["id"])
    assert (again["inserted_rows"], again["updated_rows"]) == (0, 0)
    assert rows(spark.table(t), "id", "purchase_year_month", "v") == want


def test_batch_runs_once_and_errors_are_recorded(spark, db):
    runs, calls = f"{db}.runs", []

    def job():
        calls.append(1)
        return {"source_rows": 10, "target_rows": 9}

    assert upsert.run_batch_once(spark, runs, "load", "b1", job)
    assert not upsert.run_batch_once(spark, runs, "load", "b1", job)
    with pytest.raises(ZeroDivisionError):
        upsert.run_batch_once(spark, runs, "load", "b2", lambda: 1 / 0)
    assert not audit.already_done(spark, runs, "load", "b2")
    assert upsert.run_batch_once(spark, runs, "load", "b2", lambda: {"target_rows": 90})
    saved = {(r.batch_id, r.status): r for r in spark.table(runs).collect()}
    assert saved["b1", "succeeded"].source_rows == 10 and "division" in saved["b2", "failed"].error_message
    assert len(calls) == 1
    assert [r.relative_change for r in audit.row_count_changes(spark.table(runs)).collect()] == [9.0]


def test_freshness(spark):
    df = spark.createDataFrame([(datetime.datetime(2020, 1, 1, 6),)], "ts timestamp")
    assert audit.freshness(df, "ts", "2020-01-01 18:00:00").first().is_fresh
    assert not audit.freshness(df, "ts", "2020-01-03 06:00:01").first().is_fresh
    assert not audit.freshness(df.limit(0), "ts", "2020-01-01 00:00:00").first().is_fresh


def test_month_refresh_equals_full(spark):
    orders = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b")], "order_id string, purchase_year_month string")
    mart = lambda o: o.groupBy("purchase_year_month").count()
    before = mart(orders.filter("order_id <> '2'"))
    months = upsert.affected_months(orders.filter("order_id = '2'"))
    out = upsert.replace_months(before, upsert.refresh_months(mart, orders, months=months), months)
    assert rows(out, "purchase_year_month", "count") == [("a", 2), ("b", 1)]


CSV = 'review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n'


def test_csv_with_line_break_and_bad_rows(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(CSV + 'r1,o1,5,"say ""hi""","two\nlines",,\nr2,o2,five,,,,\n')
    df = files.read_entity(spark, str(path), "reviews", keep_malformed=True)
    good, bad = files.split_malformed(df)
    row = good.first()
    assert (row.review_comment_title, row.review_comment_message) == ('say "hi"', "two\nlines")
    assert [r.review_id for r in bad.collect()] == ["r2"]
    assert files.read_entity(spark, str(path), "reviews").filter("review_id = 'r2'").first().review_score is None


def test_bronze_columns_and_file_report(spark, tmp_path):
    head = ",".join(SCHEMAS["sellers"].fieldNames())
    (tmp_path / "a.csv").write_text(f"{head}\n1,0,x,sp\n2,0,y,sp\n")
    (tmp_path / "b.csv").write_text(f"{head}\n1,0,x,sp\n2,0,y,sp\n")
    (tmp_path / "c.csv").write_text("wrong,header\n1,2\n")
    (tmp_path / "d.csv").write_text("")
    report = files.source_file_report(spark, str(tmp_path), SCHEMAS["sellers"])
    got = {r.file_path[-5:]: r for r in report.collect()}
    assert [got[k].data_rows for k in ("a.csv", "b.csv", "d.csv")] == [2, 2, 0]
    assert [got[k].has_expected_columns for k in ("a.csv", "c.csv")] == [True, False]
    assert got["a.csv"].fingerprint == got["b.csv"].fingerprint != got["c.csv"].fingerprint
    assert not got["d.csv"].is_not_empty
    left = files.new_files(report, report.filter(F.col("file_path").endswith("a.csv")))
    assert sorted(r.file_path[-5:] for r in left.collect()) == ["c.csv", "d.csv"]
    raw = files.read_entity(spark, str(tmp_path / "a.csv"), "sellers")
    row = files.with_bronze_columns(raw, "shop", "b7", {"state_present": F.col("seller_state").isNotNull()}).first()
    assert row._source_file.endswith("a.csv") and row._batch_id == "b7" and row._is_valid and len(row._record_hash) == 64


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", -1)], "k string, v int")
    out = {r.rule_name: r for r in quality.check_rows(df, "t", {"low": F.col("v") >= 0, "k": F.col("k").isNotNull()}, "domain").collect()}
    assert (out["low"].rows_failed, out["low"].status, out["k"].status) == (2, "failed", "passed")
    unique = quality.stamp(quality.check_unique(df, "t", ["k"]), "r1", datetime.datetime(2020, 1, 1)).first()
    assert (unique.rows_failed, unique.run_id) == (1, "r1")
    empty = quality.check_unique(df.limit(0), "t", ["k"]).first()
    assert (empty.rows_checked, empty.status) == (0, "passed")


def test_compare_totals_finds_a_cent(spark):
    a = spark.createDataFrame([(0.1,), (0.2,)], "v double").select(F.col("v").cast("decimal(18,2)").alias("v"))
    b = spark.createDataFrame([(0.31,)], "v double").select(F.col("v").cast("decimal(18,2)").alias("v"))
    row = quality.compare_totals("x", a, F.sum("v"), b, F.sum("v")).first()
    assert row.status == "failed" and float(row.difference) == -0.01


def test_replication_keeps_references(spark):
    orders = frame(spark, "orders", [{"order_id": "1", "customer_id": "c", "order_status": "shipped",
                                      "order_purchase_timestamp": "2020-02-29 10:11:12", "order_approved_at": "broken"}])
    items = frame(spark, "order_items", [{"order_id": "1", "order_item_id": 1, "price": 2.0, "freight_value": 1.0}])
    o = {r.order_id: r for r in scale.replicate_orders(orders, 3, bad_status_per_thousand=1000).collect()}
    assert set(o) == {"1", "1-1", "1-2"} and o["1-1"].order_purchase_timestamp == "2021-02-28 10:11:12"
    assert o["1-1"].order_approved_at == "broken" and (o["1"].order_status, o["1-2"].order_status) == ("shipped", "???")
    i = {r.order_id: r.price for r in scale.replicate_items(items, 3, negative_price_per_thousand=1000).collect()}
    assert set(i) == set(o) and (i["1"], i["1-1"]) == (2.0, -2.0)
    people = frame(spark, "customers", [{"customer_id": "c", "customer_unique_id": "p"}])
    assert {r.customer_id for r in scale.replicate_customers(people, 3).collect()} == {r.customer_id for r in o.values()}
    batches = scale.daily_batches(spark.range(100).select(F.col("id").cast("string").alias("order_id")), 4)
    assert {r.batch_number for r in batches.collect()} == {0, 1, 2, 3}


def test_work_files_can_be_cleared(spark):
    from lakemart.plans.registry import all_queries
    from lakemart.session import _handed_out, clear_work, shared_folder
    folder = shared_folder(spark).removeprefix("file:")
    clear_work(spark)
    before = set(os.listdir(folder))
    assert all_queries()["order_value_ranks"](spark, "/root/testdata/sf0.001").collect()
    made = set(os.listdir(folder)) - before
    assert made and clear_work(spark) >= len(made)
    assert set(os.listdir(folder)) == before and not _handed_out
