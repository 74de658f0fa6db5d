"""Upserts into partitions with null, quoted and emptied values; what is read, and what a stop leaves behind."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest

from lakemart.operators import upsert
from lakemart.sources.ledger import Ledger, table_location
from lakemart.sources.tables import write_table

SCHEMA = "id long, v string, part string"


@pytest.fixture
def table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS upserts")
    rows = [(1, "a", None), (2, "b", None), (3, "c", "2020-01"), (5, "e", "it's")]
    write_table(spark.createDataFrame(rows, SCHEMA), "upserts.t", partition_by=["part"])
    yield "upserts.t"
    for name in ("t", "t_keys"):
        spark.sql(f"DROP TABLE IF EXISTS upserts.{name}")


def read(spark, table):
    return sorted((r.id, r.v, r.part) for r in spark.table(table).select("id", "v", "part").collect())


def test_null_partition_keeps_its_rows(spark, table):
    upsert.upsert_table(spark, table, spark.createDataFrame([(4, "d", None)], SCHEMA), ["id"])
    assert read(spark, table) == [(1, "a", None), (2, "b", None), (3, "c", "2020-01"), (4, "d", None), (5, "e", "it's")]


def test_quoted_partition_is_emptied_and_a_broken_run_can_be_repeated(spark, table, monkeypatch):
    source = spark.createDataFrame([(5, "e", "2020-01")], SCHEMA)
    with monkeypatch.context() as broken:
        broken.setattr(upsert, "overwrite_partitions", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            upsert.upsert_table(spark, table, source, ["id"])
    for _ in range(2):
        upsert.upsert_table(spark, table, source, ["id"])
        assert read(spark, table) == [(1, "a", None), (2, "b", None), (3, "c", "2020-01"), (5, "e", "2020-01")]
        assert spark.read.parquet(table_location(spark, table)).count() == 4


def test_null_partition_is_emptied(spark, table):
    upsert.upsert_table(spark, table, spark.createDataFrame([(1, "a", "2020-01"), (2, "b", "2020-01")], SCHEMA), ["id"])
    assert read(spark, table) == [(1, "a", "2020-01"), (2, "b", "2020-01"), (3, "c", "2020-01"), (5, "e", "it's")]
    upsert.upsert_table(spark, table, spark.createDataFrame([(1, "A", None), (None, "n", "x"), (3, "c", "2020-01")], SCHEMA), ["id"])
    upsert.upsert_table(spark, table, spark.createDataFrame([(None, "m", "y")], SCHEMA), ["id"])
    got = [(2, "b", "2020-01"), (3, "c", "2020-01"), (5, "e", "it's"), (1, "A", None), (None, "m", "y")]
    assert sorted(map(str, spark.table(table).select("id", "v", "part").collect())) == \
        sorted(f"Row(id={i!r}, v={v!r}, part={p!r})" if "'" not in (p or "") else f'Row(id={i!r}, v={v!r}, part="{p}")' for i, v, p in got)


@pytest.mark.parametrize("step", ["overwrite_partitions", "_extend_index"])
def test_a_stopped_upsert_is_completed_by_the_next(spark, table, monkeypatch, step):
    """Stopped before or behind the exchange of files: creation times stay, nothing is doubled or lost."""
    ddl = SCHEMA + ", record_created_at string"
    spark.sql(f"DROP TABLE {table}")
    old = [(1, "a", None, "old"), (3, "c", "2020-01", "old"), (5, "e", "it's", "old")]
    write_table(spark.createDataFrame(old, ddl).select("id", "v", "record_created_at", "part"), table, partition_by=["part"])
    moved = spark.createDataFrame([(5, "E", "2020-01", "new"), (6, "f", "2020-02", "new")], ddl)
    with monkeypatch.context() as broken:
        broken.setattr(upsert, step, lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            upsert.upsert_table(spark, table, moved, ["id"], batch_id="b1")
    assert {r.id for r in spark.table(table).collect()} >= {1, 3, 5}  # nobody misses a row meanwhile
    upsert.upsert_table(spark, table, spark.createDataFrame([(1, "x", "2020-01", "newer")], ddl), ["id"], batch_id="b2")
    want = [(1, "x", "2020-01", "old"), (3, "c", "2020-01", "old"), (5, "E", "2020-01", "old"), (6, "f", "2020-02", "new")]
    for again in ("b1", "b2"):
        assert sorted(map(tuple, spark.table(table).select("id", "v", "part", "record_created_at").collect())) == want
        assert upsert.upsert_table(spark, table, moved, ["id"], batch_id=again) == {}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_touched_partitions_are_read(spark, table):
    write_table(spark.range(3000).selectExpr("id", "'v' AS v", "CAST(id % 30 AS STRING) AS part"), table, partition_by=["part"])
    upsert.index_keys(spark, table, ["id"], buckets=4)
    source = spark.createDataFrame([(31, "w", "2")], SCHEMA)  # moves from partition 1 to partition 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        located = upsert.locate_keys(spark, table, source, ["id"])
        plan = plan_of(located)
        index_side = plan[plan.index("t_keys") - 400:]
        assert "Bucketed: true" in plan and "Exchange" not in index_side.split("FileScan")[-1]
        assert len(re.findall(r"Exchange hashpartitioning\(key_hash", plan)) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    from lakemart.session import materialize
    touched = materialize(upsert.touched_partitions(located, ["part"]), "touched")
    found = upsert.rows_of(spark.table(table), ["part"], touched)
    assert "dynamicpruningexpression(part" in plan_of(found)
    assert found.count() == 200 and {r.part for r in found.select("part").distinct().collect()} == {"1", "2"}
    upsert.upsert_table(spark, table, source, ["id"])
    assert spark.table(table).count() == 3000 and spark.table(table).filter("id = 31").first().part == "2"


def test_a_replaced_table_is_indexed_again(spark, table):
    upsert.upsert_table(spark, table, spark.createDataFrame([(9, "z", "p")], SCHEMA), ["id"])
    write_table(spark.createDataFrame([(7, "g", "q")], SCHEMA), table, partition_by=["part"])
    upsert.upsert_table(spark, table, spark.createDataFrame([(7, "G", "r")], SCHEMA), ["id"])
    assert read(spark, table) == [(7, "G", "r")]


def test_a_batch_is_claimed_by_one_run(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS upserts")
    runs, calls = "upserts.claimed_runs", []
    try:
        def job():
            calls.append(1)
            return {"target_rows": 1}
        with ThreadPoolExecutor(4) as pool:  # at once
            assert sorted(pool.map(lambda _: upsert.run_batch_once(spark, runs, "load", "b1", job), range(4))) == [False] * 3 + [True]
        assert len(calls) == 1

        def interrupted():
            raise KeyboardInterrupt
        with pytest.raises(KeyboardInterrupt):
            upsert.run_batch_once(spark, runs, "load", "b3", interrupted)
        assert [r.status for r in spark.table(runs).filter("batch_id = 'b3'").collect()] == ["failed"]
        assert upsert.run_batch_once(spark, runs, "load", "b3", lambda: {})
        # A killed driver leaves its claim without a word of failure.
        assert Ledger(spark, f"{table_location(spark, runs)}/_claims").claim("load/b2/attempt-1")
        assert not upsert.run_batch_once(spark, runs, "load", "b2", job)  # may still be running
        assert upsert.run_batch_once(spark, runs, "load", "b2", job, lease_seconds=0)
        assert not upsert.run_batch_once(spark, runs, "load", "b2", job, lease_seconds=0)
        assert len(calls) == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {runs}")
