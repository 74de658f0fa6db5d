import json

import pytest

from lakemart.operators.clean import clean_transactions
from lakemart.operators.sales import hourly_client_spend
from lakemart.schemas import SCHEMAS
from lakemart.streaming import ingest, latest

ONCE = {"availableNow": True}


def write(folder, name, rows):
    keys = SCHEMAS["transactions"].fieldNames()
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(
        (r if isinstance(r, str) else json.dumps(dict(zip(keys, r)))) + "\n" for r in rows))


def source(spark, folder):
    stream = ingest.read_stream(spark, "text", {"maxFilesPerTrigger": "1"}, path=str(folder))
    return ingest.decode_json(stream, SCHEMAS["transactions"])


FIRST = [("1", "ana", "x", 1.0, "2024-01-01 10:05:00"), ("2", "bob", "y", 2.0, "2024-01-01 10:55:00"), "{broken"]
SECOND = [("1", "ana", "x", 5.0, "2024-01-01 11:05:00"), ("2", "bob", "y", 9.0, "2024-01-01 09:00:00"),
          ("3", "ana", "z", 4.0, "2024-01-01 10:59:59")]


def test_bronze_appends_only_new_files(spark, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    write(tmp_path / "in", "a", FIRST)
    ingest.run_available(ingest.write_stream(source(spark, tmp_path / "in"), log, path=out, trigger=ONCE))
    assert spark.read.parquet(out).filter("id_transaction is null").count() == 1  # not JSON
    write(tmp_path / "in", "b", SECOND)
    ingest.run_available(ingest.write_stream(source(spark, tmp_path / "in"), log, path=out, trigger=ONCE))
    assert spark.read.parquet(out).count() == 6


def test_bronze_table_sink(spark, tmp_path):
    write(tmp_path / "in", "a", FIRST)
    spark.sql("DROP TABLE IF EXISTS bronze_transactions")
    ingest.run_available(ingest.write_stream(
        source(spark, tmp_path / "in"), str(tmp_path / "log"), table="bronze_transactions", trigger=ONCE))
    assert spark.table("bronze_transactions").count() == 3
    spark.sql("DROP TABLE bronze_transactions")


@pytest.fixture
def table(spark):
    yield "live_rows"
    for name in ("live_rows", "live_rows_keys"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def batch_rows(spark, *lists):
    return spark.createDataFrame([r for rows in lists for r in rows], SCHEMAS["transactions"])


THIRD = [("2", "bob", "y", 7.0, "not a date"), ("1", "ana", "x", 6.0, "2024-01-01 11:05:00"), ("4", "eve", "z", None, None),
         (None, "eve", "z", 1.0, "2023-01-01 00:00:00")]


def test_latest_over_batches_equals_batch_result(spark, tmp_path, table):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    for name, part in (("a", FIRST[:2]), ("b", SECOND), ("c", THIRD)):  # stopped after each batch
        write(tmp_path / "in", name, part)
        ingest.run_available(latest.stream_latest(source(spark, tmp_path / "in"), table, log, ONCE, out))
    want = rows(clean_transactions(batch_rows(spark, FIRST[:2], SECOND, THIRD)))
    assert rows(latest.read_latest(spark, table)) == want
    assert {(r[0], r[3]) for r in want} == {("1", 6.0), ("2", 2.0), ("3", 4.0), ("4", None), (None, 1.0)}
    assert rows(spark.read.parquet(out).drop("transaction_date")) == want  # no file is left behind
    # A new checkpoint reads every file again, one per batch.
    ingest.run_available(latest.stream_latest(source(spark, tmp_path / "in"), table, str(tmp_path / "log2"), ONCE, out))
    assert rows(latest.read_latest(spark, table)) == want


def test_a_batch_that_stopped_halfway_is_completed_once(spark, tmp_path, table, monkeypatch):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    write(tmp_path / "in", "a", FIRST[:2])
    ingest.run_available(latest.stream_hourly_spend(source(spark, tmp_path / "in"), table, log, ONCE, out))
    write(tmp_path / "in", "b", SECOND)
    from lakemart.operators import upsert
    real = upsert.overwrite_partitions

    def stop_behind(*args):
        real(*args)
        raise RuntimeError("stopped")

    with monkeypatch.context() as broken:
        broken.setattr(upsert, "overwrite_partitions", stop_behind)
        with pytest.raises(Exception, match="stopped"):
            ingest.run_available(latest.stream_hourly_spend(source(spark, tmp_path / "in"), table, log, ONCE, out))
    write(tmp_path / "in", "c", THIRD)
    ingest.run_available(latest.stream_hourly_spend(source(spark, tmp_path / "in"), table, log, ONCE, out))
    want = rows(hourly_client_spend(batch_rows(spark, FIRST[:2], SECOND, THIRD)))
    assert rows(latest.read_hourly_spend(spark, table)) == want


def test_hourly_spend_counts_every_row(spark, tmp_path, table):
    """Years late, without a time, too large for any decimal: all count, whatever the cut."""
    odd = [("8", "ana", "x", 1e300, "2024-01-01 10:05:00"), ("9", "ana", "x", 1.5, "2001-01-01 00:30:00"),
           ("10", "ana", "x", 3e18, "2001-01-01 00:40:00"), ("11", "bob", "x", 0.001, "never")]
    for name, part in (("a", FIRST[:2]), ("b", [("5", "ana", "x", 1.0, "2024-01-09 00:00:00")]), ("c", odd), ("d", THIRD)):
        write(tmp_path / "in", name, part)
        ingest.run_available(latest.stream_hourly_spend(source(spark, tmp_path / "in"), table, str(tmp_path / "log"), ONCE,
                                                        str(tmp_path / "out")))
    got = {(r.client, str(r.transaction_hour)): (r.total_spending, r.transaction_count)
           for r in latest.read_hourly_spend(spark, table).collect()}
    assert got["ana", "2001-01-01 00:00:00"] == (3e18 + 1.5, 2) and got["ana", "2024-01-01 10:00:00"] == (1e300, 2)
    assert got["bob", "None"] == (7.001, 2) and got["eve", "None"] == (None, 1)
    with pytest.raises(Exception, match="holds the sums of stream"):
        ingest.run_available(latest.stream_hourly_spend(
            source(spark, tmp_path / "in"), table, str(tmp_path / "other"), ONCE, str(tmp_path / "out")))


def test_timeout_is_reported(spark, tmp_path):
    write(tmp_path / "in", "a", FIRST)
    query = ingest.write_stream(source(spark, tmp_path / "in"), str(tmp_path / "log"), path=str(tmp_path / "out"))
    with pytest.raises(TimeoutError):
        ingest.run_available(query, 1)


def test_a_replay_leaves_unchanged_partitions_alone(spark, tmp_path, table):
    out = tmp_path / "out"
    for name, part in (("a", FIRST[:2]), ("b", SECOND), ("c", THIRD)):
        write(tmp_path / "in", name, part)

    def files():
        return {str(f.relative_to(out)) for f in out.glob("transaction_date=*/*.parquet")}

    ingest.run_available(latest.stream_latest(source(spark, tmp_path / "in"), table, str(tmp_path / "log"), ONCE, str(out)))
    before, kept = files(), rows(latest.read_latest(spark, table))
    moved = [("5", "ana", "x", 1.0, "2024-02-01 00:00:00"), ("3", "ana", "z", 4.0, "2024-02-01 10:00:00")]
    write(tmp_path / "in", "d", moved)
    ingest.run_available(latest.stream_latest(source(spark, tmp_path / "in"), table, str(tmp_path / "log2"), ONCE, str(out)))
    after, want = files(), rows(clean_transactions(batch_rows(spark, FIRST[:2], SECOND, THIRD, moved)))
    assert rows(latest.read_latest(spark, table)) == want != kept
    untouched = {f for f in before if "2024-01-01" not in f}
    assert untouched and untouched <= after and any("2024-02-01" in f for f in after)
    assert not {f for f in before - untouched} & after  # row 3 moved away
