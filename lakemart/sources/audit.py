"""Run audit: one row per job run, freshness, and unusual row counts."""

from __future__ import annotations

import datetime
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from lakemart.functions import ratio
from lakemart.sources.tables import create_table

COUNTS = ["source_rows", "target_rows", "rejected_rows", "inserted_rows", "updated_rows"]
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("job_name", T.StringType()),
    T.StructField("batch_id", T.StringType()), T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()), T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()), *[T.StructField(c, T.LongType()) for c in COUNTS],
    T.StructField("error_message", T.StringType()),
])


@contextmanager
def run_audit(spark: SparkSession, table: str, job_name: str, batch_id: str | None = None):
    """Record a run. The block fills the yielded dict with counts; an error is recorded and raised again."""
    create_table(spark, table, RUN_SCHEMA)
    counts: dict = {"run_id": uuid.uuid4().hex}
    start = datetime.datetime.now()
    status, error = "failed", None
    try:
        yield counts
        status = "succeeded"
    except BaseException as e:  # an interrupt is no success either
        error = f"{type(e).__name__}: {e}"
        raise
    finally:
        end = datetime.datetime.now()
        row = (counts["run_id"], job_name, batch_id, start, end, (end - start).total_seconds(), status,
               *[counts.get(c) for c in COUNTS], error)
        spark.createDataFrame([row], RUN_SCHEMA).write.insertInto(table)


def already_done(spark: SparkSession, table: str, job_name: str, batch_id: str) -> bool:
    """True if this batch succeeded before; lets a rerun skip it."""
    if not spark.catalog.tableExists(table):
        return False
    done = (F.col("job_name") == job_name) & (F.col("batch_id") == batch_id) & (F.col("status") == "succeeded")
    return not spark.table(table).filter(done).isEmpty()


def freshness(df: DataFrame, ts: str, now, max_hours: float = 24.0) -> DataFrame:
    """Newest time in the data and whether it is recent enough."""
    age = ratio(F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("newest"), F.lit(3600))
    return df.agg(F.max(F.col(ts).cast("timestamp")).alias("newest")).withColumn("age_hours", age).withColumn(
        "is_fresh", F.coalesce(F.col("age_hours") <= max_hours, F.lit(False)))


def row_count_changes(runs: DataFrame, max_change: float = 0.5) -> DataFrame:
    """Successful runs whose target count differs from the job's previous run by more than ``max_change``."""
    previous = F.lag("target_rows").over(Window.partitionBy("job_name").orderBy("started_at"))
    compared = runs.filter(F.col("status") == "succeeded").withColumn("previous_rows", previous)
    change = ratio(F.col("target_rows") - F.col("previous_rows"), "previous_rows")
    return compared.withColumn("relative_change", change).filter(F.abs("relative_change") > max_change)
