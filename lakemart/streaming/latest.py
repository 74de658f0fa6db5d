"""Continuous tables: latest row per transaction, and hourly spend.

Each micro-batch is reduced and then upserted into an ordinary partitioned table, exactly once: its
number and the identity of the stream are the batch id of the upsert. No state is kept in the stream,
so nothing is too late to count, and the table is complete and readable after every batch.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lakemart.operators.clean import clean_transactions, latest_transaction
from lakemart.operators.sales import add_spend, spend_parts, total_spend
from lakemart.operators.upsert import batch_ledger, upsert_table
from lakemart.schemas import SCHEMAS
from lakemart.sources.ledger import Ledger
from lakemart.sources.tables import create_table

EVERY = {"processingTime": "10 seconds"}
LATEST_DATE, SPEND_DAY = "transaction_date", "spend_day"


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity that the stream keeps in its checkpoint; a checkpoint made anew has another."""
    return json.loads(Ledger(spark, checkpoint).read("metadata"))["id"]


def with_latest_date(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn(LATEST_DATE, F.to_date("transaction_time"))


def with_spend_day(spend: DataFrame) -> DataFrame:
    return spend.withColumn(SPEND_DAY, F.to_date("transaction_hour"))


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS["transactions"])


def stream_latest(transactions: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
                  path: str | None = None) -> StreamingQuery:
    """Keep the latest cleaned row per transaction id in a table partitioned by its date.

    The newest of all versions wins by the order of the batch job, whatever the cut into batches: a
    repeated batch, a stop between batches and a new checkpoint that reads everything again change
    nothing. Rows without an id are one key, rows without a time one partition.
    """
    spark = transactions.sparkSession
    schema = with_latest_date(clean_transactions(_empty(spark))).schema
    create_table(spark, table, T.StructType(schema.fields), partition_by=[LATEST_DATE], location=path)

    def apply(batch: DataFrame, number: int) -> None:
        rows = with_latest_date(clean_transactions(batch))
        own = batch.sparkSession
        upsert_table(own, table, rows, ["id_transaction"], batch_id=f"{_stream_id(own, checkpoint)}-{number}",
                     resolve=latest_transaction, picks_rows=True)

    return transactions.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY)) \
        .foreachBatch(apply).start()


def read_latest(spark: SparkSession, table: str) -> DataFrame:
    spark.catalog.refreshTable(table)  # the stream writes in a session of its own
    return spark.table(table).drop(LATEST_DATE)


def stream_hourly_spend(transactions: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
                        path: str | None = None) -> StreamingQuery:
    """Add up spend and count per client and hour in a table partitioned by day.

    Every batch is reduced to partial sums, which are added to the days it touches; rows may come as
    late as they like, and unreadable times share the null hour. Totals are those of the batch job for
    every cut into batches. Sums of one stream only can be added up: a checkpoint made anew would count
    its source again, so it needs a new table, and is refused for this one.
    """
    spark = transactions.sparkSession
    schema = with_spend_day(spend_parts(_empty(spark))).schema
    create_table(spark, table, T.StructType(schema.fields), partition_by=[SPEND_DAY], location=path)

    def apply(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        stream = _stream_id(own, checkpoint)
        ledger = batch_ledger(own, table)
        first = ledger.read("stream")
        if first is None:
            ledger.put("stream", stream)
        elif first != stream:
            raise ValueError(f"{table} holds the sums of stream {first}, not of {stream}")
        upsert_table(own, table, with_spend_day(spend_parts(batch)), ["client", "transaction_hour"],
                     batch_id=f"{stream}-{number}", keys_fix_partition=True,
                     resolve=lambda rows: with_spend_day(add_spend(rows)))

    return transactions.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY)) \
        .foreachBatch(apply).start()


def read_hourly_spend(spark: SparkSession, table: str) -> DataFrame:
    spark.catalog.refreshTable(table)
    return total_spend(spark.table(table))
