"""Streaming ingestion: source, JSON decoding, append sink, bounded runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
                schema: T.StructType | None = None, path: str | None = None, from_start: bool = False) -> DataFrame:
    """An unbounded source of any format. ``from_start`` replays a message log from its earliest
    offset; file sources always start at the beginning."""
    options = dict(options or {})
    if from_start and fmt == "kafka":
        options["startingOffsets"] = "earliest"
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def decode_json(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Bytes or text to typed columns. Text that is not JSON gives a row of nulls."""
    return df.select(F.from_json(F.col(column).cast("string"), schema).alias("data")).select("data.*")


def write_stream(df: DataFrame, checkpoint: str, table: str | None = None, path: str | None = None,
                 fmt: str = "parquet", trigger: dict | None = None) -> StreamingQuery:
    """Append to a table or folder. The trigger defaults to 10 s; ``{"availableNow": True}`` takes
    what is there and ends."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "10 seconds"}))
    if table:
        return writer.toTable(table)
    return writer.start(path)


def run_available(query: StreamingQuery, timeout_seconds: int | None = None) -> None:
    """Wait for a bounded run to end, by default as long as it takes; an error in the stream is raised here."""
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"stream did not finish in {timeout_seconds} s")
