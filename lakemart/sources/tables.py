"""Catalog tables: create, write, replace, compact.

The table format is a parameter. Parquet tables of the session catalog are the default;
formats with their own catalog (``iceberg``, ``delta``) take the second-generation writer.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from lakemart.session import materialize

CATALOG_FORMATS = {"iceberg", "delta"}


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})


def create_table(spark: SparkSession, table: str, schema: T.StructType, fmt: str = "parquet", partition_by=(),
                 location: str | None = None) -> None:
    """Create an empty typed table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}) USING {fmt}{parts}{place}", args={"name": table})


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": table})


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def arrange(df: DataFrame, partition_by=(), sort_by=()) -> DataFrame:
    """Bring rows of a table partition together and sort them inside each file.

    ``rebalance`` gathers by the partition columns but lets AQE split a partition that is too
    big for one task and merge small ones, so a hot month is written by many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    return df


def write_table(df: DataFrame, table: str, fmt: str = "parquet", partition_by=(), sort_by=(), bucket_by=None,
                path: str | None = None, with_processed_at: bool = False, global_order=()) -> dict:
    """Replace a table with the frame and return its row count, taken during the write.

    ``bucket_by`` is (column, number). ``path`` fixes the location. ``global_order`` sorts the whole
    result by ranges, for small tables that are read in order; ``sort_by`` only sorts inside files.
    """
    if with_processed_at:
        df = df.withColumn("processed_at", F.current_timestamp())
    counted = Observation()
    arranged = df.orderBy(*global_order) if global_order else arrange(df, partition_by, sort_by)
    arranged = arranged.observe(counted, F.count(F.lit(1)).alias("rows"))
    if fmt in CATALOG_FORMATS:
        writer = arranged.writeTo(table).using(fmt)
        if path:
            writer = writer.tableProperty("location", path)
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()
    else:
        writer = arranged.write.format(fmt).mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            column, number = bucket_by
            writer = writer.bucketBy(number, column).sortBy(column)
        if path:
            writer = writer.option("path", path)
        # A fixed location may still hold folders of an earlier table: replace all of it.
        with _partition_overwrite(df.sparkSession, "static"):
            writer.saveAsTable(table)
    return {"target_rows": counted.get["rows"]}


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace only the partitions present in the frame; an unpartitioned table is replaced whole.

    The frame must not read the table itself: stage it first.
    """
    spark = df.sparkSession
    with _partition_overwrite(spark, "dynamic"):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


@contextmanager
def _partition_overwrite(spark: SparkSession, mode: str):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, mode)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def materialize_sql(spark: SparkSession, sql: str, table: str, fmt: str = "parquet") -> dict:
    """Run a query and keep its result as a table."""
    return write_table(spark.sql(sql), table, fmt)


def filter_period(df: DataFrame, first_month: str, last_month: str, column: str = "purchase_year_month") -> DataFrame:
    """Months from first to last, by the partition column itself so that other folders are not listed."""
    return df.filter(F.col(column).between(first_month, last_month))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of the data files below a path; only the listing is read, not the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def memory_bytes(df: DataFrame) -> int:
    """About what the rows take in a sort: eight bytes a column, null bits, an entry to sort by, and the
    values without a fixed width, which are read for their length."""
    fixed = T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType
    loose = [f.name for f in df.schema if not isinstance(f.dataType, fixed)]
    lengths = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`").cast("string"))), F.lit(0)) for c in loose]
    rows, *loose_bytes = df.agg(F.count(F.lit(1)), *lengths).first()
    return rows * (8 * len(df.columns) + 32) + sum(loose_bytes)


def compact_folder(spark: SparkSession, source: str, target: str, target_bytes: int = 256 << 20, sort_by=(),
                   sort_bytes: int = 512 << 20) -> int:
    """Rewrite a parquet folder into a new one with files near the target size; returns their number.

    With ``sort_by`` the files are ranges of the sort order, which sharpens min/max statistics. One task
    sorts one file, so there are more, smaller files where one would take over ``sort_bytes`` in memory.
    """
    files = max(1, math.ceil(folder_bytes(spark, source) / target_bytes))
    df = spark.read.parquet(source)
    if sort_by:
        files = max(files, math.ceil(memory_bytes(df) / sort_bytes))
        df = df.repartitionByRange(files, *sort_by).sortWithinPartitions(*sort_by)
    else:
        df = df.repartition(files)
    df.write.parquet(target)
    return files


def compact_partitions(spark: SparkSession, table: str, condition, sort_by=()) -> None:
    """Rewrite the partitions a condition on partition columns selects. Rows are staged first, so a
    failed run leaves the table as it was."""
    parts = partition_columns(spark, table)
    if not parts:
        raise ValueError("compact_partitions needs a partitioned table; use compact_folder")
    staged = materialize(spark.table(table).filter(condition), "compact")
    overwrite_partitions(arrange(staged, parts, sort_by), table)
