"""CSV sources: declared schemas, malformed rows, bronze columns and file checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from lakemart.functions import row_hash
from lakemart.operators.rules import broken_rules, entity_rules
from lakemart.schemas import SCHEMAS
from lakemart.session import materialize
from lakemart.sources.tables import create_table, overwrite_partitions

CORRUPT = "_corrupt_record"

#: Entities with free text, whose quoted fields may hold line breaks.
MULTI_LINE = {"reviews"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False,
             keep_malformed: bool = False) -> DataFrame:
    """Header CSV with a declared schema; bad fields become null.

    ``multi_line`` is needed for quoted line breaks but makes each file one task, so it is off
    unless asked for. ``keep_malformed`` adds the raw text of rows that do not fit.
    """
    if keep_malformed:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"') \
        .option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_entity(spark: SparkSession, path: str, entity: str, keep_malformed: bool = False) -> DataFrame:
    return read_csv(spark, path, SCHEMAS[entity], entity in MULTI_LINE, keep_malformed)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the others with their raw text."""
    bad = F.col(CORRUPT).isNotNull()
    return df.filter(~bad).drop(CORRUPT), df.filter(bad)


def with_bronze_columns(df: DataFrame, source_system: str, batch_id: str, rules=None, source_file=None) -> DataFrame:
    """Technical columns of the raw layer; values themselves stay as they came. ``source_file`` is a
    column that already names the file, for frames that are no plain scan any more."""
    values = [c for c in df.columns if c not in (CORRUPT, source_file)]
    errors = broken_rules(rules) if rules else F.array().cast("array<string>")
    if CORRUPT in df.columns:
        malformed = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("malformed"))).otherwise(F.array().cast("array<string>"))
        errors = F.concat(malformed, errors)
    now = F.current_timestamp()
    return df.withColumns({
        "_source_file": F.col(source_file) if source_file else F.input_file_name(),
        "_validation_errors": errors,
        "_record_hash": row_hash(*values),
    }).withColumns({
        "_ingestion_timestamp": now,
        "_ingestion_date": F.to_date(now),
        "_source_system": F.lit(source_system),
        "_batch_id": F.lit(batch_id),
        "_is_valid": F.size("_validation_errors") == 0,
    })


def _content(lines: DataFrame) -> DataFrame:
    """Fingerprint and rows of each file of (file_path, value, is_header). Line hashes are added and mixed by
    all tasks that read a file, so no file has to be read by one. The order of lines does not matter."""
    line_hash = F.xxhash64("value")
    return lines.groupBy("file_path").agg(
        F.count_if(~F.col("is_header")).alias("data_rows"), F.count_if(F.col("is_header")).alias("headers"),
        F.sum(F.pmod(line_hash, F.lit(1 << 31))).alias("sum_hash"), F.bit_xor(line_hash).alias("xor_hash"))


def _lines(text: DataFrame, schema: T.StructType) -> DataFrame:
    is_header = F.regexp_replace("value", '["\ufeff\r]', "") == ",".join(schema.fieldNames())
    return text.select("value", F.col("_metadata.file_path").alias("file_path"), is_header.alias("is_header"))


def _fingerprint() -> Column:
    return F.concat_ws("-", F.coalesce("data_rows", F.lit(0)), "sum_hash", F.hex("xor_hash"))


REGISTRY_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType()), T.StructField("fingerprint", T.StringType()), T.StructField("file_path", T.StringType()),
    T.StructField("data_rows", T.LongType()), T.StructField("batch_id", T.StringType()), T.StructField("loaded_at", T.TimestampType())])
MALFORMED = "_is_malformed"


def load_new_files(spark: SparkSession, path: str, entity: str, table: str, registry: str, batch_id: str,
                   source_system: str = "files") -> dict:
    """Append the files of a path whose content was not loaded before to a raw table; returns row counts.

    Content decides, not the name: a renamed copy loads nothing, of equal files in one load the first by
    name counts. Files are fingerprinted and chosen by tasks. One scan writes fitting and malformed
    rows, each kind to its own partition of the batch, the latter with their text; readers of one kind
    do not see the other. A run that stopped is repeated under its batch id and replaces what it wrote.
    """
    schema = SCHEMAS[entity]
    create_table(spark, registry, REGISTRY_SCHEMA)
    known = spark.table(registry).filter(F.col("entity") == entity).select("fingerprint")
    prints = _content(_lines(spark.read.text(path), schema)).withColumn("fingerprint", _fingerprint())
    fresh = prints.join(known, "fingerprint", "left_anti").groupBy("fingerprint") \
        .agg(F.min("file_path").alias("file_path"), F.max("data_rows").alias("data_rows"))
    fresh = materialize(fresh, "new-files")
    raw = read_entity(spark, path, entity, keep_malformed=True).select("*", F.col("_metadata.file_path").alias("file_path"))
    chosen = raw.join(fresh.select("file_path"), "file_path", "left_semi")
    counted = Observation()
    rows = with_bronze_columns(chosen, source_system, batch_id, entity_rules(entity), "file_path").drop("file_path") \
        .withColumn(MALFORMED, F.col(CORRUPT).isNotNull()) \
        .observe(counted, F.count(F.lit(1)).alias("source_rows"), F.count_if(MALFORMED).alias("malformed_rows"),
                 F.count_if(~F.col("_is_valid")).alias("rejected_rows"))
    order = [c for c in rows.columns if c not in ("_batch_id", MALFORMED)] + ["_batch_id", MALFORMED]
    rows = rows.select(*order)
    create_table(spark, table, T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]), partition_by=["_batch_id", MALFORMED])
    overwrite_partitions(rows, table)
    fresh.select(F.lit(entity).alias("entity"), "fingerprint", "file_path", "data_rows", F.lit(batch_id).alias("batch_id"),
                 F.current_timestamp().alias("loaded_at")).write.insertInto(registry)
    found = dict(counted.get)
    return {**found, "target_rows": found["source_rows"] - found["malformed_rows"]}


def fitting_rows(spark: SparkSession, table: str, entity: str) -> DataFrame:
    """The rows of a raw table that fit the declared schema, in its columns; other partitions are not read."""
    return spark.table(table).filter(~F.col(MALFORMED)).select(*SCHEMAS[entity].fieldNames())


def malformed_rows(spark: SparkSession, table: str) -> DataFrame:
    """Text, file and batch of the rows that did not fit."""
    return spark.table(table).filter(MALFORMED).select(F.col(CORRUPT).alias("raw_text"), "_source_file", "_batch_id")


def source_file_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per file: size, data rows, whether the expected header is there, content fingerprint.

    One distributed pass over the lines. The fingerprint adds and mixes line hashes, so it does
    not need a file in one task. Empty files appear with zero rows.
    """
    text = spark.read.text(path)
    # Scans skip empty files, so the names come from the listing.
    listed = spark.createDataFrame([(f,) for f in text.inputFiles()], "file_path string")
    content = _content(_lines(text, schema))
    sizes = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file_path"), "length")
    slashes = F.regexp_replace("file_path", "^file:/+", "file:/")  # the listings write local paths differently
    named = [d.withColumn("file_path", slashes) for d in (listed, sizes, content)]
    return named[0].join(named[1], "file_path", "left").join(named[2], "file_path", "left").select(
        "file_path", F.coalesce("length", F.lit(0)).alias("bytes"), F.coalesce("data_rows", F.lit(0)).alias("data_rows"),
        (F.coalesce("headers", F.lit(0)) > 0).alias("has_expected_columns"),
        _fingerprint().alias("fingerprint"),
        (F.coalesce("data_rows", F.lit(0)) > 0).alias("is_not_empty"),
    )


def new_files(report: DataFrame, registry: DataFrame) -> DataFrame:
    """Files whose content was not loaded before, whatever their name."""
    return report.join(registry.select("fingerprint").distinct(), "fingerprint", "left_anti")
