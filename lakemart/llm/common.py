"""Shared helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakemart.session import work_path

# The letters that lower-casing covers.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(c: str | Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(F.col(c) if isinstance(c, str) else c, UPPER, LOWER)


def as_bytes(texts: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column."""
    return texts.cast(pa.binary()).to_pylist()


def add_columns(df: DataFrame, inputs: list[str], fields: str, start: Callable[[], Callable[..., list]]) -> DataFrame:
    """Append (or replace, keeping the place) columns that Python computes from Arrow batches.

    ``start`` runs once per partition and returns the function that maps the input arrays of a
    batch to one list or array per field of ``fields`` (a DDL string). Rows stay where they are.
    """
    made = StructType.fromDDL(fields)
    names = [f.name for f in made]
    kept = [c for c in df.columns if c not in names]
    schema = StructType([df.schema[c] for c in kept] + list(made))
    arrow = to_arrow_schema(made)
    where = {c: i for i, c in enumerate(df.columns)}

    def run(batches):
        work = start()
        for batch in batches:
            results = work(*(batch.column(where[c]) for c in inputs))
            arrays = [r if isinstance(r, (pa.Array, pa.ChunkedArray)) else pa.array(r, type=f.type)
                      for r, f in zip(results, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(where[c]) for c in kept] + arrays, names=kept + names)

    order = [*df.columns, *(n for n in names if n not in where)]
    return df.mapInArrow(run, schema).select(*order)


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Frees the shuffle files of each finished SQL execution inside, where Spark offers that."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def store(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Written to the shared folder and read back; the shuffle files of the computation go."""
    path = work_path(df.sparkSession, name)
    with shuffle_cleanup(df.sparkSession):
        df.write.parquet(path, compression=compression)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Deletes what ``store`` wrote. To be called once all that reads it is itself stored."""
    for df in stored:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
