"""The corpus pipeline: stages over the documents table, each stored before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import decontaminate, lines, packing, simhash, toxicity
from lakemart.llm.common import read_table, store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents scored as toxic go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: lines of any length that repeat or resemble an earlier line go, and documents left empty by that."""
    return lines.drop_similar_lines(docs, min_words=1)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2, with its own shingle length and distance: one document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that hold a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the rest is packed into training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: Hashed features, fingerprints and sequential packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. Every earlier stage is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
