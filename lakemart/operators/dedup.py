"""Row deduplication.

``row_number() = 1`` is planned with a group limit on both sides of the shuffle: every map
task sends at most one row per key, so a key that holds a third of the table is reduced
before it reaches its reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F


def _first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*(order or keys))  # without an order all rows of a key are alike
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _total_order(df: DataFrame, used: list[str], wanted: list[str] | None = None) -> list[Column]:
    """The remaining columns, so that ties cannot change the survivor between runs. Columns behind the last
    wanted one are left out: rows that tie up to there agree in all that is wanted."""
    rest = [c for c in df.columns if c not in used]
    if wanted is not None:
        rest = rest[:max((i + 1 for i, c in enumerate(rest) if c in wanted), default=0)]
    return [F.col(c).asc_nulls_last() for c in rest]


def dedup(df: DataFrame, keys: list[str], order_by: list[Column] | None = None,
          columns: list[str] | None = None) -> DataFrame:
    """One row per key. Null keys are one group. The survivor is the first by ``order_by``,
    then by all other columns. With ``columns`` only these come back, of the same survivors, and columns
    that cannot change them are not read."""
    unique = _first_per_key(df, keys, list(order_by or []) + _total_order(df, keys, columns))
    return unique if columns is None else unique.select(*columns)


def keep_latest(df: DataFrame, keys: list[str], ts: str | Column, tie_break: list[Column] | None = None) -> DataFrame:
    """The newest row per key; rows without a time come last."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    order = [ts.desc_nulls_last()] + list(tie_break or []) + _total_order(df, keys)
    return _first_per_key(df, keys, order)


def drop_exact_duplicates(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Remove equal rows. ``observation`` receives source_rows, target_rows and duplicate_rows
    when the result is written, without a second job."""
    grouped = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    if observation is not None:
        grouped = grouped.observe(
            observation,
            F.sum("_copies").alias("source_rows"),
            F.count(F.lit(1)).alias("target_rows"),
            F.sum(F.col("_copies") - 1).alias("duplicate_rows"),
        )
    return grouped.drop("_copies")
