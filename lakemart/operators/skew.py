"""Salting for keys that hold a large part of a table (beyond what AQE splits)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.session import materialize


def salted_aggregate(df: DataFrame, keys: list[str], partial: dict[str, Column], final: dict[str, Column],
                     salts: int = 64) -> DataFrame:
    """Two-step aggregate: ``partial`` per key and salt, ``final`` over the partial columns.

    Worth it only where the map side cannot reduce (collecting, distinct-like states); sums
    and counts are already reduced before the shuffle.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    first = salted.groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in partial.items()])
    return first.groupBy(*keys).agg(*[c.alias(n) for n, c in final.items()])


def hot_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys that hold at least ``share`` of all rows: at most 1 / share of them, whatever the size of ``df``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    per_key = materialize(per_key, "rows-per-key")
    total = per_key.agg(F.sum("_rows")).scalar()
    return per_key.filter(F.col("_rows") >= F.lit(share) * total).drop("_rows")


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", share: float = 0.001,
                salts: int = 64) -> DataFrame:
    """Inner or left join that spreads hot keys of ``big`` over ``salts`` tasks.

    Hot is a key with at least ``share`` of all rows. Rows of ``small`` are copied ``salts`` times for
    hot keys only. The list of hot keys is broadcast: it has at most 1 / share entries.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins keep their result when the right side is copied")
    hot = F.broadcast(hot_keys(big.filter(_all_known(keys)), keys, share).withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int")
    left = big.join(hot, keys, "left").withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(0)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def _all_known(keys: list[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known
