"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.llm.common import store



def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``class`` (smallest node of its component) of every node that has a link.

    Links live in distributed tables only; each round is written to the shared folder. In a round,
    every node points its larger neighbours to its smallest one (large star), then all its smaller
    neighbours (small star), until nothing changes. The smallest neighbour is an aggregate joined
    back, so no neighbour list is ever gathered and hot nodes are split like any skewed join.
    """
    edges = links.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")) \
        .filter(F.col("low") < F.col("high")).distinct()
    edges = store(edges, "components")
    before = None
    while True:
        edges = store(_small_star(_large_star(edges)), "components")
        # Order-free digest of the links; the same twice means that nothing moved.
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("low", "high")), F.sum(F.hash("low", "high").cast("long"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("high").alias("node"), F.col("low").alias("class")) \
        .union(edges.select(F.col("low").alias("node"), F.col("low").alias("class")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")) \
        .union(edges.select(F.col("high").alias("u"), F.col("low").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
    return larger.join(least, "u").select(F.col("m").alias("low"), F.col("v").alias("high")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("m"))
    met = edges.join(least, "high")
    moved = met.filter("low <> m").select(F.col("m").alias("low"), F.col("low").alias("high"))
    return moved.union(least.select(F.col("m").alias("low"), "high")).distinct()
