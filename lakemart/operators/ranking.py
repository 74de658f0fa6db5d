"""Exact ranks, medians and quantiles that never gather a large group in one task.

A plain window sorts its whole partition in one task: for a global ranking that is the whole
table, for a grouped one the hottest group. Here rows are first counted per distinct value
(reduced on the map side), the counts are dealt into ranges of (group, value), and ranks inside
a range are shifted by the exact number of rows of the group in earlier ranges. A group gets as
many ranges as its size asks for. The borders only balance the work; the result does not depend
on them, and small and large data take the same plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.functions import ratio
from lakemart.session import materialize

_N = "_rows"


def same_values(left: str, right: str, columns: list[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return condition


def split_groups(df: DataFrame, by: list[str], value: str, pieces: int | None = None) -> DataFrame:
    """``df`` with ``_piece``: stored in ranges of (group, value) of about equal size, numbered in that order.

    Rows of one group and value are expected to be few (one, after counting). Null is the lowest value.
    ``pieces`` sets the number of ranges, by default that of a shuffle; adaptive execution merges small ones.
    Stored, because the borders come from a sample and the numbers are read more than once.
    """
    order = [*[F.col(c).asc_nulls_first() for c in by], F.col(value).asc_nulls_first()]
    dealt = df.repartitionByRange(pieces, *order) if pieces else df.repartitionByRange(*order)
    return materialize(dealt.withColumn("_piece", F.spark_partition_id()), "ranges")


def value_positions(df: DataFrame, by: list[str], value: str, pieces: int | None = None) -> DataFrame:
    """One row per group and distinct value with ``rows_here``, ``rows_below`` and ``rows_total``.

    ``rows_below + 1`` is the SQL ``rank`` of the value. Nulls sort lowest.
    """
    counts = split_groups(df.groupBy(*by, value).agg(F.count(F.lit(1)).alias(_N)), by, value, pieces)
    group = Window.partitionBy(*by)
    to_here = (Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy(*by, "_piece").orderBy(F.col(value).asc_nulls_first()).rowsBetween(*to_here)
    ranked = counts.withColumn("_upto", F.sum(_N).over(inside))
    # Per group at most one row per range, so this window is small whatever the group holds.
    offsets = counts.groupBy(*by, "_piece").agg(F.sum(_N).alias("_piece_rows")).withColumns({
        "_offset": F.sum("_piece_rows").over(group.orderBy("_piece").rowsBetween(*to_here)) - F.col("_piece_rows"),
        "rows_total": F.sum("_piece_rows").over(group),
    })
    return ranked.alias("v").join(offsets.alias("o"), same_values("v", "o", [*by, "_piece"]), "inner").select(
        *[F.col(f"v.{c}") for c in by], F.col(f"v.{value}"), F.col(_N).alias("rows_here"),
        (F.col("_offset") + F.col("_upto") - F.col(_N)).alias("rows_below"), "rows_total",
    )


def percent_ranks(df: DataFrame, by: list[str], value: str, name: str, pieces: int | None = None) -> DataFrame:
    """``df`` plus ``name`` = (rank - 1) / (rows - 1) within the group, ties equal, 0 for a single row."""
    positions = value_positions(df, by, value, pieces)
    scored = positions.withColumn(
        name, F.coalesce(ratio("rows_below", F.col("rows_total") - 1), F.lit(0.0))
    ).select(*by, value, name)
    return df.alias("d").join(scored.alias("s"), same_values("d", "s", [*by, value]), "left").select("d.*", f"s.{name}")


def exact_median(df: DataFrame, by: list[str], value: str, name: str, pieces: int | None = None) -> DataFrame:
    """Median per group; the mean of the two middle values for an even count."""
    positions = value_positions(df.filter(F.col(value).isNotNull()), by, value, pieces)
    low = F.floor((F.col("rows_total") - 1) / 2)
    high = F.floor(F.col("rows_total") / 2)

    def covers(position):
        return (F.col("rows_below") <= position) & (position < F.col("rows_below") + F.col("rows_here"))

    middle = positions.filter(covers(low) | covers(high))
    return middle.groupBy(*by).agg(ratio(F.min(value).cast("double") + F.max(value).cast("double"), F.lit(2)).alias(name))


def quantile_value(df: DataFrame, value: str, fraction: float, pieces: int | None = None) -> Column:
    """Scalar: the smallest value that at least ``fraction`` of the rows do not exceed."""
    positions = value_positions(df.filter(F.col(value).isNotNull()), [], value, pieces)
    reached = (F.col("rows_below") + F.col("rows_here")).cast("double") >= F.lit(float(fraction)) * F.col("rows_total")
    return positions.filter(reached).agg(F.min(value)).scalar()


def _tile(position: Column, total: Column, n: int) -> Column:
    """SQL ``ntile``: the first ``total % n`` tiles hold one row more."""
    size, extra = F.floor(total / n), total % n
    head = extra * (size + 1)
    tail = F.floor(F.try_divide(position - head, size))
    return F.when(position < head, F.floor(position / (size + 1)) + 1).otherwise(extra + tail + 1).cast("int")


def ntile_by_value(df: DataFrame, key: str, value: str, n: int, name: str, by: list[str] | None = None,
                   ties: str = "split", pieces: int | None = None) -> DataFrame:
    """``df`` plus ``name`` in 1..n per group, low values first. ``key`` is unique in the group.

    ``ties="together"`` gives equal values the tile of their first row. ``ties="split"`` is
    SQL ``ntile`` ordered by value and then by the digest of ``key``: at most n - 1 values per
    group straddle a tile border, and only their rows are ranked one by one. ``df`` is read
    twice, so it should be stored.
    """
    by = by or []
    total = F.col("rows_total")
    tiles = value_positions(df, by, value, pieces).withColumns({
        "_first": _tile(F.col("rows_below"), total, n),
        "_last": _tile(F.col("rows_below") + F.col("rows_here") - 1, total, n),
    })
    extra = ["_first", "_last", "rows_below", "rows_total"]
    tiled = df.alias("d").join(tiles.alias("t"), same_values("d", "t", [*by, value]), "left").select("d.*", *extra)
    if ties == "together":
        return tiled.withColumn(name, F.col("_first")).drop(*extra)
    # Rows of border values: rank by a uniform 60-bit digest of the key, again in pieces.
    border = materialize(tiled.filter(F.col("_first") != F.col("_last")).select(
        *by, key, value, "rows_below", "rows_total", tie_number(key).alias("_tie")), "tile-borders")
    ahead = value_positions(border, [*by, value], "_tie", pieces).select(
        *by, value, "_tie", F.col("rows_below").alias("_ahead"))
    # Equal digests are almost always single rows; the window orders the rest by key.
    same_digest = Window.partitionBy(*by, value, "_tie").orderBy(key)
    position = F.col("rows_below") + F.col("_ahead") + F.row_number().over(same_digest) - 1
    placed = border.alias("b").join(ahead.alias("a"), same_values("b", "a", [*by, value, "_tie"]), "inner") \
        .select("b.*", "_ahead").select(*by, key, _tile(position, total, n).alias("_placed"))
    return tiled.alias("d").join(placed.alias("p"), same_values("d", "p", [*by, key]), "left").select(
        "d.*", "_placed").withColumn(name, F.coalesce("_placed", "_first")).drop(*extra, "_placed")


def tie_number(key: str) -> Column:
    """First 60 bits of the key's digest."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 15), 16, 10).cast("bigint")
