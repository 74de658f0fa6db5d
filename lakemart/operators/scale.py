"""Larger data sets from a given one, with references kept and known defects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.operators.ranking import tie_number


def _copies(df: DataFrame, times: int) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def _copied(id_column: str) -> Column:
    """Copy 0 keeps the id."""
    return F.when(F.col("copy") == 0, F.col(id_column)).otherwise(
        F.concat(id_column, F.lit("-"), F.col("copy").cast("string")))


def _hit(seed: str, id_column: str, per_thousand: int) -> Column:
    """Deterministic choice of about ``per_thousand`` of a thousand copied rows."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col(id_column))), 1, 8), 16, 10).cast("bigint")
    return (F.col("copy") > 0) & (F.pmod(drawn, F.lit(1000)) < per_thousand)


def replicate_orders(orders: DataFrame, times: int, months_apart: int = 12, bad_status_per_thousand: int = 0) -> DataFrame:
    """Raw orders ``times`` times: new ids, shifted dates, optionally a wrong status in some copies.

    A row-local expansion: no shuffle, any number of copies. Unreadable dates stay as they are.
    """
    copied = _copies(orders, times).withColumns({"order_id": _copied("order_id"), "customer_id": _copied("customer_id")})

    def shifted(name: str) -> Column:
        parsed = F.try_to_timestamp(F.col(name), F.lit("yyyy-MM-dd HH:mm:ss"))
        moved = F.date_format(F.add_months(F.to_date(parsed), F.col("copy") * months_apart), "yyyy-MM-dd")
        clock = F.date_format(parsed, " HH:mm:ss")
        return F.when((F.col("copy") == 0) | parsed.isNull(), F.col(name)).otherwise(F.concat(moved, clock))

    times_columns = [c for c in orders.columns if c.endswith("_timestamp") or c.endswith("_date") or c.endswith("_at")]
    moved = copied.withColumns({c: shifted(c) for c in times_columns})
    bad = _hit("status", "order_id", bad_status_per_thousand)
    return moved.withColumn("order_status", F.when(bad, "???").otherwise(F.col("order_status"))).drop("copy")


def replicate_items(items: DataFrame, times: int, negative_price_per_thousand: int = 0) -> DataFrame:
    """Order items for the copied orders; products and sellers are shared by all copies."""
    copied = _copies(items, times).withColumn("order_id", _copied("order_id"))
    bad = _hit("price", "order_id", negative_price_per_thousand)
    return copied.withColumn("price", F.when(bad, -F.abs("price")).otherwise(F.col("price"))).drop("copy")


def replicate_customers(customers: DataFrame, times: int) -> DataFrame:
    """Customer rows for the copied orders, each copy with persons of its own."""
    return _copies(customers, times).withColumns({
        "customer_id": _copied("customer_id"), "customer_unique_id": _copied("customer_unique_id")}).drop("copy")


def daily_batches(orders: DataFrame, batches: int) -> DataFrame:
    """Assign every order to one of ``batches`` load batches by digest of its id."""
    return orders.withColumn("batch_number", F.pmod(tie_number("order_id"), F.lit(batches)).cast("int"))
