"""Join patterns shared by the marts.

No join carries a broadcast hint on data that can grow: Spark broadcasts a side when its
estimated or, under AQE, measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and
shuffles otherwise, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.session import materialize


def broadcast_lookup(fact: DataFrame, dimension: DataFrame, on: list[str], max_bytes: int = 32 << 20) -> DataFrame:
    """Left join to a dimension, broadcast only if it takes at most ``max_bytes``; else the shuffle join.

    The dimension is stored once, so it is not computed again for the join, and its size is that of
    the stored file, times what unpacking strings and rows in memory costs.
    """
    stored = materialize(dimension, "dimension")
    in_memory = 5 * int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return fact.join(F.broadcast(stored) if in_memory <= max_bytes else stored, on, "left")


def with_default(df: DataFrame, column: str, default: str, name: str | None = None) -> DataFrame:
    """Replace the nulls a left join leaves."""
    return df.withColumn(name or column, F.coalesce(F.col(column), F.lit(default)))


def missing_parents(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent and how many rows use them. Keys are counted first, so a
    hot key is one row in the join."""
    used = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("child_rows"))
    known = parent.select(F.col(parent_key or child_key).alias(child_key))
    return used.join(known, child_key, "left_anti")


def review_per_order(reviews: DataFrame) -> DataFrame:
    """Lowest score per order: one row per order, so joining it cannot multiply items."""
    return reviews.groupBy("order_id").agg(F.min("review_score").alias("review_score"))


def item_base(orders: DataFrame, items: DataFrame, reviews: DataFrame, include_empty_orders: bool = False) -> DataFrame:
    """Orders with items and review score, one row per order item. Columns nobody asks for are not read."""
    return (
        orders.join(items, "order_id", "left" if include_empty_orders else "inner")
        .join(review_per_order(reviews), "order_id", "left")
    )


def item_totals(items: DataFrame, *by: str) -> DataFrame:
    """Counts and sums per order (and further item columns), reduced before any join."""
    return items.groupBy("order_id", *by).agg(
        F.count("order_item_id").alias("items"), F.sum("price").alias("gross"),
        F.sum("freight_value").alias("freight"), F.sum("total_item_amount").alias("total"),
    )


def order_base(orders: DataFrame, items: DataFrame, reviews: DataFrame, by: tuple[str, ...] = (),
               include_empty_orders: bool = False) -> DataFrame:
    """Orders with item totals and review score, one row per order (and ``by`` value).

    Item tables are large and orders can be hot, so the marts join this pre-aggregated form
    instead of single items. Both aggregates leave the data partitioned by order.
    """
    how = "left" if include_empty_orders else "inner"
    return (
        orders.join(item_totals(items, *by), "order_id", how)
        .join(review_per_order(reviews), "order_id", "left")
    )


#: State of orders without a customer record.
NO_STATE = "unknown"


def persons_of(orders: DataFrame, customers: DataFrame, known_only: bool = True) -> DataFrame:
    """Attach the person and their place to order rows. For products about persons, orders without a
    customer record drop; totals keep them (``known_only=False``), without a person, in the state 'unknown'."""
    if known_only:
        return orders.join(customers, "customer_id", "inner")
    return with_default(orders.join(customers, "customer_id", "left"), "customer_state", NO_STATE)
