"""Sales aggregates by day, month, category and client hour.

``grain="order"`` counts an order once in flags and rates. ``grain="item"`` counts it once per
item, as the original jobs do (a rate can then pass 1). Nothing here sorts; order belongs to
the writer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.functions import parse_timestamp, ratio, share
from lakemart.operators.joins import order_base, with_default


def _flagged(flag: str, grain: str) -> Column:
    """Rows with the flag: orders, or the items of those orders."""
    if grain == "order":
        return F.count_if(F.col(flag))
    if grain == "item":
        return F.coalesce(F.sum(F.when(F.col(flag), F.col("items"))), F.lit(0))
    raise ValueError(f"grain must be order or item, not {grain}")


def _item_mean(value: str) -> Column:
    """Mean over items of a measure that is constant within the order."""
    return ratio(F.sum(F.col(value) * F.col("items")), F.sum(F.when(F.col(value).isNotNull(), F.col("items"))))


def _distinct_sellers(orders: DataFrame, items: DataFrame, period: str) -> DataFrame:
    """Sellers per period. Pairs are made distinct before the join, and this is its own branch
    because a second distinct count in one aggregate would copy every row once per count."""
    pairs = items.select("order_id", "seller_id").distinct()
    return orders.select("order_id", period).join(pairs, "order_id").groupBy(period).agg(
        F.count_distinct("seller_id").alias("unique_sellers"))


def _sales(orders, items, reviews, period: str, measures: list[Column], include_empty_orders: bool) -> DataFrame:
    base = order_base(orders, items, reviews, include_empty_orders=include_empty_orders)
    per_period = base.groupBy(period).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("items_sold"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("freight").alias("freight_revenue"),
        F.sum("total").alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
        _item_mean("review_score").alias("avg_review_score"),
        *measures,
    )
    return per_period.join(_distinct_sellers(orders, items, period), period, "left").withColumns({
        "unique_sellers": F.coalesce("unique_sellers", F.lit(0)),
        "avg_order_value": ratio("total_revenue", "order_count"),
    })


def agg_daily_sales(orders: DataFrame, items: DataFrame, reviews: DataFrame, grain: str = "order",
                    include_empty_orders: bool = False) -> DataFrame:
    """One row per purchase date."""
    measures = [
        _flagged("is_delivered", grain).alias("delivered_order_count"),
        _flagged("is_cancelled", grain).alias("cancelled_order_count"),
    ]
    daily = _sales(orders, items, reviews, "purchase_date", measures, include_empty_orders)
    return daily.withColumn("avg_items_per_order", ratio("items_sold", "order_count"))


def agg_monthly_sales(orders: DataFrame, items: DataFrame, reviews: DataFrame, grain: str = "order",
                      include_empty_orders: bool = False) -> DataFrame:
    """One row per month with rates and growth over the previous month present."""
    rows = F.count(F.lit(1))
    measures = [
        _item_mean("delivery_duration_days").alias("avg_delivery_days"),
        ratio(_flagged("is_delivered", grain), rows).alias("delivery_success_rate"),
        ratio(_flagged("is_cancelled", grain), rows).alias("cancellation_rate"),
        ratio(_flagged("is_late_delivery", grain), rows).alias("late_delivery_rate"),
    ]
    monthly = _sales(orders, items, reviews, "purchase_year_month", measures, include_empty_orders)
    return with_growth(monthly, "total_revenue", "purchase_year_month", "mom_revenue_growth")


def with_growth(df: DataFrame, value: str, period: str, name: str, by: list[str] | None = None) -> DataFrame:
    """Relative change to the previous row; null unless the previous value is positive.

    The window holds one row per period (and ``by`` key), which the calendar bounds.
    """
    window = Window.partitionBy(*(by or [])).orderBy(period)
    previous = F.lag(value).over(window)
    return df.withColumn(name, F.when(previous > 0, ratio(F.col(value) - previous, previous)))


def _item_categories(items: DataFrame, products: DataFrame) -> DataFrame:
    names = products.select("product_id", F.col("product_category_name_en").alias("category"))
    return with_default(items.join(names, "product_id", "left"), "category", "unknown")


def agg_category_performance(orders: DataFrame, items: DataFrame, products: DataFrame, reviews: DataFrame,
                             grain: str = "order") -> DataFrame:
    """One row per month and category; items without a translated category are 'unknown'."""
    base = order_base(orders, _item_categories(items, products), reviews, by=("category",))
    rows = F.count(F.lit(1))
    return base.groupBy("purchase_year_month", "category").agg(
        F.sum("items").alias("units_sold"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("total").alias("total_revenue"),
        rows.alias("order_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
        ratio(F.sum("gross"), F.sum("items")).alias("avg_item_price"),
        ratio(F.sum("freight"), F.sum("items")).alias("avg_freight"),
        _item_mean("review_score").alias("avg_review_score"),
        ratio(_flagged("is_late_delivery", grain), rows).alias("late_delivery_rate"),
    )


def with_revenue_share(category_performance: DataFrame) -> DataFrame:
    """Share of the month's revenue; a month has as many rows as there are categories."""
    month = Window.partitionBy("purchase_year_month")
    return category_performance.withColumn("category_revenue_share", share("total_revenue", month))


#: Exact amounts; their sum keeps ten more digits, so that no number of rows overflows it.
EXACT = "decimal(28,10)"


def spend_parts(transactions: DataFrame) -> DataFrame:
    """Per client and hour over raw transactions: exact spend, spend beyond the exact type, and count.
    Parts of any cut of the rows can be added up; unreadable times share the null hour."""
    amount = F.col("prix")
    exact = amount.try_cast(EXACT)
    return transactions.groupBy(
        "client", F.date_trunc("hour", parse_timestamp("timestamp")).alias("transaction_hour")
    ).agg(
        F.sum(exact).alias("exact_spending"),
        F.sum(F.when(exact.isNull(), amount)).alias("other_spending"),
        F.count("id_transaction").alias("transaction_count"),
    )


def add_spend(parts: DataFrame) -> DataFrame:
    """Parts of the same client and hour as one."""
    return parts.groupBy("client", "transaction_hour").agg(
        F.sum("exact_spending").cast("decimal(38,10)").alias("exact_spending"), F.sum("other_spending").alias("other_spending"),
        F.sum("transaction_count").alias("transaction_count"))


def total_spend(parts: DataFrame, *more: str) -> DataFrame:
    """Whole sums of parts, with further columns passed through."""
    exact = F.col("exact_spending").cast("double")
    total = F.coalesce(exact + F.coalesce("other_spending", F.lit(0.0)), "other_spending")
    return parts.select("client", "transaction_hour", total.alias("total_spending"), "transaction_count", *more)


def hourly_client_spend(transactions: DataFrame) -> DataFrame:
    """Spend and count per client and hour over raw transactions; unreadable times share the null hour.
    Amounts are summed as exact decimals of ten digits behind the point, so that the order of rows does
    not matter; what is too large for that (from 1e18 on) is summed as it is, and nothing is left out."""
    return total_spend(spend_parts(transactions))
