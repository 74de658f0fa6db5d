"""Scorecards, rankings and dashboard figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.functions import ratio
from lakemart.operators.joins import order_base, review_per_order, with_default
from lakemart.operators.ranking import percent_ranks
from lakemart.operators.sales import with_growth
from lakemart.session import materialize


def seller_scorecard(performance: DataFrame, scores: DataFrame) -> DataFrame:
    """Seller months rolled up over all time with the mean score."""
    joined = performance.join(scores.select("seller_id", "purchase_year_month", "seller_score"),
                              ["seller_id", "purchase_year_month"], "left")
    orders = F.sum("orders_received")
    late, cancelled = F.sum("late_orders"), F.sum("cancelled_orders")
    # Scores are summed as decimals: the order of rows must not matter.
    return joined.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("active_months"), orders.alias("orders_received"), F.sum("items_sold").alias("items_sold"),
        F.sum("gross_merchandise_value").alias("gross_merchandise_value"),
        ratio(late, orders).alias("late_delivery_rate"), ratio(cancelled, orders).alias("cancellation_rate"),
        F.round(ratio(F.sum(F.col("seller_score").cast("decimal(18,9)")), F.count("seller_score")), 6)
        .alias("avg_seller_score"),
    )


def product_scorecard(orders: DataFrame, items: DataFrame, products: DataFrame, reviews: DataFrame, **limits) -> DataFrame:
    """Units, revenue, orders, score and revenue percent rank within the category per product."""
    base = order_base(orders, items, reviews, by=("product_id",))
    per_product = base.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("items").alias("units_sold"), F.sum("gross").alias("revenue"),
        ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"),
        ratio(F.count_if("is_late_delivery"), F.count(F.lit(1))).alias("late_delivery_rate"))
    names = products.select("product_id", F.col("product_category_name_en").alias("category"))
    named = materialize(with_default(per_product.join(names, "product_id", "left"), "category", "unknown"), "products")
    return percent_ranks(named, ["category"], "revenue", "revenue_rank_in_category", **limits)


def _kpis() -> list[Column]:
    rows = F.count(F.lit(1))
    known = F.count("delivery_delay_days")
    return [
        F.sum("total").alias("total_revenue"), rows.alias("orders"),
        ratio(F.sum("total"), rows).alias("avg_order_value"),
        F.sum("items").alias("items_sold"),
        ratio(F.count_if("is_cancelled"), rows).alias("cancellation_rate"),
        ratio(F.count_if(F.col("delivery_delay_days") <= 0), known).alias("on_time_rate"),
        ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"),
        F.count_distinct("customer_unique_id").alias("customers"),
    ]


def executive_kpis(person_orders: DataFrame) -> DataFrame:
    """One row over all orders of :func:`person_orders` (with reviews; ``known_only=False`` for whole totals)."""
    return person_orders.agg(*_kpis())


def sales_dashboard(person_orders: DataFrame) -> DataFrame:
    """The executive figures by month with revenue growth."""
    monthly = person_orders.groupBy("purchase_year_month").agg(*_kpis())
    return with_growth(monthly, "total_revenue", "purchase_year_month", "revenue_growth")


def orders_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))


def revenue_by_state(person_orders: DataFrame) -> DataFrame:
    return person_orders.groupBy("customer_state").agg(
        F.sum("total").alias("revenue"), F.count(F.lit(1)).alias("orders"))


def top_categories(category_performance: DataFrame, k: int = 5) -> DataFrame:
    """The k best-selling categories; sort and limit become one top-k step per task."""
    totals = category_performance.groupBy("category").agg(F.sum("total_revenue").alias("total_revenue"))
    return totals.orderBy(F.col("total_revenue").desc(), "category").limit(k)


def top_sellers_by_month(performance: DataFrame, k: int = 3) -> DataFrame:
    """Sellers ranked 1..k by revenue in each month (ties share a rank). The rank filter limits
    every map task to its own top k before the shuffle."""
    window = Window.partitionBy("purchase_year_month").orderBy(F.col("gross_merchandise_value").desc())
    return performance.select("purchase_year_month", "seller_id", "gross_merchandise_value") \
        .withColumn("revenue_rank", F.rank().over(window)).filter(F.col("revenue_rank") <= k)


def late_seller_ranking(performance: DataFrame, k: int = 10) -> DataFrame:
    """Sellers with the highest share of late orders over all time."""
    late = F.sum("late_orders")
    totals = performance.groupBy("seller_id").agg(
        late.alias("late_orders"), ratio(late, F.sum("orders_received")).alias("late_delivery_rate"))
    return totals.orderBy(F.col("late_delivery_rate").desc(), "seller_id").limit(k)


def delay_bucket(delay: Column) -> Column:
    return F.when(delay <= -8, "early 8+").when(delay < 0, "early 1-7").when(delay == 0, "on the day") \
        .when(delay <= 7, "late 1-7").otherwise("late 8+")


def _delays_and_scores(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    return orders.select("order_id", "delivery_delay_days").filter(F.col("delivery_delay_days").isNotNull()) \
        .join(review_per_order(reviews), "order_id")


def delay_vs_score(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders and mean review score by delivery delay."""
    return _delays_and_scores(orders, reviews).groupBy(delay_bucket(F.col("delivery_delay_days")).alias("delay_bucket")).agg(
        F.count(F.lit(1)).alias("orders"), ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"))


def delay_score_correlation(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Pearson correlation of delay and score from exact integer sums."""
    x, y = F.col("delivery_delay_days").cast("bigint"), F.col("review_score").cast("bigint")
    sums = _delays_and_scores(orders, reviews).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * y).alias("sxy"),
        F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"))

    def d(name):
        return F.col(name).cast("double")

    n = d("orders")
    spread = F.sqrt(n * d("sxx") - d("sx") * d("sx")) * F.sqrt(n * d("syy") - d("sy") * d("sy"))
    return sums.select("orders", F.try_divide(n * d("sxy") - d("sx") * d("sy"), spread).alias("correlation"))


def seller_growth(performance: DataFrame) -> DataFrame:
    """Revenue growth of each seller over their previous active month."""
    return with_growth(performance.select("seller_id", "purchase_year_month", "gross_merchandise_value"),
                       "gross_merchandise_value", "purchase_year_month", "revenue_growth", by=["seller_id"])


def seller_kpis(performance: DataFrame, scores: DataFrame) -> DataFrame:
    """By month: active sellers, revenue, mean score and review."""
    joined = performance.join(scores.select("seller_id", "purchase_year_month", "seller_score"),
                              ["seller_id", "purchase_year_month"], "left")
    exact = "decimal(18,9)"
    return joined.groupBy("purchase_year_month").agg(
        F.count(F.lit(1)).alias("active_sellers"), F.sum("gross_merchandise_value").alias("gross_merchandise_value"),
        F.round(ratio(F.sum(F.col("seller_score").cast(exact)), F.count("seller_score")), 6).alias("avg_seller_score"),
        F.round(ratio(F.sum(F.col("avg_review_score").cast(exact)), F.count("avg_review_score")), 6)
        .alias("avg_seller_review"),
    )
