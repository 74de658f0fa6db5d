"""Seller, delivery, payment, state and customer aggregates.

All start from totals per order (and seller, product or category), so that no hot order or
product is joined item by item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lakemart.functions import ratio, share
from lakemart.operators.joins import item_totals, order_base, persons_of, review_per_order, with_default
from lakemart.operators.ranking import percent_ranks
from lakemart.session import materialize


def _distinct_per(orders: DataFrame, items: DataFrame, by: list[str], item_key: str, column: str, name: str) -> DataFrame:
    """Distinct item values per order attribute and item key, as its own narrow branch."""
    pairs = items.select("order_id", item_key, column).distinct()
    return orders.select("order_id", *[b for b in by if b != item_key]).join(pairs, "order_id") \
        .groupBy(*by).agg(F.count_distinct(column).alias(name))


def agg_seller_performance(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per seller and month. Rates and the review mean count an order once."""
    by = ["seller_id", "purchase_year_month"]
    base = order_base(orders, items, reviews, by=("seller_id",))
    rows = F.count(F.lit(1))
    per_seller = base.groupBy(*by).agg(
        rows.alias("orders_received"),
        F.sum("items").alias("items_sold"),
        F.sum("gross").alias("gross_merchandise_value"),
        ratio(F.sum("gross"), F.sum("items")).alias("avg_item_price"),
        ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"),
        ratio(F.count_if("is_late_delivery"), rows).alias("late_delivery_rate"),
        ratio(F.count_if("is_cancelled"), rows).alias("cancellation_rate"),
        F.count_if("is_late_delivery").alias("late_orders"),
        F.count_if("is_cancelled").alias("cancelled_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    products = _distinct_per(orders, items, by, "seller_id", "product_id", "active_products")
    return per_seller.join(products, by, "left")


#: Parts of the seller score; they should add up to 1.
SELLER_WEIGHTS = {"revenue": 0.4, "review": 0.3, "delivery": 0.2, "cancellation": 0.1}


def seller_score(performance: DataFrame, weights: dict[str, float] | None = None, **limits) -> DataFrame:
    """Weighted sum of percent ranks within the month. Sellers without a review rank lowest there.

    A month can hold all sellers, so ranks come from the distributed ranking.
    """
    weights = weights or SELLER_WEIGHTS
    measures = {
        "revenue": F.col("gross_merchandise_value"),
        "review": F.coalesce("avg_review_score", F.lit(0.0)),
        "delivery": -F.col("late_delivery_rate"),
        "cancellation": -F.col("cancellation_rate"),
    }
    keys = ["seller_id", "purchase_year_month"]
    # One long frame ranks all parts in one pass instead of one per part.
    parts = F.explode(F.array(*[
        F.struct(F.lit(name).alias("part"), value.cast("double").alias("value")) for name, value in measures.items()]))
    long = materialize(performance.select(*keys, parts.alias("p")).select(*keys, "p.part", "p.value"), "seller-parts")
    ranked = percent_ranks(long, ["purchase_year_month", "part"], "value", "rank", **limits)
    scored = ranked.groupBy(*keys).agg(*[
        F.max(F.when(F.col("part") == name, F.col("rank"))).alias(f"{name}_score") for name in measures])
    total = sum((F.col(f"{name}_score") * F.lit(weights[name]) for name in measures), F.lit(0.0))
    return scored.withColumn("seller_score", total)


DELIVERY_GRAINS = {"date": "purchase_date", "month": "purchase_year_month", "state": "customer_state",
                   "seller": "seller_id", "category": "category"}


def agg_delivery_performance(orders: DataFrame, items: DataFrame, by: list[str], customers: DataFrame | None = None,
                             products: DataFrame | None = None) -> DataFrame:
    """Delivery times by any of date, month, state, seller and category.

    An order counts once per group. On-time and late rates cover orders with a known delay.
    The first aggregate leaves one row per distinct outcome, so the exact median sees at most
    as many values as there are different day counts.
    """
    columns = [DELIVERY_GRAINS[b] for b in by]
    item_keys = [c for c in columns if c in ("seller_id", "category")]
    if "category" in columns:
        names = products.select("product_id", F.col("product_category_name_en").alias("category"))
        items = with_default(items.join(names, "product_id", "left"), "category", "unknown")
    base = orders.join(item_totals(items, *item_keys), "order_id")
    if "customer_state" in columns:
        base = persons_of(base, customers.select("customer_id", "customer_state"), known_only=False)
    outcomes = base.groupBy(*columns, "delivery_duration_days", "delivery_delay_days").agg(
        F.count(F.lit(1)).alias("n"), F.sum("freight").alias("freight"), F.sum("items").alias("items"))
    days, delay, n = F.col("delivery_duration_days"), F.col("delivery_delay_days"), F.col("n")
    known = F.sum(F.when(delay.isNotNull(), n))
    return outcomes.groupBy(*columns).agg(
        F.sum("n").alias("orders"),
        ratio(F.sum(days * n), F.sum(F.when(days.isNotNull(), n))).alias("avg_delivery_days"),
        F.percentile(days, 0.5, n).alias("median_delivery_days"),
        ratio(F.sum(delay * n), known).alias("avg_delay_days"),
        ratio(F.sum(F.when(delay <= 0, n).when(delay > 0, 0)), known).alias("on_time_delivery_rate"),
        ratio(F.sum(F.when(delay > 0, n).when(delay <= 0, 0)), known).alias("late_delivery_rate"),
        ratio(F.sum("freight"), F.sum("items")).alias("avg_freight_value"),
    )


def agg_payment_performance(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per month and payment type; the share is of the month's paid value, and multi-payment
    orders are those with more than one payment of any type."""
    per_type = payments.groupBy("order_id", "payment_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("payment_value").alias("value"),
        F.sum("payment_installments").alias("installments"))
    per_order = payments.groupBy("order_id").agg((F.count(F.lit(1)) > 1).alias("is_multi"))
    monthly = (
        orders.select("order_id", "purchase_year_month").join(per_type, "order_id").join(per_order, "order_id")
        .groupBy("purchase_year_month", "payment_type").agg(
            F.sum("n").alias("payment_count"),
            F.sum("value").alias("paid_value"),
            ratio(F.sum("value"), F.sum("n")).alias("avg_payment_value"),
            ratio(F.sum("installments"), F.sum("n")).alias("avg_installments"),
            F.count_if("is_multi").alias("multi_payment_order_count"),
        )
    )
    return monthly.withColumn("payment_type_share", share("paid_value", Window.partitionBy("purchase_year_month")))


def agg_state_performance(orders: DataFrame, items: DataFrame, reviews: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per month and customer state, order-weighted; customers are persons. Orders without a
    customer record are in the state 'unknown'."""
    base = persons_of(order_base(orders, items, reviews),
                      customers.select("customer_id", "customer_unique_id", "customer_state"), known_only=False)
    rows = F.count(F.lit(1))
    days, score = F.col("delivery_duration_days"), F.col("review_score")
    return base.groupBy("purchase_year_month", "customer_state").agg(
        rows.alias("orders"),
        F.count_distinct("customer_unique_id").alias("customers"),
        F.sum("total").alias("revenue"),
        ratio(F.sum("total"), rows).alias("avg_order_value"),
        ratio(F.sum(days), F.count(days)).alias("avg_delivery_days"),
        ratio(F.count_if("is_late_delivery"), rows).alias("late_delivery_rate"),
        ratio(F.sum(score), F.count(score)).alias("avg_review_score"),
    )


def person_orders(orders: DataFrame, items: DataFrame, customers: DataFrame, reviews: DataFrame | None = None,
                  known_only: bool = True) -> DataFrame:
    """One row per order with items, its totals, person and place (see :func:`persons_of`)."""
    base = orders.join(item_totals(items), "order_id")
    if reviews is not None:
        base = base.join(review_per_order(reviews), "order_id", "left")
    return persons_of(base, customers, known_only)


def agg_customer_value(orders: DataFrame, items: DataFrame, customers: DataFrame, by: str = "person") -> DataFrame:
    """Orders, spend and order value per known person, or per state of the order's address (all orders)."""
    base = person_orders(orders, items, customers, known_only=by == "person")
    key = {"person": "customer_unique_id", "state": "customer_state"}[by]
    people = [] if by == "person" else [F.count_distinct("customer_unique_id").alias("customers")]
    return base.groupBy(key).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total").alias("total_spend"),
        ratio(F.sum("total"), F.count(F.lit(1))).alias("avg_order_value"), *people)


def agg_person_sales(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Known persons per month beside the per-order customer ids that the sales marts count."""
    base = person_orders(orders, items, customers, known_only=False)
    return base.groupBy("purchase_year_month").agg(
        F.count(F.lit(1)).alias("unique_customers"), F.count_distinct("customer_unique_id").alias("unique_persons"))
