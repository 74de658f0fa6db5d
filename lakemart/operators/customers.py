"""Customer analytics per person (``customer_unique_id``).

Person-level measures are plain aggregates: even gaps between purchases follow from first,
last and count, so no window gathers all orders of one person.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.functions import ratio
from lakemart.operators.joins import item_totals, persons_of, review_per_order, with_default
from lakemart.operators.performance import person_orders
from lakemart.operators.ranking import ntile_by_value, quantile_value
from lakemart.session import materialize


def _as_of(orders: DataFrame, as_of) -> Column:
    return F.lit(as_of).cast("date") if as_of is not None else orders.agg(F.max("purchase_date")).scalar()


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Default segment rules over scores of 1 (low) to 5 (high); first match wins."""
    value = f + m
    return (
        F.when((r >= 4) & (value >= 8), "Champions")
        .when((r >= 3) & (value >= 7), "Loyal customers")
        .when((r >= 4) & (f <= 1), "New customers")
        .when(r >= 3, "Potential loyalists")
        .when((r <= 2) & (value >= 6), "At risk")
        .when(r == 2, "Hibernating")
        .otherwise("Lost customers")
    )


def customer_rfm(orders: DataFrame, items: DataFrame, customers: DataFrame, as_of=None, n: int = 5,
                 ties: str = "split", **limits) -> DataFrame:
    """Recency, frequency, monetary value and their quantile scores per person.

    Scores are exact ``ntile`` values; ``ties="together"`` keeps persons with equal values in
    one tile. ``as_of`` defaults to the last purchase date.
    """
    people = materialize(person_orders(orders, items, customers).groupBy("customer_unique_id").agg(
        F.max("purchase_date").alias("last_purchase_date"),
        F.count(F.lit(1)).alias("frequency_orders"),
        F.sum("total").alias("monetary_value"),
    ).withColumn("recency_days", F.datediff(_as_of(orders, as_of), "last_purchase_date")), "rfm-people")
    # Recent is good: rank the negative number of days, so that a high score is best throughout.
    values = {"recency": -F.col("recency_days"), "frequency": F.col("frequency_orders"), "monetary": F.col("monetary_value")}
    measures = F.array(*[
        F.struct(F.lit(m).alias("measure"), v.cast("decimal(30,2)").alias("value")) for m, v in values.items()])
    long = people.select("customer_unique_id", F.inline(measures))
    scored = ntile_by_value(long, "customer_unique_id", "value", n, "score", ["measure"], ties, **limits)
    scores = scored.groupBy("customer_unique_id").agg(*[
        F.max(F.when(F.col("measure") == m, F.col("score"))).alias(f"{m}_score") for m in values])
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    return people.join(scores, "customer_unique_id").withColumns({
        "rfm_score": F.concat(r.cast("string"), f.cast("string"), m.cast("string")),
        "customer_segment": rfm_segment(r, f, m),
    })


def _preferred(pairs: DataFrame, value: str, weight: Column) -> DataFrame:
    """Most frequent value per person, smallest name on ties; pairs are counted before choosing."""
    counts = pairs.groupBy("customer_unique_id", value).agg(weight.alias("n"))
    top = counts.filter(F.col(value).isNotNull()).groupBy("customer_unique_id").agg(
        F.min(F.struct((-F.col("n")).alias("n"), value)).alias("top"))
    return top.select("customer_unique_id", F.col(f"top.{value}").alias(f"preferred_{value}"))


def customer_360(orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame, payments: DataFrame,
                 reviews: DataFrame, rfm: DataFrame) -> DataFrame:
    """One row per person for marketing use. Orders with their persons are stored, because three branches
    read them: order totals, categories and payments."""
    buyers = materialize(persons_of(orders, customers).select(
        "order_id", "customer_unique_id", "customer_city", "customer_state", "order_purchase_timestamp", "purchase_date",
        "delivery_delay_days"), "buyers")
    base = buyers.join(item_totals(items), "order_id").join(review_per_order(reviews), "order_id", "left")
    place = F.struct("customer_city", "customer_state")
    people = base.groupBy("customer_unique_id").agg(
        F.max_by(place, F.struct("order_purchase_timestamp", "order_id")).alias("place"),
        F.min("purchase_date").alias("first_purchase_date"),
        F.max("purchase_date").alias("last_purchase_date"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("total").alias("total_spend"),
        ratio(F.sum("total"), F.count(F.lit(1))).alias("avg_order_value"),
        ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"),
        ratio(F.sum("delivery_delay_days"), F.count("delivery_delay_days")).alias("avg_delivery_delay_days"),
    )
    persons = buyers.select("order_id", "customer_unique_id")
    names = products.select("product_id", F.col("product_category_name_en").alias("category"))
    per_category = with_default(items.join(names, "product_id", "left"), "category", "unknown") \
        .groupBy("order_id", "category").agg(F.count(F.lit(1)).alias("pieces"))
    category = _preferred(persons.join(per_category, "order_id"), "category", F.sum("pieces"))
    per_type = payments.groupBy("order_id", "payment_type").agg(F.count(F.lit(1)).alias("pieces"))
    payment = _preferred(persons.join(per_type, "order_id"), "payment_type", F.sum("pieces"))
    return (
        people.join(category, "customer_unique_id", "left").join(payment, "customer_unique_id", "left")
        .join(rfm.select("customer_unique_id", "customer_segment"), "customer_unique_id", "left")
        .select("customer_unique_id", "place.customer_city", "place.customer_state", "first_purchase_date",
                "last_purchase_date", "orders", "total_spend", "avg_order_value", "preferred_category",
                "preferred_payment_type", "avg_review_score", "avg_delivery_delay_days", "customer_segment")
    )


def customer_kpis(orders: DataFrame, items: DataFrame, customers: DataFrame, as_of=None, new_days: int = 90,
                  high_value_share: float = 0.1, **limits) -> DataFrame:
    """One row: repeat, new and high-value customers, mean value and order frequency.

    New: first purchase within ``new_days``. High value: spend at or above the exact
    (1 - ``high_value_share``) quantile.
    """
    people = materialize(person_orders(orders, items, customers).groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total").alias("spend"), F.min("purchase_date").alias("first")),
        "customer-kpis")
    border = quantile_value(people.select("spend"), "spend", 1 - high_value_share, **limits)
    rows = F.count(F.lit(1))
    marked = people.withColumns({
        "is_high": F.col("spend") >= border,
        "is_new": F.datediff(_as_of(orders, as_of), "first") < new_days,
    })
    return marked.agg(
        rows.alias("customers"), F.count_if(F.col("orders") > 1).alias("repeat_customers"),
        F.count_if("is_new").alias("new_customers"), F.count_if("is_high").alias("high_value_customers"),
        ratio(F.sum("spend"), rows).alias("avg_customer_value"),
        ratio(F.sum("orders"), rows).alias("avg_order_frequency"),
    )


def first_versus_repeat(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Per month: orders and revenue of persons in their first month and of returning ones."""
    monthly = person_orders(orders, items, customers).groupBy("customer_unique_id", "purchase_year_month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total").alias("revenue"))
    # At most one row per calendar month and person reaches this window.
    first = F.min("purchase_year_month").over(Window.partitionBy("customer_unique_id"))
    kind = F.when(F.col("purchase_year_month") == first, "first").otherwise("repeat")
    return monthly.withColumn("customer_kind", kind).groupBy("purchase_year_month", "customer_kind").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))


def cohort_retention(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Active persons by first-purchase month and months since, with the share of the cohort."""
    active = person_orders(orders, items, customers).select(
        "customer_unique_id", F.trunc("purchase_date", "month").alias("month")).distinct()
    person = Window.partitionBy("customer_unique_id")  # one row per active month
    offset = (F.year("month") - F.year("first")) * 12 + F.month("month") - F.month("first")
    cells = active.withColumn("first", F.min("month").over(person)).groupBy(
        F.date_format("first", "yyyy-MM").alias("cohort_month"), offset.alias("months_since")
    ).agg(F.count(F.lit(1)).alias("customers"))
    cohort = Window.partitionBy("cohort_month")  # one row per month offset
    size = F.max(F.when(F.col("months_since") == 0, F.col("customers"))).over(cohort)
    return cells.withColumn("retention_rate", ratio("customers", size))


def category_affinity(items: DataFrame, products: DataFrame) -> DataFrame:
    """Category pairs bought in one order, with support, confidence and lift.

    Orders shrink to their set of categories and equal sets are counted once, so pairs are
    formed per distinct set, not per order. A set never exceeds the category list, and every
    pair formed is a row of the result; no basket is capped.
    """
    names = products.select("product_id", F.col("product_category_name_en").alias("category"))
    labelled = with_default(items.join(names, "product_id", "left"), "category", "unknown")
    sets = labelled.groupBy("order_id").agg(F.sort_array(F.collect_set("category")).alias("categories"))
    counted = materialize(sets.groupBy("categories").agg(F.count(F.lit(1)).alias("orders")), "category-sets")
    total = counted.agg(F.sum("orders")).scalar()
    single = counted.select(F.explode("categories").alias("category"), "orders").groupBy("category").agg(
        F.sum("orders").alias("category_orders"))
    first = counted.select(F.explode("categories").alias("category_a"), "categories", "orders")
    later = F.filter("categories", lambda c: c > F.col("category_a"))
    pairs = first.select("category_a", F.explode(later).alias("category_b"), "orders").groupBy(
        "category_a", "category_b").agg(F.sum("orders").alias("pair_orders"))
    a = single.select(F.col("category").alias("category_a"), F.col("category_orders").alias("a_orders"))
    b = single.select(F.col("category").alias("category_b"), F.col("category_orders").alias("b_orders"))
    both = pairs.join(a, "category_a").join(b, "category_b")
    return both.select(
        "category_a", "category_b", "pair_orders",
        ratio("pair_orders", total).alias("support"),
        ratio("pair_orders", "a_orders").alias("confidence_a_to_b"),
        ratio("pair_orders", "b_orders").alias("confidence_b_to_a"),
        F.try_divide(F.col("pair_orders").cast("double") * total.cast("double"),
                     F.col("a_orders").cast("double") * F.col("b_orders").cast("double")).alias("lift"),
    )


def churn_risk(orders: DataFrame, items: DataFrame, customers: DataFrame, as_of=None, medium: float = 1.5,
               high: float = 3.0, single_days: int = 365) -> DataFrame:
    """Days since the last purchase against the person's mean gap between orders.

    The mean gap is (last - first) / (orders - 1). Persons with one order, or all on one day,
    are judged by ``single_days``.
    """
    people = person_orders(orders, items, customers).groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("orders"), F.min("purchase_date").alias("first"), F.max("purchase_date").alias("last"))
    gap = ratio(F.datediff("last", "first"), F.col("orders") - 1)
    measured = people.select(
        "customer_unique_id", "orders", F.datediff(_as_of(orders, as_of), "last").alias("recency_days"),
        F.when(gap > 0, gap).alias("mean_gap_days"))
    pace = ratio("recency_days", "mean_gap_days")
    return measured.withColumn("churn_risk", (
        F.when(pace.isNull() & (F.col("recency_days") > single_days), "high")
        .when(pace.isNull(), "low").when(pace > high, "high").when(pace > medium, "medium").otherwise("low")))
