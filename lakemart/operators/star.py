"""Star schema: dimensions and facts.

Surrogate keys are digests of the natural keys, so facts compute them without joining the
dimensions and every run gives the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.functions import digest, region_of, year_month
from lakemart.operators.enrich import with_product_bands
from lakemart.operators.joins import order_base, review_per_order
from lakemart.operators.performance import person_orders


def date_key(c) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def dim_date(orders: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last purchase."""
    span = orders.agg(F.min("purchase_date").alias("lo"), F.max("purchase_date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"), "full_date", F.dayofmonth(d).alias("day"), F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week"), F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"), F.year(d).alias("year"), year_month(d).alias("year_month"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_customer(orders: DataFrame, items: DataFrame, customers: DataFrame, regions: dict[str, str], as_of=None,
                 active_days: int = 180) -> DataFrame:
    """One row per person with the place of their latest order (Type 1).

    ``as_of`` defaults to the last purchase date; 'active' means a purchase in the last
    ``active_days`` days. The latest place is an aggregate, so a person with very many orders
    is reduced before the shuffle.
    """
    base = person_orders(orders, items, customers)
    as_of = F.lit(as_of).cast("date") if as_of is not None else orders.agg(F.max("purchase_date")).scalar()
    place = F.struct("customer_zip_code_prefix", "customer_city", "customer_state")
    people = base.groupBy("customer_unique_id").agg(
        F.max_by(place, F.struct("order_purchase_timestamp", "order_id")).alias("place"),
        F.min("purchase_date").alias("first_purchase_date"),
        F.max("purchase_date").alias("last_purchase_date"),
        F.count(F.lit(1)).alias("total_orders"),
    )
    last = F.col("last_purchase_date")
    return people.select(
        digest("customer_unique_id").alias("customer_key"), "customer_unique_id", "place.customer_zip_code_prefix",
        "place.customer_city", "place.customer_state",
        region_of("place.customer_state", regions).alias("customer_region"),
        "first_purchase_date", "last_purchase_date",
        F.datediff(last, "first_purchase_date").alias("customer_tenure_days"), "total_orders",
        F.when(F.datediff(as_of, last) <= active_days, "active").otherwise("inactive").alias("customer_status"),
    )


def dim_product(products: DataFrame) -> DataFrame:
    return with_product_bands(products).select(
        digest("product_id").alias("product_key"), "product_id",
        F.col("product_category_name_pt").alias("category_name_pt"),
        F.col("product_category_name_en").alias("category_name_en"), F.col("product_weight_g").alias("weight_g"),
        F.col("product_volume_cm3").alias("volume_cm3"), F.col("product_weight_band").alias("weight_band"),
        F.col("product_size_band").alias("size_band"),
    )


def dim_seller(sellers: DataFrame, regions: dict[str, str]) -> DataFrame:
    return sellers.select(
        digest("seller_id").alias("seller_key"), "seller_id", "seller_city", "seller_state",
        region_of("seller_state", regions).alias("seller_region"),
    )


def dim_geography(zips: DataFrame, regions: dict[str, str]) -> DataFrame:
    return zips.select(
        digest("zip_code_prefix").alias("geography_key"), "zip_code_prefix", "city", "state",
        region_of("state", regions).alias("region"), "latitude", "longitude",
    )


def dim_payment_type(payments: DataFrame) -> DataFrame:
    return payments.select("payment_type").distinct().select(digest("payment_type").alias("payment_type_key"), "payment_type")


def fact_order_items(orders: DataFrame, items: DataFrame, reviews: DataFrame, customers: DataFrame,
                     sellers: DataFrame) -> DataFrame:
    """One row per order item with dimension keys. Orders take their customer and review before the
    items join, so the item table is shuffled once by order."""
    headers = (
        orders.join(review_per_order(reviews), "order_id", "left")
        .join(customers.select("customer_id", "customer_unique_id", "customer_zip_code_prefix"), "customer_id", "left")
    )
    places = sellers.select("seller_id", "seller_zip_code_prefix")
    return items.join(places, "seller_id", "left").join(headers, "order_id").select(
        "order_id", "order_item_id", date_key("purchase_date").alias("date_key"),
        digest("customer_unique_id").alias("customer_key"), digest("product_id").alias("product_key"),
        digest("seller_id").alias("seller_key"), digest("customer_zip_code_prefix").alias("customer_geography_key"),
        digest("seller_zip_code_prefix").alias("seller_geography_key"), "order_status",
        F.col("price").alias("item_price"), F.col("freight_value").alias("freight_amount"), "total_item_amount",
        "delivery_duration_days", "delivery_delay_days", "review_score", "is_delivered", "is_cancelled",
        "is_late_delivery",
    )


def fact_orders(orders: DataFrame, items: DataFrame, reviews: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order, also those without items."""
    base = order_base(orders, items, reviews, include_empty_orders=True)
    people = customers.select("customer_id", "customer_unique_id")
    return base.join(people, "customer_id", "left").select(
        "order_id", date_key("purchase_date").alias("date_key"), digest("customer_unique_id").alias("customer_key"),
        "order_status", F.coalesce("items", F.lit(0)).alias("item_count"), F.col("gross").alias("item_revenue"),
        F.col("freight").alias("freight_revenue"), F.col("total").alias("total_order_value"),
        "delivery_duration_days", "delivery_delay_days", "review_score", "is_delivered", "is_cancelled",
        "is_late_delivery",
    )


def fact_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    days = orders.select("order_id", date_key("purchase_date").alias("date_key"))
    return payments.join(days, "order_id").select(
        "order_id", "payment_sequential", "date_key", digest("payment_type").alias("payment_type_key"),
        "payment_installments", "payment_value")


def fact_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    days = orders.select("order_id", date_key("purchase_date").alias("date_key"))
    return reviews.join(days, "order_id").select(
        "review_id", "order_id", "date_key", date_key("review_creation_date").alias("creation_date_key"), "review_score",
        "review_score_category", "has_review_message")
