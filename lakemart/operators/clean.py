"""Entity cleaning: raw source columns in, typed and unique rows out.

Each function is one filter, one projection and at most one shuffle (the dedup).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.functions import (
    blank_to_null, days_between, money, parse_timestamp, ratio, score_category, tidy, tidy_lower, tidy_title,
    tidy_upper, year_month,
)
from lakemart.operators.dedup import dedup, keep_latest
from lakemart.operators.rules import entity_rules, keep_valid
from lakemart.schemas import KEYS

ORDER_TIMES = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]


def _valid(raw: DataFrame, entity: str) -> DataFrame:
    return keep_valid(raw, entity_rules(entity))


def clean_customers(raw: DataFrame) -> DataFrame:
    tidied = _valid(raw, "customers").withColumns({
        "customer_city": tidy_title("customer_city"),
        "customer_state": tidy_upper("customer_state"),
        "customer_zip_code_prefix": tidy("customer_zip_code_prefix"),
    })
    return dedup(tidied, KEYS["customers"])


def clean_orders(raw: DataFrame) -> DataFrame:
    """Typed orders with date parts, status flags and delivery measures."""
    typed = _valid(raw, "orders").withColumns({
        **{c: parse_timestamp(c) for c in ORDER_TIMES},
        "order_status": tidy_lower("order_status"),
    })
    unique = dedup(typed, KEYS["orders"])
    delay = days_between("order_delivered_customer_date", "order_estimated_delivery_date")
    return unique.withColumns({
        "purchase_date": F.to_date("order_purchase_timestamp"),
        "purchase_year_month": year_month("order_purchase_timestamp"),
        "is_delivered": F.col("order_status") == "delivered",
        "is_cancelled": F.col("order_status") == "canceled",
        "delivery_duration_days": days_between("order_delivered_customer_date", "order_purchase_timestamp"),
        "delivery_delay_days": delay,
        "is_late_delivery": F.coalesce(delay > 0, F.lit(False)),
    })


def clean_order_items(raw: DataFrame) -> DataFrame:
    """Valid items; of equal keys the dearest row survives."""
    typed = _valid(raw, "order_items").withColumns({
        "price": money("price"),
        "freight_value": money("freight_value"),
        "shipping_limit_date": parse_timestamp("shipping_limit_date"),
    })
    unique = dedup(typed, KEYS["order_items"], [F.col("price").desc()])
    return unique.withColumn("total_item_amount", money(F.col("price") + F.col("freight_value")))


def clean_translation(raw: DataFrame) -> DataFrame:
    """Category names: one english name per source name."""
    tidied = raw.withColumns({
        "product_category_name": tidy_lower("product_category_name"),
        "product_category_name_english": tidy("product_category_name_english"),
    })
    return dedup(tidied, KEYS["category_translation"])


def clean_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with both category names, checked weight and volume. ``translation`` is raw."""
    tidied = _valid(raw, "products").withColumn("product_category_name", tidy_lower("product_category_name"))
    named = dedup(tidied, KEYS["products"]).join(clean_translation(translation), "product_category_name", "left")
    return named.withColumns({
        "product_weight_g": F.when(F.col("product_weight_g") >= 0, F.col("product_weight_g")),
        "product_volume_cm3": F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"),
        "has_category": F.col("product_category_name").isNotNull(),
    }).withColumnsRenamed({
        "product_category_name": "product_category_name_pt",
        "product_category_name_english": "product_category_name_en",
    })


def clean_sellers(raw: DataFrame) -> DataFrame:
    tidied = _valid(raw, "sellers").withColumns({
        "seller_city": tidy_title("seller_city"),
        "seller_state": tidy_upper("seller_state"),
        "seller_zip_code_prefix": tidy("seller_zip_code_prefix"),
    })
    return dedup(tidied, KEYS["sellers"])


def clean_payments(raw: DataFrame) -> DataFrame:
    typed = _valid(raw, "payments").withColumns({
        "payment_type": tidy_lower("payment_type"),
        "payment_value": money("payment_value"),
    })
    return dedup(typed, KEYS["payments"])


def clean_reviews(raw: DataFrame) -> DataFrame:
    typed = _valid(raw, "reviews").withColumns({
        "review_creation_date": parse_timestamp("review_creation_date"),
        "review_answer_timestamp": parse_timestamp("review_answer_timestamp"),
        "review_comment_title": blank_to_null("review_comment_title"),
        "review_comment_message": blank_to_null("review_comment_message"),
    })
    return dedup(typed, KEYS["reviews"]).withColumns({
        "has_review_message": F.col("review_comment_message").isNotNull(),
        "review_score_category": score_category("review_score"),
    })


def clean_scores(raw: DataFrame) -> DataFrame:
    """Order and score of the rows of :func:`clean_reviews`, for marts that need no more; texts are not read."""
    return dedup(_valid(raw, "reviews"), KEYS["reviews"], columns=["order_id", "review_score"])


def tidy_geolocation(raw: DataFrame) -> DataFrame:
    """Valid coordinates with normalized place names; coordinates become exact decimals so that
    sums do not depend on row order."""
    return _valid(raw, "geolocation").select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        tidy_title("geolocation_city").alias("city"),
        tidy_upper("geolocation_state").alias("state"),
        F.col("geolocation_lat").cast("decimal(18,12)").alias("lat"),
        F.col("geolocation_lng").cast("decimal(18,12)").alias("lng"),
    )


def clean_geolocation(raw: DataFrame) -> DataFrame:
    """Centroid and number of coordinates per zip, city and state."""
    return tidy_geolocation(raw).groupBy("zip_code_prefix", "city", "state").agg(
        ratio(F.sum("lat"), F.count("lat")).alias("lat"),
        ratio(F.sum("lng"), F.count("lng")).alias("lng"),
        F.count(F.lit(1)).alias("coordinate_count"),
    )


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Latest row per transaction id, by parsed time."""
    typed = raw.select(
        "id_transaction",
        F.upper("client").alias("client_name"),
        F.col("produit").alias("product_name"),
        F.col("prix").alias("price"),
        F.col("timestamp").try_cast("timestamp").alias("transaction_time"),
    )
    return latest_transaction(typed)


def latest_transaction(typed: DataFrame) -> DataFrame:
    """Latest of the typed versions of each transaction; any part of them may have been reduced before."""
    return keep_latest(typed, ["id_transaction"], "transaction_time", [F.col("price").desc_nulls_last()])
