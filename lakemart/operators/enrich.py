"""Further silver columns and per-order summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.functions import (
    accents_removed, days_between, hours_between, ratio, region_of, row_hash, valid_zip,
)
from lakemart.operators.clean import tidy_geolocation
from lakemart.operators.joins import broadcast_lookup
from lakemart.operators.ranking import exact_median


def with_order_extras(orders: DataFrame) -> DataFrame:
    """Calendar parts of the purchase and the durations of the order's steps."""
    ts = "order_purchase_timestamp"
    return orders.withColumns({
        "purchase_year": F.year(ts),
        "purchase_month": F.month(ts),
        "purchase_day_of_week": F.dayofweek(ts),
        "purchase_hour": F.hour(ts),
        "approval_delay_hours": hours_between("order_approved_at", ts),
        "estimated_delivery_days": days_between("order_estimated_delivery_date", ts),
        "carrier_handling_days": days_between("order_delivered_carrier_date", "order_approved_at"),
    })


def with_product_bands(products: DataFrame, weight_limits=(100.0, 300.0), volume_limits=(1_000.0, 20_000.0),
                       missing_category: str = "unknown") -> DataFrame:
    """Weight and size bands. Upper limits are inclusive; the defaults are ours."""

    def band(column, limits):
        value = F.col(column)
        return F.when(value.isNull(), "unknown").when(value <= limits[0], "small") \
            .when(value <= limits[1], "medium").otherwise("large")

    complete = F.col("product_volume_cm3").isNotNull() & F.col("product_weight_g").isNotNull()
    return products.withColumns({
        "product_category_name_en": F.coalesce("product_category_name_en", F.lit(missing_category)),
        "product_weight_band": band("product_weight_g", weight_limits),
        "product_size_band": band("product_volume_cm3", volume_limits),
        "has_complete_dimensions": complete,
    })


def with_review_extras(reviews: DataFrame) -> DataFrame:
    return reviews.withColumns({
        "has_review_title": F.col("review_comment_title").isNotNull(),
        "review_response_delay_days": days_between("review_answer_timestamp", "review_creation_date"),
    })


def with_customer_extras(customers: DataFrame, regions: dict[str, str]) -> DataFrame:
    """Region, validity of zip and state, and a city key without accents."""
    return customers.withColumns({
        "customer_city_key": F.lower(accents_removed("customer_city")),
        "customer_region": region_of("customer_state", regions),
        "has_valid_zip": F.coalesce(valid_zip("customer_zip_code_prefix"), F.lit(False)),
        "has_valid_state": F.coalesce(F.col("customer_state").isin(list(regions)), F.lit(False)),
    })


def with_record_times(df: DataFrame, now, columns: list[str]) -> DataFrame:
    """Content hash and record times for a first load; an upsert keeps the creation time."""
    return df.withColumns({
        "record_hash": row_hash(*columns),
        "record_created_at": F.lit(now).cast("timestamp"),
        "record_updated_at": F.lit(now).cast("timestamp"),
    })


def geolocation_by_zip(raw: DataFrame, **limits) -> DataFrame:
    """One row per zip: median coordinates, most frequent place (smallest name on ties), count."""
    points = tidy_geolocation(raw)
    places = points.groupBy("zip_code_prefix", "city", "state").agg(F.count(F.lit(1)).alias("n"))
    place = places.groupBy("zip_code_prefix").agg(
        F.min(F.struct((-F.col("n")).alias("n"), "city", "state")).alias("top"),
        F.sum("n").alias("coordinate_count"),
    )
    axes = F.array(F.struct(F.lit("lat").alias("axis"), F.col("lat").alias("value")),
                   F.struct(F.lit("lng").alias("axis"), F.col("lng").alias("value")))
    medians = exact_median(points.select("zip_code_prefix", F.inline(axes)), ["zip_code_prefix", "axis"], "value",
                           "median", **limits)
    middle = medians.groupBy("zip_code_prefix").agg(
        F.max(F.when(F.col("axis") == "lat", F.col("median"))).alias("latitude"),
        F.max(F.when(F.col("axis") == "lng", F.col("median"))).alias("longitude"))
    return place.join(middle, "zip_code_prefix").select(
        "zip_code_prefix", "latitude", "longitude", F.col("top.city").alias("city"), F.col("top.state").alias("state"),
        "coordinate_count",
    )


def with_seller_place(sellers: DataFrame, zips: DataFrame, regions: dict[str, str]) -> DataFrame:
    """Region and approximate coordinates of sellers. ``zips`` has one row per zip."""
    points = zips.select(F.col("zip_code_prefix").alias("seller_zip_code_prefix"),
                         F.col("latitude").alias("seller_latitude"), F.col("longitude").alias("seller_longitude"))
    return sellers.join(points, "seller_zip_code_prefix", "left").withColumn(
        "seller_region", region_of("seller_state", regions))


def payment_summary(payments: DataFrame) -> DataFrame:
    """One row per order, so that orders can be joined to payments without multiplying items."""
    per_type = payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_value").alias("value"), F.count(F.lit(1)).alias("n"),
        F.max("payment_installments").alias("installments"))
    return per_type.groupBy("order_id").agg(
        F.sum("value").alias("payment_value"),
        F.sum("n").alias("payment_count"),
        F.count("payment_type").alias("payment_methods"),
        F.max("installments").alias("max_installments"),
        (F.sum("n") > 1).alias("is_split_payment"),
        F.coalesce(F.bool_or(F.col("payment_type") == "voucher"), F.lit(False)).alias("has_voucher"),
    )


def review_summary(reviews: DataFrame) -> DataFrame:
    delay = days_between("review_answer_timestamp", "review_creation_date")
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.min("review_score").alias("min_review_score"),
        F.max("review_score").alias("max_review_score"),
        ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review_score"),
        F.count_if("has_review_message").alias("message_count"),
        ratio(F.sum(delay), F.count(delay)).alias("avg_response_delay_days"),
    )


def order_details(orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame,
                  sellers: DataFrame) -> DataFrame:
    """Wide table, one row per order item. Customers join to orders before the items do, and products and
    sellers are broadcast as long as their size allows, so items are shuffled once, by order."""
    buyers = orders.join(customers, "customer_id", "left")
    named = broadcast_lookup(broadcast_lookup(items, products, ["product_id"]), sellers, ["seller_id"])
    return named.join(buyers, "order_id", "inner")
