"""Declared input schemas and business keys (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the source files.
_DECLARED = {
    "transactions": "id_transaction string, client string, produit string, prix double, timestamp string",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                 "customer_city string, customer_state string",
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
              "order_approved_at string, order_delivered_carrier_date string, "
              "order_delivered_customer_date string, order_estimated_delivery_date string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
                   "shipping_limit_date string, price double, freight_value double",
    "products": "product_id string, product_category_name string, product_name_length int, "
                "product_description_length int, product_photos_qty int, product_weight_g double, "
                "product_length_cm double, product_height_cm double, product_width_cm double",
    "category_translation": "product_category_name string, product_category_name_english string",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "payments": "order_id string, payment_sequential int, payment_type string, payment_installments int, "
                "payment_value double",
    "reviews": "review_id string, order_id string, review_score int, review_comment_title string, "
               "review_comment_message string, review_creation_date string, review_answer_timestamp string",
    "geolocation": "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
                   "geolocation_city string, geolocation_state string",
}

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}


def _struct(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS = {name: _struct(columns) for name, columns in _DECLARED.items()}

KEYS = {
    "transactions": ["id_transaction"],
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "products": ["product_id"],
    "category_translation": ["product_category_name"],
    "sellers": ["seller_id"],
    "payments": ["order_id", "payment_sequential"],
    "reviews": ["review_id", "order_id"],
}

# Order life-cycle states.
ORDER_STATUSES = ["created", "approved", "invoiced", "processing", "shipped", "delivered", "canceled", "unavailable"]
