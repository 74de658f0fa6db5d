"""Oracle side of the shared steps: raw and cleaned entities as named SQL subqueries."""

from __future__ import annotations

import re

from lakemart.sources.adapters import RAW_SQL, TABLES

_TS = "TRY_STRPTIME({0}, '%Y-%m-%d %H:%M:%S')"
_TITLE = "UPPER(LEFT(TRIM({0}), 1)) || LOWER(SUBSTR(TRIM({0}), 2))"


def _ts(c):
    return _TS.format(c)


def _title(c):
    return _TITLE.format(c)


STEPS: dict[str, str] = {
    f"raw_{name}": sql.format(**{t: t for t in TABLES}) for name, sql in RAW_SQL.items()
}

STEPS["customers"] = f"""
    SELECT customer_id, customer_unique_id, TRIM(customer_zip_code_prefix) AS customer_zip_code_prefix,
           {_title('customer_city')} AS customer_city, UPPER(TRIM(customer_state)) AS customer_state
    FROM raw_customers WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY customer_unique_id, 3, 4, 5) = 1"""

STEPS["orders_typed"] = f"""
    SELECT order_id, customer_id, LOWER(TRIM(order_status)) AS order_status,
           {_ts('order_purchase_timestamp')} AS order_purchase_timestamp,
           {_ts('order_approved_at')} AS order_approved_at,
           {_ts('order_delivered_carrier_date')} AS order_delivered_carrier_date,
           {_ts('order_delivered_customer_date')} AS order_delivered_customer_date,
           {_ts('order_estimated_delivery_date')} AS order_estimated_delivery_date
    FROM raw_orders"""

STEPS["orders_clean"] = """
    SELECT *, CAST(order_purchase_timestamp AS DATE) AS purchase_date,
           STRFTIME(order_purchase_timestamp, '%Y-%m') AS purchase_year_month,
           order_status = 'delivered' AS is_delivered, order_status = 'canceled' AS is_cancelled,
           CAST(DATEDIFF('day', order_purchase_timestamp, order_delivered_customer_date) AS INT)
               AS delivery_duration_days,
           CAST(DATEDIFF('day', order_estimated_delivery_date, order_delivered_customer_date) AS INT)
               AS delivery_delay_days,
           COALESCE(DATEDIFF('day', order_estimated_delivery_date, order_delivered_customer_date) > 0, FALSE)
               AS is_late_delivery
    FROM orders_typed WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_purchase_timestamp IS NOT NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY customer_id, order_status, order_purchase_timestamp) = 1"""

STEPS["items_typed"] = f"""
    SELECT order_id, order_item_id, product_id, seller_id, {_ts('shipping_limit_date')} AS shipping_limit_date,
           CAST(price AS DECIMAL(18,2)) AS price, CAST(freight_value AS DECIMAL(18,2)) AS freight_value
    FROM raw_order_items"""

STEPS["items"] = """
    SELECT *, CAST(price + freight_value AS DECIMAL(18,2)) AS total_item_amount
    FROM items_typed WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL AND price >= 0 AND freight_value >= 0
    QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, order_item_id
        ORDER BY price DESC, product_id, seller_id, shipping_limit_date NULLS LAST, freight_value) = 1"""

STEPS["translation"] = """
    SELECT LOWER(TRIM(product_category_name)) AS product_category_name,
           MIN(TRIM(product_category_name_english)) AS product_category_name_english
    FROM raw_category_translation GROUP BY 1"""

STEPS["products"] = """
    SELECT p.product_id, LOWER(TRIM(p.product_category_name)) AS product_category_name_pt,
           t.product_category_name_english AS product_category_name_en,
           p.product_name_length, p.product_description_length, p.product_photos_qty,
           CASE WHEN p.product_weight_g >= 0 THEN p.product_weight_g END AS product_weight_g,
           p.product_length_cm, p.product_height_cm, p.product_width_cm,
           p.product_length_cm * p.product_height_cm * p.product_width_cm AS product_volume_cm3,
           p.product_category_name IS NOT NULL AS has_category
    FROM raw_products p LEFT JOIN translation t
      ON LOWER(TRIM(p.product_category_name)) = t.product_category_name
    WHERE p.product_id IS NOT NULL"""

STEPS["sellers"] = f"""
    SELECT seller_id, TRIM(seller_zip_code_prefix) AS seller_zip_code_prefix, {_title('seller_city')} AS seller_city,
           UPPER(TRIM(seller_state)) AS seller_state
    FROM raw_sellers WHERE seller_id IS NOT NULL"""

STEPS["payments"] = """
    SELECT order_id, payment_sequential, LOWER(TRIM(payment_type)) AS payment_type, payment_installments,
           CAST(payment_value AS DECIMAL(18,2)) AS payment_value
    FROM raw_payments WHERE order_id IS NOT NULL AND payment_value >= 0 AND payment_installments >= 0"""

STEPS["reviews"] = f"""
    SELECT review_id, order_id, review_score, NULLIF(TRIM(review_comment_title), '') AS review_comment_title,
           NULLIF(TRIM(review_comment_message), '') AS review_comment_message,
           {_ts('review_creation_date')} AS review_creation_date,
           {_ts('review_answer_timestamp')} AS review_answer_timestamp,
           NULLIF(TRIM(review_comment_message), '') IS NOT NULL AS has_review_message,
           CASE WHEN review_score <= 2 THEN 'Negative' WHEN review_score = 3 THEN 'Neutral' ELSE 'Positive' END
               AS review_score_category
    FROM raw_reviews WHERE review_score BETWEEN 1 AND 5"""

STEPS["geo"] = f"""
    SELECT geolocation_zip_code_prefix AS zip_code_prefix, {_title('geolocation_city')} AS city,
           UPPER(TRIM(geolocation_state)) AS state, CAST(geolocation_lat AS DECIMAL(18,12)) AS lat,
           CAST(geolocation_lng AS DECIMAL(18,12)) AS lng
    FROM raw_geolocation
    WHERE geolocation_lat BETWEEN -90 AND 90 AND geolocation_lng BETWEEN -180 AND 180"""

STEPS["transactions"] = """
    SELECT id_transaction, UPPER(client) AS client_name, produit AS product_name, prix AS price,
           TRY_CAST("timestamp" AS TIMESTAMP) AS transaction_time
    FROM raw_transactions
    QUALIFY ROW_NUMBER() OVER (PARTITION BY id_transaction ORDER BY TRY_CAST("timestamp" AS TIMESTAMP) DESC NULLS LAST,
        prix DESC, UPPER(client), produit) = 1"""

# One row per order that has items, with the lowest review score.
STEPS["order_reviews"] = "SELECT order_id, MIN(review_score) AS review_score FROM reviews GROUP BY 1"

STEPS["base"] = """
    SELECT o.*, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value, i.total_item_amount,
           r.review_score
    FROM orders_clean o JOIN items i USING (order_id) LEFT JOIN order_reviews r USING (order_id)"""

STEPS["persons"] = "SELECT b.*, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state " \
                   "FROM base b JOIN customers c USING (customer_id)"

STEPS["order_totals"] = """
    SELECT order_id, ANY_VALUE(customer_id) AS customer_id, ANY_VALUE(order_purchase_timestamp) AS ts,
           ANY_VALUE(purchase_date) AS purchase_date, ANY_VALUE(purchase_year_month) AS purchase_year_month,
           ANY_VALUE(order_status) AS order_status, ANY_VALUE(is_delivered) AS is_delivered,
           ANY_VALUE(is_cancelled) AS is_cancelled,
           ANY_VALUE(is_late_delivery) AS is_late_delivery, ANY_VALUE(delivery_duration_days) AS days,
           ANY_VALUE(delivery_delay_days) AS delay, ANY_VALUE(review_score) AS score, COUNT(*) AS items,
           SUM(price) AS gross, SUM(freight_value) AS freight, SUM(total_item_amount) AS total
    FROM base GROUP BY order_id"""

STEPS["person_orders"] = "SELECT t.*, c.customer_unique_id, c.customer_zip_code_prefix, c.customer_city, " \
                         "c.customer_state FROM order_totals t JOIN customers c USING (customer_id)"

# The same for totals: orders without a customer record stay, in the state 'unknown'.
STEPS["placed_orders"] = """
    SELECT t.*, c.customer_unique_id, COALESCE(c.customer_state, 'unknown') AS customer_state
    FROM order_totals t LEFT JOIN customers c USING (customer_id)"""
STEPS["placed_items"] = """
    SELECT b.*, COALESCE(c.customer_state, 'unknown') AS customer_state
    FROM base b LEFT JOIN customers c USING (customer_id)"""


def with_steps(query: str) -> str:
    """Prefix a query with the named steps it uses."""
    needed: list[str] = []

    def need(text: str):
        for name, body in STEPS.items():
            if name not in needed and re.search(rf"\b{name}\b(?!\s*\.)", text) and body is not text:
                need(body)
                if name not in needed:
                    needed.append(name)

    need(query)
    if not needed:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in needed) + "\n" + query
