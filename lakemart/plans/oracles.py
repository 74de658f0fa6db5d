"""Oracle SQL per query, written independently of the Spark code over the same raw mapping."""

from __future__ import annotations

from lakemart.plans.oracle_sources import STEPS, with_steps

ORACLES: dict[str, str] = {}

# --- cleaned entities -------------------------------------------------------------------

ORACLES["clean_customers"] = "SELECT * FROM customers"
ORACLES["clean_orders"] = "SELECT * FROM orders_clean"
ORACLES["clean_order_items"] = """
    SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, CAST(price AS DOUBLE) AS price,
           CAST(freight_value AS DOUBLE) AS freight_value, CAST(total_item_amount AS DOUBLE) AS total_item_amount
    FROM items"""
ORACLES["clean_products"] = "SELECT * FROM products"
ORACLES["translate_categories"] = "SELECT * FROM translation"
ORACLES["clean_sellers"] = "SELECT * FROM sellers"
ORACLES["clean_payments"] = """
    SELECT order_id, payment_sequential, payment_type, payment_installments, CAST(payment_value AS DOUBLE) AS payment_value
    FROM payments"""
ORACLES["clean_reviews"] = "SELECT * FROM reviews"
ORACLES["clean_geolocation"] = """
    SELECT zip_code_prefix, city, state, CAST(SUM(lat) AS DOUBLE) / COUNT(*) AS lat,
           CAST(SUM(lng) AS DOUBLE) / COUNT(*) AS lng, COUNT(*) AS coordinate_count
    FROM geo GROUP BY 1, 2, 3"""
ORACLES["clean_transactions"] = "SELECT * FROM transactions"

# --- further silver ---------------------------------------------------------------------

_BY_ZIP = """
    SELECT zip_code_prefix, MEDIAN(CAST(lat AS DOUBLE)) AS latitude, MEDIAN(CAST(lng AS DOUBLE)) AS longitude,
           ANY_VALUE(top.city) AS city, ANY_VALUE(top.state) AS state, COUNT(*) AS coordinate_count
    FROM geo JOIN (SELECT zip_code_prefix, city, state FROM geo GROUP BY 1, 2, 3
                   QUALIFY ROW_NUMBER() OVER (PARTITION BY zip_code_prefix ORDER BY COUNT(*) DESC, city, state) = 1) top
         USING (zip_code_prefix)
    GROUP BY 1"""
ORACLES["geolocation_by_zip"] = _BY_ZIP
ORACLES["order_extras"] = """
    SELECT order_id, CAST(YEAR(order_purchase_timestamp) AS INT) AS purchase_year,
           CAST(MONTH(order_purchase_timestamp) AS INT) AS purchase_month,
           CAST(DAYOFWEEK(order_purchase_timestamp) + 1 AS INT) AS purchase_day_of_week,
           CAST(HOUR(order_purchase_timestamp) AS INT) AS purchase_hour,
           CAST(DATEDIFF('second', order_purchase_timestamp, order_approved_at) AS DOUBLE) / 3600 AS approval_delay_hours,
           CAST(DATEDIFF('day', order_purchase_timestamp, order_estimated_delivery_date) AS INT)
               AS estimated_delivery_days,
           CAST(DATEDIFF('day', order_approved_at, order_delivered_carrier_date) AS INT) AS carrier_handling_days
    FROM orders_clean"""
ORACLES["product_bands"] = """
    SELECT product_id, COALESCE(product_category_name_en, 'unknown') AS product_category_name_en,
           CASE WHEN product_weight_g IS NULL THEN 'unknown' WHEN product_weight_g <= 100 THEN 'small'
                WHEN product_weight_g <= 300 THEN 'medium' ELSE 'large' END AS product_weight_band,
           CASE WHEN product_volume_cm3 IS NULL THEN 'unknown' WHEN product_volume_cm3 <= 1000 THEN 'small'
                WHEN product_volume_cm3 <= 20000 THEN 'medium' ELSE 'large' END AS product_size_band,
           product_volume_cm3 IS NOT NULL AND product_weight_g IS NOT NULL AS has_complete_dimensions
    FROM products"""
ORACLES["review_extras"] = """
    SELECT review_id, order_id, review_comment_title IS NOT NULL AS has_review_title,
           CAST(DATEDIFF('day', review_creation_date, review_answer_timestamp) AS INT) AS review_response_delay_days
    FROM reviews"""


def _region(column: str) -> str:
    return f"""COALESCE((SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey
        WHERE UPPER(TRIM(n_name)) = {column}), 'Unknown')"""


ORACLES["customer_extras"] = f"""
    SELECT customer_id, LOWER(STRIP_ACCENTS(customer_city)) AS customer_city_key,
           {_region('customer_state')} AS customer_region,
           REGEXP_FULL_MATCH(customer_zip_code_prefix, '[0-9]{{1,5}}') AS has_valid_zip,
           customer_state IN (SELECT UPPER(TRIM(n_name)) FROM nation) AS has_valid_state
    FROM customers"""
ORACLES["seller_place"] = f"""
    SELECT s.seller_id, s.seller_zip_code_prefix, s.seller_city, s.seller_state, z.latitude AS seller_latitude,
           z.longitude AS seller_longitude, {_region('s.seller_state')} AS seller_region
    FROM sellers s LEFT JOIN ({_BY_ZIP}) z ON s.seller_zip_code_prefix = z.zip_code_prefix"""
ORACLES["payment_summary"] = """
    SELECT order_id, CAST(SUM(payment_value) AS DOUBLE) AS payment_value, COUNT(*) AS payment_count,
           COUNT(DISTINCT payment_type) AS payment_methods, MAX(payment_installments) AS max_installments,
           COUNT(*) > 1 AS is_split_payment, BOOL_OR(payment_type = 'voucher') AS has_voucher
    FROM payments GROUP BY 1"""
ORACLES["review_summary"] = """
    SELECT order_id, COUNT(*) AS review_count, MIN(review_score) AS min_review_score,
           MAX(review_score) AS max_review_score, CAST(SUM(review_score) AS DOUBLE) / COUNT(*) AS avg_review_score,
           COUNT(*) FILTER (review_comment_message IS NOT NULL) AS message_count,
           CAST(SUM(DATEDIFF('day', review_creation_date, review_answer_timestamp)) AS DOUBLE)
               / NULLIF(COUNT(review_answer_timestamp), 0) AS avg_response_delay_days
    FROM reviews GROUP BY 1"""
ORACLES["order_details"] = """
    SELECT i.order_id, i.order_item_id, c.customer_unique_id, c.customer_state, p.product_category_name_en,
           p.product_volume_cm3, s.seller_state, o.purchase_date, o.order_status, o.is_late_delivery,
           CAST(i.price AS DOUBLE) AS price, CAST(i.total_item_amount AS DOUBLE) AS total_item_amount
    FROM items i JOIN orders_clean o USING (order_id) LEFT JOIN customers c USING (customer_id)
    LEFT JOIN products p USING (product_id) LEFT JOIN sellers s USING (seller_id)"""

# --- sales ------------------------------------------------------------------------------


def _money(expr: str, name: str) -> str:
    return f"CAST(SUM({expr}) AS DOUBLE) AS {name}"


def _flag_count(flag: str, grain: str) -> str:
    return f"COUNT(DISTINCT order_id) FILTER ({flag})" if grain == "order" else f"COUNT(*) FILTER ({flag})"


_SALES = f"""COUNT(DISTINCT order_id) AS order_count, COUNT(order_item_id) AS items_sold,
    {_money('price', 'gross_revenue')}, {_money('freight_value', 'freight_revenue')},
    {_money('total_item_amount', 'total_revenue')}, COUNT(DISTINCT customer_id) AS unique_customers,
    COUNT(DISTINCT seller_id) AS unique_sellers,
    CAST(SUM(review_score) AS DOUBLE) / NULLIF(COUNT(review_score), 0) AS avg_review_score,
    CAST(SUM(total_item_amount) AS DOUBLE) / COUNT(DISTINCT order_id) AS avg_order_value"""


def _daily(grain: str, source: str = "base") -> str:
    return f"""
    SELECT purchase_date, {_SALES}, {_flag_count('is_delivered', grain)} AS delivered_order_count,
           {_flag_count('is_cancelled', grain)} AS cancelled_order_count,
           CAST(COUNT(order_item_id) AS DOUBLE) / COUNT(DISTINCT order_id) AS avg_items_per_order
    FROM {source} GROUP BY purchase_date"""


def _monthly(grain: str) -> str:
    rates = ", ".join(
        f"CAST({_flag_count(flag, grain)} AS DOUBLE) / COUNT(DISTINCT order_id) AS {name}"
        for flag, name in [("is_delivered", "delivery_success_rate"), ("is_cancelled", "cancellation_rate"),
                           ("is_late_delivery", "late_delivery_rate")])
    return f"""
    SELECT * EXCLUDE (previous),
           CASE WHEN previous > 0 THEN CAST(exact_total - previous AS DOUBLE) / CAST(previous AS DOUBLE) END
               AS mom_revenue_growth
    FROM (SELECT purchase_year_month, {_SALES},
                 CAST(SUM(delivery_duration_days) AS DOUBLE) / NULLIF(COUNT(delivery_duration_days), 0)
                     AS avg_delivery_days, {rates}, SUM(total_item_amount) AS exact_total,
                 LAG(SUM(total_item_amount)) OVER (ORDER BY purchase_year_month) AS previous
          FROM base GROUP BY purchase_year_month)""".replace("EXCLUDE (previous)", "EXCLUDE (previous, exact_total)")


def _category(grain: str) -> str:
    return f"""
    SELECT purchase_year_month, COALESCE(p.product_category_name_en, 'unknown') AS category,
           COUNT(order_item_id) AS units_sold, {_money('price', 'gross_revenue')},
           {_money('total_item_amount', 'total_revenue')}, COUNT(DISTINCT order_id) AS order_count,
           COUNT(DISTINCT customer_id) AS unique_customers,
           CAST(SUM(price) AS DOUBLE) / COUNT(*) AS avg_item_price,
           CAST(SUM(freight_value) AS DOUBLE) / COUNT(*) AS avg_freight,
           CAST(SUM(review_score) AS DOUBLE) / NULLIF(COUNT(review_score), 0) AS avg_review_score,
           CAST({_flag_count('is_late_delivery', grain)} AS DOUBLE) / COUNT(DISTINCT order_id) AS late_delivery_rate
    FROM base b LEFT JOIN products p USING (product_id) GROUP BY 1, 2"""


ORACLES["agg_daily_sales"] = _daily("order")
ORACLES["agg_daily_sales_item_grain"] = _daily("item")
ORACLES["agg_daily_sales_all_orders"] = _daily("order", """(
    SELECT o.*, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value, i.total_item_amount, r.review_score
    FROM orders_clean o LEFT JOIN items i USING (order_id) LEFT JOIN order_reviews r USING (order_id))""").replace(
    "CAST(SUM(review_score) AS DOUBLE) / NULLIF(COUNT(review_score), 0)",
    "CAST(SUM(CASE WHEN order_item_id IS NOT NULL THEN review_score END) AS DOUBLE) "
    "/ NULLIF(COUNT(CASE WHEN order_item_id IS NOT NULL THEN review_score END), 0)")
ORACLES["agg_monthly_sales"] = _monthly("order")
ORACLES["agg_monthly_sales_item_grain"] = _monthly("item")
ORACLES["agg_category_performance"] = _category("order")
ORACLES["agg_category_performance_item_grain"] = _category("item")
ORACLES["category_revenue_share"] = f"""
    SELECT purchase_year_month, category,
           total_revenue / CAST(SUM(exact) OVER (PARTITION BY purchase_year_month) AS DOUBLE) AS category_revenue_share
    FROM (SELECT purchase_year_month, COALESCE(p.product_category_name_en, 'unknown') AS category,
                 {_money('total_item_amount', 'total_revenue')}, SUM(total_item_amount) AS exact
          FROM base LEFT JOIN products p USING (product_id) GROUP BY 1, 2)"""
ORACLES["hourly_client_spend"] = """
    SELECT client, DATE_TRUNC('hour', TRY_STRPTIME("timestamp", '%Y-%m-%d %H:%M:%S')) AS transaction_hour,
           CAST(SUM(CAST(ROUND(prix * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_spending, COUNT(*) AS transaction_count
    FROM raw_transactions GROUP BY 1, 2"""


# --- seller, delivery, payment, state, customer -----------------------------------------


def _mean(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DOUBLE) / NULLIF(COUNT({expr}), 0)"


STEPS["seller_orders"] = """
    SELECT b.seller_id, b.order_id, ANY_VALUE(purchase_year_month) AS purchase_year_month,
           ANY_VALUE(customer_id) AS customer_id, ANY_VALUE(review_score) AS score,
           ANY_VALUE(is_late_delivery) AS late, ANY_VALUE(is_cancelled) AS cancelled, COUNT(*) AS n, SUM(price) AS gross
    FROM base b GROUP BY 1, 2"""
STEPS["seller_months"] = f"""
    SELECT seller_id, purchase_year_month, COUNT(*) AS orders_received, CAST(SUM(n) AS BIGINT) AS items_sold,
           SUM(gross) AS exact_gross, CAST(SUM(gross) AS DOUBLE) / SUM(n) AS avg_item_price,
           {_mean('score')} AS avg_review_score, COUNT(*) FILTER (late) AS late_orders,
           COUNT(*) FILTER (cancelled) AS cancelled_orders,
           CAST(COUNT(*) FILTER (late) AS DOUBLE) / COUNT(*) AS late_delivery_rate,
           CAST(COUNT(*) FILTER (cancelled) AS DOUBLE) / COUNT(*) AS cancellation_rate,
           COUNT(DISTINCT customer_id) AS unique_customers
    FROM seller_orders GROUP BY 1, 2"""
STEPS["seller_scores"] = """
    SELECT seller_id, purchase_year_month, revenue_score, review_score, delivery_score, cancellation_score,
           revenue_score * 0.4e0 + review_score * 0.3e0 + delivery_score * 0.2e0 + cancellation_score * 0.1e0
               AS seller_score
    FROM (SELECT seller_id, purchase_year_month,
                 PERCENT_RANK() OVER (PARTITION BY purchase_year_month ORDER BY exact_gross) AS revenue_score,
                 PERCENT_RANK() OVER (PARTITION BY purchase_year_month ORDER BY COALESCE(avg_review_score, 0))
                     AS review_score,
                 PERCENT_RANK() OVER (PARTITION BY purchase_year_month ORDER BY late_delivery_rate DESC)
                     AS delivery_score,
                 PERCENT_RANK() OVER (PARTITION BY purchase_year_month ORDER BY cancellation_rate DESC)
                     AS cancellation_score
          FROM seller_months)"""

ORACLES["agg_seller_performance"] = """
    SELECT m.seller_id, m.purchase_year_month, orders_received, items_sold,
           CAST(exact_gross AS DOUBLE) AS gross_merchandise_value, avg_item_price, avg_review_score, late_delivery_rate,
           cancellation_rate, late_orders, cancelled_orders, unique_customers, p.active_products
    FROM seller_months m JOIN (SELECT seller_id, purchase_year_month, COUNT(DISTINCT product_id) AS active_products
                               FROM base GROUP BY 1, 2) p USING (seller_id, purchase_year_month)"""
ORACLES["seller_score"] = "SELECT * FROM seller_scores"


def _delivery(columns: list[str], source: str) -> str:
    keys = ", ".join(columns)
    known = "COUNT(delay)"
    return f"""
    SELECT {keys}, COUNT(*) AS orders, {_mean('days')} AS avg_delivery_days, MEDIAN(days) AS median_delivery_days,
           {_mean('delay')} AS avg_delay_days,
           CAST(COUNT(*) FILTER (delay <= 0) AS DOUBLE) / NULLIF({known}, 0) AS on_time_delivery_rate,
           CAST(COUNT(*) FILTER (delay > 0) AS DOUBLE) / NULLIF({known}, 0) AS late_delivery_rate,
           CAST(SUM(freight) AS DOUBLE) / SUM(items) AS avg_freight_value
    FROM (SELECT order_id, {keys}, ANY_VALUE(delivery_duration_days) AS days, ANY_VALUE(delivery_delay_days) AS delay,
                 SUM(freight_value) AS freight, COUNT(*) AS items
          FROM {source} GROUP BY order_id, {keys}) GROUP BY {keys}"""


_CATEGORIZED = """(SELECT b.*, COALESCE(p.product_category_name_en, 'unknown') AS category
                   FROM base b LEFT JOIN products p USING (product_id))"""
ORACLES["agg_delivery_by_date"] = _delivery(["purchase_date"], "base")
ORACLES["agg_delivery_by_state"] = _delivery(["customer_state"], "placed_items")
ORACLES["agg_delivery_by_seller"] = _delivery(["seller_id"], "base")
ORACLES["agg_delivery_by_category"] = _delivery(["category"], _CATEGORIZED)
ORACLES["agg_delivery_by_month_state"] = _delivery(["purchase_year_month", "customer_state"], "placed_items")
ORACLES["agg_payment_performance"] = """
    SELECT *, paid_value / SUM(paid_value) OVER (PARTITION BY purchase_year_month) AS payment_type_share
    FROM (SELECT purchase_year_month, payment_type, COUNT(*) AS payment_count, SUM(payment_value) AS paid_value,
                 CAST(SUM(payment_value) AS DOUBLE) / COUNT(*) AS avg_payment_value,
                 CAST(SUM(payment_installments) AS DOUBLE) / COUNT(*) AS avg_installments,
                 COUNT(DISTINCT order_id) FILTER (in_order > 1) AS multi_payment_order_count
          FROM (SELECT *, COUNT(*) OVER (PARTITION BY order_id) AS in_order FROM payments)
               JOIN orders_clean USING (order_id) GROUP BY 1, 2)"""
ORACLES["agg_payment_performance"] = ORACLES["agg_payment_performance"].replace(
    "SELECT *, paid_value / SUM(paid_value) OVER (PARTITION BY purchase_year_month)",
    "SELECT * REPLACE (CAST(paid_value AS DOUBLE) AS paid_value), CAST(paid_value AS DOUBLE) "
    "/ CAST(SUM(paid_value) OVER (PARTITION BY purchase_year_month) AS DOUBLE)")
ORACLES["agg_state_performance"] = f"""
    SELECT purchase_year_month, customer_state, COUNT(*) AS orders, COUNT(DISTINCT customer_unique_id) AS customers,
           {_money('total', 'revenue')}, CAST(SUM(total) AS DOUBLE) / COUNT(*) AS avg_order_value,
           {_mean('days')} AS avg_delivery_days,
           CAST(COUNT(*) FILTER (is_late_delivery) AS DOUBLE) / COUNT(*) AS late_delivery_rate,
           {_mean('score')} AS avg_review_score
    FROM placed_orders GROUP BY 1, 2"""
ORACLES["agg_customer_value"] = f"""
    SELECT customer_unique_id, COUNT(*) AS orders, {_money('total', 'total_spend')},
           CAST(SUM(total) AS DOUBLE) / COUNT(*) AS avg_order_value FROM person_orders GROUP BY 1"""
ORACLES["agg_customer_value_by_state"] = f"""
    SELECT customer_state, COUNT(*) AS orders, {_money('total', 'total_spend')},
           CAST(SUM(total) AS DOUBLE) / COUNT(*) AS avg_order_value, COUNT(DISTINCT customer_unique_id) AS customers
    FROM placed_orders GROUP BY 1"""
ORACLES["agg_person_sales"] = """
    SELECT purchase_year_month, COUNT(DISTINCT customer_id) AS unique_customers,
           COUNT(DISTINCT customer_unique_id) AS unique_persons FROM placed_orders GROUP BY 1"""

# --- star schema ------------------------------------------------------------------------

ORACLES["dim_date"] = """
    SELECT CAST(STRFTIME(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date, CAST(DAY(d) AS INT) AS day,
           DAYNAME(d) AS day_name, CAST(WEEK(d) AS INT) AS week, CAST(MONTH(d) AS INT) AS month,
           MONTHNAME(d) AS month_name, CAST(QUARTER(d) AS INT) AS quarter, CAST(YEAR(d) AS INT) AS year,
           STRFTIME(d, '%Y-%m') AS year_month, ISODOW(d) >= 6 AS is_weekend
    FROM (SELECT UNNEST(GENERATE_SERIES(MIN(purchase_date), MAX(purchase_date), INTERVAL 1 DAY)) AS d FROM orders_clean)"""
STEPS["latest_place"] = """
    SELECT customer_unique_id, customer_zip_code_prefix, customer_city, customer_state FROM person_orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_unique_id ORDER BY ts DESC, order_id DESC) = 1"""
ORACLES["dim_customer"] = f"""
    SELECT MD5(customer_unique_id) AS customer_key, customer_unique_id, customer_zip_code_prefix, customer_city,
           customer_state, {_region('customer_state')} AS customer_region, first_purchase_date, last_purchase_date,
           CAST(last_purchase_date - first_purchase_date AS INT) AS customer_tenure_days, total_orders,
           CASE WHEN (SELECT MAX(purchase_date) FROM orders_clean) - last_purchase_date <= 180 THEN 'active'
                ELSE 'inactive' END AS customer_status
    FROM latest_place JOIN (SELECT customer_unique_id, MIN(purchase_date) AS first_purchase_date,
                                   MAX(purchase_date) AS last_purchase_date, COUNT(*) AS total_orders
                            FROM person_orders GROUP BY 1) USING (customer_unique_id)"""
ORACLES["dim_product"] = f"""
    SELECT MD5(product_id) AS product_key, product_id, product_category_name_pt AS category_name_pt,
           b.product_category_name_en AS category_name_en, product_weight_g AS weight_g, product_volume_cm3 AS volume_cm3,
           b.product_weight_band AS weight_band, b.product_size_band AS size_band
    FROM products JOIN ({ORACLES['product_bands']}) b USING (product_id)"""
ORACLES["dim_seller"] = f"""
    SELECT MD5(seller_id) AS seller_key, seller_id, seller_city, seller_state,
           {_region('seller_state')} AS seller_region FROM sellers"""
ORACLES["dim_geography"] = f"""
    SELECT MD5(zip_code_prefix) AS geography_key, zip_code_prefix, city, state, {_region('state')} AS region,
           latitude, longitude FROM ({_BY_ZIP})"""
ORACLES["dim_payment_type"] = "SELECT DISTINCT MD5(payment_type) AS payment_type_key, payment_type FROM payments"
ORACLES["fact_order_items"] = """
    SELECT b.order_id, b.order_item_id, CAST(STRFTIME(purchase_date, '%Y%m%d') AS INT) AS date_key,
           MD5(c.customer_unique_id) AS customer_key, MD5(b.product_id) AS product_key, MD5(b.seller_id) AS seller_key,
           MD5(c.customer_zip_code_prefix) AS customer_geography_key,
           MD5(s.seller_zip_code_prefix) AS seller_geography_key, order_status, CAST(price AS DOUBLE) AS item_price,
           CAST(freight_value AS DOUBLE) AS freight_amount, CAST(total_item_amount AS DOUBLE) AS total_item_amount,
           delivery_duration_days, delivery_delay_days, review_score, is_delivered, is_cancelled, is_late_delivery
    FROM base b LEFT JOIN customers c USING (customer_id) LEFT JOIN sellers s USING (seller_id)"""
ORACLES["fact_orders"] = """
    SELECT o.order_id, CAST(STRFTIME(o.purchase_date, '%Y%m%d') AS INT) AS date_key,
           MD5(c.customer_unique_id) AS customer_key, o.order_status, COALESCE(t.items, 0) AS item_count,
           CAST(t.gross AS DOUBLE) AS item_revenue, CAST(t.freight AS DOUBLE) AS freight_revenue,
           CAST(t.total AS DOUBLE) AS total_order_value, o.delivery_duration_days, o.delivery_delay_days,
           r.review_score, o.is_delivered, o.is_cancelled, o.is_late_delivery
    FROM orders_clean o LEFT JOIN order_totals t USING (order_id) LEFT JOIN order_reviews r USING (order_id)
    LEFT JOIN customers c ON o.customer_id = c.customer_id"""
ORACLES["fact_payments"] = """
    SELECT order_id, payment_sequential, CAST(STRFTIME(purchase_date, '%Y%m%d') AS INT) AS date_key,
           MD5(payment_type) AS payment_type_key, payment_installments, CAST(payment_value AS DOUBLE) AS payment_value
    FROM payments JOIN orders_clean USING (order_id)"""
ORACLES["fact_reviews"] = """
    SELECT review_id, order_id, CAST(STRFTIME(purchase_date, '%Y%m%d') AS INT) AS date_key,
           CAST(STRFTIME(review_creation_date, '%Y%m%d') AS INT) AS creation_date_key, review_score,
           review_score_category, has_review_message
    FROM reviews JOIN orders_clean USING (order_id)"""

# --- customers --------------------------------------------------------------------------

_AS_OF = "(SELECT MAX(purchase_date) FROM orders_clean)"
STEPS["people"] = f"""
    SELECT customer_unique_id, MIN(purchase_date) AS first_purchase_date, MAX(purchase_date) AS last_purchase_date,
           COUNT(*) AS orders_made, SUM(total) AS spend, CAST({_AS_OF} - MAX(purchase_date) AS INT) AS recency_days,
           CAST('0x' || SUBSTR(MD5(customer_unique_id), 1, 15) AS BIGINT) AS tie
    FROM person_orders GROUP BY 1"""
_SEGMENT = """CASE WHEN r >= 4 AND f + m >= 8 THEN 'Champions' WHEN r >= 3 AND f + m >= 7 THEN 'Loyal customers'
    WHEN r >= 4 AND f <= 1 THEN 'New customers' WHEN r >= 3 THEN 'Potential loyalists'
    WHEN f + m >= 6 THEN 'At risk' WHEN r = 2 THEN 'Hibernating' ELSE 'Lost customers' END"""


def _rfm(score) -> str:
    return f"""
    SELECT customer_unique_id, last_purchase_date, recency_days, orders_made AS frequency_orders,
           CAST(spend AS DOUBLE) AS monetary_value, r AS recency_score, f AS frequency_score, m AS monetary_score,
           CAST(r AS VARCHAR) || CAST(f AS VARCHAR) || CAST(m AS VARCHAR) AS rfm_score, {_SEGMENT} AS customer_segment
    FROM (SELECT *, CAST({score('-recency_days')} AS INT) AS r, CAST({score('orders_made')} AS INT) AS f,
                 CAST({score('spend')} AS INT) AS m FROM people)"""


STEPS["rfm"] = _rfm(lambda v: f"NTILE(5) OVER (ORDER BY {v}, tie, customer_unique_id)")
ORACLES["customer_rfm"] = "SELECT * FROM rfm"
# The tile of the first row of each group of equal values.
ORACLES["customer_rfm_tied"] = _rfm(
    lambda v: f"MIN(tile_{v.strip('-')}) OVER (PARTITION BY {v})").replace(
    "FROM people)", """FROM (SELECT *, NTILE(5) OVER (ORDER BY -recency_days, tie) AS tile_recency_days,
        NTILE(5) OVER (ORDER BY orders_made, tie) AS tile_orders_made, NTILE(5) OVER (ORDER BY spend, tie) AS tile_spend
        FROM people))""")
ORACLES["rfm_segments"] = """
    SELECT customer_segment, COUNT(*) AS customers, CAST(SUM(p.spend) AS DOUBLE) AS monetary_value
    FROM rfm JOIN people p USING (customer_unique_id) GROUP BY 1"""
ORACLES["customer_360"] = f"""

    SELECT p.customer_unique_id, l.customer_city, l.customer_state, p.first_purchase_date, p.last_purchase_date,
           p.orders_made AS orders, CAST(p.spend AS DOUBLE) AS total_spend,
           CAST(p.spend AS DOUBLE) / p.orders_made AS avg_order_value, c.category AS preferred_category,
           y.payment_type AS preferred_payment_type, m.avg_review_score, m.avg_delivery_delay_days, rfm.customer_segment
    FROM people p JOIN latest_place l USING (customer_unique_id) JOIN rfm USING (customer_unique_id)
    JOIN (SELECT customer_unique_id, {_mean('score')} AS avg_review_score, {_mean('delay')} AS avg_delivery_delay_days
          FROM person_orders GROUP BY 1) m USING (customer_unique_id)
    LEFT JOIN (SELECT customer_unique_id, COALESCE(product_category_name_en, 'unknown') AS category
               FROM persons LEFT JOIN products USING (product_id) GROUP BY 1, 2
               QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_unique_id ORDER BY COUNT(*) DESC, category) = 1) c
         USING (customer_unique_id)
    LEFT JOIN (SELECT customer_unique_id, payment_type
               FROM payments JOIN orders_clean USING (order_id) JOIN customers USING (customer_id) GROUP BY 1, 2
               QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_unique_id ORDER BY COUNT(*) DESC, payment_type) = 1) y
         USING (customer_unique_id)"""
ORACLES["repeat_customers"] = f"""
    SELECT COUNT(*) AS customers, COUNT(*) FILTER (orders_made > 1) AS repeat_customers,
           COUNT(*) FILTER ({_AS_OF} - first_purchase_date < 90) AS new_customers,
           COUNT(*) FILTER (spend >= (SELECT QUANTILE_DISC(spend, 0.9) FROM people)) AS high_value_customers,
           CAST(SUM(spend) AS DOUBLE) / COUNT(*) AS avg_customer_value,
           CAST(SUM(orders_made) AS DOUBLE) / COUNT(*) AS avg_order_frequency
    FROM people"""
ORACLES["first_versus_repeat"] = f"""
    SELECT purchase_year_month,
           CASE WHEN purchase_year_month = STRFTIME(p.first_purchase_date, '%Y-%m') THEN 'first' ELSE 'repeat' END
               AS customer_kind,
           COUNT(DISTINCT customer_unique_id) AS customers, COUNT(*) AS orders, {_money('total', 'revenue')}
    FROM person_orders JOIN people p USING (customer_unique_id) GROUP BY 1, 2"""
ORACLES["cohort_retention"] = """
    SELECT *, CAST(customers AS DOUBLE) / MAX(CASE WHEN months_since = 0 THEN customers END)
                  OVER (PARTITION BY cohort_month) AS retention_rate
    FROM (SELECT STRFTIME(first_purchase_date, '%Y-%m') AS cohort_month,
                 CAST(DATEDIFF('month', first_purchase_date, purchase_date) AS INT) AS months_since,
                 COUNT(DISTINCT customer_unique_id) AS customers
          FROM person_orders JOIN people USING (customer_unique_id) GROUP BY 1, 2)"""
STEPS["baskets"] = """
    SELECT DISTINCT order_id, COALESCE(product_category_name_en, 'unknown') AS category
    FROM items LEFT JOIN products USING (product_id)"""
ORACLES["category_affinity"] = """
    SELECT category_a, category_b, pair_orders, CAST(pair_orders AS DOUBLE) / total AS support,
           CAST(pair_orders AS DOUBLE) / a.n AS confidence_a_to_b, CAST(pair_orders AS DOUBLE) / b.n AS confidence_b_to_a,
           (CAST(pair_orders AS DOUBLE) * total) / (CAST(a.n AS DOUBLE) * b.n) AS lift
    FROM (SELECT x.category AS category_a, y.category AS category_b, COUNT(*) AS pair_orders
          FROM baskets x JOIN baskets y ON x.order_id = y.order_id AND x.category < y.category GROUP BY 1, 2)
    JOIN (SELECT category, COUNT(*) AS n FROM baskets GROUP BY 1) a ON a.category = category_a
    JOIN (SELECT category, COUNT(*) AS n FROM baskets GROUP BY 1) b ON b.category = category_b,
    (SELECT COUNT(DISTINCT order_id) AS total FROM baskets)"""
ORACLES["churn_risk"] = """
    SELECT *, CASE WHEN mean_gap_days IS NULL THEN CASE WHEN recency_days > 365 THEN 'high' ELSE 'low' END
                   WHEN recency_days / mean_gap_days > 3 THEN 'high'
                   WHEN recency_days / mean_gap_days > 1.5 THEN 'medium' ELSE 'low' END AS churn_risk
    FROM (SELECT customer_unique_id, orders_made AS orders, recency_days,
                 CASE WHEN orders_made > 1 AND last_purchase_date > first_purchase_date
                      THEN CAST(last_purchase_date - first_purchase_date AS DOUBLE) / (orders_made - 1) END
                     AS mean_gap_days
          FROM people)"""

# --- scorecards and dashboards ----------------------------------------------------------

ORACLES["seller_scorecard"] = """
    SELECT seller_id, COUNT(*) AS active_months, CAST(SUM(orders_received) AS BIGINT) AS orders_received,
           CAST(SUM(items_sold) AS BIGINT) AS items_sold, CAST(SUM(exact_gross) AS DOUBLE) AS gross_merchandise_value,
           CAST(SUM(late_orders) AS DOUBLE) / SUM(orders_received) AS late_delivery_rate,
           CAST(SUM(cancelled_orders) AS DOUBLE) / SUM(orders_received) AS cancellation_rate,
           ROUND(CAST(SUM(CAST(seller_score AS DECIMAL(18,9))) AS DOUBLE) / COUNT(*), 6) AS avg_seller_score
    FROM seller_months JOIN seller_scores USING (seller_id, purchase_year_month) GROUP BY 1"""
ORACLES["product_scorecard"] = f"""
    SELECT product_id, category, orders, units_sold, CAST(revenue AS DOUBLE) AS revenue, avg_review_score,
           late_delivery_rate, PERCENT_RANK() OVER (PARTITION BY category ORDER BY revenue) AS revenue_rank_in_category
    FROM (SELECT product_id, ANY_VALUE(category) AS category, COUNT(*) AS orders, CAST(SUM(n) AS BIGINT) AS units_sold,
                 SUM(gross) AS revenue, {_mean('score')} AS avg_review_score,
                 CAST(COUNT(*) FILTER (late) AS DOUBLE) / COUNT(*) AS late_delivery_rate
          FROM (SELECT product_id, order_id, ANY_VALUE(COALESCE(product_category_name_en, 'unknown')) AS category,
                       COUNT(*) AS n, SUM(price) AS gross, ANY_VALUE(review_score) AS score,
                       ANY_VALUE(is_late_delivery) AS late
                FROM base LEFT JOIN products USING (product_id) GROUP BY 1, 2) GROUP BY 1)"""
_KPIS = f"""{_money('total', 'total_revenue')}, COUNT(*) AS orders,
    CAST(SUM(total) AS DOUBLE) / COUNT(*) AS avg_order_value, CAST(SUM(items) AS BIGINT) AS items_sold,
    CAST(COUNT(*) FILTER (is_cancelled) AS DOUBLE) / COUNT(*) AS cancellation_rate,
    CAST(COUNT(*) FILTER (delay <= 0) AS DOUBLE) / NULLIF(COUNT(delay), 0) AS on_time_rate,
    {_mean('score')} AS avg_review_score, COUNT(DISTINCT customer_unique_id) AS customers"""
ORACLES["executive_kpis"] = f"SELECT {_KPIS} FROM placed_orders"
ORACLES["sales_dashboard"] = f"""
    SELECT * EXCLUDE (exact, previous), CASE WHEN previous > 0
               THEN CAST(exact - previous AS DOUBLE) / CAST(previous AS DOUBLE) END AS revenue_growth
    FROM (SELECT purchase_year_month, {_KPIS}, SUM(total) AS exact,
                 LAG(SUM(total)) OVER (ORDER BY purchase_year_month) AS previous
          FROM placed_orders GROUP BY 1)"""
ORACLES["orders_by_status"] = "SELECT order_status, COUNT(*) AS orders FROM orders_clean GROUP BY 1"
ORACLES["revenue_by_state"] = f"""
    SELECT customer_state, {_money('total', 'revenue')}, COUNT(*) AS orders FROM placed_orders GROUP BY 1"""
ORACLES["top_categories"] = f"""
    SELECT COALESCE(product_category_name_en, 'unknown') AS category, {_money('total_item_amount', 'total_revenue')}
    FROM base LEFT JOIN products USING (product_id) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
ORACLES["top_sellers_by_month"] = """
    SELECT purchase_year_month, seller_id, CAST(exact_gross AS DOUBLE) AS gross_merchandise_value,
           CAST(RANK() OVER (PARTITION BY purchase_year_month ORDER BY exact_gross DESC) AS INT) AS revenue_rank
    FROM seller_months QUALIFY revenue_rank <= 3"""
ORACLES["late_seller_ranking"] = """
    SELECT seller_id, CAST(SUM(late_orders) AS BIGINT) AS late_orders,
           CAST(SUM(late_orders) AS DOUBLE) / SUM(orders_received) AS late_delivery_rate
    FROM seller_months GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10"""
ORACLES["delay_vs_score"] = f"""
    SELECT CASE WHEN d <= -8 THEN 'early 8+' WHEN d < 0 THEN 'early 1-7' WHEN d = 0 THEN 'on the day'
                WHEN d <= 7 THEN 'late 1-7' ELSE 'late 8+' END AS delay_bucket,
           COUNT(*) AS orders, {_mean('score')} AS avg_review_score
    FROM (SELECT delivery_delay_days AS d, review_score AS score FROM orders_clean JOIN order_reviews USING (order_id)
          WHERE delivery_delay_days IS NOT NULL) GROUP BY 1"""
ORACLES["delay_score_correlation"] = """
    SELECT n AS orders, (n * sxy - sx * sy) / (SQRT(n * sxx - sx * sx) * SQRT(n * syy - sy * sy)) AS correlation
    FROM (SELECT COUNT(*) AS n, CAST(SUM(x) AS DOUBLE) AS sx, CAST(SUM(y) AS DOUBLE) AS sy,
                 CAST(SUM(x * y) AS DOUBLE) AS sxy, CAST(SUM(x * x) AS DOUBLE) AS sxx, CAST(SUM(y * y) AS DOUBLE) AS syy
          FROM (SELECT delivery_delay_days AS x, review_score AS y
                FROM orders_clean JOIN order_reviews USING (order_id) WHERE delivery_delay_days IS NOT NULL))"""
ORACLES["seller_growth"] = """
    SELECT seller_id, purchase_year_month, CAST(exact_gross AS DOUBLE) AS gross_merchandise_value,
           CASE WHEN previous > 0 THEN CAST(exact_gross - previous AS DOUBLE) / CAST(previous AS DOUBLE) END
               AS revenue_growth
    FROM (SELECT *, LAG(exact_gross) OVER (PARTITION BY seller_id ORDER BY purchase_year_month) AS previous
          FROM seller_months)"""
ORACLES["seller_kpis"] = """
    SELECT purchase_year_month, COUNT(*) AS active_sellers, CAST(SUM(exact_gross) AS DOUBLE) AS gross_merchandise_value,
           ROUND(CAST(SUM(CAST(seller_score AS DECIMAL(18,9))) AS DOUBLE) / COUNT(*), 6) AS avg_seller_score,
           ROUND(CAST(SUM(CAST(avg_review_score AS DECIMAL(18,9))) AS DOUBLE) / COUNT(avg_review_score), 6)
               AS avg_seller_review
    FROM seller_months JOIN seller_scores USING (seller_id, purchase_year_month) GROUP BY 1"""


# --- quality ----------------------------------------------------------------------------


def _dq(table: str, rule: str, kind: str, checked: str, failed: str, source: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{rule}' AS rule_name, '{kind}' AS rule_type, checked AS rows_checked,
        failed AS rows_failed, COALESCE(CAST(failed AS DOUBLE) / NULLIF(checked, 0), 0) * 100 AS failure_percentage,
        CASE WHEN failed = 0 THEN 'passed' ELSE 'failed' END AS status
        FROM (SELECT {checked} AS checked, {failed} AS failed FROM {source})"""


_KEYS = {"customers": "customer_id", "orders": "order_id", "products": "product_id", "sellers": "seller_id",
         "order_items": "order_id, order_item_id", "payments": "order_id, payment_sequential"}
ORACLES["dq_uniqueness"] = " UNION ALL ".join(
    _dq(t, "unique_" + k.replace(", ", "_"), "uniqueness", "CAST(SUM(n) AS BIGINT)", "CAST(SUM(n - 1) AS BIGINT)",
        f"(SELECT {k}, COUNT(*) AS n FROM raw_{t} GROUP BY {k})") for t, k in _KEYS.items())
ORACLES["dq_referential"] = " UNION ALL ".join(
    _dq(t, f"{k}_in_{p}", "referential", f"COUNT({k})",
        f"COUNT(*) FILTER ({k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM {parent}))", child)
    for t, child, p, parent, k in [
        ("orders", "orders_clean", "customers", "customers", "customer_id"),
        ("order_items", "items", "orders", "orders_clean", "order_id"),
        ("order_items", "items", "products", "products", "product_id"),
        ("order_items", "items", "sellers", "sellers", "seller_id"),
        ("payments", "payments", "orders", "orders_clean", "order_id"),
        ("reviews", "reviews", "orders", "orders_clean", "order_id")])
_RULES = {
    "customers": {"customer_id_present": "customer_id IS NOT NULL",
                  "customer_unique_id_present": "customer_unique_id IS NOT NULL"},
    "orders": {"order_id_present": "order_id IS NOT NULL", "customer_id_present": "customer_id IS NOT NULL",
               "purchase_timestamp_valid":
                   "TRY_STRPTIME(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') IS NOT NULL"},
    "order_items": {"order_id_present": "order_id IS NOT NULL", "order_item_id_present": "order_item_id IS NOT NULL",
                    "price_not_negative": "price >= 0", "price_representable": "price < 1e16",
                    "freight_not_negative": "freight_value >= 0", "freight_representable": "freight_value < 1e16"},
    "products": {"product_id_present": "product_id IS NOT NULL"},
    "sellers": {"seller_id_present": "seller_id IS NOT NULL"},
    "payments": {"order_id_present": "order_id IS NOT NULL", "value_not_negative": "payment_value >= 0",
                 "value_representable": "payment_value < 1e16",
                 "installments_not_negative": "payment_installments >= 0"},
    "reviews": {"review_id_present": "review_id IS NOT NULL", "order_id_present": "order_id IS NOT NULL",
                "score_in_range": "review_score BETWEEN 1 AND 5"},
}
_DOMAIN = {t: dict(r) for t, r in _RULES.items() if t != "sellers"}
_DOMAIN["orders"]["status_allowed"] = (
    "LOWER(TRIM(order_status)) IN ('created', 'approved', 'invoiced', 'processing', 'shipped', 'delivered', "
    "'canceled', 'unavailable')")
_DOMAIN["products"]["weight_not_negative"] = "product_weight_g >= 0"
ORACLES["dq_domain"] = " UNION ALL ".join(
    _dq(t, name, "domain", "COUNT(*)", f"COUNT(*) FILTER (NOT COALESCE({ok}, FALSE))", f"raw_{t}")
    for t, rules in _DOMAIN.items() for name, ok in rules.items())
_TIME_RULES = {
    "approved_after_purchase": "order_approved_at < order_purchase_timestamp",
    "carrier_after_approval": "order_delivered_carrier_date < order_approved_at",
    "delivered_after_carrier": "order_delivered_customer_date < order_delivered_carrier_date",
    "delivered_after_purchase": "order_delivered_customer_date < order_purchase_timestamp",
    "estimate_after_purchase": "order_estimated_delivery_date < order_purchase_timestamp",
}
ORACLES["dq_timestamps"] = " UNION ALL ".join(
    _dq("orders", name, "timestamp", "COUNT(*)", f"COUNT(*) FILTER ({bad})", "orders_clean")
    for name, bad in _TIME_RULES.items())
_BROKEN_TIMES = ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in _TIME_RULES.items())
ORACLES["order_time_flags"] = f"""
    SELECT order_id, CONCAT_WS(',', {_BROKEN_TIMES}) AS violations,
           CONCAT_WS(',', {_BROKEN_TIMES}) <> '' AS has_time_violation FROM orders_clean"""
_BROKEN = ", ".join(f"CASE WHEN NOT COALESCE({ok}, FALSE) THEN '{name}' END"
                    for name, ok in _RULES["order_items"].items())
ORACLES["reject_split"] = f"""
    SELECT order_id, order_item_id, product_id, seller_id, price, CONCAT_WS(',', {_BROKEN}) AS errors
    FROM raw_order_items WHERE CONCAT_WS(',', {_BROKEN}) <> ''"""


def _reconcile(table: str, keys: str) -> str:
    ok = " AND ".join(f"({r})" for r in _RULES[table].values())
    return f"""SELECT '{table}' AS table_name, CAST(SUM(n) AS BIGINT) AS source_rows,
        COUNT(*) FILTER (valid > 0) AS target_rows, CAST(SUM(n - valid) AS BIGINT) AS rejected_rows,
        CAST(SUM(GREATEST(valid - 1, 0)) AS BIGINT) AS duplicate_rows, TRUE AS is_balanced
        FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER ({ok}) AS valid FROM raw_{table} GROUP BY {keys})"""


ORACLES["reconcile_silver"] = " UNION ALL ".join(
    _reconcile(t, k) for t, k in {**_KEYS, "reviews": "review_id, order_id"}.items())
ORACLES["reconcile_gold"] = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, CAST({value} AS DOUBLE) AS left_value, CAST({value} AS DOUBLE) AS right_value, "
    f"0.0e0 AS difference, 'passed' AS status FROM {source}"
    for name, value, source in [
        ("daily_gross_equals_fact", "SUM(price)", "base"), ("monthly_total_equals_daily", "SUM(total_item_amount)", "base"),
        ("daily_orders_equal_fact", "COUNT(DISTINCT order_id)", "base"),
        ("dimension_orders_equal_fact", "COUNT(*)", "person_orders"), ("no_negative_revenue", "0", "(SELECT 1)"),
        *[(f"{mart}_revenue_equals_daily", "SUM(total_item_amount)", "base") for mart in ("executive", "dashboard", "states")],
        *[(f"{mart}_orders_equal_daily", "COUNT(DISTINCT order_id)", "base") for mart in ("executive", "dashboard", "states")]])

# --- upsert, history, replication -------------------------------------------------------

ORACLES["upsert_orders"] = """
    SELECT order_id, customer_id,
           CASE WHEN purchase_date >= DATE '1999-10-01' AND order_status = 'shipped' THEN 'delivered' ELSE order_status END
               AS order_status, order_purchase_timestamp,
           CASE WHEN purchase_date >= DATE '2000-01-01' THEN 'insert'
                WHEN purchase_date >= DATE '1999-10-01' AND order_status = 'shipped' THEN 'update' ELSE 'unchanged' END
               AS change
    FROM orders_clean"""
ORACLES["incremental_months"] = ORACLES["agg_category_performance"]
ORACLES["scd2_customer"] = """
    SELECT customer_unique_id, ts AS order_purchase_timestamp,
           LEAD(ts) OVER (PARTITION BY customer_unique_id ORDER BY ts) AS valid_to,
           LEAD(ts) OVER (PARTITION BY customer_unique_id ORDER BY ts) IS NULL AS is_current,
           s.z AS customer_zip_code_prefix, s.c AS customer_city, s.st AS customer_state
    FROM (SELECT *, LAG(s) OVER (PARTITION BY customer_unique_id ORDER BY ts) AS before
          FROM (SELECT customer_unique_id, order_purchase_timestamp AS ts,
                       MAX({'z': customer_zip_code_prefix, 'c': customer_city, 'st': customer_state}) AS s
                FROM orders_clean JOIN customers USING (customer_id) GROUP BY 1, 2))
    WHERE before IS DISTINCT FROM s"""
_DRAW = "CAST('0x' || SUBSTR(MD5('{0}' || {1}), 1, 8) AS BIGINT) % 1000 < {2}"


def _shifted(column: str) -> str:
    return f"""CASE WHEN copy = 0 OR TRY_STRPTIME({column}, '%Y-%m-%d %H:%M:%S') IS NULL THEN {column}
        ELSE STRFTIME(TRY_STRPTIME({column}, '%Y-%m-%d %H:%M:%S') + TO_MONTHS(copy * 12), '%Y-%m-%d %H:%M:%S') END
        AS {column}"""


_NEW_ID = "CASE WHEN copy = 0 THEN {0} ELSE {0} || '-' || copy END"
ORACLES["replicate_orders"] = f"""
    SELECT {_NEW_ID.format('order_id')} AS order_id, {_NEW_ID.format('customer_id')} AS customer_id,
           CASE WHEN copy > 0 AND {_DRAW.format('status', _NEW_ID.format('order_id'), 20)} THEN '???'
                ELSE order_status END AS order_status,
           {', '.join(_shifted(c) for c in ['order_purchase_timestamp', 'order_approved_at',
                                            'order_delivered_carrier_date', 'order_delivered_customer_date',
                                            'order_estimated_delivery_date'])}
    FROM raw_orders, (SELECT UNNEST([0, 1, 2]) AS copy)"""
ORACLES["replicate_items"] = f"""
    SELECT {_NEW_ID.format('order_id')} AS order_id, order_item_id, product_id, seller_id, shipping_limit_date,
           CASE WHEN copy > 0 AND {_DRAW.format('price', _NEW_ID.format('order_id'), 5)} THEN -ABS(price)
                ELSE price END AS price, freight_value
    FROM raw_order_items, (SELECT UNNEST([0, 1]) AS copy)"""

# --- streaming --------------------------------------------------------------------------

ORACLES["stream_bronze"] = "SELECT * FROM raw_transactions"
ORACLES["stream_latest"] = "SELECT * FROM transactions"
ORACLES["stream_hourly_spend"] = ORACLES["hourly_client_spend"]


# --- joins, duplicates, hashes, skew ----------------------------------------------------

ORACLES["item_base"] = """
    SELECT order_id, customer_id, order_purchase_timestamp, purchase_date, purchase_year_month, order_status, is_delivered,
           is_cancelled, is_late_delivery, delivery_duration_days, delivery_delay_days, order_item_id, product_id,
           seller_id, CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
           CAST(total_item_amount AS DOUBLE) AS total_item_amount, review_score FROM base"""
ORACLES["item_categories"] = """
    SELECT order_id, order_item_id, COALESCE(product_category_name_en, 'unknown') AS category
    FROM items LEFT JOIN products USING (product_id)"""
ORACLES["missing_orders"] = """
    SELECT order_id, COUNT(*) AS child_rows FROM items
    WHERE NOT EXISTS (SELECT 1 FROM orders_clean o WHERE o.order_id = items.order_id) GROUP BY 1"""
ORACLES["exact_duplicates"] = """
    SELECT *, (SELECT COUNT(*) FROM raw_order_items) AS source_rows, COUNT(*) OVER () AS target_rows,
           (SELECT COUNT(*) FROM raw_order_items) - COUNT(*) OVER () AS duplicate_rows
    FROM (SELECT DISTINCT * FROM raw_order_items)"""
ORACLES["record_hashes"] = """
    SELECT customer_id, SHA256(customer_id || CHR(1) || COALESCE(customer_unique_id, CHR(0)) || CHR(1)
        || customer_zip_code_prefix || CHR(1) || customer_city || CHR(1) || customer_state) AS record_hash
    FROM raw_customers"""
ORACLES["customer_record_times"] = """
    SELECT customer_id, SHA256(customer_city || CHR(1) || customer_state) AS record_hash,
           TIMESTAMP '2002-01-01 00:00:00' AS record_created_at, TIMESTAMP '2002-01-01 00:00:00' AS record_updated_at
    FROM customers"""
ORACLES["salted_join"] = """
    SELECT order_id, order_item_id, seller_state FROM items LEFT JOIN sellers USING (seller_id)"""
ORACLES["salted_aggregate"] = f"""
    SELECT seller_id, {_money('price', 'revenue')}, COUNT(*) AS items FROM items GROUP BY 1"""
ORACLES["daily_batches"] = """
    SELECT CAST(CAST('0x' || SUBSTR(MD5(order_id), 1, 15) AS BIGINT) % 7 AS INT) AS batch_number, COUNT(*) AS orders
    FROM raw_orders GROUP BY 1"""

# --- files and tables -------------------------------------------------------------------

ORACLES["csv_reviews"] = ORACLES["clean_reviews"]
ORACLES["orders_table"] = ORACLES["clean_orders"]
ORACLES["hourly_spend_table"] = f"""
    SELECT *, CAST(SUM(transaction_count) OVER (PARTITION BY client) AS BIGINT) AS client_transactions
    FROM ({ORACLES['hourly_client_spend']})"""
ORACLES["upsert_orders_table"] = """
    SELECT order_id, customer_id,
           CASE WHEN purchase_date >= DATE '1999-10-01' AND order_status = 'shipped' THEN 'delivered' ELSE order_status END
               AS order_status, order_purchase_timestamp, purchase_year_month
    FROM orders_clean"""

ORACLES["batches_run_once"] = """
    SELECT 'load_orders' AS job_name, CAST(YEAR(order_purchase_timestamp) AS VARCHAR) AS batch_id, 'succeeded' AS status,
           COUNT(*) AS source_rows, COUNT(*) AS target_rows, COUNT(*) AS rows_in_table
    FROM orders_clean GROUP BY 2"""

ORACLES["bronze_load"] = """
    SELECT 'first' AS batch_id, FALSE AS malformed, COUNT(*) AS rows,
           COUNT(*) FILTER (customer_id IS NOT NULL AND customer_unique_id IS NOT NULL) AS valid_rows,
           COUNT(DISTINCT customer_id) AS records FROM raw_customers
    UNION ALL SELECT 'first', TRUE, COUNT(*), 0, COUNT(*) FROM supplier"""
ORACLES["quality_results"] = f"""
    SELECT *, 'run-1' AS run_id FROM ({ORACLES['dq_uniqueness']})
    UNION ALL SELECT *, 'run-2' FROM ({ORACLES['dq_timestamps']})"""
ORACLES["replaced_table"] = """
    SELECT seller_id, seller_state, TRUE AS processed_now, 0 AS rows_before, COUNT(*) OVER () AS rows_written FROM sellers"""
ORACLES["sql_model"] = """
    SELECT UPPER(client) AS client_name, COUNT(*) AS transactions, MAX(prix) AS highest_price FROM raw_transactions GROUP BY 1"""
ORACLES["sorted_daily_sales"] = """
    SELECT purchase_date, COUNT(DISTINCT order_id) AS order_count, ROW_NUMBER() OVER (ORDER BY purchase_date) AS position
    FROM base GROUP BY 1"""
ORACLES["compacted_payments"] = """
    SELECT COUNT(*) AS payments, CAST(SUM(payment_value) AS DOUBLE) AS paid, TRUE AS as_few_files_as_said FROM payments"""
ORACLES["layout_comparison"] = """
    SELECT layout, COUNT(*) AS orders, MAX(order_purchase_timestamp) AS latest
    FROM orders_clean, (SELECT UNNEST(['plain', 'by month']) AS layout) WHERE purchase_year_month = '1998-03' GROUP BY 1"""
ORACLES["order_freshness"] = """
    SELECT newest, EPOCH(TIMESTAMP '2001-08-01 12:00:00' - newest) / 3600 AS age_hours,
           newest >= TIMESTAMP '2001-07-31 12:00:00' AS is_fresh
    FROM (SELECT MAX(order_purchase_timestamp) AS newest FROM orders_clean)"""
ORACLES["load_anomalies"] = """
    SELECT CAST(year AS VARCHAR) AS batch_id, n AS target_rows, before AS previous_rows,
           CAST(n - before AS DOUBLE) / before AS relative_change
    FROM (SELECT year, n, LAG(n) OVER (ORDER BY year) AS before
          FROM (SELECT YEAR(order_purchase_timestamp) AS year, COUNT(*) AS n FROM orders_clean GROUP BY 1))
    WHERE ABS(CAST(n - before AS DOUBLE) / before) > 0.1"""
ORACLES["order_value_ranks"] = """
    SELECT order_id, CAST(total AS DOUBLE) AS total, RANK() OVER (ORDER BY total) AS value_rank
    FROM (SELECT order_id, SUM(total_item_amount) AS total FROM items GROUP BY 1)"""


def all_oracles() -> dict[str, str]:
    return {name: with_steps(sql) for name, sql in ORACLES.items()}
