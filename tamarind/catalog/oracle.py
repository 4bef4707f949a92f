"""The model as plain SQL common table expressions.

Written naively, one window or subquery per rule, so that it shares no plan and
no code with the Spark operators. ``sql(select)`` prepends the expressions that a
statement mentions, directly or through others.
"""

from __future__ import annotations

import re

from tamarind.catalog.roles import ROLES, role_sql
from tamarind.functions import fixed


def rnd(x: str, n: int = 2) -> str:
    """Half-up rounding on the decimal digits of a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(30,10)), {n}) AS DOUBLE)"


def pct(a: str, b: str, n: int = 2) -> str:
    return rnd(f"CAST({a} AS DOUBLE) * 100 / nullif({b}, 0)", n)


def clean(c: str) -> str:
    return f"trim(translate(lower({c}), '{fixed.ACCENTED}', '{fixed.PLAIN}'))"


def region(c: str) -> str:
    by_region: dict[str, list[str]] = {}
    for state, name in fixed.STATE_REGION.items():
        by_region.setdefault(name, []).append(f"'{state}'")
    cases = " ".join(f"WHEN {c} IN ({', '.join(s)}) THEN '{r}'" for r, s in by_region.items())
    return f"CASE {cases} ELSE 'Unknown' END"


def day_key(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS BIGINT)"


def days(start: str, end: str) -> str:
    return f"date_diff('day', {start}, {end})"


def secs(start: str, end: str) -> str:
    return f"(epoch({end}) - epoch({start}))"


def lifecycle(gap: str, late: str, undated: str = "'Unknown'") -> str:
    return f"""CASE WHEN order_status = 'canceled' THEN 'Canceled' WHEN order_status = 'unavailable' THEN 'Unavailable'
        WHEN order_status IN ('shipped', 'processing', 'approved', 'created', 'invoiced') THEN 'In Progress'
        WHEN order_status = 'delivered' AND {gap} < 0 THEN 'Early'
        WHEN order_status = 'delivered' AND {gap} = 0 THEN 'On Time'
        WHEN order_status = 'delivered' AND {gap} > 0 THEN '{late}'
        WHEN order_status = 'delivered' THEN {undated} ELSE 'Unknown' END"""


def location(city: str, state: str) -> str:
    metro = ", ".join(f"'{c}'" for c in fixed.METRO_CITIES)
    return f"""CASE WHEN {city} IN ({metro}) THEN 'Metropolitan' WHEN {state} IN ('SP', 'RJ', 'MG') THEN 'Urban'
        ELSE 'Regional' END"""


_BAD_LIMIT = """(shipping_limit_date IS NULL OR shipping_limit_date < order_purchase_timestamp
    OR shipping_limit_date < order_approved_at)"""

CTES = {
    "geo_points": f"""
        SELECT DISTINCT TRY_CAST(geolocation_zip_code_prefix AS INTEGER) AS zip, geolocation_lat AS lat,
               geolocation_lng AS lng, {clean('geolocation_city')} AS city, upper(trim(geolocation_state)) AS state
        FROM raw_geo""",
    "geo_valid": """
        SELECT * FROM geo_points WHERE zip IS NOT NULL AND lat BETWEEN -34 AND 6 AND lng BETWEEN -75 AND -28""",
    "silver_geo": f"""
        SELECT p.zip AS zip_code_prefix, p.city, p.state, {region('p.state')} AS region,
               m.median_latitude, m.median_longitude
        FROM (SELECT zip, city, state, row_number() OVER (PARTITION BY zip ORDER BY count(*) DESC, city, state) AS rn
              FROM geo_valid GROUP BY zip, city, state) p
        JOIN (SELECT zip, quantile_disc(lat, 0.5) AS median_latitude, quantile_disc(lng, 0.5) AS median_longitude
              FROM geo_valid GROUP BY zip) m ON p.zip = m.zip
        WHERE p.rn = 1""",
    "customers_typed": f"""
        SELECT trim(customer_id) AS customer_id, trim(customer_unique_id) AS customer_unique_id,
               TRY_CAST(customer_zip_code_prefix AS INTEGER) AS customer_zip_code_prefix,
               {clean('customer_city')} AS customer_city, upper(trim(customer_state)) AS customer_state
        FROM raw_customers""",
    "silver_customers": f"""
        SELECT c.*, {region('customer_state')} AS customer_region, median_latitude, median_longitude
        FROM customers_typed c LEFT JOIN silver_geo g ON c.customer_zip_code_prefix = g.zip_code_prefix""",
    "orders_typed": """
        SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id, lower(trim(order_status)) AS order_status,
               order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date
        FROM raw_orders""",
    "orders_measured": f"""
        SELECT *, {days('order_approved_at', 'order_delivered_carrier_date')} AS handling_days,
               {days('order_delivered_carrier_date', 'order_delivered_customer_date')} AS shipping_days,
               {days('order_purchase_timestamp', 'order_delivered_customer_date')} AS total_lead_time,
               {days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS days_diff_estimated,
               {days('order_purchase_timestamp', 'order_estimated_delivery_date')} AS estimated_buffer
        FROM orders_typed""",
    "silver_orders": f"""
        SELECT *, {lifecycle('days_diff_estimated', 'Late')} AS delivery_status_category,
               CASE WHEN days_diff_estimated <= -7 THEN 'Very Early' WHEN days_diff_estimated < 0 THEN 'Early'
                    WHEN days_diff_estimated = 0 THEN 'On Time' WHEN days_diff_estimated <= 3 THEN 'Slight Delay'
                    WHEN days_diff_estimated <= 7 THEN 'Late' WHEN days_diff_estimated > 7 THEN 'Critical Delay'
                    ELSE upper(order_status[1]) || order_status[2:] END AS delivery_status_detail,
               abs(days_diff_estimated) AS abs_days_diff,
               CASE WHEN days_diff_estimated <= 0 THEN 1 ELSE 0 END AS on_time_flag
        FROM orders_measured""",
    "translation": """
        SELECT lower(trim(product_category_name)) AS product_category_name,
               lower(trim(product_category_name_english)) AS english FROM raw_translation""",
    "products_typed": """
        SELECT trim(product_id) AS product_id, lower(trim(product_category_name)) AS product_category_name,
               product_name_lenght, product_description_lenght, product_photos_qty,
               CAST(product_weight_g AS DECIMAL(18,2)) AS product_weight_g,
               CAST(product_length_cm AS DECIMAL(18,2)) AS product_length_cm,
               CAST(product_height_cm AS DECIMAL(18,2)) AS product_height_cm,
               CAST(product_width_cm AS DECIMAL(18,2)) AS product_width_cm
        FROM raw_products""",
    "category_medians": """
        SELECT product_category_name AS cat, quantile_disc(product_weight_g, 0.5) AS w,
               quantile_disc(product_length_cm, 0.5) AS l, quantile_disc(product_height_cm, 0.5) AS h,
               quantile_disc(product_width_cm, 0.5) AS d
        FROM products_typed GROUP BY product_category_name""",
    "products_filled": """
        SELECT product_id, coalesce(product_category_name, 'unknown_category') AS product_category_name,
               coalesce(product_name_lenght, 0) AS product_name_lenght,
               coalesce(product_description_lenght, 0) AS product_description_lenght,
               coalesce(product_photos_qty, 0) AS product_photos_qty,
               coalesce(product_weight_g, w) AS product_weight_g, coalesce(product_length_cm, l) AS product_length_cm,
               coalesce(product_height_cm, h) AS product_height_cm, coalesce(product_width_cm, d) AS product_width_cm
        FROM products_typed LEFT JOIN category_medians ON product_category_name IS NOT DISTINCT FROM cat""",
    "silver_products": """
        SELECT p.*, CASE WHEN p.product_category_name = 'pc_gamer' THEN 'pc_gamer'
                         WHEN p.product_category_name = 'portateis_cozinha_e_preparadores_de_alimentos'
                             THEN 'kitchen_portables_and_food_preparers'
                         ELSE coalesce(t.english, 'unknown') END AS product_category_name_english,
               CAST(product_length_cm * product_height_cm * product_width_cm AS DECIMAL(18,2)) AS product_volume_cm3,
               CASE WHEN product_length_cm * product_height_cm * product_width_cm IS NULL THEN 'Unknown'
                    WHEN product_length_cm * product_height_cm * product_width_cm <= 5000 THEN 'Small'
                    WHEN product_length_cm * product_height_cm * product_width_cm <= 20000 THEN 'Medium'
                    ELSE 'Large' END AS product_size_category,
               coalesce(product_weight_g >= 10000, false) AS heavy_product_flag,
               product_weight_g IS NOT NULL AND product_length_cm IS NOT NULL AND product_height_cm IS NOT NULL
                   AND product_width_cm IS NOT NULL AS logistics_completeness_flag,
               true AS catalog_completeness_flag
        FROM products_filled p LEFT JOIN translation t ON p.product_category_name = t.product_category_name""",
    "items_typed": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
                ORDER BY product_id NULLS FIRST, seller_id NULLS FIRST, shipping_limit_date NULLS FIRST,
                         price NULLS FIRST, freight_value NULLS FIRST) AS rn FROM raw_items) WHERE rn = 1""",
    "items_dated": """
        SELECT i.*, o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date, o.order_status
        FROM items_typed i JOIN silver_orders o ON i.order_id = o.order_id""",
    "limit_median": f"""
        SELECT coalesce(quantile_disc({days('order_approved_at', 'shipping_limit_date')}, 0.5), 4) AS m FROM items_dated
        WHERE shipping_limit_date IS NOT NULL AND shipping_limit_date >= order_approved_at""",
    "items_rebuilt": f"""
        SELECT * REPLACE (CASE WHEN {_BAD_LIMIT}
                THEN CAST(CAST(coalesce(order_approved_at, order_purchase_timestamp) AS DATE)
                     + CAST((SELECT m FROM limit_median) AS INTEGER) AS TIMESTAMP)
                ELSE shipping_limit_date END AS shipping_limit_date)
        FROM items_dated""",
    "silver_items": f"""
        SELECT *, abs(seller_handling_days) AS abs_seller_handling,
               {lifecycle('seller_handling_days', 'Late Delivery to Carrier')} AS seller_performance
        FROM (SELECT *, {days('shipping_limit_date', 'order_delivered_carrier_date')} AS seller_handling_days
              FROM items_rebuilt)""",
    "payments_typed": """
        SELECT DISTINCT trim(order_id) AS order_id, payment_sequential, lower(trim(payment_type)) AS payment_type,
               payment_installments, CAST(payment_value AS DECIMAL(18,2)) AS payment_value FROM raw_payments""",
    "silver_payments": """
        SELECT order_id, payment_sequential, payment_type,
               CASE WHEN payment_type IN ('credit_card', 'debit_card') THEN 'Card' WHEN payment_type = 'boleto'
                    THEN 'Boleto' WHEN payment_type = 'voucher' THEN 'Voucher' ELSE 'Other' END AS payment_type_category,
               CASE WHEN payment_type = 'credit_card' AND payment_installments = 0 THEN 1
                    ELSE payment_installments END AS payment_installments,
               payment_value,
               CASE WHEN payment_installments > 1 THEN 1 ELSE 0 END AS is_installment_payment
        FROM payments_typed WHERE order_id IN (SELECT order_id FROM silver_orders)""",
    "reviews_typed": """
        SELECT trim(review_id) AS review_id, trim(order_id) AS order_id, TRY_CAST(review_score AS INTEGER) AS review_score,
               TRY_CAST(review_creation_date AS TIMESTAMP) AS review_creation_date,
               TRY_CAST(review_answer_timestamp AS TIMESTAMP) AS review_answer_timestamp FROM raw_reviews""",
    "reviews_usable": """
        SELECT * FROM reviews_typed WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_score IS NOT NULL""",
    "reviews_latest": """
        SELECT r.* EXCLUDE (rn), o.order_purchase_timestamp FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY review_answer_timestamp DESC NULLS LAST,
                review_id, review_score, review_creation_date NULLS FIRST) AS rn FROM reviews_usable) r
        JOIN silver_orders o ON r.order_id = o.order_id WHERE rn = 1""",
    "response_median": f"""
        SELECT coalesce(quantile_disc({secs('review_creation_date', 'review_answer_timestamp')}, 0.5), 86400) AS m
        FROM reviews_latest WHERE review_creation_date IS NOT NULL AND review_answer_timestamp IS NOT NULL""",
    "reviews_dated": """
        SELECT review_id, order_id, review_score, c AS review_creation_date,
               coalesce(review_answer_timestamp, c + INTERVAL '1' SECOND * CAST((SELECT m FROM response_median) AS BIGINT))
                   AS review_answer_timestamp
        FROM (SELECT *, coalesce(review_creation_date,
                CAST(CAST(order_purchase_timestamp AS DATE) + 7 AS TIMESTAMP)) AS c FROM reviews_latest)""",
    "silver_reviews": f"""
        SELECT *, CASE WHEN review_score >= 4 THEN 'Satisfied' WHEN review_score = 3 THEN 'Neutral'
                       ELSE 'Unsatisfied' END AS review_label,
               CASE WHEN review_score >= 4 THEN 'Positive' WHEN review_score = 3 THEN 'Neutral'
                    ELSE 'Negative' END AS sentiment_category,
               {days('review_creation_date', 'review_answer_timestamp')} AS review_response_delay_days,
               {rnd(secs('review_creation_date', 'review_answer_timestamp') + ' / 3600')} AS review_response_delay_hours,
               {days('review_creation_date', 'review_answer_timestamp')} = 0 AS is_same_day_response,
               review_score <= 2 AS negative_review_flag, review_score = 3 AS neutral_review_flag,
               review_score >= 4 AS positive_review_flag
        FROM reviews_dated""",
    "silver_leads": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY mql_id
                ORDER BY first_contact_date NULLS LAST, landing_page_id, origin) AS rn FROM (
            SELECT trim(mql_id) AS mql_id, CAST(first_contact_date AS TIMESTAMP) AS first_contact_date,
                   lower(trim(landing_page_id)) AS landing_page_id, coalesce(lower(trim(origin)), 'unknown') AS origin
            FROM raw_leads) WHERE mql_id IS NOT NULL) WHERE rn = 1""",
    "silver_deals": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY mql_id, seller_id
                ORDER BY won_date NULLS LAST, sdr_id, sr_id, business_segment, lead_type, lead_behaviour_profile,
                         business_type, declared_monthly_revenue) AS rn FROM (
            SELECT mql_id, seller_id, sdr_id, sr_id, CAST(won_date AS TIMESTAMP) AS won_date,
                   lower(trim(business_segment)) AS business_segment, lower(trim(lead_type)) AS lead_type,
                   lower(trim(lead_behaviour_profile)) AS lead_behaviour_profile,
                   lower(trim(business_type)) AS business_type,
                   CAST(declared_monthly_revenue AS DECIMAL(18,2)) AS declared_monthly_revenue
            FROM raw_deals) WHERE mql_id IS NOT NULL AND seller_id IS NOT NULL) WHERE rn = 1""",
    "acquisition": f"""
        SELECT *, CASE WHEN NOT converted_flag THEN 'Not Converted' WHEN days_to_convert <= 7 THEN 'Fast Conversion'
                       WHEN days_to_convert <= 30 THEN 'Normal Conversion'
                       WHEN days_to_convert IS NOT NULL THEN 'Slow Conversion'
                       ELSE 'Unknown Conversion' END AS seller_acquisition_segment
        FROM (SELECT l.mql_id, d.seller_id, l.first_contact_date, l.landing_page_id, l.origin AS marketing_origin,
                     l.origin AS acquisition_source, d.won_date, d.business_segment, d.lead_type,
                     d.lead_behaviour_profile, d.business_type, d.declared_monthly_revenue,
                     {days('l.first_contact_date', 'd.won_date')} AS days_to_convert,
                     d.seller_id IS NOT NULL AS converted_flag
              FROM silver_leads l LEFT JOIN silver_deals d ON l.mql_id = d.mql_id)""",
    "seller_matrix": f"""
        SELECT *, {pct('early_preparations', 'total_items_sold')} AS early_ratio,
               {pct('on_time_preparations', 'total_items_sold')} AS on_time_ratio,
               {pct('late_preparations', 'total_items_sold')} AS late_ratio
        FROM (SELECT seller_id, count(order_item_id) AS total_items_sold, count(DISTINCT order_id) AS total_unique_orders,
                     sum(CASE WHEN seller_performance = 'Early' THEN 1 ELSE 0 END) AS early_preparations,
                     sum(CASE WHEN seller_performance = 'On Time' THEN 1 ELSE 0 END) AS on_time_preparations,
                     sum(CASE WHEN seller_performance LIKE 'Late%' THEN 1 ELSE 0 END) AS late_preparations,
                     {rnd('avg(seller_handling_days)')} AS avg_handling_days
              FROM silver_items GROUP BY seller_id)""",
    "sellers_typed": f"""
        SELECT trim(seller_id) AS seller_id, TRY_CAST(seller_zip_code_prefix AS INTEGER) AS seller_zip_code_prefix,
               {clean('seller_city')} AS seller_city, upper(trim(seller_state)) AS seller_state FROM raw_sellers""",
    "first_deal": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY won_date NULLS LAST, marketing_origin,
            acquisition_source, business_segment, lead_type, lead_behaviour_profile, seller_acquisition_segment,
            days_to_convert NULLS FIRST) AS rn FROM acquisition WHERE seller_id IS NOT NULL) WHERE rn = 1""",
    "silver_sellers": f"""
        SELECT s.*, {region('seller_state')} AS seller_region, median_latitude, median_longitude,
               coalesce(total_items_sold, 0) AS total_items_sold, coalesce(total_unique_orders, 0) AS total_unique_orders,
               coalesce(early_preparations, 0) AS early_preparations,
               coalesce(on_time_preparations, 0) AS on_time_preparations,
               coalesce(late_preparations, 0) AS late_preparations,
               coalesce(avg_handling_days, 0) AS avg_handling_days, coalesce(early_ratio, 0) AS early_ratio,
               coalesce(on_time_ratio, 0) AS on_time_ratio, coalesce(late_ratio, 0) AS late_ratio,
               coalesce(total_items_sold, 0) > 0 AS has_sales,
               coalesce(marketing_origin, 'Not Tracked') AS marketing_origin,
               coalesce(acquisition_source, 'Not Tracked') AS acquisition_source,
               coalesce(business_segment, 'Not Tracked') AS business_segment,
               coalesce(lead_type, 'Not Tracked') AS lead_type,
               coalesce(lead_behaviour_profile, 'Not Tracked') AS lead_behaviour_profile,
               coalesce(days_to_convert, -1) AS days_to_convert, coalesce(converted_flag, false) AS converted_flag,
               coalesce(seller_acquisition_segment, 'Not Tracked') AS seller_acquisition_segment
        FROM sellers_typed s LEFT JOIN silver_geo g ON s.seller_zip_code_prefix = g.zip_code_prefix
        LEFT JOIN seller_matrix m ON s.seller_id = m.seller_id LEFT JOIN first_deal f ON s.seller_id = f.seller_id""",
    "order_payments": """
        SELECT p.order_id, total_payment_value, total_payment_installments, payment_type, payment_type_category,
               total_payment_installments > 1 AS installment_flag
        FROM (SELECT order_id, sum(payment_value) AS total_payment_value,
                     max(payment_installments) AS total_payment_installments FROM silver_payments GROUP BY order_id) p
        JOIN (SELECT order_id, payment_type, payment_type_category, row_number() OVER (PARTITION BY order_id
                ORDER BY payment_sequential, payment_type, payment_type_category) AS rn FROM silver_payments) f
          ON p.order_id = f.order_id AND f.rn = 1""",
    "order_totals": """
        SELECT t.*, f.seller_id AS primary_seller_id, seller_count > 1 AS is_multi_seller_order
        FROM (SELECT order_id, sum(price + freight_value) AS total_order_item_value,
                     count(order_item_id) AS total_items_count, count(DISTINCT seller_id) AS seller_count,
                     sum(freight_value) AS freight_total_value FROM silver_items GROUP BY order_id) t
        JOIN (SELECT order_id, seller_id, row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, seller_id) AS rn
              FROM silver_items) f ON t.order_id = f.order_id AND f.rn = 1""",
    "sales_staging": """
        SELECT *, item_sales_ratio * CAST(total_payment_value AS DOUBLE) AS allocated_payment_value,
               item_sales_ratio * CAST(total_payment_value AS DOUBLE) >= 500 AS high_ticket_order_flag
        FROM (SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price,
                     i.freight_value, i.seller_handling_days, i.seller_performance, o.customer_id,
                     o.order_purchase_timestamp, p.total_payment_value, p.total_payment_installments, p.payment_type,
                     p.payment_type_category, p.installment_flag, t.total_order_item_value, q.product_volume_cm3,
                     i.price + i.freight_value AS gross_item_value,
                     CASE WHEN t.total_order_item_value > 0 THEN CAST(i.price + i.freight_value AS DOUBLE)
                          / CAST(t.total_order_item_value AS DOUBLE) ELSE 0.0 END AS item_sales_ratio,
                     CASE WHEN i.price + i.freight_value > 0 THEN CAST(i.freight_value AS DOUBLE)
                          / CAST(i.price + i.freight_value AS DOUBLE) ELSE 0.0 END AS freight_ratio,
                     count(*) OVER (PARTITION BY i.order_id, i.seller_id) AS seller_item_count_in_order
              FROM silver_items i LEFT JOIN silver_orders o ON i.order_id = o.order_id
              LEFT JOIN order_payments p ON i.order_id = p.order_id LEFT JOIN order_totals t ON i.order_id = t.order_id
              LEFT JOIN silver_products q ON i.product_id = q.product_id)""",
    "delivery_staging": """
        SELECT o.*, t.* EXCLUDE (order_id), c.customer_region, c.median_latitude AS customer_lat,
               c.median_longitude AS customer_lng, s.seller_region, s.seller_state, s.median_latitude AS seller_lat,
               s.median_longitude AS seller_lng,
               CASE WHEN s.seller_region IS NULL OR c.customer_region IS NULL THEN 'Unknown'
                    WHEN s.seller_region = c.customer_region THEN 'Same Region' ELSE 'Cross Region' END AS distance_bucket
        FROM silver_orders o LEFT JOIN order_totals t ON o.order_id = t.order_id
        LEFT JOIN silver_customers c ON o.customer_id = c.customer_id
        LEFT JOIN silver_sellers s ON t.primary_seller_id = s.seller_id""",
    "reviews_staging": """
        SELECT r.*, d.primary_seller_id, d.order_status, d.total_lead_time AS delivery_duration_days,
               d.days_diff_estimated AS delay_days, d.delivery_status_category, d.distance_bucket,
               d.is_multi_seller_order, d.days_diff_estimated > 0 AND r.review_score <= 3 AS delayed_delivery_review_flag,
               CASE WHEN d.days_diff_estimated <= 0 AND r.review_score >= 4 THEN 'Good Experience'
                    WHEN d.days_diff_estimated > 0 AND r.review_score <= 3 THEN 'Delivery Impacted Review'
                    ELSE 'Mixed Experience' END AS delivery_experience_segment
        FROM silver_reviews r LEFT JOIN delivery_staging d ON r.order_id = d.order_id""",
    "fulfillment_base": """
        SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
               o.order_purchase_timestamp, p.product_volume_cm3, s.acquisition_source,
               year(o.order_purchase_timestamp) AS y, month(o.order_purchase_timestamp) AS m
        FROM silver_items i LEFT JOIN silver_orders o ON i.order_id = o.order_id
        LEFT JOIN silver_products p ON i.product_id = p.product_id
        LEFT JOIN silver_sellers s ON i.seller_id = s.seller_id""",
    "fulfillment_staging": """
        SELECT *, CASE WHEN seller_monthly_orders >= 100 THEN 'Overloaded' WHEN seller_monthly_orders >= 50
                       THEN 'High Volume' WHEN seller_monthly_orders >= 10 THEN 'Normal Volume'
                       ELSE 'Low Volume' END AS workload_bucket,
               coalesce(seller_monthly_orders >= 100, false) AS is_overloaded_seller
        FROM (SELECT b.*, w.seller_monthly_orders,
                     CASE WHEN price + freight_value > 0 THEN CAST(freight_value AS DOUBLE)
                          / CAST(price + freight_value AS DOUBLE) ELSE 0.0 END AS freight_ratio,
                     count(*) OVER (PARTITION BY order_id, b.seller_id) AS seller_item_count_in_order
              FROM fulfillment_base b LEFT JOIN (
                  SELECT seller_id, y, m, count(DISTINCT order_id) AS seller_monthly_orders
                  FROM fulfillment_base GROUP BY seller_id, y, m) w
              ON b.seller_id = w.seller_id AND b.y = w.y AND b.m = w.m)""",
    "monthly_joined": """
        SELECT d.seller_id, d.y AS performance_year, d.m AS performance_month, monthly_orders, avg_shipping_days,
               on_time_rate, avg_delay_days, delayed_orders_count, coalesce(avg_review_score, 0) AS avg_review_score,
               coalesce(negative_review_rate, 0) AS negative_review_rate,
               coalesce(monthly_review_count, 0) AS monthly_review_count, avg_monthly_workload, avg_freight_ratio,
               avg_product_volume_cm3,
               lag(monthly_orders) OVER (PARTITION BY d.seller_id ORDER BY d.y, d.m) AS previous_month_orders
        FROM (SELECT primary_seller_id AS seller_id, year(order_purchase_timestamp) AS y,
                     month(order_purchase_timestamp) AS m, count(order_id) AS monthly_orders,
                     avg(total_lead_time) AS avg_shipping_days,
                     avg(CASE WHEN days_diff_estimated <= 0 THEN 1 ELSE 0 END) AS on_time_rate,
                     avg(days_diff_estimated) AS avg_delay_days,
                     sum(CASE WHEN days_diff_estimated > 0 THEN 1 ELSE 0 END) AS delayed_orders_count
              FROM delivery_staging WHERE NOT coalesce(is_multi_seller_order, false) GROUP BY ALL) d
        LEFT JOIN (SELECT primary_seller_id AS seller_id, year(review_creation_date) AS y,
                     month(review_creation_date) AS m, avg(review_score) AS avg_review_score,
                     avg(CASE WHEN negative_review_flag THEN 1 ELSE 0 END) AS negative_review_rate,
                     count(review_id) AS monthly_review_count
              FROM reviews_staging WHERE NOT coalesce(is_multi_seller_order, false) GROUP BY ALL) r
          ON d.seller_id = r.seller_id AND d.y = r.y AND d.m = r.m
        LEFT JOIN (SELECT seller_id, y, m, avg(seller_monthly_orders) AS avg_monthly_workload,
                     avg(freight_ratio) AS avg_freight_ratio,
                     avg(CAST(product_volume_cm3 AS DOUBLE)) AS avg_product_volume_cm3
              FROM fulfillment_staging GROUP BY ALL) f
          ON d.seller_id = f.seller_id AND d.y = f.y AND d.m = f.m""",
    "monthly_staging": """
        SELECT *, CASE WHEN is_new_seller_month THEN 'New Seller' WHEN volume_growth_rate >= 0.5 THEN 'High Growth'
                       WHEN volume_growth_rate >= 0.1 THEN 'Moderate Growth' WHEN volume_growth_rate <= -0.1
                       THEN 'Declining' ELSE 'Stable' END AS seller_growth_category,
               CASE WHEN on_time_rate >= 0.9 THEN 'Excellent' WHEN on_time_rate >= 0.75 THEN 'Good'
                    WHEN on_time_rate >= 0.5 THEN 'Fair' ELSE 'Poor' END AS seller_performance_category
        FROM (SELECT *, previous_month_orders IS NULL AS is_new_seller_month,
                     CAST(monthly_orders - previous_month_orders AS DOUBLE) / nullif(previous_month_orders, 0)
                         AS volume_growth_rate FROM monthly_joined)""",
    "costed": """
        SELECT o.*, CAST(coalesce(p, 0) AS DECIMAL(18,2)) AS total_products_price,
               CAST(coalesce(f, 0) AS DECIMAL(18,2)) AS total_freight_value,
               CAST(coalesce(p + f, 0) AS DECIMAL(18,2)) AS total_order_cost,
               coalesce(n, 0) AS total_items_count, coalesce(s, 0) AS seller_count,
               CASE WHEN s > 1 THEN 1 ELSE 0 END AS is_multi_seller_order
        FROM silver_orders o LEFT JOIN (SELECT order_id, sum(price) AS p, sum(freight_value) AS f,
            count(order_item_id) AS n, count(DISTINCT seller_id) AS s FROM silver_items GROUP BY order_id) i
        ON o.order_id = i.order_id""",
    "recon": """
        SELECT coalesce(p.order_id, c.order_id) AS order_id, total_amount_paid, total_order_cost AS total_items_value,
               total_amount_paid - total_order_cost AS variance
        FROM (SELECT order_id, sum(payment_value) AS total_amount_paid FROM silver_payments GROUP BY order_id) p
        FULL JOIN costed c ON p.order_id = c.order_id""",
    "timeline": f"""
        SELECT r.*, o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date,
               o.order_status, {days('o.order_delivered_customer_date', 'r.review_creation_date')} AS days_after_delivery
        FROM silver_reviews r JOIN silver_orders o ON r.order_id = o.order_id""",
    "dim_customer": f"""
        SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, *,
               {location('customer_city', 'customer_state')} AS customer_location_type FROM silver_customers""",
    "dim_seller": f"""
        SELECT row_number() OVER (ORDER BY seller_id) AS seller_sk, *,
               {location('seller_city', 'seller_state')} AS seller_location_type FROM silver_sellers""",
    "dim_product": "SELECT row_number() OVER (ORDER BY product_id) AS product_sk, * FROM silver_products",
    "dim_delivery_status": """
        SELECT row_number() OVER (ORDER BY delivery_status_category, order_status) AS delivery_status_sk, *,
               CASE WHEN delivery_status_category = 'On Time' THEN 'Successful'
                    WHEN delivery_status_category IN ('Slight Delay', 'Late', 'Critical Delay') THEN 'Delayed'
                    ELSE 'Other' END AS delivery_status_group
        FROM (SELECT DISTINCT order_status, delivery_status_category FROM delivery_staging)""",
    "dim_review_sentiment": """
        SELECT row_number() OVER (ORDER BY sentiment_category) AS review_sentiment_sk, sentiment_category,
               CASE sentiment_category WHEN 'Positive' THEN 'Score 4-5' WHEN 'Neutral' THEN 'Score 3'
                    WHEN 'Negative' THEN 'Score 1-2' ELSE 'Unknown' END AS sentiment_score_band
        FROM (SELECT DISTINCT sentiment_category FROM reviews_staging)""",
    "dim_payment_type": """
        SELECT row_number() OVER (ORDER BY payment_type NULLS FIRST, installment_flag NULLS FIRST,
               payment_type_category NULLS FIRST) AS payment_type_sk, *
        FROM (SELECT DISTINCT payment_type, payment_type_category, installment_flag FROM sales_staging)""",
    "fct_order_sales": f"""
        SELECT row_number() OVER (ORDER BY order_id, order_item_id) AS sales_fact_sk, s.order_id, s.order_item_id,
               p.product_sk AS product_sk_fk, e.seller_sk AS seller_sk_fk, c.customer_sk AS customer_sk_fk,
               t.payment_type_sk AS payment_type_sk_fk, {day_key('s.order_purchase_timestamp')} AS sales_date_sk,
               s.price, s.freight_value, s.gross_item_value, s.total_order_item_value, s.allocated_payment_value,
               s.item_sales_ratio, s.freight_ratio, s.product_volume_cm3, s.seller_item_count_in_order,
               s.total_payment_installments, s.installment_flag, s.high_ticket_order_flag,
               s.freight_ratio > 0.30 AS high_freight_item_flag
        FROM sales_staging s LEFT JOIN dim_product p ON s.product_id = p.product_id
        LEFT JOIN dim_seller e ON s.seller_id = e.seller_id LEFT JOIN dim_customer c ON s.customer_id = c.customer_id
        LEFT JOIN dim_payment_type t ON s.payment_type = t.payment_type AND s.installment_flag = t.installment_flag""",
    "fct_order_delivery": f"""
        SELECT row_number() OVER (ORDER BY d.order_id) AS delivery_fact_sk, d.order_id, c.customer_sk AS customer_sk_fk,
               e.seller_sk AS seller_sk_fk, x.delivery_status_sk AS delivery_status_sk_fk,
               {day_key('order_purchase_timestamp')} AS purchase_date_sk,
               {day_key('order_estimated_delivery_date')} AS estimated_delivery_date_sk,
               {day_key('order_delivered_customer_date')} AS actual_delivery_date_sk, d.order_status,
               d.order_purchase_timestamp, d.order_approved_at, d.order_delivered_carrier_date,
               d.order_delivered_customer_date, d.order_estimated_delivery_date,
               d.total_lead_time AS delivery_duration_days, d.days_diff_estimated AS delay_days,
               d.estimated_buffer AS buffer_days, d.freight_total_value, d.total_items_count, d.seller_count,
               d.is_multi_seller_order, d.distance_bucket, d.seller_region, d.customer_region,
               d.days_diff_estimated <= 0 AS on_time_delivery_flag, d.days_diff_estimated > 0 AS late_delivery_flag
        FROM delivery_staging d LEFT JOIN dim_customer c ON d.customer_id = c.customer_id
        LEFT JOIN dim_seller e ON d.primary_seller_id = e.seller_id
        LEFT JOIN dim_delivery_status x ON d.order_status = x.order_status
              AND d.delivery_status_category = x.delivery_status_category""",
    "fct_customer_reviews": f"""
        SELECT row_number() OVER (ORDER BY review_id, order_id) AS review_fact_sk, r.review_id, r.order_id,
               e.seller_sk AS seller_sk_fk, x.review_sentiment_sk AS review_sentiment_sk_fk,
               {day_key('review_creation_date')} AS review_date_sk,
               {day_key('review_answer_timestamp')} AS response_date_sk, r.review_score,
               r.review_response_delay_days AS review_response_days, r.delivery_duration_days, r.delay_days,
               r.negative_review_flag, r.neutral_review_flag, r.positive_review_flag, r.delayed_delivery_review_flag,
               r.review_score <= 2 AS low_rating_flag, r.review_score = 5 AS excellent_rating_flag,
               r.is_multi_seller_order, r.sentiment_category, r.delivery_experience_segment,
               r.delivery_status_category, r.distance_bucket
        FROM reviews_staging r LEFT JOIN dim_seller e ON r.primary_seller_id = e.seller_id
        LEFT JOIN dim_review_sentiment x ON r.sentiment_category = x.sentiment_category""",
    "fct_seller_fulfillment": f"""
        SELECT row_number() OVER (ORDER BY f.order_id, order_item_id) AS fulfillment_fact_sk, f.order_id,
               f.order_item_id, e.seller_sk AS seller_sk_fk, p.product_sk AS product_sk_fk,
               {day_key('order_purchase_timestamp')} AS purchase_date_sk, f.price, f.freight_value, f.freight_ratio,
               f.product_volume_cm3, f.seller_item_count_in_order, f.seller_monthly_orders, f.workload_bucket,
               f.is_overloaded_seller, f.workload_bucket IN ('High Volume', 'Overloaded') AS high_workload_flag,
               f.freight_ratio >= 0.30 AS high_freight_item_flag, f.acquisition_source
        FROM fulfillment_staging f LEFT JOIN dim_seller e ON f.seller_id = e.seller_id
        LEFT JOIN dim_product p ON f.product_id = p.product_id""",
}


def _definition(name: str) -> str | None:
    if name in CTES:
        return CTES[name]
    return role_sql(name) if name in ROLES else None


def sql(select: str) -> str:
    """``select`` with every expression it needs in front, in order of dependency."""
    done: dict[str, str] = {}
    seen: set[str] = set()

    def need(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_]+", text)):
            body = _definition(word)
            if body is not None and word not in seen:
                seen.add(word)
                need(body)
                done[word] = body

    need(select)
    if not done:
        return select
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in done.items())
    return f"WITH {ctes}\n{select}"
