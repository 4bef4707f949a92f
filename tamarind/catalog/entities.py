"""Silver entities, their rejects, and staging tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind.catalog.base import cols, query
from tamarind.catalog.oracle import sql
from tamarind.plans import staging

_GEO = "zip_code_prefix:i, city, state, region, median_latitude:d, median_longitude:d"
_CUSTOMER = """customer_id, customer_unique_id, customer_zip_code_prefix:i, customer_city, customer_state,
    customer_region, median_latitude:d, median_longitude:d"""
_MILESTONES = """order_purchase_timestamp:t, order_approved_at:t, order_delivered_carrier_date:t,
    order_delivered_customer_date:t, order_estimated_delivery_date:t"""
_ORDER = f"""order_id, customer_id, order_status, {_MILESTONES}, handling_days:i, shipping_days:i,
    total_lead_time:i, days_diff_estimated:i, estimated_buffer:i, delivery_status_category, delivery_status_detail,
    abs_days_diff:i, on_time_flag:i"""
_PRODUCT = """product_id, product_category_name, product_category_name_english, product_name_lenght:i,
    product_description_lenght:i, product_photos_qty:i, product_weight_g:d, product_length_cm:d, product_height_cm:d,
    product_width_cm:d, product_volume_cm3:d, product_size_category, heavy_product_flag, logistics_completeness_flag,
    catalog_completeness_flag"""
_ITEM = """order_id, order_item_id:i, product_id, seller_id, shipping_limit_date:t, price:d, freight_value:d,
    seller_handling_days:i, abs_seller_handling:i, seller_performance"""
_PAYMENT = """order_id, payment_sequential:i, payment_type, payment_type_category, payment_installments:i,
    payment_value:d, is_installment_payment:i"""
_REVIEW = """review_id, order_id, review_score:i, review_creation_date:t, review_answer_timestamp:t, review_label,
    sentiment_category, review_response_delay_days:i, review_response_delay_hours:d, is_same_day_response,
    negative_review_flag, neutral_review_flag, positive_review_flag"""
_SELLER = """seller_id, seller_zip_code_prefix:i, seller_city, seller_state, seller_region, median_latitude:d,
    median_longitude:d, total_items_sold:i, total_unique_orders:i, early_preparations:i, on_time_preparations:i,
    late_preparations:i, avg_handling_days:d, early_ratio:d, on_time_ratio:d, late_ratio:d, has_sales,
    marketing_origin, acquisition_source, business_segment, lead_type, lead_behaviour_profile, days_to_convert:i,
    converted_flag, seller_acquisition_segment"""


@query("silver_geolocation", "E01 A06 A15 W03", sql(f"SELECT {cols(_GEO)} FROM silver_geo"))
def _(r):
    return r.geolocation.rows


@query("bbox_violations", "P05 Q05 Q20 F03 F04", sql("""
    SELECT CAST(zip AS BIGINT) AS geolocation_zip_code_prefix, round(lat, 6) AS geolocation_lat,
           round(lng, 6) AS geolocation_lng, city AS geolocation_city, state AS geolocation_state,
           'Invalid or missing geolocation coordinates' AS error_reason
    FROM geo_points WHERE lat IS NULL OR lng IS NULL OR lat < -34 OR lat > 6 OR lng < -75 OR lng > -28"""))
def _(r):
    return r.geolocation.rejects


@query("silver_customers", "E02 J03 F05", sql(f"SELECT {cols(_CUSTOMER)} FROM silver_customers"))
def _(r):
    return r.customers.rows


@query("customers_unmapped_zip", "E02 J05 Q02", sql("""
    SELECT customer_id, customer_unique_id, CAST(customer_zip_code_prefix AS BIGINT) AS customer_zip_code_prefix,
           customer_city, customer_state, 'Customer zip code missing or not found in geolocation' AS error_reason
    FROM customers_typed LEFT JOIN silver_geo ON customer_zip_code_prefix = zip_code_prefix
    WHERE zip_code_prefix IS NULL"""))
def _(r):
    return r.customers.rejects


@query("silver_orders", "E03 C01 C02 C04 C05 F09", sql(f"SELECT {cols(_ORDER)} FROM silver_orders"))
def _(r):
    return r.orders.rows


@query("silver_products", "E04 C07 C10 C11 F22 F23 J12 Q23 Q24", sql(f"SELECT {cols(_PRODUCT)} FROM silver_products"))
def _(r):
    return r.products.rows


@query("any_null_rows", "P06 Q02", sql("""
    SELECT product_id, product_category_name, CAST(product_name_lenght AS BIGINT) AS product_name_lenght,
           CAST(product_description_lenght AS BIGINT) AS product_description_lenght,
           CAST(product_photos_qty AS BIGINT) AS product_photos_qty,
           CAST(product_weight_g AS DOUBLE) AS product_weight_g, CAST(product_length_cm AS DOUBLE) AS product_length_cm,
           CAST(product_height_cm AS DOUBLE) AS product_height_cm, CAST(product_width_cm AS DOUBLE) AS product_width_cm,
           'Product missing key logistics fields' AS error_reason
    FROM products_typed WHERE product_weight_g IS NULL OR product_length_cm IS NULL OR product_height_cm IS NULL
        OR product_width_cm IS NULL"""))
def _(r):
    return r.products.rejects


@query("silver_order_items", "E05 C06 U05 F10 F11", sql(f"SELECT {cols(_ITEM)} FROM silver_items"))
def _(r):
    return r.items.rows


@query("items_bad_limit", "E05 Q02 Q25", sql("""
    SELECT error_reason, count(*) AS row_count FROM (
        SELECT 'Invalid shipping_limit_date, rebuilt using median approval-to-limit days' AS error_reason
        FROM items_dated WHERE shipping_limit_date IS NULL OR shipping_limit_date < order_purchase_timestamp
            OR shipping_limit_date < order_approved_at
        UNION ALL SELECT 'Order item order_id missing from silver_orders' FROM items_typed
        WHERE order_id NOT IN (SELECT order_id FROM silver_orders)) GROUP BY error_reason"""))
def _(r):
    return r.items.rejects.groupBy("error_reason").agg(F.count("*").alias("row_count"))


@query("silver_payments", "E06 C12 C13 C14 U04", sql(f"SELECT {cols(_PAYMENT)} FROM silver_payments"))
def _(r):
    return r.payments.rows


@query("silver_reviews", "E07 W01 Q29 C15 C16 C18 F12 F13", sql(f"SELECT {cols(_REVIEW)} FROM silver_reviews"))
def _(r):
    return r.reviews.rows


@query("reviews_rejected", "E07 Q02 Q06", sql("""
    SELECT 'Review critical key or score missing' AS error_reason, count(*) AS row_count FROM reviews_typed
    WHERE review_id IS NULL OR order_id IS NULL OR review_score IS NULL
    UNION ALL SELECT 'Review order_id missing from silver_orders', count(*) FROM reviews_usable
    WHERE order_id NOT IN (SELECT order_id FROM silver_orders)"""))
def _(r):
    return r.review_rejects.groupBy("error_reason").agg(F.count("*").alias("row_count"))


@query("silver_leads", "E08 F02", sql(
    f"SELECT {cols('mql_id, first_contact_date:t, landing_page_id, origin')} FROM silver_leads"))
def _(r):
    return r.leads.rows


@query("silver_closed_deals", "E09 F08", sql(f"""SELECT {cols('''mql_id, seller_id, sdr_id, sr_id, won_date:t,
    business_segment, lead_type, lead_behaviour_profile, business_type, declared_monthly_revenue:d''')}
    FROM silver_deals"""))
def _(r):
    return r.deals.rows


@query("silver_sellers", "E10 G02 W02 F23", sql(f"SELECT {cols(_SELLER)} FROM silver_sellers"))
def _(r):
    return r.sellers.rows


@query("acquisition_segment", "G01 C19 C20", sql(f"""SELECT {cols('''mql_id, seller_id, first_contact_date:t,
    landing_page_id, marketing_origin, acquisition_source, won_date:t, business_segment, lead_type,
    lead_behaviour_profile, business_type, declared_monthly_revenue:d, days_to_convert:i, converted_flag,
    seller_acquisition_segment''')} FROM acquisition"""))
def _(r):
    return r.acquisition


@query("seller_performance", "G02 A03 A04 A14 F21", sql(f"""SELECT {cols('''seller_id, total_items_sold:i,
    total_unique_orders:i, early_preparations:i, on_time_preparations:i, late_preparations:i, avg_handling_days:d,
    early_ratio:d, on_time_ratio:d, late_ratio:d''')} FROM seller_matrix"""))
def _(r):
    return r.matrix


@query("min_by_first", "G03 A02 A09", sql(f"""SELECT {cols('''order_id, total_payment_value:d,
    total_payment_installments:i, payment_type, payment_type_category, installment_flag''')} FROM order_payments"""))
def _(r):
    return r.order_payments


@query("order_totals", "G04 A02 A03 C21 F19", sql(f"""SELECT {cols('''order_id, total_order_item_value:d,
    total_items_count:i, seller_count:i, primary_seller_id, freight_total_value:d, is_multi_seller_order''')}
    FROM order_totals"""))
def _(r):
    return r.totals


_SALES = """order_id, order_item_id:i, product_id, seller_id, customer_id, price:d, freight_value:d,
    order_purchase_timestamp:t, total_payment_value:d, payment_type, payment_type_category, installment_flag,
    total_order_item_value:d, product_volume_cm3:d, gross_item_value:d, item_sales_ratio:d, freight_ratio:d,
    allocated_payment_value:d, high_ticket_order_flag, seller_item_count_in_order:i, total_payment_installments:i"""


def _names(spec: str) -> list[str]:
    return [p.strip().partition(":")[0] for p in spec.split(",")]


@query("payment_allocation", "G05 J02 C31 F20 W07", sql(f"SELECT {cols(_SALES)} FROM sales_staging"))
def _(r):
    return r.sales.select(*_names(_SALES))


@query("delivery_staging", "G06 C22", sql(f"""SELECT {cols(_ORDER)}, {cols('''total_order_item_value:d,
    total_items_count:i, seller_count:i, primary_seller_id, freight_total_value:d, is_multi_seller_order,
    customer_region, customer_lat:d, customer_lng:d, seller_region, seller_state, seller_lat:d, seller_lng:d,
    distance_bucket''')} FROM delivery_staging"""))
def _(r):
    return r.delivery


@query("reviews_staging", "G07 C23 C24", sql(f"""SELECT {cols(_REVIEW)}, {cols('''primary_seller_id, order_status,
    delivery_duration_days:i, delay_days:i, delivery_status_category, distance_bucket, is_multi_seller_order,
    delayed_delivery_review_flag, delivery_experience_segment''')} FROM reviews_staging"""))
def _(r):
    return r.judged


_FULFILLED = """order_id, order_item_id:i, product_id, seller_id, price:d, freight_value:d,
    order_purchase_timestamp:t, product_volume_cm3:d, acquisition_source, seller_monthly_orders:i, freight_ratio:d,
    seller_item_count_in_order:i, workload_bucket, is_overloaded_seller"""


@query("workload", "G08 C25 J08", sql(f"SELECT {cols(_FULFILLED)} FROM fulfillment_staging"))
def _(r):
    return r.fulfilled.select(*_names(_FULFILLED))


@query("seller_monthly", "G09 W04 C26 C27 C28 A05", sql(f"""SELECT {cols('''seller_id, performance_year:i,
    performance_month:i, monthly_orders:i, avg_shipping_days:d, on_time_rate:d, avg_delay_days:d,
    delayed_orders_count:i, avg_review_score:d, negative_review_rate:d, monthly_review_count:i, avg_monthly_workload:d,
    avg_freight_ratio:d, avg_product_volume_cm3:d, previous_month_orders:i, is_new_seller_month, volume_growth_rate:d,
    seller_growth_category, seller_performance_category''')} FROM monthly_staging"""))
def _(r):
    return r.monthly


@query("orders_left_totals", "G10 J02 P13", sql(f"""SELECT {cols('''order_id, total_products_price:d,
    total_freight_value:d, total_order_cost:d, total_items_count:i, seller_count:i, is_multi_seller_order:i''')}
    FROM costed"""))
def _(r):
    return r.costed.select(
        "order_id", "total_products_price", "total_freight_value", "total_order_cost", "total_items_count",
        "seller_count", "is_multi_seller_order",
    )


@query("payment_status", "G11 C38 W08", sql("""
    SELECT order_id, CAST(total_order_cost AS DOUBLE) AS total_order_cost,
           CAST(total_amount_paid AS DOUBLE) AS total_amount_paid,
           CAST(total_amount_paid - total_order_cost AS DOUBLE) AS financial_variance,
           CASE WHEN total_amount_paid IS NULL THEN 'no payment record'
                WHEN total_amount_paid > total_order_cost THEN 'overpaid'
                WHEN total_amount_paid < total_order_cost THEN 'underpaid' ELSE 'matched' END AS payment_status
    FROM (SELECT c.order_id, c.total_order_cost, p.total_amount_paid FROM costed c LEFT JOIN (
        SELECT order_id, sum(payment_value) AS total_amount_paid FROM silver_payments GROUP BY order_id) p
        ON c.order_id = p.order_id)"""))
def _(r):
    paid = staging.orders_with_payments(r.costed, r.payments.rows)
    return paid.select("order_id", "total_order_cost", "total_amount_paid", "financial_variance", "payment_status")
