"""Classifier queries (C*): every label with the number of rows it gets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind.catalog.base import query
from tamarind.catalog.oracle import location, sql
from tamarind.functions import classify as rule
from tamarind.functions.numbers import money, volume


@query("delivery_status", "C01 C02 C03 C04 C05", sql("""
    SELECT order_status, delivery_status_category, delivery_status_detail,
           CASE WHEN order_status = 'delivered' AND days_diff_estimated IS NULL THEN NULL
                WHEN delivery_status_category = 'Unknown' THEN 'Other' ELSE delivery_status_category END AS refined,
           CAST(on_time_flag AS BIGINT) AS on_time_flag,
           CAST(CASE WHEN order_status = 'delivered' THEN abs_days_diff END AS BIGINT) AS delivered_gap,
           count(*) AS orders
    FROM silver_orders GROUP BY ALL"""))
def _(r):
    labelled = r.use("orders").select(
        "order_status", "delivery_status_category", "delivery_status_detail",
        rule.delivery_detail_refined().alias("refined"), "on_time_flag",
        rule.abs_gap("days_diff_estimated", "order_status").alias("delivered_gap"),
    )
    return labelled.groupBy(*labelled.columns).agg(F.count("*").alias("orders"))


@query("seller_performance_refined", "C06", sql("""
    SELECT order_status, CASE WHEN order_status = 'canceled' THEN 'Canceled' WHEN order_status = 'unavailable'
        THEN 'Unavailable' WHEN order_status IN ('shipped', 'processing', 'approved', 'created') THEN 'In Progress'
        WHEN order_status = 'delivered' THEN CASE WHEN gap < 0 THEN 'Early' WHEN gap = 0 THEN 'On Time'
            WHEN gap > 0 THEN 'Late Delivery to Carrier' ELSE 'Unfulfilled' END
        ELSE 'Unknown' END AS performance, count(*) AS orders
    FROM (SELECT order_status, handling_days AS gap FROM silver_orders) GROUP BY ALL"""))
def _(r):
    gaps = r.use("orders").select(
        "order_status", rule.seller_performance_refined(gap="handling_days").alias("performance")
    )
    return gaps.groupBy("order_status", "performance").agg(F.count("*").alias("orders"))


@query("size_weight", "C07 C08 C09 C10 C11", sql("""
    SELECT CASE WHEN v IS NULL THEN 'Unknown' WHEN v <= 5000 THEN 'Small' WHEN v <= 20000 THEN 'Medium' ELSE 'Large' END
               AS size, CASE WHEN v <= 0 THEN 'Unknown Size' WHEN v <= 5000 THEN 'Small Box' WHEN v <= 20000
               THEN 'Medium Box' ELSE 'Large Parcel' END AS parcel,
           CASE WHEN w <= 0 THEN 'Unknown Weight' WHEN w <= 2000 THEN 'Lightweight' WHEN w <= 10000 THEN 'Midweight'
               ELSE 'Heavyweight' END AS weight, coalesce(w >= 10000, false) AS heavy,
           w IS NOT NULL AND v IS NOT NULL AS complete, count(*) AS products
    FROM (SELECT product_weight_g AS w, product_length_cm * product_height_cm * product_width_cm AS v FROM products_typed)
    GROUP BY ALL"""))
def _(r):
    sizes = ("product_length_cm", "product_height_cm", "product_width_cm", "product_weight_g")
    typed = r.role("raw_products").withColumns({c: money(c) for c in sizes})
    labelled = typed.withColumn("v", volume(*sizes[:3])).select(
        rule.product_size("v").alias("size"), rule.parcel_size("v").alias("parcel"),
        rule.parcel_weight("product_weight_g").alias("weight"), rule.is_heavy("product_weight_g").alias("heavy"),
        rule.is_complete("product_weight_g", "v").alias("complete"),
    )
    return labelled.groupBy(*labelled.columns).agg(F.count("*").alias("products"))


@query("payment_flags", "C12 C13 C14", sql("""
    SELECT payment_type, payment_type_category, CAST(payment_installments AS BIGINT) AS payment_installments,
           payment_installments > 1 AS split, count(*) AS payments FROM silver_payments GROUP BY ALL"""))
def _(r):
    flagged = r.use("payments").withColumn("split", rule.in_installments("payment_installments"))
    return flagged.groupBy("payment_type", "payment_type_category", "payment_installments", "split").agg(
        F.count("*").alias("payments")
    )


@query("review_sentiment", "C15 C16 C17 C18", sql("""
    SELECT CAST(review_score AS BIGINT) AS review_score, review_label, sentiment_category, is_same_day_response,
           CASE sentiment_category WHEN 'Positive' THEN 'Score 4-5' WHEN 'Neutral' THEN 'Score 3' ELSE 'Score 1-2' END
               AS score_band, count(*) AS reviews FROM silver_reviews GROUP BY ALL"""))
def _(r):
    banded = r.use("reviews").withColumn("score_band", rule.sentiment_band("sentiment_category"))
    return banded.groupBy(
        "review_score", "review_label", "sentiment_category", "is_same_day_response", "score_band"
    ).agg(F.count("*").alias("reviews"))


@query("distance_bucket", "C21 C22", sql("""
    SELECT distance_bucket, is_multi_seller_order, count(*) AS orders FROM delivery_staging GROUP BY ALL"""))
def _(r):
    return r.delivery.groupBy("distance_bucket", "is_multi_seller_order").agg(F.count("*").alias("orders"))


@query("review_experience", "C23 C24", sql("""
    SELECT delivery_experience_segment, delayed_delivery_review_flag, count(*) AS reviews FROM reviews_staging
    GROUP BY ALL"""))
def _(r):
    return r.judged.groupBy("delivery_experience_segment", "delayed_delivery_review_flag").agg(F.count("*").alias("reviews"))


@query("grades", "C25 C27 C33", sql("""
    SELECT o_custkey, n AS orders, CASE WHEN n >= 100 THEN 'Overloaded' WHEN n >= 50 THEN 'High Volume'
               WHEN n >= 10 THEN 'Normal Volume' ELSE 'Low Volume' END AS bucket, n >= 50 AS high,
           CASE WHEN p >= 0.9 THEN 'Excellent' WHEN p >= 0.75 THEN 'Good' WHEN p >= 0.5 THEN 'Fair' ELSE 'Poor' END AS grade
    FROM (SELECT o_custkey, count(*) AS n, avg(CASE WHEN o_orderstatus <> 'P' THEN 1.0 ELSE 0.0 END) AS p
          FROM orders GROUP BY 1)"""))
def _(r):
    per_customer = r.table("orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.avg((F.col("o_orderstatus") != "P").cast("int")).alias("p")
    )
    bucketed = per_customer.withColumns({"bucket": rule.workload_bucket("orders"), "grade": rule.on_time_grade("p")})
    return bucketed.withColumn("high", rule.is_high_workload("bucket")).drop("p")


@query("location_type", "C29", sql(f"""
    SELECT {location('customer_city', 'customer_state')} AS location_type, count(*) AS customers
    FROM customers_typed GROUP BY 1"""))
def _(r):
    kind = rule.location_type("customer_city", "customer_state").alias("location_type")
    return r.use("customers").groupBy(kind).agg(F.count("*").alias("customers"))


@query("delivery_group", "C30", sql("""
    SELECT delivery_status_detail, CASE WHEN delivery_status_detail = 'On Time' THEN 'Successful'
        WHEN delivery_status_detail IN ('Slight Delay', 'Late', 'Critical Delay') THEN 'Delayed' ELSE 'Other' END
        AS delivery_group, count(*) AS orders FROM silver_orders GROUP BY ALL"""))
def _(r):
    grouped = r.use("orders").withColumn("delivery_group", rule.delivery_group("delivery_status_detail"))
    return grouped.groupBy("delivery_status_detail", "delivery_group").agg(F.count("*").alias("orders"))


@query("flag_limits", "C31 C32", sql("""
    SELECT CAST(l_tax AS DOUBLE) AS tax, l_tax > 0.05 AS above, l_tax >= 0.05 AS at_or_above,
           count(*) FILTER (l_extendedprice >= 500) AS high_ticket, count(*) AS lines FROM lineitem GROUP BY ALL"""))
def _(r):
    return r.table("lineitem").groupBy(
        F.col("l_tax").alias("tax"), rule.is_high_freight("l_tax", 0.05).alias("above"),
        rule.is_high_freight("l_tax", 0.05, inclusive=True).alias("at_or_above"),
    ).agg(F.count_if(rule.is_high_ticket("l_extendedprice")).alias("high_ticket"), F.count("*").alias("lines"))


@query("price_freight_buckets", "C34 C35", sql("""
    SELECT CASE WHEN price < 50 THEN 'Under R$50' WHEN price < 100 THEN 'R$50-100' WHEN price < 200 THEN 'R$100-200'
                WHEN price < 400 THEN 'R$200-400' ELSE 'Above R$400' END AS price_bucket,
           CASE WHEN freight_value < 15 THEN 'Under R$15' WHEN freight_value < 30 THEN 'R$15-30'
                WHEN freight_value < 50 THEN 'R$30-50' ELSE 'Above R$50' END AS freight_bucket, count(*) AS items
    FROM flat_events GROUP BY ALL"""))
def _(r):
    return r.role("flat_events").groupBy(
        rule.price_bucket("price").alias("price_bucket"), rule.freight_bucket("freight_value").alias("freight_bucket")
    ).agg(F.count("*").alias("items"))
