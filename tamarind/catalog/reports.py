"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind.catalog.base import query
from tamarind.catalog.oracle import days, pct, rnd, sql
from tamarind.catalog.roles import role_sql
from tamarind.plans import reports
from tamarind.session import stored


@query("late_magnitude", "X01", sql(f"""
    SELECT {rnd('avg(abs_days_diff)', 0)} AS average_delay_days,
           CAST(quantile_disc(abs_days_diff, 0.5) AS BIGINT) AS median_delay_days
    FROM silver_orders WHERE delivery_status_category = 'Late'"""))
def _(r):
    return reports.late_magnitude(r.use("orders"))


@query("status_matrix", "X02", sql("""
    SELECT order_status, delivery_status_detail, count(*) AS row_count FROM silver_orders GROUP BY 1, 2"""))
def _(r):
    return reports.status_matrix(r.use("orders"), "order_status", "delivery_status_detail")


@query("performance_distribution", "X03", sql(f"""
    SELECT seller_performance, count(*) AS row_count,
           {pct('count(*)', '(SELECT count(*) FROM silver_items)')} AS percentage FROM silver_items GROUP BY 1"""))
def _(r):
    return reports.performance_distribution(r.use("items"))


@query("items_by_status", "X04", sql("""
    SELECT o.order_status, count(order_item_id) AS total_items, count(DISTINCT i.order_id) AS unique_orders
    FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id GROUP BY 1"""))
def _(r):
    return reports.items_by_status(r.use("items"), r.use("orders"))


_REPEATED = """(SELECT *, lag(review_answer_timestamp) OVER w AS prev_timestamp, lag(review_score) OVER w AS prev_score
    FROM reviews_usable WINDOW w AS (PARTITION BY order_id ORDER BY review_answer_timestamp NULLS FIRST, review_id,
        review_score))"""


def _usable(r):
    from tamarind.functions.temporal import wall_clock

    raw = r.role("raw_reviews").where("review_id IS NOT NULL AND order_id IS NOT NULL")
    return raw.select(
        "review_id", "order_id", F.col("review_score").try_cast("int").alias("review_score"),
        wall_clock("review_answer_timestamp").alias("review_answer_timestamp"),
    ).where("review_score IS NOT NULL")


@query("review_gaps", "X05 W05", sql(f"""
    SELECT order_id, review_id, CAST(review_answer_timestamp AS VARCHAR) AS review_answer_timestamp,
           {rnd('(epoch(review_answer_timestamp) - epoch(prev_timestamp)) / 3600')} AS hours_between_reviews
    FROM {_REPEATED} WHERE prev_timestamp IS NOT NULL AND review_answer_timestamp IS NOT NULL"""))
def _(r):
    return reports.repeated_reviews(_usable(r)).select(
        "order_id", "review_id", "review_answer_timestamp", "hours_between_reviews"
    )


@query("score_changes", "X06 W06", sql(f"""
    SELECT coalesce(review_score <> prev_score, false) AS is_score_changed, count(*) AS row_count
    FROM {_REPEATED} WHERE prev_timestamp IS NOT NULL AND review_answer_timestamp IS NOT NULL GROUP BY 1"""))
def _(r):
    return reports.score_changes(_usable(r))


@query("days_to_review", "X07", sql("""
    SELECT CAST(days_after_delivery AS BIGINT) AS days_after_delivery, count(*) AS reviews FROM timeline GROUP BY 1"""))
def _(r):
    return r.timeline.groupBy("days_after_delivery").agg(F.count("*").alias("reviews"))


@query("early_responses", "X08 C40", sql(f"""
    SELECT CASE WHEN review_answer_timestamp >= order_estimated_delivery_date THEN 'Yes (After Estimated)'
                ELSE 'No (Before Estimated - Anomaly)' END AS is_after_estimated, count(*) AS row_count,
           round(avg({days('order_estimated_delivery_date', 'review_answer_timestamp')}), 6) AS avg_days_diff
    FROM timeline WHERE review_answer_timestamp < order_delivered_customer_date GROUP BY 1"""))
def _(r):
    return reports.early_responses(r.timeline)


@query("canceled_scores", "X09", sql("""
    SELECT CAST(review_score AS BIGINT) AS review_score, count(*) AS row_count FROM timeline
    WHERE order_status = 'canceled' GROUP BY 1"""))
def _(r):
    return reports.scores_of_canceled(r.timeline)


@query("late_delivery_anger", "X10", sql(f"""
    SELECT round(avg(review_score), 6) AS average_score, count(*) AS total_count,
           count(*) FILTER (review_score <= 2) AS low_scores_count, count(*) FILTER (review_score >= 4) AS high_scores_count,
           {pct('count(*) FILTER (review_score <= 2)', 'count(*)')} AS low_score_percentage
    FROM timeline WHERE review_answer_timestamp < order_delivered_customer_date
        AND review_answer_timestamp >= order_estimated_delivery_date"""))
def _(r):
    return reports.late_delivery_anger(r.timeline)


@query("late_delivery_stars", "X10", sql(f"""
    WITH kept_waiting AS (SELECT review_score FROM timeline WHERE review_answer_timestamp < order_delivered_customer_date
        AND review_answer_timestamp >= order_estimated_delivery_date)
    SELECT CAST(review_score AS BIGINT) AS review_score, count(*) AS row_count,
           {pct('count(*)', '(SELECT count(*) FROM kept_waiting)')} AS percentage FROM kept_waiting GROUP BY 1""").replace(
    "\n\n    WITH kept_waiting AS", ",\nkept_waiting AS"))
def _(r):
    return reports.late_delivery_stars(r.timeline)


@query("score_distribution", "X11 A12", sql(f"""
    SELECT CAST(review_score AS BIGINT) AS review_score, count(*) AS row_count,
           {pct('count(*)', '(SELECT count(*) FROM silver_reviews)')} AS percentage FROM silver_reviews GROUP BY 1"""))
def _(r):
    return reports.score_distribution(r.use("reviews"))


@query("response_latency", "X12 A20", sql(f"""
    SELECT round(avg(d), 6) AS mean, CAST(min(d) AS BIGINT) AS min, CAST(quantile_disc(d, 0.25) AS BIGINT) AS p25,
           CAST(quantile_disc(d, 0.5) AS BIGINT) AS p50, CAST(quantile_disc(d, 0.75) AS BIGINT) AS p75,
           CAST(max(d) AS BIGINT) AS max, {pct('count(*) FILTER (is_same_day_response)', 'count(*)')} AS same_day_pct
    FROM (SELECT review_response_delay_days AS d, is_same_day_response FROM silver_reviews)"""))
def _(r):
    return reports.response_latency(r.use("reviews"))


_LABELS = """count(*) FILTER (review_label = 'Neutral') AS "Neutral",
    count(*) FILTER (review_label = 'Satisfied') AS "Satisfied",
    count(*) FILTER (review_label = 'Unsatisfied') AS "Unsatisfied", count(*) AS "Total_Reviews",
    """ + pct("count(*) FILTER (review_label = 'Unsatisfied')", "count(*)") + ' AS "Unsatisfied_Rate"'


@query("category_dissatisfaction", "X13 J11", sql(f"""
    SELECT product_category_name, {_LABELS} FROM silver_reviews r JOIN silver_items i ON r.order_id = i.order_id
    JOIN silver_products p ON i.product_id = p.product_id GROUP BY 1 HAVING count(*) >= 50
    ORDER BY "Unsatisfied_Rate" DESC, 1 LIMIT 10"""))
def _(r):
    r.keep("orders")
    return reports.category_dissatisfaction(r.use("reviews"), r.use("items"), r.use("products"))


# Sellers of all sizes: a third are taken together in four, the others' items are parted among
# 4 or 40 by order.
_SIZED = """CASE CAST(seller_id AS INT) % 3 WHEN 0 THEN concat('joint-', CAST(CAST(seller_id AS INT) % 4 AS STRING))
    WHEN 1 THEN concat(seller_id, '-', CAST(CAST(order_id AS BIGINT) % 4 AS STRING))
    ELSE concat(seller_id, '-', CAST(CAST(order_id AS BIGINT) % 40 AS STRING)) END"""


@query("seller_size_satisfaction", "X14 C37", sql(f"""
    SELECT CASE WHEN n < 50 THEN 'Small Seller' WHEN n <= 500 THEN 'Medium Seller' ELSE 'Large Seller' END
               AS seller_segment, {_LABELS}
    FROM (SELECT review_label, count(*) OVER (PARTITION BY seller_id) AS n FROM silver_reviews r
          JOIN (SELECT order_id, {_SIZED} AS seller_id FROM silver_items) i ON r.order_id = i.order_id) GROUP BY 1"""))
def _(r):
    r.keep("orders")
    return reports.seller_size_satisfaction(r.use("reviews"), r.use("items").withColumn("seller_id", F.expr(_SIZED)))


# Every fifth payment of an order is of value zero here; no payment of the table is.
_VALUE = "CASE WHEN payment_sequential % 5 = 4 THEN 0 ELSE payment_value END"


@query("zero_payments", "X15", sql(f"""
    SELECT payment_type, count(*) FILTER ({_VALUE} = 0) AS zero_value_rows,
           count(*) FILTER (payment_installments = 0) AS zero_installment_rows FROM raw_payments GROUP BY 1"""))
def _(r):
    return reports.zero_payments(r.role("raw_payments").withColumn("payment_value", F.expr(_VALUE)))


@query("payment_type_share", "X16", sql(f"""
    SELECT payment_type, count(*) AS row_count, {pct('count(*)', '(SELECT count(*) FROM silver_payments)')} AS percentage
    FROM silver_payments GROUP BY 1"""))
def _(r):
    return reports.payment_type_share(r.use("payments"))


# named here in full: only the payments and the keys of the orders are needed
@query("split_timelines", "X17 J10", f"""
    WITH known AS MATERIALIZED (
        SELECT DISTINCT trim(order_id) AS order_id, payment_sequential, lower(trim(payment_type)) AS payment_type,
               payment_installments, payment_value
        FROM ({role_sql('raw_payments')}) p
        WHERE order_id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders)),
    split AS MATERIALIZED (SELECT DISTINCT order_id FROM known WHERE payment_sequential >= 7)
    SELECT order_id, CAST(payment_sequential AS BIGINT) AS payment_sequential, payment_type,
           CAST(payment_value AS DOUBLE) AS payment_value
    FROM known JOIN split USING (order_id)""")
def _(r):
    found = reports.split_timelines(r.use("payments"), 7)
    return found.select("order_id", "payment_sequential", "payment_type", "payment_value")


@query("split_orders_by_status", "X18", sql("""
    SELECT order_status, count(*) AS row_count FROM silver_orders
    WHERE order_id IN (SELECT order_id FROM silver_payments WHERE payment_sequential >= 7) GROUP BY 1"""))
def _(r):
    return reports.split_orders_by_status(r.use("payments"), r.use("orders"), 7)


@query("reconciliation_summary", "X19", sql(f"""
    SELECT count(*) AS total_orders, count(*) FILTER (variance = 0) AS perfect_matches,
           count(*) FILTER (variance <> 0) AS numeric_discrepancies, count(*) FILTER (variance IS NULL) AS missing_data,
           {pct('count(*) FILTER (variance = 0)', 'count(*)')} AS match_pct FROM recon"""))
def _(r):
    return reports.reconciliation_summary(r.recon)


@query("discrepancies", "X20 C39", sql(f"""
    SELECT CASE WHEN variance > 0 THEN 'Overpayment (Paid > Cost)' ELSE 'Underpayment (Paid < Cost)' END
               AS discrepancy_type, count(*) AS order_count,
           {pct('count(*)', '(SELECT count(*) FROM recon WHERE variance <> 0)')} AS percentage
    FROM recon WHERE variance <> 0 GROUP BY 1"""))
def _(r):
    return reports.discrepancies(r.recon)


_OVERPAID = "silver_payments WHERE order_id IN (SELECT order_id FROM recon WHERE variance > 0)"


def _paid(r):
    """Reconciliation and payments over one stored copy of the payments."""
    r.keep("orders", "payments")
    return r.recon, r.use("payments")


@query("overpay_profile", "X21 A03", sql(f"""
    SELECT payment_type, count(DISTINCT order_id) AS unique_orders, count(*) AS total_transaction_rows
    FROM {_OVERPAID} GROUP BY 1"""))
def _(r):
    return reports.overpaid_by_type(*_paid(r))


@query("overpaid_installments", "X21", sql(f"""
    SELECT CAST(min(payment_installments) AS BIGINT) AS min_installments,
           CAST(max(payment_installments) AS BIGINT) AS max_installments,
           {rnd('avg(payment_installments)')} AS avg_installments FROM {_OVERPAID}"""))
def _(r):
    return reports.overpaid_installments(*_paid(r))


@query("overpaid_by_installments", "X21", sql(f"""
    SELECT CAST(payment_installments AS BIGINT) AS payment_installments, count(DISTINCT order_id) AS unique_orders
    FROM {_OVERPAID} GROUP BY 1"""))
def _(r):
    return reports.overpaid_by_installments(*_paid(r))


@query("method_combo", "X22 A10", sql(f"""
    SELECT payment_methods, CAST(m AS BIGINT) AS true_max_installments, count(*) AS order_count,
           CAST(sum(n) AS BIGINT) AS transaction_count
    FROM (SELECT order_id, string_agg(payment_type || ' x' || c, ' + ' ORDER BY payment_type || ' x' || c)
                     AS payment_methods, max(m) AS m, sum(c) AS n
          FROM (SELECT order_id, payment_type, count(*) AS c, max(payment_installments) AS m FROM {_OVERPAID}
                GROUP BY 1, 2) GROUP BY 1) GROUP BY 1, 2"""))
def _(r):
    return reports.payment_profiles(*_paid(r))


@query("overpaid_by_month", "X23 A26", sql("""
    SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, count(*) AS order_count FROM silver_orders
    WHERE order_id IN (SELECT order_id FROM recon WHERE variance > 0) GROUP BY 1"""))
def _(r):
    r.keep("orders")
    return reports.overpaid_by_month(r.recon, r.use("orders"))


@query("overpaid_by_seller", "X23", sql("""
    SELECT seller_id, count(DISTINCT order_id) AS order_count FROM silver_items
    WHERE order_id IN (SELECT order_id FROM recon WHERE variance > 0) GROUP BY 1"""))
def _(r):
    r.keep("orders", "items")
    return reports.overpaid_by_seller(r.recon, r.use("items"))


_PCT = f"""(SELECT order_id, variance, {rnd('abs(CAST(variance AS DOUBLE)) * 100 / nullif(CAST(total_items_value AS DOUBLE), 0)')}
    AS p FROM recon WHERE variance <> 0)"""


@query("variance_pct_stats", "X24 F21", sql(f"""
    SELECT {rnd('avg(p)')} AS average_percentage, round(quantile_disc(p, 0.5), 1) AS median_percentage,
           (SELECT p FROM {_PCT} WHERE variance > 0 AND p IS NOT NULL GROUP BY p ORDER BY count(*) DESC, p LIMIT 1)
               AS mode_percentage
    FROM {_PCT} WHERE variance > 0"""))
def _(r):
    r.keep("orders", "recon")
    # the sketch's rank error allows for the next value
    stats = reports.variance_stats(r.use("recon"))
    return stats.withColumn("median_percentage", F.round("median_percentage", 1))


@query("variance_by_installments", "X25 A17", sql(f"""
    SELECT v.p AS variance_percentage, CAST(payment_installments AS BIGINT) AS payment_installments, count(*) AS frequency
    FROM {_PCT} v JOIN silver_payments s ON v.order_id = s.order_id WHERE variance > 0 GROUP BY 1, 2"""))
def _(r):
    return reports.variance_by_installments(*_paid(r))


@query("underpayment_profile", "X26", sql(f"""
    SELECT v.p AS underpayment_percentage, payment_type, CAST(payment_installments AS BIGINT) AS payment_installments,
           count(*) AS frequency
    FROM {_PCT} v JOIN silver_payments s ON v.order_id = s.order_id WHERE variance < 0 AND p >= 25 GROUP BY 1, 2, 3"""))
def _(r):
    return reports.underpayment_profile(*_paid(r), min_pct=25.0)


_WANTED = f"order_id IN (SELECT order_id FROM {_PCT} WHERE variance > 0 AND p >= 20)"


@query("drill_down", "X27", sql(f"""
    SELECT order_id, 'payment' AS kind, CAST(payment_sequential AS BIGINT) AS position, payment_type AS detail,
           CAST(payment_value AS DOUBLE) AS amount FROM silver_payments WHERE {_WANTED}
    UNION ALL SELECT order_id, 'item', CAST(order_item_id AS BIGINT), product_id, CAST(price AS DOUBLE) FROM silver_items
    WHERE {_WANTED}
    UNION ALL SELECT order_id, 'order', 0, order_status, CAST(total_order_cost AS DOUBLE) FROM costed
    WHERE {_WANTED}"""))
def _(r):
    r.keep("orders", "item_values", "payments", "costed")
    wanted = reports.with_variance_pct(reports.overpaid(r.recon)).where("variance_percentage >= 20").select("order_id")
    return reports.drill_down(stored(wanted, "wanted"), r.use("payments"), r.use("item_values"), r.use("costed"))


@query("unpaid_order_status", "X34", sql("""
    SELECT order_status, count(*) FILTER (total_amount_paid IS NULL) AS no_payment,
           count(*) FILTER (total_items_value IS NULL) AS no_cost
    FROM recon x LEFT JOIN silver_orders o ON x.order_id = o.order_id WHERE variance IS NULL GROUP BY 1"""))
def _(r):
    r.keep("orders")
    return reports.unpaid_order_status(r.recon, r.use("orders"))


@query("state_share", "X28", sql(f"""
    SELECT customer_state, count(*) AS transaction_count,
           {pct('count(*)', '(SELECT count(*) FROM customers_typed)')} AS percentage FROM customers_typed GROUP BY 1"""))
def _(r):
    return reports.place_share(r.use("customers"), "customer_state")


_LOYAL = """(SELECT customer_unique_id, n AS order_count, CASE WHEN n = 1 THEN 'New' WHEN n <= 4 THEN 'Repeat'
    ELSE 'Elite' END AS loyalty_segment FROM (
        SELECT customer_unique_id, count(customer_id) AS n FROM customers_typed GROUP BY 1))"""


@query("loyalty", "X29 C36", sql(f"SELECT * FROM {_LOYAL}"))
def _(r):
    return reports.customer_loyalty(r.use("customers"))


@query("elite_customers", "X29 O01", sql(f"""
    SELECT customer_unique_id, order_count FROM {_LOYAL} WHERE loyalty_segment = 'Elite' ORDER BY 2 DESC, 1"""))
def _(r):
    elite = reports.elite_customers(reports.customer_loyalty(r.use("customers")))
    return elite.orderBy(F.desc("order_count"), "customer_unique_id")


@query("loyalty_share", "X29 A12", sql(f"""
    SELECT loyalty_segment, count(*) AS unique_customer_count,
           {pct('count(*)', '(SELECT count(DISTINCT customer_unique_id) FROM customers_typed)')} AS percentage
    FROM {_LOYAL} GROUP BY 1"""))
def _(r):
    return reports.loyalty_share(reports.customer_loyalty(r.use("customers")))


def _impact(where: str) -> str:
    market_n, market_items = "(SELECT count(*) FROM seller_matrix)", "(SELECT sum(total_items_sold) FROM seller_matrix)"
    return f"""SELECT count(*) AS seller_count, CAST(coalesce(sum(total_items_sold), 0) AS BIGINT) AS items_sold,
        CAST(coalesce(sum(late_preparations), 0) AS BIGINT) AS delayed_items,
        {pct('count(*)', market_n)} AS seller_pct, {pct('coalesce(sum(total_items_sold), 0)', market_items)} AS volume_pct,
        {pct('coalesce(sum(late_preparations), 0)', market_items)} AS delayed_pct FROM seller_matrix WHERE {where}"""


@query("elite_sellers", "X30", sql("""
    SELECT seller_id, CAST(total_items_sold AS BIGINT) AS total_items_sold, early_ratio, on_time_ratio FROM seller_matrix
    WHERE total_items_sold > 100 AND round(early_ratio + on_time_ratio, 2) > 35"""))
def _(r):
    # item timing here is spread evenly, so the report's 95 percent would select nobody
    elite = reports.elite_sellers(r.matrix, 100, 35.0)
    return elite.select("seller_id", "total_items_sold", "early_ratio", "on_time_ratio")


@query("bottleneck_share", "X31", sql(_impact("total_items_sold > 10 AND late_ratio > 20")))
def _(r):
    r.keep("matrix")
    return reports.group_impact(r.use("matrix"), reports.bottleneck_sellers(r.use("matrix")))


@query("fast_seller_share", "X32", sql(_impact("avg_handling_days <= -7")))
def _(r):
    r.keep("matrix")
    return reports.group_impact(r.use("matrix"), reports.fast_sellers(r.use("matrix")))


@query("fastest_sellers", "X32 O04", sql("""
    SELECT seller_id, avg_handling_days FROM seller_matrix WHERE avg_handling_days <= 0
    ORDER BY avg_handling_days, seller_id LIMIT 1"""))
def _(r):
    return reports.speed_record(r.matrix, 0.0).select("seller_id", "avg_handling_days")


@query("late_ratio_histogram", "X33", sql("""
    SELECT CAST(bin AS BIGINT) AS bin, count(*) AS row_count, round(lo + bin * (hi - lo) / 20, 6) AS bin_start FROM (
        SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor((late_ratio - lo) * 20 / (hi - lo)), 19) END AS bin, lo, hi
        FROM seller_matrix, (SELECT min(late_ratio) AS lo, max(late_ratio) AS hi FROM seller_matrix
            WHERE total_items_sold > 10 AND late_ratio > 20) WHERE total_items_sold > 10 AND late_ratio > 20)
    GROUP BY bin, lo, hi"""))
def _(r):
    from tamarind.operators.aggregates import histogram

    r.keep("matrix")
    return histogram(reports.bottleneck_sellers(r.use("matrix")), "late_ratio", 20)
