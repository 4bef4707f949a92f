"""Data-quality, repair and integrity queries (Q*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind.catalog.base import query
from tamarind.catalog.oracle import clean, pct, secs, sql
from tamarind.functions import fixed
from tamarind.functions.temporal import wall_clock
from tamarind.functions.text import clean_text
from tamarind.operators import repair
from tamarind.operators.profiles import integrity_gap, missing_when, nulls_by
from tamarind.operators.quality import (
    ForeignKey,
    Holds,
    NotNull,
    Unique,
    check_rules,
    guarded,
    missing_names,
    missing_of,
    outcome_table,
    summarise,
    tag,
)
from tamarind.plans import reports

_RULES = (
    NotNull("customers_null_customer_id", "customers", ("customer_id",)),
    NotNull("leads_null_id", "leads", ("mql_id",)),
    NotNull("orders_null_dates", "orders", ("order_approved_at", "order_delivered_customer_date")),
    ForeignKey("items_orphan_order_id", "items", "order_id", "orders", "order_id"),
    ForeignKey("payments_orphan_order_id", "payments", "order_id", "orders", "order_id"),
    ForeignKey("deals_orphan_mql_id", "deals", "mql_id", "leads", "mql_id"),
    ForeignKey("converted_seller_unknown", "acquisition", "seller_id", "sellers", "seller_id", where="converted_flag"),
    Unique("items_unique", "raw_items", ("order_id", "order_item_id")),
    Holds("orders_in_order", "orders", "order_approved_at <= order_delivered_customer_date"),
)


# Rules that cannot run: the table or column is not there, or a row makes the rule fail.
_BROKEN = (
    NotNull("returns_null_id", "returns", ("return_id",)),
    Holds("orders_no_such_column", "orders", "order_paid_at IS NOT NULL"),
    Holds("orders_status_is_a_number", "orders", "CAST(order_status AS INT) > 0"),
)


@query("dq_summary", "Q04 Q10 Q11 Q12 Q13 Q14 Q15", sql("""
    SELECT 'customers_null_customer_id' AS dq_rule, count(*) FILTER (customer_id IS NULL) AS issue_count FROM silver_customers
    UNION ALL SELECT 'leads_null_id', count(*) FILTER (mql_id IS NULL) FROM raw_leads
    UNION ALL SELECT 'orders_null_dates', count(*) FROM silver_orders
        WHERE order_approved_at IS NULL OR order_delivered_customer_date IS NULL
    UNION ALL SELECT 'items_orphan_order_id', count(*) FROM silver_items
        WHERE order_id NOT IN (SELECT order_id FROM silver_orders)
    UNION ALL SELECT 'payments_orphan_order_id', count(*) FROM silver_payments
        WHERE order_id NOT IN (SELECT order_id FROM silver_orders)
    UNION ALL SELECT 'deals_orphan_mql_id', count(*) FROM silver_deals d
        WHERE NOT EXISTS (SELECT 1 FROM silver_leads l WHERE l.mql_id = d.mql_id)
    UNION ALL SELECT 'converted_seller_unknown', count(*) FROM acquisition a WHERE converted_flag
        AND NOT EXISTS (SELECT 1 FROM sellers_typed s WHERE s.seller_id = a.seller_id)
    UNION ALL SELECT 'items_unique', count(*) FROM (SELECT 1 FROM raw_items GROUP BY order_id, order_item_id
        HAVING count(*) > 1)
    UNION ALL SELECT 'orders_in_order', count(*) FROM silver_orders
        WHERE NOT coalesce(order_approved_at <= order_delivered_customer_date, false)
    UNION ALL VALUES ('returns_null_id', 1), ('orders_no_such_column', 1), ('orders_status_is_a_number', 1),
        ('expected_table_missing', 1)"""))
def _(r):
    used = ("orders", "items", "customers", "payments", "deals", "acquisition")
    r.keep(*used)
    tables = {t: r.use(t) for t in used}
    raw = {"leads": r.role("raw_leads"), "sellers": r.role("raw_sellers"), "raw_items": r.role("raw_items")}
    outcomes = check_rules(r.spark, (*_RULES, *_BROKEN), {**tables, **raw})
    missing = missing_of(("customers", "orders", "items", "returns"), list(tables))
    outcomes.append(("expected_table_missing", len(missing), ", ".join(missing)))
    return outcome_table(r.spark, outcomes).select("dq_rule", "issue_count")


@query("rule_counts", "Q10 Q11 Q13 D15", sql("""
    SELECT 'items_orphan_product_id' AS dq_rule, count(*) AS issue_count FROM raw_items i
        WHERE NOT EXISTS (SELECT 1 FROM silver_products p WHERE p.product_id = i.product_id AND p.product_weight_g > 2000)
    UNION ALL SELECT 'items_orphan_seller_id', count(*) FROM raw_items
        WHERE CAST(seller_id AS INT) NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
    UNION ALL SELECT 'items_orphan_order_id', count(*) FROM raw_items
        WHERE order_id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders)
    UNION ALL SELECT 'payments_orphan_order_id', count(*) FROM raw_payments
        WHERE order_id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders)
    UNION ALL SELECT 'items_unique_seller', count(*) FROM (SELECT 1 FROM raw_items GROUP BY order_id, seller_id
        HAVING count(*) > 1)
    UNION ALL SELECT 'items_null_limit', count(*) FROM raw_items WHERE shipping_limit_date IS NULL"""))
def _(r):
    # heavy products and solvent sellers only, so that every foreign key has orphans
    heavy = r.products.rows.where("product_weight_g > 2000").select("product_id")
    solvent = r.table("supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("seller_id"))
    known = r.table("orders").select(F.col("o_orderkey").cast("string").alias("order_id"))
    rules = (
        ForeignKey("items_orphan_product_id", "items", "product_id", "products", "product_id"),
        ForeignKey("items_orphan_seller_id", "items", "seller_id", "sellers", "seller_id"),
        ForeignKey("items_orphan_order_id", "items", "order_id", "orders", "order_id"),
        ForeignKey("payments_orphan_order_id", "payments", "order_id", "orders", "order_id"),
        Unique("items_unique_seller", "items", ("order_id", "seller_id")),
        NotNull("items_null_limit", "items", ("shipping_limit_date",)),
    )
    tables = {"items": r.role("raw_items"), "payments": r.role("raw_payments")}
    return summarise(rules, {**tables, "products": heavy, "sellers": solvent, "orders": known})


@query("missing_names", "Q14 Q15 S20 S21", sql("""
    SELECT n_name, 'missing_member' AS dq_rule FROM (VALUES ('NATION_1'), ('nation2'), ('region2')) AS t(n_name)
    WHERE n_name NOT IN (SELECT n_name FROM nation)"""))
def _(r):
    check = lambda: missing_names(r.spark, ["NATION_1", "nation2", "region2"], r.table("nation"), "n_name")
    return guarded(r.spark, "missing_member", check)


@query("tagged_reasons", "Q02 Q03", sql("""
    SELECT error_reason, count(*) AS row_count FROM (
        SELECT CASE WHEN mql_id IS NULL THEN 'Critical: missing lead' ELSE 'Orphaned lead' END AS error_reason
        FROM raw_leads WHERE mql_id IS NULL OR mql_id NOT IN (SELECT mql_id FROM raw_deals)) GROUP BY 1"""))
def _(r):
    from tamarind.operators.joins import orphans

    reason = F.when(F.col("mql_id").isNull(), "Critical: missing lead").otherwise("Orphaned lead")
    lost = tag(orphans(r.role("raw_leads"), r.role("raw_deals"), "mql_id"), reason)
    return lost.groupBy("error_reason").agg(F.count("*").alias("row_count"))


@query("unknown_member", "Q09", sql("""
    SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier UNION ALL SELECT '-1', 'Unknown'"""))
def _(r):
    named = r.table("supplier").select(F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name")
    once = repair.with_unknown_member(named, "s_suppkey", {"s_name": "Unknown"})
    return repair.with_unknown_member(once, "s_suppkey", {"s_name": "Unknown"})


@query("limit_date_rebuild", "Q25", sql("""
    SELECT CAST(shipping_limit_date AS VARCHAR) AS shipping_limit_date, count(*) AS items FROM items_rebuilt GROUP BY 1"""))
def _(r):
    return r.use("items").groupBy("shipping_limit_date").agg(F.count("*").alias("items"))


_FILL = f"""
    SELECT order_id, order_status, p AS order_purchase_timestamp, a AS order_approved_at,
           c AS order_delivered_carrier_date, coalesce(order_delivered_customer_date,
               CASE WHEN order_status = 'delivered' THEN c + s * (SELECT g3 FROM gaps) END) AS order_delivered_customer_date
    FROM (SELECT *, coalesce(order_delivered_carrier_date,
              CASE WHEN order_status = 'delivered' THEN a + s * (SELECT g2 FROM gaps) END) AS c
          FROM (SELECT *, coalesce(order_approved_at,
                    CASE WHEN order_status = 'delivered' THEN p + s * (SELECT g1 FROM gaps) END) AS a
                FROM (SELECT *, coalesce(order_purchase_timestamp, order_approved_at - s * (SELECT g1 FROM gaps),
                             order_delivered_carrier_date - s * (SELECT g1 + g2 FROM gaps),
                             order_delivered_customer_date - s * (SELECT g1 + g2 + g3 FROM gaps),
                             order_estimated_delivery_date - s * (SELECT g4 FROM gaps)) AS p
                      FROM (SELECT *, INTERVAL '1' SECOND AS s FROM blanked))))"""
_BLANKED = """SELECT * REPLACE (CASE WHEN day(order_purchase_timestamp) <= 3 THEN NULL ELSE order_purchase_timestamp END
    AS order_purchase_timestamp) FROM orders_typed"""
_GAPS = f"""SELECT CAST(quantile_disc({secs('order_purchase_timestamp', 'order_approved_at')}, 0.5) AS BIGINT) AS g1,
    CAST(quantile_disc({secs('order_approved_at', 'order_delivered_carrier_date')}, 0.5) AS BIGINT) AS g2,
    CAST(quantile_disc({secs('order_delivered_carrier_date', 'order_delivered_customer_date')}, 0.5) AS BIGINT) AS g3,
    CAST(quantile_disc({secs('order_purchase_timestamp', 'order_estimated_delivery_date')}, 0.5) AS BIGINT) AS g4
    FROM blanked WHERE order_purchase_timestamp IS NOT NULL AND order_approved_at IS NOT NULL
    AND order_delivered_carrier_date IS NOT NULL AND order_delivered_customer_date IS NOT NULL"""


def _with_gaps(select: str) -> str:
    text = sql("SELECT * FROM orders_typed")
    head = text[: text.rindex("SELECT * FROM orders_typed")].rstrip()
    return f"{head},\nblanked AS MATERIALIZED ({_BLANKED}),\ngaps AS MATERIALIZED ({_GAPS})\n{select}"


_STAGES = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in fixed.MILESTONES)


def _blanked(r):
    bought = fixed.MILESTONES[0]
    early = F.dayofmonth(bought) <= 3
    return r.use("orders").withColumn(bought, F.when(~early, F.col(bought)))


@query("sequential_imputation", "Q26 A08", _with_gaps(f"SELECT order_id, order_status, {_STAGES} FROM ({_FILL})"))
def _(r):
    return repair.fill_milestones(_blanked(r)).select("order_id", "order_status", *fixed.MILESTONES)


@query("clamp_chronology", "Q27", sql("""
    SELECT order_id, CAST(p AS VARCHAR) AS order_purchase_timestamp, CAST(a AS VARCHAR) AS order_approved_at,
           CAST(c AS VARCHAR) AS order_delivered_carrier_date,
           CAST(CASE WHEN order_delivered_customer_date < c THEN c ELSE order_delivered_customer_date END AS VARCHAR)
               AS order_delivered_customer_date
    FROM (SELECT *, CASE WHEN order_delivered_carrier_date < a THEN a ELSE order_delivered_carrier_date END AS c
          FROM (SELECT *, order_purchase_timestamp AS p, CASE WHEN order_approved_at < order_purchase_timestamp
                    THEN order_purchase_timestamp ELSE order_approved_at END AS a FROM raw_orders))"""))
def _(r):
    return repair.clamp_chronology(r.role("raw_orders")).select("order_id", *fixed.MILESTONES)


@query("swap_reversed", "Q28", sql("""
    SELECT review_id, CAST(CASE WHEN b < a THEN b ELSE a END AS VARCHAR) AS created,
           CAST(CASE WHEN b < a THEN a ELSE b END AS VARCHAR) AS answered
    FROM (SELECT review_id, review_creation_date AS a, review_answer_timestamp AS b FROM reviews_usable)"""))
def _(r):
    usable = r.role("raw_reviews").where("review_id IS NOT NULL AND order_id IS NOT NULL AND review_score IS NOT NULL")
    dated = usable.select(
        "review_id", wall_clock("review_creation_date").alias("created"), wall_clock("review_answer_timestamp").alias("answered")
    )
    return repair.swap_if_reversed(dated, "created", "answered")


@query("review_cascade", "Q30", sql(f"""
    SELECT review_id, order_id, CAST(c AS VARCHAR) AS review_creation_date,
           CAST(coalesce(review_answer_timestamp, c + INTERVAL '1' SECOND * CAST(m2 AS BIGINT)) AS VARCHAR)
               AS review_answer_timestamp
    FROM (SELECT *, coalesce(review_creation_date, order_purchase_timestamp + INTERVAL '1' SECOND * CAST(m1 AS BIGINT)) AS c
          FROM reviews_latest, (
              SELECT quantile_disc({secs('order_purchase_timestamp', 'review_creation_date')}, 0.5) AS m1,
                     quantile_disc({secs('review_creation_date', 'review_answer_timestamp')}, 0.5) AS m2
              FROM reviews_latest WHERE review_creation_date IS NOT NULL AND review_answer_timestamp IS NOT NULL))"""))
def _(r):
    from tamarind.operators.dedupe import latest_per_key
    from tamarind.operators.joins import attach

    usable = r.role("raw_reviews").where("review_id IS NOT NULL AND order_id IS NOT NULL AND review_score IS NOT NULL")
    dated = usable.select(
        "review_id", "order_id", F.col("review_score").cast("int").alias("review_score"),
        wall_clock("review_creation_date").alias("review_creation_date"),
        wall_clock("review_answer_timestamp").alias("review_answer_timestamp"),
    )
    newest = latest_per_key(dated, ["order_id"], "review_answer_timestamp")
    bought = r.role("raw_orders").select("order_id", "order_purchase_timestamp")
    filled = repair.fill_review_cascade(attach(newest, bought, "order_id", "inner"))
    return filled.select("review_id", "order_id", "review_creation_date", "review_answer_timestamp")


@query("centroid_impute", "Q21", sql("""
    SELECT zip, round(CASE WHEN lat < -34 OR lat > 6 THEN clat ELSE lat END, 6) AS lat,
           round(CASE WHEN lng < -75 OR lng > -28 THEN clng ELSE lng END, 6) AS lng
    FROM (SELECT geolocation_zip_code_prefix AS zip, geolocation_lat AS lat, geolocation_lng AS lng FROM raw_geo)
    LEFT JOIN (SELECT geolocation_zip_code_prefix AS z, avg(geolocation_lat) AS clat, avg(geolocation_lng) AS clng
               FROM raw_geo WHERE geolocation_lat BETWEEN -34 AND 6 AND geolocation_lng BETWEEN -75 AND -28 GROUP BY 1)
        ON zip = z"""))
def _(r):
    points = r.role("raw_geo").select(
        F.col("geolocation_zip_code_prefix").alias("zip"), F.col("geolocation_lat").alias("lat"),
        F.col("geolocation_lng").alias("lng"),
    )
    return repair.fill_from_centroid(points, "zip", "lat", "lng")


@query("city_standardised", "Q22 A15", sql(f"""
    SELECT g.geolocation_zip_code_prefix AS zip, m.city, count(*) AS row_count
    FROM raw_geo g JOIN (SELECT zip, city FROM (
        SELECT geolocation_zip_code_prefix AS zip, {clean('geolocation_city')} AS city, row_number() OVER (
            PARTITION BY geolocation_zip_code_prefix ORDER BY count(*) DESC, {clean('geolocation_city')}) AS rn
        FROM raw_geo GROUP BY 1, 2) WHERE rn = 1) m ON g.geolocation_zip_code_prefix = m.zip GROUP BY 1, 2"""))
def _(r):
    points = r.role("raw_geo").select(
        F.col("geolocation_zip_code_prefix").alias("zip"), clean_text("geolocation_city").alias("city")
    )
    return repair.standardise_by_majority(points, "zip", "city").groupBy("zip", "city").agg(F.count("*").alias("row_count"))


_DATES = ("order_delivered_customer_date", "order_delivered_carrier_date", "order_approved_at")


@query("null_pattern_by_status", "Q32", sql(f"""
    SELECT order_status, {', '.join(f'count(*) FILTER ({c} IS NULL) AS {c}_nulls' for c in _DATES)}
    FROM orders_typed GROUP BY 1"""))
def _(r):
    return nulls_by(r.use("orders"), "order_status", _DATES)


@query("delivered_without_date", "Q31", sql(" UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count(*) FILTER (order_status = 'delivered' AND {c} IS NULL) AS error_count,
           {pct(f"count(*) FILTER (order_status = 'delivered' AND {c} IS NULL)", 'count(*)', 4)} AS error_pct
    FROM orders_typed""" for c in _DATES)))
def _(r):
    return missing_when(r.use("orders"), F.col("order_status") == "delivered", _DATES)


@query("integrity_gap", "Q33", sql(f"""
    SELECT count(*) AS total_rows, count(*) FILTER (zip_code_prefix IS NULL) AS unmapped_rows,
           {pct('count(*) FILTER (zip_code_prefix IS NULL)', 'count(*)', 4)} AS unmapped_pct
    FROM customers_typed LEFT JOIN silver_geo ON customer_zip_code_prefix = zip_code_prefix"""))
def _(r):
    return integrity_gap(
        r.use("customers"), r.use("geolocation"), {"customer_zip_code_prefix": "zip_code_prefix"}
    )


@query("untranslated_categories", "Q34", sql("""
    SELECT product_category_name, count(*) AS product_count FROM products_typed
    WHERE product_category_name IS NOT NULL
        AND product_category_name NOT IN (SELECT product_category_name FROM translation) GROUP BY 1"""))
def _(r):
    from tamarind.functions.text import label_text
    from tamarind.plans.silver import translations

    named = r.role("raw_products").withColumn("product_category_name", label_text("product_category_name"))
    return reports.untranslated_categories(named, translations(r.role("raw_translation")))


_LOST = ("product_name_lenght", "product_photos_qty")


@query("incomplete_product_sales", "Q35", sql("""
    SELECT p.product_id, CAST(product_name_lenght AS BIGINT) AS product_name_lenght,
           CAST(product_photos_qty AS BIGINT) AS product_photos_qty, count(i.order_id) AS times_bought,
           CAST(sum(i.price) AS DOUBLE) AS total_revenue, count(DISTINCT i.seller_id) AS seller_count
    FROM raw_products p LEFT JOIN raw_items i ON p.product_id = i.product_id
    WHERE product_name_lenght IS NULL OR product_photos_qty IS NULL GROUP BY 1, 2, 3"""))
def _(r):
    return reports.incomplete_product_sales(r.role("raw_products"), r.role("raw_items"), _LOST)


@query("incomplete_product_sellers", "Q35 A10", sql("""
    SELECT DISTINCT product_id, seller_id FROM raw_items WHERE product_id IN (
        SELECT product_id FROM raw_products WHERE product_name_lenght IS NULL OR product_photos_qty IS NULL)"""))
def _(r):
    return reports.incomplete_product_sellers(r.role("raw_products"), r.role("raw_items"), _LOST)
