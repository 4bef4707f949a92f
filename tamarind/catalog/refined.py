"""Registered queries of the refined lineage, each beside its SQL."""

from __future__ import annotations

from tamarind.catalog.base import query
from tamarind.catalog.oracle import clean, days, region, secs, sql
from tamarind.catalog.quality import _GAPS
from tamarind.functions import fixed
from tamarind.plans import refined
from tamarind.sources.tables import Lake

_BRONZE = {
    "geolocation": "raw_geo", "customers": "raw_customers", "sellers": "raw_sellers", "orders": "raw_orders",
    "products": "raw_products", "order_items": "raw_items", "order_payments": "raw_payments",
    "order_reviews": "raw_reviews",
}
_ZIP = "CAST(geolocation_zip_code_prefix AS VARCHAR)"
_POINTS = f"""(SELECT DISTINCT trim({_ZIP}) AS zip, geolocation_lat AS lat, geolocation_lng AS lng,
    {clean('geolocation_city')} AS city, upper(trim(geolocation_state)) AS state FROM raw_geo)"""


def _table(r, name: str):
    """One refined table, with those that it starts from and no others."""
    lake = Lake(r.spark, r.scratch.path("refined"))
    return refined.build_refined(lake, {t: r.role(role) for t, role in _BRONZE.items()}, only=[name])[name]


@query("refined_geolocation", "Q09 Q21 Q22 A15", sql(f"""
    SELECT DISTINCT zip AS zip_code_prefix, round(CASE WHEN lat < -34 OR lat > 6 THEN clat ELSE lat END, 6)
        AS latitude, round(CASE WHEN lng < -75 OR lng > -28 THEN clng ELSE lng END, 6) AS longitude,
        c.city, state, {region('state')} AS region
    FROM {_POINTS} p
    LEFT JOIN (SELECT zip AS z, avg(lat) AS clat, avg(lng) AS clng FROM {_POINTS}
               WHERE lat BETWEEN -34 AND 6 AND lng BETWEEN -75 AND -28 GROUP BY 1) m ON p.zip = m.z
    LEFT JOIN (SELECT zip AS cz, city, row_number() OVER (PARTITION BY zip ORDER BY count(*) DESC, city) AS rn
               FROM {_POINTS} GROUP BY 1, 2) c ON p.zip = c.cz AND c.rn = 1
    UNION ALL SELECT '-1', NULL, NULL, 'unknown', 'XX', 'Unknown'"""))
def _(r):
    return _table(r, "geolocation")


@query("refined_customers", "Q07 Q09", sql(f"""
    SELECT customer_id, customer_unique_id, CASE WHEN CAST(customer_zip_code_prefix AS VARCHAR) IN (
        SELECT trim({_ZIP}) FROM raw_geo) THEN CAST(customer_zip_code_prefix AS VARCHAR) ELSE '-1' END AS zip_code_prefix,
        customer_city, customer_state, {region('customer_state')} AS customer_region FROM customers_typed
    UNION ALL SELECT '-1', '-1', '-1', 'unknown', 'XX', 'Unknown'"""))
def _(r):
    return _table(r, "customers")


@query("refined_sellers", "Q07 Q09", sql(f"""
    SELECT seller_id, CASE WHEN seller_zip_code_prefix IN (SELECT trim({_ZIP}) FROM raw_geo)
        THEN seller_zip_code_prefix ELSE '-1' END AS zip_code_prefix, {clean('seller_city')} AS seller_city, seller_state
    FROM raw_sellers UNION ALL SELECT '-1', '-1', 'unknown', 'XX'"""))
def _(r):
    return _table(r, "sellers")


_S = "INTERVAL '1' SECOND"
# milestones filled one after another, then none before the one before it
_TIMED = f"""
    SELECT order_id, customer_id, order_status, p AS order_purchase_timestamp, greatest(p, a0) AS order_approved_at,
           CASE WHEN c0 IS NOT NULL THEN greatest(p, a0, c0) END AS order_delivered_carrier_date,
           CASE WHEN d0 IS NOT NULL THEN greatest(d0, CASE WHEN c0 IS NOT NULL THEN greatest(p, a0, c0) END) END
               AS order_delivered_customer_date, order_estimated_delivery_date
    FROM (SELECT *, coalesce(order_delivered_customer_date,
              CASE WHEN order_status = 'delivered' THEN c0 + {_S} * (SELECT g3 FROM gaps) END) AS d0
          FROM (SELECT *, coalesce(order_delivered_carrier_date,
                    CASE WHEN order_status = 'delivered' THEN a0 + {_S} * (SELECT g2 FROM gaps) END) AS c0
                FROM (SELECT *, order_purchase_timestamp AS p, coalesce(order_approved_at,
                          CASE WHEN order_status = 'delivered' THEN order_purchase_timestamp
                              + {_S} * (SELECT g1 FROM gaps) END) AS a0 FROM blanked)))"""


def _timed(select: str) -> str:
    """The select over ``refined_orders``; the purchase is always known here."""
    mark = "SELECT * FROM orders_typed, items_typed, products_filled, reviews_usable, payments_typed"
    text = sql(mark)
    head = text[: text.rindex(mark)].rstrip()
    timed = _TIMED.replace("greatest(p, a0) AS", "CASE WHEN a0 IS NOT NULL THEN greatest(p, a0) END AS")
    return (
        f"{head},\nblanked AS MATERIALIZED (SELECT * FROM orders_typed),\ngaps AS MATERIALIZED ({_GAPS}),\n"
        f"refined_orders AS MATERIALIZED ({timed})\n{select}"
    )


_STAGES = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in (*fixed.MILESTONES, fixed.ESTIMATE))


@query("refined_orders", "Q07 Q09 Q26 Q27 C03 C05", _timed(f"""
    SELECT order_id, customer_id, order_status, {_STAGES}, gap AS days_diff_estimated,
        CASE WHEN order_status = 'canceled' THEN 'Canceled' WHEN order_status = 'unavailable' THEN 'Unavailable'
             WHEN order_status IN ('shipped', 'processing', 'approved', 'created', 'invoiced') THEN 'In Progress'
             WHEN order_status = 'delivered' THEN CASE WHEN gap < 0 THEN 'Early' WHEN gap = 0 THEN 'On Time'
                 WHEN gap > 0 THEN 'Late' END ELSE 'Other' END AS delivery_status,
        CASE WHEN order_status = 'delivered' THEN abs(gap) END AS abs_days_diff
    FROM (SELECT *, {days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS gap FROM refined_orders)
    UNION ALL SELECT '-1', '-1', 'unknown', NULL, NULL, NULL, NULL, NULL, NULL, 'Other', NULL"""))
def _(r):
    return _table(r, "orders")


_DIM = ("product_length_cm", "product_height_cm", "product_width_cm")


@query("refined_products", "Q09 Q23 Q24 C08 C09", sql(f"""
    SELECT product_id, product_category_name, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in ('product_weight_g', *_DIM))},
        CAST(v AS DOUBLE) AS product_volume_cm3,
        CASE WHEN v <= 0 THEN 'Unknown Size' WHEN v <= 5000 THEN 'Small Box' WHEN v <= 20000 THEN 'Medium Box'
             ELSE 'Large Parcel' END AS logistics_size_category,
        CASE WHEN product_weight_g <= 0 THEN 'Unknown Weight' WHEN product_weight_g <= 2000 THEN 'Lightweight'
             WHEN product_weight_g <= 10000 THEN 'Midweight' ELSE 'Heavyweight' END AS logistics_weight_category
    FROM (SELECT *, CASE WHEN least({', '.join(_DIM)}) >= 0 THEN {' * '.join(_DIM)} ELSE -1 END AS v FROM (
        SELECT product_id, product_category_name, {', '.join(f'coalesce({c}, -1) AS {c}' for c in ('product_weight_g', *_DIM))}
        FROM products_filled))
    UNION ALL SELECT '-1', 'unknown_category', -1, -1, -1, -1, -1, 'Unknown Size', 'Unknown Weight'"""))
def _(r):
    return _table(r, "products")


@query("refined_items", "Q07 Q25 C06", _timed(f"""
    SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, product_id, seller_id,
        CAST(l AS VARCHAR) AS shipping_limit_date, CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE)
        AS freight_value, gap AS seller_handling_days,
        CASE WHEN order_status = 'canceled' THEN 'Canceled' WHEN order_status = 'unavailable' THEN 'Unavailable'
             WHEN order_status IN ('shipped', 'processing', 'approved', 'created') THEN 'In Progress'
             WHEN order_status = 'delivered' THEN CASE WHEN gap < 0 THEN 'Early' WHEN gap = 0 THEN 'On Time'
                 WHEN gap > 0 THEN 'Late Delivery to Carrier' ELSE 'Unfulfilled' END
             ELSE 'Unknown' END AS seller_performance
    FROM (SELECT *, {days('l', 'order_delivered_carrier_date')} AS gap FROM (
        SELECT CASE WHEN o.order_id IS NULL THEN '-1' ELSE i.order_id END AS order_id, order_item_id, product_id, seller_id,
            price, freight_value, order_delivered_carrier_date, coalesce(order_status, 'unknown') AS order_status,
            CASE WHEN shipping_limit_date IS NULL OR shipping_limit_date < order_purchase_timestamp
                      OR shipping_limit_date < order_approved_at
                 THEN CAST(CAST(coalesce(order_approved_at, order_purchase_timestamp) AS DATE) + CAST((
                     SELECT coalesce(quantile_disc({days('order_approved_at', 'shipping_limit_date')}, 0.5), 4)
                     FROM items_typed JOIN refined_orders USING (order_id)
                     WHERE shipping_limit_date >= order_approved_at) AS INTEGER) AS TIMESTAMP)
                 ELSE shipping_limit_date END AS l
        FROM items_typed i LEFT JOIN refined_orders o ON i.order_id = o.order_id))"""))
def _(r):
    return _table(r, "order_items")


@query("refined_payments", "Q07 C13", sql("""
    SELECT CASE WHEN order_id IN (SELECT order_id FROM orders_typed) THEN order_id ELSE '-1' END AS order_id,
        CAST(payment_sequential AS BIGINT) AS payment_sequential, payment_type,
        CAST(CASE WHEN payment_type = 'credit_card' AND payment_installments = 0 THEN 1 ELSE payment_installments END
             AS BIGINT) AS payment_installments, CAST(payment_value AS DOUBLE) AS payment_value
    FROM payments_typed"""))
def _(r):
    return _table(r, "order_payments")


@query("refined_reviews", "Q07 Q28 Q30 C15", sql(f"""
    SELECT review_id, order_id, CAST(review_score AS BIGINT) AS review_score,
        CAST(CASE WHEN w < c THEN w ELSE c END AS VARCHAR) AS review_creation_date,
        CAST(CASE WHEN w < c THEN c ELSE w END AS VARCHAR) AS review_answer_timestamp,
        CASE WHEN review_score >= 4 THEN 'Satisfied' WHEN review_score = 3 THEN 'Neutral' ELSE 'Unsatisfied' END
            AS review_label, abs({days('c', 'w')}) AS review_response_days
    FROM (SELECT *, coalesce(review_answer_timestamp, c + INTERVAL '1' SECOND * CAST(m2 AS BIGINT)) AS w
        FROM (SELECT *, coalesce(review_creation_date, order_purchase_timestamp + INTERVAL '1' SECOND * CAST(m1 AS BIGINT))
                  AS c
              FROM (SELECT review_id, CASE WHEN o.order_id IS NULL THEN '-1' ELSE r.order_id END AS order_id, review_score,
                        review_creation_date, review_answer_timestamp, order_purchase_timestamp
                    FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY review_answer_timestamp DESC NULLS LAST,
                              review_id, review_score, review_creation_date NULLS FIRST) AS rn FROM reviews_usable) r
                    LEFT JOIN orders_typed o ON r.order_id = o.order_id WHERE rn = 1),
              (SELECT quantile_disc({secs('order_purchase_timestamp', 'review_creation_date')}, 0.5) AS m1,
                      quantile_disc({secs('review_creation_date', 'review_answer_timestamp')}, 0.5) AS m2
               FROM reviews_latest WHERE review_creation_date IS NOT NULL AND review_answer_timestamp IS NOT NULL
               AND order_purchase_timestamp IS NOT NULL)))"""))
def _(r):
    return _table(r, "order_reviews")
