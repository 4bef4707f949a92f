"""Dimensions, facts, marts, constraints."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tamarind.catalog.base import cols, query
from tamarind.catalog.oracle import CTES, pct, rnd, sql
from tamarind.operators.joins import attach
from tamarind.operators.quality import count_sheet, missing_counts, null_key_counts, summarise
from tamarind.operators.ranged import dense_key
from tamarind.plans import gold, marts, staging
from tamarind.session import by_buckets


# Dimensions that facts look up by a natural key: stored, so that Spark knows their size.
_LOOKED_UP = (
    "dim_customer", "dim_seller", "dim_product", "dim_delivery_status", "dim_review_sentiment", "dim_payment_type",
)


class Star:
    """The star schema over one set of roles; every member is built once."""

    def __init__(self, r):
        self.r = r
        self._built: dict[str, object] = {}

    def __getitem__(self, name: str):
        if name not in self._built:
            built = getattr(self, "_" + name)()
            self._built[name] = self.r.scratch.write(built, name) if name in _LOOKED_UP else built
        return self._built[name]

    def keep_by_order(self, *names: str) -> None:
        """Store members of a few rows per order that several facts use."""
        for name in names:
            self._built[name] = self.r.scratch.write_bucketed(self[name], name, ["order_id"])

    def rows(self, fact: str):
        """A fact without its own surrogate key, for what only adds up its rows."""
        return getattr(self, "_" + fact)(numbered=False)

    def _item_keys(self):
        """What facts of items want of products and sellers, per item."""
        products = self["dim_product"].select("product_id", "product_volume_cm3", F.col("product_sk").alias("product_sk_fk"))
        sellers = self["dim_seller"].select("seller_id", "acquisition_source", F.col("seller_sk").alias("seller_sk_fk"))
        return staging.item_lookups(self.r.use("items"), ("product_id", products), ("seller_id", sellers))

    def _order_keys(self):
        """The customer key per order: there are fewer orders than items."""
        customers = self["dim_customer"].select("customer_id", F.col("customer_sk").alias("customer_sk_fk"))
        placed = self.r.use("orders").select("order_id", "customer_id").where("order_id IS NOT NULL")
        return by_buckets(attach(placed, customers, "customer_id").drop("customer_id"), ["order_id"])

    def _dim_customer(self):
        self.r.keep("customers")
        return gold.customer_dimension(self.r.use("customers"))

    def _dim_seller(self):
        self.r.keep_by_order("orders")
        self.r.keep("items", "sellers")
        return gold.seller_dimension(self.r.use("sellers"), date(2024, 1, 1))

    def _dim_product(self):
        self.r.keep("products")
        return gold.product_dimension(self.r.use("products"))

    def _dim_geolocation(self):
        self.r.keep("geolocation")
        return gold.geolocation_dimension(self.r.use("geolocation"))

    def _dim_date(self):
        r = self.r
        return gold.date_dimension(
            gold.calendar_bounds(
                (r.use("orders"), "order_purchase_timestamp"),
                (r.use("orders"), "order_estimated_delivery_date"),
                (r.use("orders"), "order_delivered_customer_date"),
                (r.use("reviews"), "review_creation_date"),
                (r.use("reviews"), "review_answer_timestamp"),
            )
        )

    def _dim_delivery_status(self):
        return gold.delivery_status_dimension(self.r.use("delivery"))

    def _dim_review_sentiment(self):
        return gold.sentiment_dimension(self.r.use("judged"))

    def _dim_payment_type(self):
        return gold.payment_type_dimension(self.r.use("paid_pairs"))

    def _fct_order_sales(self, numbered=True):
        self.r.keep_by_order("orders")
        self.r.keep("items")
        sales = attach(self.r.sales_with(self["item_keys"].drop("acquisition_source")), self["order_keys"], "order_id")
        return gold.order_sales_fact(
            sales, self["dim_product"], self["dim_seller"], self["dim_customer"], self["dim_payment_type"], numbered,
            self.r.use("items"),
        )

    def _fct_order_delivery(self, numbered=True):
        self.r.keep_by_order("orders")
        self.r.keep("items", "sellers", *["delivery"][:numbered])
        return gold.order_delivery_fact(
            self.r.use("delivery"), self["dim_customer"], self["dim_seller"], self["dim_delivery_status"], numbered
        )

    def _fct_customer_reviews(self, numbered=True):
        self.r.keep_by_order("orders")
        self.r.keep("items", "sellers", *["judged"][:numbered])
        return gold.customer_reviews_fact(self.r.use("judged"), self["dim_seller"], self["dim_review_sentiment"], numbered)

    def _fct_seller_fulfillment(self, numbered=True):
        self.r.keep_by_order("orders")
        self.r.keep("items", "sellers")
        return gold.seller_fulfillment_fact(
            self.r.fulfilled_with(self["item_keys"]), self["dim_seller"], self["dim_product"], numbered, self.r.use("items")
        )


@query("dense_surrogate_key", "D01 W10", sql("""
    SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)
               AS line_sk, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity,
           round(l_extendedprice, 6) AS l_extendedprice
    FROM lineitem"""))
def _(r):
    lines = r.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return dense_key(lines, ["l_orderkey", "l_linenumber"], "line_sk")


_CALENDAR = """SELECT {key} AS date_sk, strftime(d, '%Y-%m-%d') AS full_date, CAST(year(d) AS BIGINT) AS year,
    CAST(quarter(d) AS BIGINT) AS quarter, CAST(month(d) AS BIGINT) AS month, strftime(d, '%m') AS month_key,
    strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month,
    CAST(strftime(d, '%U') AS BIGINT) AS week_of_year, CAST(day(d) AS BIGINT) AS day,
    CAST(dayofyear(d) AS BIGINT) AS day_of_year, strftime(d, '%A') AS day_name,
    CASE WHEN isodow(d) >= 6 THEN 'Weekend' ELSE 'Business Day' END AS day_type, isodow(d) >= 6 AS is_weekend,
    isodow(d) < 6 AS is_business_day, day(d) = 1 AS is_month_start, d = last_day(d) AS is_month_end,
    day(d) = 1 AND month(d) IN (1, 4, 7, 10) AS is_quarter_start,
    d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS is_quarter_end,
    day(d) = 1 AND month(d) = 1 AS is_year_start, day(d) = 31 AND month(d) = 12 AS is_year_end
    FROM {days}""".replace("{key}", "CAST(strftime(d, '%Y%m%d') AS BIGINT)")


@query("dim_date_sales", "D02 F33 J02", sql(f"""
    SELECT c.*, coalesce(n, 0) AS order_count FROM ({_CALENDAR.replace('{days}', '''(
        SELECT CAST(unnest(generate_series(date_trunc('year', min(o_orderdate)),
            date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
        FROM orders)''')}) c
    LEFT JOIN (SELECT strftime(o_orderdate, '%Y%m%d') AS k, count(*) AS n FROM orders GROUP BY 1) o
        ON CAST(c.date_sk AS VARCHAR) = o.k"""))
def _(r):
    orders = r.table("orders").groupBy(gold.date_key("o_orderdate").alias("k")).agg(F.count("*").alias("order_count"))
    calendar = gold.date_dimension(gold.calendar_bounds((r.table("orders"), "o_orderdate")))
    return calendar.join(orders, F.col("date_sk") == F.col("k"), "left").drop("k").fillna(0, ["order_count"])


@query("calendar_fields", "F14 F33", sql(_CALENDAR.replace(
    "{days}", "(SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)")))
def _(r):
    from tamarind.functions.temporal import calendar_attributes

    days = r.table("lineitem").select(F.to_date("l_shipdate").alias("full_date")).distinct()
    return days.select(*[c.alias(n) for n, c in calendar_attributes().items()])


@query("dim_geolocation", "D03", sql(f"""SELECT row_number() OVER (ORDER BY zip_code_prefix, city, state)
    AS geolocation_sk, {cols('zip_code_prefix:i, city, state, region, median_latitude:d, median_longitude:d')}
    FROM silver_geo"""))
def _(r):
    return Star(r)["dim_geolocation"]


@query("dim_customer", "D04 C29", sql(f"""SELECT {cols('''customer_sk, customer_id, customer_unique_id,
    customer_zip_code_prefix:i, customer_city, customer_state, customer_region, customer_location_type,
    median_latitude:d, median_longitude:d''')} FROM dim_customer"""))
def _(r):
    return Star(r)["dim_customer"]


@query("dim_seller", "D05 C29 C41", sql(f"""SELECT {cols('''seller_sk, seller_id, seller_zip_code_prefix:i, seller_city,
    seller_state, seller_region, median_latitude:d, median_longitude:d, marketing_origin, acquisition_source,
    business_segment, lead_type, lead_behaviour_profile, days_to_convert:i, converted_flag,
    seller_acquisition_segment, seller_location_type''')}, '2024-01-01' AS effective_start_date,
    CAST(NULL AS VARCHAR) AS effective_end_date, true AS is_current FROM dim_seller"""))
def _(r):
    return Star(r)["dim_seller"]


@query("dim_product", "D06", sql(f"""SELECT {cols('''product_sk, product_id, product_category_name,
    product_category_name_english, product_name_lenght:i, product_description_lenght:i, product_photos_qty:i,
    product_weight_g:d, product_length_cm:d, product_height_cm:d, product_width_cm:d, product_volume_cm3:d,
    product_size_category, heavy_product_flag, logistics_completeness_flag, catalog_completeness_flag''')}
    FROM dim_product"""))
def _(r):
    return Star(r)["dim_product"]


@query("junk_dimension", "D07 C30 U04", sql("SELECT * FROM dim_delivery_status"))
def _(r):
    return Star(r)["dim_delivery_status"]


@query("dim_review_sentiment", "D08 C17", sql("SELECT * FROM dim_review_sentiment"))
def _(r):
    return Star(r)["dim_review_sentiment"]


@query("dim_payment_type", "D09", sql("SELECT * FROM dim_payment_type"))
def _(r):
    return Star(r)["dim_payment_type"]


@query("fact_sales", "D10 D14 F15 C32 J13", sql(f"""SELECT {cols('''sales_fact_sk, order_id, order_item_id:i,
    product_sk_fk, seller_sk_fk, customer_sk_fk, payment_type_sk_fk, sales_date_sk, price:d, freight_value:d,
    gross_item_value:d, total_order_item_value:d, allocated_payment_value:d, item_sales_ratio:d, freight_ratio:d,
    product_volume_cm3:d, seller_item_count_in_order:i, total_payment_installments:i, installment_flag,
    high_ticket_order_flag, high_freight_item_flag''')} FROM fct_order_sales"""))
def _(r):
    return Star(r)["fct_order_sales"]


@query("fact_delivery", "D11 D14 F15 C33", sql(f"""SELECT {cols('''delivery_fact_sk, order_id, customer_sk_fk,
    seller_sk_fk, delivery_status_sk_fk, purchase_date_sk, estimated_delivery_date_sk, actual_delivery_date_sk,
    order_status, order_purchase_timestamp:t, order_approved_at:t, order_delivered_carrier_date:t,
    order_delivered_customer_date:t, order_estimated_delivery_date:t, delivery_duration_days:i, delay_days:i,
    buffer_days:i, freight_total_value:d, total_items_count:i, seller_count:i, is_multi_seller_order,
    distance_bucket, seller_region, customer_region, on_time_delivery_flag, late_delivery_flag''')}
    FROM fct_order_delivery"""))
def _(r):
    return Star(r)["fct_order_delivery"]


@query("fact_reviews", "D12 C33", sql(f"""SELECT {cols('''review_fact_sk, review_id, order_id, seller_sk_fk,
    review_sentiment_sk_fk, review_date_sk, response_date_sk, review_score:i, review_response_days:i,
    delivery_duration_days:i, delay_days:i, negative_review_flag, neutral_review_flag, positive_review_flag,
    delayed_delivery_review_flag, low_rating_flag, excellent_rating_flag, is_multi_seller_order, sentiment_category,
    delivery_experience_segment, delivery_status_category, distance_bucket''')} FROM fct_customer_reviews"""))
def _(r):
    return Star(r)["fct_customer_reviews"]


@query("fact_fulfillment", "D13 C25 C32", sql(f"""SELECT {cols('''fulfillment_fact_sk, order_id, order_item_id:i,
    seller_sk_fk, product_sk_fk, purchase_date_sk, price:d, freight_value:d, freight_ratio:d, product_volume_cm3:d,
    seller_item_count_in_order:i, seller_monthly_orders:i, workload_bucket, is_overloaded_seller, high_workload_flag,
    high_freight_item_flag, acquisition_source''')} FROM fct_seller_fulfillment"""))
def _(r):
    return Star(r)["fct_seller_fulfillment"]


@query("geo_heatmap", "M05 A13 A14", sql(f"""
    SELECT customer_state, customer_region, count(DISTINCT order_id) AS total_orders,
           CAST(sum(v) AS DOUBLE) AS total_revenue, count(DISTINCT customer_sk_fk) AS total_customers,
           {rnd('avg(CAST(v AS DOUBLE))')} AS avg_order_value,
           CAST(sum(CASE WHEN on_time_delivery_flag THEN 1 ELSE 0 END) AS BIGINT) AS on_time_orders,
           CAST(sum(CASE WHEN late_delivery_flag THEN 1 ELSE 0 END) AS BIGINT) AS delayed_orders,
           {rnd('avg(delivery_duration_days)')} AS avg_lead_time_days,
           {pct('sum(CASE WHEN on_time_delivery_flag THEN 1 ELSE 0 END)', 'count(DISTINCT order_id)')}
               AS on_time_rate_pct
    FROM (SELECT f.* EXCLUDE (customer_region), c.customer_state, c.customer_region,
                 coalesce(t.total_order_item_value, 0) AS v
          FROM fct_order_delivery f JOIN dim_customer c ON f.customer_sk_fk = c.customer_sk
          LEFT JOIN order_totals t ON f.order_id = t.order_id)
    GROUP BY customer_state, customer_region"""))
def _(r):
    s = Star(r)
    return marts.geo_heatmap(s.rows("fct_order_delivery"), s["dim_customer"], r.use("totals"))


@query("sentiment_mart", "M06 U08 J11", sql(f"""
    SELECT product_category_name, customer_region, count(DISTINCT review_id) AS total_reviews,
           {rnd('avg(review_score)')} AS avg_score,
           CAST(sum(CASE WHEN review_score >= 4 THEN 1 ELSE 0 END) AS BIGINT) AS positive_count,
           CAST(sum(CASE WHEN review_score = 3 THEN 1 ELSE 0 END) AS BIGINT) AS neutral_count,
           CAST(sum(CASE WHEN review_score <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS negative_count,
           {rnd('avg(review_response_days)')} AS avg_response_delay_days,
           {pct('sum(CASE WHEN review_score >= 4 THEN 1 ELSE 0 END)', 'count(DISTINCT review_id)')} AS pct_positive,
           {pct('sum(CASE WHEN review_score <= 2 THEN 1 ELSE 0 END)', 'count(DISTINCT review_id)')} AS pct_negative
    FROM (SELECT DISTINCT r.review_id, r.order_id, r.review_score, r.review_response_days, c.customer_region,
                 p.product_category_name
          FROM fct_customer_reviews r JOIN fct_order_delivery d ON r.order_id = d.order_id
          JOIN dim_customer c ON d.customer_sk_fk = c.customer_sk
          JOIN fct_seller_fulfillment f ON r.order_id = f.order_id
          JOIN dim_product p ON f.product_sk_fk = p.product_sk)
    GROUP BY product_category_name, customer_region"""))
def _(r):
    s = Star(r)
    return marts.review_sentiment(
        s.rows("fct_customer_reviews"), s.rows("fct_order_delivery"), s["dim_customer"], s.rows("fct_seller_fulfillment"),
        s["dim_product"],
    )


@query("fk_missing_counts", "Q16 Q17", sql("""
    SELECT CAST(sum(CASE WHEN e.seller_sk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_sellers,
           CAST(sum(CASE WHEN p.product_sk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_products,
           CAST(sum(CASE WHEN d.k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_purchase_dates
    FROM fct_seller_fulfillment f LEFT JOIN dim_seller e ON f.seller_sk_fk = e.seller_sk AND e.seller_sk % 10 <> 3
    LEFT JOIN dim_product p ON f.product_sk_fk = p.product_sk AND p.product_sk % 7 <> 2
    LEFT JOIN (SELECT DISTINCT purchase_date_sk AS k FROM fct_seller_fulfillment) d
        ON f.purchase_date_sk = d.k AND d.k % 100 <> 15"""))
def _(r):
    # members that are left out of the dimensions must show as missing
    s = Star(r)
    sellers, products = s["dim_seller"].where("seller_sk % 10 <> 3"), s["dim_product"].where("product_sk % 7 <> 2")
    return missing_counts(
        s.rows("fct_seller_fulfillment"),
        {
            "missing_sellers": ("seller_sk_fk", sellers, "seller_sk"),
            "missing_products": ("product_sk_fk", products, "product_sk"),
            "missing_purchase_dates": ("purchase_date_sk", s["dim_date"].where("date_sk % 100 <> 15"), "date_sk"),
        },
    )


@query("null_key_counts", "Q18 F24", sql("""
    SELECT CAST(sum(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_order_ids,
           CAST(sum(CASE WHEN customer_sk_fk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_customer_fk,
           CAST(sum(CASE WHEN seller_sk_fk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_seller_fk,
           CAST(sum(CASE WHEN actual_delivery_date_sk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_delivery_date_fk
    FROM fct_order_delivery"""))
def _(r):
    return null_key_counts(
        Star(r).rows("fct_order_delivery"),
        {
            "null_order_ids": "order_id",
            "null_customer_fk": "customer_sk_fk",
            "null_seller_fk": "seller_sk_fk",
            "null_delivery_date_fk": "actual_delivery_date_sk",
        },
    )


_CHECKED = ("dim_customer", "dim_seller", "dim_product", "dim_payment_type", "fct_order_sales")


def _constraint_sql() -> str:
    from tamarind.plans.marts import FOREIGN_KEYS, PRIMARY_KEYS

    parts = [
        f"""SELECT 'pk_{t}' AS dq_rule, (SELECT count(*) FROM (
            SELECT {k} FROM (SELECT {k} FROM {t} WHERE {k} % 10 <> 3 UNION ALL SELECT {k} FROM {t} WHERE {k} % 10 = 4)
            GROUP BY {k} HAVING count(*) > 1 OR {k} IS NULL)) AS issue_count"""
        for t, k in PRIMARY_KEYS.items()
        if t in _CHECKED
    ]
    for col, dim in FOREIGN_KEYS["fct_order_sales"].items():
        if dim == "dim_date":
            member = f"SELECT 1 WHERE f.{col} % 10 <> 3"
        else:
            member = f"SELECT 1 FROM {dim} d WHERE d.{PRIMARY_KEYS[dim]} = f.{col} AND f.{col} % 10 <> 3"
        fact = f"{PRIMARY_KEYS['fct_order_sales']} % 10"
        parts.append(
            f"""SELECT 'fk_fct_order_sales_{col}' AS dq_rule, (
            SELECT CAST(coalesce(sum(CASE WHEN {fact} = 4 THEN 2 ELSE 1 END), 0) AS BIGINT) FROM fct_order_sales f
            WHERE {fact} <> 3 AND f.{col} IS NOT NULL AND NOT EXISTS ({member})) AS issue_count"""
        )
    return sql(" UNION ALL ".join(parts))


def _damaged(df, key: str):
    """A tenth of the keys is left out and another tenth is repeated, in one pass."""
    digit = F.col(key) % 10
    copies = F.sequence(F.lit(1), F.when(digit == 4, 2).otherwise(1))
    return df.where(digit != 3).withColumn("copy", F.explode(copies)).drop("copy")


@query("pk_fk_check", "D15 D16 M01", _constraint_sql())
def _(r):
    s = Star(r)
    tables = {t: _damaged(s[t], marts.PRIMARY_KEYS[t]) for t in (*_CHECKED, "dim_date")}
    return summarise(marts.gold_constraints(_CHECKED), tables)


@query("mart_counts", "M03 M04 M07 Q19 U03", sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in CTES if t.startswith("fct_"))))
def _(r):
    s = Star(r)
    r.keep_by_order("orders")
    s.keep_by_order("item_keys")
    return count_sheet({fact: s.rows(fact) for fact in dict.fromkeys(m.fact for m in marts.MARTS)})
