"""The driver's tables in the role of the marketplace's bronze tables.

Each role is a SELECT that both engines understand, so the fixture is the same for
the Spark operators and for the SQL statements they are compared with. Every role
reads its tables whole; its rows grow with them. The expressions plant the cases
the operators must handle: padding, mixed case and accents, missing and reversed
times, points outside the country, unknown keys, repeated keys.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from tamarind.functions.text import trimmed
from tamarind.plans import reports, silver, staging
from tamarind.session import scratch_path
from tamarind.sources.tables import Lake

# Entities that lie in a stored pass already: their rows only filter it.
STORED = ("items",)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

_STATES = "SP,RJ,MG,ES,PR,SC,RS,GO,MT,MS,DF,BA,PE,CE,PB,RN,AL,SE,PI,MA,AM,PA,AC,RO,RR,AP,TO"


def _state(index: str) -> str:
    return f"split_part('{_STATES}', ',', CAST({index} AS INT) + 1)"


def _order_id(rate: int) -> str:
    """Order of a line; every ``rate``-th part belongs to orders that nobody knows."""
    return f"CASE WHEN l_partkey % {rate} = 0 THEN concat('lost-', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END"


_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_CENT = "CAST(0.01 AS DECIMAL(3,2))"  # a factor, because division leaves decimals in one engine
_HALF = f"CAST({_PRICE} * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,2))"
_FREIGHT = f"CAST({_PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2))"

ROLES = {
    "raw_orders": """
        SELECT CAST(o_orderkey AS STRING) AS order_id,
               CAST(o_custkey AS STRING) AS customer_id,
               CASE WHEN o_orderstatus = 'F' THEN ' Delivered '
                    WHEN o_orderstatus = 'O' THEN
                        CASE o_orderpriority WHEN '1-URGENT' THEN 'shipped' WHEN '2-HIGH' THEN 'processing'
                             WHEN '3-MEDIUM' THEN 'approved' WHEN '4-NOT SPECIFIED' THEN 'Created' ELSE 'invoiced' END
                    WHEN o_orderpriority = '1-URGENT' THEN 'canceled'
                    WHEN o_orderpriority = '2-HIGH' THEN 'unavailable'
                    ELSE 'delivered' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_custkey % 7 = 0 AND o_orderpriority = '5-LOW' THEN NULL
                    ELSE o_orderdate + INTERVAL '1' HOUR * (o_custkey % 48) END AS order_approved_at,
               CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT' THEN NULL
                    WHEN o_custkey % 11 = 0 THEN NULL
                    ELSE o_orderdate + INTERVAL '1' DAY * (o_orderkey % 9) END AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'O' OR o_custkey % 13 = 0 THEN NULL
                    WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL
                    ELSE o_orderdate + INTERVAL '1' DAY * (o_orderkey % 9 + o_custkey % 17)
                    END AS order_delivered_customer_date,
               o_orderdate + INTERVAL '1' DAY * 14 AS order_estimated_delivery_date
        FROM {orders}""",
    "raw_items": f"""
        SELECT {_order_id(41)} AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
               CASE WHEN l_discount = 0.0 THEN NULL
                    ELSE o_orderdate + INTERVAL '1' DAY * (l_linenumber % 4 + l_suppkey % 16) END
                   AS shipping_limit_date,
               {_PRICE} AS price, {_FREIGHT} AS freight_value
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "raw_payments": f"""
        SELECT {_order_id(43)} AS order_id, l_linenumber AS payment_sequential,
               CASE WHEN l_returnflag = 'A' THEN ' Credit_Card ' WHEN l_returnflag = 'N' THEN 'boleto'
                    WHEN l_linestatus = 'O' THEN 'voucher' WHEN l_discount = 0.05 THEN 'not_defined'
                    ELSE 'debit_card' END AS payment_type,
               l_linenumber - 1 AS payment_installments,
               CASE WHEN l_discount > 0.08 THEN {_HALF} WHEN l_discount = 0.02 THEN {_PRICE} + {_PRICE}
                    WHEN l_discount = 0.01 THEN {_PRICE} + {_FREIGHT} + 10
                    ELSE {_PRICE} + {_FREIGHT} END AS payment_value
        FROM {{lineitem}}""",
    "raw_reviews": f"""
        SELECT CASE WHEN l_partkey % 53 = 0 THEN NULL
                    ELSE md5(concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
                                    CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING))) END AS review_id,
               {_order_id(47)} AS order_id,
               CASE WHEN l_tax = 0.08 THEN NULL ELSE CAST(1 + CAST(l_quantity AS INT) % 5 AS STRING) END AS review_score,
               l_returnflag AS review_comment_title, l_linestatus AS review_comment_message,
               CASE WHEN l_suppkey % 23 = 0 THEN NULL ELSE CAST(l_shipdate AS STRING) END AS review_creation_date,
               CASE WHEN l_suppkey % 19 = 0 THEN NULL
                    ELSE CAST(l_shipdate + INTERVAL '1' HOUR * (CAST(l_quantity AS INT) * 3 % 97 - 4) AS STRING)
                    END AS review_answer_timestamp
        FROM {{lineitem}}""",
    "raw_customers": f"""
        SELECT concat(' ', CAST(c_custkey AS STRING), ' ') AS customer_id,
               concat('u', CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 40
                                     WHEN c_custkey % 3 = 1 THEN c_custkey % 500 ELSE c_custkey END AS STRING))
                   AS customer_unique_id,
               CAST(10000 + c_nationkey * 10 + c_custkey % 12 AS STRING) AS customer_zip_code_prefix,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '  São Paulo' WHEN 'BUILDING' THEN 'BRASÍLIA '
                    WHEN 'FURNITURE' THEN 'Ribeirão Preto' WHEN 'HOUSEHOLD' THEN 'Goiânia' ELSE 'curitiba' END
                   AS customer_city,
               lower({_state('c_nationkey')}) AS customer_state
        FROM {{customer}}""",
    "raw_sellers": f"""
        SELECT CAST(s_suppkey AS STRING) AS seller_id,
               CAST(10000 + s_nationkey * 10 + s_suppkey % 14 AS STRING) AS seller_zip_code_prefix,
               CASE WHEN s_acctbal < 2500 THEN 'São Paulo ' WHEN s_acctbal < 5000 THEN ' MARÍLIA' ELSE 'Recife' END
                   AS seller_city,
               {_state('s_nationkey')} AS seller_state
        FROM {{supplier}}""",
    "raw_products": """
        SELECT CAST(p_partkey AS STRING) AS product_id,
               CASE p_type WHEN 'ECONOMY' THEN 'pc_gamer' WHEN 'SMALL' THEN ' Beleza_Saude'
                    WHEN 'MEDIUM' THEN 'portateis_cozinha_e_preparadores_de_alimentos'
                    WHEN 'LARGE' THEN 'Esporte_Lazer' WHEN 'PROMO' THEN 'sem_traducao' ELSE NULL END
                   AS product_category_name,
               CASE WHEN p_size % 9 = 0 THEN NULL ELSE length(p_name) END AS product_name_lenght,
               CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size * 10 END AS product_description_lenght,
               nullif(p_size % 7, 0) AS product_photos_qty,
               CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size * 300 END AS product_weight_g,
               CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_size + 5 END AS product_length_cm,
               p_size % 20 + 2 AS product_height_cm, p_size % 30 + 3 AS product_width_cm
        FROM {part}""",
    "raw_translation": """
        SELECT DISTINCT CASE p_type WHEN 'SMALL' THEN 'beleza_saude ' ELSE 'esporte_lazer' END AS product_category_name,
               CASE p_type WHEN 'SMALL' THEN 'Health_Beauty' ELSE 'sports_leisure' END AS product_category_name_english
        FROM {part} WHERE p_type IN ('SMALL', 'LARGE')""",
    "raw_geo": f"""
        SELECT CAST(10000 + c_nationkey * 10 + c_custkey % 12 AS STRING) AS geolocation_zip_code_prefix,
               CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_acctbal / 250.0 - 35 END AS geolocation_lat,
               CAST(-27 - c_custkey % 50 AS DOUBLE) AS geolocation_lng,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '  São Paulo' WHEN 'BUILDING' THEN 'SAO PAULO '
                    WHEN 'FURNITURE' THEN 'sao paulo' WHEN 'HOUSEHOLD' THEN 'Goiânia' ELSE 'goiania' END
                   AS geolocation_city,
               {_state('c_nationkey')} AS geolocation_state
        FROM {{customer}}
        UNION ALL
        SELECT CAST(10000 + s_nationkey * 10 + s_suppkey % 12 AS STRING), s_acctbal / 250.0 - 35,
               CAST(-27 - s_suppkey % 50 AS DOUBLE), 'Marília', {_state('s_nationkey')}
        FROM {{supplier}}""",
    "raw_leads": """
        SELECT CASE WHEN user_id % 37 = 0 THEN NULL WHEN event_id % 19 = 0 THEN concat('x', CAST(event_id AS STRING))
                    ELSE concat('m', CAST(user_id AS STRING)) END AS mql_id,
               CAST(date_trunc('second', ts) AS STRING) AS first_contact_date,
               concat('LP', CAST(event_id % 5 AS STRING)) AS landing_page_id,
               CASE event_id % 4 WHEN 0 THEN ' Organic_Search' WHEN 1 THEN 'paid_search' WHEN 2 THEN 'Social' END
                   AS origin
        FROM {events} WHERE event_type = 'signup'""",
    "raw_deals": """
        SELECT concat('m', CAST(user_id AS STRING)) AS mql_id,
               CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 120 AS STRING) END AS seller_id,
               CAST(event_id % 7 AS STRING) AS sdr_id, CAST(event_id % 11 AS STRING) AS sr_id,
               CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(date_trunc('second', ts) AS STRING) END AS won_date,
               CASE WHEN value < 10 THEN ' Pet' WHEN value < 30 THEN 'AUDIO' ELSE 'home_decor' END AS business_segment,
               CASE event_id % 3 WHEN 0 THEN 'Online_Big' WHEN 1 THEN 'industry' ELSE 'offline' END AS lead_type,
               CASE event_id % 2 WHEN 0 THEN 'Cat' ELSE 'eagle' END AS lead_behaviour_profile,
               CASE event_id % 2 WHEN 0 THEN 'Reseller' ELSE 'manufacturer' END AS business_type,
               CAST(value AS DECIMAL(18,2)) * 100 AS declared_monthly_revenue
        FROM {events} WHERE event_type = 'purchase'""",
    # one event per order item, already flat; streams.py nests it into JSON first
    "flat_events": f"""
        SELECT CAST(l_shipdate + INTERVAL '1' MINUTE * (l_partkey % 1440) AS STRING) AS event_timestamp,
               CAST(l_orderkey AS STRING) AS order_id,
               CASE WHEN l_linestatus = 'O' THEN 'shipped' WHEN l_returnflag = 'R' THEN 'canceled' ELSE 'delivered' END
                   AS order_status,
               CAST(l_shipdate AS STRING) AS order_purchase_timestamp,
               CAST(l_quantity AS INT) AS delivery_days,
               {_state('l_orderkey % 27')} AS customer_state,
               concat('city ', CAST(l_orderkey % 100 AS STRING)) AS customer_city,
               {_state('l_suppkey % 21')} AS seller_state,
               concat('town ', CAST(l_suppkey % 40 AS STRING)) AS seller_city,
               concat('categoria ', CAST(l_partkey % 20 AS STRING)) AS product_category_name,
               CASE WHEN l_partkey % 20 = 7 THEN NULL ELSE concat('category ', CAST(l_partkey % 20 AS STRING)) END
                   AS product_category_name_english,
               l_linenumber AS product_photos_qty,
               CAST(l_quantity AS INT) * 100 AS product_weight_g,
               CAST(l_partkey % 300 AS INT) AS product_description_length,
               CAST(CAST({_PRICE} * {_CENT} AS DECIMAL(18,2)) AS DOUBLE) AS price,
               CAST(CAST({_FREIGHT} * {_CENT} AS DECIMAL(18,2)) AS DOUBLE) AS freight_value,
               CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
               CASE WHEN l_discount = 0.1 THEN CAST(0 AS DOUBLE)
                    ELSE CAST(CAST(({_PRICE} + {_FREIGHT}) * {_CENT} AS DECIMAL(18,2)) AS DOUBLE) END AS payment_value,
               l_linenumber AS payment_installments,
               CAST(1 + l_quantity AS INT) % 5 + 1 AS review_score,
               l_discount > 0.05 AS review_has_comment
        FROM {{lineitem}}""",
}


def role_sql(name: str) -> str:
    """A role as SQL over the registered table names."""
    return ROLES[name].format(**{t: t for t in TABLES})


class Roles:
    """Tables and roles of one scale-factor folder, plus the entities built from them.

    Entities are lazy. A query that reads the same entity along several paths keeps
    it first: the entity is written once to the shared scratch folder, and all paths
    start from that table instead of repeating its plan.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._kept: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def role(self, name: str) -> DataFrame:
        text = ROLES[name]
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    @cached_property
    def scratch(self) -> Lake:
        return Lake(self.spark, scratch_path(self.spark, "scratch"))

    def use(self, name: str) -> DataFrame:
        """Rows of an entity, from its table when it was kept."""
        if name in self._kept:
            return self._kept[name]
        built = getattr(self, name)
        return built.rows if isinstance(built, silver.Entity) else built

    def keep(self, *names: str) -> None:
        for name in names:
            if name not in self._kept:
                self._kept[name] = self.use(name) if name in STORED else self.scratch.write(self.use(name), name)

    def _by_order(self, name: str, df: DataFrame) -> DataFrame:
        return self.scratch.write_bucketed(df, name, ["order_id"])

    def keep_by_order(self, *names: str) -> None:
        """Keep entities of at most a few rows per order in buckets of the order, so that
        they join and aggregate on it without a shuffle."""
        for name in names:
            if name not in self._kept:
                self._kept[name] = self._by_order(name, self.use(name))

    @cached_property
    def geolocation(self) -> silver.Entity:
        return silver.geolocation(self.role("raw_geo"))

    @cached_property
    def customers(self) -> silver.Entity:
        return silver.customers(self.role("raw_customers"), self.use("geolocation"))

    @cached_property
    def orders(self) -> silver.Entity:
        # the customers only decide which orders are flagged, and only by their ids
        known = self.role("raw_customers").select(trimmed("customer_id").alias("customer_id"))
        return silver.orders(self.role("raw_orders"), known)

    @cached_property
    def products(self) -> silver.Entity:
        return silver.products(self.role("raw_products"), self.role("raw_translation"))

    @cached_property
    def items(self) -> silver.Entity:
        # judged in buckets of the order, which is where they have met it
        return silver.order_items(self.role("raw_items"), self.use("orders"), partial(self._by_order, "judged_items"))

    @cached_property
    def item_values(self) -> DataFrame:
        """Items with their keys and values only. These need no learned limit date, so that
        nothing has to be stored for them."""
        if "items" in vars(self):
            built = self.use("items")
        else:
            built = silver.order_items(self.role("raw_items"), self.use("orders"), silver.lazily).rows
        return built.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")

    @cached_property
    def payments(self) -> silver.Entity:
        return silver.payments(self.role("raw_payments"), self.use("orders"))

    @cached_property
    def reviews(self) -> silver.Entity:
        kept_newest = partial(self._by_order, "newest_reviews")
        return silver.reviews(self.role("raw_reviews"), self.use("orders"), silver.lazily, kept_newest)

    @property
    def review_rejects(self) -> DataFrame:
        return silver.reviews(self.role("raw_reviews"), self.use("orders"), silver.lazily).rejects

    @cached_property
    def leads(self) -> silver.Entity:
        return silver.qualified_leads(self.role("raw_leads"))

    @cached_property
    def deals(self) -> silver.Entity:
        return silver.closed_deals(self.role("raw_deals"))

    @cached_property
    def acquisition(self) -> DataFrame:
        return staging.seller_acquisition(self.use("leads"), self.use("deals"))

    @cached_property
    def sellers(self) -> silver.Entity:
        return silver.sellers(
            self.role("raw_sellers"), self.use("geolocation"), self.use("items"), self.use("acquisition")
        )

    @cached_property
    def pairs(self) -> DataFrame:
        return staging.order_sellers(self.use("item_values"))

    @cached_property
    def totals(self) -> DataFrame:
        return staging.order_totals(self.use("pairs"))

    @cached_property
    def order_payments(self) -> DataFrame:
        return staging.order_payments(self.use("payments"))

    @cached_property
    def paid_pairs(self) -> DataFrame:
        self.keep_by_order("orders")
        self.keep("items")
        self.keep_by_order("order_payments")
        return staging.paid_pairs(self.use("orders"), self.use("order_payments"), self.use("totals"), self.use("pairs"))

    @cached_property
    def sales(self) -> DataFrame:
        self.keep("products")
        return self.sales_with(None)

    def sales_with(self, found: DataFrame | None) -> DataFrame:
        """Sales with what has been looked up for the items, if anything has."""
        self.keep_by_order("orders")
        self.keep("items")
        self.keep_by_order("order_payments")
        return staging.sales(
            self.use("items"),
            self.use("orders"),
            self.use("order_payments"),
            self.use("totals"),
            self.use("products"),
            self.use("pairs"),
            found,
        )

    @cached_property
    def delivery(self) -> DataFrame:
        self.keep_by_order("orders")
        self.keep("items")
        return staging.delivery(self.use("orders"), self.use("totals"), self.use("customers"), self.use("sellers"))

    @cached_property
    def judged(self) -> DataFrame:
        self.keep_by_order("orders")
        self.keep("items")
        return staging.reviews(self.use("reviews"), self.use("delivery"))

    @cached_property
    def fulfilled(self) -> DataFrame:
        self.keep("products")
        return self.fulfilled_with(None)

    def fulfilled_with(self, found: DataFrame | None) -> DataFrame:
        """Fulfillment with what has been looked up for the items, if anything has."""
        self.keep_by_order("orders")
        self.keep("items")
        return staging.fulfillment(
            self.use("items"), self.use("orders"), self.use("products"), self.use("sellers"), self.use("pairs"), found
        )

    @cached_property
    def monthly(self) -> DataFrame:
        self.keep_by_order("orders")
        self.keep("items", "sellers", "delivery", "judged", "fulfilled")
        return staging.seller_monthly(self.use("delivery"), self.use("judged"), self.use("fulfilled"))

    @cached_property
    def costed(self) -> DataFrame:
        return staging.orders_with_costs(self.use("orders"), self.use("item_values"), self.use("pairs"))

    @cached_property
    def recon(self) -> DataFrame:
        return reports.reconcile(self.use("payments"), self.use("costed"))

    @cached_property
    def timeline(self) -> DataFrame:
        return reports.with_order_timeline(self.use("reviews"), self.use("orders"))

    @cached_property
    def matrix(self) -> DataFrame:
        return silver.seller_matrix(self.use("items"))
