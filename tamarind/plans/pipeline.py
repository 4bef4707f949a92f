"""The daily run: bronze, silver, staging, gold, marts, quality checks.

Every table is written before the next stage reads it. A stage therefore starts
from files, recovers from lost executors without repeating earlier stages, and no
plan grows beyond one table's worth of work.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.operators.quality import (
    ForeignKey,
    NotNull,
    Rule,
    check_rules,
    issue_table,
    missing_of,
    outcome_table,
)
from tamarind.plans import gold, marts, silver, staging
from tamarind.sources.audit import log_rejects
from tamarind.sources.tables import Lake, Landed, ingest_typed

# The bronze tables and their file names.
BRONZE_FILES = {
    "orders": "orders.csv",
    "order_items": "order_items.csv",
    "order_payments": "order_payments.csv",
    "order_reviews": "order_reviews.csv",
    "customers": "customers.csv",
    "sellers": "sellers.csv",
    "products": "products.csv",
    "geolocation": "geolocation.csv",
    "category_translation": "category_translation.csv",
    "marketing_qualified_leads": "marketing_qualified_leads.csv",
    "closed_deals": "closed_deals.csv",
}

# Columns of the bronze files. Identifiers, labels and times of mixed format
# stay text; the entities clean them.
BRONZE_SCHEMAS = {
    "orders": """order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp STRING,
        order_approved_at STRING, order_delivered_carrier_date STRING, order_delivered_customer_date STRING,
        order_estimated_delivery_date STRING""",
    "order_items": """order_id STRING, order_item_id INT, product_id STRING, seller_id STRING,
        shipping_limit_date STRING, price DECIMAL(18,2), freight_value DECIMAL(18,2)""",
    "order_payments": """order_id STRING, payment_sequential INT, payment_type STRING, payment_installments INT,
        payment_value DECIMAL(18,2)""",
    "order_reviews": """review_id STRING, order_id STRING, review_score STRING, review_comment_title STRING,
        review_comment_message STRING, review_creation_date STRING, review_answer_timestamp STRING""",
    "customers": """customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix STRING,
        customer_city STRING, customer_state STRING""",
    "sellers": "seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING, seller_state STRING",
    "products": """product_id STRING, product_category_name STRING, product_name_lenght INT,
        product_description_lenght INT, product_photos_qty INT, product_weight_g INT, product_length_cm INT,
        product_height_cm INT, product_width_cm INT""",
    "geolocation": """geolocation_zip_code_prefix STRING, geolocation_lat DOUBLE, geolocation_lng DOUBLE,
        geolocation_city STRING, geolocation_state STRING""",
    "category_translation": "product_category_name STRING, product_category_name_english STRING",
    "marketing_qualified_leads": "mql_id STRING, first_contact_date STRING, landing_page_id STRING, origin STRING",
    "closed_deals": """mql_id STRING, seller_id STRING, sdr_id STRING, sr_id STRING, won_date STRING,
        business_segment STRING, lead_type STRING, lead_behaviour_profile STRING, business_type STRING,
        declared_monthly_revenue STRING""",
}

# Bronze tables whose fields may hold line breaks.
MULTI_LINE = ("order_reviews",)

# The standing quality rules.
RULES: tuple[Rule, ...] = (
    NotNull("customers_null_customer_id", "silver_customers", ("customer_id",)),
    NotNull("sellers_null_seller_id", "silver_sellers", ("seller_id",)),
    NotNull("products_null_product_id", "silver_products", ("product_id",)),
    NotNull("orders_null_keys", "silver_orders", ("order_id", "customer_id")),
    ForeignKey("order_items_orphan_order_id", "silver_order_items", "order_id", "silver_orders", "order_id"),
    ForeignKey("order_items_orphan_product_id", "silver_order_items", "product_id", "silver_products", "product_id"),
    ForeignKey("order_items_orphan_seller_id", "silver_order_items", "seller_id", "silver_sellers", "seller_id"),
    ForeignKey("payments_orphan_order_id", "silver_payments", "order_id", "silver_orders", "order_id"),
    ForeignKey("reviews_orphan_order_id", "silver_reviews", "order_id", "silver_orders", "order_id"),
    ForeignKey(
        "closed_deals_orphan_mql_id", "silver_closed_deals", "mql_id", "silver_marketing_qualified_leads", "mql_id"
    ),
    ForeignKey(
        "converted_marketing_seller_not_in_silver_sellers", "seller_acquisition_staging", "seller_id",
        "silver_sellers", "seller_id", where="converted_flag",
    ),
    NotNull(
        "sales_staging_null_business_keys", "sales_staging",
        ("order_id", "order_item_id", "product_id", "seller_id", "customer_id"),
    ),
    NotNull("delivery_staging_null_business_keys", "order_delivery_staging", ("order_id", "customer_id")),
    NotNull("reviews_staging_null_business_keys", "reviews_staging", ("review_id", "order_id")),
    NotNull(
        "seller_fulfillment_staging_null_business_keys", "seller_fulfillment_staging",
        ("order_id", "order_item_id", "seller_id", "product_id"),
    ),
    NotNull(
        "seller_performance_monthly_null_business_keys", "seller_performance_monthly_staging",
        ("seller_id", "performance_year", "performance_month"),
    ),
)


@dataclass
class Run:
    """Where a run writes, and the time it stands for."""

    spark: SparkSession
    root: str
    run_id: str
    run_at: datetime
    fmt: str = "parquet"
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def lake(self, layer: str) -> Lake:
        return Lake(self.spark, f"{self.root.rstrip('/')}/{layer}", self.fmt)

    def keep(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        self.tables[name] = self.lake(layer).write(df, name)
        return self.tables[name]

    def keep_by_order(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """As ``keep``, in buckets of the order: for tables of a few rows per order."""
        self.tables[name] = self.lake(layer).write_bucketed(df, name, ["order_id"])
        return self.tables[name]

    def land(self, folder: str) -> Landed:
        """Bronze from the landing folder by declared schemas; unreadable lines go to the
        audit log of this run (S02)."""
        return ingest_typed(
            self.lake("bronze"),
            folder,
            BRONZE_FILES,
            BRONZE_SCHEMAS,
            lambda rows, table: log_rejects(self.lake("audit"), rows, f"bronze_{table}", self.run_id, self.run_at),
            F.lit(self.run_at),
            MULTI_LINE,
        )

    def replace(self, layer: str, name: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A table rewritten from itself, as a new version."""
        self.tables[name] = self.lake(layer).replace(name, change)
        return self.tables[name]

    def entity(self, name: str, built: silver.Entity) -> DataFrame:
        """Write an entity's rows and log its rejects."""
        log_rejects(self.lake("audit"), built.rejects, name, self.run_id, self.run_at)
        return self.keep("silver", name, built.rows)


def build_silver(run: Run, bronze: Mapping[str, DataFrame]) -> None:
    """Entities and staging tables, in order of dependency."""
    geo = run.entity("silver_geolocation", silver.geolocation(bronze["geolocation"]))
    customers = run.entity("silver_customers", silver.customers(bronze["customers"], geo))
    orders = run.entity("silver_orders", silver.orders(bronze["orders"], customers))
    products = run.entity("silver_products", silver.products(bronze["products"], bronze["category_translation"]))
    items = run.entity("silver_order_items", silver.order_items(bronze["order_items"], orders))
    payments = run.entity("silver_payments", silver.payments(bronze["order_payments"], orders, silver.kept_by_verdict))
    reviews = run.entity("silver_reviews", silver.reviews(bronze["order_reviews"], orders))
    leads = run.entity("silver_marketing_qualified_leads", silver.qualified_leads(bronze["marketing_qualified_leads"]))
    deals = run.entity("silver_closed_deals", silver.closed_deals(bronze["closed_deals"]))
    acquisition = run.keep("silver", "seller_acquisition_staging", staging.seller_acquisition(leads, deals))
    sellers = run.entity("silver_sellers", silver.sellers(bronze["sellers"], geo, items, acquisition))
    pairs = run.keep_by_order("silver", "order_sellers", staging.order_sellers(items))
    totals = run.keep_by_order("silver", "order_totals", staging.order_totals(pairs))
    paid = staging.order_payments(payments)
    run.keep("silver", "sales_staging", staging.sales(items, orders, paid, totals, products, pairs))
    delivery = run.keep("silver", "order_delivery_staging", staging.delivery(orders, totals, customers, sellers))
    judged = run.keep("silver", "reviews_staging", staging.reviews(reviews, delivery))
    fulfilled = run.keep(
        "silver", "seller_fulfillment_staging", staging.fulfillment(items, orders, products, sellers, pairs)
    )
    run.keep("silver", "seller_performance_monthly_staging", staging.seller_monthly(delivery, judged, fulfilled))
    # last, because the staging tables bring measures of the same names
    run.replace(
        "silver",
        "silver_orders",
        lambda old: staging.orders_with_payments(staging.orders_with_costs(old, items, pairs), payments),
    )


def build_gold(run: Run) -> None:
    """Dimensions first; facts then look their keys up in the stored dimensions."""
    t = run.tables

    def keep(name: str, df: DataFrame) -> DataFrame:
        return run.keep("gold", name, df.withColumn("gold_loaded_at", F.lit(run.run_at)))

    sold, sent, judged = t["sales_staging"], t["order_delivery_staging"], t["reviews_staging"]
    days = gold.calendar_bounds(
        (sold, "order_purchase_timestamp"),
        (sent, "order_purchase_timestamp"),
        (sent, "order_estimated_delivery_date"),
        (sent, "order_delivered_customer_date"),
        (judged, "review_creation_date"),
        (judged, "review_answer_timestamp"),
        (t["seller_fulfillment_staging"], "order_purchase_timestamp"),
    )
    keep("dim_date", gold.date_dimension(days))
    keep("dim_geolocation", gold.geolocation_dimension(t["silver_geolocation"]))
    customers = keep("dim_customer", gold.customer_dimension(t["silver_customers"]))
    sellers = keep("dim_seller", gold.seller_dimension(t["silver_sellers"], run.run_at.date()))
    products = keep("dim_product", gold.product_dimension(t["silver_products"]))
    statuses = keep("dim_delivery_status", gold.delivery_status_dimension(t["order_delivery_staging"]))
    sentiments = keep("dim_review_sentiment", gold.sentiment_dimension(t["reviews_staging"]))
    types = keep("dim_payment_type", gold.payment_type_dimension(t["sales_staging"]))
    keep("fct_order_sales", gold.order_sales_fact(t["sales_staging"], products, sellers, customers, types))
    keep("fct_order_delivery", gold.order_delivery_fact(t["order_delivery_staging"], customers, sellers, statuses))
    keep("fct_customer_reviews", gold.customer_reviews_fact(t["reviews_staging"], sellers, sentiments))
    keep("fct_seller_fulfillment", gold.seller_fulfillment_fact(t["seller_fulfillment_staging"], sellers, products))


def build_marts(run: Run) -> None:
    for mart in marts.MARTS:
        marts.load_mart(mart, run.tables)
    t = run.tables
    run.keep("gold", "mart_geo_heatmap", marts.geo_heatmap(t["fct_order_delivery"], t["dim_customer"], t["order_totals"]))
    run.keep(
        "gold",
        "mart_review_sentiment",
        marts.review_sentiment(
            t["fct_customer_reviews"], t["fct_order_delivery"], t["dim_customer"], t["fct_seller_fulfillment"],
            t["dim_product"],
        ),
    )


# Tables that a whole run leaves behind.
EXPECTED = (
    "silver_geolocation", "silver_customers", "silver_orders", "silver_products", "silver_order_items",
    "silver_payments", "silver_reviews", "silver_marketing_qualified_leads", "silver_closed_deals", "silver_sellers",
    "seller_acquisition_staging", "sales_staging", "order_delivery_staging", "reviews_staging",
    "seller_fulfillment_staging", "seller_performance_monthly_staging", *marts.PRIMARY_KEYS,
)


def check_quality(run: Run, *, with_marts: bool = False) -> DataFrame:
    """Violations per rule and constraint; rows are written for violated rules only.

    One job counts for all rules (:func:`summarise`). Expected tables, and marts where they
    were built, that are absent and rules that could not run are issues like any other.
    """
    rules = (*RULES, *marts.gold_constraints())
    outcomes = check_rules(run.spark, rules, run.tables)
    lake = run.lake("quality")
    for rule, (_, count, error) in zip(rules, outcomes):
        if count and error is None:
            lake.write(issue_table(rule, run.tables, F.lit(run.run_at)), f"dq_{rule.name}")
    names = [f"{m.name}.{t}" for m in marts.MARTS for t in m.tables] if with_marts else []
    published = [n for n in names if run.spark.catalog.tableExists(n)]
    for rule, expected, present in (
        ("expected_table_missing", EXPECTED, list(run.tables)),
        ("expected_mart_table_missing", names, published),
    ):
        missing = missing_of(expected, present)
        outcomes.append((rule, len(missing), ", ".join(missing) or None))
    return run.keep("quality", "dq_summary", outcome_table(run.spark, outcomes))


def run_pipeline(run: Run, bronze: Mapping[str, DataFrame], *, with_marts: bool = True) -> DataFrame:
    """The whole run over bronze tables; returns the quality summary."""
    build_silver(run, bronze)
    build_gold(run)
    if with_marts:
        build_marts(run)
    return check_quality(run, with_marts=with_marts)
