"""Subject-area marts, their constraints and two serving marts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.numbers import MONEY, share
from tamarind.operators.joins import attach, lookup_key
from tamarind.operators.quality import ForeignKey, Rule, Unique, count_sheet
from tamarind.session import CODEC
from tamarind.sources.jdbc import Warehouse
from tamarind.sources.tables import reset_namespace

# Primary key of every gold table.
PRIMARY_KEYS = {
    "dim_customer": "customer_sk",
    "dim_seller": "seller_sk",
    "dim_product": "product_sk",
    "dim_date": "date_sk",
    "dim_delivery_status": "delivery_status_sk",
    "dim_review_sentiment": "review_sentiment_sk",
    "dim_payment_type": "payment_type_sk",
    "dim_geolocation": "geolocation_sk",
    "fct_order_sales": "sales_fact_sk",
    "fct_order_delivery": "delivery_fact_sk",
    "fct_customer_reviews": "review_fact_sk",
    "fct_seller_fulfillment": "fulfillment_fact_sk",
}

# Foreign keys of every fact, {fact: {column: dimension}}.
FOREIGN_KEYS = {
    "fct_order_sales": {
        "product_sk_fk": "dim_product", "seller_sk_fk": "dim_seller", "customer_sk_fk": "dim_customer",
        "payment_type_sk_fk": "dim_payment_type", "sales_date_sk": "dim_date",
    },
    "fct_order_delivery": {
        "customer_sk_fk": "dim_customer", "seller_sk_fk": "dim_seller",
        "delivery_status_sk_fk": "dim_delivery_status", "purchase_date_sk": "dim_date",
    },
    "fct_customer_reviews": {
        "seller_sk_fk": "dim_seller", "review_sentiment_sk_fk": "dim_review_sentiment", "review_date_sk": "dim_date",
    },
    "fct_seller_fulfillment": {
        "seller_sk_fk": "dim_seller", "product_sk_fk": "dim_product", "purchase_date_sk": "dim_date",
    },
}


@dataclass(frozen=True)
class Mart:
    """A namespace that publishes one fact and the dimensions it refers to."""

    name: str
    fact: str

    @property
    def tables(self) -> tuple[str, ...]:
        return (*dict.fromkeys(FOREIGN_KEYS[self.fact].values()), self.fact)

    def constraints(self) -> list[Rule]:
        """The primary and foreign keys, as checkable rules."""
        return gold_constraints(self.tables)


def gold_constraints(tables: tuple[str, ...] = tuple(PRIMARY_KEYS)) -> list[Rule]:
    unique: list[Rule] = [Unique(f"pk_{t}", t, (PRIMARY_KEYS[t],)) for t in tables]
    linked = [
        ForeignKey(f"fk_{t}_{col}", t, col, dim, PRIMARY_KEYS[dim], ignore_null=True)
        for t in tables
        for col, dim in FOREIGN_KEYS.get(t, {}).items()
    ]
    return unique + linked


# The published marts. The last two share their tables.
MARTS = (
    Mart("sales_mart", "fct_order_sales"),
    Mart("delivery_performance_mart", "fct_order_delivery"),
    Mart("customer_satisfaction_mart", "fct_customer_reviews"),
    Mart("seller_performance_mart", "fct_seller_fulfillment"),
    Mart("seller_acquisition_effectiveness_mart", "fct_seller_fulfillment"),
)


def load_mart(mart: Mart, gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Reset the mart's namespace and copy its tables into it."""
    spark = gold[mart.fact].sparkSession
    reset_namespace(spark, mart.name)
    for table in mart.tables:
        gold[table].write.mode("overwrite").option("compression", CODEC).saveAsTable(f"{mart.name}.{table}")
    return {t: spark.table(f"{mart.name}.{t}") for t in mart.tables}


def publish(tables: Mapping[str, DataFrame], warehouse: Warehouse, schema: str) -> None:
    """Copy tables to a relational schema for reporting tools."""
    for name, df in tables.items():
        warehouse.write(df, f"{schema}.{name}")


def geo_heatmap(delivery: DataFrame, customers: DataFrame, order_value: DataFrame) -> DataFrame:
    """Orders, revenue, customers and punctuality per state and region.

    ``order_value`` gives ``total_order_item_value`` per ``order_id``; an order
    without items counts as zero revenue.
    """
    valued = attach(delivery.drop("customer_region"), order_value.select("order_id", "total_order_item_value"), "order_id")
    place = customers.where(F.col("customer_state").isNotNull()).select("customer_sk", "customer_state", "customer_region")
    placed = attach(valued, place, {"customer_sk_fk": "customer_sk"}, "inner").withColumn(
        "value", F.coalesce(F.col("total_order_item_value"), F.lit(0).cast(MONEY))
    )
    # an order is one row and belongs to one customer, so folding per customer first
    # leaves only counts to add up, whatever a state's share of the orders
    per_customer = placed.groupBy("customer_state", "customer_region", "customer_sk_fk").agg(
        F.count("*").alias("orders"),
        F.sum("value").alias("value"),
        F.count_if("on_time_delivery_flag").alias("on_time"),
        F.count_if("late_delivery_flag").alias("late"),
        F.sum("delivery_duration_days").alias("days"),
        F.count("delivery_duration_days").alias("dated"),
    )
    return per_customer.groupBy("customer_state", "customer_region").agg(
        F.sum("orders").alias("total_orders"),
        F.sum("value").cast(MONEY).alias("total_revenue"),
        F.count("*").alias("total_customers"),
        F.round(F.sum("value").cast("double") / F.sum("orders"), 2).alias("avg_order_value"),
        F.sum("on_time").alias("on_time_orders"),
        F.sum("late").alias("delayed_orders"),
        F.round(F.try_divide(F.sum("days"), F.sum("dated")), 2).alias("avg_lead_time_days"),
    ).withColumn("on_time_rate_pct", share("on_time_orders", "total_orders"))


def review_sentiment(
    reviews: DataFrame, delivery: DataFrame, customers: DataFrame, fulfillment: DataFrame, products: DataFrame
) -> DataFrame:
    """Satisfaction per product category and customer region.

    A review reaches its customer through the order and its categories through the
    order's items; a category bought several times in one order counts once.
    """
    buyer = lookup_key(
        delivery.select("order_id", "customer_sk_fk"), customers, {"customer_sk_fk": "customer_sk"}, "customer_region"
    )
    category = lookup_key(
        fulfillment.select("order_id", "product_sk_fk"), products, {"product_sk_fk": "product_sk"}, "product_category_name"
    )
    bought = category.select("order_id", "product_category_name").dropna().distinct()
    judged = reviews.select("review_id", "order_id", "review_score", "review_response_days")
    # one row per review and category: an order has one delivery and each category once
    base = attach(
        attach(judged, buyer.select("order_id", "customer_region").dropna(), "order_id", "inner"), bought, "order_id", "inner"
    )
    score = F.col("review_score")
    counted = base.groupBy("product_category_name", "customer_region").agg(
        F.count_distinct("review_id").alias("total_reviews"),
        F.round(F.avg(score), 2).alias("avg_score"),
        F.count_if(score >= 4).alias("positive_count"),
        F.count_if(score == 3).alias("neutral_count"),
        F.count_if(score <= 2).alias("negative_count"),
        F.round(F.avg("review_response_days"), 2).alias("avg_response_delay_days"),
    )
    return counted.withColumns(
        {
            "pct_positive": share("positive_count", "total_reviews"),
            "pct_negative": share("negative_count", "total_reviews"),
        }
    )


def mart_counts(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of published marts."""
    return count_sheet(marts, label="mart_name")
