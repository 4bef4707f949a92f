"""Star schema: dimensions and facts with dense integer keys.

Fixed values: the column lists of the dimensions and facts, in their published order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions import classify as rule
from tamarind.functions.predicates import is_true
from tamarind.functions.temporal import calendar_attributes, date_key
from tamarind.operators import ranged
from tamarind.operators.joins import Keys, key_map, lookup_key
from tamarind.plans.silver import stamped
from tamarind.session import stored

_AUDIT = ("source_system", "transformation_version")


def dense_key(df: DataFrame, order: list[str], name: str, source: DataFrame | None = None) -> DataFrame:
    """Surrogate key of a table with a unique natural key (D01). ``source`` is the stored
    table that the rows come from, one for one."""
    return ranged.dense_key_of(df, order, name, source)


_ITEM = ["order_id", "order_item_id"]

# A key to look up: (dimension, natural key, surrogate key, name in the fact).
Lookup = tuple[DataFrame, Keys, str, str]


def _looked_up(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    for dim, on, key, as_ in lookups:
        df = lookup_key(df, dim, on, key, as_)
    return df


def _own_key(
    df: DataFrame, order: list[str], name: str, source: DataFrame, numbered: bool, lookups: Sequence[Lookup] = ()
) -> DataFrame:
    """A fact with its surrogate key and those of large dimensions. These are looked up on
    the natural keys alone and come with the number, so the wide rows are moved once,
    whatever the number of dimensions. A caller that has no use for the fact's own key
    spares the numbering: what only adds up a fact's rows reads few columns of them.
    """
    if not numbered:
        return _looked_up(df, lookups)
    ids = [c for _, on, _, _ in lookups for c in key_map(on)]
    narrow = _looked_up(source.select(*dict.fromkeys([*order, *ids])), lookups)
    return ranged.dense_key_of(df, order, name, narrow, [as_ for *_, as_ in lookups])


def _item_key(sales: DataFrame, name: str, source: DataFrame | None, numbered: bool, lookups: Sequence[Lookup]) -> DataFrame:
    """As :func:`_own_key`, for facts of items; keys that the rows have brought along are not
    looked up again. ``source`` names items in buckets of their order, which stay there."""
    lookups = [one for one in lookups if one[3] not in sales.columns]
    if source is None or not numbered:
        return _own_key(sales, _ITEM, name, sales, numbered, lookups)
    return ranged.dense_key_within(_looked_up(sales, lookups), _ITEM, name, source)


def calendar_bounds(*dates: tuple[DataFrame, str]) -> DataFrame:
    """One row: the first and the last day of the years that the date columns touch."""
    spans = [df.agg(F.min(F.to_date(c)).alias("first"), F.max(F.to_date(c)).alias("last")) for df, c in dates]
    both = reduce(DataFrame.unionAll, spans).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return both.select(
        F.trunc("first", "year").alias("first"), F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1).alias("last")
    )


def date_dimension(bounds: DataFrame) -> DataFrame:
    """One row per day between the bounds with its calendar attributes."""
    days = bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("full_date"))
    return stamped(days.select(*[c.alias(n) for n, c in calendar_attributes().items()]))


def geolocation_dimension(geo: DataFrame) -> DataFrame:
    return dense_key(geo, ["zip_code_prefix", "city", "state"], "geolocation_sk")


def customer_dimension(customers: DataFrame) -> DataFrame:
    placed = customers.withColumn("customer_location_type", rule.location_type("customer_city", "customer_state"))
    return dense_key(
        placed.select(
            "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
            "customer_region", "customer_location_type", "median_latitude", "median_longitude", *_AUDIT,
        ),
        ["customer_id"],
        "customer_sk",
    )


def seller_dimension(sellers: DataFrame, run_date: date) -> DataFrame:
    """Sellers with validity columns for the run date; history is not merged."""
    valid = sellers.withColumns(
        {
            "seller_location_type": rule.location_type("seller_city", "seller_state"),
            "effective_start_date": F.lit(run_date),
            "effective_end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )
    return dense_key(
        valid.select(
            "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "seller_region", "median_latitude",
            "median_longitude", "marketing_origin", "acquisition_source", "business_segment", "lead_type",
            "lead_behaviour_profile", "days_to_convert", "converted_flag", "seller_acquisition_segment",
            "seller_location_type", "effective_start_date", "effective_end_date", "is_current", *_AUDIT,
        ),
        ["seller_id"],
        "seller_sk",
    )


def product_dimension(products: DataFrame) -> DataFrame:
    return dense_key(products, ["product_id"], "product_sk")


def delivery_status_dimension(delivery: DataFrame) -> DataFrame:
    """Junk dimension of the status pairs that occur."""
    pairs = delivery.select("order_status", "delivery_status_category").distinct()
    grouped = pairs.withColumn("delivery_status_group", rule.delivery_group("delivery_status_category"))
    return dense_key(stored(stamped(grouped), "statuses"), ["delivery_status_category", "order_status"], "delivery_status_sk")


def sentiment_dimension(reviews: DataFrame) -> DataFrame:
    labels = reviews.select("sentiment_category").distinct()
    banded = labels.withColumn("sentiment_score_band", rule.sentiment_band("sentiment_category"))
    return dense_key(stored(stamped(banded), "sentiments"), ["sentiment_category"], "review_sentiment_sk")


def payment_type_dimension(sales: DataFrame) -> DataFrame:
    """Payment types of the sales, whose rows per order and seller have them all."""
    types = sales.select("payment_type", "payment_type_category", "installment_flag").distinct()
    return dense_key(stored(stamped(types), "payment_types"), ["payment_type", "installment_flag", "payment_type_category"], "payment_type_sk")


def order_sales_fact(
    sales: DataFrame, products: DataFrame, sellers: DataFrame, customers: DataFrame, payment_types: DataFrame,
    numbered: bool = True, items: DataFrame | None = None,
) -> DataFrame:
    """One row per item sold (D10). Orders without payment keep a null payment key. ``items``
    are the rows of the sales in buckets of their order, where they lie so."""
    lookups = [
        (products, "product_id", "product_sk", "product_sk_fk"), (sellers, "seller_id", "seller_sk", "seller_sk_fk"),
        (customers, "customer_id", "customer_sk", "customer_sk_fk"),
    ]
    keyed = _item_key(sales, "sales_fact_sk", items, numbered, lookups)
    keyed = lookup_key(
        keyed, payment_types, ["payment_type", "installment_flag"], "payment_type_sk", "payment_type_sk_fk"
    )
    return keyed.select(
        *["sales_fact_sk"][:numbered], "order_id", "order_item_id", "product_sk_fk", "seller_sk_fk", "customer_sk_fk", "payment_type_sk_fk",
        date_key("order_purchase_timestamp").alias("sales_date_sk"), "price", "freight_value", "gross_item_value",
        "total_order_item_value", "allocated_payment_value", "item_sales_ratio", "freight_ratio",
        "product_volume_cm3", "seller_item_count_in_order", "total_payment_installments", "installment_flag",
        "high_ticket_order_flag", rule.is_high_freight("freight_ratio").alias("high_freight_item_flag"), *_AUDIT,
    )


def order_delivery_fact(
    delivery: DataFrame, customers: DataFrame, sellers: DataFrame, statuses: DataFrame, numbered: bool = True
) -> DataFrame:
    """One row per order with three date roles."""
    lookups = [
        (customers, "customer_id", "customer_sk", "customer_sk_fk"),
        (sellers, {"primary_seller_id": "seller_id"}, "seller_sk", "seller_sk_fk"),
    ]
    keyed = _own_key(delivery, ["order_id"], "delivery_fact_sk", delivery, numbered, lookups)
    keyed = lookup_key(
        keyed, statuses, ["order_status", "delivery_status_category"], "delivery_status_sk", "delivery_status_sk_fk"
    )
    return keyed.select(
        *["delivery_fact_sk"][:numbered], "order_id", "customer_sk_fk", "seller_sk_fk", "delivery_status_sk_fk",
        date_key("order_purchase_timestamp").alias("purchase_date_sk"),
        date_key("order_estimated_delivery_date").alias("estimated_delivery_date_sk"),
        date_key("order_delivered_customer_date").alias("actual_delivery_date_sk"),
        "order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
        F.col("total_lead_time").alias("delivery_duration_days"),
        F.col("days_diff_estimated").alias("delay_days"),
        F.col("estimated_buffer").alias("buffer_days"),
        "freight_total_value", "total_items_count", "seller_count", "is_multi_seller_order", "distance_bucket",
        "seller_region", "customer_region",
        (F.col("days_diff_estimated") <= 0).alias("on_time_delivery_flag"),
        (F.col("days_diff_estimated") > 0).alias("late_delivery_flag"), *_AUDIT,
    )


def customer_reviews_fact(
    reviews: DataFrame, sellers: DataFrame, sentiments: DataFrame, numbered: bool = True
) -> DataFrame:
    """One row per review."""
    lookups = [(sellers, {"primary_seller_id": "seller_id"}, "seller_sk", "seller_sk_fk")]
    keyed = _own_key(reviews, ["review_id", "order_id"], "review_fact_sk", reviews, numbered, lookups)
    keyed = lookup_key(keyed, sentiments, "sentiment_category", "review_sentiment_sk", "review_sentiment_sk_fk")
    return keyed.select(
        *["review_fact_sk"][:numbered], "review_id", "order_id", "seller_sk_fk", "review_sentiment_sk_fk",
        date_key("review_creation_date").alias("review_date_sk"),
        date_key("review_answer_timestamp").alias("response_date_sk"),
        "review_score", F.col("review_response_delay_days").alias("review_response_days"), "delivery_duration_days",
        "delay_days", "negative_review_flag", "neutral_review_flag", "positive_review_flag",
        "delayed_delivery_review_flag", (F.col("review_score") <= 2).alias("low_rating_flag"),
        (F.col("review_score") == 5).alias("excellent_rating_flag"), "is_multi_seller_order", "sentiment_category",
        "delivery_experience_segment", "delivery_status_category", "distance_bucket", *_AUDIT,
    )


def seller_fulfillment_fact(
    fulfillment: DataFrame, sellers: DataFrame, products: DataFrame, numbered: bool = True,
    items: DataFrame | None = None,
) -> DataFrame:
    """One row per item shipped (D13); ``items`` as in the fact of the sales."""
    lookups = [
        (sellers, "seller_id", "seller_sk", "seller_sk_fk"), (products, "product_id", "product_sk", "product_sk_fk"),
    ]
    keyed = _item_key(fulfillment, "fulfillment_fact_sk", items, numbered, lookups)
    return keyed.select(
        *["fulfillment_fact_sk"][:numbered], "order_id", "order_item_id", "seller_sk_fk", "product_sk_fk",
        date_key("order_purchase_timestamp").alias("purchase_date_sk"), "price", "freight_value", "freight_ratio",
        "product_volume_cm3", "seller_item_count_in_order", "seller_monthly_orders", "workload_bucket",
        "is_overloaded_seller", is_true(rule.is_high_workload("workload_bucket")).alias("high_workload_flag"),
        rule.is_high_freight("freight_ratio", inclusive=True).alias("high_freight_item_flag"), "acquisition_source",
        *_AUDIT,
    )
