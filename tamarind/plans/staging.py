"""Joined and enriched grain tables that feed the dimensional model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions import classify as rule
from tamarind.functions.numbers import MONEY, ratio
from tamarind.functions.predicates import is_true
from tamarind.functions.temporal import days_between
from tamarind.operators.aggregates import rate
from tamarind.operators.joins import attach
from tamarind.operators.windows import previous_active
from tamarind.plans.silver import stamped
from tamarind.session import by_buckets

_FUNNEL = "MARKETPLACE_MARKETING_FUNNEL"


def seller_acquisition(leads: DataFrame, deals: DataFrame) -> DataFrame:
    """Every lead with its deal, if any, and the speed of conversion."""
    won = deals.drop("sdr_id", "sr_id", "source_system", "transformation_version")
    funnel = attach(leads.drop("source_system", "transformation_version"), won, "mql_id")
    measured = funnel.withColumns(
        {
            "marketing_origin": F.col("origin"),
            "acquisition_source": F.coalesce("origin", F.lit("unknown")),
            "converted_flag": F.col("seller_id").isNotNull(),
            "days_to_convert": days_between("first_contact_date", "won_date"),
        }
    ).withColumn("seller_acquisition_segment", rule.acquisition_segment("converted_flag", "days_to_convert"))
    return stamped(
        measured.select(
            "mql_id", "seller_id", "first_contact_date", "landing_page_id", "marketing_origin", "acquisition_source",
            "won_date", "business_segment", "lead_type", "lead_behaviour_profile", "business_type",
            "declared_monthly_revenue", "days_to_convert", "converted_flag", "seller_acquisition_segment",
        ),
        _FUNNEL,
    )


def order_payments(payments: DataFrame) -> DataFrame:
    """Payments per order; type and category come from the first payment in
    sequence, so they belong together (G03, A09)."""
    named = F.struct("payment_sequential", "payment_type", "payment_type_category")
    first = F.min(F.when(F.col("payment_type").isNotNull(), named)).alias("__first")
    return (
        payments.groupBy("order_id")
        .agg(
            F.sum("payment_value").alias("total_payment_value"),
            F.max("payment_installments").alias("total_payment_installments"),
            first,
        )
        .select(
            "order_id",
            "total_payment_value",
            "total_payment_installments",
            F.col("__first.payment_type").alias("payment_type"),
            F.coalesce("__first.payment_type_category", F.lit("Other")).alias("payment_type_category"),
            rule.in_installments("total_payment_installments").alias("installment_flag"),
        )
    )


def order_sellers(items: DataFrame) -> DataFrame:
    """One row per order and seller with all that is summed up per order, per pair and per
    seller. Stored in buckets of the order it is the one place where items are grouped:
    totals, costs, shares and monthly workloads start from it."""
    return items.groupBy(*_PAIR).agg(
        F.sum("price").alias("price"),
        F.sum("freight_value").alias("freight"),
        F.sum(F.col("price") + F.col("freight_value")).alias("gross"),
        F.count("order_item_id").alias("items"),
        F.count("*").alias("seller_item_count_in_order"),
        F.min("order_item_id").alias("first_item"),
    )


def order_totals(pairs: DataFrame) -> DataFrame:
    """Items per order from :func:`order_sellers` (G04, C21). The primary seller is that
    of the first item. An order with very many items is already folded."""
    return (
        pairs.groupBy("order_id")
        .agg(
            F.sum("gross").cast(MONEY).alias("total_order_item_value"),
            F.sum("items").alias("total_items_count"),
            F.count("seller_id").alias("seller_count"),
            F.min(F.when(F.col("seller_id").isNotNull(), F.struct("first_item", "seller_id")))["seller_id"]
            .alias("primary_seller_id"),
            F.sum("freight").cast(MONEY).alias("freight_total_value"),
        )
        .withColumn("is_multi_seller_order", rule.several("seller_count"))
    )


_PAIR = ["order_id", "seller_id"]
_ITEM = ["order_id", "order_item_id"]


def item_lookups(items: DataFrame, *tables: tuple[str, DataFrame]) -> DataFrame:
    """What is known of each item in tables of other keys, as (key, table): one row per item
    with its order and number, dealt by order. Only the keys travel to those tables, and what
    is found there travels back."""
    found = items.select(*_ITEM, *[key for key, _ in tables])
    for key, table in tables:
        found = attach(found, table, key)
    return by_buckets(found.drop(*[key for key, _ in tables]), ["order_id"])


def _with_found(items: DataFrame, found: DataFrame) -> DataFrame:
    return attach(items, found, _ITEM, null_safe=["order_item_id"])


def paid_pairs(orders: DataFrame, payments_per_order: DataFrame, totals: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per order and seller with what is known of the order: customer, payment, value."""
    order_level = attach(
        attach(orders.select("order_id", "customer_id", "order_purchase_timestamp"), payments_per_order, "order_id"),
        totals.select("order_id", "total_order_item_value"),
        "order_id",
    )
    return attach(pairs.select(*_PAIR, "seller_item_count_in_order"), order_level, "order_id")


def sales(
    items: DataFrame,
    orders: DataFrame,
    payments_per_order: DataFrame,
    totals: DataFrame,
    products: DataFrame,
    pairs: DataFrame,
    found: DataFrame | None = None,
) -> DataFrame:
    """Items with the order's payment allocated by their share of its value.

    Everything known per order is joined to one row per order and seller; stored in
    buckets of the order, none of these tables is shuffled for it, nor are the items, whose
    order is known. A caller that looks up more than the volume gives what it ``found``.
    """
    shared = paid_pairs(orders, payments_per_order, totals, pairs)
    if found is None:
        found = item_lookups(items, ("product_id", products.select("product_id", "product_volume_cm3")))
    enriched = _with_found(attach(items, shared, _PAIR, null_safe=["seller_id"]), found)
    measured = (
        enriched.withColumn("gross_item_value", F.col("price") + F.col("freight_value"))
        .withColumns(
            {
                "item_sales_ratio": ratio("gross_item_value", "total_order_item_value"),
                "freight_ratio": ratio("freight_value", "gross_item_value"),
            }
        )
        .withColumn("allocated_payment_value", F.col("item_sales_ratio") * F.col("total_payment_value").cast("double"))
        .withColumn("high_ticket_order_flag", rule.is_high_ticket("allocated_payment_value"))
    )
    return stamped(measured)


def delivery(orders: DataFrame, totals: DataFrame, customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Orders with totals, both ends' places and the distance bucket."""
    buyer = customers.select(
        "customer_id", "customer_region",
        F.col("median_latitude").alias("customer_lat"), F.col("median_longitude").alias("customer_lng"),
    )
    seller = sellers.select(
        F.col("seller_id").alias("primary_seller_id"), "seller_region", "seller_state",
        F.col("median_latitude").alias("seller_lat"), F.col("median_longitude").alias("seller_lng"),
    )
    placed = attach(attach(attach(orders, totals, "order_id"), buyer, "customer_id"), seller, "primary_seller_id")
    return stamped(placed.withColumn("distance_bucket", rule.distance_bucket("seller_region", "customer_region")))


def reviews(reviews_: DataFrame, delivery_: DataFrame) -> DataFrame:
    """Reviews with the delivery they judge."""
    outcome = delivery_.select(
        "order_id", "primary_seller_id", "order_status",
        F.col("total_lead_time").alias("delivery_duration_days"), F.col("days_diff_estimated").alias("delay_days"),
        "delivery_status_category", "distance_bucket", "is_multi_seller_order",
    )
    return stamped(
        attach(reviews_, outcome, "order_id").withColumns(
            {
                "delayed_delivery_review_flag": rule.late_and_unhappy("delay_days", "review_score"),
                "delivery_experience_segment": rule.experience_segment("delay_days", "review_score"),
            }
        )
    )


_MONTH = ("performance_year", "performance_month")


def _by_month(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({_MONTH[0]: F.year(ts), _MONTH[1]: F.month(ts)})


def fulfillment(
    items: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame, pairs: DataFrame,
    found: DataFrame | None = None,
) -> DataFrame:
    """Items with the seller's monthly workload.

    The distinct orders of a seller and month are counted on one row per order and
    seller, not on the items; that row travels back to the items, which stay by their order.
    A caller that looks up more of product and seller gives what it ``found``.
    """
    if found is None:
        found = item_lookups(
            items, ("product_id", products.select("product_id", "product_volume_cm3")),
            ("seller_id", sellers.select("seller_id", "acquisition_source")),
        )
    dated = attach(
        pairs.select(*_PAIR, "seller_item_count_in_order"),
        orders.select("order_id", "order_purchase_timestamp"),
        "order_id",
    )
    active = _by_month(dated, "order_purchase_timestamp")
    monthly = active.groupBy("seller_id", *_MONTH).agg(F.count("order_id").alias("seller_monthly_orders"))
    loaded = by_buckets(attach(active, monthly, ["seller_id", *_MONTH]).drop(*_MONTH), ["order_id"])
    enriched = _with_found(attach(items, loaded, _PAIR, null_safe=["seller_id"]), found)
    measured = enriched.withColumns(
        {
            "freight_ratio": ratio("freight_value", F.col("price") + F.col("freight_value")),
            "workload_bucket": rule.workload_bucket("seller_monthly_orders"),
        }
    )
    return stamped(measured.withColumn("is_overloaded_seller", F.col("workload_bucket") == "Overloaded"))


def seller_monthly(delivery_: DataFrame, reviews_: DataFrame, fulfillment_: DataFrame) -> DataFrame:
    """Per seller and month: single-seller deliveries, reviews (by review month) and
    workload, with growth against the previous active month (G09)."""
    keys = ["seller_id", *_MONTH]

    def single(df: DataFrame, ts: str) -> DataFrame:
        one = df.where(~is_true(F.col("is_multi_seller_order")))
        return _by_month(one.withColumn("seller_id", F.col("primary_seller_id")), ts)

    gap = F.col("days_diff_estimated")
    shipped = single(delivery_, "order_purchase_timestamp").groupBy(*keys).agg(
        F.count("order_id").alias("monthly_orders"),
        F.avg("total_lead_time").alias("avg_shipping_days"),
        rate(gap <= 0).alias("on_time_rate"),
        F.avg(gap).alias("avg_delay_days"),
        F.count_if(gap > 0).alias("delayed_orders_count"),
    )
    judged = single(reviews_, "review_creation_date").groupBy(*keys).agg(
        F.avg("review_score").alias("avg_review_score"),
        rate(F.col("negative_review_flag")).alias("negative_review_rate"),
        F.count("review_id").alias("monthly_review_count"),
    )
    worked = _by_month(fulfillment_, "order_purchase_timestamp").groupBy(*keys).agg(
        F.avg("seller_monthly_orders").alias("avg_monthly_workload"),
        F.avg("freight_ratio").alias("avg_freight_ratio"),
        F.avg(F.col("product_volume_cm3").cast("double")).alias("avg_product_volume_cm3"),
    )
    monthly = attach(attach(shipped, judged, keys), worked, keys).fillna(
        {"avg_review_score": 0.0, "negative_review_rate": 0.0, "monthly_review_count": 0}
    )
    grown = (
        previous_active(monthly, ["seller_id"], _MONTH, {"previous_month_orders": "monthly_orders"})
        .withColumn("is_new_seller_month", F.col("previous_month_orders").isNull())
        .withColumn("volume_growth_rate", rule.growth_rate("monthly_orders", "previous_month_orders"))
        .withColumns(
            {
                "seller_growth_category": rule.growth_category("is_new_seller_month", "volume_growth_rate"),
                "seller_performance_category": rule.on_time_grade("on_time_rate"),
            }
        )
    )
    return stamped(grown)


_COSTS = ("total_products_price", "total_freight_value", "total_order_cost")
_COUNTS = ("total_items_count", "seller_count", "is_multi_seller_order")


def orders_with_costs(orders: DataFrame, items: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Orders with cost, freight, item and seller counts; zero without items (G10), from
    the stored :func:`order_sellers` where there is one. Enriching an enriched frame
    replaces the measures."""
    pairs = order_sellers(items) if pairs is None else pairs
    costs = pairs.groupBy("order_id").agg(
        F.sum("price").cast(MONEY).alias("total_products_price"),
        F.sum("freight").cast(MONEY).alias("total_freight_value"),
        F.sum("items").cast("int").alias("total_items_count"),
        F.count("seller_id").cast("int").alias("seller_count"),
    ).withColumns(
        {
            "total_order_cost": (F.col("total_products_price") + F.col("total_freight_value")).cast(MONEY),
            "is_multi_seller_order": rule.several("seller_count").cast("int"),
        }
    )
    joined = attach(orders.drop(*_COSTS, *_COUNTS), costs.select("order_id", *_COSTS, *_COUNTS), "order_id")
    return joined.withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(0).cast(MONEY)) for c in _COSTS},
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in _COUNTS},
        }
    )


_PAID = ("total_amount_paid", "financial_variance", "payment_status")


def orders_with_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders (with ``total_order_cost``) with the amount paid and its variance.
    Enriching an enriched frame replaces the measures."""
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").cast(MONEY).alias("total_amount_paid"))
    variance = (F.col("total_amount_paid") - F.col("total_order_cost")).cast(MONEY)
    return (
        attach(orders.drop(*_PAID), paid, "order_id")
        .withColumn("financial_variance", variance)
        .withColumn("payment_status", rule.payment_status("total_amount_paid", "financial_variance"))
    )
