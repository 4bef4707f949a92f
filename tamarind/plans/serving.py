"""Dashboard frames over counters, sums and events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarind.functions import fixed
from tamarind.functions.text import mask_id, state_name, titled
from tamarind.functions.numbers import to_number
from tamarind.functions.temporal import clock_label
from tamarind.operators.aggregates import label_rank, numeric_order, top_k
from tamarind.operators.joins import attach, full_merge

PRICE_LABELS = tuple(label for _, _, label in fixed.PRICE_BUCKET)
FREIGHT_LABELS = tuple(label for _, _, label in fixed.FREIGHT_BUCKET)


def _mean(total: str, count: str, digits: int, scale: float = 1.0) -> Column:
    """Mean with a zero guard: no observations give zero."""
    return F.round(F.col(total) / F.greatest(F.col(count), F.lit(1)) * scale, digits)


def kpi_row(metrics: DataFrame) -> DataFrame:
    """Eight headline figures from the running sums."""
    return metrics.select(
        F.col("total_orders").cast("long").alias("total_orders"),
        F.round("total_revenue", 2).alias("total_revenue"),
        F.round("total_freight", 2).alias("total_freight"),
        _mean("review_score_sum", "review_score_count", 2).alias("avg_score"),
        _mean("total_revenue", "total_orders", 2).alias("avg_order_value"),
        _mean("delivery_days_sum", "delivery_days_count", 1).alias("avg_delivery_days"),
        _mean("weight_sum", "weight_count", 0).alias("avg_weight_g"),
        _mean("freight_ratio_sum", "freight_ratio_count", 1, 100).alias("avg_freight_pct"),
    )


def counter(counts: DataFrame, dim: str) -> DataFrame:
    """Labels of one dimension by falling count."""
    return _counter(counts, dim).orderBy(F.desc("event_count"), "label")


def _counter(counts: DataFrame, dim: str) -> DataFrame:
    return counts.where(F.col("dim") == dim).select("label", "event_count")


def top_labels(counts: DataFrame, dim: str, k: int = 10) -> DataFrame:
    """The k most frequent labels: categories, cities or states."""
    return top_k(_counter(counts, dim), k, "event_count", "label")


def top_labels_of(counts: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """The most frequent labels of several dimensions, ranked in one pass."""
    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("event_count"), "label"))
    wanted = F.coalesce(*[F.when(F.col("dim") == dim, F.lit(k)) for dim, k in sizes.items()])
    ranked = counts.withColumns({"__place": place, "__wanted": wanted})
    return ranked.where("__place <= __wanted").select("dim", "label", "event_count")


def state_comparison(counts: DataFrame, k: int | None = 10) -> DataFrame:
    """Orders bought and sold per state, zero where a state has only one side."""
    bought = _counter(counts, "state").withColumnRenamed("event_count", "customer_orders")
    sold = _counter(counts, "seller_state").withColumnRenamed("event_count", "seller_orders")
    merged = full_merge(bought, sold, ["label"], 0)
    return merged if k is None else top_k(merged, k, "customer_orders", "label")


def bucket_distribution(counts: DataFrame, dim: str, order: Sequence[str]) -> DataFrame:
    """Buckets in their natural order; unknown labels last."""
    ranked = _counter(counts, dim).withColumn("sort_order", label_rank("label", order))
    return ranked.orderBy("sort_order", "label")


def numeric_distribution(counts: DataFrame, dim: str, suffix: str = "") -> DataFrame:
    """Numeric labels in numeric order, shown with a suffix."""
    ordered = _counter(counts, dim).orderBy(numeric_order("label"), "label")
    return ordered.select(F.concat("label", F.lit(suffix)).alias("label"), "event_count")


def state_map(counts: DataFrame, dim: str = "state") -> DataFrame:
    """State code, count and full name."""
    return _counter(counts, dim).select("label", "event_count", state_name("label").alias("state_name"))


_NUMERIC = (
    "payment_value", "price", "freight_value", "review_score", "product_photos_qty", "product_weight_g",
    "payment_installments", "delivery_days",
)


def recent_details(recent: DataFrame, latest: DataFrame, n: int = 15) -> DataFrame:
    """The last ``n`` events with the newest details of their orders."""
    newest = latest.withColumns({c: to_number(c) for c in _NUMERIC}).drop("event_time")
    order = recent.select("order_id", F.col("event_timestamp").alias("seen_at"))
    last = order.orderBy(F.desc_nulls_last("seen_at"), "order_id").limit(n)
    return attach(last, newest, "order_id", "inner")


# Columns of the live feed, in display order.
FEED = (
    "order_id", "order_status", "customer_state", "customer_city", "product_category", "payment_type",
    "payment_installments", "payment_value", "price", "freight_value", "review_score", "delivery_days",
    "event_timestamp",
)


def live_feed(details: DataFrame) -> DataFrame:
    """Feed rows with masked ids, clock times and readable headings."""
    shown = details.withColumns(
        {
            "order_id": mask_id("order_id"),
            "product_category": F.col("product_category_name_english"),
            "event_timestamp": clock_label("event_timestamp"),
        }
    )
    return titled(shown.select(*FEED))
