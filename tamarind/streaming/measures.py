"""Counters and running sums over flat events (T07-T12). The same functions serve a
batch, a micro-batch and a stateful streaming aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.classify import freight_bucket, price_bucket
from tamarind.functions.temporal import wall_clock
from tamarind.operators.dedupe import latest_per_key


def _dimensions() -> dict[str, Column]:
    return {
        "status": F.col("order_status"),
        "payment": F.col("payment_type"),
        "category": F.col("product_category_name_english"),
        "state": F.col("customer_state"),
        "seller_state": F.col("seller_state"),
        "installments": F.col("payment_installments"),
        "photos": F.col("product_photos_qty"),
        "review_score": F.col("review_score"),
        "review_has_comment": F.when(F.col("review_has_comment"), "yes").otherwise("no"),
        "price_bucket": price_bucket("price"),
        "freight_bucket": freight_bucket("freight_value"),
        "customer_city": F.col("customer_city"),
        "seller_city": F.col("seller_city"),
    }


def dimension_counts(flat: DataFrame, dims: Sequence[str] | None = None) -> DataFrame:
    """Events per label of each of the 13 dimensions, or of the named ones, as
    (dim, label, event_count).

    All dimensions are counted in one aggregate with map-side combine; a missing
    label is counted as ``None``.
    """
    entries = [
        F.struct(F.lit(dim).alias("dim"), F.coalesce(c.cast("string"), F.lit("None")).alias("label"))
        for dim, c in _dimensions().items()
        if dims is None or dim in dims
    ]
    labelled = flat.select(F.explode(F.array(*entries)).alias("e")).select("e.dim", "e.label")
    return labelled.groupBy("dim", "label").agg(F.count("*").alias("event_count"))


def _sums() -> dict[str, Column]:
    paid = F.col("payment_value") > 0
    freight_ratio = F.when(paid, F.col("freight_value") / F.col("payment_value"))
    return {
        "total_orders": F.count("*"),
        "total_revenue": F.sum("payment_value"),
        "total_freight": F.sum("freight_value"),
        "review_score_sum": F.sum("review_score"),
        "review_score_count": F.count("review_score"),
        "delivery_days_sum": F.sum("delivery_days"),
        "delivery_days_count": F.count("delivery_days"),
        "weight_sum": F.sum("product_weight_g"),
        "weight_count": F.count("product_weight_g"),
        "freight_ratio_sum": F.sum(freight_ratio),
        "freight_ratio_count": F.count(freight_ratio),
    }



def metric_sums(flat: DataFrame) -> DataFrame:
    """One row of running sums and counts; sums over nothing are zero."""
    return flat.agg(*[c.alias(n) for n, c in _sums().items()]).fillna(0)


def add_metrics(parts: DataFrame) -> DataFrame:
    """Sums of several batches added up."""
    return parts.agg(*[F.sum(n).alias(n) for n in _sums()]).fillna(0)


def latest_events(flat: DataFrame) -> DataFrame:
    """The newest event of each order."""
    return latest_per_key(flat.withColumn("event_time", wall_clock("event_timestamp")), ["order_id"], "event_time")


def unexpired(latest: DataFrame, hours: int = 24) -> DataFrame:
    """Events no older than ``hours`` before the newest event."""
    newest = latest.agg(F.max("event_time").alias("t")).scalar()
    return latest.where(F.col("event_time") > newest - F.make_dt_interval(hours=F.lit(hours)))


def recent_events(flat: DataFrame, n: int = 200) -> DataFrame:
    """The last ``n`` events, newest first."""
    ties = [c for c in flat.columns if c != "event_timestamp"]
    return flat.orderBy(wall_clock("event_timestamp").desc_nulls_last(), *ties).limit(n)


def day_counts(timed: DataFrame) -> DataFrame:
    """Events per tumbling day, those on time and those late apart."""
    return timed.groupBy(F.to_date("event_time").alias("day")).agg(
        F.count_if(~F.col("is_late")).alias("events"), F.count_if("is_late").alias("late_events")
    )


def add_day_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("day").agg(F.sum("events").alias("events"), F.sum("late_events").alias("late_events"))


def late_events(timed: DataFrame) -> DataFrame:
    """The side table of late events."""
    return timed.where("is_late").drop("is_late")
