"""Exploratory reports as reusable operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions import classify as rule
from tamarind.functions import fixed
from tamarind.functions.numbers import MONEY, share
from tamarind.functions.predicates import any_null, mentions
from tamarind.functions.temporal import days_between, hours_between
from tamarind.operators.aggregates import (
    bottom_1,
    count_by,
    crosstab,
    median,
    mode_table,
    month_counts,
    multiset_label,
    pivot_counts,
    rate,
    share_of_total,
    top_k,
)
from tamarind.operators.dedupe import duplicate_groups
from tamarind.operators.joins import attach, flag_match, full_merge, orphans, with_parent
from tamarind.operators.profiles import quartile_summary
from tamarind.operators.quality import tag
from tamarind.operators.ranged import ordered_lag

LABELS = ("Neutral", "Satisfied", "Unsatisfied")


# --- orders and items ---------------------------------------------------------


def late_magnitude(orders: DataFrame) -> DataFrame:
    """Average and median days of the late orders."""
    late = orders.where(F.col("delivery_status_category") == "Late")
    return late.agg(
        F.round(F.avg("abs_days_diff"), 0).alias("average_delay_days"), median("abs_days_diff").alias("median_delay_days")
    )


def status_matrix(df: DataFrame, status: str, derived: str) -> DataFrame:
    return crosstab(df, status, derived, "row_count")


def performance_distribution(items: DataFrame) -> DataFrame:
    """Seller performance with counts and percentages; null is a row of its own."""
    return share_of_total(items, "seller_performance")


def items_by_status(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items and distinct orders per order status."""
    per_order = items.groupBy("order_id").agg(F.count("order_item_id").alias("items"))
    joined = attach(per_order, orders.select("order_id", "order_status"), "order_id", "inner")
    return joined.groupBy("order_status").agg(
        F.sum("items").alias("total_items"), F.count("order_id").alias("unique_orders")
    )


# --- products -----------------------------------------------------------------


def untranslated_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Categories without a translation and the number of products in each (Q34)."""
    name = "product_category_name"
    return orphans(count_by(products.where(F.col(name).isNotNull()), name, name="product_count"), translation, name)


def translations_mentioning(translation: DataFrame, *words: str) -> DataFrame:
    return translation.where(mentions("product_category_name_english", *words))


def incomplete_product_sales(products: DataFrame, items: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """Sales of products that miss one of ``cols``, with the number of sellers (Q35)."""
    incomplete = products.where(any_null(*cols)).select("product_id", *cols)
    sold = with_parent(items, incomplete, "product_id")
    per_seller = sold.groupBy("product_id", "seller_id").agg(F.count("order_id").alias("n"), F.sum("price").alias("value"))
    per_product = per_seller.groupBy("product_id").agg(
        F.sum("n").alias("times_bought"),
        F.sum("value").cast(MONEY).alias("total_revenue"),
        F.count("seller_id").alias("seller_count"),
    )
    return attach(incomplete, per_product, "product_id").fillna({"times_bought": 0, "seller_count": 0})


def incomplete_product_sellers(products: DataFrame, items: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """The sellers of those products, one row per product and seller: a list per
    product could grow without bound (Q35)."""
    incomplete = products.where(any_null(*cols))
    return with_parent(items, incomplete, "product_id").select("product_id", "seller_id").distinct()


# --- reviews ------------------------------------------------------------------


def repeated_reviews(reviews: DataFrame) -> DataFrame:
    """Consecutive reviews of the same order: hours between them and whether the
    score changed (X05, X06, W05, W06)."""
    several = duplicate_groups(reviews, ["order_id"])
    wanted = with_parent(reviews, several, "order_id").select(
        "order_id", "review_answer_timestamp", "review_score", "review_id"
    )
    lagged = ordered_lag(
        wanted,
        ["order_id"],
        ["review_answer_timestamp", "review_id"],
        {"prev_timestamp": "review_answer_timestamp", "prev_score": "review_score"},
    )
    gaps = lagged.withColumns(
        {
            "hours_between_reviews": hours_between("prev_timestamp", "review_answer_timestamp"),
            "is_score_changed": F.coalesce(F.col("review_score") != F.col("prev_score"), F.lit(False)),
        }
    )
    return gaps.where(F.col("hours_between_reviews").isNotNull())


def score_changes(reviews: DataFrame) -> DataFrame:
    return count_by(repeated_reviews(reviews), "is_score_changed")


_TIMELINE = ("order_delivered_carrier_date", "order_delivered_customer_date", fixed.ESTIMATE, "order_status")


def with_order_timeline(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Reviews beside the milestones of their order."""
    joined = attach(reviews, orders.select("order_id", *_TIMELINE), "order_id", "inner")
    return joined.withColumn(
        "days_after_delivery", days_between("order_delivered_customer_date", "review_creation_date")
    )


def _answered_early() -> Column:
    return F.col("review_answer_timestamp") < F.col("order_delivered_customer_date")


def early_responses(timeline: DataFrame) -> DataFrame:
    """Answers before delivery, split by whether the estimate had passed."""
    early = timeline.where(_answered_early()).withColumn(
        "is_after_estimated", rule.response_timing("review_answer_timestamp", fixed.ESTIMATE)
    )
    gap = days_between(fixed.ESTIMATE, "review_answer_timestamp")
    return early.groupBy("is_after_estimated").agg(F.count("*").alias("row_count"), F.avg(gap).alias("avg_days_diff"))


def scores_of_canceled(timeline: DataFrame) -> DataFrame:
    return count_by(timeline.where(F.col("order_status") == "canceled"), "review_score")


def _kept_waiting(timeline: DataFrame) -> DataFrame:
    """Reviews written after the estimate but before the delivery."""
    return timeline.where(_answered_early() & (F.col("review_answer_timestamp") >= F.col(fixed.ESTIMATE)))


def late_delivery_stars(timeline: DataFrame) -> DataFrame:
    """Rows and share of each score among the reviews of those kept waiting."""
    return share_of_total(_kept_waiting(timeline), "review_score")


def late_delivery_anger(timeline: DataFrame) -> DataFrame:
    """Averages and counts of the reviews of those kept waiting."""
    score = F.col("review_score")
    return _kept_waiting(timeline).agg(
        F.avg(score).alias("average_score"),
        F.count("*").alias("total_count"),
        F.count_if(score <= 2).alias("low_scores_count"),
        F.count_if(score >= 4).alias("high_scores_count"),
    ).withColumn("low_score_percentage", share("low_scores_count", "total_count"))


def score_distribution(reviews: DataFrame, by: str = "review_score") -> DataFrame:
    return share_of_total(reviews, by)


def response_latency(reviews: DataFrame) -> DataFrame:
    """Quartiles of the response days and the share answered on the same day."""
    same_day = reviews.agg(F.round(rate(F.col("is_same_day_response")) * 100, 2).alias("p"))
    return quartile_summary(reviews, "review_response_delay_days").withColumn("same_day_pct", same_day.scalar())


def _dissatisfaction(pivoted: DataFrame) -> DataFrame:
    total = sum((F.col(x) for x in LABELS[1:]), F.col(LABELS[0]))
    return pivoted.withColumn("Total_Reviews", total).withColumn("Unsatisfied_Rate", share("Unsatisfied", "Total_Reviews"))


def category_dissatisfaction(
    reviews: DataFrame, items: DataFrame, products: DataFrame, min_n: int = 50, k: int | None = 10
) -> DataFrame:
    """Categories with the highest share of unsatisfied reviews (X13); ``k=None``
    returns all of them."""
    bridge = attach(
        attach(reviews.select("order_id", "review_label"), items.select("order_id", "product_id"), "order_id", "inner"),
        products.select("product_id", "product_category_name"),
        "product_id",
        "inner",
    )
    rated = _dissatisfaction(pivot_counts(bridge, "product_category_name", "review_label", LABELS))
    busy = rated.where(F.col("Total_Reviews") >= min_n)
    return busy if k is None else top_k(busy, k, "Unsatisfied_Rate", "product_category_name")


def seller_size_satisfaction(reviews: DataFrame, items: DataFrame) -> DataFrame:
    """Review labels by size of seller, measured in reviews received."""
    joined = attach(items.select("order_id", "seller_id"), reviews.select("order_id", "review_label"), "order_id", "inner")
    per_seller = pivot_counts(joined, "seller_id", "review_label", LABELS)
    total = sum((F.col(x) for x in LABELS[1:]), F.col(LABELS[0]))
    sized = per_seller.withColumn("seller_segment", rule.seller_size(total))
    return _dissatisfaction(sized.groupBy("seller_segment").agg(*[F.sum(x).alias(x) for x in LABELS]))


# --- payments -----------------------------------------------------------------


def zero_payments(payments: DataFrame) -> DataFrame:
    """Payments of value zero and of zero installments per type."""
    return payments.groupBy("payment_type").agg(
        F.count_if(F.col("payment_value") == 0).alias("zero_value_rows"),
        F.count_if(F.col("payment_installments") == 0).alias("zero_installment_rows"),
    )


def payment_type_share(payments: DataFrame) -> DataFrame:
    return share_of_total(payments, "payment_type")


def sequence_distribution(payments: DataFrame) -> DataFrame:
    """Rows and mean value per payment sequence."""
    return payments.groupBy("payment_sequential").agg(
        F.count("*").alias("row_count"),
        F.round(F.avg(F.col("payment_value").cast("double")), 2).alias("avg_payment_value"),
    )


def split_orders(payments: DataFrame, min_seq: int) -> DataFrame:
    """Orders whose payment was split at least ``min_seq`` times."""
    return payments.where(F.col("payment_sequential") >= min_seq).select("order_id").distinct()


def split_timelines(payments: DataFrame, min_seq: int) -> DataFrame:
    return with_parent(payments, split_orders(payments, min_seq), "order_id")


def split_orders_by_status(payments: DataFrame, orders: DataFrame, min_seq: int) -> DataFrame:
    found = with_parent(orders, split_orders(payments, min_seq), "order_id")
    return count_by(found, "order_status")


def reconcile(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Amount paid against order cost, over all orders of either side."""
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").cast(MONEY).alias("total_amount_paid"))
    cost = orders.select("order_id", F.col("total_order_cost").alias("total_items_value"))
    variance = (F.col("total_amount_paid") - F.col("total_items_value")).cast(MONEY)
    return full_merge(paid, cost, ["order_id"]).withColumn("variance", variance)


def reconciliation_summary(recon: DataFrame) -> DataFrame:
    v = F.col("variance")
    return recon.agg(
        F.count("*").alias("total_orders"),
        F.count_if(v == 0).alias("perfect_matches"),
        F.count_if(v != 0).alias("numeric_discrepancies"),
        F.count_if(v.isNull()).alias("missing_data"),
    ).withColumn("match_pct", share("perfect_matches", "total_orders"))


def discrepancies(recon: DataFrame) -> DataFrame:
    """Over- and underpaid orders with percentages."""
    off = recon.where(F.col("variance") != 0).withColumn("discrepancy_type", rule.discrepancy_type("variance"))
    return share_of_total(off, "discrepancy_type", count="order_count")


def overpaid(recon: DataFrame) -> DataFrame:
    return recon.where(F.col("variance") > 0)


def overpaid_by_type(recon: DataFrame, payments: DataFrame) -> DataFrame:
    """Overpaid orders and payment rows per payment type."""
    rows = with_parent(payments, overpaid(recon), "order_id")
    per_order = rows.groupBy("payment_type", "order_id").agg(F.count("*").alias("n"))
    return per_order.groupBy("payment_type").agg(
        F.count("order_id").alias("unique_orders"), F.sum("n").alias("total_transaction_rows")
    )


def overpaid_installments(recon: DataFrame, payments: DataFrame) -> DataFrame:
    rows = with_parent(payments, overpaid(recon), "order_id")
    n = F.col("payment_installments")
    return rows.agg(
        F.min(n).alias("min_installments"), F.max(n).alias("max_installments"),
        F.round(F.avg(n), 2).alias("avg_installments"),
    )


def overpaid_by_installments(recon: DataFrame, payments: DataFrame) -> DataFrame:
    rows = with_parent(payments, overpaid(recon), "order_id").select("payment_installments", "order_id").distinct()
    return count_by(rows, "payment_installments", name="unique_orders")


def payment_profiles(recon: DataFrame, payments: DataFrame) -> DataFrame:
    """Combination of payment methods per overpaid order, and how often it occurs."""
    rows = with_parent(payments, overpaid(recon), "order_id")
    methods = multiset_label(rows, ["order_id"], "payment_type", "payment_methods")
    sizes = rows.groupBy("order_id").agg(
        F.max("payment_installments").alias("true_max_installments"), F.count("*").alias("number_of_transactions")
    )
    return attach(methods, sizes, "order_id").groupBy("payment_methods", "true_max_installments").agg(
        F.count("order_id").alias("order_count"), F.sum("number_of_transactions").alias("transaction_count")
    )


def overpaid_by_month(recon: DataFrame, orders: DataFrame) -> DataFrame:
    return month_counts(with_parent(orders, overpaid(recon), "order_id"), "order_purchase_timestamp", "order_count")


def overpaid_by_seller(recon: DataFrame, items: DataFrame) -> DataFrame:
    pairs = with_parent(items, overpaid(recon), "order_id").select("seller_id", "order_id").distinct()
    return count_by(pairs, "seller_id", name="order_count")


def with_variance_pct(recon: DataFrame) -> DataFrame:
    """Discrepant orders with the size of the variance relative to the cost."""
    return recon.where(F.col("variance") != 0).withColumn(
        "variance_percentage",
        F.round(
            F.try_divide(F.abs(F.col("variance")).cast("double") * 100, F.col("total_items_value").cast("double")), 2
        ),
    )


def variance_stats(recon: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Mean, median and mode of the overpayment percentage."""
    pct = with_variance_pct(overpaid(recon))
    mode = mode_table(pct.where(F.col("variance_percentage").isNotNull()), "variance_percentage", 1)
    return pct.agg(
        F.round(F.avg("variance_percentage"), 2).alias("average_percentage"),
        median("variance_percentage", accuracy).alias("median_percentage"),
    ).withColumn("mode_percentage", mode.select("variance_percentage").scalar())


def variance_by_installments(recon: DataFrame, payments: DataFrame) -> DataFrame:
    """Frequency of each overpayment percentage per number of installments."""
    pct = with_variance_pct(overpaid(recon)).select("order_id", "variance_percentage")
    linked = attach(payments.select("order_id", "payment_installments"), pct, "order_id", "inner")
    return crosstab(linked, "variance_percentage", "payment_installments")


def underpayment_profile(recon: DataFrame, payments: DataFrame, min_pct: float = 0.0) -> DataFrame:
    """Underpayments of at least ``min_pct`` percent by type and installments."""
    under = with_variance_pct(recon.where(F.col("variance") < 0)).where(F.col("variance_percentage") >= min_pct)
    linked = attach(
        payments.select("order_id", "payment_type", "payment_installments"),
        under.select("order_id", F.col("variance_percentage").alias("underpayment_percentage")),
        "order_id",
        "inner",
    )
    return count_by(linked, "underpayment_percentage", "payment_type", "payment_installments", name="frequency")


def drill_down(ids: DataFrame, payments: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Everything known about the wanted orders, one row per fact."""
    parts = {
        "payment": (payments, F.col("payment_type"), F.col("payment_value"), F.col("payment_sequential")),
        "item": (items, F.col("product_id"), F.col("price"), F.col("order_item_id")),
        "order": (orders, F.col("order_status"), F.col("total_order_cost"), F.lit(0)),
    }
    rows = [
        with_parent(df, ids, "order_id").select(
            "order_id", F.lit(kind).alias("kind"), position.cast("int").alias("position"), detail.alias("detail"),
            amount.cast(MONEY).alias("amount"),
        )
        for kind, (df, detail, amount, position) in parts.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def unpaid_order_status(recon: DataFrame, orders: DataFrame) -> DataFrame:
    """Status of the orders that miss a payment or a cost."""
    missing = recon.where(F.col("variance").isNull()).select("order_id", "total_amount_paid", "total_items_value")
    return attach(missing, orders.select("order_id", "order_status"), "order_id").groupBy("order_status").agg(
        F.count_if(F.col("total_amount_paid").isNull()).alias("no_payment"),
        F.count_if(F.col("total_items_value").isNull()).alias("no_cost"),
    )


# --- customers ----------------------------------------------------------------


def place_share(customers: DataFrame, key: str) -> DataFrame:
    return share_of_total(customers, key, count="transaction_count")


def customer_loyalty(customers: DataFrame) -> DataFrame:
    """Orders and loyalty segment per unique customer."""
    return customers.groupBy("customer_unique_id").agg(F.count("customer_id").alias("order_count")).withColumn(
        "loyalty_segment", rule.loyalty("order_count")
    )


def elite_customers(loyalty: DataFrame) -> DataFrame:
    return loyalty.where(F.col("loyalty_segment") == "Elite").select("customer_unique_id", "order_count")


def loyalty_share(loyalty: DataFrame) -> DataFrame:
    return share_of_total(loyalty, "loyalty_segment", count="unique_customer_count")


def customers_without_orders(customers: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all customers flagged, the unmatched ones as issues) (Q36)."""
    flagged = flag_match(customers, orders, "customer_id", "has_matching_order")
    unmatched = flagged.where(~F.col("has_matching_order"))
    return flagged, tag(unmatched, fixed.ORPHAN_TRANSACTION)


# --- sellers ------------------------------------------------------------------


def elite_sellers(matrix: DataFrame, min_items: int = 100, min_rate: float = 95.0) -> DataFrame:
    """Sellers with many items, nearly all early or on time."""
    punctual = F.round(F.col("early_ratio") + F.col("on_time_ratio"), 2)
    return matrix.where((F.col("total_items_sold") > min_items) & (punctual > min_rate))


def bottleneck_sellers(matrix: DataFrame, min_items: int = 10, max_late: float = 20.0) -> DataFrame:
    return matrix.where((F.col("total_items_sold") > min_items) & (F.col("late_ratio") > max_late))


def fast_sellers(matrix: DataFrame, max_days: float = -7.0) -> DataFrame:
    return matrix.where(F.col("avg_handling_days") <= max_days)


def group_impact(matrix: DataFrame, group: DataFrame) -> DataFrame:
    """Share of a group of sellers in sellers, items and late items."""
    market = matrix.agg(F.count("*").alias("n"), F.sum("total_items_sold").alias("items"))
    return group.agg(
        F.count("*").alias("seller_count"),
        F.coalesce(F.sum("total_items_sold"), F.lit(0)).alias("items_sold"),
        F.coalesce(F.sum("late_preparations"), F.lit(0)).alias("delayed_items"),
    ).select(
        "seller_count", "items_sold", "delayed_items",
        share("seller_count", market.select("n").scalar()).alias("seller_pct"),
        share("items_sold", market.select("items").scalar()).alias("volume_pct"),
        share("delayed_items", market.select("items").scalar()).alias("delayed_pct"),
    )


def speed_record(matrix: DataFrame, max_days: float = -7.0) -> DataFrame:
    """The fastest seller among the fast ones."""
    return bottom_1(fast_sellers(matrix, max_days), "avg_handling_days", "seller_id")
