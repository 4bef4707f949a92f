"""Business classifiers as pure column expressions.

Most rules are bands over one measure: a table of (comparison, bound, label)
steps from :mod:`tamarind.functions.fixed`, applied by :func:`band`. Thresholds
are data, so a caller can pass its own table.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarind.functions import fixed
from tamarind.functions.predicates import all_present, is_true
from tamarind.functions.temporal import days_between
from tamarind.functions.text import as_col, lookup

_COMPARE = {"<": operator.lt, "<=": operator.le, "==": operator.eq, ">=": operator.ge, ">": operator.gt}

Steps = Sequence[tuple[str, float, str]]


def band(measure: str | Column, steps: Steps, otherwise: str | Column | None = None) -> Column:
    """Label of the first step whose comparison holds, else ``otherwise``."""
    measure = as_col(measure)
    tests = [(_COMPARE[op](measure, bound), label) for op, bound, label in steps]
    out = F.when(*tests[0])
    for test, label in tests[1:]:
        out = out.when(test, label)
    return out if otherwise is None else out.otherwise(otherwise)


def lifecycle(
    status: str | Column,
    day_gap: str | Column,
    *,
    late: str = "Late",
    undated: str | None = "Unknown",
    otherwise: str = "Unknown",
    in_progress: Sequence[str] = fixed.IN_PROGRESS,
) -> Column:
    """Outcome of an order or item: terminal status first, then the day gap.

    One rule serves delivery status (C01, C03) and seller performance (C06):
    they differ only in the label for a late outcome and for a delivered row
    without a gap.
    """
    status = as_col(status)
    dated = band(day_gap, (("<", 0, "Early"), ("==", 0, "On Time"), (">", 0, late)), F.lit(undated).cast("string"))
    return (
        F.when(status == "canceled", "Canceled")
        .when(status == "unavailable", "Unavailable")
        .when(status.isin(*in_progress), "In Progress")
        .when(status == "delivered", dated)
        .otherwise(otherwise)
    )


def delivery_category(status: str = "order_status", gap: str = "days_diff_estimated") -> Column:
    return lifecycle(status, gap)


def delivery_detail(gap: str = "days_diff_estimated", status: str = "order_status") -> Column:
    return band(gap, fixed.DELIVERY_DETAIL, F.initcap(F.col(status)))


def delivery_detail_refined(status: str = "order_status", gap: str = "days_diff_estimated") -> Column:
    return lifecycle(status, gap, undated=None, otherwise="Other")


def seller_performance(status: str = "order_status", gap: str = "seller_handling_days") -> Column:
    return lifecycle(status, gap, late="Late Delivery to Carrier")


def seller_performance_refined(status: str = "order_status", gap: str = "seller_handling_days") -> Column:
    still_open = [s for s in fixed.IN_PROGRESS if s != "invoiced"]
    return lifecycle(status, gap, late="Late Delivery to Carrier", undated="Unfulfilled", in_progress=still_open)


def on_time_flag(gap: str | Column) -> Column:
    """1 when not late; an unknown gap counts as 0."""
    return is_true(as_col(gap) <= 0).cast("int")


def abs_gap(gap: str, status: str | None = None) -> Column:
    """Size of the gap; with ``status``, only for delivered rows."""
    size = F.abs(F.col(gap))
    return size if status is None else F.when(F.col(status) == "delivered", size)


def product_size(volume: str | Column) -> Column:
    return band(volume, fixed.PRODUCT_SIZE, "Unknown")


def parcel_size(volume: str | Column) -> Column:
    """Parcel band; a missing volume falls into the last band, as a missing test does."""
    return band(volume, fixed.PARCEL_SIZE, "Large Parcel")


def parcel_weight(weight: str | Column) -> Column:
    return band(weight, fixed.PARCEL_WEIGHT, "Heavyweight")


def is_heavy(weight: str | Column, limit: float = 10000) -> Column:
    return is_true(as_col(weight) >= limit)


def is_complete(*cols: str) -> Column:
    return all_present(*cols)


def payment_category(payment_type: str | Column) -> Column:
    return lookup(payment_type, fixed.PAYMENT_CATEGORY, "Other")


def repaired_installments(payment_type: str, installments: str) -> Column:
    """A card payment always has at least one installment."""
    return F.when(
        (F.col(payment_type) == "credit_card") & (F.col(installments) == 0), F.lit(1)
    ).otherwise(F.col(installments))


def in_installments(n: str | Column) -> Column:
    return as_col(n) > 1


def review_label(score: str | Column) -> Column:
    return band(score, fixed.REVIEW_LABEL, "Unsatisfied")


def sentiment(score: str | Column) -> Column:
    return band(score, fixed.SENTIMENT, "Negative")


def sentiment_band(label: str | Column) -> Column:
    return lookup(label, fixed.SENTIMENT_BAND, "Unknown")


def same_day(start: str, end: str) -> Column:
    return days_between(start, end) == 0


def acquisition_segment(converted: str, days: str) -> Column:
    speed = band(days, fixed.CONVERSION_SPEED, "Unknown Conversion")
    return F.when(~F.col(converted), "Not Converted").otherwise(speed)


def several(n: str | Column) -> Column:
    """More than one, e.g. sellers in an order."""
    return as_col(n) > 1


def distance_bucket(region_a: str, region_b: str) -> Column:
    same = F.col(region_a) == F.col(region_b)
    return F.when(same, "Same Region").when(~same, "Cross Region").otherwise("Unknown")


def late_and_unhappy(delay: str, score: str) -> Column:
    return (F.col(delay) > 0) & (F.col(score) <= 3)


def experience_segment(delay: str, score: str) -> Column:
    happy = (F.col(delay) <= 0) & (F.col(score) >= 4)
    return (
        F.when(happy, "Good Experience")
        .when(late_and_unhappy(delay, score), "Delivery Impacted Review")
        .otherwise("Mixed Experience")
    )


def workload_bucket(orders: str | Column) -> Column:
    return band(orders, fixed.WORKLOAD, "Low Volume")


def is_high_workload(bucket: str | Column) -> Column:
    return as_col(bucket).isin("High Volume", "Overloaded")


def growth_rate(now: str, before: str) -> Column:
    """Relative change, null when there is no earlier value or it is zero."""
    return F.try_divide((F.col(now) - F.col(before)).cast("double"), F.col(before).cast("double"))


def growth_category(is_new: str, rate: str) -> Column:
    return F.when(F.col(is_new), "New Seller").otherwise(band(rate, fixed.GROWTH, "Stable"))


def on_time_grade(rate: str | Column) -> Column:
    return band(rate, fixed.ON_TIME_GRADE, "Poor")


def location_type(city: str, state: str) -> Column:
    return (
        F.when(F.col(city).isin(*fixed.METRO_CITIES), "Metropolitan")
        .when(F.col(state).isin(*fixed.URBAN_STATES), "Urban")
        .otherwise("Regional")
    )


def delivery_group(category: str | Column) -> Column:
    return lookup(category, fixed.DELIVERY_GROUP, "Other")


def is_high_ticket(value: str | Column, limit: float = 500) -> Column:
    return as_col(value) >= limit


def is_high_freight(freight_ratio: str | Column, limit: float = 0.30, inclusive: bool = False) -> Column:
    """The sales fact excludes the limit, the fulfilment fact includes it."""
    c = as_col(freight_ratio)
    return c >= limit if inclusive else c > limit


def price_bucket(price: str | Column) -> Column:
    return band(price, fixed.PRICE_BUCKET)


def freight_bucket(freight: str | Column) -> Column:
    return band(freight, fixed.FREIGHT_BUCKET)


def loyalty(orders: str | Column) -> Column:
    return band(orders, fixed.LOYALTY, "Elite")


def seller_size(reviews: str | Column) -> Column:
    return band(reviews, fixed.SELLER_SIZE)


def payment_status(paid: str, variance: str) -> Column:
    return F.when(F.col(paid).isNull(), "no payment record").otherwise(
        band(variance, ((">", 0, "overpaid"), ("<", 0, "underpaid")), "matched")
    )


def discrepancy_type(variance: str | Column) -> Column:
    return band(variance, ((">", 0, "Overpayment (Paid > Cost)"),), "Underpayment (Paid < Cost)")


def response_timing(answer: str, estimate: str) -> Column:
    return F.when(F.col(answer) >= F.col(estimate), "Yes (After Estimated)").otherwise(
        "No (Before Estimated - Anomaly)"
    )
