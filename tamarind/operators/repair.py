"""Imputation and correction of bad values (Q09, Q21-Q30).

Learned constants (medians) are one-row aggregates used as scalar subqueries, so
nothing is collected to the driver and the repair stays one lazy plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions import fixed
from tamarind.functions.predicates import all_present, in_box, is_true, outside
from tamarind.functions.temporal import days_between, plus_days, plus_seconds, seconds_between
from tamarind.operators.aggregates import median, medians, scalar_or
from tamarind.operators.dedupe import majority
from tamarind.operators.joins import attach
from tamarind.operators.windows import with_group_measures


def with_unknown_member(df: DataFrame, key: str, values: Mapping[str, object], unknown: object = "-1") -> DataFrame:
    """Exactly one unknown-member row; applying it twice changes nothing (Q09)."""
    member = df.sparkSession.range(1).select(
        *[F.lit(unknown if f.name == key else values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema]
    )
    return df.where(~F.col(key).eqNullSafe(F.lit(unknown))).unionByName(member)


def fill_group_median(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """Nulls replaced by the median of the row's group; a group without any known
    value keeps its nulls (Q23). Rows without a group form one group."""
    types = dict(df.dtypes)
    learned = with_group_measures(df, [by], {f"__m_{c}": median(c) for c in cols})
    filled = {c: F.coalesce(F.col(c), F.col(f"__m_{c}")).cast(types[c]) for c in cols}
    return learned.withColumns(filled).select(*df.columns)


def rebuild_limit_date(
    items: DataFrame,
    limit: str = "shipping_limit_date",
    approved: str = "order_approved_at",
    purchased: str = "order_purchase_timestamp",
    default_days: int = fixed.DEFAULT_LIMIT_DAYS,
) -> DataFrame:
    """Missing or too early limits rebuilt as approval (else purchase) plus the median
    approval-to-limit days of the valid rows (Q25)."""
    valid = items.where(all_present(limit, approved) & (F.col(limit) >= F.col(approved)))
    days = scalar_or(medians(valid, {"days": days_between(approved, limit)}), default_days).cast("int")
    rebuilt = plus_days(F.coalesce(F.col(approved), F.col(purchased)), days)
    return items.withColumn(limit, F.when(has_bad_limit(limit, approved, purchased), rebuilt).otherwise(F.col(limit)))


def has_bad_limit(
    limit: str = "shipping_limit_date",
    approved: str = "order_approved_at",
    purchased: str = "order_purchase_timestamp",
) -> Column:
    c = F.col(limit)
    return c.isNull() | is_true(c < F.col(purchased)) | is_true(c < F.col(approved))


def fill_milestones(
    orders: DataFrame, status: str = "order_status", defaults: Mapping[str, int] = fixed.DEFAULT_GAPS
) -> DataFrame:
    """Missing milestones of an order derived from its neighbours (Q26).

    The purchase date is walked back from the first later milestone that is known;
    for delivered orders the later milestones are then walked forward. The step
    lengths are the medians of the complete orders.
    """
    bought, approved, carrier, customer = fixed.MILESTONES
    complete = orders.where(all_present(*fixed.MILESTONES, fixed.ESTIMATE))
    learned = medians(
        complete,
        {
            "approval": seconds_between(bought, approved),
            "carrier": seconds_between(approved, carrier),
            "customer": seconds_between(carrier, customer),
            "estimate": seconds_between(bought, fixed.ESTIMATE),
        },
    )
    gap = {name: scalar_or(learned.select(name), default) for name, default in defaults.items()}
    back = {
        approved: gap["approval"],
        carrier: gap["approval"] + gap["carrier"],
        customer: gap["approval"] + gap["carrier"] + gap["customer"],
        fixed.ESTIMATE: gap["estimate"],
    }
    out = orders.withColumn(bought, F.coalesce(F.col(bought), *[plus_seconds(c, -s) for c, s in back.items()]))
    delivered = F.col(status) == "delivered"
    steps = ((bought, approved, "approval"), (approved, carrier, "carrier"), (carrier, customer, "customer"))
    for before, stage, name in steps:
        derived = F.when(delivered, plus_seconds(before, gap[name]))
        out = out.withColumn(stage, F.coalesce(F.col(stage), derived))
    return out


def clamp_chronology(df: DataFrame, stages: Sequence[str] = fixed.MILESTONES) -> DataFrame:
    """No stage earlier than the stage before it; nulls stay null (Q27)."""
    for before, stage in zip(stages, stages[1:]):
        later = F.greatest(F.col(stage), F.col(before))
        df = df.withColumn(stage, F.when(F.col(stage).isNotNull(), later))
    return df


def swap_if_reversed(df: DataFrame, start: str, end: str) -> DataFrame:
    """Pairs in the wrong order are exchanged; a pair with a null is left alone (Q28)."""
    both = all_present(start, end)
    return df.withColumns(
        {
            start: F.when(both, F.least(start, end)).otherwise(F.col(start)),
            end: F.when(both, F.greatest(start, end)).otherwise(F.col(end)),
        }
    )


def fill_answer_time(
    reviews: DataFrame,
    created: str = "review_creation_date",
    answered: str = "review_answer_timestamp",
    purchased: str = "order_purchase_timestamp",
    default_seconds: int = fixed.DEFAULT_RESPONSE_SECONDS,
) -> DataFrame:
    """Missing creation: a week after purchase; missing answer: creation plus the
    median response time (Q29)."""
    known = reviews.where(all_present(created, answered))
    response = scalar_or(medians(known, {"s": seconds_between(created, answered)}), default_seconds)
    return reviews.withColumn(created, F.coalesce(F.col(created), plus_days(purchased, 7))).withColumn(
        answered, F.coalesce(F.col(answered), plus_seconds(created, response))
    )


def fill_review_cascade(
    reviews: DataFrame,
    created: str = "review_creation_date",
    answered: str = "review_answer_timestamp",
    purchased: str = "order_purchase_timestamp",
) -> DataFrame:
    """Creation from purchase, then answer from creation, by the two median steps of
    the complete rows (Q30). Without complete rows nothing is filled."""
    learned = medians(
        reviews.where(all_present(created, answered, purchased)),
        {"wait": seconds_between(purchased, created), "response": seconds_between(created, answered)},
    )
    wait, response = learned.select("wait").scalar(), learned.select("response").scalar()
    return reviews.withColumn(created, F.coalesce(F.col(created), plus_seconds(purchased, wait))).withColumn(
        answered, F.coalesce(F.col(answered), plus_seconds(created, response))
    )


def fill_from_centroid(geo: DataFrame, zip_: str, lat: str, lng: str) -> DataFrame:
    """Coordinates outside the country replaced by the mean of the zip's valid points,
    each axis on its own; a zip without valid points gets null (Q21)."""
    valid = in_box(lat, lng)
    centred = with_group_measures(
        geo, [zip_], {"__lat": F.avg(F.when(valid, F.col(lat))), "__lng": F.avg(F.when(valid, F.col(lng)))}
    )
    return centred.withColumns(
        {
            lat: F.when(outside(lat, fixed.LAT_MIN, fixed.LAT_MAX), F.col("__lat")).otherwise(F.col(lat)),
            lng: F.when(outside(lng, fixed.LNG_MIN, fixed.LNG_MAX), F.col("__lng")).otherwise(F.col(lng)),
        }
    ).select(*geo.columns)


def standardise_by_majority(df: DataFrame, key: str, value: str) -> DataFrame:
    """Every row of a key gets the key's most frequent value (Q22)."""
    winner = majority(df.where(F.col(key).isNotNull()), [key], [value]).withColumnRenamed(value, "__winner")
    return (
        attach(df, winner, key)
        .withColumn(value, F.coalesce(F.col("__winner"), F.col(value)))
        .select(*df.columns)
    )
