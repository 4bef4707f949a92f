"""Typed, cleaned and deduplicated entities.

Each builder takes bronze-shaped frames and returns :class:`Entity`: the clean
rows and the rows that were rejected or flagged, tagged with a reason. Both are
lazy; writing the clean rows first and reading them back (``Lake.write``) lets
the next builder start from files.

Where rows, rejects and a learned constant come from the same typed rows, these get a
*verdict* in one pass, and ``keep`` stores that pass: bronze is read once, and each part filters that table. It is not dealt into a folder per verdict: for that a writer would
sort all rows, which spills where a task has many.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions import classify as rule
from tamarind.functions import fixed
from tamarind.functions.numbers import MONEY, money, share, volume
from tamarind.functions.predicates import all_present, any_null, in_box
from tamarind.functions.temporal import days_between, hours_between, wall_clock
from tamarind.functions.text import clean_text, label_text, lookup, region_of, state_code, trimmed
from tamarind.operators.aggregates import median
from tamarind.operators.dedupe import earliest_per_key, keep_first, latest_per_key, majority
from tamarind.operators.joins import attach, orphans, with_parent
from tamarind.operators.quality import split, tag
from tamarind.operators.repair import fill_answer_time, fill_group_median, has_bad_limit, rebuild_limit_date
from tamarind.session import stored
from tamarind.sources.tables import without_lineage


class Entity(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def stamped(df: DataFrame, system: str = "MARKETPLACE", version: str = "1.0") -> DataFrame:
    """Audit columns of every silver and staging table."""
    return df.withColumns({"source_system": F.lit(system), "transformation_version": F.lit(version)})


def _all_rejects(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


Keep = Callable[[DataFrame], DataFrame]

VERDICT = "__verdict"
_VALID, _ORPHAN, _BROKEN, _REBUILT = "valid", "orphan", "broken", "rebuilt"
# Stores a judged pass, with its verdicts as a column.
kept_by_verdict: Keep = partial(stored, name="judged")
# Stores the newest reviews, which their median and their repair both read.
kept_newest: Keep = partial(stored, name="newest")


def lazily(judged: DataFrame) -> DataFrame:
    """Store nothing: for a caller that wants one part only."""
    return judged


def _beside_order(child: DataFrame, orders_: DataFrame, *cols: str) -> DataFrame:
    """Children with columns of their order and whether it is known (``__known``)."""
    return attach(child, orders_.select("order_id", *cols, F.lit(True).alias("__known")), "order_id")


def _having(judged: DataFrame, *verdicts: str) -> DataFrame:
    return judged.where(F.col(VERDICT).isin(*verdicts)).drop(VERDICT)


def _typed(df: DataFrame, **casts: Column) -> DataFrame:
    return without_lineage(df).withColumns(casts)


def _as_int(c: str) -> Column:
    return F.col(c).try_cast("int")


def geolocation(raw: DataFrame, accuracy: int = 10_000) -> Entity:
    """One row per zip prefix: majority city and state, median coordinates, region."""
    zip_, lat, lng = "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"
    city, state = "geolocation_city", "geolocation_state"
    points = _typed(
        raw,
        **{
            zip_: _as_int(zip_),
            lat: F.col(lat).try_cast("double"),
            lng: F.col(lng).try_cast("double"),
            city: clean_text(city),
            state: state_code(state),
        },
    ).distinct()
    inside, out = split(points, in_box(lat, lng))
    inside = inside.where(F.col(zip_).isNotNull())
    place = majority(inside, [zip_], [city, state])
    centre = inside.groupBy(zip_).agg(
        median(lat, accuracy).alias("median_latitude"), median(lng, accuracy).alias("median_longitude")
    )
    rows = attach(centre, place, zip_).select(
        F.col(zip_).alias("zip_code_prefix"),
        F.col(city).alias("city"),
        F.col(state).alias("state"),
        region_of(state).alias("region"),
        "median_latitude",
        "median_longitude",
    )
    return Entity(stamped(rows), tag(out, fixed.BAD_COORDINATES))


def _zip_centres(geo: DataFrame) -> DataFrame:
    return geo.select("zip_code_prefix", "median_latitude", "median_longitude")


def customers(raw: DataFrame, geo: DataFrame) -> Entity:
    """Customers with their region and the centre of their zip (E02). Customers
    without a known zip are flagged but kept."""
    base = keep_first(
        _typed(
            raw,
            customer_id=trimmed("customer_id"),
            customer_unique_id=trimmed("customer_unique_id"),
            customer_zip_code_prefix=_as_int("customer_zip_code_prefix"),
            customer_city=clean_text("customer_city"),
            customer_state=state_code("customer_state"),
        ),
        ["customer_id"],
    )
    zip_link = {"customer_zip_code_prefix": "zip_code_prefix"}
    rows = attach(base, _zip_centres(geo), zip_link).select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
        region_of("customer_state").alias("customer_region"), "median_latitude", "median_longitude",
    )
    unmapped = orphans(base, geo, zip_link)
    return Entity(stamped(rows), tag(unmapped, fixed.CUSTOMER_ZIP))


def orders(raw: DataFrame, customers_: DataFrame) -> Entity:
    """Orders with day measures and delivery status (E03). Orders of unknown
    customers are flagged but kept."""
    clocks = {c: wall_clock(c) for c in (*fixed.MILESTONES, fixed.ESTIMATE)}
    typed = _typed(
        raw,
        order_id=trimmed("order_id"),
        customer_id=trimmed("customer_id"),
        order_status=label_text("order_status"),
        **clocks,
    )
    flagged = orphans(typed, customers_, "customer_id")
    bought, approved, carrier, customer = fixed.MILESTONES
    measured = keep_first(typed, ["order_id"]).withColumns(
        {
            "handling_days": days_between(approved, carrier),
            "shipping_days": days_between(carrier, customer),
            "total_lead_time": days_between(bought, customer),
            "days_diff_estimated": days_between(fixed.ESTIMATE, customer),
            "estimated_buffer": days_between(bought, fixed.ESTIMATE),
        }
    )
    rows = measured.select(
        "order_id", "customer_id", "order_status", *fixed.MILESTONES, fixed.ESTIMATE,
        "handling_days", "shipping_days", "total_lead_time", "days_diff_estimated", "estimated_buffer",
        rule.delivery_category().alias("delivery_status_category"),
        rule.delivery_detail().alias("delivery_status_detail"),
        rule.abs_gap("days_diff_estimated").alias("abs_days_diff"),
        rule.on_time_flag("days_diff_estimated").alias("on_time_flag"),
    )
    return Entity(stamped(rows), tag(flagged, fixed.ORDER_CUSTOMER))


_SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
_CATALOG = ("product_name_lenght", "product_description_lenght", "product_photos_qty")


def translations(raw: DataFrame) -> DataFrame:
    name, english = "product_category_name", "product_category_name_english"
    return keep_first(_typed(raw, **{name: label_text(name), english: label_text(english)}), [name])


def products(raw: DataFrame, translation_raw: DataFrame) -> Entity:
    """Products with imputed sizes, English category, volume and flags.

    A missing size takes the median of the category. The English name comes from
    the manual list, then the table, then the default.
    """
    name = "product_category_name"
    typed = keep_first(
        _typed(
            raw,
            product_id=trimmed("product_id"),
            product_category_name=label_text(name),
            **{c: _as_int(c) for c in _CATALOG},
            **{c: money(c) for c in _SIZES},
        ),
        ["product_id"],
    )
    incomplete = typed.where(any_null("product_id", *_SIZES))
    filled = fill_group_median(typed, name, _SIZES).fillna(
        {name: "unknown_category", **{c: 0 for c in _CATALOG}}
    )
    english = F.coalesce(
        lookup(name, fixed.CATEGORY_OVERRIDES), F.col("product_category_name_english"), F.lit("unknown")
    )
    length, height, width = _SIZES[1:]
    measured = attach(filled, translations(translation_raw), name).withColumn(
        "product_volume_cm3", volume(length, height, width)
    )
    rows = measured.select(
        "product_id", name, english.alias("product_category_name_english"), *_CATALOG, *_SIZES, "product_volume_cm3",
        rule.product_size("product_volume_cm3").alias("product_size_category"),
        rule.is_heavy("product_weight_g").alias("heavy_product_flag"),
        rule.is_complete(*_SIZES).alias("logistics_completeness_flag"),
        rule.is_complete(*_CATALOG).alias("catalog_completeness_flag"),
    )
    return Entity(stamped(rows), tag(incomplete, fixed.PRODUCT_FIELDS))


def order_items(raw: DataFrame, orders_: DataFrame, keep: Keep = kept_by_verdict) -> Entity:
    """Items of known orders with a plausible shipping limit and seller timing (E05). They meet
    their order before copies are dropped: by then they are dealt by order."""
    typed = _typed(
        raw,
        order_id=trimmed("order_id"),
        order_item_id=_as_int("order_item_id"),
        product_id=trimmed("product_id"),
        seller_id=trimmed("seller_id"),
        shipping_limit_date=wall_clock("shipping_limit_date"),
        price=money("price"),
        freight_value=money("freight_value"),
    )
    bought, approved, carrier, _ = fixed.MILESTONES
    beside = _beside_order(typed, orders_, bought, approved, carrier, "order_status")
    beside = keep_first(beside, ["order_id", "order_item_id"])
    verdict = F.when(F.col("__known").isNull(), _ORPHAN).when(has_bad_limit(), _REBUILT).otherwise(_VALID)
    judged = keep(beside.withColumn(VERDICT, verdict).drop("__known"))
    rows = (
        rebuild_limit_date(_having(judged, _VALID, _REBUILT))
        .withColumn("seller_handling_days", days_between("shipping_limit_date", carrier))
        .select(
            "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
            "seller_handling_days",
            rule.abs_gap("seller_handling_days").alias("abs_seller_handling"),
            rule.seller_performance().alias("seller_performance"),
        )
    )
    rejects = _all_rejects(
        tag(_having(judged, _ORPHAN), fixed.ITEM_ORDER),
        tag(
            _having(judged, _REBUILT),
            fixed.ITEM_LIMIT,
        ),
    )
    return Entity(stamped(rows), rejects)


def payments(raw: DataFrame, orders_: DataFrame, keep: Keep = lazily) -> Entity:
    """Distinct payments of known orders with category and installment flag (E06). They meet
    their order before copies are dropped: by then they are dealt by order."""
    typed = _typed(
        raw,
        order_id=trimmed("order_id"),
        payment_sequential=_as_int("payment_sequential"),
        payment_type=label_text("payment_type"),
        payment_installments=_as_int("payment_installments"),
        payment_value=money("payment_value"),
    )
    verdict = F.when(F.col("__known").isNull(), _ORPHAN).otherwise(_VALID)
    judged = keep(_beside_order(typed, orders_).distinct().withColumn(VERDICT, verdict).drop("__known"))
    installments = rule.repaired_installments("payment_type", "payment_installments")
    rows = (
        _having(judged, _VALID)
        .withColumn("payment_installments", installments)
        .select(
            "order_id", "payment_sequential", "payment_type",
            rule.payment_category("payment_type").alias("payment_type_category"),
            "payment_installments", "payment_value",
            F.coalesce(rule.in_installments("payment_installments"), F.lit(False)).cast("int")
            .alias("is_installment_payment"),
        )
    )
    return Entity(stamped(rows), tag(_having(judged, _ORPHAN), fixed.PAYMENT_ORDER))


def reviews(
    raw: DataFrame, orders_: DataFrame, keep: Keep = kept_by_verdict, keep_newest: Keep | None = None
) -> Entity:
    """The latest review of each known order, with repaired dates and labels (E07). A caller
    that wants the rows alone stores the newest ones instead of the judged pass."""
    created, answered = "review_creation_date", "review_answer_timestamp"
    typed = _typed(
        raw,
        review_id=trimmed("review_id"),
        order_id=trimmed("order_id"),
        review_score=_as_int("review_score"),
        review_comment_title=trimmed("review_comment_title"),
        review_comment_message=trimmed("review_comment_message"),
        review_creation_date=wall_clock(created),
        review_answer_timestamp=wall_clock(answered),
    )
    usable = all_present("review_id", "order_id", "review_score")
    verdict = F.when(~usable, _BROKEN).when(F.col("__known").isNull(), _ORPHAN).otherwise(_VALID)
    judged = keep(_beside_order(typed, orders_, "order_purchase_timestamp").withColumn(VERDICT, verdict).drop("__known"))
    newest = latest_per_key(
        _having(judged, _VALID).select(
            "review_id", "order_id", "review_score", created, answered, "order_purchase_timestamp"
        ),
        ["order_id"],
        answered,
    )
    rows = fill_answer_time(keep_newest(newest) if keep_newest else newest).select(
        "review_id", "order_id", "review_score", created, answered,
        rule.review_label("review_score").alias("review_label"),
        rule.sentiment("review_score").alias("sentiment_category"),
        days_between(created, answered).alias("review_response_delay_days"),
        hours_between(created, answered).cast(MONEY).alias("review_response_delay_hours"),
        rule.same_day(created, answered).alias("is_same_day_response"),
        (F.col("review_score") <= 2).alias("negative_review_flag"),
        (F.col("review_score") == 3).alias("neutral_review_flag"),
        (F.col("review_score") >= 4).alias("positive_review_flag"),
    )
    rejects = _all_rejects(
        tag(_having(judged, _BROKEN), fixed.REVIEW_KEY),
        tag(_having(judged, _ORPHAN), fixed.REVIEW_ORDER),
    )
    return Entity(stamped(rows), rejects)


_FUNNEL = "MARKETPLACE_MARKETING_FUNNEL"


def qualified_leads(raw: DataFrame) -> Entity:
    """One row per lead, origin defaulting to ``unknown``."""
    typed = _typed(
        raw,
        mql_id=trimmed("mql_id"),
        first_contact_date=wall_clock("first_contact_date"),
        landing_page_id=label_text("landing_page_id"),
        origin=F.coalesce(label_text("origin"), F.lit("unknown")),
    ).select("mql_id", "first_contact_date", "landing_page_id", "origin")
    known, broken = split(typed, F.col("mql_id").isNotNull())
    rows = earliest_per_key(known, ["mql_id"], "first_contact_date")
    return Entity(stamped(rows, _FUNNEL), tag(broken, fixed.LEAD_ID))


_DEAL_LABELS = ("business_segment", "lead_type", "lead_behaviour_profile", "business_type")


def closed_deals(raw: DataFrame) -> Entity:
    """One row per lead and seller with both keys known."""
    typed = _typed(
        raw,
        **{c: trimmed(c) for c in ("mql_id", "seller_id", "sdr_id", "sr_id")},
        won_date=wall_clock("won_date"),
        **{c: label_text(c) for c in _DEAL_LABELS},
        declared_monthly_revenue=money("declared_monthly_revenue"),
    ).select("mql_id", "seller_id", "sdr_id", "sr_id", "won_date", *_DEAL_LABELS, "declared_monthly_revenue")
    known, broken = split(typed, all_present("mql_id", "seller_id"))
    rows = earliest_per_key(known, ["mql_id", "seller_id"], "won_date")
    return Entity(stamped(rows, _FUNNEL), tag(broken, fixed.DEAL_IDS))


def seller_matrix(items: DataFrame) -> DataFrame:
    """Per seller: volumes, timing counts and their percentages.

    Items are first counted per seller and order, so the number of distinct orders
    falls out of the second, much smaller aggregate.
    """
    timing = F.col("seller_performance")
    per_order = items.groupBy("seller_id", "order_id").agg(
        F.count("order_item_id").alias("items"),
        F.count_if(timing == "Early").alias("early"),
        F.count_if(timing == "On Time").alias("on_time"),
        F.count_if(timing.like("Late%")).alias("late"),
        F.sum("seller_handling_days").alias("days"),
        F.count("seller_handling_days").alias("dated"),
    )
    return per_order.groupBy("seller_id").agg(
        F.sum("items").alias("total_items_sold"),
        F.count("order_id").alias("total_unique_orders"),
        F.sum("early").alias("early_preparations"),
        F.sum("on_time").alias("on_time_preparations"),
        F.sum("late").alias("late_preparations"),
        F.round(F.try_divide(F.sum("days"), F.sum("dated")), 2).alias("avg_handling_days"),
    ).withColumns(
        {
            "early_ratio": share("early_preparations", "total_items_sold"),
            "on_time_ratio": share("on_time_preparations", "total_items_sold"),
            "late_ratio": share("late_preparations", "total_items_sold"),
        }
    )


_ACQUISITION = (
    "marketing_origin", "acquisition_source", "business_segment", "lead_type", "lead_behaviour_profile",
    "seller_acquisition_segment",
)
_MATRIX_COUNTS = (
    "total_items_sold", "total_unique_orders", "early_preparations", "on_time_preparations", "late_preparations",
)
_MATRIX_RATES = ("avg_handling_days", "early_ratio", "on_time_ratio", "late_ratio")


def sellers(raw: DataFrame, geo: DataFrame, items: DataFrame, acquisition: DataFrame) -> Entity:
    """Sellers with place, performance matrix and first acquisition."""
    base = keep_first(
        _typed(
            raw,
            seller_id=trimmed("seller_id"),
            seller_zip_code_prefix=_as_int("seller_zip_code_prefix"),
            seller_city=clean_text("seller_city"),
            seller_state=state_code("seller_state"),
        ),
        ["seller_id"],
    )
    zip_link = {"seller_zip_code_prefix": "zip_code_prefix"}
    first_deal = earliest_per_key(
        acquisition.where(F.col("seller_id").isNotNull()).select(
            "seller_id", "won_date", *_ACQUISITION, "days_to_convert", "converted_flag"
        ),
        ["seller_id"],
        "won_date",
    ).drop("won_date")
    placed = attach(base, _zip_centres(geo), zip_link)
    enriched = attach(attach(placed, seller_matrix(items), "seller_id"), first_deal, "seller_id")
    rows = enriched.fillna(
        {
            **{c: 0 for c in _MATRIX_COUNTS},
            **{c: 0.0 for c in _MATRIX_RATES},
            **{c: "Not Tracked" for c in _ACQUISITION},
            "days_to_convert": -1,
            "converted_flag": False,
        }
    ).select(
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
        region_of("seller_state").alias("seller_region"), "median_latitude", "median_longitude",
        *_MATRIX_COUNTS, *_MATRIX_RATES, (F.col("total_items_sold") > 0).alias("has_sales"),
        *_ACQUISITION[:-1], "days_to_convert", "converted_flag", _ACQUISITION[-1],
    )
    unmapped = orphans(base, geo, zip_link)
    return Entity(stamped(rows), tag(unmapped, fixed.SELLER_ZIP))
