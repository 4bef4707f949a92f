"""The refined lineage: entities whose broken rows are repaired instead of rejected.

Children of unknown parents follow a policy: ``rekey`` hands them to the unknown member
``-1``, ``drop`` leaves them out. Tables are built in the order of :func:`build_refined`,
each from stored ones.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions import classify as rule
from tamarind.functions import fixed
from tamarind.functions.numbers import MONEY, money, volume
from tamarind.functions.temporal import days_between, wall_clock
from tamarind.functions.text import clean_text, label_text, region_of, state_code, trimmed
from tamarind.operators import repair
from tamarind.operators.dedupe import keep_first, latest_per_key
from tamarind.operators.joins import attach, rekey_orphans, with_parent
from tamarind.session import stored
from tamarind.sources.tables import Lake, without_lineage

UNKNOWN = "-1"
_SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def settled(child: DataFrame, parent: DataFrame, on: str | Mapping[str, str], policy: str) -> DataFrame:
    """Children of unknown parents, by policy (Q06, Q07)."""
    if policy not in ("drop", "rekey"):
        raise ValueError(f"unknown orphan policy: {policy}")
    return with_parent(child, parent, on) if policy == "drop" else rekey_orphans(child, parent, on, UNKNOWN)


def geolocation(raw: DataFrame) -> DataFrame:
    """Distinct points; places outside the country moved to the centre of their zip, one
    spelling of the city per zip, and the unknown member."""
    points = without_lineage(raw).select(
        trimmed("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").try_cast("double").alias("latitude"),
        F.col("geolocation_lng").try_cast("double").alias("longitude"),
        clean_text("geolocation_city").alias("city"),
        state_code("geolocation_state").alias("state"),
    ).distinct()
    moved = repair.fill_from_centroid(points, "zip_code_prefix", "latitude", "longitude")
    spelled = repair.standardise_by_majority(moved, "zip_code_prefix", "city").distinct()
    placed = spelled.withColumn("region", region_of("state"))
    return repair.with_unknown_member(placed, "zip_code_prefix", {"city": "unknown", "state": "XX", "region": "Unknown"}, UNKNOWN)


def customers(raw: DataFrame, geo: DataFrame, policy: str = "rekey") -> DataFrame:
    """Customers with a known or the unknown zip, and the unknown member."""
    typed = without_lineage(raw).select(
        trimmed("customer_id").alias("customer_id"),
        trimmed("customer_unique_id").alias("customer_unique_id"),
        trimmed("customer_zip_code_prefix").alias("zip_code_prefix"),
        clean_text("customer_city").alias("customer_city"),
        state_code("customer_state").alias("customer_state"),
    )
    placed = settled(keep_first(typed, ["customer_id"]), geo, "zip_code_prefix", policy)
    members = placed.withColumn("customer_region", region_of("customer_state"))
    unknown = {
        "customer_unique_id": UNKNOWN, "zip_code_prefix": UNKNOWN, "customer_city": "unknown",
        "customer_state": "XX", "customer_region": "Unknown",
    }
    return repair.with_unknown_member(members, "customer_id", unknown, UNKNOWN)


def sellers(raw: DataFrame, geo: DataFrame, policy: str = "rekey") -> DataFrame:
    """Sellers with a known or the unknown zip, and the unknown member."""
    typed = without_lineage(raw).select(
        trimmed("seller_id").alias("seller_id"),
        trimmed("seller_zip_code_prefix").alias("zip_code_prefix"),
        clean_text("seller_city").alias("seller_city"),
        state_code("seller_state").alias("seller_state"),
    )
    placed = settled(keep_first(typed, ["seller_id"]), geo, "zip_code_prefix", policy)
    unknown = {"zip_code_prefix": UNKNOWN, "seller_city": "unknown", "seller_state": "XX"}
    return repair.with_unknown_member(placed, "seller_id", unknown, UNKNOWN)


_UNKNOWN_ORDER = {"customer_id": UNKNOWN, "order_status": "unknown", "delivery_status": "Other"}


def orders(raw: DataFrame, customers_: DataFrame, policy: str = "rekey") -> DataFrame:
    """Orders with every derivable milestone filled, in order of time, and judged anew."""
    clocks = {c: wall_clock(c) for c in (*fixed.MILESTONES, fixed.ESTIMATE)}
    typed = without_lineage(raw).withColumns(
        {
            "order_id": trimmed("order_id"),
            "customer_id": trimmed("customer_id"),
            "order_status": label_text("order_status"),
            **clocks,
        }
    )
    known = settled(keep_first(typed, ["order_id"]), customers_, "customer_id", policy)
    timed = repair.clamp_chronology(repair.fill_milestones(known))
    gap = days_between(fixed.ESTIMATE, fixed.MILESTONES[-1])
    judged = timed.withColumn("days_diff_estimated", gap).select(
        "order_id", "customer_id", "order_status", *fixed.MILESTONES, fixed.ESTIMATE, "days_diff_estimated",
        rule.delivery_detail_refined().alias("delivery_status"),
        rule.abs_gap("days_diff_estimated", "order_status").alias("abs_days_diff"),
    )
    return repair.with_unknown_member(judged, "order_id", _UNKNOWN_ORDER, UNKNOWN)


def products(raw: DataFrame) -> DataFrame:
    """Products with sizes from their category's median, else -1, parcel bands, and the
    unknown member."""
    name = "product_category_name"
    typed = without_lineage(raw).select(
        trimmed("product_id").alias("product_id"), label_text(name).alias(name), *[money(c).alias(c) for c in _SIZES]
    )
    filled = repair.fill_group_median(keep_first(typed, ["product_id"]), name, _SIZES)
    filled = filled.fillna({name: "unknown_category"}).withColumns(
        {c: F.coalesce(F.col(c), F.lit(-1).cast(MONEY)) for c in _SIZES}
    )
    measured = filled.withColumn("product_volume_cm3", F.when(F.least(*_SIZES[1:]) >= 0, volume(*_SIZES[1:])).otherwise(-1).cast(MONEY))
    banded = measured.withColumns(
        {
            "logistics_size_category": rule.parcel_size("product_volume_cm3"),
            "logistics_weight_category": rule.parcel_weight("product_weight_g"),
        }
    )
    unknown = {
        name: "unknown_category", **{c: -1 for c in (*_SIZES, "product_volume_cm3")},
        "logistics_size_category": "Unknown Size", "logistics_weight_category": "Unknown Weight",
    }
    return repair.with_unknown_member(banded, "product_id", unknown, UNKNOWN)


def _dated(items: DataFrame, orders_: DataFrame, policy: str) -> DataFrame:
    """Items with times and status of their order; one join tells both whether the order is
    known and when it was. Orphans get what the unknown order has, or are dropped."""
    bought, approved, carrier, _ = fixed.MILESTONES
    known = orders_.select("order_id", bought, approved, carrier, "order_status", F.lit(True).alias("__known"))
    if policy == "drop":
        return attach(items, known, "order_id", "inner").drop("__known")
    joined = attach(items, known, "order_id")
    missing = F.col("__known").isNull()
    return joined.withColumns(
        {
            "order_id": F.when(missing, UNKNOWN).otherwise(F.col("order_id")),
            "order_status": F.when(missing, _UNKNOWN_ORDER["order_status"]).otherwise(F.col("order_status")),
        }
    ).drop("__known")


def order_items(
    raw: DataFrame, orders_: DataFrame, products_: DataFrame, sellers_: DataFrame, policy: str = "rekey"
) -> DataFrame:
    """Items with known or unknown parents, plausible limits and seller timing."""
    typed = without_lineage(raw).select(
        trimmed("order_id").alias("order_id"),
        F.col("order_item_id").try_cast("int").alias("order_item_id"),
        trimmed("product_id").alias("product_id"),
        trimmed("seller_id").alias("seller_id"),
        wall_clock("shipping_limit_date").alias("shipping_limit_date"),
        money("price").alias("price"),
        money("freight_value").alias("freight_value"),
    )
    # one row per item before the key may become the unknown one
    items = keep_first(typed, ["order_id", "order_item_id"])
    for parent, key in ((products_, "product_id"), (sellers_, "seller_id")):
        items = settled(items, parent, key, policy)
    # stored, because the median and the rows both come from it
    carrier = fixed.MILESTONES[2]
    dated = stored(_dated(items, orders_, policy), "refined_items")
    rebuilt = repair.rebuild_limit_date(dated).withColumn("seller_handling_days", days_between("shipping_limit_date", carrier))
    return rebuilt.select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
        "seller_handling_days", rule.seller_performance_refined().alias("seller_performance"),
    )


def payments(raw: DataFrame, orders_: DataFrame, policy: str = "rekey") -> DataFrame:
    """Distinct payments of known or the unknown order, installments repaired."""
    typed = without_lineage(raw).select(
        trimmed("order_id").alias("order_id"),
        F.col("payment_sequential").try_cast("int").alias("payment_sequential"),
        label_text("payment_type").alias("payment_type"),
        F.col("payment_installments").try_cast("int").alias("payment_installments"),
        money("payment_value").alias("payment_value"),
    ).distinct()
    repaired = rule.repaired_installments("payment_type", "payment_installments")
    return settled(typed, orders_, "order_id", policy).withColumn("payment_installments", repaired)


def reviews(raw: DataFrame, orders_: DataFrame, policy: str = "rekey") -> DataFrame:
    """The latest review of each order; dates derived from the purchase, reversed pairs
    exchanged."""
    created, answered = "review_creation_date", "review_answer_timestamp"
    typed = without_lineage(raw).select(
        trimmed("review_id").alias("review_id"),
        trimmed("order_id").alias("order_id"),
        F.col("review_score").try_cast("int").alias("review_score"),
        wall_clock(created).alias(created),
        wall_clock(answered).alias(answered),
    )
    newest = latest_per_key(typed.dropna(subset=["review_id", "order_id", "review_score"]), ["order_id"], answered)
    dated = attach(settled(newest, orders_, "order_id", policy), orders_.select("order_id", "order_purchase_timestamp"), "order_id")
    filled = repair.swap_if_reversed(repair.fill_review_cascade(dated), created, answered)
    return filled.select(
        "review_id", "order_id", "review_score", created, answered,
        rule.review_label("review_score").alias("review_label"),
        days_between(created, answered).alias("review_response_days"),
    )


# Builder of each table and the tables that it starts from, in order of dependency.
_BUILDERS = {
    "geolocation": (geolocation, ()),
    "customers": (customers, ("geolocation",)),
    "sellers": (sellers, ("geolocation",)),
    "orders": (orders, ("customers",)),
    "products": (products, ()),
    "order_items": (order_items, ("orders", "products", "sellers")),
    "order_payments": (payments, ("orders",)),
    "order_reviews": (reviews, ("orders",)),
}


def build_refined(
    lake: Lake, bronze: Mapping[str, DataFrame], policy: str = "rekey", only: Collection[str] = tuple(_BUILDERS)
) -> dict[str, DataFrame]:
    """The tables of ``only``, by default all eight, and those that they start from, written
    in order of dependency."""
    needed = set(only)
    for name, (_, parents) in reversed(_BUILDERS.items()):
        if name in needed:
            needed.update(parents)
    out: dict[str, DataFrame] = {}
    for name, (build, parents) in _BUILDERS.items():
        if name in needed:
            given = [bronze[name], *(out[p] for p in parents)]
            out[name] = lake.write(build(*given, policy) if parents else build(*given), name)
    return out
