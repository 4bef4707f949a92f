"""Per-key and neighbour queries (W*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind.catalog.base import query
from tamarind.catalog.oracle import rnd, sql
from tamarind.functions.classify import growth_category, growth_rate
from tamarind.functions.temporal import hours_between
from tamarind.operators.dedupe import earliest_per_key, latest_per_key
from tamarind.operators.ranged import ordered_lag
from tamarind.operators.repair import fill_group_median
from tamarind.operators.windows import group_count, group_median, previous_active, with_group_measures

_EVENT = "event_id, user_id, event_type, round(value, 6) AS value, CAST(ts AS VARCHAR) AS ts"


@query("latest_per_key", "W01 O08", sql(f"""SELECT {_EVENT} FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1"""))
def _(r):
    return latest_per_key(r.table("events").drop("props"), ["user_id"], "ts")


@query("earliest_per_key", "W02 O08", sql(f"""SELECT {_EVENT} FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY ts NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1"""))
def _(r):
    return earliest_per_key(r.table("events").drop("props"), ["user_id", "event_type"], "ts")


@query("lag_growth", "W04 C26 C28", sql("""
    SELECT *, CASE WHEN is_new THEN 'New Seller' WHEN rate >= 0.5 THEN 'High Growth' WHEN rate >= 0.1
        THEN 'Moderate Growth' WHEN rate <= -0.1 THEN 'Declining' ELSE 'Stable' END AS category
    FROM (SELECT *, previous IS NULL AS is_new, round(CAST(orders - previous AS DOUBLE) / previous, 6) AS rate FROM (
        SELECT *, lag(orders) OVER (PARTITION BY o_custkey ORDER BY month) AS previous FROM (
            SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders FROM orders GROUP BY 1, 2)))"""))
def _(r):
    monthly = r.table("orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("orders")
    )
    lagged = previous_active(monthly, ["o_custkey"], ["month"], {"previous": "orders"})
    rated = lagged.withColumns({"is_new": F.col("previous").isNull(), "rate": growth_rate("orders", "previous")})
    return rated.withColumn("category", growth_category("is_new", "rate"))


@query("gap_hours", "W05", sql(f"""
    SELECT event_id, user_id, {rnd("(epoch(date_trunc('second', ts)) - epoch(date_trunc('second', before))) / 3600")}
        AS hours_since, event_type FROM (
        SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)"""))
def _(r):
    events = r.table("events").select("event_id", "user_id", "event_type", "ts")
    lagged = ordered_lag(events, ["user_id"], ["ts", "event_id"], {"before": "ts"}, distinct=True)
    return lagged.select("event_id", "user_id", hours_between("before", "ts").alias("hours_since"), "event_type")


@query("change_flag", "W06", sql("""
    SELECT event_id, user_id, coalesce(event_type <> lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id),
        false) AS is_changed FROM events"""))
def _(r):
    events = r.table("events").select("event_id", "user_id", "event_type", "ts")
    lagged = ordered_lag(events, ["user_id"], ["ts", "event_id"], {"before": "event_type"}, distinct=True)
    changed = F.coalesce(F.col("event_type") != F.col("before"), F.lit(False))
    return lagged.select("event_id", "user_id", changed.alias("is_changed"))


_LINE = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey"


@query("count_over_pair", "W07", sql(f"""
    SELECT {_LINE}, count(*) OVER (PARTITION BY l_orderkey, l_suppkey) AS lines_of_supplier FROM lineitem"""))
def _(r):
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return group_count(lines, ["l_orderkey", "l_suppkey"], "lines_of_supplier")


@query("sum_over_key", "W08", sql(f"""
    SELECT {_LINE}, k, CAST(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY k) AS BIGINT) AS key_quantity
    FROM (SELECT *, CAST(nullif(l_suppkey % 23, 3) AS BIGINT) AS k FROM lineitem)"""))
def _(r):
    # few keys, all of them hot, and one of them null
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    keyed = lines.withColumn("k", F.nullif(F.col("l_suppkey") % 23, F.lit(3)))
    total = {"key_quantity": F.sum(F.col("l_quantity").cast("long"))}
    return with_group_measures(keyed, ["k"], total, salted=True, rows_per_task=1_000).drop("l_quantity")


@query("median_over_key", "W09", sql("""
    SELECT p_partkey, p_type, CAST(p_size AS BIGINT) AS p_size,
           CAST(quantile_disc(p_size, 0.5) OVER (PARTITION BY p_type) AS BIGINT) AS median_p_size FROM part"""))
def _(r):
    return group_median(r.table("part").select("p_partkey", "p_type", "p_size"), ["p_type"], ["p_size"])


@query("impute_group_median", "W09 Q23", sql("""
    SELECT product_id, product_category_name, CAST(coalesce(product_weight_g, w) AS BIGINT) AS product_weight_g,
           CAST(coalesce(product_length_cm, l) AS BIGINT) AS product_length_cm
    FROM raw_products LEFT JOIN (
        SELECT product_category_name AS c, quantile_disc(product_weight_g, 0.5) AS w,
               quantile_disc(product_length_cm, 0.5) AS l FROM raw_products GROUP BY 1)
        ON product_category_name IS NOT DISTINCT FROM c"""))
def _(r):
    raw = r.role("raw_products").select("product_id", "product_category_name", "product_weight_g", "product_length_cm")
    return fill_group_median(raw, "product_category_name", ["product_weight_g", "product_length_cm"])
