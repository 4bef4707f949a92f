"""Aggregation, profile, sort and set queries (A*, O*, U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind.catalog.base import query
from tamarind.catalog.oracle import clean, pct, rnd, sql
from tamarind.functions import fixed
from tamarind.functions.classify import price_bucket
from tamarind.functions.numbers import money, to_number
from tamarind.functions.text import clean_text
from tamarind.operators import aggregates as agg
from tamarind.operators.dedupe import duplicate_groups, duplicate_report, duplicate_rows, keep_first, majority
from tamarind.operators.profiles import (
    column_profile,
    distinct_counts,
    null_profile,
    quartile_summary,
)
from tamarind.operators.quality import count_sheet


@query("conditional_counts", "A01 A04 A05", sql("""
    SELECT l_returnflag, CAST(sum(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END) AS BIGINT) AS taxed,
           CAST(sum(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) AS BIGINT) AS full_price FROM lineitem GROUP BY 1"""))
def _(r):
    return agg.conditional_counts(
        r.table("lineitem"), ["l_returnflag"], {"taxed": F.col("l_tax") > 0.04, "full_price": F.col("l_discount") == 0}
    )


@query("conditional_rate", "A02 A05 A14", sql(f"""
    SELECT o_orderpriority, {rnd("avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)", 4)} AS done_rate,
           {rnd('avg(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE))')} AS avg_price,
           round(min(o_totalprice), 6) AS min_price, round(max(o_totalprice), 6) AS max_price, count(*) AS orders
    FROM orders GROUP BY 1"""))
def _(r):
    price = F.col("o_totalprice")
    return r.table("orders").groupBy("o_orderpriority").agg(
        F.round(agg.rate(F.col("o_orderstatus") == "F"), 4).alias("done_rate"), F.round(F.avg(price), 2).alias("avg_price"),
        F.min(price).alias("min_price"), F.max(price).alias("max_price"), F.count("*").alias("orders"),
    )


@query("group_median", "A06", sql("""
    SELECT l_suppkey, round(quantile_disc(l_extendedprice, 0.5), 6) AS median_price,
           quantile_disc(l_quantity, 0.5) AS median_quantity FROM lineitem GROUP BY 1"""))
def _(r):
    return r.table("lineitem").groupBy("l_suppkey").agg(
        agg.median("l_extendedprice").alias("median_price"), agg.median("l_quantity").alias("median_quantity")
    )


@query("global_medians", "A07 A08", sql("""
    SELECT round(avg(CAST(l_extendedprice <= p AS DOUBLE)), 2) AS price_rank, min(q) AS quantity, min(d) AS discount
    FROM lineitem, (SELECT quantile_disc(l_extendedprice, 0.5) AS p, quantile_disc(l_quantity, 0.5) AS q,
                           quantile_disc(l_discount, 0.5) AS d FROM lineitem)"""))
def _(r):
    measures = {"price": F.col("l_extendedprice"), "quantity": F.col("l_quantity"), "discount": F.col("l_discount")}
    lines = r.table("lineitem")
    middle = agg.medians(lines, measures)
    # the sketch is right up to a rank, so the price is compared by its rank
    below = (F.col("l_extendedprice") <= middle.select("price").scalar()).cast("double")
    return lines.agg(
        F.round(F.avg(below), 2).alias("price_rank"),
        F.first(middle.select("quantity").scalar()).alias("quantity"),
        F.first(middle.select("discount").scalar()).alias("discount"),
    )


@query("above_global_median", "A07", sql("""
    SELECT l_returnflag, count(*) AS lines FROM lineitem
    WHERE l_quantity > (SELECT quantile_disc(l_quantity, 0.5) FROM lineitem) GROUP BY 1"""))
def _(r):
    lines = r.table("lineitem")
    middle = agg.scalar_or(agg.medians(lines, {"q": F.col("l_quantity")}), 0)
    return agg.count_by(lines.where(F.col("l_quantity") > middle), "l_returnflag", name="lines")


@query("collect_sorted", "A10", sql("""
    SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_returnflag) AS flags
    FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) GROUP BY 1"""))
def _(r):
    flags = agg.sorted_values(r.table("lineitem"), ["l_orderkey"], "l_returnflag", "flags")
    return flags.withColumn("flags", F.array_join("flags", ","))


@query("pivot_labels", "A11", sql("""
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
           count(*) FILTER (o_orderstatus = 'X') AS "X" FROM orders GROUP BY 1"""))
def _(r):
    return agg.pivot_counts(r.table("orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "X"])


@query("share_of_total", "A12", sql(f"""
    SELECT event_type, count(*) AS row_count, {pct('count(*)', '(SELECT count(*) FROM events)')} AS percentage
    FROM events GROUP BY 1"""))
def _(r):
    return agg.share_of_total(r.table("events"), "event_type")


@query("majority_value", "A15 W03 Q22", sql("""
    SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (
        PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn FROM events GROUP BY 1, 2) WHERE rn = 1"""))
def _(r):
    return majority(r.table("events"), ["user_id"], ["event_type"])


@query("mode_table", "A16 O01 O03", sql("""
    SELECT l_quantity, count(*) AS frequency FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""))
def _(r):
    return agg.mode_table(r.table("lineitem"), "l_quantity", 15)


@query("crosstab", "A17 X02", sql("""
    SELECT l_returnflag, l_linestatus, count(*) AS frequency FROM lineitem GROUP BY 1, 2"""))
def _(r):
    return agg.crosstab(r.table("lineitem"), "l_returnflag", "l_linestatus")


@query("column_profile", "A19", sql(" UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count({c}) AS row_count, round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS stddev,
           round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM lineitem"""
    for c in ("l_quantity", "l_discount", "l_linenumber"))))
def _(r):
    return column_profile(r.table("lineitem"), ["l_quantity", "l_discount", "l_linenumber"])


@query("quartile_summary", "A20", sql("""
    SELECT round(avg(l_quantity), 6) AS mean, min(l_quantity) AS min, quantile_disc(l_quantity, 0.25) AS p25,
           quantile_disc(l_quantity, 0.5) AS p50, quantile_disc(l_quantity, 0.75) AS p75, max(l_quantity) AS max
    FROM lineitem"""))
def _(r):
    return quartile_summary(r.table("lineitem"), "l_quantity")


_PROFILED = ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_status")


@query("null_profile", "A21 A22", sql(" UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count,
           {pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)')} AS null_pct FROM raw_orders""" for c in _PROFILED)))
def _(r):
    return null_profile(r.role("raw_orders"), _PROFILED)


@query("distinct_before_after", "A18 A23", sql(f"""
    SELECT count(DISTINCT geolocation_city) AS raw, count(DISTINCT {clean('geolocation_city')}) AS cleaned,
           count(DISTINCT geolocation_zip_code_prefix) AS zips FROM raw_geo"""))
def _(r):
    city = F.col("geolocation_city")
    return distinct_counts(
        r.role("raw_geo"), {"raw": city, "cleaned": clean_text(city), "zips": F.col("geolocation_zip_code_prefix")}
    )


@query("sequence_levels", "A24 X17", sql(f"""
    SELECT CAST(payment_sequential AS BIGINT) AS payment_sequential, count(*) AS row_count,
           {rnd('avg(CAST(payment_value AS DOUBLE))')} AS avg_payment_value FROM silver_payments GROUP BY 1"""))
def _(r):
    from tamarind.plans.reports import sequence_distribution

    return sequence_distribution(r.use("payments"))


@query("dup_groups", "A25", sql("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows_in_group FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1"""))
def _(r):
    return duplicate_groups(r.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("month_buckets", "A26", sql("""
    SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS row_count FROM orders GROUP BY 1"""))
def _(r):
    return agg.month_counts(r.table("orders"), "o_orderdate")


@query("topk_categories", "O03", sql("""
    SELECT l_partkey, count(*) AS lines FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""))
def _(r):
    return agg.top_k(agg.count_by(r.table("lineitem"), "l_partkey", name="lines"), 10, "lines", "l_partkey")


@query("record_holder", "O04 O08", sql("""
    SELECT s_suppkey, s_name, round(s_acctbal, 6) AS s_acctbal FROM supplier
    ORDER BY s_acctbal NULLS LAST, s_suppkey LIMIT 1"""))
def _(r):
    return agg.bottom_1(r.table("supplier").select("s_suppkey", "s_name", "s_acctbal"), "s_acctbal", "s_suppkey")


@query("abs_sort_topk", "O05", sql("""
    SELECT order_id, CAST(variance AS DOUBLE) AS variance FROM recon WHERE variance <> 0
    ORDER BY abs(variance) DESC, order_id LIMIT 10"""))
def _(r):
    off = r.recon.where("variance <> 0").select("order_id", "variance")
    return agg.top_k(off, 10, "variance", "order_id", by_size=True)


@query("custom_bucket_order", "O06 V06", sql("""
    SELECT label, count(*) AS orders, CAST(CASE label WHEN 'Under R$50' THEN 0 WHEN 'R$50-100' THEN 1
        WHEN 'R$100-200' THEN 2 WHEN 'R$200-400' THEN 3 WHEN 'Above R$400' THEN 4 ELSE 99 END AS BIGINT) AS sort_order
    FROM (SELECT CASE WHEN v < 50 THEN 'Under R$50' WHEN v < 100 THEN 'R$50-100' WHEN v < 200 THEN 'R$100-200'
                      WHEN v < 400 THEN 'R$200-400' ELSE 'Above R$400' END AS label
          FROM (SELECT CAST(o_totalprice / 1000 AS DECIMAL(18,2)) AS v FROM orders)) GROUP BY label"""))
def _(r):
    order = [label for _, _, label in fixed.PRICE_BUCKET]
    labelled = r.table("orders").select(price_bucket(money(F.col("o_totalprice") / 1000)).alias("label"))
    counts = agg.count_by(labelled, "label", name="orders")
    return counts.withColumn("sort_order", agg.label_rank("label", order)).orderBy("sort_order")


@query("numeric_label_order", "O07", sql("""
    SELECT concat(label, 'x') AS label, count(*) AS lines, TRY_CAST(label AS DOUBLE) AS sort_key
    FROM (SELECT CAST(l_linenumber AS VARCHAR) AS label FROM lineitem) GROUP BY label ORDER BY sort_key"""))
def _(r):
    labels = agg.count_by(
        r.table("lineitem").select(F.col("l_linenumber").cast("string").alias("label")), "label", name="lines"
    )
    ordered = labels.orderBy(agg.numeric_order("label"))
    return ordered.select(F.concat("label", F.lit("x")).alias("label"), "lines", to_number("label").alias("sort_key"))


@query("union_missing_cols", "U01 U02", sql("""
    SELECT kind, count(*) AS row_count, count(c_acctbal) AS with_customer, count(s_acctbal) AS with_supplier FROM (
        SELECT 'customer' AS kind, c_acctbal, NULL AS s_acctbal FROM customer
        UNION ALL SELECT 'supplier', NULL, s_acctbal FROM supplier) GROUP BY kind"""))
def _(r):
    bought = r.table("customer").withColumn("kind", F.lit("customer"))
    sold = r.table("supplier").withColumn("kind", F.lit("supplier"))
    return bought.unionByName(sold, allowMissingColumns=True).groupBy("kind").agg(
        F.count("*").alias("row_count"), F.count("c_acctbal").alias("with_customer"),
        F.count("s_acctbal").alias("with_supplier"),
    )


_SHEET = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("count_sheet", "U03 Q19", sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _SHEET)))
def _(r):
    return count_sheet({t: r.table(t) for t in _SHEET})


@query("dedupe_key", "U05", sql("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1"""))
def _(r):
    lines = r.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return keep_first(lines, ["l_orderkey", "l_linenumber"])


@query("duplicate_ratio", "U07", sql(f"""
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_rows,
           CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows, {pct('(sum(n) - count(*))', 'sum(n)')} AS duplicate_pct
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""))
def _(r):
    return duplicate_report(r.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("except_all_dups", "U04 U06", sql("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) - 1 AS surplus FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1"""))
def _(r):
    surplus = duplicate_rows(r.table("lineitem").select("l_orderkey", "l_linenumber"))
    return surplus.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("surplus"))


@query("histogram20", "X33", sql("""
    SELECT CAST(bin AS BIGINT) AS bin, count(*) AS row_count, round(lo + bin * (hi - lo) / 20, 6) AS bin_start FROM (
        SELECT least(floor((l_extendedprice - lo) * 20 / (hi - lo)), 19) AS bin, lo, hi FROM lineitem,
            (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)) GROUP BY bin, lo, hi"""))
def _(r):
    return agg.histogram(r.table("lineitem"), "l_extendedprice", 20)
