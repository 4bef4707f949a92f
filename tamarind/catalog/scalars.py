"""Projection, predicate and scalar-function queries (P*, F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind.catalog.base import query
from tamarind.catalog.oracle import clean, pct, region, rnd, sql
from tamarind.functions import fixed
from tamarind.functions import predicates as test
from tamarind.functions.numbers import money, ratio, share, to_number, volume
from tamarind.functions.temporal import (
    clock_label,
    date_key,
    days_between,
    hours_between,
    month_label,
    plus_days,
    plus_seconds,
    wall_clock,
)
from tamarind.functions.text import (
    clean_text,
    label_text,
    mask_id,
    region_of,
    state_code,
    state_name,
    strip_prefix,
    titled,
)
from tamarind.operators.quality import split
from tamarind.plans.silver import stamped
from tamarind.sources.tables import enforce_types, unique_columns, with_lineage, without_lineage


@query("clean_text_lang", "F01 F02 F03", sql(f"""
    SELECT doc_id, lang, md5({clean('text')}) AS cleaned_md5,
           CAST(length({clean('text')}) AS BIGINT) AS cleaned_length FROM documents"""))
def _(r):
    return r.table("documents").select(
        "doc_id", "lang", F.md5(clean_text("text")).alias("cleaned_md5"), F.length(clean_text("text")).alias("cleaned_length")
    )


_CODES = "SP RJ MG ES PR SC RS GO MT MS DF BA PE CE PB RN AL SE PI MA AM PA AC RO XX"


def _coded(r):
    codes = F.split(F.lit(_CODES), " ")
    return r.table("customer").withColumn("state", F.lower(F.element_at(codes, F.col("c_nationkey") + 1)))


_CODED = f"(SELECT *, lower(split_part('{_CODES}', ' ', c_nationkey + 1)) AS state FROM customer)"


@query("map_lookup_region", "F04 F05 F07", sql(f"""
    SELECT {region('upper(state)')} AS region, count(*) AS customers FROM {_CODED} GROUP BY 1"""))
def _(r):
    return _coded(r).groupBy(region_of(state_code("state")).alias("region")).agg(F.count("*").alias("customers"))


@query("map_lookup_keep", "F06", sql(f"""
    SELECT c_custkey, CASE upper(state) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.STATE_NAME.items())}
        ELSE upper(state) END AS state_name FROM {_CODED}"""))
def _(r):
    return _coded(r).select("c_custkey", state_name(state_code("state")).alias("state_name"))


@query("date_keys", "F14 F15 F16", sql("""
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key,
           strftime(o_orderdate, '%Y-%m') AS month, CAST(year(o_orderdate) AS BIGINT) AS y,
           CAST(month(o_orderdate) AS BIGINT) AS m,
           CAST(strftime(nullif(o_orderdate, TIMESTAMP '1995-01-01'), '%Y%m%d') AS BIGINT) AS null_safe_key
    FROM orders"""))
def _(r):
    ts = F.col("o_orderdate")
    known = F.nullif(ts, F.lit("1995-01-01").cast("timestamp_ntz"))
    return r.table("orders").select(
        "o_orderkey", date_key(ts).alias("date_key"), month_label(ts).alias("month"), F.year(ts).alias("y"),
        F.month(ts).alias("m"), date_key(known).alias("null_safe_key"),
    )


@query("date_arithmetic", "F09 F10 F11 F12 F13 F30", sql(f"""
    SELECT order_id, CAST(date_diff('day', order_approved_at, order_delivered_customer_date) AS BIGINT) AS days,
           {rnd('(epoch(order_delivered_customer_date) - epoch(order_approved_at)) / 3600')} AS hours,
           CAST(CAST(CAST(order_approved_at AS DATE) + 7 AS TIMESTAMP) AS VARCHAR) AS week_later,
           CAST(order_approved_at + INTERVAL '90' MINUTE AS VARCHAR) AS later,
           strftime(order_approved_at, '%H:%M:%S') AS clock,
           CAST(TRY_CAST(concat(order_id, '-', CAST(order_approved_at AS VARCHAR)) AS TIMESTAMP) AS VARCHAR) AS bad_text
    FROM raw_orders"""))
def _(r):
    a, b = "order_approved_at", "order_delivered_customer_date"
    text = F.concat("order_id", F.lit("-"), F.col(a).cast("string"))
    return r.role("raw_orders").select(
        "order_id", days_between(a, b).alias("days"), hours_between(a, b).alias("hours"),
        plus_days(a, 7).alias("week_later"), plus_seconds(a, 5400).alias("later"), clock_label(a).alias("clock"),
        wall_clock(text).alias("bad_text"),
    )


@query("safe_ratio_pct", "F18 F20 F21 F24 F35", sql(f"""
    SELECT CAST(s_nationkey AS BIGINT) AS s_nationkey, CAST(sum(pos) AS BIGINT) AS positive,
           count(*) AS suppliers, {pct('sum(pos)', 'count(*)')} AS positive_pct,
           {pct('sum(pos)', 'sum(zero)')} AS undefined_pct,
           CASE WHEN sum(zero) > 0 THEN 1.0 ELSE 0.0E0 END AS guarded,
           round(abs(CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE)), 6) AS abs_balance
    FROM (SELECT s_nationkey, s_acctbal, CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS pos, 0 AS zero FROM supplier)
    GROUP BY s_nationkey"""))
def _(r):
    sums = r.table("supplier").groupBy("s_nationkey").agg(
        F.count_if(F.col("s_acctbal") > 0).alias("positive"), F.count("*").alias("suppliers"),
        F.sum(F.lit(0)).alias("zero"), F.abs(F.sum(money("s_acctbal"))).alias("abs_balance"),
    )
    return sums.select(
        "s_nationkey", "positive", "suppliers", share("positive", "suppliers").alias("positive_pct"),
        share("positive", "zero").alias("undefined_pct"), ratio("positive", "zero").alias("guarded"), "abs_balance",
    )


@query("json_field", "F26 F27 F34", sql("""
    SELECT event_type, CAST(min(k) AS BIGINT) AS min_k, CAST(max(k) AS BIGINT) AS max_k, CAST(sum(k) AS BIGINT) AS sum_k,
           count(*) FILTER (k > 50) AS large
    FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type"""))
def _(r):
    parsed = r.table("events").select("event_type", F.from_json("props", "k BIGINT").alias("data"))
    return parsed.groupBy("event_type").agg(
        F.min("data.k").alias("min_k"), F.max("data.k").alias("max_k"), F.sum("data.k").alias("sum_k"),
        F.count_if(F.expr("data.k > 50")).alias("large"),
    )


@query("enforce_types", "P01 P02 P03 F08 F28", sql("""
    SELECT c_custkey, TRY_CAST(c_mktsegment AS INTEGER) IS NULL AS not_a_number,
           CAST(TRY_CAST(right(c_name, 6) AS INTEGER) AS BIGINT) AS name_number,
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance,
           CAST(TRY_CAST(concat(c_mktsegment, c_name) AS DOUBLE) AS DOUBLE) AS no_number
    FROM customer"""))
def _(r):
    df = r.table("customer").select(
        "c_custkey", F.col("c_mktsegment").alias("not_a_number"), F.expr("right(c_name, 6)").alias("name_number"),
        F.col("c_acctbal").alias("balance"), to_number(F.concat("c_mktsegment", "c_name")).alias("no_number"),
    )
    typed = enforce_types(df, {"not_a_number": "int", "name_number": "int", "balance": "decimal(18,2)"})
    return typed.withColumn("not_a_number", F.col("not_a_number").isNull())


@query("regex_like_contains", "P09 P10 P11", sql("""
    SELECT source, count(*) AS documents,
           count(*) FILTER (regexp_matches(md5(text), '^[a-fA-F0-9]{32}$')) AS hex_ids,
           count(*) FILTER (regexp_matches(lang, '^[a-fA-F0-9]{32}$')) AS bad_ids,
           count(*) FILTER (lang LIKE 'e%') AS prefixed,
           count(*) FILTER (contains(text, 'kitchen') OR contains(text, 'game') OR contains(text, 'food')) AS mentioned
    FROM documents GROUP BY source"""))
def _(r):
    return r.table("documents").groupBy("source").agg(
        F.count("*").alias("documents"), F.count_if(test.is_hex_id(F.md5("text"))).alias("hex_ids"),
        F.count_if(test.is_hex_id("lang")).alias("bad_ids"), F.count_if(test.has_prefix("lang", "e")).alias("prefixed"),
        F.count_if(test.mentions("text", "kitchen", "game", "food")).alias("mentioned"),
    )


@query("chronology_errors", "P12 P13", sql("""
    SELECT order_id, order_status FROM raw_orders
    WHERE order_approved_at < order_purchase_timestamp OR order_delivered_carrier_date < order_approved_at
        OR order_delivered_carrier_date < order_purchase_timestamp
        OR order_delivered_customer_date < order_delivered_carrier_date
        OR order_delivered_customer_date < order_approved_at
        OR order_delivered_customer_date < order_purchase_timestamp"""))
def _(r):
    return r.role("raw_orders").where(test.out_of_order(*fixed.MILESTONES)).select("order_id", "order_status")


@query("predicates_in_range", "P04 P07 P08", sql("""
    SELECT CAST(payment_sequential AS BIGINT) AS payment_sequential, count(*) AS row_count
    FROM raw_payments WHERE payment_value BETWEEN 1000 AND 50000 AND payment_type IN ('boleto', 'voucher')
        AND order_id IS NOT NULL AND payment_installments IS NOT NULL GROUP BY 1"""))
def _(r):
    kept = r.role("raw_payments").where(
        F.col("payment_value").between(1000, 50000)
        & F.col("payment_type").isin("boleto", "voucher")
        & test.all_present("order_id", "payment_installments")
    )
    return kept.groupBy("payment_sequential").agg(F.count("*").alias("row_count"))


@query("labels_and_masks", "F29 F31 F32", sql("""
    SELECT c_custkey AS "C Custkey", concat(substr(c_name, 1, 8), '...') AS "Masked Name",
           substr(c_name, 10) AS "Bare Number", lower(trim(c_mktsegment)) AS "Segment" FROM customer"""))
def _(r):
    return titled(
        r.table("customer").select(
            "c_custkey", mask_id("c_name").alias("masked_name"),
            strip_prefix("c_name", "Customer#").alias("bare_number"), label_text("c_mktsegment").alias("segment"),
        )
    )


@query("decimal_volume", "F19 F25", sql("""
    SELECT product_id, CAST(product_length_cm * product_height_cm * product_width_cm AS DOUBLE) AS cm3
    FROM products_typed"""))
def _(r):
    sizes = ("product_length_cm", "product_height_cm", "product_width_cm")
    typed = r.role("raw_products").withColumns({c: money(c) for c in sizes})
    return typed.select("product_id", volume(*sizes).alias("cm3"))


@query("lineage_and_names", "S03 S22 P14 P15 P16 F17", sql("""
    SELECT source_file, count(*) AS row_count, count(DISTINCT doc_id) AS documents
    FROM (SELECT 'documents.parquet' AS source_file, doc_id FROM documents) GROUP BY source_file"""))
def _(r):
    traced = with_lineage(r.table("documents").drop("text")).withColumnRenamed("_source_file", "source_file")
    doubled = traced.select("*", F.col("lang").alias("lang"))
    return without_lineage(unique_columns(doubled)).groupBy("source_file").agg(
        F.count("*").alias("row_count"), F.count_distinct("doc_id").alias("documents")
    )


_KEPT = "doc_id,lang,source,n_chars,source_system,transformation_version"


@query("lineage_traces", "S03 S22 P14 P15 P16 F17", sql(f"""
    SELECT lang, 'documents.parquet' AS source_file, 'MARKETPLACE 1.0' AS system, true AS is_of_today, count(*) AS row_count,
           '{_KEPT.replace(",source_system", ",_ingested_at,_source_file,source_system")}' AS columns_traced,
           '{_KEPT}' AS columns_kept
    FROM documents GROUP BY lang"""))
def _(r):
    # what each step leaves: constants, times and file names in the rows, names in the columns
    traced = stamped(with_lineage(r.table("documents").drop("text")))
    doubled = traced.select("*", F.upper("lang").alias("lang"), F.lit(0).alias("source"))
    single = unique_columns(doubled)
    today = F.to_date("_ingested_at") == F.current_date()
    rows = single.groupBy("lang", F.col("_source_file").alias("source_file")).agg(
        F.max(F.concat_ws(" ", "source_system", "transformation_version")).alias("system"),
        F.min(today & (F.col("_ingested_at") <= F.current_timestamp())).alias("is_of_today"),
        F.count("*").alias("row_count"),
    )
    kept = {"columns_traced": single.columns, "columns_kept": without_lineage(single).columns}
    return rows.withColumns({name: F.lit(",".join(names)) for name, names in kept.items()})


@query("valid_rejected_split", "Q05", sql("""
    SELECT verdict, count(*) AS row_count FROM (
        SELECT CASE WHEN review_id IS NOT NULL AND review_score IS NOT NULL THEN 'valid' ELSE 'rejected' END AS verdict
        FROM raw_reviews) GROUP BY verdict"""))
def _(r):
    valid, rejected = split(r.role("raw_reviews"), test.all_present("review_id", "review_score"))
    counted = [
        part.agg(F.lit(name).alias("verdict"), F.count("*").alias("row_count"))
        for name, part in (("valid", valid), ("rejected", rejected))
    ]
    return counted[0].unionByName(counted[1])
