"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind.catalog.base import query
from tamarind.catalog.oracle import sql
from tamarind.functions.numbers import money
from tamarind.operators.joins import (
    attach,
    full_merge,
    orphans,
    rekey_orphans,
    salted_attach,
    split_by_parent,
    with_parent,
)
from tamarind.plans import reports


def _active_suppliers(r):
    return r.table("supplier").where("s_acctbal >= 0")


@query("items_inner_orders", "J01", sql("""
    SELECT o_orderstatus, count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus"""))
def _(r):
    joined = attach(r.table("lineitem"), r.table("orders"), {"l_orderkey": "o_orderkey"}, "inner")
    return joined.groupBy("o_orderstatus").agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )


@query("orphans_anti", "J04 J05", sql("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey FROM lineitem
    LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey
    WHERE s_suppkey IS NULL"""))
def _(r):
    found = orphans(r.table("lineitem"), _active_suppliers(r), {"l_suppkey": "s_suppkey"})
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("orders_without_items", "J04", sql("""
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""))
def _(r):
    return orphans(r.table("orders"), r.table("lineitem"), {"o_orderkey": "l_orderkey"}).select("o_orderkey", "o_custkey")


@query("rekey_orphans", "Q07 Q08", sql("""
    SELECT CASE WHEN s_suppkey IS NULL THEN '-1' ELSE CAST(l_suppkey AS VARCHAR) END AS l_suppkey, count(*) AS lines
    FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey
    GROUP BY 1"""))
def _(r):
    lines = r.table("lineitem").select(F.col("l_suppkey").cast("string").alias("l_suppkey"))
    parents = _active_suppliers(r).select(F.col("s_suppkey").cast("string").alias("s_suppkey"))
    return rekey_orphans(lines, parents, {"l_suppkey": "s_suppkey"}).groupBy("l_suppkey").agg(F.count("*").alias("lines"))


@query("drop_and_log_orphans", "Q06", sql("""
    SELECT 'kept' AS outcome, count(*) AS lines FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
    UNION ALL SELECT 'orphan', count(*) FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)"""))
def _(r):
    kept, lost = split_by_parent(r.table("lineitem"), _active_suppliers(r), {"l_suppkey": "s_suppkey"})
    return kept.agg(F.lit("kept").alias("outcome"), F.count("*").alias("lines")).unionAll(
        lost.agg(F.lit("orphan"), F.count("*"))
    )


@query("reconcile_full_outer", "J06 X19", sql("""
    SELECT order_id, CAST(total_amount_paid AS DOUBLE) AS total_amount_paid,
           CAST(total_items_value AS DOUBLE) AS total_items_value, CAST(variance AS DOUBLE) AS variance FROM recon"""))
def _(r):
    return r.recon


# One-sided groups: some nations of either table get a key that the other one lacks.
_BUYER = "c_nationkey + CASE WHEN c_nationkey % 5 = 1 THEN 100 ELSE 0 END"
_VENDOR = "s_nationkey + CASE WHEN s_nationkey % 4 = 2 THEN 200 ELSE 0 END"


@query("outer_merge_fill", "J07", sql(f"""
    SELECT coalesce(a.k, b.k) AS nation, coalesce(a.n, 0) AS customers, coalesce(b.n, 0) AS suppliers
    FROM (SELECT CAST({_BUYER} AS BIGINT) AS k, count(*) AS n FROM customer GROUP BY 1) a
    FULL JOIN (SELECT CAST({_VENDOR} AS BIGINT) AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k"""))
def _(r):
    bought = r.table("customer").groupBy(F.expr(_BUYER).alias("nation")).agg(F.count("*").alias("customers"))
    sold = r.table("supplier").groupBy(F.expr(_VENDOR).alias("nation")).agg(F.count("*").alias("suppliers"))
    return full_merge(bought, sold, ["nation"], 0)


@query("composite_key_lookup", "J08 J13", sql("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, n AS copies
    FROM lineitem LEFT JOIN (SELECT l_orderkey AS k, nullif(l_linenumber, 7) AS j, count(*) AS n FROM lineitem
        GROUP BY 1, 2) ON l_orderkey = k AND nullif(l_linenumber, 7) = j"""))
def _(r):
    lines = r.table("lineitem").withColumn("line", F.nullif("l_linenumber", F.lit(7)))
    counts = lines.groupBy("l_orderkey", "line").agg(F.count("*").alias("copies"))
    joined = attach(lines, counts, ["l_orderkey", "line"])
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "copies")


@query("has_match_flag", "J09 Q36", sql("""
    SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS has_matching_order
    FROM customer"""))
def _(r):
    done = r.table("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("customer_id"))
    known = r.table("customer").select(F.col("c_custkey").alias("customer_id"))
    flagged, _ = reports.customers_without_orders(known, done)
    return flagged.withColumnRenamed("customer_id", "c_custkey")


@query("semi_keyset", "J10", sql("""
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (
        SELECT l_orderkey FROM lineitem WHERE l_linenumber >= 7)"""))
def _(r):
    wanted = r.table("lineitem").where("l_linenumber >= 7")
    return with_parent(r.table("orders"), wanted, {"o_orderkey": "l_orderkey"}).select("o_orderkey", "o_orderstatus")


@query("three_way_bridge", "J11", sql("""
    SELECT p_type, o_orderstatus, count(*) AS lines, count(DISTINCT o_orderkey) AS orders
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""))
def _(r):
    lines = attach(r.table("lineitem"), r.table("part").select("p_partkey", "p_type"), {"l_partkey": "p_partkey"}, "inner")
    bridge = attach(
        lines.select("l_orderkey", "p_type"), r.table("orders").select("o_orderkey", "o_orderstatus"),
        {"l_orderkey": "o_orderkey"}, "inner",
    )
    # lines are folded per order before the distinct orders are counted
    per_order = bridge.groupBy("p_type", "o_orderstatus", "l_orderkey").agg(F.count("*").alias("n"))
    return per_order.groupBy("p_type", "o_orderstatus").agg(F.sum("n").alias("lines"), F.count("*").alias("orders"))


@query("small_dimension_lookup", "J03 J12", sql("""
    SELECT r_name, n_name, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2"""))
def _(r):
    places = attach(r.table("nation"), r.table("region"), {"n_regionkey": "r_regionkey"})
    per_nation = r.table("customer").groupBy("c_nationkey").agg(
        F.count("*").alias("customers"), F.sum(money("c_acctbal")).alias("balance")
    )
    named = attach(per_nation, places.select("n_nationkey", "n_name", "r_name"), {"c_nationkey": "n_nationkey"})
    return named.select("r_name", "n_name", "customers", "balance")


@query("salted_lookup", "J02 D14", sql("""
    SELECT CAST(s_nationkey AS BIGINT) AS s_nationkey, count(*) AS lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1"""))
def _(r):
    # every supplier holds a percent of the lines here, so all of them are salted
    lines = r.table("lineitem").select("l_suppkey", "l_extendedprice", "l_orderkey", "l_linenumber")
    joined = salted_attach(lines, r.table("supplier"), {"l_suppkey": "s_suppkey"}, rows_per_task=200, buckets=16)
    return joined.groupBy("s_nationkey").agg(F.count("*").alias("lines"), F.sum(money("l_extendedprice")).alias("value"))
