"""Registered round trips: tables are written below the scratch folder or to the
catalog, and what comes back is compared with the tables they were made of."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tamarind.catalog.base import query
from tamarind.catalog.model import Star
from tamarind.catalog.oracle import sql
from tamarind.operators.profiles import schema_of
from tamarind.operators.quality import count_sheet
from tamarind.plans.marts import MARTS, load_mart
from tamarind.session import scratch_path
from tamarind.sources import audit, tables
from tamarind.sources.tables import Lake

_NOTE = """concat('said "', o_orderpriority, '",', chr(10), 'line two; ', o_orderstatus)"""
_CSV = "order_id bigint, customer_id bigint, total decimal(18,2), placed timestamp_ntz, note string"
_ORDERS = f"""o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
    o_orderdate AS placed, {_NOTE} AS note"""


def _lake(r) -> Lake:
    return Lake(r.spark, scratch_path(r.spark, "lake"))


# The file has a column more and one less than declared, and every 17th total is no number.
_LANDED = _ORDERS.replace("CAST(o_totalprice AS DECIMAL(18,2)) AS total", """CASE WHEN o_orderkey % 17 = 0 THEN 'n/a'
    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS total""") + ", 'web' AS channel"


@query("csv_to_bronze", "S01 S02 S04 S05 S11 S14", f"""
    SELECT order_id, customer_id, CASE WHEN outcome = 'bronze' THEN round(CAST(total AS DOUBLE), 6) END AS total,
           CAST(placed AS VARCHAR) AS placed, note, outcome, 'orders.csv' AS source_file,
           count(*) OVER (PARTITION BY outcome) AS rows_reported
    FROM (SELECT {_ORDERS}, CASE WHEN o_orderkey % 17 = 0 THEN 'rejected' ELSE 'bronze' END AS outcome FROM orders)
    UNION ALL SELECT NULL, NULL, NULL, NULL, note, 'drift', 'orders', 1 FROM (VALUES ('channel added'), ('clerk missing')) v(note)""")
def _(r):
    landing = scratch_path(r.spark, "landing")
    orders = r.table("orders").selectExpr(*_split(_LANDED.replace("chr(10)", "'\\n'")))
    orders.write.option("header", True).option("escape", '"').csv(f"{landing}/orders.csv")
    lake, log = _lake(r), _lake(r)
    # an older table with another schema is replaced
    lake.write(r.table("region"), "orders")
    landed = tables.ingest_typed(
        lake,
        landing,
        {"orders": "orders.csv"},
        {"orders": f"{_CSV}, clerk string"},
        lambda rows, table: audit.log_rejects(log, rows, table, "run-1", datetime(2024, 5, 1)),
        multi_line={"orders"},
    )
    columns = [c.split()[0] for c in _CSV.split(", ")]

    def shown(rows, outcome, n):
        return rows.select(*columns, F.lit(outcome).alias("outcome"), F.col("_source_file").alias("source_file"), F.lit(n).cast("long").alias("rows_reported"))

    rejects = audit.read_log(log, "orders", "run-1").withColumn("_source_file", F.lit("orders.csv"))
    both = shown(lake.read("orders"), "bronze", landed.counts["orders"]).unionByName(
        shown(rejects, "rejected", landed.rejected["orders"])
    )
    changes = landed.drift.select(
        F.concat_ws(" ", "column_name", "change").alias("note"), F.lit("drift").alias("outcome"),
        F.col("table_name").alias("source_file"), F.lit(1).cast("long").alias("rows_reported"),
    )
    return both.unionByName(changes, allowMissingColumns=True)


def _split(spec: str) -> list[str]:
    """Select list of ``a AS b`` items, parted at the commas outside parentheses."""
    items, depth, item = [], 0, ""
    for c in spec:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            items.append(item)
            item = ""
        else:
            item += c
    return [*items, item]


@query("audit_log_runs", "S06 Q01", """
    SELECT l_orderkey, l_linenumber, 'no discount' AS error_reason, 'monday' AS run_id
    FROM lineitem WHERE l_discount = 0
    UNION ALL SELECT l_orderkey, l_linenumber, 'late', 'tuesday' FROM lineitem WHERE l_returnflag = 'R'""")
def _(r):
    lake, lines = _lake(r), r.table("lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_returnflag")
    free = lines.where("l_discount = 0").withColumn("error_reason", F.lit("no discount"))
    late = lines.where("l_returnflag = 'R'").withColumn("error_reason", F.lit("late"))
    audit.log_rejects(lake, late, "lines", "monday", datetime(2024, 1, 1))
    # the same run again replaces what it has logged
    audit.log_rejects(lake, free, "lines", "monday", datetime(2024, 1, 1))
    audit.log_rejects(lake, late.drop("l_discount"), "lines", "tuesday", datetime(2024, 1, 2))
    return audit.read_log(lake, "lines").select("l_orderkey", "l_linenumber", "error_reason", "run_id")


@query("evolved_append", "S07", """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority
    FROM orders""")
def _(r):
    lake, orders = _lake(r), r.table("orders")
    lake.append(orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus"), "orders")
    lake.append(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority"), "orders")
    return lake.read_evolved("orders")


@query("parquet_exports", "S08 S09", """
    SELECT 'report' AS export, 1 AS files_at_most, o_orderpriority AS name, count(*) AS n FROM orders GROUP BY 3
    UNION ALL SELECT 'lines', NULL, l_shipmode, count(*) FROM (SELECT l_linestatus AS l_shipmode FROM lineitem) GROUP BY 3""")
def _(r):
    root = scratch_path(r.spark, "export")
    report = r.table("orders").groupBy(F.col("o_orderpriority").alias("name")).agg(F.count("*").alias("n"))
    tables.export_parquet(report, f"{root}/report", single_file=True)
    tables.export_parquet(r.table("lineitem").select("l_linestatus"), f"{root}/lines")
    back = r.spark.read.parquet(f"{root}/report")
    files = back.select(F.input_file_name().alias("f")).agg(F.count_distinct("f")).scalar()
    lines = r.spark.read.parquet(f"{root}/lines").groupBy(F.col("l_linestatus").alias("name")).agg(F.count("*").alias("n"))
    return back.select(F.lit("report").alias("export"), files.alias("files_at_most"), "name", "n").union(
        lines.select(F.lit("lines"), F.lit(None).cast("long"), "name", "n")
    )


@query("catalog_tables", "S10 S18 S19 S20 S26", """
    SELECT 'big_orders' AS table_name, o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 150000
    UNION ALL SELECT 'small_orders', o_orderkey, o_totalprice FROM orders WHERE o_totalprice <= 150000""")
def _(r):
    space = f"tamarind_{uuid.uuid4().hex[:12]}"
    orders = r.table("orders").select("o_orderkey", "o_totalprice")
    tables.create_namespaces(r.spark, space)
    tables.save_as_table(orders, f"{space}.forgotten")
    tables.reset_namespace(r.spark, space)
    tables.save_as_table(orders.where("o_totalprice > 150000"), f"{space}.big_orders")
    tables.save_as_table(orders, f"{space}.small_orders")
    tables.save_as_table(orders.where("o_totalprice <= 150000"), f"{space}.small_orders")
    rows = None
    for name in sorted(t.table_name for t in tables.list_tables(r.spark, space).collect()):
        part = r.spark.table(f"{space}.{name}").withColumn("table_name", F.lit(name))
        rows = part if rows is None else rows.union(part)
    return rows.select("table_name", "o_orderkey", "o_totalprice")


@query("mart_load", "M02", sql("""
    SELECT 'fct_order_sales' AS table_name, count(*) AS row_count FROM silver_items
    UNION ALL SELECT 'dim_customer', count(DISTINCT trim(CAST(c_custkey AS VARCHAR))) FROM customer
    UNION ALL SELECT 'dim_product', count(*) FROM part
    UNION ALL SELECT 'dim_seller', count(*) FROM supplier"""))
def _(r):
    star = Star(r)
    mart = next(m for m in MARTS if m.fact == "fct_order_sales")
    loaded = load_mart(mart, {t: star[t] for t in mart.tables})
    wanted = ("fct_order_sales", "dim_customer", "dim_product", "dim_seller")
    return count_sheet({t: loaded[t] for t in wanted})


@query("table_schemas", "S25", """
    SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
        WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type, true AS is_nullable
    FROM (DESCRIBE lineitem)""")
def _(r):
    return schema_of(r.table("lineitem"))


@query("empty_and_first_rows", "S23 O02 S25", """
    SELECT o_orderkey, o_totalprice, 0 AS empty_rows FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def _(r):
    orders = r.table("orders").select("o_orderkey", "o_totalprice")
    empty = tables.empty_like(orders)
    rows = tables.preview(orders.union(empty).orderBy(F.desc("o_totalprice"), "o_orderkey"), 25)
    return rows.withColumn("empty_rows", F.lit(empty.count()).cast("long"))
