"""Items, their facts and numbers stay in buckets of their order; on rows of their own."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import harness
from tamarind.catalog import load
from tamarind.catalog.roles import Roles
from tamarind.operators import ranged
from tamarind.operators.joins import attach
from tamarind.session import ADAPTIVE, STORING, adaptive, by_buckets, scratch_path, stored
from tamarind.sources.tables import Lake

DAY = "timestamp_ntz '2024-01-01' + make_dt_interval(CAST({} AS INT))"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables: lines of one order and number that differ, orders without lines, parts nobody knows."""
    root = tmp_path_factory.mktemp("tables")
    made = {
        "customer": spark.range(30).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey", "CAST(id * 300 AS DOUBLE) AS c_acctbal",
                                               "element_at(array('BUILDING', 'FURNITURE', 'HOUSEHOLD'), CAST(id % 3 + 1 AS INT)) AS c_mktsegment"),
        "supplier": spark.range(12).selectExpr("id AS s_suppkey", "CAST(id % 25 AS INT) AS s_nationkey", "CAST(id * 700 AS DOUBLE) AS s_acctbal"),
        "part": spark.range(90).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "CAST(id % 50 + 1 AS INT) AS p_size",
                                           "element_at(array('SMALL', 'LARGE', 'PROMO'), CAST(id % 3 + 1 AS INT)) AS p_type"),
        "orders": spark.range(150).selectExpr(
            "id AS o_orderkey", "id * 7 % 33 AS o_custkey", "element_at(array('F', 'O', 'P'), CAST(id % 3 + 1 AS INT)) AS o_orderstatus",
            f"{DAY.format('id % 40')} AS o_orderdate",
            "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'), CAST(id % 5 + 1 AS INT)) AS o_orderpriority"),
        "lineitem": spark.range(400).selectExpr(
            "id * 13 % 120 AS l_orderkey", "CAST(id % 4 + 1 AS INT) AS l_linenumber", "id * 7 % 100 AS l_partkey", "id % 14 AS l_suppkey",
            "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity", "CAST(id % 97 * 13 + 900 AS DOUBLE) AS l_extendedprice",
            "CAST(id % 11 AS DOUBLE) / 100 AS l_discount", "CAST(id % 9 AS DOUBLE) / 100 AS l_tax",
            "element_at(array('A', 'N', 'R'), CAST(id % 3 + 1 AS INT)) AS l_returnflag", "IF(id % 2 = 0, 'O', 'F') AS l_linestatus",
            f"{DAY.format('id % 60')} AS l_shipdate"),
        "events": spark.range(200).selectExpr(
            "id AS event_id", "id % 50 AS user_id", "element_at(array('signup', 'purchase', 'view'), CAST(id % 3 + 1 AS INT)) AS event_type",
            f"{DAY.format('id % 30')} AS ts", "CAST(id % 60 AS DOUBLE) AS value"),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{root}/parts/{name}")
        (file,) = Path(f"{root}/parts/{name}").glob("*.parquet")
        file.rename(f"{root}/{name}.parquet")
    return str(root)


FACTS = ("fact_sales", "fact_fulfillment", "fk_missing_counts", "pk_fk_check", "mart_counts", "mart_load")


@pytest.mark.parametrize("name", FACTS)
def test_facts_equal_their_sql(spark, folder, name):
    assert harness.difference(spark, harness.connect(folder), folder, load()[name]) is None


@pytest.fixture
def unlike_small(spark):
    """Joins as of large tables."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def built(spark, folder, name):
    """A query's frame, and the tables below its scratch folder."""
    roles = Roles(adaptive(spark, ADAPTIVE | STORING), folder)
    df = load()[name].build(roles)
    return df, {p.name for p in Path(roles.scratch.root).iterdir()}


def moves(df):
    """Columns that each shuffle of the plan moves."""
    def below(node):
        if node.nodeName() == "Exchange":
            yield {a.name() for a in (node.output().apply(i) for i in range(node.output().size()))}
        for i in range(node.children().size()):
            yield from below(node.children().apply(i))

    return list(below(df._jdf.queryExecution().executedPlan().initialPlan()))


@pytest.mark.parametrize("name", ["fact_sales", "fact_fulfillment"])
def test_facts_of_items_move_keys_only(spark, folder, unlike_small, name):
    df, kept = built(spark, folder, name)
    assert not kept & {"items", "pairs", "sales", "fulfilled"} and "judged_items" in kept
    moved = moves(df)
    wide = [m for m in moved if m & {"price", "freight_value"}]
    assert moved and len(wide) == (name == "fact_sales"), "only for the few payment types, which are broadcast elsewhere"


@pytest.mark.parametrize("name", ["mart_counts", "fk_missing_counts", "pk_fk_check"])
def test_counts_store_items_once(spark, folder, name):
    _, kept = built(spark, folder, name)
    assert "judged_items" in kept and not kept & {"items", "pairs", "sales", "fulfilled", "judged", "delivery"}


def test_marts_are_compressed_well(spark, folder):
    built(spark, folder, "mart_load")
    files = spark.table("sales_mart.fct_order_sales").inputFiles()
    assert files and all(".zstd." in f for f in files)


def test_null_safe_may_name_some_keys(spark, rows):
    left = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, "x", 3)], "k string, s string, v int")
    right = spark.createDataFrame([("a", None, 10), ("a", "x", 20), (None, "x", 30)], "k string, s string, w int")
    assert rows(attach(left, right, ["k", "s"], null_safe=["s"]), "v", "w") == [(1, 10), (2, 20), (3, None)]


@pytest.mark.parametrize("most", [100, 3])
def test_numbers_within_an_order_equal_numbers_of_keys(spark, rows, most):
    keys = [(None if i % 9 == 0 else f"o{i % 9}", None if i == 40 else i // 9, i) for i in range(45)]
    df = spark.createDataFrame(keys, "order_id string, order_item_id int, v int")
    order = ["order_id", "order_item_id"]
    within = ranged.dense_key_within(df, order, "sk", rows_per_key=most)
    assert rows(within) == rows(ranged.dense_key_of(df, order, "sk"))
    assert [r.sk for r in within.orderBy("sk").collect()] == list(range(1, 46))
    assert ranged.dense_key_within(df.where("v < 0"), order, "sk").count() == 0


def test_numbers_do_not_move_rows_in_buckets(spark, unlike_small):
    adaptive(spark, STORING)
    df = spark.range(60).selectExpr("CAST(id % 20 AS STRING) AS order_id", "CAST(id AS INT) AS order_item_id", "repeat('x', 50) AS wide")
    lying = Lake(spark, scratch_path(spark, "lake")).write_bucketed(df, "rows", ["order_id"])
    numbered = ranged.dense_key_within(lying, ["order_id", "order_item_id"], "sk", lying)
    assert not [m for m in moves(numbered) if "wide" in m]
    assert numbered.agg(F.max("sk"), F.count_distinct("sk")).collect() == [(60, 60)]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_statement(spark):
    adaptive(spark, STORING)
    before = shuffle_files(spark)
    wide = by_buckets(spark.range(1000).selectExpr("id", "id % 7 AS k"), ["k"])
    assert stored(wide, "wide").count() == 1000
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert len(wide.collect()) == len(wide.collect()) == 1000, "a frame that is run again writes them again"
