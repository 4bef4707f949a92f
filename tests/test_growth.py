"""What the queries store and parse, on rows of their own."""

from pathlib import Path

from pyspark.sql import functions as F

from tamarind.catalog import load
from tamarind.functions import fixed
from tamarind.operators import quality
from tamarind.plans import gold, silver, staging


def folders(spark):
    return set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir()) if Path(spark.conf.get("spark.checkpoint.dir")).exists() else set()


def new_names(spark, before):
    return sorted(p.name.rpartition("-")[0] for p in folders(spark) - before)


def test_live_feed_parses_each_message_once(spark, tmp_path):
    spark.range(600).selectExpr(
        "id DIV 3 AS l_orderkey", "CAST(id % 3 + 1 AS INT) AS l_linenumber", "id * 7 % 200 AS l_partkey", "id % 10 AS l_suppkey",
        "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity", "CAST(id % 977 + 900 AS DOUBLE) AS l_extendedprice",
        "0.05D AS l_discount", "0.05D AS l_tax", "'A' AS l_returnflag", "'O' AS l_linestatus",
        "timestamp_ntz '2024-01-01' + make_dt_interval(CAST(id * 37 % 601 AS INT)) AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    feed = load()["live_feed"].run(spark, str(tmp_path))
    assert "from_json" not in feed._jdf.queryExecution().optimizedPlan().toString(), "it starts from the parsed events"
    assert feed.count() == 15


def reviews_of(spark, **keep):
    raw = spark.createDataFrame(
        [("r1", "o1", "5", "2024-01-02 00:00:00", "2024-01-03 00:00:00"), ("r2", "o1", "1", "2024-01-02 00:00:00", "2024-01-05 00:00:00"),
         ("r3", "o2", "3", "2024-01-02 00:00:00", None), (None, "o2", "3", None, None), ("r4", "lost", "3", None, None)],
        "review_id string, order_id string, review_score string, review_creation_date string, review_answer_timestamp string",
    ).withColumns({"review_comment_title": F.lit(None).cast("string"), "review_comment_message": F.lit("x")})
    orders = spark.createDataFrame([("o1",), ("o2",)], "order_id string").withColumn(
        "order_purchase_timestamp", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    return silver.reviews(raw, orders, **keep)


def test_reviews_store_their_newest_rows_only(spark, rows):
    before = folders(spark)
    lean = reviews_of(spark, keep=silver.lazily, keep_newest=silver.kept_newest)
    assert new_names(spark, before) == ["newest"]
    whole = reviews_of(spark)
    assert rows(lean.rows) == rows(whole.rows) and lean.rows.count() == 2
    assert rows(lean.rejects.groupBy("error_reason").count()) == rows(whole.rejects.groupBy("error_reason").count())


def test_judged_rows_are_not_sorted_into_folders(spark):
    before = folders(spark)
    reviews_of(spark)
    (judged,) = folders(spark) - before
    assert not list(judged.glob("__verdict=*"))


def test_payment_types_need_one_row_per_order_and_seller(spark, rows):
    orders = spark.createDataFrame([("o1", "c"), ("o2", "c"), ("o3", "c")], "order_id string, customer_id string").withColumn(
        "order_purchase_timestamp", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    paid = spark.createDataFrame(
        [("o1", 9.0, 2, "boleto", "Cash", True), ("o3", 1.0, 1, "voucher", "Other", False)],
        "order_id string, total_payment_value double, total_payment_installments int, payment_type string, "
        "payment_type_category string, installment_flag boolean",
    )
    items = spark.createDataFrame(
        [("o1", 1, "s1", "p"), ("o1", 2, "s1", "p"), ("o1", 3, None, "p"), ("o2", 1, "s2", "p")],
        "order_id string, order_item_id int, seller_id string, product_id string",
    ).withColumns({"price": F.lit(2).cast("decimal(18,2)"), "freight_value": F.lit(1).cast("decimal(18,2)")})
    products = spark.createDataFrame([("p", 1)], "product_id string, product_volume_cm3 int")
    pairs = staging.order_sellers(items)
    totals = staging.order_totals(pairs)
    lean = gold.payment_type_dimension(staging.paid_pairs(orders, paid, totals, pairs))
    whole = gold.payment_type_dimension(staging.sales(items, orders, paid, totals, products, pairs))
    assert rows(lean) == rows(whole) and lean.count() == 2, "an order without items has no payment type, one without payment a null"


def test_facts_are_numbered_for_those_who_read_the_number(spark):
    fact = spark.createDataFrame([("b",), ("a",)], "order_id string")
    before = folders(spark)
    assert gold._own_key(fact, ["order_id"], "sk", fact, False).columns == ["order_id"] and not new_names(spark, before)
    assert sorted(map(tuple, gold._own_key(fact, ["order_id"], "sk", fact, True).collect())) == [(1, "a"), (2, "b")]


def test_rules_are_counted_by_one_shuffle_of_narrow_keys(spark, rows):
    child = spark.createDataFrame(
        [(1, "a,1:b", None), (1, "a", "1:b"), (2, None, "x"), (2, None, "x"), (3, "k", "v"), (3, "k", "v"), (None, "k", "w")],
        "fk long, a string, b string",
    )
    parent = spark.createDataFrame([("1",), ("1",), (None,)], "pk string")
    rules = [
        quality.Unique("pair", "c", ("a", "b")),
        quality.Unique("single", "c", ("fk",)),
        quality.ForeignKey("known", "c", "fk", "p", "pk"),
        quality.ForeignKey("known_or_null", "c", "fk", "p", "pk", ignore_null=True),
        quality.ForeignKey("itself", "p", "pk", "p", "pk", where="pk <> 'z'"),
        quality.NotNull("present", "c", ("a", "b")),
        quality.Holds("small", "c", "fk < 3"),
        quality.Holds("none", "c", "true"),
    ]
    counts = quality.summarise(rules, {"c": child, "p": parent})
    expected = {r.name: r.issues({"c": child, "p": parent}).count() for r in rules}
    assert {r.dq_rule: r.issue_count for r in counts.collect()} == expected
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "to_json" not in plan and "filter(array" not in plan
    by_key = [line for line in plan.splitlines() if "Aggregate" in line and "key" in line.split("]")[0]]
    assert len(by_key) == 1, "the parents' keys meet those of the children in the only aggregate by key"


def test_a_rule_that_fails_costs_the_others_one_more_job(spark, monkeypatch):
    t = spark.createDataFrame([(i, "x") for i in range(5)], "id long, s string")
    sound = [quality.NotNull(f"n{i}", "t", ("id",)) for i in range(3)] + [quality.Unique(f"u{i}", "t", ("s",)) for i in range(4)]
    rules = [*sound[:2], quality.Holds("number", "t", "CAST(s AS INT) > 0"), quality.Holds("low", "t", "id < 4"), *sound[2:]]
    jobs, plain = [], quality.summarise
    monkeypatch.setattr(quality, "summarise", lambda some, tables: jobs.append([r.name for r in some]) or plain(some, tables))
    found = {name: (n, error is not None) for name, n, error in quality.check_rules(spark, rules, {"t": t})}
    assert found == {**{f"n{i}": (0, False) for i in range(3)}, **{f"u{i}": (1, False) for i in range(4)},
                     "number": (1, True), "low": (1, False)}
    assert sum("u0" in names for names in jobs) == 2


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_items_and_payments_are_dealt_by_order_once(spark, rows):
    orders = spark.createDataFrame([("o1", "shipped"), ("o2", "shipped")], "order_id string, order_status string").withColumns(
        {c: F.lit("2024-01-01").cast("timestamp_ntz") for c in fixed.MILESTONES}
    )
    items = spark.createDataFrame(
        [("o1", "1", "p", "s", None, "9", "1"), ("o1", "1", "p", "s", None, "9", "1"), ("o1", "1", "p", "r", None, "9", "1"),
         ("o1", "2", "p", None, None, "8", "1"), ("lost", "1", "p", "s", None, "9", "1"), (None, "1", "p", "s", None, "9", "1")],
        "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date string, price string, "
        "freight_value string",
    )
    payments = spark.createDataFrame(
        [("o1", "1", "boleto", "1", "5"), ("o1", "1", "boleto", "1", "5"), ("o1", "1", "boleto", "1", "6"), ("lost", "1", "x", "1", "5"),
         (None, "1", "x", "1", "5"), (None, "1", "x", "1", "5")],
        "order_id string, payment_sequential string, payment_type string, payment_installments string, payment_value string",
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sold, paid = silver.order_items(items, orders, silver.lazily), silver.payments(payments, orders)
        values = sold.rows.select("order_id", "order_item_id", "seller_id", "price", "freight_value")
        assert shuffles(values) == 2 == shuffles(paid.rows), "the orders and their rows, each once"
        assert shuffles(staging.orders_with_costs(orders, values)) == 3
        assert [r[:3] for r in rows(values)] == [("o1", 1, "r"), ("o1", 2, None)]
        assert [int(r.payment_value) for r in paid.rows.orderBy("payment_value").collect()] == [5, 6]
        assert rows(paid.rejects, "order_id") == [(None,), ("lost",)] == rows(sold.rejects.where("error_reason <> ''").where(
            "order_id IS NULL OR order_id = 'lost'"), "order_id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_large_dimensions_are_looked_up_on_narrow_rows(spark, rows):
    fact = spark.range(200).selectExpr(
        "CAST(199 - id AS STRING) AS order_id", "id % 7 AS a", "IF(id % 5 = 0, NULL, id % 11) AS b", "repeat('x', 50) AS wide"
    )
    dims = [spark.range(6).selectExpr("id AS a", "id + 100 AS a_sk"), spark.range(11).selectExpr("id AS k", "id + 200 AS b_sk")]
    lookups = [(dims[0], "a", "a_sk", "a_fk"), (dims[1], {"b": "k"}, "b_sk", "b_fk")]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = gold._own_key(fact, ["order_id"], "sk", fact, True, lookups)
        plan = keyed._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 5, "the rows, their keys, the starts of the ranges; none for a dimension"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    columns = ["order_id", "a_fk", "b_fk", "wide"]
    plain = gold._own_key(fact, ["order_id"], "sk", fact, False, lookups)
    assert rows(keyed.select(*columns)) == rows(plain.select(*columns)) and plain.count() == 200
    assert [r.order_id for r in keyed.orderBy("sk").collect()] == sorted(str(i) for i in range(200))


def test_damaged_tables_are_read_once(spark, rows):
    from tamarind.catalog.model import _damaged

    table = spark.range(25).selectExpr("nullif(id, 7) AS sk", "id AS x")
    damaged = _damaged(table, "sk")
    assert rows(damaged) == rows(table.where("sk % 10 <> 3").unionAll(table.where("sk % 10 = 4")))
    assert damaged._jdf.queryExecution().optimizedPlan().toString().count("Range") == 1
