"""Imputation and correction (Q09, Q21-Q30) and quality rules."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tamarind.functions import fixed
from tamarind.operators import quality, repair

DAY = datetime(2020, 1, 1)


def stages(spark, *orders):
    """Orders as hour offsets of the four milestones and the estimate."""
    data = [
        (str(i), status, *[None if h is None else DAY + timedelta(hours=h) for h in hours])
        for i, (status, *hours) in enumerate(orders)
    ]
    columns = ", ".join(f"{c} timestamp_ntz" for c in (*fixed.MILESTONES, fixed.ESTIMATE))
    return spark.createDataFrame(data, f"order_id string, order_status string, {columns}")


def hours(df):
    out = []
    for r in df.orderBy("order_id").select(*fixed.MILESTONES).collect():
        out.append([None if v is None else (v - DAY).total_seconds() / 3600 for v in r])
    return out


def test_milestones_follow_the_medians(spark):
    df = stages(
        spark,
        ("delivered", 0, 2, 10, 30, 200),
        ("delivered", 0, None, None, None, 200),
        ("delivered", None, 5, 13, 33, 205),
        ("shipped", 0, None, None, None, 200),
        ("delivered", None, None, None, None, 200),
    )
    assert hours(repair.fill_milestones(df)) == [
        [0, 2, 10, 30], [0, 2, 10, 30], [3, 5, 13, 33], [0, None, None, None], [0, 2, 10, 30],
    ]


def test_milestone_defaults_without_complete_orders(spark):
    df = stages(spark, ("delivered", 0, None, None, None, None))
    assert hours(repair.fill_milestones(df)) == [[0, 1, 25, 97]]


def test_clamp_is_idempotent_and_keeps_nulls(spark):
    df = stages(spark, ("delivered", 5, 3, None, 4, None), ("delivered", 0, 9, 2, 1, None))
    clamped = repair.clamp_chronology(df)
    assert hours(clamped) == [[5, 5, None, 4], [0, 9, 9, 9]]
    assert hours(repair.clamp_chronology(clamped)) == hours(clamped)


def test_swap_is_idempotent_and_keeps_nulls(spark, rows):
    df = spark.createDataFrame([(2, 1), (1, 2), (None, 1), (3, None)], "a int, b int")
    swapped = repair.swap_if_reversed(df, "a", "b")
    assert rows(swapped) == [(None, 1), (1, 2), (1, 2), (3, None)]
    assert rows(repair.swap_if_reversed(swapped, "a", "b")) == rows(swapped)


def test_group_median_fill(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 10), (2, "a", 20), (3, "a", 30), (4, "a", None), (5, None, 7), (6, None, None), (7, "c", None)],
        "id int, g string, w int",
    )
    assert rows(repair.fill_group_median(df, "g", ["w"]), "id", "w") == [
        (1, 10), (2, 20), (3, 30), (4, 20), (5, 7), (6, 7), (7, None),
    ]


def test_limit_date_rebuilt_at_midnight(spark):
    at = lambda h: DAY + timedelta(hours=h)
    df = spark.createDataFrame(
        [(1, at(30), at(20), at(96)), (2, at(30), at(20), at(2)), (3, at(30), None, None), (4, at(30), None, at(31))],
        "id int, order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, shipping_limit_date timestamp_ntz",
    )
    got = {r.id: r.shipping_limit_date for r in repair.rebuild_limit_date(df).collect()}
    assert got == {1: at(96), 2: datetime(2020, 1, 5), 3: datetime(2020, 1, 6), 4: at(31)}


def test_review_times(spark):
    at = lambda h: DAY + timedelta(hours=h)
    df = spark.createDataFrame(
        [(1, at(0), at(24), at(48)), (2, at(5), None, None), (3, at(5), at(30), None)],
        "id int, order_purchase_timestamp timestamp_ntz, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz",
    )
    got = {r.id: (r.review_creation_date, r.review_answer_timestamp) for r in repair.fill_answer_time(df).collect()}
    assert got[2] == (datetime(2020, 1, 8), datetime(2020, 1, 9)) and got[3] == (at(30), at(54))
    cascade = {r.id: (r.review_creation_date, r.review_answer_timestamp) for r in repair.fill_review_cascade(df).collect()}
    assert cascade[2] == (at(29), at(53))


def test_centroid_and_majority(spark, rows):
    df = spark.createDataFrame(
        [(1, -10.0, -40.0), (1, -20.0, -50.0), (1, 50.0, -50.0), (2, 50.0, -50.0), (1, None, -40.0)],
        "z int, lat double, lng double",
    )
    assert rows(repair.fill_from_centroid(df, "z", "lat", "lng")) == [
        (1, None, -40.0), (1, -20.0, -50.0), (1, -15.0, -50.0), (1, -10.0, -40.0), (2, None, -50.0),
    ]
    cities = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c")], "z int, city string")
    assert rows(repair.standardise_by_majority(cities, "z", "city")) == [(None, "c"), (1, "a"), (1, "a"), (1, "a")]


def test_unknown_member_is_idempotent(spark, rows):
    df = spark.createDataFrame([("1", "x"), (None, "y")], "id string, name string")
    once = repair.with_unknown_member(df, "id", {"name": "Unknown"})
    twice = repair.with_unknown_member(once, "id", {"name": "Unknown"})
    assert rows(once) == rows(twice) == [(None, "y"), ("-1", "Unknown"), ("1", "x")]


def test_split_covers_the_input(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    valid, rejected = quality.split(df, F.col("x") > 0)
    assert (valid.count(), rejected.count()) == (1, 2)


def test_rules(spark, rows):
    tables = {
        "c": spark.createDataFrame([(1, 10), (2, 99), (3, None), (3, 10)], "id int, fk int"),
        "p": spark.createDataFrame([(10,)], "pk int"),
    }
    rules = [
        quality.NotNull("not_null", "c", ("id", "fk")),
        quality.ForeignKey("strict", "c", "fk", "p", "pk"),
        quality.ForeignKey("sql_like", "c", "fk", "p", "pk", ignore_null=True),
        quality.ForeignKey("filtered", "c", "fk", "p", "pk", where="id = 1"),
        quality.Unique("unique", "c", ("id",)),
        quality.Holds("holds", "c", "fk > 10"),
    ]
    assert rows(quality.summarise(rules, tables)) == [
        ("filtered", 0), ("holds", 3), ("not_null", 1), ("sql_like", 1), ("strict", 2), ("unique", 1),
    ]
    issues = quality.issue_table(rules[1], tables)
    assert issues.columns == ["id", "fk", "dq_rule", "dq_checked_at"]
    assert quality.check_primary_key(tables["c"], "id").count() == 1
    assert quality.check_foreign_key(tables["c"], "fk", tables["p"], "pk").count() == 1
    assert rows(quality.missing_counts(tables["c"], {"missing": ("fk", tables["p"], "pk")})) == [(2,)]
    assert rows(quality.null_key_counts(tables["c"], {"nulls": "fk"})) == [(1,)]


def test_all_rules_take_one_pass_over_each_table(spark, tmp_path):
    """Also with null keys, composite keys and a parent that several rules share."""
    child = [(i, i % 7 if i % 5 else None, f"k{i % 3}", i // 6) for i in range(60)]
    spark.createDataFrame(child, "id int, fk int, part string, pair int").write.parquet(f"{tmp_path}/c")
    spark.createDataFrame([(1,), (2,), (2,), (None,)], "pk int").write.parquet(f"{tmp_path}/p")
    tables = {t: spark.read.parquet(f"{tmp_path}/{t}") for t in ("c", "p")}
    rules = [
        quality.NotNull("not_null", "c", ("fk",)),
        quality.ForeignKey("strict", "c", "fk", "p", "pk"),
        quality.ForeignKey("filtered", "c", "fk", "p", "pk", where="id > 30", ignore_null=True),
        quality.ForeignKey("other", "c", "id", "p", "pk"),
        quality.Unique("pairs", "c", ("part", "pair")),
        quality.Unique("with_null", "c", ("fk", "part")),
        quality.Unique("parent", "p", ("pk",)),
        quality.Holds("holds", "c", "fk < 3"),
    ]
    counts = quality.summarise(rules, tables)
    singly = {r.name: r.issues(tables).count() for r in rules}
    assert {r.dq_rule: r.issue_count for r in counts.collect()} == singly and all(singly.values())
    plan = quality.summarise(rules, tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_rules_that_cannot_run_are_issues(spark):
    tables = {"c": spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")}
    rules = [
        quality.Holds("good", "c", "id > 1"),
        quality.NotNull("no_column", "c", ("nothing",)),
        quality.Holds("fails_on_a_row", "c", "CAST(name AS INT) > 0"),
        quality.ForeignKey("no_table", "c", "id", "missing", "id"),
        quality.Unique("also_good", "c", ("id",)),
    ]
    got = {name: (n, error and error.split(":")[0]) for name, n, error in quality.check_rules(spark, rules, tables)}
    assert got["good"] == (1, None) and got["also_good"] == (0, None)
    assert {got[n][0] for n in ("no_column", "fails_on_a_row", "no_table")} == {1}
    assert all(got[n][1] for n in ("no_column", "fails_on_a_row", "no_table"))
    table = quality.outcome_table(spark, quality.check_rules(spark, rules, tables))
    assert table.where("validation_error IS NOT NULL").count() == 3
    assert quality.missing_of(["a", "b"], ["b"]) == ["a"]


def test_failures_become_issues(spark):
    bad = quality.guarded(spark, "rule", lambda: spark.table("no_such_table"))
    assert "TABLE_OR_VIEW_NOT_FOUND" in bad.first().validation_error
    names = quality.missing_names(spark, ["a", "b"], spark.createDataFrame([("a",)], "n string"), "n")
    assert [r.n for r in names.collect()] == ["b"]
