"""Joins, dedupe, ranged order, skew, profiles: against brute force on hot keys."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tamarind.operators import dedupe, joins, profiles, ranged, windows


@pytest.fixture(scope="module")
def hot(spark):
    """3,000 rows, a third of them in one key and a tenth without a key."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 10 == 0 else f"k{rng.randint(0, 400)}"
        data.append((i, key, rng.randint(0, 50), f"v{rng.randint(0, 5)}"))
    return spark.createDataFrame(data, "id int, k string, t int, v string").repartition(8).cache(), data


def test_salted_join_equals_plain_join(spark, hot, rows):
    df, data = hot
    lookup = spark.createDataFrame([(f"k{i}", i) for i in range(0, 300)] + [("hot", -1)], "key string, n int")
    assert joins.heavy_hashes(df, ["k"], 150), "the hot key must be found"
    for how in ("left", "inner"):
        salted = joins.salted_attach(df, lookup, {"k": "key"}, how, rows_per_task=150, buckets=8)
        assert rows(salted) == rows(joins.attach(df, lookup, {"k": "key"}, how))
    assert joins.salted_attach(df, lookup, {"k": "key"}, rows_per_task=150).count() == len(data)


def test_salted_join_without_hot_keys(spark, hot, rows):
    df, _ = hot
    lookup = spark.createDataFrame([("k1", 1)], "k string, n int")
    cold = df.where("k <> 'hot'")
    assert rows(joins.salted_attach(cold, lookup, "k")) == rows(joins.attach(cold, lookup, "k"))
    with pytest.raises(ValueError):
        joins.salted_attach(cold, lookup, "k", "full")


def test_orphan_policies_cover_the_input(spark, hot):
    df, data = hot
    parents = spark.createDataFrame([("hot",), ("k1",), ("k1",), (None,)], "k string")
    kept, lost = joins.split_by_parent(df, parents, "k")
    expected = sum(1 for r in data if r[1] in ("hot", "k1"))
    assert (kept.count(), lost.count()) == (expected, len(data) - expected)
    rekeyed = joins.rekey_orphans(df, parents, "k")
    assert rekeyed.count() == len(data)
    assert rekeyed.where("k = '-1'").count() == len(data) - expected
    flagged = joins.flag_match(df, parents, "k", "known")
    assert flagged.where("known").count() == expected


def test_null_keys(spark, rows):
    left = spark.createDataFrame([(1, None), (2, "a")], "id int, k string")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, n int")
    assert rows(joins.attach(left, right, "k"), "id", "n") == [(1, None), (2, 20)]
    assert rows(joins.attach(left, right, "k", null_safe=True), "id", "n") == [(1, 10), (2, 20)]
    merged = joins.full_merge(right, left.drop("id").withColumn("m", F.lit(1)), ["k"], 0)
    assert merged.count() == 3  # null keys stay apart


def test_lookup_key(spark, rows):
    fact = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("a", 5)], "k string, sk int")
    assert rows(joins.lookup_key(fact, dim, "k", "sk", "sk_fk"), "id", "sk_fk") == [(1, 5), (2, None), (3, None)]


def test_dense_key_is_dense_and_ordered(hot):
    df, data = hot
    keyed = ranged.dense_key(df, ["k", "t"], "sk")
    got = sorted((r.sk, r.id) for r in keyed.collect())
    assert [sk for sk, _ in got] == list(range(1, len(data) + 1))
    order = sorted(data, key=lambda r: ((r[1] is not None, r[1] or ""), r[2], r[0], r[3]))
    assert [i for _, i in got] == [r[0] for r in order]


def test_dense_key_uses_several_tasks(hot):
    df, _ = hot
    frozen = ranged._frozen(df, ["k", "t"], True)
    sizes = [r["count"] for r in frozen.groupBy("__part").count().collect()]
    assert len(sizes) >= 1 and sum(sizes) == 3000
    plan = ranged.dense_key(df, ["k"], "sk")._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and "CartesianProduct" not in plan


def test_copies_are_spread_and_numbered(spark):
    """Two thirds of the rows are copies of one row."""
    df = spark.range(3000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).alias("k"), F.lit("x").alias("v")
    )
    assert sorted(r.sk for r in ranged.dense_key(df, ["k"], "sk").collect()) == list(range(1, 3001))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frozen = ranged._frozen(df, ["k"], False).where("k = 7")
        assert frozen.select("__part").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    lagged = ranged.ordered_lag(df, ["k"], ["v"], {"before": "v"})
    assert lagged.where("before IS NULL").count() == df.select("k").distinct().count()


@pytest.mark.parametrize("distinct", [True, False])
def test_hot_keys_are_numbered_by_ranges(hot, distinct):
    """The same numbers, whether a key's rows are numbered in one task or by ranges."""
    df, data = hot
    expected = {r.id: r.sk for r in ranged.dense_key(df, ["k"], "sk").collect()}
    by_ranges = ranged.dense_key(df, ["k"], "sk", distinct=distinct, rows_per_key=100)
    assert {r.id: r.sk for r in by_ranges.collect()} == expected
    order = sorted(data, key=lambda r: ((r[1] is not None, r[1] or ""), r[0], r[2], r[3]))
    assert [expected[r[0]] for r in order] == list(range(1, len(data) + 1))


def test_dense_key_of_a_unique_key(spark, hot, monkeypatch):
    """Numbers come from the key table; the sums of partitions go through two levels."""
    df, data = hot
    monkeypatch.setattr(ranged, "_FAN_IN", 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sorted((r.sk, r.id) for r in ranged.dense_key_of(df, ["k", "id"], "sk", df.select("id", "k")).collect())
        general = sorted((r.sk, r.id) for r in ranged.dense_key(df, ["k", "id"], "sk").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    order = sorted(data, key=lambda r: ((r[1] is not None, r[1] or ""), r[0]))
    assert found == general == [(n, r[0]) for n, r in enumerate(order, 1)]


def test_dense_key_of_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    assert ranged.dense_key(empty, ["k"], "sk").collect() == []
    assert ranged.dense_key_of(empty, ["k"], "sk").collect() == []


def test_ordered_lag_over_a_hot_key(hot):
    df, data = hot
    lagged = ranged.ordered_lag(df, ["k"], ["t", "id"], {"pid": "id", "pv": "v"})
    groups = defaultdict(list)
    for i, k, t, v in data:
        groups[k].append((t, i, v))
    expected = {}
    for group in groups.values():
        previous = (None, None)
        for t, i, v in sorted(group):
            expected[i] = previous
            previous = (i, v)
    assert {r.id: (r.pid, r.pv) for r in lagged.collect()} == expected


def test_lag_moves_only_the_borders(hot):
    """After the rows are stored in order nothing but one row per partition is shuffled."""
    df, _ = hot
    lagged = ranged.ordered_lag(df, ["k"], ["t", "id"], {"pid": "id"}, distinct=True)
    plan = lagged._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(moved) <= 2 and all("SinglePartition" in m or "Broadcast" in m for m in moved), plan


def test_group_measures_keep_every_row(hot):
    df, data = hot
    sizes = defaultdict(int)
    for r in data:
        sizes[r[1]] += 1
    plain = windows.group_count(df, ["k"], "n")
    assert {r.id: r.n for r in plain.collect()} == {r[0]: sizes[r[1]] for r in data}
    salted = windows.with_group_measures(df, ["k"], {"n": F.count("*")}, salted=True, rows_per_task=150)
    assert {r.id: r.n for r in salted.collect()} == {r[0]: sizes[r[1]] for r in data}


def test_keep_first_is_deterministic_and_idempotent(hot, rows):
    df, data = hot
    once = dedupe.latest_per_key(df, ["k"], "t")
    assert rows(dedupe.latest_per_key(once, ["k"], "t")) == rows(once)
    assert rows(dedupe.latest_per_key(df.repartition(3), ["k"], "t")) == rows(once)
    assert once.count() == len({r[1] for r in data})
    best = max(r[2] for r in data if r[1] == "hot")
    assert once.where("k = 'hot'").first().t == best


def test_keep_first_limits_groups_before_the_shuffle(hot):
    df, _ = hot
    plan = dedupe.latest_per_key(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_nulls_in_sort_keys(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3)], "k string, t int, id int")
    assert rows(dedupe.latest_per_key(df, ["k"], "t"), "id") == [(2,), (3,)]
    assert rows(dedupe.earliest_per_key(df, ["k"], "t"), "id") == [(2,), (3,)]


def test_majority_ties(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z"), (2, "z"), (2, "a")], "k int, v string")
    assert rows(dedupe.majority(df, ["k"], ["v"])) == [(1, "a"), (2, "z")]


def test_duplicates(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(dedupe.duplicate_rows(df)) == [(None,), (1,), (1,)]
    assert rows(dedupe.duplicate_groups(df, ["k"])) == [(None, 2), (1, 3)]
    assert rows(dedupe.duplicate_report(df)) == [(6, 3, 3, 50.0)]
    assert rows(dedupe.duplicate_report(df.limit(0))) == [(0, 0, 0, None)]


def test_profiles(spark, rows):
    df = spark.createDataFrame([(1, None), (3, "x")], "n int, s string")
    assert rows(profiles.null_profile(df)) == [("n", 0, 0.0), ("s", 1, 50.0)]
    assert rows(profiles.column_profile(df, ["n"]), "row_count", "mean", "min", "max") == [(2, 2.0, 1.0, 3.0)]
    assert rows(profiles.schema_of(df)) == [("n", "int", True), ("s", "string", True)]
    assert rows(profiles.integrity_gap(df, df.where("n = 1"), "n")) == [(2, 1, 50.0)]
    assert rows(profiles.missing_when(df, F.col("n") == 1, ["s"])) == [("s", 1, 50.0)]
