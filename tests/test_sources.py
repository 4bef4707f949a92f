"""Writers, exports, catalog (S01-S26). JDBC needs a database and is not run here."""

import pytest
from pyspark.sql import functions as F

from tamarind.plans.marts import publish
from tamarind.session import build_session, initial_partitions, scratch_path, shared_folder
from tamarind.sources import tables
from tamarind.sources.jdbc import Warehouse
from tamarind.sources.tables import Lake
from tamarind.sources.versions import Conflict, Pointer


def test_write_replaces_schema_and_counts(spark, tmp_path):
    lake = tables.Lake(spark, str(tmp_path))
    lake.write(spark.range(3), "t")
    stored, n = lake.write_counted(spark.range(5).select(F.col("id").alias("other")), "t")
    assert lake.write_counted(spark.range(5).where("id > 9"), "none")[1] == 0
    assert n == 5 and stored.columns == ["other"] and lake.read("t").count() == 5


def test_append_with_new_columns(spark, tmp_path, rows):
    lake = tables.Lake(spark, str(tmp_path))
    lake.append(spark.createDataFrame([(1,)], "a int"), "t")
    lake.append(spark.createDataFrame([(2, "x")], "a int, b string"), "t")
    assert rows(lake.read_evolved("t"), "a", "b") == [(1, None), (2, "x")]


def test_exports(spark, tmp_path):
    df = spark.range(100).repartition(4)
    tables.export_parquet(df, str(tmp_path / "many"))
    tables.export_parquet(df, str(tmp_path / "one"), single_file=True)
    parts = lambda d: len(list((tmp_path / d).glob("part-*.parquet")))
    assert parts("many") == 4 and parts("one") == 1
    assert spark.read.parquet(str(tmp_path / "one")).count() == 100


def test_catalog(spark):
    tables.reset_namespace(spark, "layer_x")
    tables.create_namespaces(spark, "layer_x")
    tables.save_as_table(spark.range(2), "layer_x.mart_a")
    tables.save_as_table(spark.range(3), "layer_x.mart_a")
    assert [r.table_name for r in tables.list_tables(spark, "layer_x", "mart_*").collect()] == ["mart_a"]
    assert spark.table("layer_x.mart_a").count() == 3
    assert "layer_x" in [r.schema_name for r in tables.list_namespaces(spark).collect()]
    tables.drop_tables(spark, "layer_x.mart_a")
    assert tables.list_tables(spark, "layer_x").count() == 0
    tables.reset_namespace(spark, "layer_x")


def test_lineage(spark, tmp_path):
    tables.export_parquet(spark.range(1), str(tmp_path / "x"))
    traced = tables.with_lineage(spark.read.parquet(str(tmp_path / "x")))
    assert traced.first()._source_file.endswith(".parquet")
    assert tables.without_lineage(traced).columns == ["id"]
    assert tables.preview(spark.range(9), 2).count() == 2


def test_csv_with_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n')
    assert tables.read_csv(spark, str(tmp_path / "a.csv"), "a int, b string", multi_line=True).first() == (1, "x\ny")


def test_scratch_follows_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(folder) and scratch_path(spark, "x") != scratch_path(spark, "x")
    assert initial_partitions(10**14) > 700_000 and initial_partitions(1) == 200
    assert build_session().conf.get("spark.sql.adaptive.enabled") == "true"


def test_publishing_names_every_table(spark):
    class Recorder:
        def __init__(self):
            self.written = {}

        def write(self, df, table):
            self.written[table] = df.count()

    recorder = Recorder()
    publish({"a": spark.range(2), "b": spark.range(3)}, recorder, "mart")
    assert recorder.written == {"mart.a": 2, "mart.b": 3}


def test_jdbc_settings(spark):
    w = Warehouse(spark, "jdbc:example:db", {"user": "u"})
    assert w.properties == {"user": "u"} and w.url == "jdbc:example:db"


def test_a_table_replaces_itself(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(spark.range(5).withColumn("n", F.lit(0)), "t")
    for round_ in range(1, 4):
        changed = lake.replace("t", lambda old: old.withColumn("n", F.col("n") + 1))
        assert [(r.id, r.n) for r in changed.orderBy("id").collect()] == [(i, round_) for i in range(5)]
    folders = [p.name for p in (tmp_path / "t__versions").iterdir() if not p.name.startswith("_")]
    assert len(folders) == 2, "the newest version and the one before"
    lake.write(spark.range(2), "t")
    assert lake.read("t").count() == 2 and lake.read("t").columns == ["id"]


def test_a_failure_before_the_switch_leaves_the_old_version(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    lake.write(spark.range(3), "t")
    lake.replace("t", lambda old: old.withColumn("n", F.lit("old")))
    reader = lake.read("t")

    def lost(*_):
        raise OSError("the driver is gone")

    monkeypatch.setattr(Pointer, "switch", lost)
    with pytest.raises(OSError):
        lake.replace("t", lambda old: old.withColumn("n", F.lit("new")))
    monkeypatch.undo()
    assert {r.n for r in lake.read("t").collect()} == {r.n for r in reader.collect()} == {"old"}
    lake.replace("t", lambda old: old.withColumn("n", F.lit("new")))
    assert {r.n for r in reader.collect()} == {"old"}, "a running reader keeps its version"


def test_two_writers_cannot_switch_from_the_same_version(spark, tmp_path):
    pointer = Pointer(spark, str(tmp_path / "p"))
    assert pointer.current() == (0, {})
    assert pointer.switch(0, {"a": 1}) == 1
    with pytest.raises(Conflict):
        pointer.switch(0, {"a": 2})
    assert pointer.current() == (1, {"a": 1})
    for seen in range(1, 30):
        pointer.switch(seen, {"a": seen})
    assert pointer.current() == (30, {"a": 29}) and len(list((tmp_path / "p").glob("*.json"))) <= 8


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    left = lake.write_bucketed(spark.range(100).selectExpr("cast(id as string) k", "id"), "a", ["k"])
    right = lake.write_bucketed(spark.range(50).selectExpr("cast(id as string) k", "id * 2 AS m"), "b", ["k"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "k", "left").groupBy("k").agg(F.sum("m").alias("m"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.agg(F.sum("m")).first()[0] == 2450 and joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    again = lake.write_bucketed(spark.range(3).selectExpr("cast(id as string) k"), "a", ["k"])
    assert again.count() == 3
