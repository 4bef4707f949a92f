"""Parsing, counters, replay and expiry."""

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tamarind.plans import serving
from tamarind.streaming import measures
from tamarind.streaming.events import FLAT_FIELDS, flatten, flatten_all, parse
from tamarind.streaming.store import EventStore, live_orders, running_latest

START = datetime(2024, 1, 10)


def message(order, hours, **changes):
    flat = {
        "order_id": order, "order_status": "delivered", "order_purchase_timestamp": str(START), "delivery_days": 4,
        "customer_state": "SP", "customer_city": "sao paulo", "seller_state": "RJ", "seller_city": "rio",
        "product_category_name": "x", "product_category_name_english": "toys", "product_photos_qty": 2,
        "product_weight_g": 100, "product_description_length": 9, "price": 40.0, "freight_value": 10.0,
        "payment_type": "boleto", "payment_value": 50.0, "payment_installments": 1, "review_score": 5,
        "review_has_comment": True, **changes,
    }
    event = {part: {f: flat[f] for f in fields} for part, fields in FLAT_FIELDS.items()}
    return json.dumps({"event_timestamp": str(START + timedelta(hours=hours)), **event})


FIRST = [message("o1", 0), message("o2", 1, customer_state="RJ", price=400.0), "not json", '{"event_timestamp": "x"}']
SECOND = [message("o1", 30, order_status="canceled", payment_value=0.0), message("o3", 31, product_category_name_english=None)]


def drop(folder, name, lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def play(spark, store, folder, checkpoint):
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))
    store.start(raw, str(checkpoint), {"availableNow": True}).awaitTermination()


@pytest.fixture
def played(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    store = EventStore(spark, str(tmp_path / "store"))
    drop(folder, "a.txt", FIRST)
    play(spark, store, folder, tmp_path / "cp")
    drop(folder, "b.txt", SECOND)
    play(spark, store, folder, tmp_path / "cp")
    return store


def test_parse_separates_bad_messages(spark):
    raw = spark.createDataFrame([(m,) for m in [*FIRST, None]], "value string")
    parsed = parse(raw)
    assert flatten(parsed).count() == 2 and len(flatten(parsed).columns) == 21
    assert flatten_all(parsed).where("NOT is_valid").count() == 3


def test_each_message_is_parsed_once(spark):
    raw = spark.createDataFrame([(m,) for m in FIRST], "value string")
    plan = measures.dimension_counts(flatten(parse(raw)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def counters(df):
    return sorted(map(tuple, df.select("dim", "label", "event_count").collect()))


def test_stream_totals_equal_batch_totals(spark, played):
    raw = spark.createDataFrame([(m,) for m in FIRST + SECOND], "value string")
    flat = flatten(parse(raw))
    assert counters(played.read("counters")) == counters(measures.dimension_counts(flat))
    assert played.read("metrics").first() == measures.metric_sums(flat).first()
    assert sorted(r.value for r in played.rejects().collect()) == sorted(FIRST[2:])


def test_counters(played):
    got = {(d, x): n for d, x, n in counters(played.read("counters"))}
    assert got["state", "SP"] == 3 and got["state", "RJ"] == 1 and got["category", "None"] == 1
    assert got["price_bucket", "Above R$400"] == 1 and got["review_has_comment", "yes"] == 4
    assert len({d for d, _ in got}) == 13


def test_replayed_batch_changes_nothing(spark, played):
    before = counters(played.read("counters")), played.read("metrics").first(), played.read("latest").count()
    raw = spark.createDataFrame([(m,) for m in SECOND], "value string")
    played.apply(flatten_all(parse(raw)), 1)
    assert (counters(played.read("counters")), played.read("metrics").first(), played.read("latest").count()) == before


def test_folding_batches_keeps_the_totals(spark, played):
    tables = ("counters", "metrics", "latest", "recent")
    before = {t: sorted(map(str, played.read(t).collect())) for t in tables}
    played.fold(0)
    assert {t: sorted(map(str, played.read(t).collect())) for t in tables} == before
    played.fold(1)
    played.fold(1)
    assert {t: sorted(map(str, played.read(t).collect())) for t in tables} == before
    played.apply(flatten_all(parse(spark.createDataFrame([(message("o9", 40),)], "value string"))), 2)
    assert played.read("metrics").first().total_orders == 5


def test_empty_batch_writes_nothing(spark, played):
    before = counters(played.read("counters"))
    played.apply(flatten_all(parse(spark.createDataFrame([], "value string"))), 99)
    assert counters(played.read("counters")) == before


def test_latest_recent_and_expiry(played):
    latest = {r.order_id: r.order_status for r in played.read("latest").collect()}
    assert latest == {"o1": "canceled", "o2": "delivered", "o3": "delivered"}
    assert sorted(r.order_id for r in played.live(24).collect()) == ["o1", "o3"]
    assert [r.order_id for r in played.read("recent").collect()] == ["o3", "o1", "o2", "o1"]
    assert EventStore(played.spark, played.root, keep_recent=2).read("recent").count() == 2


def test_serving(played):
    kpi = serving.kpi_row(played.read("metrics")).first()
    assert kpi.total_orders == 4 and kpi.total_revenue == 150.0 and kpi.avg_order_value == 37.5
    assert kpi.avg_freight_pct == 20.0, "only events with a payment count"
    nothing = serving.kpi_row(played.read("metrics").select([F.lit(0).alias(c) for c in played.read("metrics").columns]))
    assert nothing.first().avg_score == 0
    counts = played.read("counters")
    assert [r.label for r in serving.numeric_distribution(counts, "installments", "x").collect()] == ["1x"]
    assert [r.label for r in serving.bucket_distribution(counts, "price_bucket", serving.PRICE_LABELS).collect()] == [
        "Under R$50", "Above R$400",
    ]
    assert [tuple(r) for r in serving.state_comparison(counts).collect()] == [("SP", 3, 0), ("RJ", 1, 4)]
    feed = serving.live_feed(serving.recent_details(played.read("recent"), played.read("latest"), 2))
    assert feed.columns[0] == "Order Id" and feed.count() == 2


def test_batches_are_folded_on_an_interval(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"), fold_every=4, expire_hours=1)
    plain = EventStore(spark, str(tmp_path / "plain"), fold_every=0)
    for batch in range(6):
        rows = spark.createDataFrame([(message(f"o{batch}", 10 * batch),)], "value string")
        for s in (store, plain):
            s.apply(flatten_all(parse(rows)), batch)
    folds = {p.name for p in (tmp_path / "store" / "counters_folded").iterdir() if p.is_dir()}
    assert folds == {"upto=3"} and not (tmp_path / "plain" / "counters_folded").exists()
    assert counters(store.read("counters")) == counters(plain.read("counters"))
    assert store.read("metrics").first() == plain.read("metrics").first()
    newest = plain.read("latest")
    assert store.read("latest").count() == measures.unexpired(newest, 1).count() <= newest.count()


def test_counts_of_named_dimensions(spark, played):
    flat = spark.read.parquet(f"{played.root}/events").where("is_valid")
    full = counters(measures.dimension_counts(flat))
    some = counters(measures.dimension_counts(flat, ["state", "status"]))
    assert some == [c for c in full if c[0] in ("state", "status")] and some


def folders(root):
    return sorted(f"{t.name}/{p.name}" for t in root.iterdir() if t.is_dir() for p in t.iterdir() if p.is_dir())


def test_fifty_batches_leave_few_folders(spark, tmp_path):
    """Also one that is replayed after it was folded, one replayed before, and one empty."""
    root = tmp_path / "store"
    store = EventStore(spark, str(root), fold_every=5, tables=("counters", "late"))
    most, lines = 0, []
    for batch in range(50):
        line = [] if batch == 17 else [message(f"o{batch}", batch), "bad"]
        lines += line
        rows = flatten_all(parse(spark.createDataFrame([(m,) for m in line], "value string")))
        store.apply(rows, batch)
        if batch in (20, 23):
            store.apply(rows, batch)
        if batch == 30:
            store.apply(flatten_all(parse(spark.createDataFrame([(lines[6],)], "value string"))), 3)
        most = max(most, len([f for f in folders(root) if not f.startswith("_")]))
    assert most <= 2 * 3 * (5 + 1) + 2 * 3, "two intervals of batches and two folds of three tables"
    flat = flatten(parse(spark.createDataFrame([(m,) for m in lines], "value string")))
    assert counters(store.read("counters")) == counters(measures.dimension_counts(flat))
    assert store.rejects().count() == 49 and store.read("late").count() == 0
    manifest = store._manifest()[1]
    assert manifest["upto"] == 44 and manifest["batches"] == [45, 46, 47, 48, 49]


def test_a_batch_counts_when_its_manifest_is_there(spark, tmp_path, monkeypatch):
    store = EventStore(spark, str(tmp_path / "store"), tables=("metrics",))
    rows = [flatten_all(parse(spark.createDataFrame([(m,)], "value string"))) for m in (FIRST[0], FIRST[1])]
    store.apply(rows[0], 0)

    def lost(*_):
        raise OSError("the driver is gone")

    monkeypatch.setattr("tamarind.sources.versions.Pointer.switch", lost)
    with pytest.raises(OSError):
        store.apply(rows[1], 1)
    monkeypatch.undo()
    assert store.read("metrics").first().total_orders == 1
    store.apply(rows[1], 1)
    assert store.read("metrics").first().total_orders == 2


def test_a_failed_fold_changes_nothing(spark, played, monkeypatch):
    before = counters(played.read("counters"))

    def lost(*_):
        raise OSError("the driver is gone")

    monkeypatch.setattr("tamarind.sources.versions.Pointer.switch", lost)
    with pytest.raises(OSError):
        played.fold(1)
    monkeypatch.undo()
    assert counters(played.read("counters")) == before
    played.fold(1)
    assert counters(played.read("counters")) == before and played.rejects().count() == 2


def test_late_events_are_counted_apart(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "store"), late_hours=24, tables=("days", "late"))
    batches = [[("a", 0), ("b", 60)], [("c", 35), ("d", 36), ("e", 100)], [("f", 75), ("g", 76), ("h", 40)]]
    for n, batch in enumerate(batches):
        rows = spark.createDataFrame([(message(o, h),) for o, h in batch], "value string")
        store.apply(flatten_all(parse(rows)), n)
        store.apply(flatten_all(parse(rows)), n)
    # the first batch has nothing before it; limits after it are 60 - 24 and 100 - 24 hours
    assert sorted(r.order_id for r in store.read("late").collect()) == ["c", "f", "h"]
    days = {str(r.day): (r.events, r.late_events) for r in store.read("days").collect()}
    assert days == {"2024-01-10": (1, 0), "2024-01-11": (1, 2), "2024-01-12": (1, 0), "2024-01-13": (1, 1), "2024-01-14": (1, 0)}
    store.fold(2)
    assert {str(r.day): (r.events, r.late_events) for r in store.read("days").collect()} == days


def test_running_latest_has_a_time_limit(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    out = f"{tmp_path}/out"
    drop(folder, "a.txt", [message("o1", 0), message("o2", 1), message("o1", 2, order_status="shipped")])
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))

    def run():
        def keep(rows, n):
            rows.write.mode("overwrite").parquet(f"{out}/batch={n}")

        running = running_latest(parse(raw)).writeStream.outputMode("update").foreachBatch(keep)
        query = running.option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        query.awaitTermination()
        return [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]

    run()
    drop(folder, "b.txt", [message("o3", 90), message("o1", 91, order_status="canceled")])
    run()
    drop(folder, "c.txt", [message("o2", 3), message("o4", 92)])
    states = run()
    live = live_orders(spark.read.parquet(out).drop("batch"))
    assert {r.order_id: r.order_status for r in live.collect()} == {"o1": "canceled", "o3": "delivered", "o4": "delivered"}
    assert states[-1].numRowsTotal <= 3, "the windows of the first file are gone"


def test_topic_takes_less_room_than_its_messages_and_gives_the_same_days(spark, tmp_path):
    from tamarind.catalog import load, streams
    from tamarind.catalog.roles import Roles

    lines = spark.range(3000).selectExpr(
        "id DIV 3 AS l_orderkey", "CAST(id % 3 + 1 AS INT) AS l_linenumber", "id * 7 % 200 AS l_partkey", "id % 10 AS l_suppkey",
        "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity", "CAST(id % 977 + 900 AS DOUBLE) AS l_extendedprice",
        "CAST(id % 11 AS DOUBLE) / 100 AS l_discount", "0.05D AS l_tax", "substr('ANR', CAST(id % 3 + 1 AS INT), 1) AS l_returnflag",
        "'O' AS l_linestatus", "timestamp_ntz '2024-01-01' + make_dt_interval(CAST(id * 37 % 900 AS INT)) AS l_shipdate",
    )
    # files of other sizes, one of them with orders of one part only
    lines.where("id < 2000").repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    lines.where("id >= 2000 AND l_orderkey % 5 = 1").repartition(1).write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    r = Roles(spark, str(tmp_path))
    flat = r.role("flat_events")
    plain = streams._messages(flat).agg(F.sum(F.length("value"))).first()[0]
    before = set(Path(spark.conf.get("spark.checkpoint.dir")).glob("topic-*"))
    got = {d.day: (d.events, d.late_events) for d in load()["stream_day_windows"].run(spark, str(tmp_path)).collect()}
    (topic,) = set(Path(spark.conf.get("spark.checkpoint.dir")).glob("topic-*")) - before
    assert sum(p.stat().st_size for p in topic.rglob("*") if p.is_file()) < plain / 4
    assert sum(p.read_bytes()[:2] == b"\x1f\x8b" for p in topic.rglob("part-*")) > 5, "several files a part"
    days = flat.groupBy(F.substring("event_timestamp", 1, 10).alias("d")).count().collect()
    assert sum(n + late for n, late in got.values()) == flat.count() and {d: sum(n) for d, n in got.items()} == {d.d: d["count"] for d in days}


def test_a_store_of_one_table_keeps_no_valid_messages(spark, tmp_path):
    lone = {t: EventStore(spark, f"{tmp_path}/{t}", fold_every=0, tables=(t,)) for t in ("counters", "metrics", "days")}
    full = EventStore(spark, f"{tmp_path}/full", fold_every=0, late_hours=24)
    for n, lines in enumerate((FIRST, SECOND, [message("o4", 2)])):
        batch = flatten_all(parse(spark.createDataFrame([(m,) for m in lines], "value string")))
        for store in (full, *lone.values()):
            store.apply(batch, n)
    for table, store in lone.items():
        assert sorted(map(str, store.read(table).collect())) == sorted(map(str, full.read(table).collect()))
        assert spark.read.parquet(f"{store.root}/events").count() == 2 == store.rejects().count()
        store.fold(1)
        assert sorted(map(str, store.read(table).collect())) == sorted(map(str, full.read(table).collect()))
        assert sorted(r.value for r in store.rejects().collect()) == sorted(r.value for r in full.rejects().collect())


def test_expired_events_are_dropped_before_their_orders_meet(spark, tmp_path):
    batches = [
        [message("o1", 0), message("o2", 50), message("o3", 60)],
        [message("o1", 1), message("o3", 60, order_status="canceled"), message("o2", 20), message("o4", 37)],
        [message("o2", 61), message("o4", 30), message("o5", 85)],
    ]
    short = EventStore(spark, f"{tmp_path}/short", fold_every=0, tables=("latest",), expire_hours=24)
    full = EventStore(spark, f"{tmp_path}/full", fold_every=0)
    for n, lines in enumerate(batches):
        for store in (short, full):
            store.apply(flatten_all(parse(spark.createDataFrame([(m,) for m in lines], "value string"))), n)
    assert spark.read.parquet(f"{short.root}/latest/batch_id=1").count() == 2
    wanted = {"o5": "delivered"}
    for store in (short, full):
        assert {r.order_id: r.order_status for r in store.live().collect()} == wanted
    assert {r.order_id: r.order_status for r in full.live(26).collect()} == {**wanted, "o2": "delivered", "o3": "canceled"}
    for live in (full.live(), live_orders(full.read("latest").withColumn("window_start", F.lit(0)))):
        plan = live._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("row_number()") < plan.index("scalar-subquery")
