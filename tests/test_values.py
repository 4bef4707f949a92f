"""Text, number and time helpers (F01-F35) and type enforcement."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tamarind.functions import numbers, temporal, text
from tamarind.operators.aggregates import histogram, label_rank, numeric_order, share_of_total, sorted_values
from tamarind.sources.tables import empty_like, enforce_types, unique_columns


def one(spark, expression, *values):
    schema = ", ".join(f"c{i} {t}" for i, (_, t) in enumerate(values))
    return spark.createDataFrame([tuple(v for v, _ in values)], schema).select(expression).first()[0]


def test_clean_text_handles_upper_case_accents(spark):
    raw = "  SÃO João Çà Ê  "
    assert one(spark, text.clean_text("c0"), (raw, "string")) == "sao joao ca e"


def test_lookups(spark):
    assert one(spark, text.region_of("c0"), ("SP", "string")) == "Southeast"
    assert one(spark, text.region_of("c0"), ("XX", "string")) == "Unknown"
    assert one(spark, text.region_of("c0"), (None, "string")) == "Unknown"
    assert one(spark, text.state_name("c0"), ("SP", "string")) == "São Paulo"
    assert one(spark, text.state_name("c0"), ("XX", "string")) == "XX"
    assert one(spark, text.lookup("c0", {"it's": "quoted 'x'"}), ("it's", "string")) == "quoted 'x'"


def test_display_helpers(spark):
    assert one(spark, text.mask_id("c0"), ("abcdefghijkl", "string")) == "abcdefgh..."
    assert one(spark, text.strip_prefix("c0", "counters:"), ("counters:x", "string")) == "x"
    assert one(spark, text.strip_prefix("c0", "counters:"), ("other:x", "string")) == "other:x"
    assert text.titled(spark.range(1).withColumnRenamed("id", "order_item_id")).columns == ["Order Item Id"]


def test_ratios_never_raise(spark):
    assert one(spark, numbers.ratio("c0", "c1"), (1, "int"), (0, "int")) == 0.0
    assert one(spark, numbers.ratio("c0", "c1"), (1, "int"), (4, "int")) == 0.25
    assert one(spark, numbers.share("c0", "c1"), (1, "int"), (0, "int")) is None
    assert one(spark, numbers.share("c0", "c1"), (1, "int"), (3, "int")) == 33.33
    assert one(spark, numbers.to_number("c0"), ("abc", "string")) is None
    sizes = [(Decimal("1.50"), "decimal(18,2)"), (Decimal("2.00"), "decimal(18,2)"), (Decimal("3.00"), "decimal(18,2)")]
    assert one(spark, numbers.volume("c0", "c1", "c2"), *sizes) == Decimal("9.00")


def test_durations(spark):
    a, b = datetime(2020, 1, 1, 23, 0), datetime(2020, 1, 2, 1, 30)
    assert one(spark, temporal.days_between("c0", "c1"), (a, "timestamp_ntz"), (b, "timestamp_ntz")) == 1
    assert one(spark, temporal.hours_between("c0", "c1"), (a, "timestamp_ntz"), (b, "timestamp_ntz")) == 2.5
    assert one(spark, temporal.plus_days("c0", 7), (a, "timestamp_ntz")) == datetime(2020, 1, 8)
    assert one(spark, temporal.plus_seconds("c0", 90), (a, "timestamp_ntz")) == datetime(2020, 1, 1, 23, 1, 30)
    assert one(spark, temporal.wall_clock("c0"), ("not a time", "string")) is None
    assert one(spark, temporal.clock_label("c0"), ("2020-01-01 10:20:30", "string")) == "10:20:30"


def test_results_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        value = one(spark, temporal.plus_seconds(temporal.wall_clock("c0"), 3600), ("2018-11-03 23:30:00", "string"))
        assert value == datetime(2018, 11, 4, 0, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("day", [date(2015, 1, 1), date(2016, 2, 29), date(2017, 1, 1), date(2019, 12, 31), date(2020, 6, 30)])
def test_calendar_matches_the_standard_library(spark, day):
    df = spark.createDataFrame([(day,)], "full_date date")
    got = df.select(*[c.alias(n) for n, c in temporal.calendar_attributes().items()]).first().asDict()
    assert got["date_sk"] == int(day.strftime("%Y%m%d"))
    assert got["week_of_year"] == int(day.strftime("%U"))
    assert got["month_name"] == day.strftime("%B") and got["day_name"] == day.strftime("%A")
    assert got["is_weekend"] == (day.weekday() >= 5)
    assert got["is_quarter_end"] == ((day.month, day.day) in {(3, 31), (6, 30), (9, 30), (12, 31)})
    assert got["is_year_start"] == ((day.month, day.day) == (1, 1))


def test_enforce_types_and_columns(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert enforce_types(df, {"a": "int", "b": "int", "zz": "int"}).first() == (1, None)
    with pytest.raises(ValueError):
        enforce_types(df, {"zz": "int"}, strict=True)
    doubled = df.select("*", F.lit("y").alias("a"))
    assert unique_columns(doubled).first().asDict() == {"a": "1", "b": "x"}
    assert empty_like(df).count() == 0 and empty_like(df).schema == df.schema


def test_shares_ranks_and_bins(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 9)], "k string, v int")
    assert rows(share_of_total(df, "k")) == [(None, 1, 25.0), ("a", 2, 50.0), ("b", 1, 25.0)]
    assert rows(df.select(label_rank("k", ["b", "a"]))) == [(0,), (1,), (1,), (2,)]
    assert [r[0] for r in df.select(F.col("v").cast("string").alias("v")).orderBy(numeric_order("v")).collect()] == ["1", "2", "3", "9"]
    assert rows(histogram(df, "v", 4)) == [(0, 2, 1.0), (1, 1, 3.0), (3, 1, 7.0)]
    assert rows(histogram(df.where("v = 1"), "v", 4)) == [(0, 1, 1.0)]
    assert sorted_values(df, ["k"], "v", "vs").where("k = 'a'").first()["vs"] == [1, 2]
