"""Boundary values of the classifiers (C01-C40) and predicates."""

import pytest
from pyspark.sql import functions as F

from tamarind.functions import classify as rule
from tamarind.functions import fixed
from tamarind.functions import predicates as test


def labels(spark, values, type_, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(expression("x")).collect()]


@pytest.mark.parametrize(
    "expression, values, expected",
    [
        (lambda c: rule.band(c, fixed.DELIVERY_DETAIL, "none"), [-8, -7, -6, -1, 0, 1, 3, 4, 7, 8, None],
         ["Very Early", "Very Early", "Early", "Early", "On Time", "Slight Delay", "Slight Delay", "Late", "Late",
          "Critical Delay", "none"]),
        (rule.product_size, [0, 5000, 5001, 20000, 20001, None], ["Small", "Small", "Medium", "Medium", "Large", "Unknown"]),
        (rule.parcel_size, [0, 1, 5000, 20000, 20001, None],
         ["Unknown Size", "Small Box", "Small Box", "Medium Box", "Large Parcel", "Large Parcel"]),
        (rule.parcel_weight, [-1, 2000, 10000, 10001, None],
         ["Unknown Weight", "Lightweight", "Midweight", "Heavyweight", "Heavyweight"]),
        (rule.is_heavy, [9999, 10000, None], [False, True, False]),
        (rule.review_label, [1, 3, 4, None], ["Unsatisfied", "Neutral", "Satisfied", "Unsatisfied"]),
        (rule.sentiment, [2, 3, 5], ["Negative", "Neutral", "Positive"]),
        (rule.workload_bucket, [9, 10, 49, 50, 99, 100, None],
         ["Low Volume", "Normal Volume", "Normal Volume", "High Volume", "High Volume", "Overloaded", "Low Volume"]),
        (rule.loyalty, [1, 2, 4, 5], ["New", "Repeat", "Repeat", "Elite"]),
        (rule.seller_size, [49, 50, 500, 501], ["Small Seller", "Medium Seller", "Medium Seller", "Large Seller"]),
        (rule.on_time_flag, [-1, 0, 1, None], [1, 1, 0, 0]),
        (rule.several, [1, 2, None], [False, True, None]),
    ],
)
def test_integer_bands(spark, expression, values, expected):
    assert labels(spark, values, "int", expression) == expected


@pytest.mark.parametrize(
    "expression, values, expected",
    [
        (rule.on_time_grade, [0.9, 0.89, 0.75, 0.5, 0.49], ["Excellent", "Good", "Good", "Fair", "Poor"]),
        (lambda c: rule.band(c, fixed.GROWTH, "Stable"), [0.5, 0.1, 0.09, -0.09, -0.1, None],
         ["High Growth", "Moderate Growth", "Stable", "Stable", "Declining", "Stable"]),
        (rule.price_bucket, [49.99, 50.0, 100.0, 200.0, 400.0],
         ["Under R$50", "R$50-100", "R$100-200", "R$200-400", "Above R$400"]),
        (rule.freight_bucket, [14.99, 15.0, 30.0, 50.0], ["Under R$15", "R$15-30", "R$30-50", "Above R$50"]),
        (rule.is_high_freight, [0.3, 0.31], [False, True]),
        (lambda c: rule.is_high_freight(c, inclusive=True), [0.3, 0.29], [True, False]),
        (rule.is_high_ticket, [499.99, 500.0], [False, True]),
        (rule.discrepancy_type, [0.01, -0.01], ["Overpayment (Paid > Cost)", "Underpayment (Paid < Cost)"]),
    ],
)
def test_double_bands(spark, expression, values, expected):
    assert labels(spark, values, "double", expression) == expected


def test_text_rules(spark):
    assert labels(spark, ["credit_card", "debit_card", "boleto", "voucher", "pix", None], "string", rule.payment_category) == [
        "Card", "Card", "Boleto", "Voucher", "Other", "Other",
    ]
    assert labels(spark, ["On Time", "Late", "Early"], "string", rule.delivery_group) == ["Successful", "Delayed", "Other"]
    assert labels(spark, ["Positive", "Neutral", "Negative", None], "string", rule.sentiment_band) == [
        "Score 4-5", "Score 3", "Score 1-2", "Unknown",
    ]
    assert labels(spark, ["a" * 32, "F0" * 16, "g" * 32, "a" * 31], "string", test.is_hex_id) == [True, True, False, False]


def test_lifecycle_variants(spark):
    data = [("canceled", 1), ("invoiced", None), ("delivered", -1), ("delivered", 0), ("delivered", 1), ("delivered", None), ("x", 0)]
    df = spark.createDataFrame(data, "order_status string, gap int")
    got = df.select(
        rule.delivery_category(gap="gap"), rule.delivery_detail_refined(gap="gap"),
        rule.seller_performance(gap="gap"), rule.seller_performance_refined(gap="gap"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Canceled",) * 4,
        ("In Progress", "In Progress", "In Progress", "Unknown"),
        ("Early",) * 4,
        ("On Time",) * 4,
        ("Late", "Late", "Late Delivery to Carrier", "Late Delivery to Carrier"),
        ("Unknown", None, "Unknown", "Unfulfilled"),
        ("Unknown", "Other", "Unknown", "Unknown"),
    ]


def test_pair_rules(spark):
    df = spark.createDataFrame(
        [(1, 3, "N", "N"), (0, 4, "N", "S"), (1, 5, None, "S"), (None, 1, "N", None)], "delay int, score int, a string, b string"
    )
    got = df.select(
        rule.late_and_unhappy("delay", "score"), rule.experience_segment("delay", "score"), rule.distance_bucket("a", "b")
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, "Delivery Impacted Review", "Same Region"),
        (False, "Good Experience", "Cross Region"),
        (False, "Mixed Experience", "Unknown"),
        (None, "Mixed Experience", "Unknown"),
    ]


def test_growth_and_conversion(spark):
    df = spark.createDataFrame([(3, 2), (3, 0), (3, None)], "now int, before int")
    assert [r[0] for r in df.select(rule.growth_rate("now", "before")).collect()] == [0.5, None, None]
    deals = spark.createDataFrame([(True, 7), (True, 30), (True, 31), (True, None), (False, None)], "c boolean, d int")
    assert [r[0] for r in deals.select(rule.acquisition_segment("c", "d")).collect()] == [
        "Fast Conversion", "Normal Conversion", "Slow Conversion", "Unknown Conversion", "Not Converted",
    ]


def test_payment_rules(spark):
    df = spark.createDataFrame([("credit_card", 0), ("boleto", 0), ("credit_card", 3)], "t string, n int")
    assert [r[0] for r in df.select(rule.repaired_installments("t", "n")).collect()] == [1, 0, 3]
    paid = spark.createDataFrame([(None, None), (1.0, 0.5), (1.0, -0.5), (1.0, 0.0)], "p double, v double")
    assert [r[0] for r in paid.select(rule.payment_status("p", "v")).collect()] == [
        "no payment record", "overpaid", "underpaid", "matched",
    ]


def test_location_and_predicates(spark):
    df = spark.createDataFrame([("recife", "PE"), ("campinas", "SP"), ("palmas", "TO")], "city string, state string")
    assert [r[0] for r in df.select(rule.location_type("city", "state")).collect()] == ["Metropolitan", "Urban", "Regional"]
    points = spark.createDataFrame([(-34.0, -75.0), (6.1, -50.0), (None, -50.0)], "lat double, lng double")
    assert [r[0] for r in points.select(test.in_box("lat", "lng")).collect()] == [True, False, False]
    stages = spark.createDataFrame([(1, 2, 3), (1, 3, 2), (2, None, 1), (None, None, 1)], "a int, b int, c int")
    assert [r[0] for r in stages.select(test.out_of_order("a", "b", "c")).collect()] == [False, True, True, False]
    assert stages.where(test.any_null("a", "b")).count() == 2
    assert stages.where(test.all_present("a", "b", "c")).count() == 2
    assert stages.where(F.lit(True)).count() == 4
