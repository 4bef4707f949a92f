"""Bronze CSV to marts on the planted marketplace (FIXTURES.md, section 4)."""

from datetime import datetime

import pytest
from fixtures import BRONZE
from pyspark.sql import functions as F

from tamarind.plans import marts, pipeline, refined, staging
from tamarind.sources.audit import log_rejects, read_log
from tamarind.sources.tables import Lake, ingest

RUN_AT = datetime(2024, 5, 1, 3, 0)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("market")
    (folder / "csv").mkdir()
    for name, text in BRONZE.items():
        (folder / "csv" / pipeline.BRONZE_FILES[name]).write_text(text)
    run = pipeline.Run(spark, str(folder / "lake"), "run-1", RUN_AT)
    bronze = run.lake("bronze")
    run.ingested = ingest(bronze, str(folder / "csv"), pipeline.BRONZE_FILES, ingested_at=F.lit(RUN_AT), multi_line=pipeline.MULTI_LINE)
    run.summary = pipeline.run_pipeline(run, {t: bronze.read(t) for t in pipeline.BRONZE_FILES})
    return run


def by(df, key, *cols):
    return {r[0]: tuple(r)[1:] for r in df.select(key, *cols).collect()}


def test_ingestion_counts_and_multiline_text(run):
    assert run.ingested["order_reviews"] == 8 and run.ingested["order_items"] == 9
    review = run.lake("bronze").read("order_reviews").where("review_id = 'r1'").first()
    assert review.review_comment_message == 'good, "very"\ngood' and review._source_file == "order_reviews.csv"


def test_declared_schemas_give_the_same_entities(run, spark, tmp_path):
    """The run over typed bronze; broken lines go to the audit log, drift is reported."""
    (tmp_path / "csv").mkdir()
    for name, text in BRONZE.items():
        lines = text
        if name == "order_items":
            lines += "o6,three,p1,s1,2018-01-22 00:00:00,5.00,0.00\no6,4,p1\n"
        if name == "sellers":
            rows = [line.split(",") for line in text.splitlines()]
            lines = "\n".join(",".join([r[3], r[0], r[1], r[2], "new"]) for r in rows).replace("new", "grade", 1) + "\n"
        (tmp_path / "csv" / pipeline.BRONZE_FILES[name]).write_text(lines)
    other = pipeline.Run(spark, str(tmp_path / "lake"), "run-2", RUN_AT)
    landed = other.land(str(tmp_path / "csv"))
    assert landed.counts == run.ingested and {t: n for t, n in landed.rejected.items() if n} == {"order_items": 2}
    assert [tuple(r) for r in landed.drift.collect()] == [("sellers", "grade", "added")]
    log = read_log(other.lake("audit"), "bronze_order_items", "run-2")
    assert {r._corrupt_record for r in log.collect()} == {"o6,three,p1,s1,2018-01-22 00:00:00,5.00,0.00", "o6,4,p1"}
    pipeline.build_silver(other, {t: other.lake("bronze").read(t) for t in pipeline.BRONZE_FILES})
    for name in (t for t in other.tables if t.startswith("silver_")):
        columns = run.tables[name].columns
        assert sorted(map(str, other.tables[name].select(columns).collect())) == sorted(map(str, run.tables[name].collect())), name


def test_geolocation(run):
    got = by(run.tables["silver_geolocation"], "zip_code_prefix", "city", "state", "region", "median_latitude")
    assert got == {
        1000: ("sao paulo", "SP", "Southeast", -24.0),
        2000: ("alagoinhas", "BA", "Northeast", -11.0),
        4000: ("manaus", "AM", "North", -3.0),
    }


def test_customers_and_orders(run):
    customers = by(run.tables["silver_customers"], "customer_id", "customer_city", "customer_region", "median_latitude")
    assert customers["c1"] == ("sao paulo", "Southeast", -24.0) and customers["c3"] == ("nowhere", "Unknown", None)
    orders = by(run.tables["silver_orders"], "order_id", "delivery_status_category", "delivery_status_detail", "on_time_flag")
    assert orders == {
        "o1": ("Early", "Very Early", 1), "o2": ("Late", "Late", 0), "o3": ("In Progress", "Shipped", 0),
        "o4": ("On Time", "On Time", 1), "o5": ("Canceled", "Canceled", 0), "o6": ("Early", "Very Early", 1),
    }


def test_products(run):
    got = by(
        run.tables["silver_products"], "product_id", "product_category_name", "product_category_name_english",
        "product_weight_g", "product_size_category", "heavy_product_flag", "logistics_completeness_flag",
    )
    assert [str(v) for v in got["p2"]] == ["beleza_saude", "health_beauty", "500.00", "Medium", "False", "True"]
    assert got["p3"][1] == "pc_gamer" and got["p3"][3:] == ("Large", True, True)
    assert got["p4"][1] == "unknown" and got["p5"][0] == "unknown_category"
    assert got["p6"][2:] == (None, "Unknown", False, False)


def test_items(run):
    got = by(run.tables["silver_order_items"].where("order_item_id = 1"), "order_id", "product_id", "shipping_limit_date", "seller_performance")
    assert got["o1"][0] == "p1", "the duplicate key keeps the first row in total order"
    assert got["o2"][1] == datetime(2018, 1, 8), "too early a limit: approval day plus the median of two days"
    assert got["o3"][1] == datetime(2018, 3, 3) and got["o3"][2] == "In Progress"
    assert "oX" not in got


def test_payments_and_reviews(run):
    payments = run.tables["silver_payments"]
    assert payments.count() == 6 and payments.where("payment_type = 'credit_card' AND payment_installments = 0").count() == 0
    got = by(run.tables["silver_reviews"], "order_id", "review_id", "review_creation_date", "review_answer_timestamp")
    assert got["o1"][0] == "r2"
    assert got["o2"][2] == datetime(2018, 1, 27), "median response is one day"
    assert got["o3"] == ("r4", datetime(2018, 3, 8), datetime(2018, 3, 9))
    assert set(got) == {"o1", "o2", "o3", "o6"}


def test_acquisition_and_sellers(run):
    got = by(run.tables["seller_acquisition_staging"], "mql_id", "marketing_origin", "days_to_convert", "seller_acquisition_segment")
    assert got == {
        "m1": ("social", 7, "Fast Conversion"), "m2": ("unknown", 30, "Normal Conversion"),
        "m3": ("social", 31, "Slow Conversion"), "m4": ("paid", None, "Not Converted"),
    }
    sellers = by(run.tables["silver_sellers"], "seller_id", "total_items_sold", "has_sales", "marketing_origin", "days_to_convert")
    assert sellers["s1"] == (4, True, "social", 7) and sellers["s3"] == (0, False, "Not Tracked", -1)


def test_allocated_payments_add_up(run):
    sales = run.tables["sales_staging"]
    sums = sales.groupBy("order_id").agg(F.sum("allocated_payment_value").alias("a"), F.max("total_payment_value").alias("p"))
    for r in sums.collect():
        assert r.a == pytest.approx(float(r.p))
    o1 = by(sales.where("order_id = 'o1'"), "order_item_id", "seller_item_count_in_order", "payment_type", "installment_flag")
    assert o1 == {1: (1, "credit_card", False), 2: (1, "credit_card", False)}


def test_monthly_growth_uses_the_previous_active_month(run):
    got = by(run.tables["seller_performance_monthly_staging"].where("seller_id = 's1'"), "performance_month", "monthly_orders",
             "previous_month_orders", "seller_growth_category")
    assert got == {1: (1, None, "New Seller"), 3: (1, 1, "Stable")}


def test_dimensions_are_dense(run):
    for name, key in marts.PRIMARY_KEYS.items():
        if name == "dim_date":
            continue
        r = run.tables[name].agg(F.count("*"), F.min(key), F.max(key), F.count_distinct(key)).first()
        assert tuple(r) == (r[0], 1, r[0], r[0]), name
    days = run.tables["dim_date"]
    assert days.count() == days.agg(F.countDistinct("date_sk")).first()[0] and days.count() % 365 in (0, 1)
    assert days.agg(F.min("is_year_start"), F.max("is_year_end")).first() == (False, True)


def test_every_fact_has_a_day(run):
    known = {r.date_sk for r in run.tables["dim_date"].collect()}
    for name in [t for t in run.tables if t.startswith("fct_")]:
        fact = run.tables[name]
        for key in [c for c in fact.columns if c.endswith("date_sk")]:
            assert {r[0] for r in fact.select(key).distinct().collect() if r[0] is not None} <= known, (name, key)


def test_facts_keep_every_row(run):
    assert run.tables["fct_order_sales"].count() == run.tables["silver_order_items"].count() == 7
    assert run.tables["fct_order_delivery"].count() == 6
    facts = by(run.tables["fct_order_delivery"], "order_id", "purchase_date_sk", "actual_delivery_date_sk", "late_delivery_flag")
    assert facts["o2"] == (20180106, 20180125, True) and facts["o3"] == (20180301, None, None)


def test_marts(run, spark):
    assert {t.name for t in spark.catalog.listTables("sales_mart")} == {
        "dim_product", "dim_seller", "dim_customer", "dim_payment_type", "dim_date", "fct_order_sales",
    }
    heat = by(run.tables["mart_geo_heatmap"], "customer_state", "total_orders", "total_revenue", "on_time_orders")
    assert [str(x) for x in heat["SP"]] == ["3", "238.00", "2"]
    assert run.tables["mart_review_sentiment"].where("product_category_name = 'beleza_saude'").count() > 0


def test_quality_finds_only_the_planted_issues(run):
    found = {r.dq_rule: r.issue_count for r in run.summary.where("issue_count > 0").collect()}
    assert found == {
        "order_items_orphan_product_id": 1,
        "order_items_orphan_seller_id": 1,
        "closed_deals_orphan_mql_id": 1,
        "converted_marketing_seller_not_in_silver_sellers": 1,
        "seller_performance_monthly_null_business_keys": 1,  # the canceled order has no seller
    }


def test_issue_rows_are_written_for_violated_rules_only(run):
    import os

    written = {n.removeprefix("dq_") for n in os.listdir(f"{run.root}/quality") if n.startswith("dq_")} - {"summary"}
    assert written == {r.dq_rule for r in run.summary.where("issue_count > 0").collect()}
    absent = pipeline.Run(run.spark, run.root + "/absent", "x", run.run_at)
    absent.tables = {k: v for k, v in run.tables.items() if k not in ("dim_date", "silver_orders")}
    found = {r.dq_rule: r for r in pipeline.check_quality(absent, with_marts=True).collect()}
    assert found["expected_table_missing"].issue_count == 2
    assert found["expected_table_missing"].validation_error == "silver_orders, dim_date"
    assert found["orders_null_keys"].validation_error and found["orders_null_keys"].issue_count == 1
    assert found["expected_mart_table_missing"].issue_count == 0
    assert found["closed_deals_orphan_mql_id"].issue_count == 1


def test_orders_are_enriched_in_place(run):
    orders = run.lake("silver").read("silver_orders")
    assert orders.columns[-3:] == ["total_amount_paid", "financial_variance", "payment_status"]
    assert by(orders, "order_id", "payment_status")["o5"] == ("no payment record",)


def test_audit_log_is_idempotent(run, spark):
    audit = run.lake("audit")
    reasons = {r[0]: r[1] for r in read_log(audit, "silver_reviews", "run-1").groupBy("error_reason").count().collect()}
    assert reasons == {"Review critical key or score missing": 2, "Review order_id missing from silver_orders": 1}
    lake = Lake(spark, run.root + "/audit2")
    one = spark.createDataFrame([("a", "x")], "id string, error_reason string")
    two = spark.createDataFrame([("b", 1)], "id string, extra int")
    for _ in range(2):
        log_rejects(lake, one, "t", "r1", RUN_AT)
        log_rejects(lake, two, "t", "r2", RUN_AT)
    got = sorted(tuple(r) for r in read_log(lake, "t").select("id", "error_reason", "extra", "run_id").fillna("-").collect())
    assert got == [("a", "x", None, "r1"), ("b", "-", 1, "r2")]
    log_rejects(lake, one.limit(0), "t", "r1", RUN_AT)
    assert [r.id for r in read_log(lake, "t").collect()] == ["b"]


def test_enrichment_write_back(run):
    costed = staging.orders_with_costs(run.tables["silver_orders"], run.tables["silver_order_items"])
    again = staging.orders_with_costs(costed, run.tables["silver_order_items"])
    assert sorted(map(tuple, again.select("order_id", "total_order_cost").collect())) == sorted(
        map(tuple, costed.select("order_id", "total_order_cost").collect())
    )
    got = by(staging.orders_with_payments(costed, run.tables["silver_payments"]), "order_id", "payment_status")
    assert got == {
        "o1": ("matched",), "o2": ("overpaid",), "o3": ("underpaid",), "o4": ("matched",), "o5": ("no payment record",),
        "o6": ("matched",),
    }


def test_refined_lineage_by_policy(run):
    bronze = {t: run.lake("bronze").read(t) for t in pipeline.BRONZE_FILES}
    rekeyed = refined.build_refined(Lake(run.spark, f"{run.root}/refined"), bronze, "rekey")
    dropped = refined.build_refined(Lake(run.spark, f"{run.root}/refined_drop"), bronze, "drop")
    assert set(rekeyed) == set(dropped) and len(rekeyed) == 8
    for name, key in (("orders", "order_id"), ("customers", "customer_id"), ("sellers", "seller_id"), ("products", "product_id")):
        for tables in (rekeyed, dropped):
            assert tables[name].where(F.col(key) == "-1").count() == 1
    items, kept = rekeyed["order_items"], dropped["order_items"]
    assert items.where("order_id = '-1'").count() > 0 and kept.where("order_id = '-1'").count() == 0
    assert kept.count() < items.count()
    for name in ("order_items", "order_payments", "order_reviews"):
        known = rekeyed["orders"].select("order_id")
        assert rekeyed[name].join(known, "order_id", "left_anti").count() == 0
    with pytest.raises(ValueError):
        refined.settled(items, kept, "order_id", "guess")
