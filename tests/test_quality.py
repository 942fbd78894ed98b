"""Scorecards and gates: golden values from the source pipelines' tests."""

import pytest
from pyspark.sql import functions as F

from martforge.operators import gates, quality

SALES = "order_id string, product_id string, quantity bigint, unit_price double"


def score(df, suite2=True):
    r = (quality.ratio_summary(df) if suite2 else quality.summary(df)).first()
    return round(r["quality_score"], 2), r["passed_checks"], r["total_checks"]


def test_suite2_dirty_three_rows(spark):
    df = spark.createDataFrame(
        [("ORD001", "PROD1", 1, 10.0), (None, "PROD2", -1, 0.0), ("ORD003", None, 3, 30.0)], SALES)
    assert score(quality.dq_sales(df)) == (33.33, 2, 6)
    # the source's exact order of operations: (passed / total) * 100
    assert quality.ratio_summary(quality.dq_sales(df)).first()["quality_score"] == (2 / 6) * 100


def test_suite2_all_null_order_refused(spark):
    df = spark.createDataFrame([(None, "P1", -1, 0.0), (None, "P2", -2, 0.0), (None, "P3", -3, 0.0)], SALES)
    card = quality.dq_sales(df)
    assert score(card) == (50.0, 3, 6)
    with pytest.raises(gates.QualityGateError):
        gates.enforce(gates.gate(quality.ratio_summary(card), "pre", gates.PRE_TRANSFORM_GATE))


def test_suite2_clean(spark):
    df = spark.createDataFrame([("ORD001", "P1", 1, 10.0), ("ORD002", "P2", 2, 20.0)], SALES)
    assert score(quality.dq_sales(df)) == (100.0, 6, 6)
    gates.enforce(gates.gate(quality.ratio_summary(quality.dq_sales(df)), "pre", 80))


def test_suite2_empty_frame_passes_80_but_require_rows_refuses(spark):
    df = spark.createDataFrame([], SALES)
    assert score(quality.dq_sales(df)) == (83.33, 5, 6)
    gates.enforce(gates.gate(quality.ratio_summary(quality.dq_sales(df)), "pre", 80))
    with pytest.raises(gates.QualityGateError):
        gates.require_rows(df)


def test_suite2_only_present_columns(spark):
    df = spark.createDataFrame([("a",), ("b",)], "order_id string")
    card = quality.dq_sales(df).orderBy("check_order").collect()
    assert [r["check_name"] for r in card] == ["row_count_check", "order_id_not_null", "order_id_unique"]


def test_suite2_null_quantity_fails_range(spark):
    df = spark.createDataFrame([("a", "p", None, 1.0)], SALES)
    card = {r["check_name"]: r["passed"] for r in quality.dq_sales(df).collect()}
    assert card["quantity_range_check"] is False


PRODUCTS = "product_id string, product_name string, category string, unit_cost double"
SALES1 = "order_id string, quantity bigint, total_amount double"


def test_suite1_all_good(spark):
    p = spark.createDataFrame([("P1", "A", "c", 1.0), ("P2", "B", "c", 2.0), ("P3", "C", "c", 3.0)], PRODUCTS)
    s = spark.createDataFrame([("O1", 1, 10.0), ("O2", 2, 20.0), ("O3", 3, 30.0)], SALES1)
    assert score(quality.dq_dimensional(p, s), suite2=False) == (100.0, 5, 5)


def test_suite1_failing(spark):
    p = spark.createDataFrame([("P1", "A", "c", 1.0), ("P1", None, "c", 2.0)], PRODUCTS)
    s = spark.createDataFrame([("O1", -2, 10.0), ("O2", 1, -45.0)], SALES1)
    assert score(quality.dq_dimensional(p, s), suite2=False) == (20.0, 1, 5)
    with pytest.raises(gates.QualityGateError):
        gates.enforce(gates.gate(quality.summary(quality.dq_dimensional(p, s)), "dim", 85))


def test_suite1_missing_column_scores_zero(spark):
    p = spark.createDataFrame([("P1", 1.0)], "product_id string, unit_cost double")
    s = spark.createDataFrame([("O1", 1, 10.0)], SALES1)
    assert score(quality.dq_dimensional(p, s), suite2=False) == (0.0, 0, 0)
    assert "product_name" in quality.suite_error(p, s)


@pytest.mark.parametrize("dim,fact,q,ok", [(100, 10000, 95.0, True), (0, 10000, 95.0, False),
                                           (100, 10000, 70.0, False)])
def test_validate_warehouse(spark, dim, fact, q, ok):
    summary = spark.createDataFrame([(dim, fact, q)], "dim_product_rows bigint, fct_sales_rows bigint, quality_score double")
    rows = gates.validate_warehouse(summary).collect()
    assert all(r["passed"] for r in rows) is ok


def test_validate_layers_missing_layer(spark):
    counts = spark.createDataFrame([("raw", 10), ("staging", 9), ("core", 9)], "layer string, rows bigint")
    rows = {r["layer"]: r["passed"] for r in gates.validate_layers(counts).collect()}
    assert rows == {"raw": True, "staging": True, "core": True, "mart": False}


def test_thresholds(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 12:00:00"), (None, "2024-01-02 00:00:00"),
                                (2, "2024-01-02 00:00:00")], "k bigint, ts string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    r = {x["metric"]: x for x in quality.dq_thresholds(
        df, "k", "ts", F.lit("2024-01-03 06:00:00").cast("timestamp_ntz")).collect()}
    assert r["null_rate"]["value"] == 0.25 and not r["null_rate"]["passed"]
    assert r["duplicate_rate"]["value"] == 0.25
    assert r["freshness_hours"]["value"] == 30.0 and not r["freshness_hours"]["passed"]


def test_contract_violations(spark):
    df = spark.createDataFrame([("k1", 1, 1.0), ("k1", 0, -1.0), (None, None, 2.0)], "sales_key string, quantity bigint, unit_price double")
    out = {r["rule"]: r["violations"] for r in quality.contract_violations(
        df, ["sales_key", "quantity"], "sales_key",
        {"quantity_positive": F.col("quantity") > 0, "unit_price_non_negative": F.col("unit_price") >= 0}).collect()}
    assert out == {"not_null:sales_key": 1, "not_null:quantity": 1, "primary_key:sales_key": 1,
                   "check:quantity_positive": 1, "check:unit_price_non_negative": 1}


def test_profile(spark):
    df = spark.createDataFrame([("b", 2), ("a", None), ("a", 3)], "id string, q bigint")
    out = {r["column_name"]: r for r in quality.profile(df, ["id", "q"]).collect()}
    assert (out["id"]["min_value"], out["id"]["distinct_count"], out["id"]["non_null_count"]) == ("a", 2, 3)
    assert (out["q"]["min_value"], out["q"]["distinct_count"], out["q"]["non_null_count"], out["q"]["row_count"]) == ("2", 2, 2, 3)
