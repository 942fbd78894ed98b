"""Column conforming, generators, scalar functions."""

import pytest
from pyspark.sql import functions as F

from martforge.functions import columns as C
from martforge.operators import conform, filters
from martforge.sources import generators


def test_standardize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`Order ID` long, `QTY` long")
    assert conform.standardize_columns(df).columns == ["order_id", "qty"]
    with pytest.raises(conform.SchemaError):
        conform.standardize_columns(spark.createDataFrame([(1, 2)], "`A b` long, `a_b` long"))


def test_conform_types_strict_and_safe(spark):
    df = spark.createDataFrame([("1", 2.7, "3.5")], "order_id string, quantity double, unit_price string")
    r = conform.conform_types(df).first()
    assert r["quantity"] == 2 and r["unit_price"] == 3.5
    bad = spark.createDataFrame([("1", "x", "3.5")], "order_id string, quantity string, unit_price string")
    with pytest.raises(Exception):
        conform.conform_types(bad).collect()
    assert conform.conform_types(bad, safe=True).first()["quantity"] is None
    null_q = spark.createDataFrame([("1", None)], "order_id string, quantity string")
    with pytest.raises(Exception):
        conform.conform_types(null_q).collect()


def test_audit_and_batch_id(spark):
    df = conform.with_audit(spark.range(1), C.ts_literal("2024-02-01 13:04:05")).first()
    assert df["batch_id"] == "batch_20240201_130405"


def test_format_id_widens(spark):
    r = spark.createDataFrame([(42,), (123456,), (-5,)], "k long").select(C.format_id("PROD", 5, "k").alias("x")).collect()
    assert [x["x"] for x in r] == ["PROD_00042", "PROD_123456", "PROD_-0005"]


def test_sanitize_and_stem(spark):
    r = spark.createDataFrame([("extract_sales../é-1 x", "/a/b/sales_data.csv")], "j string, p string").select(
        C.sanitize_id("j").alias("j"), C.file_stem("p").alias("s")).first()
    assert r["j"] == "extract_salesé-1x" and r["s"] == "sales_data"


def test_pct_zero_guard(spark):
    r = spark.createDataFrame([(5000, 10000), (1, 0)], "p long, t long").select(C.pct("p", "t").alias("x")).collect()
    assert [x["x"] for x in r] == [50.0, 0.0]


def test_quarantine_partitions_input(spark):
    df = spark.createDataFrame([("o", "p", 1, 1.0), (None, "p", 1, 1.0), ("o", None, 0, 1.0), ("o", "p", None, 1.0),
                                ("o", "p", 1, 0.0)], "order_id string, product_id string, quantity bigint, unit_price double")
    clean, rejected = filters.split_quarantine(df)
    assert clean.count() == 1
    reasons = sorted(r["reject_reason"] for r in rejected.collect())
    assert reasons == ["order_id_null", "product_id_null", "quantity_not_positive", "unit_price_not_positive"]


def test_generators_deterministic(spark):
    a = generators.gen_sales(spark, 10000)
    assert a.count() == 10000
    assert a.select("order_id").distinct().count() == 10000
    assert a.exceptAll(generators.gen_sales(spark, 10000)).count() == 0
    r = a.agg(F.min("quantity"), F.max("quantity"), F.min("unit_price"), F.max("unit_price")).first()
    assert 1 <= r[0] and r[1] <= 9 and float(r[2]) >= 15 and float(r[3]) <= 150
    p = generators.gen_products(spark)
    assert p.count() == 100 and p.agg(F.min("product_id")).first()[0] == "PROD_00001"
