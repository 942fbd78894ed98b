"""The two daily pipelines end to end on generated extracts."""

import pytest
from pyspark.sql import functions as F

from martforge.operators import gates
from martforge.plans import daily_jobs, dim_store
from martforge.sources import csv as csv_src
from martforge.sources import generators


def _extracts(spark, base, n=2000):
    sales = generators.gen_sales(spark, n).withColumn("unit_price", F.col("unit_price").cast("double")) \
        .withColumn("total_amount", F.col("total_amount").cast("double"))
    csv_src.write_csv(sales.coalesce(2), f"{base}/sales")
    csv_src.write_csv(generators.gen_products(spark).coalesce(1), f"{base}/products")
    return f"{base}/products", f"{base}/sales"


def test_csv_to_dw_and_rerun(spark, scratch):
    base = scratch("dw")
    p, s = _extracts(spark, base)
    wh = f"{base}/wh"
    out = daily_jobs.run_csv_to_dw(spark, p, s, wh, "2024-03-01 02:00:00")
    assert out["dim_product_rows"] == 100 and out["fct_sales_rows"] == 2000 and out["quality_score"] == 100.0
    again = daily_jobs.run_csv_to_dw(spark, p, s, wh, "2024-03-01 02:00:00")
    assert again["fct_sales_rows"] == 2000
    assert spark.read.parquet(f"{wh}/fct_sales").count() == 2000
    # next day: unchanged products keep their version, no duplicate current rows
    daily_jobs.run_csv_to_dw(spark, p, s, wh, "2024-03-02 02:00:00")
    dim = dim_store.read_dimension(spark, f"{wh}/dim_product")
    assert dim.count() == 100 and dim.filter("is_current").count() == 100
    assert spark.read.parquet(f"{wh}/fct_sales").count() == 4000


def test_csv_to_dw_refuses_bad_batch(spark, scratch, tmp_path):
    base = scratch("dw-bad")
    p, _ = _extracts(spark, base, 10)
    bad = tmp_path / "sales.csv"
    bad.write_text("order_id,product_id,customer_id,channel,quantity,unit_price,order_date,region,total_amount\n"
                   ",P,C,Retail,-1,1.0,2024-01-01 00:00:00,North,-1.0\n")
    with pytest.raises(gates.QualityGateError):
        daily_jobs.run_csv_to_dw(spark, p, str(bad), f"{base}/wh", "2024-03-01 02:00:00")


def test_layered_pipeline(spark, scratch):
    base = scratch("layers")
    _, s = _extracts(spark, base, 3000)
    rows = daily_jobs.run_layered(spark, s, f"{base}/wh", "2024-03-01 02:00:00")
    got = {r["layer"]: r["rows"] for r in rows}
    assert got["raw"] == 3000 and got["staging"] == 3000 and got["core"] == 3000 and got["mart"] > 0
