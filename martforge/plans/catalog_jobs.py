"""Registered queries: the daily CSV-to-warehouse job and the incremental layered load end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import batch_id_text, ts_literal
from ..schemas import RAW_PRODUCTS_CSV, SALES_LINES_CSV
from ..session import scratch_path
from ..sources import csv as csv_src
from ..sources import writers
from ..sources.tables import Tables
from . import curated, daily_jobs, fixtures, incremental, model
from .catalog_quality import LOAD_SUMMARY_SQL_CTE, PRODUCT_SOURCE
from .registry import BATCH_TS, register, with_ctes
from .sqlparts import DIRTY_SALES, RAW_SALES

SUMMARY_SCHEMA = "dim_product_rows bigint, fct_sales_rows bigint, quality_score double, load_timestamp timestamp_ntz"


@register("daily_csv_to_dw", with_ctes(RAW_SALES, PRODUCT_SOURCE, LOAD_SUMMARY_SQL_CTE) + """
SELECT CAST(dim_product_rows AS BIGINT) AS dim_product_rows, CAST(fct_sales_rows AS BIGINT) AS fct_sales_rows,
       CAST(quality_score AS DOUBLE) AS quality_score, load_timestamp FROM ls""")
def daily_csv_to_dw(spark, sf_dir):
    """The products and sales extracts land as CSV; the daily job scans them
    with declared schemas, scores them (suite 1), gates at 85, applies the
    type-2 product dimension, appends the sales fact by batch, and validates
    the warehouse. Result: its load summary."""
    t = Tables(spark, sf_dir)
    base = scratch_path(spark, "daily-dw")
    products = fixtures.product_source(t).withColumns({
        "created_date": ts_literal(fixtures.DIM_V1_TS), "is_active": F.lit(True)})
    sales = model.raw_sales(t).withColumns({
        "unit_price": F.col("unit_price").cast("double"), "total_amount": F.col("total_amount").cast("double")})
    p = csv_src.write_csv(products.select(*RAW_PRODUCTS_CSV.fieldNames()), f"{base}/extract/products")
    s = csv_src.write_csv(sales.select(*SALES_LINES_CSV.fieldNames()), f"{base}/extract/sales")
    out = daily_jobs.run_csv_to_dw(spark, p, s, f"{base}/warehouse", BATCH_TS, SALES_LINES_CSV, curated.LINE_KEY)
    return spark.createDataFrame([tuple(out[c] for c in ("dim_product_rows", "fct_sales_rows", "quality_score",
                                                         "load_timestamp"))], SUMMARY_SCHEMA)


# Three batches of the layered load: orders to the end of 1996; a correction
# (one piece more) of mid 1996 to the end of 1997; orders from October 1997 on.
LAYERED_BATCHES = (
    ("2024-02-01 00:00:00", "1900-01-01", "1997-01-01", 0),
    ("2024-02-02 00:00:00", "1996-07-01", "1998-01-01", 1),
    ("2024-02-03 00:00:00", "1997-10-01", "2100-01-01", 0),
)
DELIVERED = f"""delivered AS ({' UNION ALL '.join(
    f"SELECT * REPLACE (quantity + {more} AS quantity), '{batch_id_text(ts)}' AS batch_id FROM dirty_sales "
    f"WHERE order_date >= TIMESTAMP '{low} 00:00:00' AND order_date < TIMESTAMP '{high} 00:00:00'"
    for ts, low, high, more in LAYERED_BATCHES)})"""


def _load_layers(spark, sf_dir):
    # a written table: the batches are cut from it, so the source's joins run once
    dirty = writers.as_table(fixtures.dirty_sales(Tables(spark, sf_dir)), "layered-source")
    base = scratch_path(spark, "layered")
    for ts, low, high, more in LAYERED_BATCHES:
        rows = dirty.filter((F.col("order_date") >= ts_literal(f"{low} 00:00:00"))
                            & (F.col("order_date") < ts_literal(f"{high} 00:00:00")))
        incremental.load_batch(spark, base, rows.withColumn("quantity", F.col("quantity") + more), ts, grain="quarter")
    return base


@register("layered_daily", with_ctes(RAW_SALES, DIRTY_SALES, DELIVERED) + """
, newest AS (
  SELECT order_id, line_no, product_id, arg_max(d, {'b': batch_id, 'q': quantity, 't': total_amount}) AS r
  FROM delivered d
  WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND quantity > 0 AND unit_price > 0 AND total_amount >= 0
    AND customer_id IS NOT NULL AND channel IS NOT NULL
  GROUP BY ALL)
SELECT r.channel AS channel, product_id, CAST(r.order_date AS DATE) AS sales_date,
       CAST(sum(r.quantity) AS BIGINT) AS total_quantity,
       CAST(sum(CAST(r.total_amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue,
       CAST(count(DISTINCT order_id) AS BIGINT) AS order_count
FROM newest GROUP BY ALL""")
def layered_daily(spark, sf_dir):
    """The mart after three batches, each touching only its own quarters; the second one corrects quarters of the first."""
    return spark.read.parquet(f"{_load_layers(spark, sf_dir)}/{incremental.MART}").drop(incremental.PERIOD)


@register("layered_rejects", with_ctes(RAW_SALES, DIRTY_SALES, DELIVERED) + """
, broken AS (
  SELECT batch_id, unnest([CASE WHEN order_id IS NULL THEN 'order_id_null' END,
                           CASE WHEN product_id IS NULL THEN 'product_id_null' END,
                           CASE WHEN (quantity > 0) IS NOT TRUE THEN 'quantity_not_positive' END,
                           CASE WHEN (unit_price > 0) IS NOT TRUE THEN 'unit_price_not_positive' END]) AS rule
  FROM delivered)
SELECT batch_id, rule, CAST(count(*) AS BIGINT) AS rejected FROM broken WHERE rule IS NOT NULL GROUP BY ALL""")
def layered_rejects(spark, sf_dir):
    """How many rows of each of the three batches broke each rule."""
    return incremental.reject_counts(spark, _load_layers(spark, sf_dir))
