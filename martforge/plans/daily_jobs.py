"""End-to-end jobs: the two daily pipelines as Spark jobs.

``run_csv_to_dw``: CSV extracts -> scorecard (suite 1) -> gate 85 -> type-2
product dimension (new version) + sales fact (idempotent batch append) ->
load summary -> warehouse validation.

``run_layered``: landed sales files -> resumable ingest into raw -> empty
check -> conform (names, types, audit) -> rejects set aside -> gate 80 on the
share of clean rows -> staging, core and mart of the batch's days, audited
before they are published -> layer validation.

Gates act on one-row summaries; data never passes through the driver. Time
is a parameter (``batch_ts``), never read from the clock inside a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import batch_id_text, ts_literal
from ..operators import conform, gates, quality
from ..schemas import RAW_PRODUCTS_CSV, RAW_SALES_CSV
from ..sources import csv as csv_src
from ..sources import ingest, writers
from . import curated, dim_store, incremental


def run_csv_to_dw(spark: SparkSession, products_path: str, sales_path: str, warehouse: str,
                  batch_ts: str, sales_schema=RAW_SALES_CSV, line_key=curated.ORDER_PRODUCT_KEY) -> dict:
    bts = ts_literal(batch_ts)
    bid = batch_id_text(batch_ts)
    products = gates.require_rows(csv_src.scan_csv(spark, gates.require_path(spark, products_path), RAW_PRODUCTS_CSV), "products")
    sales = gates.require_rows(csv_src.scan_csv(spark, gates.require_path(spark, sales_path), sales_schema), "sales")
    products, sales = products.persist(), sales.persist()  # read by scorecard and by the load
    try:
        card = quality.dq_dimensional(products, sales)
        decision = gates.enforce(gates.gate(quality.summary(card), "dimensional_gate",
                                            gates.DIMENSIONAL_GATE))[0]
        dim_path = dim_store.apply_batch(spark, f"{warehouse}/dim_product", products, bts, bid)
        # audited before the fact is published; suite 1 has scored the sales themselves
        gates.enforce_contract(quality.contract_violations(
            spark.read.parquet(dim_path), list(curated.DIM_NOT_NULL), "product_key", curated.dim_checks()), "dim_product")
        fct = curated.fct_sales(sales, bts, F.lit(decision["score"]), line_key)
        gates.enforce_contract(quality.contract_violations(fct, list(curated.FCT_NOT_NULL), None, curated.fct_checks()),
                               "fct_sales")
        fct_path = writers.append_batch(fct, f"{warehouse}/fct_sales")
        loaded = spark.read.parquet(fct_path).filter(F.col("batch_id") == bid)
        dim_now = dim_store.read_current(spark, f"{warehouse}/dim_product")
        summary = gates.load_summary(dim_now, loaded, card, bts)
        gates.enforce_checks(gates.validate_warehouse(summary), "warehouse validation")
        return summary.first().asDict()
    finally:
        products.unpersist()
        sales.unpersist()


def transform(df: DataFrame, batch_ts: str) -> DataFrame:
    """Names, types, audit columns (the business transformation)."""
    return conform.with_audit(conform.conform_types(conform.standardize_columns(df)), ts_literal(batch_ts))


def run_layered(spark: SparkSession, landing: str, warehouse: str, batch_ts: str,
                schema=RAW_SALES_CSV, fmt: str = "csv", line_key=curated.ORDER_PRODUCT_KEY) -> list:
    """Files landed since the last run become one batch and go through all layers (``plans.incremental``).

    Only the batch is scored and only its days are rewritten, so a refused
    batch does not hold up later ones. Returns the (layer, rows) rows of the
    batch's days. A run that failed after its ingest is completed by the same call.
    """
    raw_path, bid = f"{warehouse}/{incremental.RAW}", batch_id_text(batch_ts)

    def land(batch: DataFrame, epoch_id: int) -> None:
        # the checkpoint's epoch parts the batch: a replayed epoch replaces its own rows
        writers.replace_partitions(batch.withColumns({"batch_id": F.lit(bid), "epoch_id": F.lit(epoch_id).cast("long")}),
                                   raw_path, "batch_id", "epoch_id")

    ingest.ingest_resumable(spark, landing, schema, raw_path, f"{warehouse}/_checkpoints/raw", fmt=fmt,
                            max_files_per_trigger=4, foreach_batch=land)
    raw = spark.read.parquet(raw_path).filter(F.col("batch_id") == bid).drop("epoch_id")
    return incremental.process_batch(spark, warehouse, raw, batch_ts, line_key=line_key).collect()
