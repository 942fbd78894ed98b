"""Curated-layer table builders (fct_sales with audit columns and defaults)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import OPEN_END, surrogate_key, ts_literal
from ..operators.conform import with_defaults, with_load_audit

# Fixed column defaults of the curated fact table.
SOURCE_SYSTEM_DEFAULT = "CSV_IMPORT"
VALIDATION_STATUS_DEFAULT = "PASSED"

FCT_SALES_COLUMNS = (
    "sales_key", "order_id", "product_id", "customer_id", "quantity", "unit_price",
    "total_amount", "channel", "region", "order_date", "load_date", "batch_id",
    "source_system", "quality_score", "validation_status",
)

# Business key of a sales line, and of extracts without line numbers.
LINE_KEY = ("order_id", "line_no", "product_id")
ORDER_PRODUCT_KEY = ("order_id", "product_id")

FCT_NOT_NULL = ("sales_key", "order_id", "product_id", "customer_id", "quantity", "unit_price",
                "total_amount", "channel", "order_date", "batch_id")


def fct_key() -> Column:
    """The sales key (a digest in hex) as its bytes: half as long where keys are shuffled to be counted."""
    return F.unhex("sales_key")


def fct_checks() -> dict[str, Column]:
    return {
        "quantity_positive": F.col("quantity") > 0,
        "unit_price_non_negative": F.col("unit_price") >= 0,
        "total_amount_non_negative": F.col("total_amount") >= 0,
    }


DIM_NOT_NULL = ("product_key", "product_id", "product_name", "unit_cost", "effective_date", "end_date", "is_current",
                "record_hash", "batch_id")


def dim_checks() -> dict[str, Column]:
    """Contract of the type-2 product dimension, row by row."""
    return {
        "unit_cost_non_negative": F.col("unit_cost") >= 0,
        "starts_before_it_ends": F.col("effective_date") < F.col("end_date"),
        "current_is_open": F.col("is_current") == (F.col("end_date") == ts_literal(OPEN_END)),
    }


def fct_sales(raw: DataFrame, batch_ts: Column, quality_score: Column | None = None,
              key_cols=LINE_KEY, keep=()) -> DataFrame:
    """raw sales -> curated fact rows: key, load audit, defaults.

    ``key_cols`` must all be there; a missing ``region`` (nullable) is null.
    ``keep`` names further columns to carry along.
    """
    missing = [c for c in key_cols if c not in raw.columns]
    if missing:
        raise ValueError(f"sales rows lack key columns {missing}")
    if "region" not in raw.columns:
        raw = raw.withColumn("region", F.lit(None).cast("string"))
    df = with_load_audit(raw, batch_ts).withColumn("sales_key", surrogate_key(*key_cols))
    df = with_defaults(df, {
        "source_system": F.lit(SOURCE_SYSTEM_DEFAULT),
        "validation_status": F.lit(VALIDATION_STATUS_DEFAULT),
        "quality_score": (quality_score if quality_score is not None else F.lit(None)).cast("decimal(5,2)"),
    })
    return df.select(*FCT_SALES_COLUMNS, *keep)
