"""Layered load raw -> staging -> core -> mart (S11) as real tables.

Each layer is written, and the next layer reads the written table: lineage
is cut at every layer (a lost executor re-runs only the current layer's
tasks), and each layer is one parquet table under ``base``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import filters, marts
from ..operators.conform import with_audit
from ..session import DROP_SHUFFLES, TABLE_PARTITION_BYTES, drop_path, scratch_path, settings
from ..sources.tables import Tables
from ..sources.writers import replace_table
from . import model

LAYER_TABLES = (
    ("raw", "sales_data"),
    ("staging", "sales_clean"),
    ("core", "fact_sales"),
    ("mart", "sales_summary"),
)


def layer_path(base: str, layer: str, table: str) -> str:
    return f"{base}/{layer}/{table}"


#: Bytes of a table that one task reads: the columns of the joined lines swell about sixfold as rows of a shuffle.
SCAN_BYTES = 32 * 1024 * 1024
#: A partition of packed rows holds twice the rows in the same bytes.
PACKED_PARTITION_BYTES = TABLE_PARTITION_BYTES // 2


def load_layers(spark: SparkSession, t: Tables, raw: Callable[[DataFrame], DataFrame], base: str,
                batch_ts: Column) -> DataFrame:
    """Write the four layers; returns (layer_order, layer, table_name, rows) read back.

    ``raw`` makes the raw feed from the lines joined to their orders. These are joined once, into a table that is
    removed when raw and core are written, and the shuffle files of a table's write are removed with its end: the disk
    holds the layers and one shuffle at a time.
    """
    p = {layer: layer_path(base, layer, table) for layer, table in LAYER_TABLES}
    with settings(spark, DROP_SHUFFLES | {
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PACKED_PARTITION_BYTES)}):
        lines = scratch_path(spark, "sold-lines")
        try:
            with settings(spark, {"spark.sql.files.maxPartitionBytes": str(SCAN_BYTES)}):
                replace_table(model.sold_lines(t), lines)
                sold = spark.read.parquet(lines)
                replace_table(raw(sold), p["raw"])
                staged = filters.clean_sales(with_audit(spark.read.parquet(p["raw"]), batch_ts))
                replace_table(staged, p["staging"])
                products = model.dim_product(t)
                channels = model.dim_channel(t)
                replace_table(products, layer_path(base, "core", "dim_product"))
                replace_table(channels, layer_path(base, "core", "dim_channel"))
                # The core fact has no partition clause in its DDL (only the curated fact
                # is day-partitioned): one plain table, no folder per day.
                # It keeps the names that came with the cost lookup: the mart shuffles no line for them again.
                replace_table(model.fact_sales(t, products, ["product_name", "category"], sold), p["core"])
        finally:
            drop_path(spark, lines)
        core_fact = spark.read.parquet(p["core"])
        summary = marts.sales_summary(core_fact, spark.read.parquet(layer_path(base, "core", "dim_channel")),
                                      words=model.SUMMARY_WORDS)
        replace_table(summary, p["mart"])
    return layer_counts(spark, base)


def layer_counts(spark: SparkSession, base: str) -> DataFrame:
    parts = []
    for i, (layer, table) in enumerate(LAYER_TABLES):
        c = spark.read.parquet(layer_path(base, layer, table)).agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
        parts.append(c.select(F.lit(i).alias("layer_order"), F.lit(layer).alias("layer"),
                              F.lit(table).alias("table_name"), "rows"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out
