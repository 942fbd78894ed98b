"""Quality gates and warehouse/layer validation.

A gate is two parts: a lazy DataFrame ``(gate, score, threshold, passed)``
built from a scorecard summary, and a driver-side ``enforce`` that reads
those few rows (one per gate, never the data) and refuses the batch before
anything is published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists

# Fixed thresholds of the source pipelines.
DIMENSIONAL_GATE = 85.0
PRE_TRANSFORM_GATE = 80.0
POST_TRANSFORM_GATE = 90.0
WAREHOUSE_SCORE_MIN = 85.0
LAYERS = ("raw", "staging", "core", "mart")


class QualityGateError(RuntimeError):
    """A batch scored below its gate, or a validation failed."""


def gate(summary: DataFrame, name: str, threshold: float) -> DataFrame:
    """One row: (gate, score, threshold, passed) from a one-row scorecard summary."""
    return summary.select(
        F.lit(name).alias("gate"),
        F.col("quality_score").cast("double").alias("score"),
        F.lit(float(threshold)).alias("threshold"),
        (F.col("quality_score") >= F.lit(float(threshold))).alias("passed"),
    )


def enforce(decisions: DataFrame) -> list:
    """Raise QualityGateError when any gate row did not pass; returns the rows."""
    rows = decisions.collect()  # one row per gate
    failed = [r for r in rows if not r["passed"]]
    if failed:
        detail = ", ".join(f"{r['gate']}={r['score']:.2f}<{r['threshold']}" for r in failed)
        raise QualityGateError(f"data quality below threshold: {detail}")
    return rows


def enforce_checks(checks: DataFrame, what: str = "validation") -> list:
    """Raise QualityGateError when any (check, ..., passed) row failed."""
    rows = checks.collect()  # a handful of check rows
    failed = [r for r in rows if not r["passed"]]
    if failed:
        names = ", ".join(str(r[0]) for r in failed)
        raise QualityGateError(f"{what} failed: {names}")
    return rows


def enforce_contract(violations: DataFrame, table: str) -> None:
    """Raise QualityGateError when a rule of a table's contract is broken (``quality.contract_violations``)."""
    broken = violations.filter("violations > 0").collect()  # one row per rule at most
    if broken:
        raise QualityGateError(f"{table} contract: " + ", ".join(f"{r.rule}={r.violations}" for r in broken))


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Empty input is an error (checked before scoring: an empty batch would
    otherwise pass the pre-transform gate with 5 of 6 checks)."""
    if df.isEmpty():
        raise QualityGateError(f"no data in {what}")
    return df


def require_path(spark: SparkSession, path: str) -> str:
    """A missing input is an error (asked of the path's own file system)."""
    if not path_exists(spark, path):
        raise QualityGateError(f"file not found: {path}")
    return path


def load_summary(dim_rows: DataFrame, fact_rows: DataFrame, scorecard: DataFrame,
                 load_ts) -> DataFrame:
    """One row: dim_product_rows, fct_sales_rows, quality_score, load_timestamp.

    Built from three one-row aggregates combined by a union + pivot, so no
    join and nothing through the driver.
    """
    parts = (
        dim_rows.agg(F.count(F.lit(1)).cast("double").alias("v")).select(F.lit("dim").alias("k"), "v")
        .unionByName(fact_rows.agg(F.count(F.lit(1)).cast("double").alias("v")).select(F.lit("fact").alias("k"), "v"))
        .unionByName(scorecard.agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("v")).select(F.lit("score").alias("k"), "v"))
    )
    return parts.agg(
        F.max(F.when(F.col("k") == "dim", F.col("v"))).cast("bigint").alias("dim_product_rows"),
        F.max(F.when(F.col("k") == "fact", F.col("v"))).cast("bigint").alias("fct_sales_rows"),
        F.max(F.when(F.col("k") == "score", F.col("v"))).alias("quality_score"),
    ).withColumn("load_timestamp", load_ts)


def validate_warehouse(summary: DataFrame, score_min: float = WAREHOUSE_SCORE_MIN) -> DataFrame:
    """(check, observed, passed): dim rows > 0, fact rows > 0, score >= minimum."""
    arr = F.array(
        F.struct(F.lit("dim_product_rows").alias("check"), F.col("dim_product_rows").cast("double").alias("observed"),
                 (F.coalesce(F.col("dim_product_rows"), F.lit(0)) > 0).alias("passed")),
        F.struct(F.lit("fct_sales_rows").alias("check"), F.col("fct_sales_rows").cast("double").alias("observed"),
                 (F.coalesce(F.col("fct_sales_rows"), F.lit(0)) > 0).alias("passed")),
        F.struct(F.lit("quality_score").alias("check"), F.col("quality_score").cast("double").alias("observed"),
                 (F.coalesce(F.col("quality_score"), F.lit(0.0)) >= F.lit(float(score_min))).alias("passed")),
    )
    return summary.select(F.inline(arr))


def validate_layers(layer_counts: DataFrame, layers=LAYERS) -> DataFrame:
    """(layer, rows, passed) for every expected layer; a missing or empty layer fails."""
    spark = layer_counts.sparkSession
    expected = spark.createDataFrame([(i, name) for i, name in enumerate(layers)], "layer_order int, layer string")
    j = expected.join(layer_counts.select("layer", "rows"), "layer", "left")
    return j.select("layer_order", "layer", "rows",
                    (F.coalesce(F.col("rows"), F.lit(0)) > 0).alias("passed"))
