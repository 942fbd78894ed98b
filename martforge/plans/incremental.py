"""Incremental layered load: one batch goes raw -> staging -> core -> mart and touches only the periods it holds.

Tables under ``base``:

* ``raw/sales_data``     (by batch_id) - the batch as it came;
* ``rejects/sales_data`` (by batch_id) - rows that break a staging rule, with one bit per broken rule;
* ``staging/sales_clean``, ``core/fct_sales``, ``mart/sales_summary`` (by period, the day or month of the order).

Of the records of one order line in one period the newest batch's counts (of
several in one batch the one with the larger quantity, then amount), so a batch
may be loaded again and batches may come in any order. Staging of the batch's
periods is merged from their old rows and the batch; core is computed from that
staging, and the mart from that core. Other periods are neither read
nor written. (The order date of a line is taken as fixed: a line that comes in
two of a batch's periods breaks the key contract, and the batch is refused.)

Write, audit, publish: the periods of all three layers are written beside the
tables first and their contracts checked there; only then each layer's partition
folders are moved into its table. A refused batch leaves the tables as they were and its rejects
readable; the next batch is loaded as usual. A load that breaks off between two
layers is completed by loading the batch again.

The driver sees the periods of a batch (bounded by the calendar), one score and
the violation counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import batch_id_text, ts_literal
from ..operators import conform, filters, gates, marts, quality
from ..operators.ordering import dedup_latest
from ..session import path_exists
from ..sources import writers
from . import curated

PERIOD = "period"
RAW, REJECTS = "raw/sales_data", "rejects/sales_data"
STAGING, CORE, MART = "staging/sales_clean", "core/fct_sales", "mart/sales_summary"

#: Contract of the mart rows.
MART_NOT_NULL = ("channel", "product_id", "sales_date", "total_quantity", "total_revenue", "order_count")


def rules() -> tuple[tuple[str, Column], ...]:
    """Staging rules; a row's mask has bit i set when rule i does not hold (null comparisons do not)."""
    return (*filters.clean_rules(), ("order_date_null", F.col("order_date").isNotNull()),
            ("customer_id_null", F.col("customer_id").isNotNull()), ("channel_null", F.col("channel").isNotNull()),
            ("total_amount_negative", F.col("total_amount") >= 0))


def rule_mask() -> Column:
    mask = F.lit(0)
    for i, (_, holds) in enumerate(rules()):
        mask = mask + F.when(F.coalesce(holds, F.lit(False)), F.lit(0)).otherwise(F.lit(1 << i))
    return mask


def reject_counts(spark: SparkSession, base: str) -> DataFrame:
    """(batch_id, rule, rejected): how many rows of each batch broke each rule (a row may break several)."""
    bits = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << i).alias("bit")) for i, (name, _) in enumerate(rules())])
    rejected = spark.read.parquet(f"{base}/{REJECTS}").groupBy("batch_id", "rule_mask").count()
    return (rejected.select("batch_id", "rule_mask", "count", F.inline(bits))
            .filter(F.col("rule_mask").bitwiseAND(F.col("bit")) != 0)
            .groupBy("batch_id", "rule").agg(F.sum("count").cast("bigint").alias("rejected")))


def _periods_of(spark: SparkSession, path: str, periods: list) -> DataFrame | None:
    """The rows of ``periods``; other partitions are pruned."""
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).filter(F.col(PERIOD).isin(periods))


def load_batch(spark: SparkSession, base: str, rows: DataFrame, batch_ts: str, grain: str = "day",
               line_key=curated.LINE_KEY, least_clean: float = gates.PRE_TRANSFORM_GATE) -> DataFrame:
    """Load one landed batch through all layers; returns (layer_order, layer, rows) of the batch's periods."""
    bid = batch_id_text(batch_ts)
    writers.append_batch(rows.withColumn("batch_id", F.lit(bid)), f"{base}/{RAW}")
    raw = spark.read.parquet(f"{base}/{RAW}").filter(F.col("batch_id") == bid)
    return process_batch(spark, base, raw, batch_ts, grain, line_key, least_clean)


def process_batch(spark: SparkSession, base: str, raw: DataFrame, batch_ts: str, grain: str = "day",
                  line_key=curated.LINE_KEY, least_clean: float = gates.PRE_TRANSFORM_GATE) -> DataFrame:
    """``load_batch`` for rows that are in the raw layer already."""
    raw = conform.conform_types(conform.standardize_columns(raw.drop("batch_id")), safe=True)
    marked = conform.with_audit(gates.require_rows(raw, "raw batch"), ts_literal(batch_ts)).withColumns({
        "rule_mask": rule_mask(), PERIOD: F.to_date(F.date_trunc(grain, F.col("order_date")))})
    writers.append_batch(marked.filter("rule_mask <> 0").drop(PERIOD), f"{base}/{REJECTS}")
    # one pass: rows and clean rows by period
    tally = marked.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("rule_mask") == 0).alias("clean")).collect()
    n_raw = sum(r.rows for r in tally)
    share = spark.createDataFrame([(100.0 * sum(r.clean for r in tally) / n_raw,)], "quality_score double")
    gates.enforce(gates.gate(share, "clean_rows", least_clean))
    clean = marked.filter("rule_mask = 0").drop("rule_mask")
    periods = sorted(r[PERIOD] for r in tally if r.clean)

    audit = f"{base}/_audit-{uuid.uuid4().hex[:12]}"
    old = _periods_of(spark, f"{base}/{STAGING}", periods)
    merged = clean if old is None else old.select(*clean.columns).unionByName(clean)
    latest = dedup_latest(merged, [PERIOD, *line_key], ["batch_id", "quantity", "total_amount"], clustered=True)
    staged = _write(latest, f"{audit}/staging")
    # the load audit of a line is that of its own record; keys and audit are computed behind the shuffle
    clustered = _cluster(staged, "channel", "product_id", "customer_id")
    core = _write(curated.fct_sales(clustered, F.col("processed_at"), key_cols=line_key, keep=[PERIOD]), f"{audit}/core")
    # one shuffle serves the distinct count and the layout: all rows of a group are in one range
    days = _cluster(core.withColumn("sales_date", F.to_date("order_date")), "channel", "product_id", "sales_date")
    mart = _write(marts.daily_channel_product(days, ts="sales_date", keep=[PERIOD])
                  .sortWithinPartitions(PERIOD, "channel", "product_id"), f"{audit}/mart")

    gates.enforce_contract(quality.contract_violations(core, list(curated.FCT_NOT_NULL), "sales_key", curated.fct_checks(),
                                                       curated.fct_key()), "core")
    gates.enforce_contract(quality.contract_violations(mart, list(MART_NOT_NULL), None,
                                                       {"order_count_positive": F.col("order_count") > 0}), "mart")
    counts = spark.createDataFrame([(layer, n) for layer, n in zip(gates.LAYERS, (
        n_raw, staged.count(), core.count(), mart.count()))], "layer string, rows bigint")
    counted = gates.enforce_checks(gates.validate_layers(counts), "layer validation")

    for layer, path in (("staging", STAGING), ("core", CORE), ("mart", MART)):
        writers.publish_partitions(spark, f"{audit}/{layer}", f"{base}/{path}")
    return spark.createDataFrame([(r.layer_order, r.layer, r.rows) for r in counted],
                                 "layer_order int, layer string, rows bigint")


def _cluster(df: DataFrame, *by: str) -> DataFrame:
    keys = [PERIOD, *by]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.partitionBy(PERIOD).parquet(path, compression=writers.LAYER_CODEC)
    return df.sparkSession.read.parquet(path)


def touched(run: Callable[[], object], spark: SparkSession, path: str) -> set[str]:
    """The files that ``run`` added to or removed from the table at ``path`` (for tests and audits)."""
    def files() -> set[str]:
        if not path_exists(spark, path):
            return set()
        return {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    before = files()
    run()
    return before ^ files()
