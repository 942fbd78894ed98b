"""Per-micro-batch scorecard, gate and publish; per-micro-batch SCD-2 apply.

Each micro-batch (or each delivery in it) is scored with the sales suite in
one grouped aggregate, the gate decision is one more aggregate over that
scorecard, and:

* the batch's scorecard rows are written to ``<base>/scorecards`` in the
  partition ``epoch_id=<n>``;
* a passing batch (or delivery) is published to ``<base>/published`` in its
  own epoch partition; a refused one to ``<base>/quarantine``.

All three writes use dynamic partition overwrite keyed by the epoch, so a
replayed epoch (after a failure between write and commit) replaces its own
output instead of duplicating it.

``scd2_applier`` applies product extracts to the versioned type-2 dimension
(``plans.dim_store``). Each extract carries its snapshot time; a micro-batch
applies the snapshots it holds in time order, one dimension version per
snapshot, named by the snapshot's batch id. A replayed epoch finds its
versions committed and skips them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import batch_id_text, ts_literal
from ..operators import gates, quality
from ..session import path_exists
from ..sources import writers
from .landing import stream_id


def _write_epoch(df: DataFrame, path: str, epoch_id: int) -> None:
    (df.withColumn("epoch_id", F.lit(epoch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("epoch_id").parquet(path))


def scored_publisher(base: str, threshold: float = gates.PRE_TRANSFORM_GATE, delivery_col: str | None = None):
    """Without ``delivery_col`` the whole micro-batch is one scored unit.
    With it, every delivery in the micro-batch is scored and gated on its own,
    so one trigger can carry many deliveries; the scorecards then carry the
    delivery, whatever epoch processed it.

    All of it is distributed: the scorecard is one grouped aggregate, the
    gate decision one aggregate over the scorecard (one row per unit), and
    rows reach ``published`` or ``quarantine`` through a join with the
    decisions. An empty micro-batch has no unit and writes nothing.
    """
    def apply(batch: DataFrame, epoch_id: int) -> None:
        unit = F.col(delivery_col) if delivery_col else F.lit(0)
        rows = batch.withColumn("_unit", unit).persist()
        try:
            card = quality.dq_sales(rows, "stream_batch", ["_unit"]).persist()  # six rows per unit
            decision = card.groupBy("_unit").agg(
                ((F.count_if("passed") / F.count(F.lit(1))) * F.lit(100.0) >= F.lit(float(threshold)))
                .alias("gate_passed"))
            scored = card.join(decision, "_unit")
            scored = (scored.withColumnRenamed("_unit", delivery_col) if delivery_col
                      else scored.drop("_unit"))
            _write_epoch(scored, f"{base}/scorecards", epoch_id)
            routed = rows.join(decision, "_unit")
            for passed, folder in ((True, "published"), (False, "quarantine")):
                part = routed.filter(F.col("gate_passed") == F.lit(passed)).drop("_unit", "gate_passed")
                _write_epoch(part, f"{base}/{folder}", epoch_id)
            card.unpersist()
        finally:
            rows.unpersist()
    return apply


def sealed_publisher(base: str, checkpoint: str, manifest, delivery_col: str = "delivery",
                     threshold: float = gates.PRE_TRANSFORM_GATE):
    """Score and gate a delivery once, when all its rows have arrived, over however many triggers.

    ``manifest`` gives a DataFrame (delivery, rows) of what each delivery holds;
    it is asked at every trigger, so it may grow. Rows wait in ``<base>/pending``,
    by delivery, stream and trigger. A delivery whose pending rows are as many
    as announced is scored as one unit; its scorecard and its rows go to
    ``scorecards`` and to ``published`` or ``quarantine``, each partitioned by
    delivery, so a replayed trigger writes the same again. Only deliveries that
    are announced and not scored yet are read.
    """
    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        writers.replace_partitions(batch.withColumns({
            "stream_id": F.lit(stream_id(spark, checkpoint)), "epoch_id": F.lit(epoch_id).cast("bigint")}),
            f"{base}/pending", delivery_col, "stream_id", "epoch_id")
        pending = spark.read.parquet(f"{base}/pending")
        announced = manifest()
        if path_exists(spark, f"{base}/scorecards"):
            scored = spark.read.parquet(f"{base}/scorecards").select(delivery_col).distinct()
            announced = announced.join(scored, delivery_col, "left_anti")
        waiting = {r[0]: r[1] for r in announced.select(delivery_col, "rows").collect()}  # one row per open delivery
        open_rows = pending.filter(F.col(delivery_col).isin(list(waiting)))
        arrived = {r[0]: r["count"] for r in open_rows.groupBy(delivery_col).count().collect()}
        over = [d for d, n in arrived.items() if n > waiting[d]]
        if over:
            raise gates.QualityGateError(f"deliveries with more rows than announced: {over[:5]}")
        ready = [d for d, n in arrived.items() if n == waiting[d]]
        if not ready:
            return
        rows = pending.filter(F.col(delivery_col).isin(ready)).drop("stream_id", "epoch_id")
        card = quality.dq_sales(rows, "stream_delivery", [delivery_col])
        decision = card.groupBy(delivery_col).agg(
            ((F.count_if("passed") / F.count(F.lit(1))) * F.lit(100.0) >= F.lit(float(threshold))).alias("gate_passed"))
        decided = card.join(decision, delivery_col).persist()  # six rows per delivery
        try:
            gate = {r[0]: r[1] for r in decided.select(delivery_col, "gate_passed").distinct().collect()}
            for passed, folder in ((True, "published"), (False, "quarantine")):
                units = [d for d, ok in gate.items() if ok == passed]
                if units:  # only these deliveries' folders are read
                    writers.replace_partitions(rows.filter(F.col(delivery_col).isin(units)), f"{base}/{folder}", delivery_col)
            # last: it marks the deliveries as scored
            writers.replace_partitions(decided, f"{base}/scorecards", delivery_col)
        finally:
            decided.unpersist()
    return apply


def scd2_applier(dim_base: str, snapshot_col: str = "extracted_at"):
    def apply(batch: DataFrame, epoch_id: int) -> None:
        from ..plans import dim_store
        batch = batch.persist()
        try:
            spark = batch.sparkSession
            # distinct snapshot times of this micro-batch: one per landed extract
            snaps = sorted(r[0] for r in batch.select(snapshot_col).distinct().collect())
            for ts in snaps:
                text = ts.isoformat(sep=" ")
                rows = batch.filter(F.col(snapshot_col) == ts_literal(text)).drop(snapshot_col)
                dim_store.apply_batch(spark, dim_base, rows, ts_literal(text), batch_id_text(text))
        finally:
            batch.unpersist()
    return apply
