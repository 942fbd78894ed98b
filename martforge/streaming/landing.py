"""Landed CSV files -> typed rows, malformed records set aside, a ledger of every file read.

Each trigger parses its files once, permissively and with the quote rule of the
batch scan, and writes three tables under ``base``, partitioned by stream and
trigger:

* ``rows``      - records that fit the declared schema;
* ``malformed`` - the others: their text and their file (too few or too many fields, values of another type);
* ``ledger``    - records and malformed records of every file.

The stream is the id that the checkpoint keeps, so a replayed trigger replaces
its own output and a new checkpoint adds to the tables instead of overwriting
them. A trigger takes at most ``bytes_per_trigger``, whatever the file count.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import pct
from ..sources.csv import CORRUPT_COL
from ..sources.writers import replace_partitions

ROWS, MALFORMED, LEDGER = "rows", "malformed", "ledger"
PARTS = ("stream_id", "epoch_id")
LEDGER_SCHEMA = "source_file string, records bigint, malformed bigint, stream_id string, epoch_id bigint"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def ingest_csv(spark: SparkSession, src: str, schema: StructType, base: str, checkpoint: str,
               bytes_per_trigger: int = 10 << 30, files_per_trigger: int | None = None, after_write=None) -> None:
    """Read every file not yet committed, then stop. ``after_write(epoch_id)`` runs before a trigger's commit."""
    parsed = StructType([*schema.fields, StructField(CORRUPT_COL, StringType(), True)])
    reader = spark.readStream.schema(parsed).options(
        header=True, mode="PERMISSIVE", escape='"', columnNameOfCorruptRecord=CORRUPT_COL)
    reader = (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger
              else reader.option("maxBytesPerTrigger", bytes_per_trigger))
    stream = reader.csv(src).withColumn("source_file", F.col("_metadata.file_path"))

    def land(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.withColumns({"stream_id": F.lit(stream_id(spark, checkpoint)),
                                   "epoch_id": F.lit(epoch_id).cast("bigint")}).persist()
        try:
            bad = F.col(CORRUPT_COL).isNotNull()
            replace_partitions(batch.filter(~bad).select(*schema.fieldNames(), *PARTS), f"{base}/{ROWS}", *PARTS)
            replace_partitions(batch.filter(bad).select("source_file", F.col(CORRUPT_COL).alias("record"), *PARTS),
                               f"{base}/{MALFORMED}", *PARTS)
            counted = batch.groupBy("source_file", *PARTS).agg(
                F.count(F.lit(1)).alias("records"), F.count_if(bad).alias("malformed"))
            replace_partitions(counted, f"{base}/{LEDGER}", *PARTS)
        finally:
            batch.unpersist()
        if after_write:
            after_write(epoch_id)

    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def ledger(spark: SparkSession, base: str, total_records: int) -> DataFrame:
    """One row per file in the order of reading: records, malformed, processed so far, share of ``total_records``.

    The running sums are taken over triggers first and then inside each
    trigger, so no task sees all files.
    """
    files = spark.read.schema(LEDGER_SCHEMA).parquet(f"{base}/{LEDGER}")
    triggers = files.groupBy(*PARTS).agg(F.sum("records").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("stream_id").orderBy("epoch_id").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.sum("records").over(Window.partitionBy(*PARTS).orderBy("source_file").rowsBetween(
        Window.unboundedPreceding, 0))
    out = files.join(triggers.select(*PARTS, before.alias("_before")), list(PARTS)).withColumn(
        "processed_records", F.col("_before") + inside)
    return out.select(*PARTS, "source_file", "records", "malformed", "processed_records",
                      F.lit(total_records).cast("bigint").alias("total_records"),
                      pct(F.col("processed_records").cast("double"), F.lit(float(total_records)))
                      .alias("completion_percentage"))
