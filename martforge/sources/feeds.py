"""Landed feed ingest (S12): declared schema + key per feed, new keys only.

Files of a feed land in its folder; the resumable stream picks up files not
yet committed; each micro-batch keeps one row per key (deterministic pick),
drops keys already in the table (``left_anti``, shuffled on the key) and
writes the rest into the batch's own ``epoch_id`` partition with dynamic
overwrite, so a replayed epoch replaces exactly its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import dedup_latest
from ..schemas import FEEDS
from .ingest import ingest_resumable


def feed_spec(name: str):
    if name not in FEEDS:
        raise KeyError(f"unknown feed {name}; known: {sorted(FEEDS)}")
    return FEEDS[name]


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p.suffix("/_SUCCESS")) or fs.exists(p)


def ingest_feed(spark: SparkSession, name: str, landed_dir: str, table: str, checkpoint: str,
                fmt: str = "csv", max_files_per_trigger: int = 8) -> str:
    schema, keys = feed_spec(name)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        one = dedup_latest(batch, keys, [])
        if _exists(spark, table):
            existing = spark.read.parquet(table).filter(F.col("epoch_id") != epoch_id).select(*keys)
            one = one.join(existing, keys, "left_anti")
        (one.withColumn("epoch_id", F.lit(epoch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("epoch_id").parquet(table))

    ingest_resumable(spark, landed_dir, schema, table, checkpoint, fmt=fmt,
                     max_files_per_trigger=max_files_per_trigger, foreach_batch=merge)
    return table


def ingest_feed_once(spark: SparkSession, schema, keys, landed_dir: str, table: str, checkpoint: str,
                     fmt: str = "parquet", bytes_per_trigger: int = 10 << 30) -> str:
    """Append each key's first delivered row to ``table``; redelivered keys add nothing, in whatever trigger.

    The keys seen are the stream's state, partitioned by key and kept in the
    checkpoint, so a trigger reads the new files only and never the table. The
    checkpoint belongs to the table: both are kept or dropped together. Of rows
    of one key inside a trigger any one is taken.
    """
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_trigger)
    if fmt == "csv":
        reader = reader.options(header=True, escape='"')
    first = reader.format(fmt).load(landed_dir).dropDuplicates(list(keys))
    (first.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return table
