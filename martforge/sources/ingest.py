"""Resumable ingest, progress ledger, incremental feeds.

Resume is file-granular: landed files are read by the streaming file source
with a checkpoint, so a restarted job continues after the last committed
micro-batch and a finished job reads nothing twice. Row-exact resume against
a target table is a ``left_anti`` join on the business key.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import pct


def session_files(spark: SparkSession, at_least: int = 1) -> int:
    """A file count that grows with the data: the session's initial shuffle
    partitions (sized from the input by ``size_for_input``), at least ``at_least``."""
    conf = spark.conf
    n = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or \
        conf.get("spark.sql.shuffle.partitions")
    return max(at_least, int(n))


def land_files(df: DataFrame, path: str, n_files: int | None, order_cols, fmt: str = "parquet",
               mode: str = "overwrite") -> str:
    """Write ``df`` as range-ordered files (a landing folder; ``mode='append'``
    adds a new delivery next to the files already landed).

    ``n_files=None`` lets the file count follow the data: range partitions
    sized by the session (``size_for_input``) and coalesced by AQE, so no
    file, and no writer task, holds more than about one shuffle partition.
    """
    r = (df.repartitionByRange(n_files, *order_cols) if n_files else df.repartitionByRange(*order_cols))
    w = r.sortWithinPartitions(*order_cols).write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def ingest_resumable(spark: SparkSession, src_dir: str, schema: StructType, dst: str, checkpoint: str,
                     fmt: str = "parquet", max_files_per_trigger: int = 1,
                     foreach_batch=None) -> str:
    """Process every landed file not yet committed, then stop (availableNow).

    Output: parquet at ``dst``. The checkpoint records which files each
    micro-batch took; after a failure the same call resumes; a second call
    after success reads zero rows.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.format(fmt).load(src_dir)
    if foreach_batch is None:
        w = stream.writeStream.format("parquet").option("path", dst)
    else:
        w = stream.writeStream.foreachBatch(foreach_batch)
    q = w.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return dst


def progress_ledger(df: DataFrame, chunk: int) -> DataFrame:
    """Progress after each chunk of ``chunk`` rows: (chunk_no, rows_in_chunk,
    processed_rows, total_rows, completion_percentage).

    Chunks are consecutive ranges of the total order, so only the row total
    is data-dependent: one count, then a distributed ``range`` of chunk
    numbers (no global sort, no window over the data).
    """
    spark = df.sparkSession
    total = df.count()
    n_chunks = math.ceil(total / chunk) if total else 0
    r = spark.range(n_chunks).withColumnRenamed("id", "chunk_no")
    processed = F.least((F.col("chunk_no") + 1) * chunk, F.lit(total))
    return r.select(
        "chunk_no",
        (processed - F.col("chunk_no") * chunk).cast("bigint").alias("rows_in_chunk"),
        processed.cast("bigint").alias("processed_rows"),
        F.lit(total).cast("bigint").alias("total_rows"),
        pct(processed.cast("double"), F.lit(float(total))).alias("completion_percentage"),
    )


def incremental_union(existing: DataFrame, feed: DataFrame, keys) -> DataFrame:
    """Existing rows plus feed rows whose key is not yet present (left anti)."""
    keys = list(keys)
    new = feed.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(new)
