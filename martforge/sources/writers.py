"""Table sinks: idempotent batch append, partitioned + clustered write, replace.

Every write goes through Spark's file commit protocol (task attempts write to
staging files, the job commits), so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system, scratch_path


#: Codec of layer tables: hashed keys are half of a fact's bytes, and hex text shrinks only under an entropy coder.
LAYER_CODEC = "zstd"


def append_batch(df: DataFrame, path: str, batch_col: str = "batch_id") -> str:
    """Append one batch, idempotent by batch id.

    The table is partitioned by ``batch_col`` and written with dynamic
    partition overwrite: re-running a batch replaces exactly its own
    partition, other batches are untouched, and no driver-side lookup is
    needed.
    """
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(batch_col)
     .parquet(path, compression=LAYER_CODEC))
    return path


def write_partitioned(df: DataFrame, path: str, date_source: str, cluster_cols,
                      date_col: str = "partition_date", mode: str = "overwrite",
                      num_partitions: int | None = None, derive=None) -> str:
    """Partition by the day of ``date_source``; cluster (sort) by ``cluster_cols``.

    Range-partitioning on (day, cluster columns) instead of hashing on the
    day alone: a hot day is split over several writer tasks, and each file
    holds a sorted run of cluster keys, so parquet min/max statistics skip
    row groups for filters on the cluster columns.

    ``derive`` makes the table's columns from the clustered rows and keeps
    ``date_col``: what can be computed does not cross the shuffle.
    """
    cluster_cols = list(cluster_cols)
    d = df.withColumn(date_col, F.to_date(date_source))
    keys = [date_col, *cluster_cols]
    d = d.repartitionByRange(num_partitions, *keys) if num_partitions else d.repartitionByRange(*keys)
    d = d.sortWithinPartitions(*keys)
    if derive:
        d = derive(d)
    d.write.mode(mode).partitionBy(date_col).parquet(path)
    return path


def as_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table under the shared folder: its size is that of its files, which the planner knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=LAYER_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_partitions(df: DataFrame, path: str, *by: str) -> str:
    """Replace the partitions that ``df`` has rows of; other partitions keep their files.

    ``df`` must not read from ``path``.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
    return path


def publish_partitions(spark: SparkSession, staged: str, path: str) -> str:
    """Replace the partitions that the written table ``staged`` has by its folders, which are moved, not written again.

    As ``replace_partitions``, with ``staged`` in the file system of ``path``; what is left of it is removed.
    """
    fs, src = file_system(spark, staged)
    _, dst = file_system(spark, path)
    fs.mkdirs(dst)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in [x.getPath() for x in fs.listStatus(src) if x.isDirectory()]:
        target = path_of(dst, folder.getName())
        fs.delete(target, True)
        if not fs.rename(folder, target):
            raise OSError(f"cannot move {folder} to {target}")
    fs.delete(src, True)
    return path


def replace_table(df: DataFrame, path: str) -> str:
    """Write a table at ``path``, over what is there: for folders of a run's own.

    A failed write leaves no table; what readers use is replaced by ``replace_view``.
    """
    df.write.mode("overwrite").parquet(path, compression=LAYER_CODEC)
    return path


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int, sort=()) -> DataFrame:
    """``df`` as the table ``table`` at ``path``, in ``buckets`` buckets of ``key``, each file sorted by (key, sort).

    Tables of equal buckets and key are joined and aggregated on it without an
    exchange; a filter on the key reads its bucket only.
    """
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *sort)
     .option("path", path).mode("overwrite").saveAsTable(table))
    return df.sparkSession.table(table)


def replace_view(df: DataFrame, base: str, view: str) -> str:
    """Replace what ``view`` shows by ``df``: a new folder under ``base``, then the view is switched to it.

    Readers see the old rows until the write has ended; a failed write changes
    nothing for them. Returns the new folder.
    """
    path = f"{base.rstrip('/')}/v={uuid.uuid4().hex}"
    df.write.parquet(path)
    spark = df.sparkSession
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
    return path
