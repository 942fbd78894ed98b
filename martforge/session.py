"""Session construction and the shared work folder.

Runtime settings the engine relies on:

* session time zone UTC - the warehouse columns are ``timestamp_ntz``; they
  are only converted to instants for watermarks, and converted back before
  output, so the zone must be fixed;
* ANSI mode on - bad casts raise instead of silently becoming null;
* AQE on with skew-join splitting and runtime broadcast conversion, so a join
  side is broadcast only after its materialised size has been measured.
"""

from __future__ import annotations

import contextlib
import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Static broadcast only for inputs whose on-disk size is tiny (nation,
    # region); every other side is broadcast only when AQE has measured its
    # materialised size under the runtime threshold, else sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "martforge") -> SparkSession:
    """Session for tests and the bench; clusters pass their own builder."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of lineage cuts are removed once nothing references them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings the operators assume (idempotent)."""
    conf = dict(ENGINE_CONF)
    # Listing a day-partitioned table: Spark's default runs one listing task
    # per folder (up to 10,000 tasks). The cluster's own parallelism (its core
    # count) lists the same folders in one wave of tasks.
    conf["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(
        max(1, spark.sparkContext.defaultParallelism))
    for k, v in conf.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked settings stay as the cluster set them
            pass
    return spark


# Shuffle and scan sizing (bytes of compressed input per task).
SHUFFLE_TARGET_BYTES = 128 * 1024 * 1024
LARGE_INPUT_BYTES = 1 << 40
SCAN_SPLIT_BYTES = 128 * 1024 * 1024
LARGE_SCAN_SPLIT_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 100_000


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` (file-system metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def size_for_input(spark: SparkSession, n_bytes: int) -> int:
    """Size shuffles and scans for an input of ``n_bytes``.

    * initial shuffle partitions (before AQE coalesces them) = input /
      128 MB, rounded up to whole waves of the cluster's cores, at most
      100,000 (a 100 TB input gets the cap, about 1 GB of input per
      partition before column pruning and partial aggregation shrink it);
      a small input keeps one partition per core;
    * AQE coalesces toward 128 MB per partition (also the size skewed
      partitions are split into);
    * scans read 128 MB splits, 256 MB past 1 TiB of input (half the tasks).

    Returns the initial shuffle partition count.
    """
    cores = max(1, spark.sparkContext.defaultParallelism)
    want = math.ceil(max(0, n_bytes) / SHUFFLE_TARGET_BYTES)
    n = min(MAX_SHUFFLE_PARTITIONS, max(cores, math.ceil(want / cores) * cores))
    conf = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_TARGET_BYTES),
    }
    conf["spark.sql.files.maxPartitionBytes"] = str(
        LARGE_SCAN_SPLIT_BYTES if n_bytes >= LARGE_INPUT_BYTES else SCAN_SPLIT_BYTES)
    for k, v in conf.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # locked by the cluster
            pass
    return n


TABLE_SHUFFLE_BYTES = 8 * 1024 * 1024
TABLE_PARTITION_BYTES = 32 * 1024 * 1024


def size_table_shuffles(spark: SparkSession, n_bytes: int) -> int:
    """Initial shuffle partitions of a query over the warehouse tables: one per 8 MB of input (compressed columns swell
    about tenfold as rows), in whole waves of the cores; AQE coalesces them toward 32 MB. So the rows that one
    task sorts or aggregates do not follow the input. At least what ``size_for_input`` asks for."""
    cores = max(1, spark.sparkContext.defaultParallelism)
    least = size_for_input(spark, n_bytes)
    want = math.ceil(max(0, n_bytes) / TABLE_SHUFFLE_BYTES / cores) * cores
    n = max(least, min(MAX_SHUFFLE_PARTITIONS, want))
    for k, v in {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TABLE_PARTITION_BYTES)}.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # locked by the cluster
            pass
    return n


TEXT_SHUFFLE_BYTES = 32 * 1024 * 1024


def size_text_shuffles(spark: SparkSession, n_bytes: int) -> int:
    """Initial shuffle partitions of a query over texts: one per 32 MB of input (compressed; texts swell when they are
    read), at least those that the session is set to; AQE coalesces them. Scans stay as the session has them."""
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / TEXT_SHUFFLE_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


TEXT_BATCH_BYTES = 4 * 1024 * 1024


def size_text_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of about 4 MB, however long their texts are (Spark's default counts rows alone,
    10,000, of which an executor holds several copies per task while whole texts pass)."""
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BATCH_BYTES))
    except Exception:  # locked by the cluster
        pass


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Run a block under other session settings."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            with contextlib.suppress(Exception):  # locked by the cluster
                spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            with contextlib.suppress(Exception):
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: The shuffle files of a write are removed when it has ended, not when the driver's heap is next collected.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only where it is unset (local tests) a folder is
    created and registered, so lineage cuts and written tables always land in
    a place every executor can reach.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="martforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)  # DataFrame.checkpoint() writes under the same shared folder
    return d.rstrip("/")


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove scratch output (paths of ``scratch_path`` only)."""
    if not path.startswith(f"{shared_dir(spark)}/martforge/"):
        raise ValueError(f"not a scratch path: {path}")
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder for one job's output."""
    return f"{shared_dir(spark)}/martforge/{name}-{uuid.uuid4().hex[:12]}"
