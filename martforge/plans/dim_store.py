"""Versioned storage of the type-2 dimension (no MERGE on parquet).

Each applied batch writes ONE new folder ``<base>/v=<batch_id>``, partitioned
by ``is_current``:

* ``is_current=true``  - the complete current set after the batch;
* ``is_current=false`` - only the versions this batch closed.

A batch reads and merges the current rows of the newest version only; the
history is never read or rewritten, so a batch costs the size of the current
set, not of the whole history. The full dimension is the closed rows of every
committed version plus the current rows of the newest one.

Rows of a batch that the dimension already holds at the batch's time are
skipped, so re-running a load is a no-op; further rows of the newest batch (an
extract of several files) become one more part of it, ``v=<batch_id>_pNNNNN``.
Rows without a key go to ``<base>_rejected`` (at least once). A failed write
leaves no ``_SUCCESS`` marker, and uncommitted folders are ignored by readers.

What each batch said is kept in ``<base>_observed``. A batch for a time before
the newest one is spliced in: the versions of its keys are built anew from all
that was observed of them, and one folder ``v=<newest>_pNNNNNr`` is written that
holds the whole dimension and stands for all folders before it. So extracts may
arrive in any order; a late one costs a copy of the dimension.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from ..functions.columns import batch_id as batch_id_of, surrogate_key
from ..operators import scd2
from ..operators.ordering import dedup_latest
from ..schemas import DIM_PRODUCT

VERSION_PREFIX = "v="
PART = "_p"
WHOLE = "r"  # ends the name of a version that holds the whole dimension
_SUFFIX = re.compile(rf"{PART}\d{{5}}{WHOLE}?$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed_versions(spark: SparkSession, base: str) -> list[str]:
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION_PREFIX):
            if fs.exists(st.getPath().suffix("/_SUCCESS")):
                out.append(name[len(VERSION_PREFIX):])
    return sorted(out)


def current_path(spark: SparkSession, base: str) -> str | None:
    v = committed_versions(spark, base)
    return f"{base}/{VERSION_PREFIX}{v[-1]}" if v else None


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    """Current rows of the newest committed version."""
    p = current_path(spark, base)
    return spark.read.schema(DIM_PRODUCT).parquet(p).filter(F.col("is_current")) if p else None


def read_dimension(spark: SparkSession, base: str) -> DataFrame | None:
    """The full dimension: closed versions of every committed batch plus the
    current rows of the newest (one scan over the version folders, pruned on
    ``v`` and ``is_current``)."""
    versions = committed_versions(spark, base)
    if not versions:
        return None
    whole = [i for i, v in enumerate(versions) if v.endswith(WHOLE) and _SUFFIX.search(v)]
    versions = versions[whole[-1]:] if whole else versions
    schema = StructType([*DIM_PRODUCT.fields, StructField("v", StringType())])
    df = (spark.read.schema(schema).option("basePath", base)
          .parquet(*[f"{base}/{VERSION_PREFIX}{v}" for v in versions]))
    keep = ~F.col("is_current") | (F.col("v") == F.lit(versions[-1]))
    return df.filter(keep).drop("v")


def _observe(incoming: DataFrame, base: str, name: str, batch_ts: Column) -> None:
    incoming.select(scd2.PRODUCT_KEY, *scd2.PRODUCT_ATTRS, batch_ts.alias("observed_at")).write.mode("overwrite").parquet(
        f"{base}_observed/{VERSION_PREFIX}{name}")


def _observed(spark: SparkSession, base: str) -> DataFrame | None:
    names = committed_versions(spark, f"{base}_observed")
    if not names:
        return None
    fields = [f for f in DIM_PRODUCT.fields if f.name in (scd2.PRODUCT_KEY, *scd2.PRODUCT_ATTRS)]
    schema = StructType([*fields, StructField("observed_at", TimestampNTZType())])
    return spark.read.schema(schema).parquet(*[f"{base}_observed/{VERSION_PREFIX}{n}" for n in names])


def _splice(spark: SparkSession, base: str, incoming: DataFrame, batch_ts: Column, batch_id: str, order_cols) -> str:
    """Insert a late batch by its time; returns the path of the version that holds the dimension anew."""
    key, attrs = scd2.PRODUCT_KEY, list(scd2.PRODUCT_ATTRS)
    if order_cols:
        incoming = dedup_latest(incoming, [key], list(order_cols))
    dim = read_dimension(spark, base)
    said = incoming.select(key, *attrs, batch_ts.alias("observed_at"))
    seen = dim.select(key, *attrs, F.col("effective_date").alias("observed_at"))
    observed = _observed(spark, base)
    if observed is not None:
        same_time = observed.filter(F.col("observed_at") == batch_ts).withColumn("_h", scd2.record_hash(*attrs))
        other = [r[key] for r in said.withColumn("_n", scd2.record_hash(*attrs)).join(
            same_time.select(key, "_h"), key).filter("_h <> _n").select(key).limit(5).collect()]
        if other:
            raise ValueError(f"batch {batch_id} repeats product ids in another part, e.g. {other}")
        seen = seen.unionByName(observed.select(key, *attrs, "observed_at"))
    keys = said.select(key).distinct()
    history = scd2.scd2_history(seen.join(keys, key, "left_semi").unionByName(said), key, "observed_at", attrs)
    start = F.col("effective_date")
    anew = history.withColumns({
        scd2.SURROGATE: surrogate_key(F.col(key), start), "record_hash": scd2.record_hash(*attrs), "created_date": start,
        "updated_date": F.when(F.col("is_current"), start).otherwise(F.col("end_date")), "batch_id": batch_id_of(start)})
    newest = committed_versions(spark, base)[-1]
    batch = _SUFFIX.sub("", newest)
    n = sum(_SUFFIX.sub("", v) == batch for v in committed_versions(spark, base))
    target = f"{base}/{VERSION_PREFIX}{batch}{PART}{n:05d}{WHOLE}"
    parts = sum(_SUFFIX.sub("", v) == batch_id for v in committed_versions(spark, f"{base}_observed"))
    _observe(incoming, base, f"{batch_id}{PART}{parts:05d}", batch_ts)
    (dim.join(keys, key, "left_anti").select(*scd2.DIM_COLUMNS).unionByName(anew.select(*scd2.DIM_COLUMNS))
     .write.mode("overwrite").partitionBy("is_current").parquet(target))
    return target


def _not_held(dim: DataFrame, incoming: DataFrame, batch_ts: Column) -> DataFrame:
    """The incoming rows that the dimension does not hold as of ``batch_ts``."""
    held = dim.filter((F.col("effective_date") <= batch_ts) & (F.col("end_date") > batch_ts)).select(
        scd2.PRODUCT_KEY, "record_hash")
    return (incoming.withColumn("record_hash", scd2.record_hash(*scd2.PRODUCT_ATTRS))
            .join(held, [scd2.PRODUCT_KEY, "record_hash"], "left_anti").drop("record_hash"))


def apply_batch(spark: SparkSession, base: str, incoming: DataFrame, batch_ts: Column,
                batch_id: str, order_cols=None) -> str:
    """Merge ``incoming`` into the current rows; returns the version path.

    A batch repeating a business key is refused unless ``order_cols`` says
    which of its records is the latest; so is one that, in another part, gives
    a key other values. One that comes after a newer batch is spliced in.
    """
    key = scd2.PRODUCT_KEY
    keyless = incoming.filter(F.col(key).isNull())
    if not keyless.isEmpty():
        keyless.write.mode("append").parquet(f"{base}_rejected/{VERSION_PREFIX}{batch_id}")
    incoming = incoming.filter(F.col(key).isNotNull())
    versions = committed_versions(spark, base)
    own = [v for v in versions if v == batch_id or v.startswith(batch_id + PART)]
    target = f"{base}/{VERSION_PREFIX}{batch_id}"
    if own:
        target += f"{PART}{len(own):05d}"
        incoming = _not_held(read_dimension(spark, base), incoming, batch_ts)
        if incoming.isEmpty():
            return f"{base}/{VERSION_PREFIX}{own[-1]}"  # already applied
    late = bool(versions) and batch_id < _SUFFIX.sub("", versions[-1])
    if late and not own and batch_id in {_SUFFIX.sub("", v) for v in committed_versions(spark, f"{base}_observed")} \
            and _not_held(read_dimension(spark, base), incoming, batch_ts).isEmpty():
        return f"{base}/{VERSION_PREFIX}{versions[-1]}"  # spliced in before
    if own and not late:
        now = read_current(spark, base).filter(F.col("effective_date") == batch_ts).select(key)
        other = [r[key] for r in incoming.join(now, key, "left_semi").select(key).limit(5).collect()]
        if other:
            raise ValueError(f"batch {batch_id} repeats product ids in another part, e.g. {other}")
    if not order_cols:
        dups = scd2.duplicate_keys(incoming, scd2.PRODUCT_KEY)
        if dups:
            raise ValueError(f"batch {batch_id} repeats product ids, e.g. {dups}; pass order_cols")
    if late:
        return _splice(spark, base, incoming, batch_ts, batch_id, order_cols)
    current = read_current(spark, base)
    _observe(dedup_latest(incoming, [scd2.PRODUCT_KEY], list(order_cols)) if order_cols else incoming, base,
             target.rsplit(VERSION_PREFIX, 1)[1], batch_ts)
    if current is None:
        if order_cols:
            incoming = dedup_latest(incoming, [scd2.PRODUCT_KEY], list(order_cols))
        dim = scd2.scd2_initial(incoming, batch_ts)
    else:
        # current rows only: the output is the new current set plus the rows
        # this batch closes; older history stays where it is
        dim = scd2.scd2_merge(current, incoming, batch_ts, order_cols=order_cols)
    dim.select(*scd2.DIM_COLUMNS).write.mode("overwrite").partitionBy("is_current").parquet(target)
    return target
