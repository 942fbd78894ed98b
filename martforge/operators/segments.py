"""Ordered windows over keys of any size: range partitions and a boundary pass.

A window over a key puts all rows of that key into one task. Here the rows are
range-partitioned on (keys, order) instead, so a key that holds a third of all
rows spreads over a third of the partitions. The window runs per (segment, key);
what a segment needs from the segments before it (or after it) is one value per
key that crosses its border, and at most one key crosses each border. So the
boundary tables hold at most two rows per segment, and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

SEGMENT = "_segment"


def in_segments(df: DataFrame, keys, order) -> DataFrame:
    """``df`` in range partitions of (keys, order) with its segment number.

    Written to the shared folder: segment numbers must be the same for the rows
    and for the boundary pass, also after a lost executor. Rows equal in all of
    ``order`` share a segment; give a last column that parts them.
    """
    cols = [*keys, *order]
    ranged = df.repartitionByRange(*cols).withColumn(SEGMENT, F.spark_partition_id())
    path = scratch_path(df.sparkSession, "segments")
    ranged.write.parquet(path)
    return df.sparkSession.read.schema(ranged.schema).parquet(path)


def _crossing(seg: DataFrame, keys) -> DataFrame:
    """A superset of the keys that cross a border: firsts of segments that are lasts too (one per segment at most)."""
    key = F.struct(*keys)
    ends = seg.groupBy(SEGMENT).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    return (ends.select(F.col("first").alias("k")).join(ends.select(F.col("last").alias("k")), "k", "left_semi")
            .distinct().select("k.*"))


def carry(seg: DataFrame, keys, order, value: Column, name: str, inclusive: bool = False,
          backwards: bool = False) -> DataFrame:
    """Add ``name``: the last non-null ``value`` of the row's key before the row (``inclusive``: or at it).

    ``backwards`` goes from the end: the first non-null value after the row.
    """
    keys, order = list(keys), list(order)
    by = [F.col(c).desc() if backwards else F.col(c).asc() for c in order]
    w = Window.partitionBy(SEGMENT, *keys).orderBy(*by).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    at = F.when(F.col("_v").isNotNull(), F.struct(*order))
    edge = (F.min_by if backwards else F.max_by)("_v", at)
    valued = seg.withColumn("_v", value)
    # a few rows: the value with which each crossing key leaves each of its segments
    edges = valued.join(F.broadcast(_crossing(seg, keys)), keys, "left_semi").groupBy(SEGMENT, *keys).agg(edge.alias("_e"))
    step = F.col(SEGMENT).desc() if backwards else F.col(SEGMENT).asc()
    earlier = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(SEGMENT, *keys, F.last("_e", True).over(earlier).alias("_carried"))
    local = valued.withColumn("_local", F.last("_v", True).over(w))
    return local.join(F.broadcast(edges), [SEGMENT, *keys], "left").withColumn(
        name, F.coalesce("_local", "_carried")).drop("_v", "_local", "_carried")


def changed_rows(seg: DataFrame, keys, at: str, value: Column, end: str) -> DataFrame:
    """The rows whose ``value`` (never null) differs from the one before in their key, with ``end``: the ``at`` of the next such row.

    Rows are one per (key, ``at``). They are sorted once: what a segment gets from
    the others is worked out on the keys that cross a border alone.
    """
    keys = list(keys)
    valued = seg.withColumn("_v", value)
    crossing = valued.join(F.broadcast(_crossing(seg, keys)), keys, "left_semi")
    earlier = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.col(SEGMENT).desc()).rowsBetween(Window.unboundedPreceding, -1)
    # a few rows: the value with which each crossing key comes into each of its segments ...
    left = crossing.groupBy(SEGMENT, *keys).agg(F.max_by("_v", F.struct(at)).alias("_e"))
    left = left.select(SEGMENT, *keys, F.last("_e", True).over(earlier).alias("_carried"))
    # ... and the first change after it: up to there all rows hold the value that came in
    first = crossing.join(F.broadcast(left), [SEGMENT, *keys]).groupBy(SEGMENT, *keys).agg(
        F.first("_carried").alias("_carried"),
        F.min(F.when(~F.col("_v").eqNullSafe(F.col("_carried")), F.col(at))).alias("_f"))
    edges = first.select(SEGMENT, *keys, "_carried", F.last("_f", True).over(later).alias("_next"))
    w = Window.partitionBy(SEGMENT, *keys).orderBy(at)
    changed = (valued.withColumn("_before", F.lag("_v").over(w)).join(F.broadcast(edges), [SEGMENT, *keys], "left")
               .filter(~F.coalesce("_before", "_carried").eqNullSafe(F.col("_v"))))
    return changed.withColumn(end, F.coalesce(F.lead(at).over(w), "_next")).drop("_v", "_before", "_carried", "_next")
