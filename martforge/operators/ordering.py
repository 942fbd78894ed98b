"""Order-dependent operators without a single-partition step.

``with_row_index`` gives every row its 0-based position in a total order:
range-partition on the order (tie-broken by the remaining columns, so even a
hot key value spreads over several partitions), sort within partitions, tag
each row with (partition, position), count rows per partition (one row per
partition), turn the counts into offsets with a window over that tiny table
and add them back with a broadcast of at most one row per partition. Row
skipping and slicing then become plain filters, so nothing ever funnels the
whole table through one task (``offset()`` would).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import as_table

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def total_order(df: DataFrame, order_cols) -> list:
    order_cols = list(order_cols)
    return [F.col(c) for c in order_cols] + [F.col(c) for c in df.columns if c not in order_cols]


def with_row_index(df: DataFrame, order_cols, name: str = "row_index") -> DataFrame:
    order = total_order(df, order_cols)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.select(
        "*",
        F.shiftright("_mid", _POS_BITS).alias("_pid"),
        F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_pos"),
    ).drop("_mid")
    tagged = as_table(tagged, "row-index")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # offsets has one row per partition: a bounded broadcast
    out = tagged.join(F.broadcast(offsets), "_pid", "inner")
    return out.withColumn(name, F.col("_off") + F.col("_pos")).drop("_pid", "_pos", "_off")


def skip_rows(df: DataFrame, order_cols, n: int) -> DataFrame:
    """Rows after the first ``n`` in the given order (resume after n processed rows)."""
    cols = df.columns
    return with_row_index(df, order_cols, "_ri").filter(F.col("_ri") >= n).select(*cols)


def chunk_slice(df: DataFrame, order_cols, start: int, length: int) -> DataFrame:
    """Rows [start, start + length) of the total order."""
    cols = df.columns
    idx = with_row_index(df, order_cols, "_ri")
    return idx.filter((F.col("_ri") >= start) & (F.col("_ri") < start + length)).select(*cols)


def concat_chunks(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name (duplicates kept)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def dedup_latest(df: DataFrame, keys, order_cols, latest: bool = True, clustered: bool = False) -> DataFrame:
    """One row per key: the last (or first) by a total order.

    Expressed as ``max(struct(order..., rest...))`` per key - a partial
    aggregate, combined map-side, so a hot key never gathers its rows in one
    task (a ``row_number`` window would).

    ``clustered``: the rows come out range-partitioned and sorted by ``keys``
    from one shuffle and one sort, for a writer that wants them so (the copies
    of one key then meet in one task).
    """
    keys = list(keys)
    order_cols = list(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    if clustered:
        by = [F.col(c).desc() if latest else F.col(c).asc() for c in order_cols + rest]
        first = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
        return df.repartitionByRange(*keys).withColumn("_n", first).filter("_n = 1").select(*df.columns)
    s = F.struct(*[F.col(c) for c in order_cols + rest])
    agg = F.max(s) if latest else F.min(s)
    out = df.groupBy(*keys).agg(agg.alias("_r"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])
