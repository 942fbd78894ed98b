"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import drop_path, scratch_path


def materialize(spark: SparkSession, df: DataFrame, name: str, by: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts the lineage; survives lost executors."""
    path = scratch_path(spark, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that nothing holds any more (it does so after a collection of the
    driver's heap, which a large heap puts off)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows of a side that is sent to every task after its rows were counted; a larger one is joined by a shuffle.
FEW_ROWS = 1 << 20


def few(df: DataFrame) -> DataFrame:
    """``df`` (a few numbers a row) to be sent to every task if it has at most FEW_ROWS rows."""
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


def discard(*frames: DataFrame) -> None:
    """Remove the files of materialized frames that nothing reads any more."""
    for df in frames:
        drop_path(df.sparkSession, df.scratch)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` (any order, repeats allowed) to ``(node, label)``: the least node of each component.

    Alternating large-star and small-star steps: every step joins nodes to
    the least neighbour seen, sums run map-side, and nothing is collected.
    Each round is written to the shared folder. No edges give no rows.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))

    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(spark, edges, "cc")
    while True:
        full = both(edges)
        # large star: each larger neighbour is tied to the least of the neighbourhood
        large = (full.join(least(full), "u").filter("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: each node and its smaller neighbours are tied to the least of them
        near = least(large)
        small = (large.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(near.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        new = materialize(spark, small, "cc")
        changed = new.exceptAll(edges).limit(1).count() + edges.exceptAll(new).limit(1).count()
        discard(edges)
        edges = new
        if not changed:
            break
    labels = materialize(spark, edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct(), "cc-labels")
    discard(edges)
    return labels
