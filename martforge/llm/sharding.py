"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations.

Equal texts form a group. Groups are hashed into a fixed number of slots, each
a point of the ring; a slot belongs to the first virtual node clockwise whose
shard has room for it, and goes on past full shards. A shard is full at
(1 + slack) times the mean of bytes; adding a shard moves what falls to its
virtual nodes and what overflows. The heaviest slots are placed first, so that
groups stay whole where they can. A slot of more than half a shard (a hot group)
is divided by a hash of the rows, and a part of more than half a shard (one row
that is repeated very often) by the rows' places in the input. So nothing but a
single row can be larger than half a shard, and the loads stay within the limit
unless rows of that size leave room in none; those go to the emptiest shard.

Only byte sums are seen by the driver: of at most SLOTS slots and of PARTS parts
of each divided slot or part, of which there are at most twice as many as shards.

Defined results: a null text has size 1 and the checksum of an empty text; equal
rows share their slot or its part unless they alone are a hot part; positions
inside a shard are gapless from 0; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, Window, functions as F

from .graph import materialize

SLOTS = 1 << 14
PARTS = 1 << 8
VIRTUAL_NODES = 64
SLACK = 0.005
#: Rows that one numbering task takes.
BIN_ROWS = 50_000


def place(slots: list[tuple[int, int, int]], ring: list[tuple[int, int]], shards: int, slack: float) -> list[int]:
    """The shard of each slot (size, ring point, id): clockwise to the first shard with room.

    What fits nowhere goes to the shard with most room.
    """
    limit = -(-int(sum(s[0] for s in slots) * (1 + slack)) // shards)
    loads, points, out = [0] * shards, [p for p, _ in ring], [0] * len(slots)
    for i in sorted(range(len(slots)), key=lambda i: (-slots[i][0], slots[i][1], slots[i][2])):
        size, point, _ = slots[i]
        begin, tried = bisect_left(points, point), set()
        for k in range(len(ring)):
            shard = ring[(begin + k) % len(ring)][1]
            if shard in tried:
                continue
            if loads[shard] + size <= limit:
                break
            tried.add(shard)
            if len(tried) == shards:
                shard = min(range(shards), key=lambda s: (loads[s], s))
                break
        loads[shard] += size
        out[i] = shard
    return out


def shard(docs: DataFrame, shards: int = 8, slack: float = SLACK, nodes: int = VIRTUAL_NODES) -> DataFrame:
    """Per row doc_id, size, text_crc32, shard and slot (its place in the shard)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = materialize(spark, docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(SLOTS)).cast("int").alias("g"),
        F.xxhash64(F.col("doc_id").cast("string"), F.lit("row"), text).alias("h"),
        F.xxhash64(F.monotonically_increasing_id()).alias("place")), "shard-rows")
    sums = {r.g: (r.bytes, r.n) for r in rows.groupBy("g").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
    total = sum(b for b, _ in sums.values())
    loads = {(g, 0): b for g, (b, _) in sums.items()}
    rows = rows.withColumn("p", F.lit(0))
    # hot slots are divided by row, then hot parts of them by place
    for base, by in ((1, "h"), (1 + PARTS, "place")):
        hot = sorted(s for s, b in loads.items() if 2 * b * shards > total)
        if not hot:
            break
        divided = F.struct("g", "p").isin([F.struct(F.lit(g), F.lit(p)) for g, p in hot])
        # parts of a part keep its number in front
        number = F.col("p") * (PARTS + 1) + base + F.pmod(by, F.lit(PARTS))
        rows = rows.withColumn("was", F.when(divided, F.col("p")).otherwise(-1)).withColumn(
            "p", F.when(divided, number).otherwise(F.col("p")).cast("int"))
        loads = {s: b for s, b in loads.items() if s not in hot} | {(r.g, r.p): r.bytes for r in rows.filter("was >= 0").groupBy(
            "g", "p").agg(F.sum("size").alias("bytes")).collect()}
        rows = rows.drop("was")
    slots = [(b, g, p) for (g, p), b in loads.items()]
    ring = sorted((r.point, r.shard) for r in spark.range(shards * nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.xxhash64("id", F.lit("node")).alias("point")).collect())
    table = spark.createDataFrame([(g, p) for _, g, p in slots], "g int, p int")
    points = {(r.g, r.p): r.point for r in table.select("g", "p", F.xxhash64("g", "p", F.lit("slot")).alias("point")).collect()}
    chosen = place([(b, points[g, p], g << 32 | p) for b, g, p in slots], ring, shards, slack)
    owners = spark.createDataFrame([(g, p, s) for (_, g, p), s in zip(slots, chosen)], "g int, p int, shard int")

    bins = max(1, sum(n for _, n in sums.values()) // (shards * BIN_ROWS) + 1) * 32
    placed = materialize(spark, rows.join(F.broadcast(owners), ["g", "p"]).select(
        "doc_id", "size", "text_crc32", "shard",
        # rows divided by place are numbered by place, so equal ones do not share a bin
        F.pmod(F.when(F.col("p") > PARTS, F.col("place")).otherwise(F.col("h")), F.lit(bins)).alias("bin")), "shard-placed")
    before = (placed.groupBy("shard", "bin").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("shard").orderBy("bin")) - F.col("count")))
    nth = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("doc_id", "text_crc32", "size"))
    return placed.withColumn("nth", nth).join(before.select("shard", "bin", "before"), ["shard", "bin"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("nth") - 1).cast("long").alias("slot"))
