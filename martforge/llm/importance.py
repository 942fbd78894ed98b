"""Target-distribution importance resampling on hashed word n-grams.

Texts are lowered (A-Z only) and every run of separators becomes one space, so
an overlapped scan with boundary lookarounds emits the span of each n-gram of
words directly; the CRC of its UTF-8 bytes, modulo ``buckets``, is its feature.
Bucket counts of the documents and of the target give each bucket a gain, the
log of its smoothed target share over its share in the documents (in thousandths,
floors down); a document's weight is the sum of its features' gains. Its score
adds Gumbel noise drawn from a hash of seed and doc_id, and the highest scores
are drawn: resampling without replacement, in proportion to the weights.

One pass over the texts writes each document's buckets and the tasks' bucket
counts; the second reads the buckets only. The driver sees ``buckets`` counts
and one count per partition. Ranks are places in a range-partitioned order with
the partitions' counts added, so no task holds more than its range.

Defined results: null and empty texts have no features and weight 0; a null
doc_id draws the noise of an empty id and comes last among equal scores; the
number drawn is rounded down; rows equal in score and doc_id are ranked by
weight, then features, both ascending (repeated rows have equal noise, each its
own rank); an empty target leaves its smoothing only; empty documents give no
rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import text as tx
from .graph import materialize

#: Words are digits, letters and all that is not ASCII; A-Z become a-z and every other byte a space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@dataclass(frozen=True)
class Setting:
    longest: int = 1         # words of an n-gram, at most
    buckets: int = 10_000
    seed: int = 2024
    percent: int = 10        # of the eligible documents
    least_words: int = 20    # of an eligible document


def collapse(text: str | None) -> bytes:
    """The words of a text, lowered, with one space between two."""
    return b" ".join((text or "").encode().translate(_TABLE).split())


def scanner(n: int):
    """Spans of n words of a collapsed text: tried at every place, they begin and end at word boundaries."""
    import regex
    gram = regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (n - 1))
    return lambda text: (m.group() for m in gram.finditer(text, overlapped=True))


def _profile(setting: Setting, unit: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.binary()),
                        ("bucket", pa.int32()), ("count", pa.int64())])

    def run(batches):
        scan = [scanner(n) for n in range(1, setting.longest + 1)]
        total = np.zeros(setting.buckets, np.int64)
        for step in tx.steps(batches, "text"):
            n_words, packed = [], []
            for text in step.column("text").to_pylist():
                text = collapse(text)
                found = [np.fromiter(map(crc32, s(text)), np.uint32) % np.uint32(setting.buckets) for s in scan]
                n_words.append(len(found[0]))
                every = np.concatenate(found)
                total += np.bincount(every, minlength=setting.buckets)
                packed.append(every.astype(unit).tobytes())
            n = step.num_rows
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(packed, pa.binary()),
                                              pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], schema=schema)
        some = np.flatnonzero(total)
        n = len(some)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                                          pa.array(some, pa.int32()), pa.array(total[some])], schema=schema)
    return run


def profile(texts: DataFrame, setting: Setting, unit: str) -> DataFrame:
    """``texts(doc_id, text)`` to rows of documents (bucket is null) and of the tasks' bucket counts."""
    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _profile(setting, unit), "doc_id long, n_words long, buckets binary, bucket int, count long")


def _counts(profiled: DataFrame, buckets: int) -> list[int]:
    out = [0] * buckets
    for r in profiled.filter("bucket is not null").groupBy("bucket").agg(F.sum("count").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(documents: list[int], target: list[int]) -> list[int]:
    """Per bucket the floor of 1000 ln of the smoothed shares' quotient (one is added to each bucket)."""
    k = len(documents)
    source, aim = float(sum(documents) + k), float(sum(target) + k)
    return [floor(1000 * log((float(t + 1) * source) / (float(s + 1) * aim))) for s, t in zip(documents, target)]


def weigh(docs: DataFrame, target: DataFrame, setting: Setting = Setting()) -> DataFrame:
    """Per row doc_id, n_words, n_features, weight and score."""
    spark = docs.sparkSession
    unit = "<u2" if setting.buckets <= 1 << 16 else "<u4"
    profiled = materialize(spark, profile(docs, setting, unit), "importance-profile")
    aim = profile(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), setting, unit)
    table = spark.sparkContext.broadcast(np.array(
        gains(_counts(profiled, setting.buckets), _counts(aim, setting.buckets)), np.int64))

    def run(batches):
        for batch in batches:
            found = [np.frombuffer(b, unit) for b in batch.column("buckets").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([int(table.value[f].sum()) for f in found], pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"])
    rows = profiled.filter("bucket is null").select("doc_id", "n_words", "buckets").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{setting.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
                                  256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + noise)


def _number(batches):
    """Places of the rows of one partition, and the partition's number."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)),
                                          pa.array(np.arange(at, at + n))], names=[*batch.schema.names, "part", "nth"])
        at += n


def resample(docs: DataFrame, target: DataFrame, setting: Setting = Setting()) -> DataFrame:
    """``weigh`` with rank: 1, 2, 3 ... for the drawn documents, null for the others."""
    spark = docs.sparkSession
    weighed = materialize(spark, weigh(docs, target, setting), "importance-scores")
    able = F.col("n_words") >= setting.least_words
    # the last key parts repeated rows, which are interchangeable
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features"), F.col("copy")]
    fields = "doc_id long, n_words long, n_features long, weight long, score long"
    placed = materialize(
        spark, weighed.filter(able).withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order)
        .sortWithinPartitions(*order).drop("copy").mapInArrow(_number, fields + ", part int, nth long"), "importance-order")
    before, n = [], 0
    for r in placed.groupBy("part").count().orderBy("part").collect():  # one row per partition
        before.append((r.part, n))
        n += r["count"]
    drawn = setting.percent * n // 100
    starts = spark.createDataFrame(before, "part int, before long")
    place = F.col("before") + F.col("nth") + 1
    ranked = placed.join(F.broadcast(starts), "part").withColumn("rank", F.when(place <= drawn, place))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).union(
        weighed.filter(~able).withColumn("rank", F.lit(None).cast("long")).select(*columns))
