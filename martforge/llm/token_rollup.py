"""Token counts kept by deltas: signed rows add up to totals by source, language and tokenizer version.

Every batch of inserts, deletes and revised counts becomes a few signed rows
per group, committed under its id: a folder of the writer's own holds the rows,
and a marker that names that folder, put in place last by a rename that fails if
the id has one, makes it count. Committing an id again changes nothing, also for
a writer that was at it at the same time. Totals are sums over the committed
batches.

Defined results: null texts have no tokens; null sources and languages are
groups of their own; groups whose documents are all gone are not listed; an
empty batch commits; other columns are ignored.
"""

from __future__ import annotations

import base64
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import text as tx

GROUP = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_bytes long"
#: Versions: file of byte-pair ranks and split pattern (fixed values of the public tokenizers).
TOKENIZERS = {"byte_bpe_50k": "/opt/tokenizers/byte_bpe_50k.tiktoken",
              "byte_bpe_multi_50k": "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"}
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def count(docs: DataFrame, keep: list[str], tokenizers: dict[str, str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with tokenizer, n_tokens and n_bytes, one row per version."""
    new = ["tokenizer", "n_tokens", "n_bytes"]
    keep = [c for c in keep if c not in new]
    ranks = docs.sparkSession.sparkContext.broadcast({k: load_ranks(p) for k, p in (tokenizers or TOKENIZERS).items()})
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))

    def run(batches):
        import tiktoken
        codecs = {k: tiktoken.Encoding(k, pat_str=PATTERN, mergeable_ranks=r, special_tokens={})
                  for k, r in ranks.value.items()}
        for step in tx.steps(batches, "_text"):
            texts = [t or "" for t in step.column("_text").to_pylist()]
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            for name, codec in codecs.items():
                n = pa.array([len(codec.encode_ordinary(t)) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*(step.column(c) for c in keep), pa.array([name] * len(texts)), n, size],
                                                 names=[*keep, *new])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    return rows.mapInArrow(run, f"{fields}, tokenizer string, n_tokens long, n_bytes long")


def signed(counted: DataFrame, sign: int) -> DataFrame:
    """Deltas that insert (1) or delete (-1) counted documents."""
    return counted.groupBy(*GROUP).agg((F.count("*") * sign).alias("n_docs"), (F.sum("n_tokens") * sign).alias("n_tokens"),
                                       (F.sum("n_bytes") * sign).alias("n_bytes"))


class Rollup:
    """Totals in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _marker(self, batch_id: str):
        return self._hadoop(f"{self.path}/commits/{batch_id}")

    def commit(self, batch_id: str, *deltas: DataFrame) -> bool:
        """Add the batch's deltas; False if it was committed before."""
        if self._fs.exists(self._marker(batch_id)):
            return False
        rows = self.spark.createDataFrame([], SCHEMA)
        for d in deltas:
            rows = rows.unionByName(d)
        folder = f"{batch_id}-{uuid.uuid4().hex}"
        rows.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_bytes"))).write.parquet(
            f"{self.path}/batches/{folder}")
        return self._publish(batch_id, folder)

    def _publish(self, batch_id: str, folder: str) -> bool:
        """Put the marker in place: the one step that makes a batch visible; False for the second of two writers."""
        jvm = self.spark.sparkContext._jvm
        self._fs.mkdirs(self._hadoop(f"{self.path}/commits"))
        draft = self._hadoop(f"{self.path}/drafts/{folder}")
        out = self._fs.create(draft, False)
        out.write(bytearray(folder, "utf-8"))
        out.close()
        options = jvm.org.apache.hadoop.fs.Options
        none = self.spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 0)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            files.rename(draft, self._marker(batch_id), none)  # does not replace
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            return False
        return True

    def committed(self) -> dict[str, str]:
        """The folder of each committed batch."""
        folder = self._hadoop(f"{self.path}/commits")
        if not self._fs.exists(folder):
            return {}
        rows = self.spark.read.text(f"{self.path}/commits", wholetext=True).select(
            "value", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("id")).collect()
        return {r.id: r.value for r in sorted(rows, key=lambda r: r.id)}

    def totals(self) -> DataFrame:
        paths = [f"{self.path}/batches/{b}" for b in self.committed().values()]
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_bytes"))).filter(
            "n_docs <> 0 or n_tokens <> 0 or n_bytes <> 0")
