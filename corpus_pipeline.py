"""Corpus pipeline: documents through five training-data operators, one stage after another."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from martforge.llm import decontaminate, jaccard_join, language_id, secret_scan, sentencepiece
from martforge.session import drop_path, scratch_path, size_text_batches


def _stage(fn):
    """Whole documents pass through every stage: they go to Python in batches of bounded bytes."""
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        size_text_batches(spark)
        return fn(spark, docs, sf_dir)
    return run


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others carry the predicted language."""
    found = language_id.identify(docs, docs.columns, language_id.fit(docs))
    return found.filter("not rejected").withColumn("lang", F.col("lang_pred")).select(*docs.columns)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.one_per_component(docs)


@_stage
def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark)


@_stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; all documents stay."""
    clean = secret_scan.scan(docs, [c for c in docs.columns if c not in ("text", "n_chars")])
    return clean.withColumns({"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}).select(
        *docs.columns)


@_stage
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as piece ids, ready for training."""
    return sentencepiece.encode(docs, ["doc_id", "lang", "source"]).withColumn("n_ids", F.size("ids").cast("long"))


STAGES = [("language_id", identify_language), ("near_duplicates", near_duplicates),
          ("decontamination", remove_benchmark), ("secret_scan", redact_secrets), ("sentencepiece", encode_pieces)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written under the shared folder and reread."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # its rows are all in the next stage's files
            drop_path(spark, before)
        before = path
    return docs
