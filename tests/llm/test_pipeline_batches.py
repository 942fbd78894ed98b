"""The pipeline's stages hand texts to Python in batches of bounded bytes."""

import pyarrow as pa
import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_batches_of_long_texts_are_bounded(spark, name, stage):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        stage(spark, docs.limit(0), SF)
        long = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "repeat('ten bytes ', 1000) as text")
        found = [r.n for r in long.mapInArrow(sizes, "n long").collect()]
        assert sum(found) >= 20_000_000 and max(found) < 5_000_000
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
