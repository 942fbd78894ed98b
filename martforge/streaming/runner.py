"""Running a streaming query to completion over what has landed (availableNow)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_landed(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True)
    return r.load(path)


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> str:
    """Process everything available, commit to parquet, stop."""
    q = (stream.writeStream.format("parquet").outputMode(mode)
         .option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def run_foreach_batch(stream: DataFrame, fn, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
