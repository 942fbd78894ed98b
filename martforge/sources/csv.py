"""CSV scan and sink with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_COL = "_corrupt_record"


def scan_csv(spark: SparkSession, path: str, schema: StructType, mode: str = "FAILFAST",
             multi_line: bool = False) -> DataFrame:
    """Header CSV with a declared schema (never inferred).

    FAILFAST raises on a malformed row; PERMISSIVE keeps the row with nulls and
    the raw text in ``_corrupt_record`` for quarantine. Quotes inside a quoted
    field are doubled. ``multi_line`` allows line breaks inside quoted fields;
    each file is then read by one task, so it is off for large files.
    """
    reader = spark.read.options(header=True, mode=mode, escape='"', multiLine=multi_line)
    if mode.upper() == "PERMISSIVE":
        schema = StructType(list(schema.fields) + [StructField(CORRUPT_COL, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return reader.schema(schema).csv(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, corrupt rows) of a PERMISSIVE scan."""
    bad = F.col(CORRUPT_COL).isNotNull()
    return df.filter(~bad).drop(CORRUPT_COL), df.filter(bad)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).options(header=True, escape='"').csv(path)
    return path


def source_row_count(df: DataFrame) -> DataFrame:
    """Records of a parsed scan (of a ``multi_line`` one, quoted line breaks count once)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"))
