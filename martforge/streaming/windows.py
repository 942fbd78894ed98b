"""Tumbling-window totals with a lateness bound (T02, T03), batch and streaming.

The warehouse time columns are ``timestamp_ntz``; watermarks need an
instant, so the stream casts to TIMESTAMP (session zone UTC) before
``withWatermark`` and casts window bounds back to ``timestamp_ntz`` on
output. Rows older than the watermark (latest event time minus the delay)
are dropped as late; in append mode a window is emitted once the watermark
passes its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed polling width and freshness bound of the feeds.
WINDOW = "2 hours"
DELAY = "24 hours"


def _totals(grouped, value_col: str):
    return grouped.agg(
        F.count(F.lit(1)).cast("bigint").alias("event_count"),
        F.sum(F.col(value_col).cast("decimal(18,2)")).cast("double").alias("total_value"),
    )


def tumbling(df: DataFrame, ts: str, width: str = WINDOW, value_col: str = "value") -> DataFrame:
    """Batch form: every window, no lateness cut."""
    g = _totals(df.groupBy(F.window(ts, width).alias("w")), value_col)
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    "event_count", "total_value")


def stream_tumbling(stream: DataFrame, ts: str, width: str = WINDOW, delay: str = DELAY,
                    value_col: str = "value") -> DataFrame:
    """Streaming form (append mode): windows closed under the watermark."""
    s = stream.withColumn("_ets", F.col(ts).cast("timestamp")).withWatermark("_ets", delay)
    g = _totals(s.groupBy(F.window("_ets", width).alias("w")), value_col)
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    "event_count", "total_value")


def stream_dedup(stream: DataFrame, keys, ts: str, delay: str = DELAY) -> DataFrame:
    """Drop redelivered events: first row per key within the watermark delay.

    State per key is kept only until the watermark passes, so state size is
    bounded by the keys seen within the delay, not by the whole stream.
    """
    cols = stream.columns
    s = stream.withColumn("_ets", F.col(ts).cast("timestamp")).withWatermark("_ets", delay)
    return s.dropDuplicatesWithinWatermark(list(keys)).select(*cols)
