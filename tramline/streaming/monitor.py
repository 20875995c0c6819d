"""Ingest monitoring (O-T8): message counts per topic in tumbling event-time windows.

Event time is the message timestamp. The watermark bounds the window state:
a window is emitted once (append mode) when the watermark passes its end, and
its state is dropped; messages later than the watermark are not counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def topic_counts(messages: DataFrame, window: str = "1 minute", watermark: str = "5 minutes",
                 time_col: str = "timestamp") -> DataFrame:
    """``window_start, window_end, topic, n`` per tumbling window of ``time_col``."""
    timed = messages.withWatermark(time_col, watermark)
    counts = timed.groupBy(F.window(time_col, window).alias("w"), "topic").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "topic", "n")
