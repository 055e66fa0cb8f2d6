"""An addition of ours: tumbling windows with a watermark, for streams and tables alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events and the sum of their values by type and window."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
