"""Windows over streams; the same functions take a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly(events: DataFrame, late: str | None = None) -> DataFrame:
    """Number and mean of the values per hour and event type; ``late`` sets a watermark on a stream."""
    rows = events.withWatermark("ts", late) if late else events
    return rows.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean")
    ).select(F.col("w.start").alias("begins"), "event_type", "n", "mean")
