"""Hit rate over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hit_rate_windows(log: DataFrame, width: str = "1 hour", lateness: str | None = None) -> DataFrame:
    """Hits, misses and hit rate per tumbling window of ``ts``, for tables and streams.

    A stream must say its ``lateness``: rows later than that behind the newest one are dropped.
    """
    if log.isStreaming:
        if lateness is None:
            raise ValueError("a stream needs a lateness")
        log = log.withWatermark("ts", lateness)
    hits, total = F.count_if(F.col("hit")), F.count(F.lit(1))
    return (
        log.groupBy(F.window("ts", width).alias("w"))
        .agg(hits.alias("hit_count"), (total - hits).alias("miss_count"), F.round(hits / total, 4).alias("hit_rate"))
        .select(F.col("w.start").alias("window_start"), "hit_count", "miss_count", "hit_rate")
    )
