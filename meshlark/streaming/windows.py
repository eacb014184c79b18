"""Windowed counts, for tables and streams alike. An extension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(df: DataFrame, time: str, width: str, by: list[str], late: str | None = None, slide: str | None = None) -> DataFrame:
    """Rows by window and keys: start, end, the keys, n. late: how long a stream waits for late rows before it emits
    a window; rows without a time are in no window."""
    df = df.withWatermark(time, late) if late else df
    out = df.groupBy(F.window(time, width, slide or width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")
