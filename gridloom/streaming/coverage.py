"""Tile coverage as pixels arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import assign


def coverage_stream(pixels: DataFrame, ws: int, stride: int, min_percent: float, *, time: str = "ts", delay: str = "10 minutes", span: str = "1 hour") -> DataFrame:
    """Coverage of each window by span of time, from a stream of ``(raster_id, r, c, v, time)``; late pixels are
    counted until the watermark has passed."""
    p = assign(pixels.withWatermark(time, delay), ws, stride)
    s = p.groupBy(F.window(time, span).alias("span"), "raster_id", "wr", "wc").agg(F.count("*").alias("total_pix"), F.sum((F.col("v") != 0).cast("long")).alias("nonzero"))
    return s.where(F.col("nonzero") * 100 >= F.col("total_pix") * F.lit(min_percent * 100)).select(F.col("span.start").alias("start"), "raster_id", "wr", "wc", "total_pix", "nonzero")
