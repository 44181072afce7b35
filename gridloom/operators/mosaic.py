"""Mosaics of rasters and their overviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_wins(rasters: DataFrame, order: str = "ord") -> DataFrame:
    """``(r, c, v)`` of rasters laid over each other in ``order``; 0 is transparent, and what nothing covers is 0."""
    return rasters.groupBy("r", "c").agg(F.coalesce(F.max_by(F.when(F.col("v") != 0, F.col("v")), F.when(F.col("v") != 0, F.col(order))), F.lit(0)).alias("v"))


def overviews(pixels: DataFrame, levels: int = 9) -> DataFrame:
    """``(level, r, c, v)``: nearest neighbour by factors 2, 4, … 2**levels."""
    level = F.explode(F.sequence(F.lit(1), F.lit(levels))).alias("level")
    p = pixels.select("r", "c", "v", level).withColumn("f", F.pow(F.lit(2), F.col("level")).cast("long"))
    half = F.floor(F.col("f") / 2)
    at = p.where((F.col("r") % F.col("f") == half) & (F.col("c") % F.col("f") == half))
    return at.select("level", F.floor(F.col("r") / F.col("f")).alias("r"), F.floor(F.col("c") / F.col("f")).alias("c"), "v")
