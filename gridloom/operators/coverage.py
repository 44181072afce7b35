"""Tile coverage: how much of a window holds data, and which windows are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import window_sums


def valid(v: Column, nodata: Column | None = None) -> Column:
    """Not masked, not the raster's no-data value, not NaN."""
    ok = v.isNotNull() & ~F.isnan(v.cast("double"))
    return ok & ~F.coalesce(v == nodata, F.lit(False)) if nodata is not None else ok


def fill(v: Column, nodata: Column | None = None) -> Column:
    """Values that are not valid become 0."""
    return F.when(valid(v, nodata), v).otherwise(F.lit(0))


def tile_coverage(pixels: DataFrame, ws: int, stride: int, min_percent: float, *, keys: tuple[str, ...] = ("raster_id",), nodata: Column | None = None) -> DataFrame:
    """Windows with enough non-zero valid pixels: ``(keys, wr, wc, total_pix, nonzero, nonzero_prop)``.

    The share is of the pixels that exist under the window, so windows over an edge are not held against their
    missing part. The bound is inclusive. Windows without any valid pixel go."""
    v = F.col("v")
    good = valid(v, nodata)
    s = window_sums(pixels, ws, stride, {"total_pix": F.lit(1), "n_valid": good.cast("int"), "nonzero": F.coalesce(good & (v != 0), F.lit(False)).cast("int")}, keys)
    kept = s.where((F.col("n_valid") > 0) & (F.col("nonzero") * 100 >= F.col("total_pix") * F.lit(min_percent * 100)))
    return kept.select(*keys, "wr", "wc", "total_pix", "nonzero", (F.col("nonzero") / F.col("total_pix")).alias("nonzero_prop"))


def reclassify(pixels: DataFrame, mapping: dict[int, int]) -> DataFrame:
    """Values replaced through a map; others stay."""
    m = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    return pixels.withColumn("v", F.coalesce(F.try_element_at(m, F.col("v")), F.col("v")))


def any_valid(pixels: DataFrame, ws: int, stride: int, keys: tuple[str, ...] = ("raster_id",)) -> DataFrame:
    """Windows with at least one non-zero pixel."""
    s = window_sums(pixels, ws, stride, {"nonzero": (F.col("v") != 0).cast("int")}, keys)
    return s.where("nonzero > 0").select(*keys, "wr", "wc")


def accept_counts(tested: DataFrame, accepted: Column) -> DataFrame:
    return tested.agg(F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("rejected"))
