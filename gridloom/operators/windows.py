"""Moving windows over rasters, extents and pixel tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def raster_windows(meta: DataFrame, window_size: float, stride: float, *, overshoot: bool = True) -> DataFrame:
    """Windows of every raster in ``meta (raster_id, x0, y0, res_x, res_y, width, height)``.

    Sizes in pixels are rounded half to even; the stride uses the x resolution on both axes and is at least one
    pixel. With ``overshoot`` starts go on to ``width + window``, so some windows lie wholly past the edge; without,
    to ``width``. Columns outer, rows inner.
    """
    m = meta.select("*", F.bround(F.lit(float(window_size)) / F.col("res_x")).cast("long").alias("ws_x"), F.bround(F.lit(float(window_size)) / F.col("res_y")).cast("long").alias("ws_y"), F.greatest(F.lit(1).cast("long"), F.bround(F.lit(float(stride)) / F.col("res_x")).cast("long")).alias("step"))
    more_x, more_y = (F.col("ws_x"), F.col("ws_y")) if overshoot else (F.lit(0), F.lit(0))
    m = m.withColumn("ny", F.expr("size(sequence(cast(0 as long), height + %s, step))" % ("ws_y" if overshoot else "0")))
    m = m.select("*", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("width") + more_x, F.col("step"))).alias("ix", "col"))
    m = m.select("*", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("height") + more_y, F.col("step"))).alias("iy", "row"))
    x, y = F.col("x0") + F.col("col") * F.col("res_x"), F.col("y0") - F.col("row") * F.col("res_y")
    return m.select("raster_id", (F.col("ix") * F.col("ny") + F.col("iy")).cast("long").alias("win_id"), "col", "row", "ws_x", "ws_y", x.alias("x_min"), (y - F.col("ws_y") * F.col("res_y")).alias("y_min"), (x + F.col("ws_x") * F.col("res_x")).alias("x_max"), y.alias("y_max"))


def extent_windows(boxes: DataFrame, window_size: tuple[float, float], stride: float, *, full_only: bool = False) -> DataFrame:
    """Windows from the least corner of all boxes; starts up to the greatest corner, inclusive, or only while the
    whole window fits."""
    if stride <= 0:
        raise ValueError("stride must be above 0")
    wx, wy = window_size
    e = boxes.agg(F.min("x_min").alias("x0"), F.min("y_min").alias("y0"), F.max("x_max").alias("x1"), F.max("y_max").alias("y1")).where("x0 is not null")

    def starts(a: str, b: str, w: float) -> Column:
        last = F.floor((F.col(b) - F.col(a) - F.lit(w if full_only else 0.0)) / stride).cast("long")
        return F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last)).otherwise(F.array().cast("array<bigint>"))

    e = e.select("*", F.size(starts("y0", "y1", wy)).alias("ny"), F.explode(starts("x0", "x1", wx)).alias("ix")).select("*", F.explode(starts("y0", "y1", wy)).alias("iy"))
    x, y = F.col("x0") + F.col("ix") * stride, F.col("y0") + F.col("iy") * stride
    return e.select((F.col("ix") * F.col("ny") + F.col("iy")).cast("long").alias("win_id"), x.alias("x_min"), y.alias("y_min"), (x + wx).alias("x_max"), (y + wy).alias("y_max"))


def covering(place: str, ws: int, stride: int) -> Column:
    """Numbers of the lattice windows (start ``k * stride``) that cover a place: arithmetic, so no range join."""
    first = F.greatest(F.lit(0), F.ceil((F.col(place) - F.lit(ws - 1)) / F.lit(stride))).cast("long")
    last = F.floor(F.col(place) / F.lit(stride)).cast("long")
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def assign(pixels: DataFrame, ws: int, stride: int) -> DataFrame:
    """Each pixel once for each window that covers it, with the window's start ``(wr, wc)``."""
    p = pixels.select("*", F.explode(covering("r", ws, stride)).alias("kr")).select("*", F.explode(covering("c", ws, stride)).alias("kc"))
    return p.withColumn("wr", F.col("kr") * stride).withColumn("wc", F.col("kc") * stride).drop("kr", "kc")


def window_sums(pixels: DataFrame, ws: int, stride: int, sums: dict[str, Column], keys: tuple[str, ...] = ("raster_id",)) -> DataFrame:
    """Sums over each window. Where the stride divides the window, pixels are first summed by stride-sized block and
    only blocks are dealt to windows, which cuts the fan-out by stride squared."""
    named = [F.sum(c).cast("long").alias(n) for n, c in sums.items()]
    if ws % stride == 0 and stride > 1:
        block = pixels.withColumn("r", F.floor(F.col("r") / stride)).withColumn("c", F.floor(F.col("c") / stride))
        block = block.groupBy(*keys, "r", "c").agg(*named)
        dealt = assign(block, ws // stride, 1).withColumn("wr", F.col("wr") * stride).withColumn("wc", F.col("wc") * stride)
        return dealt.groupBy(*keys, "wr", "wc").agg(*(F.sum(n).cast("long").alias(n) for n in sums))
    return assign(pixels, ws, stride).groupBy(*keys, "wr", "wc").agg(*named)
