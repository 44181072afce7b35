"""Rasters in another coordinate system: the grid that takes them, and their values on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import crs, scalar

#: Points on each side of a raster whose places give the new bounds; sides may bend.
SIDE = 21
#: Rows of a grid that one task makes.
ROWS = 64


def target_grid(meta: DataFrame, source: int, target: int, cell: float | None = None, *, max_pixels: float = 250_000_000, aligned: bool = False) -> DataFrame:
    """``(raster_id, x0, y0, res_x, res_y, width, height)`` of the grids that take the rasters of ``meta``.

    Bounds are those of the sides as they come to lie. Without ``cell``, a pixel is square and the diagonal has as many as
    before. With it, the number of cells is the extent over the cell, rounded half to even and held to ``max_pixels``,
    and cells are stretched to fit; ``aligned``: cells keep their size and the bounds move out to multiples of it."""
    right, bottom = F.col("x0") + F.col("width") * F.col("res_x"), F.col("y0") - F.col("height") * F.col("res_y")
    m = meta.select("raster_id", "x0", "y0", "width", "height", right.alias("x1"), bottom.alias("y1"))
    t = F.explode(F.sequence(F.lit(0), F.lit(SIDE))).alias("t")
    part = F.col("t") / F.lit(float(SIDE))
    x, y = F.col("x0") + part * (F.col("x1") - F.col("x0")), F.col("y1") + part * (F.col("y0") - F.col("y1"))
    side = F.explode(F.array(*(F.struct(a.alias("x"), b.alias("y")) for a, b in ((x, F.col("y0")), (x, F.col("y1")), (F.col("x0"), y), (F.col("x1"), y))))).alias("p")
    points = m.select("*", t).select("raster_id", "width", "height", "x0", "y0", "x1", "y1", side)
    px, py = crs.reproject(F.col("p.x"), F.col("p.y"), source, target)
    b = points.select("raster_id", "width", "height", "x0", "y0", "x1", "y1", px.alias("px"), py.alias("py"))
    b = b.groupBy("raster_id", "width", "height", "x0", "y0", "x1", "y1").agg(F.min("px").alias("left"), F.max("px").alias("right"), F.min("py").alias("bottom"), F.max("py").alias("top"))
    wide, high = F.col("right") - F.col("left"), F.col("top") - F.col("bottom")
    if cell is None:
        (ax, ay), (bx, by) = crs.reproject(F.col("x0"), F.col("y0"), source, target), crs.reproject(F.col("x1"), F.col("y1"), source, target)
        side_ = F.sqrt((bx - ax) ** 2 + (by - ay) ** 2) / F.sqrt((F.col("width") ** 2 + F.col("height") ** 2).cast("double"))
        b = b.withColumn("res", side_).withColumn("w", F.greatest(F.lit(1), scalar.half_even(wide / F.col("res")))).withColumn("h", F.greatest(F.lit(1), scalar.half_even(high / F.col("res"))))
        return b.select("raster_id", F.col("left").alias("x0"), F.col("top").alias("y0"), F.col("res").alias("res_x"), F.col("res").alias("res_y"), F.col("w").alias("width"), F.col("h").alias("height"))
    size = F.lit(float(cell))
    if aligned:
        b = b.withColumn("left", F.floor(F.col("left") / size) * size).withColumn("right", F.ceil(F.col("right") / size) * size).withColumn("bottom", F.floor(F.col("bottom") / size) * size).withColumn("top", F.ceil(F.col("top") / size) * size)
        b = b.withColumn("w", scalar.half_even(wide / size)).withColumn("h", scalar.half_even(high / size))
    else:
        b = b.withColumn("s", scalar.out_shape(wide, high, size, F.lit(float(max_pixels)))).withColumn("w", F.col("s.w")).withColumn("h", F.col("s.h"))
    return b.select("raster_id", F.col("left").alias("x0"), F.col("top").alias("y0"), (wide / F.col("w")).alias("res_x"), (high / F.col("h")).alias("res_y"), F.col("w").alias("width"), F.col("h").alias("height"))


def _cells(grid: DataFrame) -> DataFrame:
    """A row for each cell of the grids, made in parallel by stretches of rows."""
    g = grid.select("raster_id", *(F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "res_x", "res_y", "width", "height")))
    g = g.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("t_height") - 1, F.lit(ROWS).cast("long")))).repartition("raster_id", "first")
    g = g.withColumn("r", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + ROWS, F.col("t_height")) - 1)))
    return g.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("t_width") - 1)))


def warp(pixels: DataFrame, meta: DataFrame, grid: DataFrame, source: int, target: int, *, method: str = "bilinear", nodata: float | None = None, whole: bool = False) -> DataFrame:
    """``(raster_id, band, r, c, v)``: the values of ``pixels`` on the grids of the same rasters.

    A cell's centre is looked up in the source. ``nearest`` takes the pixel it lies in. ``bilinear`` weighs the four
    pixels whose centres surround it; pixels that are missing, null, NaN or no data are left out and the others weigh the
    more. Cells whose centre lies outside the source, or that find no value, are not returned. ``whole``: values are
    rounded, halves up. Pixels and cells meet by an equi-join on the pixel's place."""
    cells = _cells(grid).join(meta.select("raster_id", "x0", "y0", "res_x", "res_y", "width", "height"), "raster_id")
    x, y = F.col("t_x0") + (F.col("c") + 0.5) * F.col("t_res_x"), F.col("t_y0") - (F.col("r") + 0.5) * F.col("t_res_y")
    cells = cells.select("raster_id", "r", "c", "width", "height", "x0", "y0", "res_x", "res_y", x.alias("x"), y.alias("y"))
    sx, sy = crs.reproject(F.col("x"), F.col("y"), target, source)
    cells = cells.withColumn("u", (sx - F.col("x0")) / F.col("res_x")).withColumn("w", (F.col("y0") - sy) / F.col("res_y"))
    cells = cells.where((F.col("u") >= 0) & (F.col("u") < F.col("width")) & (F.col("w") >= 0) & (F.col("w") < F.col("height"))).select("raster_id", "r", "c", "u", "w")
    good = F.col("v").isNotNull() & ~F.isnan(F.col("v").cast("double"))
    good = good & (F.col("v") != F.lit(nodata)) if nodata is not None else good
    p = pixels.where(good).select("raster_id", "band" if "band" in pixels.columns else F.lit(1).alias("band"), F.col("r").cast("long").alias("sr"), F.col("c").cast("long").alias("sc"), F.col("v").cast("double").alias("v"))

    def rounded(v: Column) -> Column:
        return F.floor(v + 0.5).cast("double") if whole else v

    if method == "nearest":
        at = cells.select("raster_id", "r", "c", F.floor("w").alias("sr"), F.floor("u").alias("sc"))
        return at.join(p, ["raster_id", "sr", "sc"]).select("raster_id", "band", "r", "c", rounded(F.col("v")).alias("v"))
    if method != "bilinear":
        raise ValueError(f"no method {method}")
    cells = cells.withColumn("r0", F.floor(F.col("w") - 0.5)).withColumn("c0", F.floor(F.col("u") - 0.5)).withColumn("fr", F.col("w") - 0.5 - F.col("r0")).withColumn("fc", F.col("u") - 0.5 - F.col("c0"))
    near = F.explode(F.array(*(F.struct((F.col("r0") + i).alias("sr"), (F.col("c0") + j).alias("sc"), ((F.col("fr") if i else 1 - F.col("fr")) * (F.col("fc") if j else 1 - F.col("fc"))).alias("weight")) for i in (0, 1) for j in (0, 1)))).alias("s")
    met = cells.select("raster_id", "r", "c", near).select("raster_id", "r", "c", "s.*").where("weight > 0").join(p, ["raster_id", "sr", "sc"])
    out = met.groupBy("raster_id", "band", "r", "c").agg((F.sum(F.col("weight") * F.col("v")) / F.sum("weight")).alias("v"))
    return out.select("raster_id", "band", "r", "c", rounded(F.col("v")).alias("v"))
