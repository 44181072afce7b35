"""The whole jobs: tiling images, tiling images with labels, mapping from predictions, sliding over series."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import coco, coverage, labels, polygons, regions, sonogram, spatial, tensors, warp, windows
from ..operators.state import saved


def tile_mosaic(pixels: DataFrame, meta: DataFrame, window: int, stride: int, min_percent: float = 0.5) -> DataFrame:
    """Manifest of kept tiles: ``(mosaic, window_size, x_min, y_min, x_max, y_max, total_pix, nonzero_prop)``."""
    kept = coverage.tile_coverage(pixels.where("band = 1") if "band" in pixels.columns else pixels, window, stride, min_percent)
    m = kept.join(meta, "raster_id")
    x, y = F.col("x0") + F.col("wc") * F.col("res_x"), F.col("y0") - F.col("wr") * F.col("res_y")
    return m.select(F.col("raster_id").alias("mosaic"), F.lit(window).alias("window_size"), x.alias("x_min"), (y - window * F.col("res_y")).alias("y_min"), (x + window * F.col("res_x")).alias("x_max"), y.alias("y_max"), "total_pix", "nonzero_prop")


def tile_with_labels(manifest: DataFrame, features: DataFrame, ids: dict[str, int], min_percent: float = 0.5, allow_empty: bool = False) -> DataFrame:
    """The manifest with what became of each tile and its class shares. Labels are summed before anything is joined
    to pixels, and tiles that they reject go. ``features`` are boxes, or polygons if they have ``rings``."""
    tiles = manifest.withColumn("win_id", F.xxhash64("mosaic", "window_size", "x_min", "y_min"))
    size = tiles.agg(F.max(F.col("x_max") - F.col("x_min")).alias("w"), F.max(F.col("y_max") - F.col("y_min")).alias("h")).first()
    if size["w"] is None:
        return tiles.select("*", F.lit(None).cast("string").alias("outcome"), F.lit(None).cast("map<string,double>").alias("class_frac"))
    clip = polygons.clip_areas if "rings" in features.columns else labels.clip_areas
    clipped = clip(tiles.select("win_id", "x_min", "y_min", "x_max", "y_max"), features, max(size["w"], size["h"]))
    outcome = labels.accept(tiles.select("win_id"), labels.window_areas(clipped, ids), size["w"] * size["h"], min_percent, allow_empty)
    shares = labels.fraction_map(labels.class_fractions(clipped))
    return tiles.join(outcome.where("outcome <> 'reject'").select("win_id", "outcome"), "win_id").join(shares, "win_id", "left")


def predict(tiles: DataFrame, model: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Probabilities ``t`` of each tile by the user's function, called with whole batches of rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(t=model(b))

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in tiles.schema.fields), "t array<double>"])
    return tiles.mapInPandas(run, schema)


def class_raster(predicted: DataFrame, classes: int, shape: tuple[int, int], window: tuple[float, float], min_size: int) -> tuple[DataFrame, DataFrame]:
    """The class raster ``(r, c, cls)`` of overlapping predicted tiles and its place ``(left, top)``, one row: windows side
    by side over the extent, mean of the tiles, likeliest class, clean-up."""
    grid = windows.extent_windows(predicted, window, window[0])
    mean = tensors.overlap_mean(grid, predicted, classes, shape, max(window))
    best = tensors.argmax(mean, ("win_id", "row", "col")).join(grid, "win_id")
    rx, ry = window[0] / shape[1], window[1] / shape[0]
    top = grid.agg(F.max("y_max").alias("top"), F.min("x_min").alias("left"))
    raster = best.crossJoin(F.broadcast(top)).select(F.bround((F.col("top") - F.col("y_max")) / ry + F.col("row")).cast("long").alias("r"), F.bround((F.col("x_min") - F.col("left")) / rx + F.col("col")).cast("long").alias("c"), "cls")  # one row
    return regions.clean_labels(raster, min_size) if min_size > 1 else raster, top


def vector_map(raster: DataFrame, names: dict[int, str], *, pixel: tuple[float, float] = (1.0, 1.0), merge_below: float = 0.0, smooth: float | None = None, touch: float = 0.0, left: float = 0.0, top: float = 0.0) -> DataFrame:
    """``(patch_id, substrate, name, area_m, rings)`` of a class raster, without class 0: 4-connected patches, small ones
    merged into neighbours (those within ``touch`` of them too), outlines and holes in map units.

    With ``smooth``, borders are thinned by that tolerance, the same on both sides, and a patch of several parts becomes a
    row for each; areas stay those of the pixels."""
    rx, ry = pixel
    labelled = saved(regions.components(raster, connectivity=4, background=None), "labelled")
    patches, moved = regions.merged(labelled, merge_below, pixel_area=rx * ry, reach=touch / min(rx, ry))
    whole = labelled.select("r", "c", "comp").join(moved, "comp").select("r", "c", F.col("root").alias("comp"))
    lines = regions.simplify(regions.rings(whole.join(patches.where("cls <> 0").select("comp"), "comp", "left_semi")), (smooth or 0.0) / min(rx, ry) + 1e-9)
    at = F.transform("ring", lambda p: F.array(F.lit(left) + p[0] * rx, F.lit(top) - p[1] * ry))
    rings = lines.select("comp", "part", "hole", at.alias("ring"))
    lookup = F.create_map(*(F.lit(x) for kv in names.items() for x in kv)) if names else F.create_map().cast("map<int,string>")
    name = F.coalesce(F.try_element_at(lookup, F.col("cls")), F.col("cls").cast("string"))
    # A patch's rings, outlines first; one row a patch as a map asks for.
    by_patch = rings.groupBy("comp").agg(F.transform(F.sort_array(F.collect_list(F.struct("part", "ring"))), lambda x: x["ring"]).alias("rings"), F.count_if(~F.col("hole")).alias("outlines"))
    out = patches.where("cls <> 0").join(by_patch, "comp")
    if smooth is not None:
        one = F.when(F.col("outlines") > 1, F.slice("rings", 1, F.col("outlines").cast("int")))
        holes = F.slice("rings", F.col("outlines").cast("int") + 1, F.size("rings"))
        parts = F.transform(one, lambda r: F.concat(F.array(r), F.filter(holes, lambda h: polygons.inside(h[0], r))))
        out = out.withColumn("rings", F.explode(F.coalesce(parts, F.array("rings"))))
    return out.select(F.col("comp").alias("patch_id"), F.col("cls").alias("substrate"), name.alias("name"), F.col("area").alias("area_m"), "rings")


def map_classes(predicted: DataFrame, classes: int, shape: tuple[int, int], window: tuple[float, float], min_size: int, names: dict[int, str], *, merge_below: float = 0.0, smooth: float | None = None) -> tuple[DataFrame, DataFrame]:
    """From overlapping predicted tiles to a class raster and its patches, see :func:`class_raster` and
    :func:`vector_map`."""
    raster, place = class_raster(predicted, classes, shape, window, min_size)
    raster, at = saved(raster, "classes"), place.first()
    pixel = (window[0] / shape[1], window[1] / shape[0])
    return raster, vector_map(raster, names, pixel=pixel, merge_below=merge_below, smooth=smooth, left=at["left"] or 0.0, top=at["top"] or 0.0)


def map_mosaics(pixels: DataFrame, meta: DataFrame, model: Callable[[pd.DataFrame], pd.Series], classes: int, shape: tuple[int, int], names: dict[int, str], *, window: int, stride: int, source: int, target: int, cell: float, min_percent: float = 0.5, min_patch: float = 3.0, smooth: float | None = None) -> dict[str, DataFrame]:
    """The whole job over rasters of one coordinate system: project, tile, predict, average, map.

    Returns the tables ``tiles`` (the manifest), ``raster`` and ``patches``. ``window`` and ``stride`` are in cells;
    ``min_patch`` is an area, a quarter of which also bounds what clean-up removes. Predictions made elsewhere join the
    manifest by :func:`pairing.with_tensors` instead."""
    if source != target:
        grid = saved(warp.target_grid(meta, source, target, cell, aligned=True), "grid")
        pixels = saved(warp.warp(pixels, meta, grid, source, target, whole=True), "projected")
        meta = grid
    manifest = saved(tile_mosaic(pixels, meta, window, stride, min_percent), "manifest")
    side = (window * cell, window * cell)
    predicted = saved(predict(manifest, model), "predicted")
    raster, patches = map_classes(predicted, classes, shape, side, max(1, int(min_patch / 4 / (side[0] / shape[1] * side[1] / shape[0]))), names, merge_below=min_patch, smooth=smooth)
    return {"tiles": manifest, "raster": raster, "patches": patches}


def annotate(labelled: DataFrame, image_of: Column, names: dict[int, str]) -> DataFrame:
    """COCO annotations of labelled masks, with outlines."""
    boxes = coco.boxes(labelled).withColumn("image_id", image_of).where(F.col("cls").isin(*[k for k in names if k]))
    return coco.annotations(boxes).join(coco.segmentation(labelled), "comp").drop("comp")


def slide(pings: DataFrame, width: int, stride: int, value: Column, name: str) -> DataFrame:
    """Windows over each transect's chunks, named as frames."""
    w = sonogram.sliding(pings, width, stride, value)
    return w.withColumn("frame", F.concat(F.lit(name), F.lit("_"), scalar.frame_number(F.col("start")), F.lit(".jpg")))


def prune(tiles: DataFrame, pixels: DataFrame, cell: int, reach: int) -> DataFrame:
    """Windows that touch the buffered footprint of the data."""
    return spatial.in_footprint(tiles, spatial.buffered(spatial.footprint_cells(pixels, cell), reach), float(cell))
