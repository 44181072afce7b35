"""Results as tables and files."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .jpeg import jpeg_grey
from .tiff import TILE, packed_tile, tiff_file, write_tiff


def manifest(df: DataFrame, path: str, *by: str) -> None:
    """Parquet, partitioned by the columns that readers filter on (window size, raster)."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def stage_csv(df: DataFrame, path: str) -> None:
    """A stage's manifest for inspection; maps and arrays as JSON are left to the caller."""
    df.write.mode("overwrite").option("header", True).csv(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def document(df: DataFrame, path: str) -> None:
    """One text column as text files, such as a whole annotation document."""
    df.write.mode("overwrite").text(path)


def tile_images(pixels: DataFrame, tiles: DataFrame, window: int) -> DataFrame:
    """``(name, content)``: a GeoTIFF for each tile. ``tiles (name, raster_id, wr, wc, x_min, y_max, res_x, res_y)``,
    ``pixels (raster_id, band, r, c, v)``; cells without a pixel are 0, values are cut to bytes. Tiles are bounded by
    their window, so a group is one tile's pixels."""
    t = tiles.select("name", "raster_id", "wr", "wc", "x_min", "y_max", "res_x", "res_y")
    br, bc = f"r div {window}", f"c div {window}"
    # A window of the lattice's size touches at most four cells of that size: an equi-join on these.
    at = t.selectExpr("*", f"explode(array_distinct(array(wr div {window}, (wr + {window - 1}) div {window}))) AS br").selectExpr("*", f"explode(array_distinct(array(wc div {window}, (wc + {window - 1}) div {window}))) AS bc")
    p = pixels.selectExpr("raster_id", "band", "r", "c", "v", f"{br} AS br", f"{bc} AS bc")
    met = p.join(at, ["raster_id", "br", "bc"]).where(f"r >= wr AND r < wr + {window} AND c >= wc AND c < wc + {window}")

    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        a = np.zeros((int(pdf["band"].max()), window, window), dtype=np.uint8)
        a[pdf["band"] - 1, pdf["r"] - first["wr"], pdf["c"] - first["wc"]] = pdf["v"].clip(0, 255)
        return pd.DataFrame({"name": [first["name"]], "content": [write_tiff(a, first["x_min"], first["y_max"], (first["res_x"], first["res_y"]), 0)]})

    return met.groupBy("name").applyInPandas(encode, "name string, content binary")


def tile_labels(labels: DataFrame, tiles: DataFrame, window: int) -> DataFrame:
    """``(name, content)``: a one-band GeoTIFF of class numbers for each tile; ``labels (raster_id, r, c, value)``. Cells
    without a label are 0, and tiles without any are images of zeros."""
    named = tiles.select("name", "raster_id", "wr", "wc", "x_min", "y_max", "res_x", "res_y")
    corner = named.select("raster_id", F.lit(1).alias("band"), F.col("wr").alias("r"), F.col("wc").alias("c"), F.lit(0).alias("v"))
    return tile_images(labels.select("raster_id", F.lit(1).alias("band"), "r", "c", F.col("value").alias("v")).union(corner.distinct()).groupBy("raster_id", "band", "r", "c").agg(F.max("v").alias("v")), tiles, window)


def frame_images(cells: DataFrame, width: int, height: int, name: str = "img") -> DataFrame:
    """``(transect, name, content)``: a JPEG frame for each window of :func:`sonogram.window_cells`, by its chunk and start;
    values are cut to bytes and what lies below ``height`` is left out. Windows are bounded, so a group is one of them."""

    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        p = pdf[(pdf["r"] < height) & (pdf["c"] < width)]
        a = np.zeros((height, width), dtype=np.uint8)
        a[p["r"], p["c"]] = p["v"].clip(0, 255)
        return pd.DataFrame({"transect": [first["transect"]], "name": [f"{name}_{int(first['chunk']):05d}_{int(first['start']):05d}.jpg"], "content": [jpeg_grey(a)]})

    kind = dict(cells.dtypes)["transect"]
    return cells.groupBy("transect", "chunk", "start").applyInPandas(encode, f"transect {kind}, name string, content binary")


def colour_table(colours: dict[int, str]) -> list[tuple[int, int, int, int]]:
    """(class, red, green, blue) rows of a class raster's palette."""
    return [(k, *(int(h.lstrip("#")[i : i + 2], 16) for i in (0, 2, 4))) for k, h in sorted(colours.items())]


def raster_files(pixels: DataFrame, meta: DataFrame, *, colours: dict[int, str] | None = None, nodata: float | None = 0, levels: int = 0, epsg: int | None = None) -> DataFrame:
    """``(name, content)``: a tiled GeoTIFF of bytes for each raster, such as a class map with its palette or a mosaic
    with overviews by nearest neighbour, factors 2 to ``2 ** levels``.

    ``pixels (raster_id, r, c, v)``, ``meta (raster_id, x0, y0, res_x, res_y, width, height)``. Tiles are packed in
    parallel; a file's packed tiles meet in the task that writes it, as a file asks for."""
    palette = {k: (r, g, b) for k, r, g, b in colour_table(colours)} if colours else None
    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")
    f = F.expr("shiftleft(1L, level)")
    half = F.expr("shiftright(shiftleft(1L, level), 1)")
    p = pixels.select("raster_id", "r", "c", "v", level).withColumn("f", f).where((F.col("r") % F.col("f") == half) & (F.col("c") % F.col("f") == half))
    p = p.select("raster_id", "level", F.expr("r div f").alias("r"), F.expr("c div f").alias("c"), "v")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        tr, tc = int(first["r"]) // TILE, int(first["c"]) // TILE
        a = np.zeros((1, TILE, TILE), dtype=np.uint8)
        a[0, pdf["r"] - tr * TILE, pdf["c"] - tc * TILE] = pdf["v"].clip(0, 255)
        return pd.DataFrame({"raster_id": [first["raster_id"]], "level": [first["level"]], "tr": [tr], "tc": [tc], "raw": [packed_tile(a)]})

    at = F.expr(f"r div {TILE}").alias("tr"), F.expr(f"c div {TILE}").alias("tc")
    tiles = p.groupBy("raster_id", "level", *at).applyInPandas(pack, "raster_id string, level int, tr int, tc int, raw binary")
    size = meta.select("raster_id", "x0", "y0", "res_x", "res_y", F.col("width").cast("long").alias("width"), F.col("height").cast("long").alias("height"))

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        m = pdf.iloc[0]
        blank, images = packed_tile(np.zeros((1, 1, 1), dtype=np.uint8)), []
        there = {(k, r, c): raw for k, r, c, raw in zip(pdf["level"], pdf["tr"], pdf["tc"], pdf["raw"])}
        for k in range(levels + 1):
            h, w = (max(1, -(-(int(x) - (1 << k >> 1)) // (1 << k))) for x in (m["height"], m["width"]))
            images.append((h, w, [there.get((k, r, c), blank) for r in range(-(-h // TILE)) for c in range(-(-w // TILE))]))
        content = tiff_file(images, 1, np.uint8, m["x0"], m["y0"], (m["res_x"], m["res_y"]), nodata, epsg=epsg, palette=palette)
        return pd.DataFrame({"name": [m["raster_id"]], "content": [content]})

    return size.join(tiles, "raster_id", "left").groupBy("raster_id").applyInPandas(write, "name string, content binary")
