"""Class-probability tiles: overlap means, arg-max, masks and resampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spatial import box_join


def cells(tiles: DataFrame, classes: int, height: int, width: int) -> DataFrame:
    """``(…, cls, row, col, p)``: one row for each number of a tile's flat array."""
    others = [c for c in tiles.columns if c != "t"]
    k = F.col("k")
    out = tiles.select(*others, F.posexplode("t").alias("k", "p"))
    return out.select(*others, F.floor(k / (height * width)).cast("int").alias("cls"), F.floor(k % (height * width) / width).cast("int").alias("row"), (k % width).cast("int").alias("col"), F.col("p").cast("double").alias("p"))


def overlap_slices(windows: DataFrame, tiles: DataFrame, shape: tuple[int, int], cell: float) -> DataFrame:
    """For each overlapping pair, the places of the common box in both grids (``shape`` rows, columns each): its
    fractional pixel box, floored and ceiled, held to the grid, cut to the common size from the top left."""
    h, w = shape

    def part(p: str) -> dict[str, Column]:
        rx, ry = (F.col(f"{p}x_max") - F.col(f"{p}x_min")) / w, (F.col(f"{p}y_max") - F.col(f"{p}y_min")) / h
        ox0, ox1 = F.greatest("a_x_min", "b_x_min"), F.least("a_x_max", "b_x_max")
        oy0, oy1 = F.greatest("a_y_min", "b_y_min"), F.least("a_y_max", "b_y_max")

        def held(x: Column, most: int) -> Column:
            return F.least(F.greatest(x, F.lit(0)), F.lit(most)).cast("int")

        return {
            f"{p}c0": held(F.floor((ox0 - F.col(f"{p}x_min")) / rx), w), f"{p}c1": held(F.ceil((ox1 - F.col(f"{p}x_min")) / rx), w),
            f"{p}r0": held(F.floor((F.col(f"{p}y_max") - oy1) / ry), h), f"{p}r1": held(F.ceil((F.col(f"{p}y_max") - oy0) / ry), h),
        }

    pairs = box_join(windows, tiles, cell)
    out = pairs.withColumns(part("a_")).withColumns(part("b_"))
    out = out.withColumn("h", F.least(F.col("a_r1") - F.col("a_r0"), F.col("b_r1") - F.col("b_r0"))).withColumn("w", F.least(F.col("a_c1") - F.col("a_c0"), F.col("b_c1") - F.col("b_c0")))
    return out.where("h > 0 and w > 0")


def overlap_mean(windows: DataFrame, tiles: DataFrame, classes: int, shape: tuple[int, int], cell: float) -> DataFrame:
    """``(win_id, cls, row, col, p)``: mean of all tiles over each window cell; cells that no tile covers have 0."""
    s = overlap_slices(windows.select("win_id", "x_min", "y_min", "x_max", "y_max"), tiles, shape, cell)
    s = s.select("a_win_id", "a_r0", "a_c0", "b_r0", "b_c0", "h", "w", F.col("b_t").alias("t"))
    c = cells(s, classes, *shape)
    inside = (F.col("row") >= F.col("b_r0")) & (F.col("row") < F.col("b_r0") + F.col("h")) & (F.col("col") >= F.col("b_c0")) & (F.col("col") < F.col("b_c0") + F.col("w"))
    placed = c.where(inside).select(F.col("a_win_id").alias("win_id"), "cls", (F.col("row") - F.col("b_r0") + F.col("a_r0")).cast("int").alias("row"), (F.col("col") - F.col("b_c0") + F.col("a_c0")).cast("int").alias("col"), "p")
    mean = placed.groupBy("win_id", "cls", "row", "col").agg(F.avg("p").alias("p"))
    ids = mean.select("win_id").distinct()
    h, w = shape
    grid = F.array(*(F.struct(F.lit(k).alias("cls"), F.lit(r).alias("row"), F.lit(c).alias("col")) for k in range(classes) for r in range(h) for c in range(w)))
    full = ids.select("win_id", F.explode(grid).alias("g")).select("win_id", "g.*")
    return full.join(mean, ["win_id", "cls", "row", "col"], "left").na.fill({"p": 0.0})


def argmax(probabilities: DataFrame, keys: tuple[str, ...], cls: str = "cls", p: str = "p") -> DataFrame:
    """The likeliest class; the first one on ties."""
    return probabilities.groupBy(*keys).agg(F.min_by(cls, F.struct(-F.col(p), F.col(cls))).alias("cls"))


def nonzero_share(cells_: DataFrame, key: str) -> DataFrame:
    """Share of non-zero cells over all bands together."""
    return cells_.groupBy(key).agg(F.count("*").alias("total"), F.avg((F.col("p") != 0).cast("int")).alias("nonzero_prop"))


def softmax(logits: Column) -> Column:
    """Of an array, stable."""
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


def threshold_mask(p: Column, threshold: float = 0.25, whole: bool = False) -> Column:
    """Whole numbers: above 0; fractions: at least the threshold."""
    return p > 0 if whole else p >= threshold


def shadow_masked(pixels: DataFrame, tiles: DataFrame, cls: int, shape: tuple[int, int], threshold: float = 0.25) -> DataFrame:
    """Pixels ``(tile_id, row, col, v)`` become 0 where the tile's class probability reaches the threshold; the class
    is held to those there are."""
    k = F.least(F.lit(cls), (F.size("t") / (shape[0] * shape[1])).cast("int") - 1)
    at = tiles.select("tile_id", k.alias("k"), F.posexplode("t").alias("i", "p")).where(F.floor(F.col("i") / (shape[0] * shape[1])) == F.col("k"))
    at = at.select("tile_id", F.floor(F.col("i") % (shape[0] * shape[1]) / shape[1]).cast("int").alias("row"), (F.col("i") % shape[1]).cast("int").alias("col"), "p")
    return pixels.join(at, ["tile_id", "row", "col"], "left").select("tile_id", "row", "col", F.when(F.coalesce(threshold_mask(F.col("p"), threshold), F.lit(False)), F.lit(0)).otherwise(F.col("v")).alias("v"))


def channel_axis(d0: Column, d1: Column, d2: Column, most: int = 64) -> Column:
    """Which axis holds the classes: the last, else the first, else the middle, if at most ``most`` and not longer
    than the others; -1: none."""
    return F.when((d2 <= most) & (d2 <= d0) & (d2 <= d1), 2).when((d0 <= most) & (d0 <= d1) & (d0 <= d2), 0).when((d1 <= most) & (d1 <= d0) & (d1 <= d2), 1).otherwise(-1)


def resize_nearest(cells_: DataFrame, keys: tuple[str, ...], source: tuple[int, int], target: tuple[int, int], value: str) -> DataFrame:
    """Centre-aligned nearest neighbour: target cell i takes ``floor((i + 1/2) * n_source / n_target)``."""
    def pick(n: int, m: int, name: str) -> Column:
        sources = [((2 * i + 1) * n) // (2 * m) for i in range(m)]
        by = {s: [i for i, x in enumerate(sources) if x == s] for s in range(n)}
        arrays = F.array(*(F.array(*map(F.lit, v)) if v else F.array().cast("array<int>") for _, v in sorted(by.items())))
        return F.explode(F.element_at(arrays, F.col(name) + 1)).alias(f"t_{name}")

    out = cells_.select("*", pick(source[0], target[0], "row")).select("*", pick(source[1], target[1], "col"))
    return out.select(*keys, F.col("t_row").alias("row"), F.col("t_col").alias("col"), value)


def _smooth(a: np.ndarray, m: int, axis: int) -> np.ndarray:
    """Down-sizing: Gaussian filter of half the excess factor, then linear interpolation at centres."""
    n = a.shape[axis]
    sigma = max(0.0, (n / m - 1) / 2)
    if sigma:
        reach = int(4 * sigma + 0.5)
        w = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
        w /= w.sum()
        padded = np.pad(a, [(reach, reach) if i == axis else (0, 0) for i in range(a.ndim)], mode="symmetric")
        a = sum(w[i] * np.take(padded, range(i, i + n), axis=axis) for i in range(2 * reach + 1))
    x = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
    lo = np.minimum(np.floor(x).astype(int), max(0, n - 2))
    f = (x - lo).reshape([-1 if i == axis else 1 for i in range(a.ndim)])
    return np.take(a, lo, axis=axis) * (1 - f) + np.take(a, np.minimum(lo + 1, n - 1), axis=axis) * f


def resize_antialias(images: DataFrame, key: str, shape: tuple[int, int], target: tuple[int, int]) -> DataFrame:
    """Flat images ``(key, t)`` of ``shape``, smoothed and interpolated to ``target``; values are cut to 0..255."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t in b["t"]:
                a = np.asarray(t, dtype=float).reshape(shape)
                for axis in (0, 1):
                    a = _smooth(a, target[axis], axis)
                out.append(np.clip(a, 0, 255).astype(int).ravel().tolist())
            yield pd.DataFrame({key: b[key], "t": out})

    return images.select(key, "t").mapInPandas(run, f"`{key}` {images.schema[key].dataType.simpleString()}, t array<int>")
