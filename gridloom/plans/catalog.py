"""Registry of the engine's queries and of the SQL that checks them.

Every query runs over its whole tables. Doubles that come from sums are rounded to six places in both engines;
thresholds are compared before rounding.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs, scalar
from ..operators import coco, coverage, labels, mosaic, pairing, polygons, regions, sonogram, spatial, tensors, warp, windows
from ..sources import views as v
from . import workflow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WS, STRIDE, SHARE = 12, 6, 0.8
LABEL_WS, LABEL_STRIDE, LABEL_SHARE = 12, 6, 0.05
TILE = (4, 4)
#: Colours of classes.
COLOURS = ("#3366CC", "#DC3912", "#FF9900", "#109618", "#990099", "#0099C6", "#DD4477", "#66AA00", "#B82E2E", "#316395")


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = v.sql(sql)
        return f

    return add


def _six(name: str) -> Column:
    return F.round(name, 6).alias(name)


# Tiling

_COVER = f"""
 k AS (SELECT raster_id, unnest(range(greatest(0, ceil((r - {WS - 1}) / {STRIDE}.0))::BIGINT, floor(r / {STRIDE}.0)::BIGINT + 1)) * {STRIDE} AS wr, c, v FROM {{src}}),
 m AS (SELECT raster_id, wr, unnest(range(greatest(0, ceil((c - {WS - 1}) / {STRIDE}.0))::BIGINT, floor(c / {STRIDE}.0)::BIGINT + 1)) * {STRIDE} AS wc, v FROM k),
 s AS (SELECT raster_id, wr, wc, count(*)::BIGINT AS total_pix, count(*) FILTER (WHERE v <> 0)::BIGINT AS nonzero FROM m GROUP BY ALL)"""


@query(f"WITH {_COVER.format(src='v_pixels')} SELECT raster_id, wr, wc, total_pix, nonzero, round(nonzero / total_pix, 6) AS nonzero_prop FROM s WHERE nonzero * 100 >= total_pix * {SHARE * 100}")
def tile_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows whose data share is at least 0.8."""
    out = coverage.tile_coverage(v.pixels(spark, sf_dir), WS, STRIDE, SHARE)
    return out.withColumn("nonzero_prop", _six("nonzero_prop"))


def _raster_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = v.pixels(spark, sf_dir).groupBy("raster_id").agg((F.max("r") + 1).alias("height"), (F.max("c") + 1).alias("width"))
    return size.select("raster_id", F.lit(0.0).alias("x0"), F.col("height").cast("double").alias("y0"), F.lit(1.0).alias("res_x"), F.lit(1.0).alias("res_y"), "width", "height")


def _grid_sql(more: int) -> str:
    return f"""WITH d AS (SELECT raster_id, max(r) + 1 AS h, max(c) + 1 AS w FROM v_pixels GROUP BY raster_id),
     x AS (SELECT raster_id, h, unnest(range(0, w + {more} + 1, 5)) AS col, h + {more} AS hh FROM d),
     y AS (SELECT raster_id, h, col, len(range(0, hh + 1, 5)) AS ny, unnest(range(0, hh + 1, 5)) AS row FROM x)
     SELECT raster_id, (col // 5 * ny + row // 5)::BIGINT AS win_id, col, row, col::DOUBLE AS x_min, (h - row - 4)::DOUBLE AS y_min, (col + 4)::DOUBLE AS x_max, (h - row)::DOUBLE AS y_max FROM y"""


@query(_grid_sql(4))
def window_grid_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 4.5 by stride 5 (4.5 rounds to 4), with those past the edge."""
    return windows.raster_windows(_raster_meta(spark, sf_dir), 4.5, 5).drop("ws_x", "ws_y")


@query(_grid_sql(0))
def window_grid_raster_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.raster_windows(_raster_meta(spark, sf_dir), 4.5, 5, overshoot=False).drop("ws_x", "ws_y")


def _extent_sql(cut: int) -> str:
    return f"""WITH e AS (SELECT min(x_min) AS x0, min(y_min) AS y0, max(x_max) AS x1, max(y_max) AS y1 FROM v_tiles),
     n AS (SELECT *, floor((x1 - x0 - {cut}) / 3)::BIGINT + 1 AS nx, floor((y1 - y0 - {cut}) / 3)::BIGINT + 1 AS ny FROM e),
     i AS (SELECT *, unnest(range(0, nx)) AS ix FROM n), j AS (SELECT *, unnest(range(0, ny)) AS iy FROM i)
     SELECT ix * ny + iy AS win_id, x0 + ix * 3 AS x_min, y0 + iy * 3 AS y_min, x0 + ix * 3 + 4 AS x_max, y0 + iy * 3 + 4 AS y_max FROM j"""


@query(_extent_sql(0))
def window_grid_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.extent_windows(v.tiles(spark, sf_dir), (4.0, 4.0), 3.0)


@query(_extent_sql(4))
def window_grid_full_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.extent_windows(v.tiles(spark, sf_dir), (4.0, 4.0), 3.0, full_only=True)


@query(f"WITH p AS (SELECT raster_id, r, c, CASE v WHEN 55 THEN 0 WHEN 60 THEN 0 WHEN 0 THEN 7 ELSE v END AS v FROM v_pixels), {_COVER.format(src='p')} SELECT raster_id, wr, wc, total_pix, nonzero, round(nonzero / total_pix, 6) AS nonzero_prop FROM s WHERE nonzero * 100 >= total_pix * 95")
def tile_reclassify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage after values were replaced."""
    out = coverage.tile_coverage(coverage.reclassify(v.pixels(spark, sf_dir), {55: 0, 60: 0, 0: 7}), WS, STRIDE, 0.95)
    return out.withColumn("nonzero_prop", _six("nonzero_prop"))


@query(f"WITH {_COVER.format(src='v_pixels')} SELECT raster_id, wr, wc FROM s WHERE nonzero > 0")
def tile_any_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.any_valid(v.pixels(spark, sf_dir), WS, STRIDE)


@query(f"WITH {_COVER.format(src='v_pixels')} SELECT count(*) FILTER (WHERE nonzero * 100 >= total_pix * {SHARE * 100})::BIGINT AS accepted, count(*) FILTER (WHERE nonzero * 100 < total_pix * {SHARE * 100})::BIGINT AS rejected FROM s")
def tile_accept_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = windows.window_sums(v.pixels(spark, sf_dir), WS, STRIDE, {"total_pix": F.lit(1), "nonzero": (F.col("v") != 0).cast("int")})
    return coverage.accept_counts(s, F.col("nonzero") * 100 >= F.col("total_pix") * F.lit(SHARE * 100))


@query("SELECT fid, concat_ws('_', 'out', trim(class_name), '12m', round_even(x_min + 0.5, 0)::BIGINT, round_even(y_min + 0.5, 0)::BIGINT, round_even(x_max + 0.25, 0)::BIGINT, round_even(y_max - 0.5, 0)::BIGINT) AS name FROM v_features")
def tile_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = v.features(spark, sf_dir)
    return f.select("fid", scalar.tile_name(F.lit("out"), F.trim("class_name"), F.lit(12), F.col("x_min") + 0.5, F.col("y_min") + 0.5, F.col("x_max") + 0.25, F.col("y_max") - 0.5).alias("name"))


@query("SELECT raster_id, band, r, c, CASE WHEN v = 100 OR v IS NULL THEN 0 ELSE v END AS v FROM (SELECT raster_id, band, r, c, CASE WHEN band = 2 AND v % 15 = 0 THEN NULL ELSE v END AS v FROM v_pixels, (SELECT unnest([1, 2, 3]) AS band))")
def tile_rgb_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three of four bands; nulls and the no-data value 100 become 0."""
    p = v.pixels(spark, sf_dir).select("*", F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))).alias("band")).where("band <= 3")
    p = p.withColumn("v", F.when((F.col("band") == 2) & (F.col("v") % 15 == 0), F.lit(None)).otherwise(F.col("v")))
    return p.select("raster_id", "band", "r", "c", coverage.fill(F.col("v"), F.lit(100)).alias("v"))


# Footprint

_CELLS = "cells AS (SELECT DISTINCT c // 4 AS cx, r // 4 AS cy FROM v_pixels WHERE r % 4 = 2 AND c % 4 = 2 AND v <> 0 AND v > 150)"
_NEAR = "near AS (SELECT DISTINCT cx + dx AS cx, cy + dy AS cy FROM cells, (SELECT unnest(range(-1, 2)) AS dx), (SELECT unnest(range(-1, 2)) AS dy) WHERE dx * dx + dy * dy <= 1)"
_LATTICE = "lat AS (SELECT (x * 1000000 + y)::BIGINT AS win_id, (x * 5)::DOUBLE AS x_min, (y * 5)::DOUBLE AS y_min, (x * 5 + 4)::DOUBLE AS x_max, (y * 5 + 4)::DOUBLE AS y_max FROM (SELECT unnest(range(0, 8)) AS x), (SELECT unnest(range(0, (SELECT max(r) // 5 + 1 FROM v_pixels))) AS y))"
_TOUCH = "w.x_min <= (n.cx + 1) * 4 AND w.x_max >= n.cx * 4 AND w.y_min <= (n.cy + 1) * 4 AND w.y_max >= n.cy * 4"


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.footprint_cells(v.pixels(spark, sf_dir), 4, (F.col("v") != 0) & (F.col("v") > 150))


def _lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = v.pixels(spark, sf_dir).agg(F.expr("max(r) div 5").alias("n")).select(F.explode(F.sequence(F.lit(0).cast("long"), "n")).alias("y"))
    w = y.select("y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("x"))
    d = lambda c: c.cast("double")
    x, y_ = F.col("x") * 5, F.col("y") * 5
    return w.select((F.col("x") * 1000000 + F.col("y")).alias("win_id"), d(x).alias("x_min"), d(y_).alias("y_min"), d(x + 4).alias("x_max"), d(y_ + 4).alias("y_max"))


@query(f"WITH {_CELLS} SELECT cx, cy FROM cells")
def footprint_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir)


@query(f"WITH {_CELLS}, {_NEAR} SELECT cx, cy FROM near")
def footprint_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.buffered(_cells(spark, sf_dir), 1)


@query(f"WITH {_CELLS}, {_LATTICE} SELECT w.* FROM lat w WHERE EXISTS (SELECT 1 FROM cells n WHERE {_TOUCH})")
def windows_in_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.in_footprint(_lattice(spark, sf_dir), _cells(spark, sf_dir), 4)


@query(f"WITH {_CELLS}, {_NEAR}, {_LATTICE} SELECT DISTINCT w.* FROM lat w JOIN near n ON {_TOUCH}")
def windows_sjoin_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.in_footprint(_lattice(spark, sf_dir), spatial.buffered(_cells(spark, sf_dir), 1), 4)


# Labels

_LW = f"win AS (SELECT (x * 1000 + y)::BIGINT AS win_id, (x * {LABEL_STRIDE})::DOUBLE AS x_min, (y * {LABEL_STRIDE})::DOUBLE AS y_min, (x * {LABEL_STRIDE} + {LABEL_WS})::DOUBLE AS x_max, (y * {LABEL_STRIDE} + {LABEL_WS})::DOUBLE AS y_max FROM (SELECT unnest(range(0, 19)) AS x), (SELECT unnest(range(0, 28)) AS y))"
_CLIP = f"{_LW}, clip AS (SELECT win_id, fid, class_name, (least(w.x_max, f.x_max) - greatest(w.x_min, f.x_min)) * (least(w.y_max, f.y_max) - greatest(w.y_min, f.y_min)) AS area FROM win w JOIN v_features f ON w.x_min < f.x_max AND w.x_max > f.x_min AND w.y_min < f.y_max AND w.y_max > f.y_min)"
_IDS = "CASE lower(trim(class_name)) " + " ".join(f"WHEN '{k}' THEN {i}" for k, i in v.FEATURE_IDS.items()) + " END"
_AREAS = f"{_CLIP}, val AS (SELECT *, {_IDS} AS value FROM clip), areas AS (SELECT win_id, sum(area) AS total_area, coalesce(sum(area) FILTER (WHERE value > 0 AND lower(trim(class_name)) NOT IN ('mask', 'shadow')), 0) AS valid_area FROM val GROUP BY win_id)"


def _label_windows(spark: SparkSession) -> DataFrame:
    w = spark.range(19).withColumnRenamed("id", "x").select("x", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(27).cast("long"))).alias("y"))
    x, y = F.col("x") * LABEL_STRIDE, F.col("y") * LABEL_STRIDE
    return w.select((F.col("x") * 1000 + F.col("y")).alias("win_id"), x.cast("double").alias("x_min"), y.cast("double").alias("y_min"), (x + LABEL_WS).cast("double").alias("x_max"), (y + LABEL_WS).cast("double").alias("y_max"))


def _clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.clip_areas(_label_windows(spark), v.features(spark, sf_dir), float(LABEL_WS))


@query(f"WITH {_CLIP} SELECT win_id, count(*)::BIGINT AS parts, round(sum(area), 6) AS total_area FROM clip GROUP BY win_id")
def label_clip_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clipped(spark, sf_dir).groupBy("win_id").agg(F.count("*").alias("parts"), F.round(F.sum("area"), 6).alias("total_area"))


@query(f"SELECT fid, class_name, {_IDS} AS value FROM v_features")
def class_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.features(spark, sf_dir).select("fid", "class_name", scalar.crosswalk(F.col("class_name"), v.FEATURE_IDS).alias("value"))


@query(f"SELECT DISTINCT class_name, {_IDS} AS value FROM v_features WHERE {_IDS} > 0 AND lower(trim(class_name)) NOT IN ('mask', 'shadow')")
def valid_class_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = v.features(spark, sf_dir).select("class_name", scalar.crosswalk(F.col("class_name"), v.FEATURE_IDS).alias("value"))
    return f.where(labels.valid_class(F.col("class_name"), F.col("value"))).distinct()


@query(f"WITH {_AREAS} SELECT win_id, round(total_area, 6) AS total_area, round(valid_area, 6) AS valid_area FROM areas WHERE total_area > 0 AND valid_area > 0 AND valid_area >= {LABEL_SHARE * LABEL_WS * LABEL_WS}")
def label_area_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = labels.window_areas(_clipped(spark, sf_dir), v.FEATURE_IDS)
    return a.where((F.col("total_area") > 0) & (F.col("has_valid") == 1) & (F.col("valid_area") >= F.lit(LABEL_SHARE * LABEL_WS * LABEL_WS))).select("win_id", _six("total_area"), _six("valid_area"))


@query(f"WITH {_CLIP} SELECT win_id, class_name, round(sum(area) / (SELECT sum(area) FROM clip t WHERE t.win_id = clip.win_id), 6) AS fraction FROM clip WHERE class_name IS NOT NULL GROUP BY win_id, class_name")
def class_area_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.class_fractions(_clipped(spark, sf_dir)).select("win_id", "class_name", _six("fraction"))


@query(f"WITH {_AREAS}, j AS (SELECT w.win_id, coalesce(total_area, 0) AS t, coalesce(valid_area, 0) AS a FROM win w LEFT JOIN areas USING (win_id)) SELECT win_id, allow_empty, CASE WHEN t > 0 AND a > 0 AND a >= {LABEL_SHARE * LABEL_WS * LABEL_WS} THEN 'label' WHEN allow_empty THEN 'empty' ELSE 'reject' END AS outcome FROM j, (SELECT unnest([true, false]) AS allow_empty)")
def tile_accept_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = labels.window_areas(_clipped(spark, sf_dir), v.FEATURE_IDS)
    both = [labels.accept(_label_windows(spark), a, LABEL_WS * LABEL_WS, LABEL_SHARE, e).select("win_id", F.lit(e).alias("allow_empty"), "outcome") for e in (True, False)]
    return both[0].union(both[1])


_BURN = f"pts AS (SELECT fid, {_IDS} AS value, c, unnest(range(y_min::BIGINT, y_max::BIGINT)) AS r FROM (SELECT *, unnest(range(x_min::BIGINT, x_max::BIGINT)) AS c FROM v_features)), burn AS (SELECT r, c, arg_max(value, fid) AS value FROM pts WHERE value IS NOT NULL GROUP BY r, c)"


def _burnt(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = v.features(spark, sf_dir)
    return labels.burn(f, scalar.crosswalk(F.col("class_name"), v.FEATURE_IDS))


@query(f"WITH {_BURN} SELECT r, c, value FROM burn")
def rasterize_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _burnt(spark, sf_dir)


@query(f"WITH {_BURN} SELECT r, c, CASE WHEN v > 0 THEN coalesce(value, 0) ELSE 0 END AS value FROM v_label_pixels LEFT JOIN burn USING (r, c)")
def label_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.mask_labels(_burnt(spark, sf_dir), v.label_pixels(spark, sf_dir).select("r", "c", "v"))


@query(f"WITH {_AREAS} SELECT w.win_id, 0 AS value, {LABEL_WS * LABEL_WS}::BIGINT AS cells FROM win w LEFT JOIN areas a USING (win_id) WHERE NOT coalesce(a.total_area > 0 AND a.valid_area > 0 AND a.valid_area >= {LABEL_SHARE * LABEL_WS * LABEL_WS}, false)")
def empty_label_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label tiles of zeros for windows without enough labels."""
    a = labels.window_areas(_clipped(spark, sf_dir), v.FEATURE_IDS)
    out = labels.accept(_label_windows(spark), a, LABEL_WS * LABEL_WS, LABEL_SHARE, True).where("outcome = 'empty'")
    return out.select("win_id", F.lit(0).alias("value"), F.lit(LABEL_WS * LABEL_WS).cast("long").alias("cells"))


# Tensors

_TW = "win AS (SELECT (x * 100000 + y)::BIGINT AS win_id, (x * 4)::DOUBLE AS x_min, (y * 4)::DOUBLE AS y_min, (x * 4 + 4)::DOUBLE AS x_max, (y * 4 + 4)::DOUBLE AS y_max FROM (SELECT unnest(range(0, 13)) AS x), (SELECT unnest(range(0, (SELECT (max(y_max) // 4)::BIGINT + 1 FROM v_tiles))) AS y))"
_PAIR = f"{_TW}, pair AS (SELECT win_id, tile_id, w.x_min AS wx, w.y_max AS wy, t.x_min AS tx, t.y_max AS ty, greatest(w.x_min, t.x_min) AS x0, least(w.x_max, t.x_max) AS x1, greatest(w.y_min, t.y_min) AS y0, least(w.y_max, t.y_max) AS y1, t FROM win w JOIN v_tiles t ON w.x_min < t.x_max AND w.x_max > t.x_min AND w.y_min < t.y_max AND w.y_max > t.y_min)"
_SLICE = f"{_PAIR}, slice AS (SELECT win_id, tile_id, t, (x0 - wx)::INT AS a_c0, (wy - y1)::INT AS a_r0, (x0 - tx)::INT AS b_c0, (ty - y1)::INT AS b_r0, (x1 - x0)::INT AS w, (y1 - y0)::INT AS h FROM pair)"
_CELL = "cell AS (SELECT tile_id, i // 16 AS cls, i % 16 // 4 AS row, i % 4 AS col, p::DOUBLE AS p FROM (SELECT tile_id, unnest(t) AS p, unnest(range(0, 64)) AS i FROM v_tiles))"
_MEAN = f"{_SLICE}, {_CELL}, mean AS (SELECT s.win_id, cls, row - b_r0 + a_r0 AS row, col - b_c0 + a_c0 AS col, avg(p) AS p FROM slice s JOIN cell c ON s.tile_id = c.tile_id AND row >= b_r0 AND row < b_r0 + h AND col >= b_c0 AND col < b_c0 + w GROUP BY ALL)"
_FULL = f"{_MEAN}, wins AS (SELECT DISTINCT win_id FROM mean), fullgrid AS (SELECT win_id, k.cls, g.row, h.col FROM wins, (SELECT unnest(range(0, 4)) AS cls) k, (SELECT unnest(range(0, 4)) AS row) g, (SELECT unnest(range(0, 4)) AS col) h), avgs AS (SELECT f.win_id, f.cls, f.row, f.col, coalesce(m.p, 0) AS p FROM fullgrid f LEFT JOIN mean m USING (win_id, cls, row, col))"


def _tile_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = v.tiles(spark, sf_dir).agg(F.floor(F.max("y_max") / 4).alias("n")).select(F.explode(F.sequence(F.lit(0).cast("long"), "n")).alias("y"))
    w = y.select("y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(12).cast("long"))).alias("x"))
    x, y_ = F.col("x") * 4, F.col("y") * 4
    return w.select((F.col("x") * 100000 + F.col("y")).alias("win_id"), x.cast("double").alias("x_min"), y_.cast("double").alias("y_min"), (x + 4).cast("double").alias("x_max"), (y_ + 4).cast("double").alias("y_max"))


def _mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensors.overlap_mean(_tile_windows(spark, sf_dir), v.tiles(spark, sf_dir), 4, TILE, 4.0)


@query(f"WITH {_PAIR} SELECT win_id, tile_id FROM pair")
def tile_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.box_join(_tile_windows(spark, sf_dir), v.tiles(spark, sf_dir).drop("t"), 4.0).select(F.col("a_win_id").alias("win_id"), F.col("b_tile_id").alias("tile_id"))


@query(f"WITH {_SLICE} SELECT win_id, tile_id, a_c0, a_r0, b_c0, b_r0, w, h FROM slice")
def overlap_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tensors.overlap_slices(_tile_windows(spark, sf_dir), v.tiles(spark, sf_dir).drop("t"), TILE, 4.0)
    return s.select(F.col("a_win_id").alias("win_id"), F.col("b_tile_id").alias("tile_id"), "a_c0", "a_r0", "b_c0", "b_r0", "w", "h")


@query(f"WITH {_FULL} SELECT win_id, cls::INT AS cls, row::INT AS row, col::INT AS col, round(p, 6) AS p FROM avgs")
def softmax_overlap_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mean(spark, sf_dir).select("win_id", "cls", "row", "col", _six("p"))


@query(f"WITH {_FULL}, q AS (SELECT win_id, row, col, cls, row_number() OVER (PARTITION BY win_id, row, col ORDER BY round(p, 6) DESC, cls) AS n FROM avgs) SELECT win_id, row::INT AS row, col::INT AS col, cls::INT AS cls FROM q WHERE n = 1")
def argmax_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _mean(spark, sf_dir).withColumn("p", F.round("p", 6))
    return tensors.argmax(m, ("win_id", "row", "col"))


@query(f"WITH {_CELL} SELECT tile_id, count(*)::BIGINT AS total, round(count(*) FILTER (WHERE p > 0.1) / count(*), 6) AS nonzero_prop FROM cell GROUP BY tile_id")
def tile_nonzero_prop_all_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tensors.cells(v.tiles(spark, sf_dir), 4, *TILE).withColumn("p", F.when(F.col("p") > 0.1, F.col("p")).otherwise(F.lit(0.0)))
    return tensors.nonzero_share(c, "tile_id").select("tile_id", "total", _six("nonzero_prop"))


@query("WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS k FROM embeddings), m AS (SELECT vec_id, k, exp(x - max(x) OVER (PARTITION BY vec_id)) AS z FROM e) SELECT vec_id, k::INT AS k, round(z / sum(z) OVER (PARTITION BY vec_id), 6) AS p FROM m")
def softmax_from_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = v.table(spark, sf_dir, "embeddings").select("vec_id", tensors.softmax(F.col("embedding").cast("array<double>")).alias("p"))
    return e.select("vec_id", F.posexplode("p").alias("k", "p")).select("vec_id", "k", _six("p"))


@query(f"WITH {_CELL} SELECT tile_id, row::INT AS row, col::INT AS col, CASE WHEN p >= 0.1 THEN 0 ELSE row * 4 + col + 1 END AS v FROM cell WHERE cls = 1")
def prob_threshold_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels become 0 where class 1 reaches 0.1."""
    t = v.tiles(spark, sf_dir)
    p = t.select("tile_id", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("i")).select("tile_id", F.expr("cast(i div 4 as int)").alias("row"), (F.col("i") % 4).alias("col"), (F.col("i") + 1).cast("long").alias("v"))
    return tensors.shadow_masked(p, t, 1, TILE, 0.1)


@query("SELECT p_partkey, CASE WHEN d2 <= 64 AND d2 <= d0 AND d2 <= d1 THEN 2 WHEN d0 <= 64 AND d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= 64 AND d1 <= d0 AND d1 <= d2 THEN 1 ELSE -1 END AS axis FROM (SELECT p_partkey, p_size * 3 AS d0, p_partkey % 97 AS d1, p_partkey % 89 + 1 AS d2 FROM part)")
def chw_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.table(spark, sf_dir, "part")
    return p.select("p_partkey", tensors.channel_axis(F.col("p_size") * 3, F.col("p_partkey") % 97, F.col("p_partkey") % 89 + 1).alias("axis"))


@query(f"WITH {_CELL}, g AS (SELECT tile_id, cls, row, col, p FROM cell), t AS (SELECT unnest(range(0, 6)) AS i), u AS (SELECT i, (2 * i + 1) * 4 // 12 AS s FROM t) SELECT tile_id, cls::INT AS cls, a.i::INT AS row, b.i::INT AS col, round(p, 6) AS p FROM g JOIN u a ON a.s = g.row JOIN u b ON b.s = g.col")
def resize_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tensors.cells(v.tiles(spark, sf_dir), 4, *TILE)
    return tensors.resize_nearest(c, ("tile_id", "cls"), TILE, (6, 6), "p").withColumn("p", _six("p"))


def _axis_sql(name: str, n: int, m: int) -> str:
    """Weights ``(i, j, w)`` of source place j in target place i: a Gaussian of half the excess factor over a line that is
    mirrored at its ends, then linear between centres."""
    sigma = (n / m - 1) / 2
    reach = int(4 * sigma + 0.5)
    return f"""
 {name}g AS (SELECT k, exp(-0.5 * (k / {sigma!r}::DOUBLE) ** 2) AS g FROM (SELECT unnest(range({-reach}, {reach} + 1)) AS k)),
 {name}s AS (SELECT q, CASE WHEN mod(q + k + {4 * n}, {2 * n}) < {n} THEN mod(q + k + {4 * n}, {2 * n}) ELSE {2 * n - 1} - mod(q + k + {4 * n}, {2 * n}) END AS j, g / (SELECT sum(g) FROM {name}g) AS g FROM {name}g, (SELECT unnest(range(0, {n})) AS q)),
 {name}x AS (SELECT i, least(floor(x), {n - 2}) AS lo, x - least(floor(x), {n - 2}) AS f FROM (SELECT i, least(greatest((i + 0.5::DOUBLE) * {n} / {m} - 0.5, 0), {n - 1}) AS x FROM (SELECT unnest(range(0, {m})) AS i))),
 {name} AS (SELECT i, j, sum(g * CASE WHEN q = lo THEN 1 - f ELSE f END) AS w FROM {name}x JOIN {name}s ON q = lo OR q = lo + 1 GROUP BY i, j)"""


@query(f"WITH {_axis_sql('ya', 8, 5)}, {_axis_sql('xa', 8, 3)}, p AS (SELECT vec_id, (unnest(embedding)::DOUBLE + 1) * 128 AS v, unnest(range(0, 64)) AS k FROM embeddings), o AS (SELECT vec_id, ya.i AS r, xa.i AS c, sum(v * ya.w * xa.w) AS v FROM p JOIN ya ON ya.j = k // 8 JOIN xa ON xa.j = k % 8 GROUP BY ALL) SELECT vec_id, list(trunc(least(greatest(v, 0), 255))::INT ORDER BY r, c) AS t FROM o GROUP BY vec_id")
def resize_antialias(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = v.table(spark, sf_dir, "embeddings").select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: (x + 1) * 128).alias("t"))
    return tensors.resize_antialias(e, "vec_id", (8, 8), (5, 3))


# Mosaics

@query("WITH s AS (SELECT r % 20 AS r, c, v, r // 20 AS ord FROM v_pixels) SELECT r, c, coalesce(arg_max(v, ord) FILTER (WHERE v <> 0), 0) AS v FROM s GROUP BY r, c")
def mosaic_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strips of 20 rows laid over each other, later ones on top."""
    p = v.pixels(spark, sf_dir).select((F.col("r") % 20).alias("r"), "c", "v", F.expr("r div 20").alias("ord"))
    return mosaic.last_wins(p)


@query("SELECT level, r // f AS r, c // f AS c, v FROM (SELECT *, (2 ** level)::BIGINT AS f FROM v_pixels, (SELECT unnest(range(1, 10))::INT AS level)) WHERE r % f = f // 2 AND c % f = f // 2")
def mosaic_overviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mosaic.overviews(v.pixels(spark, sf_dir), 9)


@query("WITH s AS (SELECT o_orderkey, greatest(1, round_even(o_totalprice / 4.0, 0)::BIGINT) AS w, greatest(1, round_even((o_orderkey % 1000 + 0.5) / 1.0, 0)::BIGINT) AS h FROM orders) SELECT o_orderkey, CASE WHEN w * h > 1000000 THEN greatest(1, trunc(w / sqrt(w * h / 1000000.0::DOUBLE))::BIGINT) ELSE w END AS w, CASE WHEN w * h > 1000000 THEN greatest(1, trunc(h / sqrt(w * h / 1000000.0::DOUBLE))::BIGINT) ELSE h END AS h FROM s")
def out_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = v.table(spark, sf_dir, "orders").select("o_orderkey", scalar.out_shape(F.col("o_totalprice") / 4.0, F.col("o_orderkey") % 1000 + F.lit(0.5), F.lit(1.0), F.lit(1000000.0)).alias("s"))
    return o.select("o_orderkey", "s.w", "s.h")


# Regions

def _links(mask: str, near: str) -> str:
    return f"px AS MATERIALIZED (SELECT r * 2147483648 + c AS id, r, c, cls FROM v_label_pixels WHERE {mask}), lk AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM px a JOIN (SELECT dr, dc FROM (SELECT unnest(range(-1, 2)) AS dr), (SELECT unnest(range(-1, 2)) AS dc) WHERE {near}) d ON true JOIN px b ON b.r = a.r + d.dr AND b.c = a.c + d.dc AND b.cls = a.cls)"


def _reach(mask: str, near: str) -> str:
    return f"WITH RECURSIVE {_links(mask, near)}, reach AS (SELECT id AS n, id AS m FROM px UNION SELECT reach.n, lk.b FROM reach JOIN lk ON lk.a = reach.m), comp AS (SELECT n AS id, min(m) AS comp FROM reach GROUP BY n), lab AS (SELECT r, c, cls, comp FROM px JOIN comp USING (id))"


_EIGHT, _FOUR = "abs(dr) + abs(dc) > 0", "abs(dr) + abs(dc) = 1"
_LAB8, _LAB4 = _reach("cls <> 0", _EIGHT), _reach("true", _FOUR)


def _labelled(spark: SparkSession, sf_dir: str, connectivity: int = 8, background: int | None = 0) -> DataFrame:
    return regions.components(v.label_pixels(spark, sf_dir), connectivity=connectivity, background=background)


@query(f"{_LAB8} SELECT r, c, cls, comp FROM lab")
def components8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir)


@query(f"{_LAB8}, big AS (SELECT comp FROM lab GROUP BY comp HAVING count(*) >= 3) SELECT r, c, cls, comp FROM lab JOIN big USING (comp)")
def small_objects_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.without_small(_labelled(spark, sf_dir), 3)


@query(f"{_reach('cls = 0', _FOUR)}, small AS (SELECT comp FROM lab GROUP BY comp HAVING count(*) < 3), hole AS (SELECT r, c FROM lab JOIN small USING (comp)) SELECT p.r, p.c, CASE WHEN h.r IS NOT NULL OR p.cls <> 0 THEN 1 ELSE 0 END AS cls FROM v_label_pixels p LEFT JOIN hole h USING (r, c)")
def hole_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = v.label_pixels(spark, sf_dir).select("r", "c", (F.col("cls") != 0).cast("int").alias("cls"))
    return regions.fill_holes(mask, 3)


@query(f"{_LAB4} SELECT comp, cls, count(*)::DOUBLE AS area_m, min(r) AS r_min, max(r) AS r_max, min(c) AS c_min, max(c) AS c_max FROM lab GROUP BY comp, cls")
def polygonize_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.polygons(v.label_pixels(spark, sf_dir))


@query(f"{_LAB4} SELECT comp, cls, count(*)::DOUBLE AS area_m FROM lab WHERE cls <> 0 GROUP BY comp, cls")
def drop_nodata_polys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.polygons(v.label_pixels(spark, sf_dir)).where("cls <> 0").select("comp", "cls", "area_m")


NAMES = {1: "Fines", 2: "Sand", 4: "Boulder"}


@query(f"{_LAB4} SELECT CASE cls WHEN 1 THEN 'Fines' WHEN 2 THEN 'Sand' WHEN 4 THEN 'Boulder' ELSE cls::VARCHAR END AS name, count(DISTINCT comp)::BIGINT AS patches, count(*)::DOUBLE AS area_m FROM lab GROUP BY 1")
def class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of classes, the number where there is none."""
    names = F.broadcast(spark.createDataFrame(list(NAMES.items()), "cls int, name string"))  # one row for each class
    p = regions.polygons(v.label_pixels(spark, sf_dir)).join(names, "cls", "left").withColumn("name", F.coalesce("name", F.col("cls").cast("string")))
    return p.groupBy("name").agg(F.count("*").alias("patches"), F.sum("area_m").alias("area_m"))


_NEAR4 = "nb AS MATERIALIZED (SELECT DISTINCT x.comp, y.comp AS nbr FROM lab x JOIN (SELECT dr, dc FROM (SELECT unnest(range(-1, 2)) AS dr), (SELECT unnest(range(-1, 2)) AS dc)) d ON true JOIN lab y ON y.r = x.r + d.dr AND y.c = x.c + d.dc AND y.comp <> x.comp)"


@query(f"{_LAB4}, {_NEAR4} SELECT comp, nbr FROM nb")
def patch_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.adjacency(_labelled(spark, sf_dir, 4, None))


@query(f"{_LAB4}, {_NEAR4}, ar AS (SELECT comp, count(*) AS area FROM lab GROUP BY comp), o AS (SELECT nb.comp, nb.nbr, row_number() OVER (PARTITION BY nb.comp ORDER BY b.area DESC, nb.nbr) AS n FROM nb JOIN ar a ON a.comp = nb.comp AND a.area < 4 JOIN ar b ON b.comp = nb.nbr) SELECT comp, nbr AS \"into\" FROM o WHERE n = 1")
def dissolve_pass1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each patch below 4 goes in the first pass."""
    lab = _labelled(spark, sf_dir, 4, None)
    return regions.receivers(lab.groupBy("comp").agg(F.count("*").cast("double").alias("area")), regions.adjacency(lab), 4.0)


def _passes_sql(least: int, passes: int) -> str:
    """Merging passes, each from the patches that the one before left."""
    ctes = [f"{_LAB4}, {_NEAR4}, p0 AS MATERIALIZED (SELECT comp, count(*) AS area FROM lab GROUP BY comp), n0 AS MATERIALIZED (SELECT comp, nbr FROM nb)"]
    for k in range(passes):
        ctes.append(
            f"o{k} AS MATERIALIZED (SELECT n.comp, n.nbr AS goes, a.area, row_number() OVER (PARTITION BY n.comp ORDER BY b.area DESC, n.nbr) AS o, b.area AS other FROM n{k} n JOIN p{k} a ON a.comp = n.comp AND a.area < {least} JOIN p{k} b ON b.comp = n.nbr), "
            f"m{k} AS MATERIALIZED (SELECT x.comp, x.goes FROM o{k} x LEFT JOIN o{k} y ON y.comp = x.goes AND y.o = 1 AND y.goes = x.comp WHERE x.o = 1 AND (y.comp IS NULL OR x.area < x.other OR (x.area = x.other AND x.comp > x.goes))), "
            f"h{k} AS (SELECT comp, goes FROM m{k} UNION SELECT h{k}.comp, m{k}.goes FROM h{k} JOIN m{k} ON m{k}.comp = h{k}.goes), "
            f"e{k} AS MATERIALIZED (SELECT comp, goes FROM h{k} WHERE goes NOT IN (SELECT comp FROM m{k})), "
            f"p{k + 1} AS MATERIALIZED (SELECT coalesce(e.goes, p.comp) AS comp, sum(p.area) AS area FROM p{k} p LEFT JOIN e{k} e USING (comp) GROUP BY 1), "
            f"n{k + 1} AS MATERIALIZED (SELECT DISTINCT coalesce(x.goes, n.comp) AS comp, coalesce(y.goes, n.nbr) AS nbr FROM n{k} n LEFT JOIN e{k} x ON x.comp = n.comp LEFT JOIN e{k} y ON y.comp = n.nbr WHERE coalesce(x.goes, n.comp) <> coalesce(y.goes, n.nbr))"
        )
    return f"{', '.join(ctes)} SELECT comp, any_value(lab.cls) AS cls, any_value(area)::DOUBLE AS area FROM p{passes} JOIN lab USING (comp) GROUP BY comp"


@query(_passes_sql(4, 5))
def dissolve_small_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.dissolve(_labelled(spark, sf_dir, 4, None), 4.0)


# Small regions out; holes of at most two pixels filled, so that two rounds reach every pixel of them.
_HOLES = _reach("keep.r IS NULL", _FOUR).removeprefix("WITH RECURSIVE ").replace("FROM v_label_pixels", "FROM v_label_pixels LEFT JOIN keep USING (r, c)").replace("a.cls AND b.cls", "").replace("cls FROM", "0 AS cls FROM")
for _name in ("px", "lk", "reach", "comp", "lab"):
    _HOLES = re.sub(rf"\b{_name}\b", f"z_{_name}", _HOLES)
_SPREAD = "SELECT h.r, h.c, min(k.cls) AS cls FROM hole h JOIN {0} k ON abs(h.r - k.r) + abs(h.c - k.c) = 1 GROUP BY h.r, h.c"
_ONE = _SPREAD.format("keep")


@query(f"{_LAB8}, big AS (SELECT comp FROM lab GROUP BY comp HAVING count(*) >= 3), keep AS MATERIALIZED (SELECT r, c, cls FROM lab JOIN big USING (comp)), {_HOLES}, hole AS MATERIALIZED (SELECT r, c FROM z_lab JOIN (SELECT z_comp FROM z_lab GROUP BY z_comp HAVING count(*) < 3) USING (z_comp)), one AS MATERIALIZED ({_ONE}), two AS ({_SPREAD.format('one')}) SELECT p.r, p.c, coalesce(keep.cls, one.cls, two.cls, 0)::INT AS cls FROM v_label_pixels p LEFT JOIN keep USING (r, c) LEFT JOIN one USING (r, c) LEFT JOIN two USING (r, c)")
def watershed_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.clean_labels(v.label_pixels(spark, sf_dir), 3)


@query()
def simplify_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.simplify(regions.rings(_labelled(spark, sf_dir, 4, None)), 0.75)


# COCO

_QUAD = "qd AS (SELECT comp, count(*) AS n FROM (SELECT comp, r - a AS qr, c - b AS qc FROM lab, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b)) GROUP BY comp, qr, qc), ca AS (SELECT comp, sum(CASE n WHEN 4 THEN 1.0 WHEN 3 THEN 0.5 ELSE 0 END)::DOUBLE AS area FROM qd GROUP BY comp), bx AS (SELECT comp, cls, min(c) AS x, min(r) AS y, max(c) - min(c) + 1 AS w, max(r) - min(r) + 1 AS h FROM lab GROUP BY comp, cls), reg AS (SELECT bx.*, area, y // 10 AS image_id FROM bx JOIN ca USING (comp) WHERE area > 0)"


@query(f"{_LAB8}, {_QUAD} SELECT comp, cls, x, y, w, h, area FROM reg")
def coco_bbox_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coco.boxes(_labelled(spark, sf_dir))


@query("WITH f AS (SELECT DISTINCT regexp_extract(path, '[^/]*$') AS file_name FROM v_paths) SELECT row_number() OVER (ORDER BY file_name)::BIGINT AS id, file_name, 512 AS width, 512 AS height FROM f")
def coco_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = v.paths(spark, sf_dir).select(scalar.basename(F.col("path")).alias("file_name")).distinct()
    return coco.images(f.select("file_name", F.lit(512).alias("width"), F.lit(512).alias("height")))


@query("SELECT * FROM (VALUES (1, 'Fines'), (2, 'Sand'), (4, 'Boulder')) t(id, name)")
def coco_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(coco.categories({0: "Unknown", **NAMES}), "id int, name string")


@query(f"{_LAB8}, {_QUAD} SELECT row_number() OVER (ORDER BY image_id, cls, y, x, comp)::BIGINT AS id, image_id, cls AS category_id, x, y, w, h, area FROM reg")
def coco_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg = coco.boxes(_labelled(spark, sf_dir)).withColumn("image_id", F.expr("y div 10"))
    b = F.col("bbox")
    return coco.annotations(reg).select("id", "image_id", "category_id", b[0].alias("x"), b[1].alias("y"), b[2].alias("w"), b[3].alias("h"), "area")


@query()
def coco_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coco.segmentation(_labelled(spark, sf_dir))


_FILES = "m AS (SELECT 'masks/' || (id % 40) || '.png' AS path FROM v_paths WHERE id % 2 = 0), i AS (SELECT 'images/' || (id % 50) || '.' || ['png', 'jpg', 'tif', 'txt'][1 + id % 4] AS path FROM v_paths)"
_PICK = "im AS (SELECT regexp_extract(path, '([^/]*)\\.[^.]*$', 1) AS base, path, list_position(['png', 'jpg', 'jpeg', 'tif', 'tiff'], regexp_extract(path, '[^.]*$')) AS k FROM (SELECT DISTINCT path FROM i)), pick AS (SELECT base, arg_min(path, k) AS image FROM im WHERE k > 0 GROUP BY base)"


@query(f"WITH {_FILES}, {_PICK} SELECT path AS mask, image FROM (SELECT DISTINCT path FROM m) JOIN pick ON base = regexp_extract(path, '([^/]*)\\.[^.]*$', 1)")
def mask_image_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.paths(spark, sf_dir)
    m = p.where("id % 2 = 0").select(F.concat(F.lit("masks/"), (F.col("id") % 40).cast("string"), F.lit(".png")).alias("path")).distinct()
    kind = F.element_at(F.array(*map(F.lit, ("png", "jpg", "tif", "txt"))), (F.col("id") % 4 + 1).cast("int"))
    i = p.select(F.concat(F.lit("images/"), (F.col("id") % 50).cast("string"), F.lit("."), kind).alias("path")).distinct()
    return coco.match_masks(m, i, keep_unmatched=False)


# Series

@query("WITH a AS (SELECT transect, ping_cnt, count(*) AS n FROM v_pings GROUP BY ALL), b AS (SELECT transect, dep_bin, count(*) AS n FROM v_pings GROUP BY ALL), x AS (SELECT transect, ping_cnt, row_number() OVER (PARTITION BY transect ORDER BY n DESC, ping_cnt) AS k FROM a), y AS (SELECT transect, dep_bin, row_number() OVER (PARTITION BY transect ORDER BY n DESC, dep_bin) AS k FROM b) SELECT x.transect, ping_cnt AS ping_max, dep_bin AS dep_mode FROM x JOIN y ON x.transect = y.transect WHERE x.k = 1 AND y.k = 1")
def modal_ping_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sonogram.modal_range(v.pings(spark, sf_dir))


@query("WITH c AS (SELECT DISTINCT transect, chunk FROM v_pings) SELECT transect, chunk, lead(chunk) OVER (PARTITION BY transect ORDER BY chunk) AS next_chunk FROM c")
def chunk_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sonogram.chunk_pairs(v.pings(spark, sf_dir).select("transect", "chunk").distinct())


@query("WITH n AS (SELECT transect, chunk, count(*) AS size, min(ping) AS first FROM v_pings GROUP BY ALL), s AS (SELECT transect, chunk, first, unnest(range(0, least(size, 32), 8)) AS start FROM n) SELECT s.transect, s.chunk, s.start, count(*)::BIGINT AS pings, sum(ping_cnt)::BIGINT AS total FROM s JOIN v_pings p ON p.transect = s.transect AND p.ping >= first + start AND p.ping < first + start + 32 GROUP BY ALL")
def sonogram_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sonogram.sliding(v.pings(spark, sf_dir), 32, 8, F.col("ping_cnt"))


@query("WITH st AS (SELECT transect, chunk, (event_type = 'view')::INT + 2 * (dep_bin % 2) AS r, ping % 64 AS c, ping_cnt AS v FROM v_pings WHERE ping % 5 <> 0), sz AS (SELECT transect, chunk, max(c) + 1 AS size FROM st GROUP BY ALL), ws AS (SELECT transect, chunk, unnest(range(0, size, 24)) AS start FROM sz), al AS (SELECT transect, chunk, r, c, v FROM st UNION ALL SELECT transect, chunk - 1, r, c + 64, v FROM st) SELECT ws.transect, ws.chunk, ws.start, al.r, al.c - ws.start AS c, al.v FROM ws JOIN al ON al.transect = ws.transect AND al.chunk = ws.chunk AND al.c >= ws.start AND al.c < ws.start + 64")
def sonogram_window_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of windows over strips of four rows."""
    st = v.pings(spark, sf_dir).where("ping % 5 <> 0").select("transect", "chunk", ((F.col("event_type") == "view").cast("int") + 2 * (F.col("dep_bin") % 2)).alias("r"), (F.col("ping") % 64).alias("c"), F.col("ping_cnt").alias("v"))
    return sonogram.window_cells(st, 64, 24)


_DEPTHS = "rg AS (SELECT transect, ping, chunk, ping_cnt, dep_bin * 1.5::DOUBLE AS dep_m, 0.25::DOUBLE * (1 + transect % 3) AS pix FROM v_pings), fr AS (SELECT transect, arg_min(pix, ping) AS pix FROM rg GROUP BY transect), mp AS (SELECT transect, ping_cnt AS ping_max FROM (SELECT transect, ping_cnt, row_number() OVER (PARTITION BY transect ORDER BY count(*) DESC, ping_cnt) AS n FROM rg GROUP BY transect, ping_cnt) WHERE n = 1), md AS (SELECT transect, dep_m FROM (SELECT transect, dep_m, row_number() OVER (PARTITION BY transect ORDER BY count(*) DESC, dep_m) AS n FROM rg GROUP BY transect, dep_m) WHERE n = 1), dr AS (SELECT transect, ping_max, trunc(dep_m / pix)::BIGINT + 50 AS dep_max FROM mp JOIN md USING (transect) JOIN fr USING (transect))"


def _depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.pings(spark, sf_dir).withColumn("dep_m", F.col("dep_bin") * 1.5).withColumn("pixM", 0.25 * (1 + F.col("transect") % 3))
    return sonogram.depth_range(p)


@query(f"WITH {_DEPTHS} SELECT transect, ping_max, dep_max FROM dr")
def modal_depth_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _depths(spark, sf_dir)


@query(f"WITH {_DEPTHS}, st AS (SELECT transect, chunk AS c, ping % 64 AS r, ping_cnt AS v FROM v_pings), gr AS (SELECT transect, c, unnest(range(0, dep_max)) AS r FROM (SELECT DISTINCT transect, c FROM st) JOIN dr USING (transect)) SELECT gr.transect, gr.c, gr.r, coalesce(st.v, 0) AS v FROM gr LEFT JOIN st USING (transect, c, r)")
def fit_water_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strips (a column for each chunk) cut or filled to the depth range of their transect."""
    st = v.pings(spark, sf_dir).select("transect", F.col("chunk").alias("c"), (F.col("ping") % 64).alias("r"), F.col("ping_cnt").alias("v"))
    return sonogram.fit_height(st, _depths(spark, sf_dir), water_column=True)


@query(f"WITH {_DEPTHS}, g AS (SELECT transect, unnest(range(0, ping_max)) AS ping FROM dr) SELECT g.transect, g.ping, coalesce(p.ping_cnt, 0) AS ping_cnt FROM g LEFT JOIN v_pings p USING (transect, ping)")
def pad_trim_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each transect cut or padded to its modal range."""
    p = v.pings(spark, sf_dir).join(_depths(spark, sf_dir), "transect")
    return sonogram.pad_trim(p, F.col("ping_max"), ("transect",), "ping", "ping_cnt")


@query("SELECT transect, ping, 'img_' || printf('%05d', ping * 37) || '.jpg' AS name FROM v_pings")
def frame_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.pings(spark, sf_dir).select("transect", "ping", F.concat(F.lit("img_"), scalar.frame_number(F.col("ping") * 37), F.lit(".jpg")).alias("name"))


# Utilities

_STEM = "regexp_replace(regexp_extract(path, '[^/]*$'), '\\.[^.]*$', '')"
_MAPS = "mo AS (SELECT path FROM v_paths), ma AS (SELECT 'maps/' || regexp_extract(path, '[^/]*$') || '.shp' AS path FROM v_paths WHERE id % 3 = 0 UNION ALL SELECT 'maps/b/' || regexp_extract(path, '[^/]*$') || '.tif' FROM v_paths WHERE id % 6 = 0)"


def _maps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = v.paths(spark, sf_dir)
    base = scalar.basename(F.col("path"))
    one = p.where("id % 3 = 0").select(F.concat(F.lit("maps/"), base, F.lit(".shp")).alias("path"))
    two = p.where("id % 6 = 0").select(F.concat(F.lit("maps/b/"), base, F.lit(".tif")).alias("path"))
    return p.select("path"), one.union(two)


@query(f"WITH {_MAPS}, f AS (SELECT {_STEM} AS base, min(path) AS map FROM ma GROUP BY 1) SELECT path AS mosaic, map FROM mo LEFT JOIN f ON f.base = {_STEM}")
def pair_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairing.paired(*_maps(spark, sf_dir))


@query(f"WITH {_MAPS} SELECT path AS mosaic FROM mo WHERE {_STEM} NOT IN (SELECT {_STEM} FROM ma)")
def unmatched_mosaics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairing.unmatched(*_maps(spark, sf_dir))


@query(f"WITH {_MAPS} SELECT {_STEM} AS base, count(*)::BIGINT AS n FROM ma GROUP BY 1 HAVING count(*) > 1")
def duplicate_basenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairing.duplicates(_maps(spark, sf_dir)[1])


CONFIGS = (
    (1, '{"MY_CLASS_NAMES": {"01": "Fines", "2": "Sand", "x": "Other"}}'), (2, '{"id2label": {"0": "Fines", "1": "Sand"}}'), (3, '{"id2label": {"Fines": 0, "Sand": "1"}}'),
    (4, '{"label2id": {"Fines": 0, "Sand": 1}}'), (5, '{"MY_CLASS_NAMES": {}, "label2id": {"0": "Fines", "1": "Sand"}}'),
)
_FOUND = "(1, '1', 'Fines'), (1, '2', 'Sand'), " + ", ".join(f"({i}, '0', 'Fines'), ({i}, '1', 'Sand')" for i in (2, 3, 4, 5))


@query(f"SELECT * FROM (VALUES {_FOUND}) t(id, cls, name)")
def class_name_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.createDataFrame(list(CONFIGS), "id int, config string")
    return c.select("id", F.explode(scalar.class_names(F.col("config"))).alias("cls", "name"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN k WHEN event_id % 3 = 1 THEN k + 1 ELSE 224 END AS height, CASE WHEN event_id % 3 = 0 THEN k WHEN event_id % 3 = 1 THEN k + 2 ELSE 224 END AS width FROM (SELECT event_id, json_extract(props, '$.k')::INT AS k FROM events)")
def target_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes from configurations that name a side, a size or neither."""
    e = v.table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    config = F.when(F.col("event_id") % 3 == 0, F.format_string('{"image_size": %d}', "k")).when(F.col("event_id") % 3 == 1, F.format_string('{"TARGET_SIZE": [%d, %d, 3]}', F.col("k") + 1, F.col("k") + 2)).otherwise(F.lit("{}"))
    s = scalar.target_size(config)
    return e.select("event_id", s[0].alias("height"), s[1].alias("width"))


def _rgb(i: int) -> str:
    return "CASE (cls + 3) % 10 " + " ".join(f"WHEN {k} THEN {int(h[1 + 2 * i : 3 + 2 * i], 16)}" for k, h in enumerate(COLOURS)) + " END"


@query("SELECT r, c, " + ", ".join(f"CASE WHEN v = 0 THEN 0 ELSE {_rgb(i)} END AS {n}" for i, n in enumerate(("red", "green", "blue"))) + " FROM v_label_pixels")
def label_to_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rgb = scalar.label_colour(F.col("cls"), F.col("v") == 0, COLOURS, 3)
    return v.label_pixels(spark, sf_dir).select("r", "c", *(rgb[i].alias(n) for i, n in enumerate(("red", "green", "blue"))))


OVERLAY_IDS = {"none": 0, "urgent": 1, "high": 3, "medium": 2, "other": 7, "low": 4, "unset": -1}


def _overlay_sql(i: int) -> str:
    ranked = sorted(k for k in OVERLAY_IDS.values() if k > 0)
    cases = " ".join(f"WHEN {k} THEN {int(scalar.OVERLAY[n][1 + 2 * i : 3 + 2 * i], 16)}" for n, k in enumerate(ranked))
    return f"round(CASE WHEN cls > 0 THEN 0.5 * (v % 256) + 0.5 * CASE cls {cases} ELSE 0 END ELSE v % 256 END, 6)"


@query(f"SELECT r, c, {', '.join(f'{_overlay_sql(i)}::DOUBLE AS {n}' for i, n in enumerate(('red', 'green', 'blue')))} FROM v_label_pixels")
def overlay_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class colours half over the image."""
    p = v.label_pixels(spark, sf_dir).withColumn("rgb", scalar.overlay(F.col("v") % 256, F.col("cls"), OVERLAY_IDS))
    return p.select("r", "c", *(F.round(F.col("rgb")[i], 6).alias(n) for i, n in enumerate(("red", "green", "blue"))))


@query("SELECT fid, CASE WHEN a < b THEN a END AS x_min, CASE WHEN a < b THEN b END AS x_max FROM (SELECT fid, x_min AS a, x_max - fid % 13 AS b FROM v_features)")
def box_from_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = scalar.box(F.col("x_min"), F.col("y_min"), F.col("x_max") - F.col("fid") % 13, F.col("y_max"))
    return v.features(spark, sf_dir).select("fid", b["x_min"].alias("x_min"), b["x_max"].alias("x_max"))


@query("SELECT r, c, round(1000 + c * 0.25, 6) AS x, round(5000 - r * 0.5, 6) AS y, c AS col, r AS row FROM v_pixels")
def affine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v.pixels(spark, sf_dir).withColumn("x", 1000 + F.col("c") * 0.25).withColumn("y", 5000 - F.col("r") * 0.5)
    return p.select("r", "c", _six("x"), _six("y"), F.floor((F.col("x") - 1000) / 0.25).alias("col"), F.floor((5000 - F.col("y")) / 0.5).alias("row"))


def _utm_sql() -> str:
    """Transverse Mercator by the third-order series in the third flattening, in SQL."""
    steps = f"c AS (SELECT fid, lon, lat, sqrt(f * (2 - f)) AS e, f / (2 - f) AS n FROM (SELECT fid, radians(x_min / 100 - 87.5) AS lon, radians(y_min / 100 + 33) AS lat, 1 / 298.257223563::DOUBLE AS f FROM v_features))"
    steps += ", d AS (SELECT *, 6378137.0::DOUBLE / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) AS r, sinh(atanh(sin(lat)) - e * atanh(e * sin(lat))) AS t, lon - radians(-87) AS dl FROM c)"
    steps += ", g AS (SELECT *, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + t * t)) AS et, n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 AS a1, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 AS a2, 61 * n ** 3 / 240 AS a3 FROM d)"
    x = " + ".join(f"a{j} * cos({2 * j} * xi) * sinh({2 * j} * et)" for j in (1, 2, 3))
    y = " + ".join(f"a{j} * sin({2 * j} * xi) * cosh({2 * j} * et)" for j in (1, 2, 3))
    return f"WITH {steps} SELECT fid, round(500000 + 0.9996::DOUBLE * r * (et + {x}), 4) AS x, round(0.9996::DOUBLE * r * (xi + {y}), 4) AS y, round(degrees(lon), 7) AS lon, round(degrees(lat), 7) AS lat FROM g"


@query(_utm_sql())
def reproject_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features to UTM zone 16 north and back."""
    f = v.features(spark, sf_dir).select("fid", (F.col("x_min") / 100 - 87.5).alias("lon"), (F.col("y_min") / 100 + 33).alias("lat"))
    x, y = crs.reproject(F.col("lon"), F.col("lat"), 4326, 32616)
    f = f.withColumn("x", x).withColumn("y", y)
    lon, lat = crs.reproject(F.col("x"), F.col("y"), 32616, 4326)
    return f.select("fid", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


# Rasters in another coordinate system

_WARP_META = ("part", -87.5, 34.25, 0.0125, 0.01)
_SRC = f"src AS (SELECT (max(c) + 1)::BIGINT AS w, (max(r) + 1)::BIGINT AS h FROM v_pixels), box AS (SELECT w, h, 6378137.0::DOUBLE * radians({_WARP_META[1]}::DOUBLE) AS x0, 6378137.0::DOUBLE * radians({_WARP_META[1]} + w * {_WARP_META[3]}::DOUBLE) AS x1, 6378137.0::DOUBLE * ln(tan(radians({_WARP_META[2]}::DOUBLE) / 2 + pi() / 4)) AS y0, 6378137.0::DOUBLE * ln(tan(radians({_WARP_META[2]} - h * {_WARP_META[4]}::DOUBLE) / 2 + pi() / 4)) AS y1 FROM src), grid AS (SELECT w, h, x0, y0, x1, y1, greatest(1, round_even((x1 - x0) / 1500, 0)::BIGINT) AS tw, greatest(1, round_even((y0 - y1) / 1500, 0)::BIGINT) AS th FROM box)"
_AT = f"spot AS (SELECT r, c, w, h, (degrees((x0 + (c + 0.5::DOUBLE) * (x1 - x0) / tw) / 6378137.0) - ({_WARP_META[1]}::DOUBLE)) / {_WARP_META[3]}::DOUBLE AS u, ({_WARP_META[2]}::DOUBLE - degrees(2 * atan(exp((y0 - (r + 0.5::DOUBLE) * (y0 - y1) / th) / 6378137.0)) - pi() / 2)) / {_WARP_META[4]}::DOUBLE AS q FROM (SELECT *, unnest(range(0, tw)) AS c FROM (SELECT *, unnest(range(0, th)) AS r FROM grid)))"
_INSIDE = "u >= 0 AND u < w AND q >= 0 AND q < h"


def _warp_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = v.pixels(spark, sf_dir).groupBy("raster_id").agg((F.max("c") + 1).alias("width"), (F.max("r") + 1).alias("height"))
    return size.select("raster_id", *(F.lit(x).alias(n) for x, n in zip(_WARP_META[1:], ("x0", "y0", "res_x", "res_y"))), "width", "height")


def _warped(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    meta = _warp_meta(spark, sf_dir)
    return warp.warp(v.pixels(spark, sf_dir), meta, warp.target_grid(meta, 4326, 3857, 1500), 4326, 3857, method=method, nodata=0).drop("band")


@query(f"WITH {_SRC} SELECT 'part' AS raster_id, round(x0, 3) AS x0, round(y0, 3) AS y0, round((x1 - x0) / tw, 6) AS res_x, round((y0 - y1) / th, 6) AS res_y, tw AS width, th AS height FROM grid")
def warp_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Mercator grid, in cells of about 1500 m, of a raster in degrees."""
    g = warp.target_grid(_warp_meta(spark, sf_dir), 4326, 3857, 1500)
    return g.select("raster_id", F.round("x0", 3).alias("x0"), F.round("y0", 3).alias("y0"), _six("res_x"), _six("res_y"), "width", "height")


@query(f"WITH {_SRC}, {_AT} SELECT 'part' AS raster_id, spot.r, spot.c, v::DOUBLE AS v FROM spot JOIN v_pixels p ON p.r = floor(q) AND p.c = floor(u) WHERE v <> 0 AND {_INSIDE}")
def warp_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _warped(spark, sf_dir, "nearest")


@query(f"WITH {_SRC}, {_AT}, nr AS (SELECT r, c, floor(q - 0.5) + i AS pr, floor(u - 0.5) + j AS pc, abs(1 - i - (q - 0.5 - floor(q - 0.5))) * abs(1 - j - (u - 0.5 - floor(u - 0.5))) AS k FROM spot, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j) WHERE {_INSIDE}) SELECT 'part' AS raster_id, nr.r, nr.c, round(sum(k * v) / sum(k), 6) AS v FROM nr JOIN v_pixels p ON p.r = pr AND p.c = pc WHERE v <> 0 AND k > 0 GROUP BY nr.r, nr.c")
def warp_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _warped(spark, sf_dir, "bilinear").withColumn("v", _six("v"))


# Polygons: diamonds in the boxes of the map, every other one with a hole of half its size

_DIAMOND = "dm AS (SELECT fid, class_name, (x_min + x_max) / 2 AS xm, (y_min + y_max) / 2 AS ym, (x_max - x_min) / 2 AS a, (y_max - y_min) / 2 AS b FROM v_features)"
_PARTS = "part_ AS (SELECT fid, class_name, xm, ym, a, b, 1 AS sg FROM dm UNION ALL SELECT fid, class_name, xm, ym, a / 2, b / 2, -1 FROM dm WHERE fid % 2 = 0)"


def _polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = v.features(spark, sf_dir)
    xm, ym = (F.col("x_min") + F.col("x_max")) / 2, (F.col("y_min") + F.col("y_max")) / 2
    a, b = (F.col("x_max") - F.col("x_min")) / 2, (F.col("y_max") - F.col("y_min")) / 2

    def diamond(k: float, way: int) -> Column:
        return F.array(F.array(xm, ym - b * k), F.array(xm + a * k * way, ym), F.array(xm, ym + b * k), F.array(xm - a * k * way, ym))

    return f.select("fid", "class_name", F.when(F.col("fid") % 2 == 0, F.array(diamond(1, 1), diamond(0.5, -1))).otherwise(F.array(diamond(1, 1))).alias("rings"))


def _corner(x: str, y: str) -> str:
    """Area of a diamond between its centre and a corner, signed by the quadrant."""
    u, w = f"least(abs({x} - xm), a)", f"least(abs({y} - ym), b)"
    return f"(sign({x} - xm) * sign({y} - ym) * ({u} * {w} - greatest(0, {u} / a + {w} / b - 1) ** 2 * a * b / 2))"


_CUT = f"sg * ({_corner('w.x_max', 'w.y_max')} - {_corner('w.x_min', 'w.y_max')} - {_corner('w.x_max', 'w.y_min')} + {_corner('w.x_min', 'w.y_min')})"


@query(f"WITH {_LW}, {_DIAMOND}, {_PARTS}, cut AS (SELECT win_id, fid, class_name, sum({_CUT}) AS area FROM win w, part_ GROUP BY ALL) SELECT win_id, fid, class_name, round(area, 6) AS area FROM cut WHERE area > 1e-9")
def label_clip_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of polygons with holes in windows."""
    c = polygons.clip_areas(_label_windows(spark), _polygons(spark, sf_dir), float(LABEL_WS)).where("area > 1e-9")
    return c.select("win_id", "fid", "class_name", _six("area"))


_EDGES = "ed AS (SELECT fid, class_name, unnest([[xm, ym - b, xm + a, ym], [xm + a, ym, xm, ym + b], [xm, ym + b, xm - a, ym], [xm - a, ym, xm, ym - b]]) AS e FROM part_)"


@query(f"WITH {_DIAMOND}, {_PARTS}, {_EDGES}, ct AS (SELECT fid, {_IDS} AS value, c, unnest(range(floor(ym - b)::BIGINT, ceil(ym + b)::BIGINT)) AS r FROM (SELECT *, unnest(range(floor(xm - a)::BIGINT, ceil(xm + a)::BIGINT)) AS c FROM dm) WHERE {_IDS} IS NOT NULL), hit AS (SELECT ct.fid, value, r, c FROM ct JOIN ed ON ed.fid = ct.fid AND ((e[2] <= r + 0.5) <> (e[4] <= r + 0.5)) AND e[1] + (r + 0.5 - e[2]) / (e[4] - e[2]) * (e[3] - e[1]) <= c + 0.5 GROUP BY ALL HAVING count(*) % 2 = 1) SELECT r, c, arg_max(value, fid) AS value FROM hit GROUP BY r, c")
def rasterize_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygons.burn(_polygons(spark, sf_dir), scalar.crosswalk(F.col("class_name"), v.FEATURE_IDS))


@query(f"WITH {_DIAMOND}, {_PARTS} SELECT fid, round(sum(sg * 2 * a * b), 6) AS area FROM part_ GROUP BY fid")
def polygon_wkt_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas after the polygons were written as text and read back."""
    p = _polygons(spark, sf_dir).select("fid", polygons.from_wkt(polygons.to_wkt(F.col("rings"))).alias("rings"))
    return p.select("fid", F.round(polygons.ring_area(), 6).alias("area"))


@query(f"WITH {_DIAMOND}, {_PARTS}, pt AS (SELECT fid, sg, unnest([xm, xm + a, xm, xm - a]) AS x, unnest([ym - b, ym, ym + b, ym]) AS y, unnest([0, 1, 2, 3]) AS k FROM part_) SELECT fid, CASE WHEN sg > 0 THEN 0 ELSE 1 END AS part, CASE WHEN sg > 0 THEN k ELSE (4 - k) % 4 END AS point, round(6378137.0::DOUBLE * radians(x / 10), 3) AS x, round(6378137.0::DOUBLE * ln(tan(radians(y / 10) / 2 + pi() / 4)), 3) AS y FROM pt")
def reproject_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p[0] / 10, p[1] / 10)))
    p = polygons.reprojected(_polygons(spark, sf_dir).select("fid", scaled.alias("rings")), 4326, 3857)
    p = p.select("fid", F.posexplode("rings").alias("part", "ring")).select("fid", "part", F.posexplode("ring").alias("point", "p"))
    return p.select("fid", "part", "point", F.round(F.col("p")[0], 3).alias("x"), F.round(F.col("p")[1], 3).alias("y"))


@query(f"{_LAB4} SELECT comp AS patch_id, cls AS substrate, CASE cls WHEN 1 THEN 'Fines' WHEN 2 THEN 'Sand' WHEN 4 THEN 'Boulder' ELSE cls::VARCHAR END AS name, count(*)::DOUBLE * 0.5 AS area_m, count(*)::DOUBLE * 0.5 AS ring_area FROM lab WHERE cls <> 0 GROUP BY comp, cls")
def map_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches of a class raster as polygons in map units, with the area that their rings enclose."""
    m = workflow.vector_map(v.label_pixels(spark, sf_dir).select("r", "c", "cls"), NAMES, pixel=(1.0, 0.5), left=10.0, top=20.0)
    return m.select("patch_id", "substrate", "name", "area_m", F.round(polygons.ring_area(), 6).alias("ring_area"))


CODES = {"fines": "1", "sand": "two", "Gravel": " 3 ", "boulder": "+4", "mask": "", "shadow": "5"}


@query("SELECT fid, class_name, CASE WHEN class_name = 'Gravel' THEN 3 ELSE " + "CASE lower(trim(class_name)) WHEN 'fines' THEN 1 WHEN 'boulder' THEN 4 WHEN 'shadow' THEN 5 END END AS value FROM v_features")
def class_crosswalk_coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class numbers given as text; those that are none give null."""
    return v.features(spark, sf_dir).select("fid", "class_name", scalar.crosswalk(F.col("class_name"), CODES).alias("value"))


@query("WITH t AS (SELECT vec_id, 'tiles/x/img_' || vec_id || CASE WHEN vec_id % 2 = 0 THEN '.png' ELSE '.png.tif' END AS tile FROM embeddings), n AS (SELECT 'img_' || vec_id AS base, 4 AS classes, embedding AS t FROM embeddings WHERE vec_id % 3 <> 0) SELECT vec_id, tile, classes, len(n.t)::INT AS numbers FROM t JOIN n ON n.base = 'img_' || vec_id")
def tile_tensor_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles with the probabilities in the file of their name."""
    e = v.table(spark, sf_dir, "embeddings")
    name = F.concat(F.lit("tiles/x/img_"), F.col("vec_id").cast("string"), F.when(F.col("vec_id") % 2 == 0, ".png").otherwise(".png.tif"))
    found = e.where("vec_id % 3 <> 0").select(F.concat(F.lit("img_"), F.col("vec_id").cast("string")).alias("base"), F.lit(4).alias("classes"), F.lit(4).alias("height"), F.lit(4).alias("width"), F.col("embedding").alias("t"))
    return pairing.with_tensors(e.select("vec_id", name.alias("tile")), found).select("vec_id", "tile", "classes", F.size("t").alias("numbers"))
