"""Edge rules on literal grids, worked out by hand."""

import io
import json
import math
import struct
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.functions import crs, scalar
from gridloom.operators import coco, coverage, labels, mosaic, pairing, polygons, regions, sonogram, spatial, state, tensors, warp, windows
from gridloom.plans import workflow
from gridloom.sources import files, jpeg, sinks, tiff
from gridloom.streaming.coverage import coverage_stream


def rows(df):
    return sorted(map(tuple, df.collect()))


def grid(spark, text, name="cls"):
    lines = [x.strip() for x in text.strip().splitlines()]
    return spark.createDataFrame([(r, c, int(v)) for r, x in enumerate(lines) for c, v in enumerate(x)], f"r long, c long, {name} int")


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_half_even_and_names(spark):
    assert [value(spark, scalar.half_even(F.lit(x))) for x in (2.5, 3.5, -0.5, 1.4)] == [2, 4, 0, 1]
    assert [value(spark, scalar.frame_number(F.lit(n))) for n in (7, 123456)] == ["00007", "123456"]
    assert value(spark, scalar.tile_name(F.lit("o"), F.lit("m"), F.lit(12), *(F.lit(x) for x in (0.5, 1.5, 2.5, 3.5)))) == "o_m_12m_0_2_2_4"
    assert value(spark, scalar.stem(F.lit("a/b.c/d.tar.tif"))) == "d.tar"
    assert value(spark, scalar.hex_colour(F.lit("#FF00a0"))) == [255, 0, 160]


def test_windows(spark):
    meta = spark.createDataFrame([("a", 0.0, 10.0, 1.0, 1.0, 10, 10)], "raster_id string, x0 double, y0 double, res_x double, res_y double, width long, height long")
    assert {r["col"] for r in windows.raster_windows(meta, 4, 5).collect()} == {0, 5, 10}
    assert {r["col"] for r in windows.raster_windows(meta, 4, 6).collect()} == {0, 6, 12}
    assert {r["col"] for r in windows.raster_windows(meta, 4, 6, overshoot=False).collect()} == {0, 6}
    assert windows.raster_windows(meta, 2.5, 0.2).where("col = 1").count() > 0  # a stride of at least one pixel
    box = spark.createDataFrame([(0.0, 0.0, 8.0, 8.0)], "x_min double, y_min double, x_max double, y_max double")
    assert {r["x_min"] for r in windows.extent_windows(box, (4, 4), 4).collect()} == {0, 4, 8}
    assert {r["x_min"] for r in windows.extent_windows(box, (4, 4), 4, full_only=True).collect()} == {0, 4}
    with pytest.raises(ValueError):
        windows.extent_windows(box, (4, 4), 0)


def test_coverage(spark):
    p = spark.createDataFrame([("a", r, c, float(v)) for r, line in enumerate(["1100", "1000", "0000", "0009"]) for c, v in enumerate(line)], "raster_id string, r long, c long, v double")
    kept = {(x["wr"], x["wc"]): x["nonzero_prop"] for x in coverage.tile_coverage(p, 2, 2, 0.75).collect()}
    assert kept == {(0, 0): 0.75}  # exactly at the limit
    assert rows(coverage.tile_coverage(p, 3, 2, 0.2).select("wr", "wc", "total_pix", "nonzero")) == [(0, 0, 9, 3), (2, 2, 4, 1)]  # cut at the edge: 4 pixels
    both = [rows(windows.window_sums(p, ws, s, {"n": F.lit(1), "v": F.col("v").cast("long")})) for ws, s in ((2, 2), (4, 2))]
    dealt = [rows(windows.assign(p, ws, s).groupBy("raster_id", "wr", "wc").agg(F.count("*"), F.sum("v").cast("long"))) for ws, s in ((2, 2), (4, 2))]
    assert both == dealt
    nan = p.withColumn("v", F.when(F.col("c") == 0, F.lit(float("nan"))).when(F.col("c") == 1, F.lit(None)).otherwise(F.lit(0.0)))
    assert coverage.tile_coverage(nan, 2, 2, 0.0).count() == 2  # no valid pixel on the left
    assert coverage.tile_coverage(p.where("false"), 2, 2, 0.5).count() == 0
    assert rows(coverage.reclassify(spark.createDataFrame([(1,), (2,)], "v int"), {1: 9})) == [(2,), (9,)]


def test_boxes(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0), (2, -5.0, -5.0, 9.0, 9.0)], "k int, x_min double, y_min double, x_max double, y_max double")
    b = spark.createDataFrame([(7, 2.0, 0.0, 4.0, 2.0), (8, 1.0, 1.0, 8.0, 8.0)], "k int, x_min double, y_min double, x_max double, y_max double")
    pairs = lambda strict, cell: rows(spatial.box_join(a, b, cell, strict=strict).select("a_k", "b_k"))
    for cell in (1.0, 3.0, 100.0):
        assert pairs(True, cell) == [(1, 8), (2, 7), (2, 8)] and pairs(False, cell) == [(1, 7), (1, 8), (2, 7), (2, 8)]
    assert value(spark, scalar.box(F.lit(1), F.lit(1), F.lit(1), F.lit(2))) is None
    cells = spark.createDataFrame([(0, 0)], "cx long, cy long")
    assert rows(spatial.buffered(cells, 1)) == [(-1, 0), (0, -1), (0, 0), (0, 1), (1, 0)]
    w = spark.createDataFrame([(1, 4.0, 0.0, 5.0, 1.0), (2, 4.1, 0.0, 5.0, 1.0)], "win_id int, x_min double, y_min double, x_max double, y_max double")
    assert [x["win_id"] for x in spatial.in_footprint(w, cells, 4.0).collect()] == [1]


@pytest.mark.parametrize("allow", [False, True])
def test_accept_matrix(spark, allow):
    w = spark.createDataFrame([(i,) for i in range(5)], "win_id int")
    clipped = spark.createDataFrame([(1, 0, "mask", 50.0), (2, 0, "Sand", 9.0), (3, 0, " sand", 10.0), (4, 0, "nothing", 90.0)], "win_id int, fid int, class_name string, area double")
    got = {x["win_id"]: x["outcome"] for x in labels.accept(w, labels.window_areas(clipped, {"sand": 1, "mask": 255}), 100.0, 0.1, allow).collect()}
    other = "empty" if allow else "reject"
    assert got == {0: other, 1: other, 2: other, 3: "label", 4: other}


def test_fractions_and_burning(spark):
    clipped = spark.createDataFrame([(1, "a", 30.0), (1, None, 60.0), (1, "b", 10.0)], "win_id int, class_name string, area double")
    assert rows(labels.class_fractions(clipped)) == [(1, "a", 0.3), (1, "b", 0.1)]
    f = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 1.0), (2, 1.0, 0.0, 3.0, 1.0), (3, 0.6, 0.0, 1.4, 1.0)], "fid int, x_min double, y_min double, x_max double, y_max double")
    assert rows(labels.burn(f, F.col("fid"))) == [(0, 0, 1), (0, 1, 2), (0, 2, 2)]


def test_tensors(spark):
    p = spark.createDataFrame([(1, 0, 0.3), (1, 1, 0.7), (1, 2, 0.7), (2, 0, 0.0), (2, 1, 0.0)], "k int, cls int, p double")
    assert rows(tensors.argmax(p, ("k",))) == [(1, 1), (2, 0)]
    t = spark.createDataFrame([(5, 0.0, 0.0, 2.0, 2.0, [float(i) for i in range(8)])], "tile_id int, x_min double, y_min double, x_max double, y_max double, t array<double>")
    w = spark.createDataFrame([(9, 0.0, 0.0, 2.0, 2.0), (8, 1.0, 1.0, 3.0, 3.0)], "win_id int, x_min double, y_min double, x_max double, y_max double")
    got = {tuple(x)[:4]: x["p"] for x in tensors.overlap_mean(w, t, 2, (2, 2), 2.0).collect()}
    assert [got[(9, k, r, c)] for k in (0, 1) for r in (0, 1) for c in (0, 1)] == [float(i) for i in range(8)]  # one tile: itself
    assert got[(8, 0, 1, 0)] == 1.0 and got[(8, 0, 0, 0)] == 0.0  # only its lower left is covered
    s = value(spark, tensors.softmax(F.array(F.lit(1000.0), F.lit(1000.0))))
    assert s == [0.5, 0.5]
    assert [value(spark, tensors.channel_axis(*map(F.lit, d))) for d in ((4, 9, 9), (9, 9, 4), (9, 4, 9), (99, 99, 99), (4, 4, 4))] == [0, 2, 1, -1, 2]
    flat = spark.createDataFrame([(1, [7.0] * 16)], "k int, t array<double>")
    assert tensors.resize_antialias(flat, "k", (4, 4), (2, 3)).first()["t"] == [7] * 6


def test_mosaic(spark):
    r = spark.createDataFrame([(0, 0, 5, 1), (0, 0, 0, 2), (0, 1, 5, 1), (0, 1, 6, 2), (0, 2, 0, 1)], "r int, c int, v int, ord int")
    assert rows(mosaic.last_wins(r)) == [(0, 0, 5), (0, 1, 6), (0, 2, 0)]
    s = lambda *x: tuple(value(spark, scalar.out_shape(*map(F.lit, x))))
    assert s(10.0, 5.0, 2.0, 1e6) == (5, 2) and s(1000.0, 1000.0, 1.0, 10000.0) == (100, 100) and s(0.1, 0.1, 1.0, 10.0) == (1, 1)


def flood_fill(lines, eight):
    cells = {(r, c): v for r, x in enumerate(lines) for c, v in enumerate(x)}
    out = {}
    for p in sorted(cells):
        if p in out:
            continue
        todo = [p]
        out[p] = p
        while todo:
            r, c = todo.pop()
            for a in (-1, 0, 1):
                for b in (-1, 0, 1):
                    q = (r + a, c + b)
                    if (eight or a * b == 0) and q not in out and cells.get(q) == cells[p]:
                        out[q] = p
                        todo.append(q)
    return out


@pytest.mark.parametrize("connectivity", [4, 8])
def test_components_across_blocks(spark, connectivity):
    r = np.random.default_rng(connectivity)
    lines = ["".join(map(str, x)) for x in r.integers(0, 3, (23, 31))]
    lines[11] = "1" * 31
    got = regions.components(grid(spark, "\n".join(lines)), connectivity=connectivity, background=None, block=5)
    want = flood_fill(lines, connectivity == 8)
    assert {(x["r"], x["c"]): divmod(x["comp"], 1 << 31) for x in got.collect()} == want
    assert regions.components(grid(spark, "0")).count() == 0


def test_clean_up(spark):
    g = grid(spark, "11100\n10102\n11100\n00000")
    lab = regions.components(g)
    assert rows(regions.sizes(lab).select("cls", "size")) == [(1, 8), (2, 1)]
    assert regions.without_small(lab, 8).count() == 8 and regions.without_small(lab, 9).count() == 0  # exactly min_size stays
    assert regions.without_small(regions.components(grid(spark, "2")), 9).count() == 1  # a region alone stays
    filled = regions.fill_holes(g.withColumn("cls", (F.col("cls") > 0).cast("int")), 2)
    assert filled.where("r = 1 and c = 1").first()["cls"] == 1 and filled.where("cls = 1").count() == 10
    out = {(x["r"], x["c"]): x["cls"] for x in regions.clean_labels(g, 2).collect()}
    assert out[(1, 1)] == 1 and out[(1, 4)] == 0


def test_dissolve(spark):
    # A (1 px) touches B (2 px) touches C (large): everything ends in C; a lone patch stays
    lab = regions.components(grid(spark, "1223333\n0000000"), connectivity=4)
    out = rows(regions.dissolve(lab, 3.0).select("cls", "area"))
    assert out == [(3, 7.0)]
    lone = regions.components(grid(spark, "100\n000"), connectivity=4)
    assert rows(regions.dissolve(lone, 5.0).select("cls", "area")) == [(1, 1.0)]
    r = np.random.default_rng(0)
    noise = regions.components(grid(spark, "\n".join("".join(map(str, x)) for x in r.integers(1, 4, (20, 20)))), connectivity=4)
    assert sum(x["area"] for x in regions.dissolve(noise, 6.0).collect()) == 400


def area(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]]))) / 2


def test_simplify(spark):
    lab = regions.components(grid(spark, "11\n12"), connectivity=4, background=None)
    rings = {x["comp"]: x["ring"] for x in regions.simplify(regions.rings(lab), 0.1).collect()}
    assert sorted(map(area, rings.values())) == [1.0, 3.0]
    assert regions.thinned([(0, 0), (1, 0), (2, 0), (2, 2)], 0.5) == [(0, 0), (2, 0), (2, 2)]


@pytest.mark.parametrize("block", [4, 256])
def test_outlines_cover_the_raster(spark, block):
    """Whatever the blocks, rings enclose the pixels of their region, and thinned borders are the same on both sides."""
    r = np.random.default_rng(5)
    a = r.integers(0, 3, (9, 14))
    a[2:7, 3:11] = 1
    a[4, 5] = a[4, 8] = 2
    lab = regions.components(grid(spark, "\n".join("".join(map(str, x)) for x in a)), connectivity=4, background=None).cache()
    size = {x["comp"]: x["size"] for x in regions.sizes(lab).collect()}
    exact = defaultdict(float)
    for x in regions.simplify(regions.rings(lab), 1e-9, block).collect():
        assert x["hole"] == (x["part"] > 0) or not x["hole"]
        exact[x["comp"]] += -area(x["ring"]) if x["hole"] else area(x["ring"])
    assert exact == size
    sides = Counter()
    for x in regions.simplify(regions.rings(lab), 1.2, block).collect():
        for p, q in zip(x["ring"], [*x["ring"][1:], x["ring"][0]]):
            sides[tuple(sorted((tuple(p), tuple(q))))] += 1
    rim = lambda e: e[0] in (0, 14) or e[1] in (0, 9)
    assert all(n % 2 == 0 or (rim(p[0]) and rim(p[1])) for p, n in sides.items())


def test_flood_far_and_merge_at_a_distance(spark):
    wide = grid(spark, "1" + "0" * 80)
    got = regions.flood(wide.where("cls = 1"), wide)
    assert got.where("cls = 1").count() == 81
    apart = regions.components(grid(spark, "1002222\n0000000"), connectivity=4)
    assert rows(regions.dissolve(apart, 2.0).select("cls", "area")) == [(1, 1.0), (2, 4.0)]
    assert rows(regions.dissolve(apart, 2.0, reach=1.5).select("cls", "area")) == [(1, 1.0), (2, 4.0)]
    assert rows(regions.dissolve(apart, 2.0, reach=2.0).select("cls", "area")) == [(2, 5.0)]


def test_checkpoint_folder():
    def session(setting, context, master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: setting), sparkContext=SimpleNamespace(getCheckpointDir=lambda: context, master=master))

    assert state.checkpoint_dir(session("s3://a/b/", "file:/c", "yarn")) == "s3://a/b"
    assert state.checkpoint_dir(session(None, "file:/c", "yarn")) == "file:/c"
    assert state.checkpoint_dir(session(None, None, "local[3]")) == state.LOCAL_DEFAULT
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            state.checkpoint_dir(session(None, None, master))


def test_numbers(spark):
    df = spark.createDataFrame([(i * 7 % 50, str(i)) for i in range(50)], "k long, x string").repartition(7)
    assert sorted(map(tuple, state.numbered(df, "k", first=1).select("k", "n").collect())) == [(i, i + 1) for i in range(50)]
    assert state.numbered(df.where("false"), "k").count() == 0


def test_polygons(spark):
    """A U and a square with a hole, cut by boxes and burnt."""
    u = [[[0.0, 0.0], [6.0, 0.0], [6.0, 6.0], [4.0, 6.0], [4.0, 2.0], [2.0, 2.0], [2.0, 6.0], [0.0, 6.0], [0.0, 0.0]]]
    ring = [[[10.0, 0.0], [10.0, 4.0], [14.0, 4.0], [14.0, 0.0]], [[11.0, 1.0], [13.0, 1.0], [13.0, 3.0], [11.0, 3.0]]]
    f = spark.createDataFrame([(1, "u", u), (2, "ring", ring), (3, "none", [])], "fid int, class_name string, rings array<array<array<double>>>")
    assert {x["fid"]: x["a"] for x in f.select("fid", polygons.ring_area().alias("a")).collect()} == {1: 28.0, 2: 12.0, 3: 0.0}
    w = spark.createDataFrame([(7, 1.0, 1.0, 5.0, 5.0), (8, 12.0, 0.0, 20.0, 20.0), (9, 2.0, 3.0, 4.0, 5.0), (10, -50.0, -50.0, 50.0, 50.0)], "win_id int, x_min double, y_min double, x_max double, y_max double")
    got = {(x["win_id"], x["fid"]): x["area"] for x in polygons.clip_areas(w, f, 30.0).collect()}
    assert got == {(7, 1): 10.0, (8, 2): 6.0, (10, 1): 28.0, (10, 2): 12.0}
    burnt = {(x["r"], x["c"]) for x in polygons.burn(f, F.col("fid")).collect()}
    inside = lambda x, y: (0 < x < 6 and 0 < y < 6 and not (2 < x < 4 and y > 2)) or (10 < x < 14 and 0 < y < 4 and not (11 < x < 13 and 1 < y < 3))
    assert burnt == {(r, c) for r in range(8) for c in range(16) if inside(c + 0.5, r + 0.5)}
    flipped = {(x["r"], x["c"]) for x in polygons.burn(f, F.col("fid"), 0.0, 8.0, (1.0, 1.0)).collect()}
    assert flipped == {(7 - r, c) for r, c in burnt}
    text = {x["fid"]: x["t"] for x in f.select("fid", polygons.to_wkt(F.col("rings")).alias("t")).collect()}
    assert text[3] == "POLYGON EMPTY" and text[2].startswith("POLYGON ((10.0 0.0, ")
    parse = lambda t: spark.range(1).select(polygons.from_wkt(F.lit(t)).alias("x")).first()["x"]
    assert parse("POINT (1 2)") is None and parse("POLYGON ((0 0, 1 x, 2 2))") is None and len(parse("multipolygon (((0 0, 1 0, 1 1)), ((5 5, 6 5, 6 6)))")) == 2
    hole = spark.range(1).select(polygons.inside(F.array(F.lit(12.0), F.lit(2.0)), F.array(*(F.array(*map(F.lit, p)) for p in ring[0]))).alias("x"))
    assert hole.first()["x"] is True


def test_warp(spark):
    meta = spark.createDataFrame([("a", 0.0, 3.0, 1.0, 1.0, 4, 3)], "raster_id string, x0 double, y0 double, res_x double, res_y double, width long, height long")
    p = spark.createDataFrame([("a", 1, r, c, float(10 * r + c)) for r in range(3) for c in range(4) if (r, c) != (1, 1)], "raster_id string, band int, r long, c long, v double")
    same = warp.warp(p, meta, meta, 4326, 4326)
    assert rows(same.select("r", "c", "v")) == sorted((r, c, float(10 * r + c)) for r in range(3) for c in range(4) if (r, c) != (1, 1))
    half = spark.createDataFrame([("a", 0.0, 3.0, 2.0, 1.5, 2, 2)], meta.schema)
    near = {(x["r"], x["c"]): x["v"] for x in warp.warp(p, meta, half, 4326, 4326, method="nearest").collect()}
    assert near == {(0, 0): 1.0, (0, 1): 3.0, (1, 0): 21.0, (1, 1): 23.0}
    smooth = {(x["r"], x["c"]): x["v"] for x in warp.warp(p, meta, half, 4326, 4326, nodata=0).collect()}
    # Centre (1, 2.25): rows 0 and 1 weigh 3/4 and 1/4, columns 0 and 1 the same; (1, 1) is missing, (0, 0) no data
    assert math.isclose(smooth[(0, 0)], (1 * 0.375 + 10 * 0.125) / 0.5) and math.isclose(smooth[(0, 1)], (2.5 * 0.75 + 12.5 * 0.25))
    assert warp.warp(p, meta, half, 4326, 4326, nodata=0, whole=True).where("r = 0 and c = 1").first()["v"] == 5.0
    assert warp.target_grid(meta, 4326, 4326).select("x0", "y0", "width", "height").first() == (0.0, 3.0, 4, 3)
    far = meta.withColumn("x0", F.col("x0") + 0.3)
    assert tuple(warp.target_grid(far, 4326, 4326, 0.5, aligned=True).first())[1:] == (0.0, 3.0, 0.5, 0.5, 9, 6)
    assert warp.target_grid(meta, 4326, 4326, 0.001, max_pixels=12).select("width", "height").first() == (4, 3)
    utm = warp.target_grid(meta.withColumn("y0", F.lit(33.0)), 4326, 32631).first()
    assert utm["width"] >= 3 and 80_000 < utm["res_x"] < 130_000
    with pytest.raises(ValueError):
        warp.warp(p, meta, half, 4326, 4326, method="cubic")


def lzw(data):
    """TIFF's LZW, one code early."""
    out, bits, held = bytearray(), 0, 0

    def put(code, width):
        nonlocal bits, held
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
            held &= (1 << bits) - 1

    table, width = {bytes([i]): i for i in range(256)}, 9
    put(256, 9)
    at = b""
    for i in range(len(data)):
        x = data[i : i + 1]
        if at + x in table:
            at += x
            continue
        put(table[at], width)
        table[at + x] = len(table) + 2
        n = len(table) + 2
        if n == 4094:
            put(256, 12)
            table, width = {bytes([i]): i for i in range(256)}, 9
        else:
            width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
        at = x
    if at:
        put(table[at], width)
        n = len(table) + 3
        width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
    put(257, width)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


def test_lzw():
    r = np.random.default_rng(3)
    for data in (b"", b"a", b"aaaaaaaaaa" * 50, bytes(r.integers(0, 256, 20_000, dtype=np.uint8)), bytes(r.integers(0, 3, 50_000, dtype=np.uint8))):
        assert tiff.unlzw(lzw(data)) == data


def by_hand(a, *, order="<", big=False, tile=None, predictor=1, epsg=None):
    """An LZW file of (bands, rows, columns) with bands apart, in strips of two rows or in tiles."""
    import struct

    n, h, w = a.shape
    th, tw = tile or (2, w)
    parts = []
    for band in a:
        for r in range(0, h, th):
            for c in range(0, w, tw):
                part = np.zeros((th if tile else min(th, h - r), tw), dtype=a.dtype)
                cut = band[r : r + th, c : c + tw]
                part[: cut.shape[0], : cut.shape[1]] = cut
                if predictor == 2:
                    part[:, 1:] = part[:, 1:] - part[:, :-1]
                parts.append(lzw(part.astype(a.dtype.newbyteorder(order)).tobytes()))
    word, size = ("Q", 8) if big else ("I", 4)
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "H", 43 if big else 42) + (struct.pack(order + "HHQ", 8, 0, 0) if big else b"\0" * 4))
    places = []
    for p in parts:
        places.append(len(out))
        out += p
    kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    tags = {256: ("H", [w]), 257: ("H", [h]), 258: ("H", [8 * a.itemsize] * n), 259: ("H", [5]), 277: ("H", [n]), 284: ("H", [2]), 317: ("H", [predictor]), 339: ("H", [kind] * n), 33550: ("d", [0.5, 0.25, 0]), 33922: ("d", [0, 0, 0, 100, 200, 0])}
    tags |= {322: ("H", [tw]), 323: ("H", [th]), 324: (word, places), 325: (word, list(map(len, parts)))} if tile else {273: (word, places), 278: ("H", [th]), 279: (word, list(map(len, parts)))}
    if epsg:
        tags[34735] = ("H", [1, 1, 0, 1, 3072, 0, 1, epsg])
    entries = b""
    for tag, (code, values) in sorted(tags.items()):
        data = struct.pack(order + str(len(values)) + code, *values)
        entries += struct.pack(order + "HH" + word, tag, {"H": 3, "I": 4, "Q": 16, "d": 12}[code], len(values))
        if len(data) <= size:
            entries += data.ljust(size, b"\0")
        else:
            entries += struct.pack(order + word, len(out))
            out += data
    out[8 if big else 4 : 16 if big else 8] = struct.pack(order + word, len(out))
    return bytes(out + struct.pack(order + ("Q" if big else "H"), len(tags)) + entries + b"\0" * 8)


def test_tiffs_of_other_writers(spark, tmp_path):
    a = np.random.default_rng(6).integers(0, 60_000, (2, 7, 9)).astype(np.uint16)
    for i, (order, big, tile, predictor) in enumerate([("<", False, None, 1), (">", False, None, 2), ("<", True, (16, 16), 2), (">", True, (4, 4), 1)]):
        b = by_hand(a, order=order, big=big, tile=tile, predictor=predictor, epsg=32616)
        assert (tiff.tiff_array(b) == a).all() and tiff.tiff_header(b)["epsg"] == 32616
        (tmp_path / f"{i}.tif").write_bytes(b)
    meta = files.raster_meta(spark, str(tmp_path)).collect()
    assert {(m["epsg"], m["x0"], m["res_y"]) for m in meta} == {(32616, 100.0, 0.25)}
    want = {(b + 1, r, c): float(a[b, r, c]) for b, r, c in np.ndindex(a.shape)}
    for window in (None, (1, 2, 5, 6)):
        px = files.raster_pixels(spark, str(tmp_path), window).collect()
        inside = {k: x for k, x in want.items() if not window or (1 <= k[1] < 5 and 2 <= k[2] < 6)}
        assert len(px) == 4 * len(inside)
        for i in range(4):
            assert {(p["band"], p["r"], p["c"]): p["v"] for p in px if p["raster_id"].endswith(f"/{i}.tif")} == inside
    assert [tiff.tiff_header(tiff.write_tiff(a, 0, 0, (1, 1), epsg=e))["epsg"] for e in (None, 4326, 32633)] == [None, 4326, 32633]


def test_projections_of_maps():
    utm = 'PROJCS["WGS_1984_UTM_Zone_16N",GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]]]]'
    assert files.prj_epsg(utm) == 32616 and files.prj_epsg(utm.replace("16N", "5S")) == 32705
    assert files.prj_epsg('GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984"]]') == 4326 and files.prj_epsg('PROJCS["WGS_1984_Web_Mercator_Auxiliary_Sphere"]') == 3857
    assert files.prj_epsg('PROJCS["x",GEOGCS["y",AUTHORITY["EPSG","4269"]],AUTHORITY["EPSG","26916"]]') == 26916
    assert files.prj_epsg(None) is None and files.prj_epsg('PROJCS["NAD83",GEOGCS["y",AUTHORITY["EPSG","4269"]]]') is None


def test_raster_files(spark):
    """A mosaic larger than a tile with overviews, and a class map with a palette."""
    a = np.random.default_rng(7).integers(1, 256, (300, 270)).astype(np.uint8)
    a[:20] = 0
    px = spark.createDataFrame(pd.DataFrame({"raster_id": "m", "r": np.indices(a.shape)[0].ravel(), "c": np.indices(a.shape)[1].ravel(), "v": a.ravel().astype(int)})).where("v <> 0")
    meta = spark.createDataFrame([("m", 5.0, 9.0, 0.5, 0.5, 270, 300), ("blank", 0.0, 0.0, 1.0, 1.0, 3, 2)], "raster_id string, x0 double, y0 double, res_x double, res_y double, width long, height long")
    out = {x["name"]: bytes(x["content"]) for x in sinks.raster_files(px, meta, colours={1: "#FF0010"}, levels=3, epsg=32616).collect()}
    head, tags = tiff.tiff_header(out["m"]), tiff.tiff_tags(out["m"])[1]
    assert (tiff.tiff_array(out["m"])[0] == a).all() and head["epsg"] == 32616 and head["nodata"] == 0 and (head["x0"], head["res_x"]) == (5.0, 0.5)
    assert tags[262] == (3,) and (tags[320][1], tags[320][257], tags[320][513]) == (65535, 0, 16 * 257)
    assert tiff.tiff_array(out["blank"]).shape == (1, 2, 3) and not tiff.tiff_array(out["blank"]).any()
    first = struct.unpack_from("<I", out["m"], 4)[0]
    (n,) = struct.unpack_from("<H", out["m"], first)
    second = struct.unpack_from("<I", out["m"], first + 2 + 12 * n)[0]
    half = tiff.tiff_array(out["m"][:4] + struct.pack("<I", second) + out["m"][8:])[0]
    assert (half == a[1::2, 1::2]).all()
    labels_ = spark.createDataFrame([("x", 1, 2, 4)], "raster_id string, r long, c long, value int")
    tiles = spark.createDataFrame([("t", "x", 0, 0, 0.0, 4.0, 1.0, 1.0), ("u", "x", 8, 8, 8.0, 4.0, 1.0, 1.0)], "name string, raster_id string, wr long, wc long, x_min double, y_max double, res_x double, res_y double")
    got = {x["name"]: tiff.tiff_array(bytes(x["content"]))[0] for x in sinks.tile_labels(labels_, tiles, 4).collect()}
    assert got["t"][1, 2] == 4 and got["t"].sum() == 4 and got["u"].shape == (4, 4) and not got["u"].any()


def test_map_with_smoothing_and_the_whole_job(spark):
    a = np.ones((12, 12), dtype=int)
    a[3:9, 3:9] = 2
    a[5, 5] = 0
    a[0, 0] = 3
    raster = grid(spark, "\n".join("".join(map(str, x)) for x in a))
    patches = {x["substrate"]: x for x in workflow.vector_map(raster, {1: "Sand"}, pixel=(2.0, 2.0), merge_below=5.0, smooth=0.0, left=100.0, top=50.0).select("*", polygons.ring_area().alias("a")).collect()}
    assert {k: (x["name"], x["area_m"], x["a"]) for k, x in patches.items()} == {1: ("Sand", 432.0, 432.0), 2: ("2", 144.0, 144.0)}
    assert len(patches[1]["rings"]) == 2 and sorted(patches[1]["rings"][0]) == [[100.0, 26.0], [100.0, 50.0], [124.0, 26.0], [124.0, 50.0]]
    p = spark.createDataFrame([("a", 1, r, c, 1 + c // 8) for r in range(16) for c in range(16)], "raster_id string, band int, r long, c long, v int")
    meta = spark.createDataFrame([("a", 0.0, 16.0, 1.0, 1.0, 16, 16)], "raster_id string, x0 double, y0 double, res_x double, res_y double, width long, height long")

    def model(b: pd.DataFrame) -> pd.Series:
        right = [np.repeat((np.arange(4) + x >= 8)[None], 4, axis=0).astype(float) for x in b["x_min"]]
        return pd.Series([np.concatenate([(0 * m).ravel(), (1 - m).ravel(), m.ravel()]).tolist() for m in right])

    out = workflow.map_mosaics(p, meta, model, 3, (4, 4), {1: "Sand", 2: "Mud"}, window=4, stride=2, source=4326, target=4326, cell=1.0)
    got = {x["name"]: x["area_m"] for x in out["patches"].collect()}
    assert set(got) == {"Sand", "Mud"} and got["Sand"] == 8 * 18.0 and out["tiles"].count() > 16
    # The same in degrees near the equator, where a hundred-thousandth is about 1.11 m
    away = meta.select("raster_id", F.lit(3.0).alias("x0"), F.lit(0.001).alias("y0"), F.lit(1e-5).alias("res_x"), F.lit(1e-5).alias("res_y"), "width", "height")
    edge = warp.target_grid(away, 4326, 32631, 1.0, aligned=True).first()
    assert (edge["width"], edge["res_x"]) in ((18, 1.0), (19, 1.0)) and edge["x0"] == 500000.0

    def utm(b: pd.DataFrame) -> pd.Series:
        return model(b.assign(x_min=b["x_min"] - 500000.0))

    out = workflow.map_mosaics(p, away, utm, 3, (4, 4), {1: "Sand", 2: "Mud"}, window=4, stride=2, source=4326, target=32631, cell=1.0)
    names = {x["name"] for x in out["patches"].collect()}
    assert names == {"Sand", "Mud"} and out["tiles"].agg(F.min("x_min")).first()[0] == 500000.0
    found = spark.createDataFrame([("t1", 1, 1, 2, [0.5, 0.5]), ("t1", 1, 1, 2, [0.1, 0.9])], "base string, classes int, height int, width int, t array<double>")
    joined = pairing.with_tensors(spark.createDataFrame([("a/t1.png",), ("b/t1.png.tif",), ("t2.png",)], "tile string"), found)
    assert rows(joined.select("tile", "t")) == [("a/t1.png", [0.1, 0.9]), ("b/t1.png.tif", [0.1, 0.9])]


def test_coco(spark):
    lab = regions.components(grid(spark, "1000000\n0222200\n0222200\n0222203\n0000003"))
    b = coco.boxes(lab).collect()
    assert [(x["cls"], x["x"], x["y"], x["w"], x["h"], x["area"]) for x in b] == [(2, 1, 1, 4, 3, 6.0)]  # a dot and a line have no area
    two = spark.createDataFrame([(3, 1, 5, 0, 0, 2, 2, 1.0), (1, 2, 6, 0, 0, 2, 2, 1.0), (1, 1, 7, 0, 0, 2, 2, 1.0)], "image_id int, cls int, comp long, x int, y int, w int, h int, area double")
    assert [(x["id"], x["image_id"], x["category_id"]) for x in coco.annotations(two).orderBy("id").collect()] == [(1, 1, 1), (2, 1, 2), (3, 3, 1)]
    assert coco.categories({0: "none", 2: "b", 1: "a"}) == [(1, "a"), (2, "b")]
    m = spark.createDataFrame([("m/a.png",), ("m/b.png",)], "path string")
    i = spark.createDataFrame([("i/a.tif",), ("i/a.jpg",), ("i/b.txt",)], "path string")
    assert rows(coco.match_masks(m, i, False)) == [("m/a.png", "i/a.jpg")] and rows(coco.match_masks(m, i, True))[1] == ("m/b.png", "m/b.png")
    doc = json.loads(coco.document(coco.images(spark.createDataFrame([("z.png", 1, 1)], "file_name string, width int, height int")), coco.annotations(two).drop("comp"), {1: "a"}).first()["json"])
    assert [a["id"] for a in doc["annotations"]] == [1, 2, 3] and doc["images"][0]["id"] == 1 and doc["categories"] == [{"id": 1, "name": "a"}]


def test_series(spark):
    p = spark.createDataFrame([("t", i, i // 4, x, 1) for i, x in enumerate([3, 3, 1, 1, 2, 9])], "transect string, ping long, chunk long, ping_cnt long, dep_bin long")
    assert rows(sonogram.modal_range(p)) == [("t", 1, 1)]  # 3 and 1 are as common: the smaller
    assert sorted(map(tuple, sonogram.chunk_pairs(p.select("transect", "chunk").distinct()).collect()), key=str) == [("t", 0, 1), ("t", 1, None)]
    assert rows(sonogram.sliding(p, 3, 0, F.col("ping_cnt"))) == [("t", 0, 0, 3, 7), ("t", 0, 1, 3, 5), ("t", 0, 2, 3, 4), ("t", 1, 0, 2, 11), ("t", 1, 1, 1, 9)]
    assert [x["ping_cnt"] for x in sonogram.pad_trim(p, F.lit(8), ("transect",), "ping", "ping_cnt").orderBy("ping").collect()] == [3, 3, 1, 1, 2, 9, 0, 0]


def test_class_maps(spark):
    read = lambda c: value(spark, scalar.class_names(F.lit(json.dumps(c))))
    want = {"0": "a", "1": "b"}
    for c in ({"MY_CLASS_NAMES": {"0": "a", "01": "b", "x": "c"}}, {"id2label": {"0": "a", "1": "b"}}, {"id2label": {"a": 0, "b": 1}}, {"label2id": {"a": 0, "b": 1}}, {"label2id": {"0": "a", "1": "b"}}):
        assert read(c) == want
    with pytest.raises(Exception, match="no class names"):
        read({"other": 1})
    size = lambda c: value(spark, scalar.target_size(F.lit(json.dumps(c))))
    assert (size({"image_size": 5}), size({"TARGET_SIZE": [3, 4, 9]}), size({})) == ([5, 5], [3, 4], [224, 224])
    assert [value(spark, scalar.crosswalk(F.lit(x), {"Sand": 1, "mud ": 2})) for x in ("Sand", " SAND ", "Mud", "x")] == [1, 1, 2, None]


def test_projections(spark):
    x, y = (value(spark, c) for c in crs.reproject(F.lit(-87.0), F.lit(0.0), 4326, 32616))
    assert math.isclose(x, 500000, abs_tol=1e-6) and math.isclose(y, 0, abs_tol=1e-6)
    x, y = (value(spark, c) for c in crs.reproject(F.lit(9.0), F.lit(48.0), 4326, 32632))
    assert math.isclose(x, 500000, abs_tol=1e-3) and math.isclose(y, 5316300.2, abs_tol=500)
    for epsg in (3857, 32616, 32716):
        a = crs.reproject(F.lit(-88.25), F.lit(33.5), 4326, epsg)
        back = [value(spark, c) for c in crs.reproject(*a, epsg, 4326)]
        assert np.allclose(back, [-88.25, 33.5], atol=1e-9)
    with pytest.raises(ValueError):
        crs.reproject(F.lit(0.0), F.lit(0.0), 4326, 2154)


def test_files(spark, tmp_path):
    a = np.arange(2 * 5 * 7, dtype=np.uint8).reshape(2, 5, 7)
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.TIF").write_bytes(tiff.write_tiff(a, 100.0, 200.0, (0.5, 0.25), 255))
    (tmp_path / "b.tiff").write_bytes(tiff.write_tiff(a[:1].astype(np.float32), 0, 0, (1, 1)))
    meta = {r["raster_id"].rsplit("/", 1)[-1]: r for r in files.raster_meta(spark, str(tmp_path)).collect()}
    assert (meta["a.TIF"]["width"], meta["a.TIF"]["height"], meta["a.TIF"]["n_bands"], meta["a.TIF"]["x0"], meta["a.TIF"]["res_y"], meta["a.TIF"]["nodata"]) == (7, 5, 2, 100.0, 0.25, 255.0)
    px = files.raster_pixels(spark, str(tmp_path)).where("raster_id like '%TIF'")
    assert {(r["band"], r["r"], r["c"]): r["v"] for r in px.collect()} == {(b + 1, r, c): float(a[b, r, c]) for b, r, c in np.ndindex(a.shape)}
    assert files.discover(spark, str(tmp_path), ".tif", ".tiff").count() == 2
    with pytest.raises(FileNotFoundError):
        files.discover(spark, str(tmp_path), ".xyz")
    buffer = io.BytesIO()
    np.savez_compressed(buffer, softmax=np.ones((2, 3)))
    (tmp_path / "t_1.npz").write_bytes(buffer.getvalue())
    assert tuple(files.tensors(spark, str(tmp_path)).first())[:4] == ("t_1", 1, 2, 3)
    (tmp_path / "config.json").write_text('{"image_size": 3}')
    assert files.config(spark, str(tmp_path)).first()["config"] == '{"image_size": 3}'


def test_shapefile(spark, tmp_path):
    import struct

    rings = [[(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]]
    pts = [p for r in rings for p in r]
    body = struct.pack("<I4d2I2I", 5, 0, 0, 4, 4, 2, len(pts), 0, 5) + b"".join(struct.pack("<2d", *p) for p in pts)
    (tmp_path / "m.shp").write_bytes(b"\0" * 100 + struct.pack(">II", 1, len(body) // 2) + body)
    head = struct.pack("<B3BIHH20x", 3, 1, 1, 1, 1, 65, 11) + b"Kind".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([10]) + b"\0" * 15 + b"\x0d"
    (tmp_path / "m.dbf").write_bytes(head + b" " + b"Sand".ljust(10))
    got = files.vector_map(spark, str(tmp_path), "Kind").select("class_name", polygons.ring_area().alias("area")).first()
    assert tuple(got) == ("Sand", 15.0)


def test_workflow(spark):
    p = spark.createDataFrame([("a", r, c, 1 if c < 6 else 0) for r in range(8) for c in range(8)], "raster_id string, r long, c long, v int")
    meta = spark.createDataFrame([("a", 0.0, 8.0, 1.0, 1.0)], "raster_id string, x0 double, y0 double, res_x double, res_y double")
    tiles = workflow.tile_mosaic(p, meta, 4, 2)
    assert tiles.count() == 12 and tiles.where("nonzero_prop < 0.5").count() == 0
    f = spark.createDataFrame([(1, 0.0, 0.0, 4.0, 8.0, "sand"), (2, 4.0, 0.0, 6.0, 8.0, "mud")], "fid int, x_min double, y_min double, x_max double, y_max double, class_name string")
    got = workflow.tile_with_labels(tiles, f, {"sand": 1, "mud": 2}).where("x_min = 2 and y_max = 8").first()
    assert got["outcome"] == "label" and got["class_frac"] == {"mud": 0.5, "sand": 0.5}

    def model(b: pd.DataFrame) -> pd.Series:
        left = [np.repeat((np.arange(4) + x < 4)[None], 4, axis=0).astype(float) for x in b["x_min"]]
        return pd.Series([np.concatenate([(m * 0.1).ravel(), (m * 0.8).ravel(), ((1 - m) * 0.7).ravel()]).tolist() for m in left])

    raster, patches = workflow.map_classes(workflow.predict(tiles, model), 3, (4, 4), (4.0, 4.0), 2, {1: "Sand"})
    assert {(x["substrate"], x["name"], x["area_m"]) for x in patches.collect()} == {(1, "Sand", 40.0), (2, "2", 40.0)}
    assert workflow.prune(tiles.withColumn("win_id", F.lit(1)), p, 4, 0).count() > 0


def test_stream(spark, tmp_path):
    src = spark.createDataFrame([("a", r, c, 1, 0) for r in range(4) for c in range(4)], "raster_id string, r long, c long, v int, s int").withColumn("ts", F.timestamp_seconds("s"))
    src.write.parquet(str(tmp_path / "in"))
    out = coverage_stream(spark.readStream.schema(src.schema).parquet(str(tmp_path / "in")), 2, 2, 0.5)
    q = out.writeStream.outputMode("complete").format("memory").queryName("cover").option("checkpointLocation", str(tmp_path / "state")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("cover").count() == 4


def png(a, how):
    """A grey PNG with one filter for all lines."""
    import struct
    import zlib

    lines, up = b"", np.zeros(a.shape[1], dtype=int)
    for line in a.astype(int):
        left = np.concatenate([[0], line[:-1]])
        corner = np.concatenate([[0], up[:-1]])
        p = left + up - corner
        near = np.stack([abs(p - left), abs(p - up), abs(p - corner)])
        paeth = np.stack([left, up, corner])[near.argmin(axis=0), np.arange(len(line))]
        guess = (0 * line, left, up, (left + up) // 2, paeth)[how]
        lines += bytes([how]) + bytes(((line - guess) & 255).astype(np.uint8))
        up = line
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + b"\0" * 4
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def test_jpeg():
    """What was written comes back, nearly; a grey and a colour file made by hand come back as they were meant."""
    r = np.random.default_rng(1)
    y, x = np.mgrid[:45, :61]
    a = np.clip(128 + 80 * np.sin(x / 9) + 30 * np.cos(y / 5) + r.normal(0, 6, (45, 61)), 0, 255).astype(np.uint8)
    got = jpeg.jpeg_array(jpeg.jpeg_grey(a, 95))
    assert got.shape == a.shape and np.abs(got.astype(int) - a).max() <= 12
    noise = r.integers(0, 256, (64, 64)).astype(np.uint8)
    assert np.abs(jpeg.jpeg_array(jpeg.jpeg_grey(noise, 100)).astype(int) - noise).max() <= 2
    # 16 x 8, three components, the first twice as fine: flat blocks whose first numbers are coded in four bits each
    part = lambda m, b: bytes([255, m]) + struct.pack(">H", len(b) + 2) + b
    table = bytes([0] * 3 + [8] + [0] * 12 + list(range(8)))
    head = part(0xDB, bytes([0] + [8] * 64)) + part(0xC0, struct.pack(">BHHB", 8, 8, 16, 3) + bytes([1, 0x21, 0, 2, 0x11, 0, 3, 0x11, 0]))
    head += part(0xC4, b"\0" + table + b"\x10" + table) + part(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0]))
    bits = "0110" + f"{40:06b}" + "0000" + "0000" + "0000" + "0101" + f"{20:05b}" + "0000" + "0000" + "0000"  # 40, the same, 20, 0
    body = int(bits.ljust(-(-len(bits) // 8) * 8, "1"), 2).to_bytes(-(-len(bits) // 8))
    got = jpeg.jpeg_array(b"\xff\xd8" + head + body + b"\xff\xd9")
    assert got.shape == (8, 16, 3) and (got == np.rint([168.0, 168 - 0.344136 * 20, 168 + 1.772 * 20])).all()
    with pytest.raises(ValueError):
        jpeg.jpeg_array(b"\xff\xd8" + part(0xC2, b"\x08\0\x08\0\x08\x01\x01\x11\0"))


def test_frames(spark, tmp_path):
    """Two chunks of three columns, windows of four: the strip is filled up to four before the next begins."""
    st = spark.createDataFrame([("t", k, r, c, 100 * k + 10 * r + c + 1) for k in (0, 1) for r in range(2) for c in range(3)], "transect string, chunk long, r long, c long, v int")
    cells = sonogram.window_cells(st, 4, 2)
    got = {(x["chunk"], x["start"]): {} for x in cells.collect()}
    for x in cells.collect():
        got[x["chunk"], x["start"]][x["r"], x["c"]] = x["v"]
    assert set(got) == {(0, 0), (0, 2), (1, 0), (1, 2)}
    assert got[0, 2] == {(0, 0): 3, (1, 0): 13, (0, 2): 101, (1, 2): 111, (0, 3): 102, (1, 3): 112}
    images = sinks.frame_images(cells, 4, 3, "x").collect()
    assert sorted(i["name"] for i in images) == ["x_00000_00000.jpg", "x_00000_00002.jpg", "x_00001_00000.jpg", "x_00001_00002.jpg"]
    one = next(bytes(i["content"]) for i in images if i["name"] == "x_00001_00000.jpg")
    assert jpeg.jpeg_array(one).shape == (3, 4)
    (tmp_path / "a.JPG").write_bytes(one)
    px = files.strips(spark, str(tmp_path))
    assert px.count() == 12 and abs(px.where("r = 1 and c = 1").first()["v"] - 112) < 30


def test_strips_and_tiles(spark, tmp_path):
    a = np.random.default_rng(1).integers(0, 256, (6, 9)).astype(np.uint8)
    for how in range(5):
        assert (files.png_grey(png(a, how)) == a).all()
    (tmp_path / "s.png").write_bytes(png(a, 4))
    px = files.strips(spark, str(tmp_path))
    assert {(r["r"], r["c"]): r["v"] for r in px.collect()} == {(r, c): float(a[r, c]) for r, c in np.ndindex(a.shape)}
    tiles = spark.createDataFrame([("t", "x", 3, 4, 4.0, 3.0, 1.0, 1.0)], "name string, raster_id string, wr long, wc long, x_min double, y_max double, res_x double, res_y double")
    out = sinks.tile_images(px.select(F.lit("x").alias("raster_id"), F.lit(1).alias("band"), "r", "c", "v"), tiles, 4).first()
    want = np.zeros((4, 4), dtype=np.uint8)
    want[:3] = a[3:6, 4:8]
    assert (tiff.tiff_array(bytes(out["content"]))[0] == want).all()
    sinks.manifest(tiles, str(tmp_path / "m"), "raster_id")
    assert spark.read.parquet(str(tmp_path / "m")).where("raster_id = 'x'").count() == 1
    sinks.stage_csv(tiles, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == tiles.columns
    assert sinks.colour_table({1: "#FF0010"}) == [(1, 255, 0, 16)]
