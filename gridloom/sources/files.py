"""Files as tables: discovery by suffix, GeoTIFF rasters, polygon shapefiles, probability tensors, settings and series.

Files are read by Spark (``binaryFile``), so any store that it knows will do; only their bytes reach Python. Rasters are
cut into their strips or tiles, which are decoded in parallel; a file of another kind is decoded in one task.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .jpeg import jpeg_array
from .tiff import tiff_header, tiff_part, tiff_parts

#: Rows of a raster that leave the reader at once, and packed bytes of its parts.
ROWS, PART_BYTES = 64, 16 << 20


def discover(spark: SparkSession, root: str, *suffixes: str, required: bool = True) -> DataFrame:
    """``(path)`` of files under a folder, at any depth, whose names end in one of the suffixes, whatever the case."""
    pattern = "(" + "|".join(s.lower().replace(".", r"\.") for s in suffixes) + ")$"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path").where(F.lower("path").rlike(pattern))
    if required and not found.limit(1).count():
        raise FileNotFoundError(f"no {' or '.join(suffixes)} under {root}")
    return found


def _contents(spark: SparkSession, root: str, *suffixes: str) -> DataFrame:
    pattern = "(" + "|".join(s.lower().replace(".", r"\.") for s in suffixes) + ")$"
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).where(F.lower("path").rlike(pattern)).select("path", "content")


def raster_meta(spark: SparkSession, root: str) -> DataFrame:
    """Headers of all rasters under a folder; bands are held to three."""
    schema = "raster_id string, x0 double, y0 double, res_x double, res_y double, width long, height long, nodata double, epsg int, n_bands int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [{"raster_id": p, **tiff_header(c)} for p, c in zip(b["path"], b["content"])]
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
            out["n_bands"] = out["n_bands"].clip(upper=3) if len(out) else out["n_bands"]
            out["epsg"] = out["epsg"].astype("Int32")
            yield out

    return _contents(spark, root, ".tif", ".tiff").mapInPandas(run, schema)


def raster_pixels(spark: SparkSession, root: str, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """``(raster_id, band, r, c, v)`` of all rasters under a folder, bands 1 to 3; only those of a window (first row and
    column, row and column after the last), if given. A file's strips or tiles are cut apart without decoding, those
    outside the window left out, and decoded in parallel."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                held, size = [], 0
                for part in tiff_parts(content, 3, window):
                    held.append((path, *part))
                    size += len(part[-1])
                    if size > PART_BYTES:
                        yield pd.DataFrame(held, columns=names)
                        held, size = [], 0
                if held:
                    yield pd.DataFrame(held, columns=names)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r0, c0, r1, c1 = window or (0, 0, 2**62, 2**62)
        for b in batches:
            for path, layout, band, top, left, raw in b[names].itertuples(index=False, name=None):
                a = tiff_part(layout, top, left, raw)[: 3 - band]
                a = a[:, max(0, r0 - top) : r1 - top, max(0, c0 - left) : c1 - left]
                top, left = max(top, r0), max(left, c0)
                for r in range(0, a.shape[1], ROWS):
                    part = a[:, r : r + ROWS]
                    k, row, col = np.indices(part.shape)
                    yield pd.DataFrame({"raster_id": path, "band": k.ravel() + band + 1, "r": row.ravel() + r + top, "c": col.ravel() + left, "v": part.ravel().astype(float)})

    names = ["path", "layout", "band", "r", "c", "raw"]
    parts = _contents(spark, root, ".tif", ".tiff").mapInPandas(cut, "path string, layout string, band int, r long, c long, raw binary")
    return parts.repartition("path", "band", "r", "c").mapInPandas(decode, "raster_id string, band int, r long, c long, v double")


def prj_epsg(text: str | None) -> int | None:
    """The coordinate system of a ``.prj`` file: its own EPSG code, else of geographic WGS 84, its Mercator or a UTM zone
    by name; null for others."""
    if not text:
        return None
    own = re.search(r'AUTHORITY\s*\[\s*"EPSG"\s*,\s*"?(\d+)"?\s*\]\s*\]\s*$', text)
    if own:
        return int(own[1])
    wgs = re.search(r"WGS[ _]?(?:19)?84", text)
    zone = re.search(r"UTM[ _]zone[ _](\d{1,2})([NS])", text, re.I)
    if wgs and zone:
        return (32600 if zone[2].upper() == "N" else 32700) + int(zone[1])
    if wgs and re.search("Web_Mercator|Pseudo-Mercator", text):
        return 3857
    return 4326 if wgs and text.lstrip().startswith("GEOGCS") else None


def shapes(shp: bytes, dbf: bytes) -> list[tuple[int, list[list[list[float]]], dict[str, str]]]:
    """(number, rings, attributes) of a polygon shapefile."""
    head, size, step = struct.unpack_from("<IHH", dbf, 4)
    fields = []
    at = 32
    while dbf[at] != 0x0D:
        fields.append((dbf[at : at + 11].split(b"\0")[0].decode("latin-1"), dbf[at + 16]))
        at += 32
    out, place, i = [], 100, 0
    while place < len(shp):
        (words,) = struct.unpack_from(">I", shp, place + 4)
        body = shp[place + 8 : place + 8 + 2 * words]
        place += 8 + 2 * words
        rings: list[list[list[float]]] = []
        if struct.unpack_from("<I", body)[0] in (5, 15, 25):
            parts, points = struct.unpack_from("<II", body, 36)
            first = [*struct.unpack_from(f"<{parts}I", body, 44), points]
            xy = np.frombuffer(body, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
            rings = [xy[a:b].tolist() for a, b in zip(first, first[1:])]
        row, names = size + i * step + 1, {}
        for name, width in fields:
            names[name] = dbf[row : row + width].decode("utf-8", "replace").strip()
            row += width
        out.append((i, rings, names))
        i += 1
    return out


def vector_map(spark: SparkSession, root: str, class_field: str) -> DataFrame:
    """``(map, fid, class_name, rings, epsg)`` of all polygon shapefiles under a folder."""
    files = _contents(spark, root, ".shp", ".dbf", ".prj").select(F.regexp_replace("path", r"\.[^.]*$", "").alias("map"), F.lower(F.regexp_extract("path", r"([^.]*)$", 1)).alias("kind"), "content")
    one = {k: F.max(F.when(F.col("kind") == k, F.col("content"))).alias(k) for k in ("shp", "dbf", "prj")}
    both = files.groupBy("map").agg(*one.values()).where("shp is not null and dbf is not null")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(m, i, names.get(class_field), rings, prj_epsg(p.decode("utf-8", "replace") if p is not None else None)) for m, s, d, p in zip(b["map"], b["shp"], b["dbf"], b["prj"]) for i, rings, names in shapes(s, d)]
            out = pd.DataFrame(rows, columns=["map", "fid", "class_name", "rings", "epsg"])
            out["epsg"] = out["epsg"].astype("Int32")
            yield out

    return both.mapInPandas(run, "map string, fid long, class_name string, rings array<array<array<double>>>, epsg int")


def tensors(spark: SparkSession, root: str) -> DataFrame:
    """``(base, classes, height, width, t)`` of .npz files: key ``softmax``, else ``logits``, else the first; flat."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    names = [n.removesuffix(".npy") for n in z.namelist()]
                    name = next((n for n in ("softmax", "logits") if n in names), names[0])
                    a = np.lib.format.read_array(io.BytesIO(z.read(f"{name}.npy")), allow_pickle=False)
                a = a[None] if a.ndim == 2 else a
                rows.append((path.rsplit("/", 1)[-1].rsplit(".", 1)[0], *a.shape, a.ravel().astype(float).tolist()))
            yield pd.DataFrame(rows, columns=["base", "classes", "height", "width", "t"])

    return _contents(spark, root, ".npz").mapInPandas(run, "base string, classes int, height int, width int, t array<double>")


def png_grey(b: bytes) -> np.ndarray:
    """Grey values 0 to 255 of an 8-bit, non-interlaced PNG; colours are weighed by luminance."""
    if b[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG file")
    place, body, head = 8, b"", ()
    while place < len(b):
        size, kind = struct.unpack_from(">I4s", b, place)
        if kind == b"IHDR":
            head = struct.unpack_from(">IIBBBBB", b, place + 8)
        elif kind == b"IDAT":
            body += b[place + 8 : place + 8 + size]
        place += 12 + size
    w, h, depth, colour, _, _, interlace = head
    if depth != 8 or interlace or colour not in (0, 2, 4, 6):
        raise ValueError("only 8-bit PNG files without palette or interlace are read")
    n = {0: 1, 2: 3, 4: 2, 6: 4}[colour]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * n)
    out = np.zeros((h, w, n), dtype=np.uint8)
    up = np.zeros((w, n), dtype=np.uint8)
    for r in range(h):
        line, how = raw[r, 1:].reshape(w, n), raw[r, 0]
        if how == 1:  # sums run along the line
            line = np.cumsum(line, axis=0, dtype=np.uint8)
        elif how == 2:
            line = line + up
        elif how in (3, 4):  # each pixel needs the one before it
            line = _predicted(line.tolist(), up.tolist(), how)
        out[r] = up = line
    return _grey(out.astype(float))


def _grey(px: np.ndarray) -> np.ndarray:
    return px[..., 0] if px.shape[2] < 3 else px[..., :3] @ np.array([0.2125, 0.7154, 0.0721])


def image_grey(b: bytes) -> np.ndarray:
    """Grey values 0 to 255 of a PNG or JPEG file."""
    if b[:2] != b"\xff\xd8":
        return png_grey(b)
    a = jpeg_array(b).astype(float)
    return a if a.ndim == 2 else _grey(a)


def _predicted(line: list[list[int]], up: list[list[int]], how: int) -> np.ndarray:
    out = []
    left = corner = [0] * len(line[0])
    for x, above in zip(line, up):
        now = []
        for v, a, b, c in zip(x, left, above, corner):
            if how == 3:
                guess = (a + b) >> 1
            else:
                da, db, dc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                guess = a if da <= db and da <= dc else b if db <= dc else c
            now.append((v + guess) & 255)
        out.append(now)
        left, corner = now, above
    return np.array(out, dtype=np.uint8)


def strips(spark: SparkSession, root: str) -> DataFrame:
    """``(path, r, c, v)`` of grey image strips (PNG, JPEG) under a folder; columns run along the track."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                a = image_grey(content)
                for r in range(0, len(a), ROWS):
                    row, col = np.indices(a[r : r + ROWS].shape)
                    yield pd.DataFrame({"path": path, "r": row.ravel() + r, "c": col.ravel(), "v": a[r : r + ROWS].ravel()})

    return _contents(spark, root, ".png", ".jpg", ".jpeg").mapInPandas(run, "path string, r long, c long, v double")


def config(spark: SparkSession, root: str) -> DataFrame:
    """The first settings file of a folder as one JSON text: ``config.json``, else the first of ``config/*.json``."""
    found = discover(spark, root, ".json").select("path", F.regexp_extract("path", r"(/config\.json|/config/[^/]*\.json)$", 1).alias("name")).where("name <> ''")
    first = found.orderBy(F.when(F.col("name") == "/config.json", 0).otherwise(1), "path").limit(1).collect()
    if not first:
        raise FileNotFoundError(f"no settings under {root}")
    return spark.read.text(first[0]["path"], wholetext=True).select(F.col("value").alias("config"))


def series(spark: SparkSession, path: str) -> DataFrame:
    """Along-track metadata from CSV, by name, without a pass to infer types."""
    return spark.read.csv(path, header=True, enforceSchema=False, schema="transect string, ping_cnt long, dep_m double, pixM double, chunk_id long")
