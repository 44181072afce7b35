"""GeoTIFF files, classic and big: headers, strips and tiles one by one, and writing with a palette and overviews."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np

_TYPES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 6: ("b", 1), 8: ("h", 2), 9: ("i", 4), 11: ("f", 4), 12: ("d", 8), 13: ("I", 4), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
#: Rows and columns of a written tile.
TILE = 256


def tiff_tags(b: bytes) -> tuple[str, dict[int, tuple]]:
    """Byte order and the tags of a file's first image."""
    order = {b"II": "<", b"MM": ">"}[b[:2]]
    (magic,) = struct.unpack_from(order + "H", b, 2)
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    big = magic == 43
    size, word, count_ = (8, "Q", "Q") if big else (4, "I", "H")
    (at,) = struct.unpack_from(order + word, b, 8 if big else 4)
    (n,) = struct.unpack_from(order + count_, b, at)
    at += struct.calcsize(count_) if not big else 8
    step = 4 + 2 * size
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HH" + word, b, at + step * i)
        code, each = _TYPES.get(kind, ("B", 1))
        place = at + step * i + 4 + size
        if count * each > size:
            (place,) = struct.unpack_from(order + word, b, place)
        raw = b[place : place + count * each]
        tags[tag] = (raw.rstrip(b"\0").decode("latin-1"),) if kind == 2 else struct.unpack(order + str(count * len(code)) + code[0], raw)
    return order, tags


def _epsg(tags: dict[int, tuple]) -> int | None:
    """The coordinate system's number from the geographic keys: that of a projection, else of its base."""
    keys = tags.get(34735, ())
    found = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    code = found.get(3072, found.get(2048))
    return int(code) if code and code != 32767 else None


def tiff_header(b: bytes) -> dict:
    """Size, bands, position, no-data value and coordinate system of a north-up raster."""
    _, t = tiff_tags(b)
    scale, tie = t.get(33550, (1.0, 1.0, 0.0)), t.get(33922, (0.0,) * 6)
    nodata = t.get(42113)
    return {"width": t[256][0], "height": t[257][0], "n_bands": t.get(277, (1,))[0], "res_x": scale[0], "res_y": scale[1], "x0": tie[3] - tie[0] * scale[0], "y0": tie[4] + tie[1] * scale[1], "nodata": float(nodata[0]) if nodata else None, "epsg": _epsg(t)}


def unpacked(raw: bytes, packing: int) -> bytes:
    return unlzw(raw) if packing == 5 else zlib.decompress(raw) if packing in (8, 32946) else raw


def unlzw(b: bytes) -> bytes:
    """LZW as in TIFF: codes of 9 to 12 bits, highest bit first, growing one code early."""
    out = bytearray()
    table = [bytes([i]) for i in range(256)] + [b"", b""]
    width, held, bits = 9, 0, 0
    last: bytes | None = None
    for byte in b:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            del table[258:]
            width, last = 9, None
            continue
        if last is None:
            entry = table[code]
        else:
            entry = table[code] if code < len(table) else last + last[:1]
            table.append(last + entry[:1])
        out += entry
        last = entry
        n = len(table)
        width = 9 if n < 511 else 10 if n < 1023 else 11 if n < 2047 else 12
    return bytes(out)


def tiff_parts(b: bytes, bands: int = 3, window: tuple[int, int, int, int] | None = None) -> Iterator[tuple[str, int, int, int, bytes]]:
    """``(layout, first band, first row, first column, packed bytes)`` of the strips or tiles that hold any of the first
    bands in the window (first row and column, row and column after the last). The layout is what decoding needs."""
    order, t = tiff_tags(b)
    w, h, n = t[256][0], t[257][0], t.get(277, (1,))[0]
    packing, planar, predictor = t.get(259, (1,))[0], t.get(284, (1,))[0], t.get(317, (1,))[0]
    if packing not in (1, 5, 8, 32946) or predictor not in (1, 2):
        raise ValueError(f"compression {packing} with predictor {predictor} is not read")
    tiled = 322 in t
    tw, th = (t[322][0], t[323][0]) if tiled else (w, min(h, t.get(278, (h,))[0]))
    offsets, sizes = (t[324], t[325]) if tiled else (t[273], t[279])
    across, down = -(-w // tw), -(-h // th)
    kind = {1: "u", 2: "i", 3: "f"}[t.get(339, (1,))[0]]
    layout = json.dumps([f"{order}{kind}{t.get(258, (8,))[0] // 8}", packing, predictor, tw, th, 1 if planar == 2 else n, w, h])
    r0, c0, r1, c1 = window or (0, 0, h, w)
    for i, (at, size) in enumerate(zip(offsets, sizes)):
        band, k = divmod(i, across * down) if planar == 2 else (0, i)
        r, c = (x * y for x, y in zip(divmod(k, across), (th, tw)))
        if band < bands and size and r < r1 and r + th > r0 and c < c1 and c + tw > c0:
            yield layout, band, r, c, b[at : at + size]


def tiff_part(layout: str, r: int, c: int, raw: bytes) -> np.ndarray:
    """(bands, rows, columns) of one strip or tile, without what lies outside the raster."""
    kind, packing, predictor, tw, th, each, w, h = json.loads(layout)
    part = np.frombuffer(unpacked(raw, packing), dtype=np.dtype(kind))
    part = part[: min(len(part) // (tw * each), th) * tw * each].reshape(-1, tw, each)
    if predictor == 2:
        part = np.cumsum(part, axis=1, dtype=part.dtype)
    return np.moveaxis(part, 2, 0)[:, : h - r, : w - c].astype(np.dtype(kind).newbyteorder("="))


def tiff_array(b: bytes) -> np.ndarray:
    """(bands, rows, columns) of a whole file."""
    order, t = tiff_tags(b)
    n = t.get(277, (1,))[0]
    out = None
    for layout, band, r, c, raw in tiff_parts(b, n):
        part = tiff_part(layout, r, c, raw)
        if out is None:
            out = np.zeros((n, t[257][0], t[256][0]), dtype=part.dtype)
        out[band : band + part.shape[0], r : r + part.shape[1], c : c + part.shape[2]] = part
    return out


def packed_tile(a: np.ndarray) -> bytes:
    """A deflated tile of (bands, rows, columns), filled up with 0."""
    whole = np.zeros((TILE, TILE, a.shape[0]), dtype=a.dtype.newbyteorder("<"))
    whole[: a.shape[1], : a.shape[2]] = np.moveaxis(a, 0, 2)
    return zlib.compress(whole.tobytes())


def tiff_file(images: list[tuple[int, int, list[bytes]]], bands: int, dtype: np.dtype, x0: float, y0: float, res: tuple[float, float], nodata: float | None = None, *, epsg: int | None = None, palette: dict[int, tuple[int, int, int]] | None = None, tiled: bool = True) -> bytes:
    """A GeoTIFF from deflated tiles in reading order: the raster, ``(height, width, tiles)``, then its overviews.
    Without ``tiled``, an image is one strip."""
    dtype = np.dtype(dtype)
    kind = {"u": 1, "i": 2, "f": 3}[dtype.kind]
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4  # where the place of the next image is written
    for level, (h, w, parts) in enumerate(images):
        places = []
        for p in parts:
            places.append(len(out))
            out += p
        tags = [(254, 4, (1 if level else 0,)), (256, 4, (w,)), (257, 4, (h,)), (258, 3, (8 * dtype.itemsize,) * bands), (259, 3, (8,)), (262, 3, (3 if palette else 1,)), (277, 3, (bands,)), (284, 3, (1,)), (339, 3, (kind,) * bands)]
        sizes = tuple(map(len, parts))
        tags += [(322, 3, (TILE,)), (323, 3, (TILE,)), (324, 4, tuple(places)), (325, 4, sizes)] if tiled else [(273, 4, tuple(places)), (278, 4, (h,)), (279, 4, sizes)]
        if palette:
            tags.append((320, 3, tuple(257 * palette.get(v, (0, 0, 0))[i] for i in range(3) for v in range(256))))
        if not level:
            tags += [(33550, 12, (*res, 0.0)), (33922, 12, (0.0, 0.0, 0.0, x0, y0, 0.0))]
            if epsg:
                flat = 4000 <= epsg < 5000
                tags.append((34735, 3, (1, 1, 0, 3, 1024, 0, 1, 2 if flat else 1, 1025, 0, 1, 1, 2048 if flat else 3072, 0, 1, epsg)))
        if nodata is not None:
            tags.append((42113, 2, (f"{nodata:g}\0".encode(),)))
        entries = bytearray()
        for tag, typ, values in sorted(tags):
            data = values[0] if typ == 2 else struct.pack("<" + str(len(values)) + _TYPES[typ][0][0], *values)
            entries += struct.pack("<HHI", tag, typ, len(data) if typ == 2 else len(values))
            if len(data) <= 4:
                entries += data.ljust(4, b"\0")
            else:
                entries += struct.pack("<I", len(out))
                out += data + b"\0" * (len(data) % 2)
        out += b"\0" * (len(out) % 2)
        out[link : link + 4] = struct.pack("<I", len(out))
        out += struct.pack("<H", len(tags)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def write_tiff(a: np.ndarray, x0: float, y0: float, res: tuple[float, float], nodata: float | None = None, *, epsg: int | None = None, palette: dict[int, tuple[int, int, int]] | None = None) -> bytes:
    """A deflated, single-strip GeoTIFF of (bands, rows, columns)."""
    body = zlib.compress(np.ascontiguousarray(np.moveaxis(a, 0, 2)).astype(a.dtype.newbyteorder("<")).tobytes())
    return tiff_file([(a.shape[1], a.shape[2], [body])], a.shape[0], a.dtype, x0, y0, res, nodata, epsg=epsg, palette=palette, tiled=False)
