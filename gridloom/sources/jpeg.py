"""JPEG files, sequential and Huffman-coded with 8 bits: reading grey or colour, writing grey."""

from __future__ import annotations

import struct
from functools import cache

import numpy as np

#: The places of a block's numbers in zigzag order.
_ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
#: Fixed values of the standard's annex K: steps for luminance, and its codes by length with their symbols.
_STEPS = np.array([
    [16, 11, 10, 16, 24, 40, 51, 61], [12, 12, 14, 19, 26, 58, 60, 55], [14, 13, 16, 24, 40, 57, 69, 56], [14, 17, 22, 29, 51, 87, 80, 62],
    [18, 22, 37, 56, 68, 109, 103, 77], [24, 35, 55, 64, 81, 104, 113, 92], [49, 64, 78, 87, 103, 121, 120, 101], [72, 92, 95, 98, 112, 100, 103, 99],
])
_DC = ((0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0), tuple(range(12)))


def _cosines() -> np.ndarray:
    k, n = np.mgrid[:8, :8]
    return np.where(k == 0, np.sqrt(1 / 8), 0.5) * np.cos((2 * n + 1) * k * np.pi / 16)


_COS = _cosines()


def _codes(lengths: bytes | tuple[int, ...], symbols: bytes | tuple[int, ...]) -> dict[tuple[int, int], int]:
    """(length, code): symbol; codes of one length count up, and go on doubled at the next."""
    out, code, at = {}, 0, 0
    for length, n in enumerate(lengths, 1):
        for _ in range(n):
            out[length, code] = symbols[at]
            code, at = code + 1, at + 1
        code <<= 1
    return out


def _lookup(lengths: bytes, symbols: bytes) -> list[tuple[int, int]]:
    """By the next 16 bits: (length, symbol); length 0 where no code begins so."""
    table = [(0, 0)] * 65536
    for (length, code), symbol in _codes(lengths, symbols).items():
        first = code << (16 - length)
        table[first : first + (1 << (16 - length))] = [(length, symbol)] * (1 << (16 - length))
    return table


class _Bits:
    def __init__(self, data: bytes):
        self.data, self.at, self.held, self.n = data + b"\0" * 8, 0, 0, 0

    def _fill(self) -> None:
        self.held = (self.held << 32 | int.from_bytes(self.data[self.at : self.at + 4].ljust(4, b"\0"))) & (1 << 80) - 1
        self.at += 4
        self.n += 32

    def symbol(self, table: list[tuple[int, int]]) -> int:
        if self.n < 16:
            self._fill()
        length, symbol = table[self.held >> (self.n - 16) & 0xFFFF]
        if not length:
            raise ValueError("broken JPEG data")
        self.n -= length
        return symbol

    def number(self, size: int) -> int:
        """Of so many bits; those that begin with 0 are negative."""
        if not size:
            return 0
        if self.n < size:
            self._fill()
        self.n -= size
        x = self.held >> self.n & (1 << size) - 1
        return x if x >> (size - 1) else x - (1 << size) + 1


def jpeg_array(b: bytes) -> np.ndarray:
    """(rows, columns) of a grey file or (rows, columns, 3) of a colour one, 0 to 255."""
    if b[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    at, steps, tables, parts, every, plain = 2, {}, {}, [], 0, False
    while True:
        while b[at] == 0xFF and b[at + 1] == 0xFF:
            at += 1
        mark, (size,) = b[at + 1], struct.unpack_from(">H", b, at + 2)
        body = b[at + 4 : at + 2 + size]
        at += 2 + size
        if mark == 0xDB:
            while body:
                wide = body[0] >> 4
                steps[body[0] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, 1).astype(np.int64)
                body = body[1 + 64 * (1 + wide) :]
        elif mark == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = _lookup(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif mark == 0xDD:
            (every,) = struct.unpack(">H", body)
        elif mark == 0xEE and body[:5] == b"Adobe":
            plain = body[11] == 0
        elif mark in (0xC0, 0xC1):
            depth, h, w, n = struct.unpack_from(">BHHB", body)
            if depth != 8 or n not in (1, 3):
                raise ValueError("only JPEG files of one or three 8-bit components are read")
            parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        elif mark in (0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("only sequential JPEG files are read")
        elif mark == 0xDA:
            chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
            if len(chosen) != len(parts):
                raise ValueError("only JPEG files with one scan are read")
            break
    # Stretches between restart marks; a stuffed 0 follows each 0xFF of the data.
    stretches, first = [], at
    while True:
        at = b.find(b"\xff", at)
        if at < 0 or at + 1 >= len(b) or (b[at + 1] and not 0xD0 <= b[at + 1] <= 0xD7):
            stretches.append(b[first : at if at >= 0 else len(b)])
            break
        if b[at + 1]:
            stretches.append(b[first:at])
            first = at + 2
        at += 2
    if len(parts) == 1:
        parts = [(parts[0][0], 1, 1, parts[0][3])]
    hm, vm = max(p[1] for p in parts), max(p[2] for p in parts)
    across, down = -(-w // (8 * hm)), -(-h // (8 * vm))
    blocks = [np.zeros((down * v, across * k, 64), dtype=np.int64) for _, k, v, _ in parts]
    unit, total = 0, across * down
    for stretch in stretches:
        bits, last = _Bits(stretch.replace(b"\xff\x00", b"\xff")), [0] * len(parts)
        for unit in range(unit, min(total, unit + every) if every else total):
            r, c = divmod(unit, across)
            for i, (name, k, v, _) in enumerate(parts):
                dc, ac = tables[chosen[name] >> 4], tables[16 | chosen[name] & 15]
                for y in range(v):
                    for x in range(k):
                        block = blocks[i][r * v + y, c * k + x]
                        last[i] += bits.number(bits.symbol(dc))
                        block[0] = last[i]
                        place = 1
                        while place < 64:
                            s = bits.symbol(ac)
                            if s & 15:
                                place += s >> 4
                                if place > 63:
                                    raise ValueError("broken JPEG data")
                                block[place] = bits.number(s & 15)
                                place += 1
                            elif s == 0xF0:
                                place += 16
                            else:
                                break
        unit += 1
    planes = []
    for (_, k, v, q), a in zip(parts, blocks):
        whole = np.zeros_like(a)
        whole[..., _ZIGZAG] = a * steps[q]
        px = _COS.T @ whole.reshape(*a.shape[:2], 8, 8) @ _COS + 128
        px = np.clip(np.rint(px), 0, 255).transpose(0, 2, 1, 3).reshape(8 * a.shape[0], 8 * a.shape[1])
        planes.append(px.repeat(vm // v, axis=0).repeat(hm // k, axis=1)[:h, :w])
    if len(planes) == 1:
        return planes[0].astype(np.uint8)
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    rgb = np.stack(planes if plain else [y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], axis=2)
    return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)


@cache
def _runs() -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Codes for runs of zeros and the size after them: short runs and sizes get short codes."""
    symbols = sorted([0, 0xF0, *(r << 4 | s for r in range(16) for s in range(1, 11))], key=lambda x: (x not in (0, 1, 2), (x >> 4) * 2 + (x & 15) * 3, x))
    lengths = [0, 0, 3, 2, 2, 4, 6, 8, 12, 20, 30, 75, 0, 0, 0, 0]
    return tuple(lengths), tuple(symbols)


def jpeg_grey(a: np.ndarray, quality: int = 90) -> bytes:
    """A grey file of (rows, columns) of 0 to 255."""
    scale = 5000 / quality if quality < 50 else 200 - 2 * quality
    steps = np.clip((_STEPS * scale + 50) // 100, 1, 255).astype(np.int64)
    h, w = a.shape
    full = np.pad(a.astype(float), ((0, -h % 8), (0, -w % 8)), mode="edge") - 128
    blocks = full.reshape(full.shape[0] // 8, 8, full.shape[1] // 8, 8).transpose(0, 2, 1, 3)
    numbers = np.rint(_COS @ blocks @ _COS.T / steps).astype(int).reshape(-1, 64)[:, _ZIGZAG]
    dc = {s: k for k, s in _codes(*_DC).items()}
    ac = {s: k for k, s in _codes(*_runs()).items()}
    held = n = 0
    out = bytearray()

    def put(length: int, code: int) -> None:
        nonlocal held, n
        held, n = held << length | code, n + length
        while n >= 8:
            n -= 8
            out.append(held >> n & 255)
            if out[-1] == 255:
                out.append(0)
        held &= (1 << n) - 1

    def value(table: dict[int, tuple[int, int]], run: int, x: int) -> None:
        size = abs(x).bit_length()
        put(*table[run << 4 | size])
        if size:
            put(size, x if x > 0 else x + (1 << size) - 1)

    last = 0
    for block in numbers.tolist():
        value(dc, 0, block[0] - last)
        last, run = block[0], 0
        end = max((i for i in range(1, 64) if block[i]), default=0)
        for x in block[1 : end + 1]:
            if x:
                value(ac, run, x)
                run = 0
            else:
                run += 1
                if run == 16:
                    put(*ac[0xF0])
                    run = 0
        if end < 63:
            put(*ac[0])
    if n:
        put(8 - n, (1 << 8 - n) - 1)
    part = lambda mark, body: struct.pack(">BBH", 255, mark, len(body) + 2) + body
    table = lambda k, t: bytes([k, *t[0], *t[1]])
    head = part(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0") + part(0xDB, bytes([0, *steps.ravel()[_ZIGZAG].tolist()])) + part(0xC0, struct.pack(">BHHBBBB", 8, h, w, 1, 1, 0x11, 0))
    return b"\xff\xd8" + head + part(0xC4, table(0, _DC) + table(16, _runs())) + part(0xDA, bytes([1, 1, 0, 0, 63, 0])) + bytes(out) + b"\xff\xd9"
