"""Vectorised work on Arrow text buffers: words, word hashes and window hashes, whole batches at a time.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, which is what ``[^\\x20\\x09-\\x0D]+`` finds in a
text. Nulls count as empty texts. All hashes are fixed functions of the bytes (no per-process seed), so reruns
and retried tasks agree.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; bounds a worker's memory whatever the batch holds.
SLICE_BYTES = 1 << 18

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = np.random.Generator(np.random.PCG64(20240601)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_SEQ = 0xD6E8FEB86659FD93 | 1
_MASK = (1 << 64) - 1
_KEPT: dict = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)  # glibc's
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def give_back() -> None:
    """Return what a batch has freed to the system; workers live on between tasks and would hold it."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def kept_by(operator: str) -> dict:
    """What this worker keeps between tasks of one operator. What another one kept goes: workers are shared by all."""
    if _KEPT.get("operator") != operator:
        _KEPT.clear()
        _KEPT.update(operator=operator, things={})
        give_back()
    return _KEPT["things"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i below n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = -(-n // (1 << 18)) << 18
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.empty(size, dtype=np.uint64)
            out[0], done = 1, 1
            while done < size:
                more = min(done, size - done)
                np.multiply(out[:more], np.uint64(pow(b, done, 1 << 64)), out=out[done : done + more])
                done += more
            both.append(out)
        have = _POWERS[base] = (both[0], both[1])
    return have


def text_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets (nulls: empty rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if column.null_count and len(column):  # as a rule a null takes no bytes; only else is the column copied
        ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        if np.diff(ends)[np.asarray(column.is_null())].any():
            column = column.fill_null("")
            _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None or len(data) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone)."""
    lo, n, done = 0, len(offsets) - 1, 0
    while lo < n:
        done += 1
        if done % 4 == 0:
            give_back()
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


class Words:
    """The words of some rows: ``start``/``end`` byte places and ``bounds``, word counts cumulated by row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        inside = np.zeros(len(data) + 2, dtype=bool)
        np.logical_not(_WS[data], out=inside[1:-1])
        begins = inside[1:] & ~inside[:-1]
        ends = ~inside[1:] & inside[:-1]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        cut = cut[inside[cut] & inside[cut + 1]]  # a row's last word touches the next row's first
        begins[cut] = True
        ends[cut] = True
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends)
        self.bounds = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        n = len(self.data)
        power, inverse = _powers(_BASE, n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * power[:n], out=total[1:])
        h = (total[self.end] - total[self.start]) * inverse[self.start]
        return mix64(h ^ (self.end - self.start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def windows(h: np.ndarray, k: int, base: int = _SEQ) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values (runs may cross rows; callers leave those out)."""
    n = len(h)
    if n < k:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _powers(base, n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * power[:n], out=total[1:])
    return mix64((total[k:] - total[:-k]) * inverse[: n - k + 1] + np.uint64(k))


def slice_words(column: pa.Array, lower: bool, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """``(first row, row after last, words)`` of a batch, in slices of bounded size."""
    data, offsets = text_rows(column)
    for lo, hi in slices(offsets, limit):
        a, b = offsets[lo], offsets[hi]
        yield lo, hi, Words(data[a:b], offsets[lo : hi + 1] - a, lower)


class Known:
    """A table from 64-bit hashes to numbers, probed for whole arrays at once. Hash 0 counts as 1."""

    def __init__(self, bits: int):
        self.bits = bits
        self.key = np.zeros(1 << bits, dtype=np.uint64)
        self.value = np.zeros(1 << bits, dtype=np.int32)
        self.n = 0

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the hashes; -1 for those unknown."""
        h = np.maximum(h, np.uint64(1))
        out = np.full(len(h), -1, dtype=np.int64)
        todo, slot = np.arange(len(h)), self._slot(h)
        while len(todo):
            k = self.key[slot]
            hit = k == h[todo]
            out[todo[hit]] = self.value[slot[hit]]
            go = ~hit & (k != 0)
            todo, slot = todo[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, h: np.ndarray, value: np.ndarray) -> None:
        """Put in distinct hashes that are not there; the caller keeps the table at most half full."""
        h = np.maximum(h, np.uint64(1))
        todo, slot = np.arange(len(h)), self._slot(h)
        self.n += len(h)
        while len(todo):
            _, first = np.unique(slot, return_index=True)
            first = first[self.key[slot[first]] == 0]
            self.key[slot[first]] = h[todo[first]]
            self.value[slot[first]] = value[todo[first]]
            left = self.key[slot] != h[todo]
            todo, slot = todo[left], (slot[left] + 1) & ((1 << self.bits) - 1)
