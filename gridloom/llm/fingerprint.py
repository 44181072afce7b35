"""Document fingerprints by a homomorphic multiset hash.

A text is a multiset of passages: its paragraphs (lines), each cut into passages of up to ``PASSAGE_WORDS`` words
counted from the paragraph's start; passages cover every byte. Each passage is hashed to a wide vector of +1 and
-1, and a fingerprint is the sum of these vectors modulo 2**16. So

* the order of passages does not matter, and equal texts have equal fingerprints;
* adding or removing a passage adds or subtracts its vector (:func:`combine`), without the rest of the text;
* the squared distance of two fingerprints estimates the size of the multisets' difference (:func:`likeness`).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

#: Coordinates of a fingerprint, 16 bits each.
WIDTH = 256
PASSAGE_WORDS = 8
#: Text of one sorted range, about. Ranges grow beyond it only where there would be more than the driver should hold
#: borders of (at 100 TB they have half a gigabyte); they are streamed, so their size is no matter of memory.
RANGE_CHARS = 6_000_000
MAX_RANGES = 200_000
_NULL_ID = -(2**63)


def _passages(words: tk.Words) -> tuple[np.ndarray, np.ndarray]:
    """Byte places where passages begin, and their numbers cumulated by row."""
    data, offsets, start = words.data, words.offsets, words.start
    row_first = np.zeros(len(start) + 1, dtype=bool)
    row_first[words.bounds[:-1][np.diff(words.bounds) > 0]] = True
    lines = np.flatnonzero(data == 10)
    before = np.searchsorted(lines, start)
    new = row_first[:-1].copy()
    new[1:] |= before[1:] != before[:-1]
    at = np.arange(len(start))
    first_of = np.maximum.accumulate(np.where(new, at, 0)) if len(start) else at
    begin = (at - first_of) % PASSAGE_WORDS == 0
    places = start[begin].copy()
    # Each row's first passage begins with the row; a row of white space only is one passage.
    row_of = np.searchsorted(offsets, places, "right") - 1
    firsts = np.ones(len(places), dtype=bool)
    firsts[1:] = row_of[1:] != row_of[:-1]
    places[firsts] = offsets[row_of[firsts]]
    blank = np.flatnonzero((np.diff(offsets) > 0) & (np.diff(words.bounds) == 0))
    places = np.sort(np.concatenate([places, offsets[blank]]))
    return places, np.searchsorted(places, offsets)


def sums(column: pa.Array) -> np.ndarray:
    """Sums of texts before the modulus, ``(rows, WIDTH)`` of int64; empty and null texts have the zero vector."""
    out = np.zeros((len(column), WIDTH), dtype=np.int64)
    for lo, hi, words in tk.slice_words(column, lower=False):
        places, bounds = _passages(words)
        n = len(words.data)
        power, inverse = tk._powers(tk._BASE, n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(tk._BYTE[words.data] * power[:n], out=total[1:])
        ends = np.append(places[1:], n)
        h = (total[ends] - total[places]) * inverse[places] ^ (ends - places).astype(np.uint64)
        step = 4096
        done: dict[int, np.ndarray] = {}
        for a in range(0, len(places), step):
            b = min(a + step, len(places))
            lanes = np.stack([tk.mix64(h[a:b] + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & tk._MASK)) for i in range(WIDTH // 64)], axis=1)
            bits = np.unpackbits(lanes.view(np.uint8).reshape(b - a, WIDTH // 8), axis=1)
            first, last = np.searchsorted(bounds, a, "right") - 1, np.searchsorted(bounds, b, "left")
            for row in range(first, last):
                x, y = max(bounds[row], a), min(bounds[row + 1], b)
                if y > x:
                    ones = bits[x - a : y - a].sum(axis=0, dtype=np.int64)
                    done[row] = done.get(row, 0) + 2 * ones - (y - x)
        for row, v in done.items():
            out[lo + row] = v
    return out


def vectors(column: pa.Array) -> np.ndarray:
    """Fingerprints of texts, ``(rows, WIDTH)`` of int16; empty and null texts have the zero vector."""
    return sums(column).astype(np.int16)


def combine(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """Fingerprint of the union (sign 1) or the difference (sign -1) of two multisets of passages."""
    return (a.astype(np.int64) + sign * b.astype(np.int64)).astype(np.int16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share, by row, of passages in common: 1 - |a - b|^2 / (|a|^2 + |b|^2), held to 0..1; equal
    ones (two empty ones too) give 1. Takes :func:`sums`; fingerprints serve only while no sum has passed 16 bits."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    apart = ((x - y) ** 2).sum(axis=1)
    both = (x**2).sum(axis=1) + (y**2).sum(axis=1)
    return np.where(apart == 0, 1.0, np.clip(1 - apart / np.maximum(both, 1), 0, 1))


def as_text(v: np.ndarray) -> list[str]:
    """Fingerprints, or sums modulo 2**16, in base64."""
    return [base64.b64encode(x.astype("<i2").tobytes()).decode() for x in v]


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), dtype="<i2")


def fingerprint(docs: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """``keep`` columns and ``fingerprint`` (base64 of little-endian 16-bit sums) of each row; null text: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = as_text(vectors(b.column(len(keep))))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(v, pa.string())], names=[*keep, "fingerprint"])

    src = docs.select(*keep, text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]), "fingerprint string"])
    return src.mapInArrow(run, schema)


def _ranges(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Keys at which ranges begin (each one is a row's key), and the least key."""
    size = docs.agg(F.sum(F.length("text")).alias("c"), F.min("key").alias("k")).first()
    n = int(min(MAX_RANGES, max(1, (size["c"] or 0) // RANGE_CHARS)))
    if n == 1:
        return np.zeros(0, np.int64), size["k"]
    cuts = docs.agg(F.percentile_approx("key", [i / n for i in range(1, n)], min(20 * n, 1_000_000))).first()[0] or []
    return np.array(sorted({c for c in cuts if c != size["k"]}), dtype=np.int64), size["k"]


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ordered into ranges so that each text's successor (ascending id, the first after the last) is the row
    after it. The row that begins a range also travels to the range before it; the first of all, to the last."""
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("key"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cuts, least = _ranges(src)
    last = len(cuts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column(0).to_numpy(zero_copy_only=False)
            r = np.searchsorted(cuts, key, "right")
            ghost = np.zeros(len(key), dtype=np.int32)
            first = np.flatnonzero((r > 0) & (cuts[np.maximum(r - 1, 0)] == key)) if last else np.zeros(0, int)
            wrap = np.flatnonzero(key == least) if least is not None else np.zeros(0, int)
            take = np.concatenate([np.arange(len(key)), first, wrap])
            r = np.concatenate([r, r[first] - 1, np.full(len(wrap), last)])
            ghost = np.concatenate([ghost, np.full(len(first), 1), np.full(len(wrap), 2)]).astype(np.int32)
            if len(take) > len(key):
                b = b.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int64)), pa.array(ghost), *b.columns], names=["r", "ghost", "key", "id", "text"])

    dealt = src.mapInArrow(deal, "r long, ghost int, key long, id long, text string")
    return dealt.repartition(last + 1, "r").sortWithinPartitions("r", "ghost", "key", "text")


def edited_pairs(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next text, compared.

    The edited text: the last floor(n/4) code points replaced by the first as many (or all) of the next text, in
    ascending id (after the last: the first; rows of one id in order of text; null ids first; null text: empty).
    Returns ``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``. One row
    alone follows itself. Empty table: no rows.
    """
    rows = with_next(docs, id_col=id_col, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far: its range, ghost, id, text and vector
        for b in batches:
            offsets = tk.text_rows(b.column(4))[1]
            for lo, hi in tk.slices(offsets):
                part = b.slice(lo, hi - lo)
                r, ghost = part.column(0).to_pylist(), part.column(1).to_pylist()
                ids, texts = part.column(3).to_pylist(), part.column(4).to_pylist()
                v = sums(part.column(4))
                if held is not None:
                    r, ghost, ids, texts = [held[0], *r], [held[1], *ghost], [held[2], *ids], [held[3], *texts]
                    v = np.vstack([held[4][None], v])
                held = (r[-1], ghost[-1], ids[-1], texts[-1], v[-1])
                at = [i for i in range(len(r) - 1) if not ghost[i] and r[i] == r[i + 1]]
                if not at:
                    continue
                edited = []
                for i in at:
                    n = len(texts[i])
                    edited.append(texts[i][: n - n // 4] + texts[i + 1][: n // 4])
                e = sums(pa.array(edited, pa.large_string()))
                mine = v[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[i] for i in at], pa.int64()), pa.array([len(texts[i]) for i in at], pa.int64()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
                        pa.array(as_text(mine)), pa.array(as_text(e)),
                        pa.array(likeness(mine, e)), pa.array(likeness(mine, v[[i + 1 for i in at]])),
                    ],
                    names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    # A range's rows sort by ghost first, so the copies that follow stand after its own rows.
    out = rows.mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)

