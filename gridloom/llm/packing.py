"""Best-fit packing of token pieces into sequences, planned on counts by length.

The planner sees only how many pieces there are of each length (``CAPACITY`` numbers, whatever the corpus). Long pieces
open sequences. For each gap it looks for what exactly fills it: one short length, two, or three, in indexes of sums
under the counts still available, and uses each combination as often as they allow. Gaps without one take the longest
piece that fits, and what is left is looked up again. The plan is a list of patterns with counts; pieces then find
their place by their rank in their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .staging import stage
from .tokens import token_batches

CAPACITY = 1024
VOCABULARY = "byte_bpe_50k.json"
#: Pieces of at most this part of a sequence are short: they fill gaps, the others open sequences.
SHORT = 8
#: Rows of a plan that are broadcast, at most; a longer plan is joined by shuffle.
PLAN_ROWS = 500_000
#: Pieces of one length that are ranked together, about.
RANKED = 5_000


class _Lengths:
    """How many short pieces of each length are left, with the pairs that make a sum looked up among these."""

    def __init__(self, counts: np.ndarray, short: int):
        self.left = np.where(np.arange(len(counts)) <= short, counts, 0).astype(np.int64)
        self.have = self.left > 0
        self.short = short
        self.pairs: np.ndarray | None = None

    def use(self, lengths: list[int], n: int) -> None:
        for x in lengths:
            self.left[x] -= n
            if self.left[x] == 0:
                self.have[x] = False
                self.pairs = None

    def times(self, lengths: list[int]) -> int:
        return min(int(self.left[x]) // lengths.count(x) for x in lengths)

    def pair(self, total: int, beside: list[int]) -> list[int] | None:
        """The most even pair of this sum that is there beside the pieces already chosen."""
        a = np.arange((total + 1) // 2, min(total - 1, self.short) + 1)
        for x in a[self.have[a] & self.have[total - a]].tolist():
            take = [*beside, x, total - x]
            if self.times(take):
                return take
        return None

    def makes_pairs(self) -> np.ndarray:
        """Which sums some pair has."""
        if self.pairs is None:
            size = 2 * self.short + 2
            f = np.fft.rfft(self.have[: self.short + 1].astype(float), size)
            self.pairs = np.fft.irfft(f * f, size) > 0.5
        return self.pairs

    def exact(self, gap: int) -> list[int] | None:
        """One, two or three pieces that fill the gap."""
        if gap <= self.short and self.have[gap]:
            return [gap]
        if gap <= 2 * self.short and (found := self.pair(gap, [])):
            return found
        if gap > 3 * self.short:
            return None
        a = np.arange(-(-gap // 3), min(gap - 2, self.short) + 1)
        a = a[gap - a <= 2 * self.short]
        for x in a[self.have[a] & self.makes_pairs()[gap - a]].tolist():
            if found := self.pair(gap - x, [x]):
                return found
        return None

    def longest(self, most: int) -> int:
        """The longest piece of at most this length; 0 if there is none."""
        at = np.flatnonzero(self.have[: min(most, self.short) + 1])
        return int(at[-1]) if len(at) else 0


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """``(lengths, how many sequences)``; ``counts[n]`` pieces have length n, 0 < n <= capacity.

    Long pieces open the sequences, longest first, each in the least gap that takes it. Then the gaps, least first, are
    filled exactly from the short pieces while the counts allow. Exact sums are plenty among short pieces, and long ones
    are never spent on each other's gaps, where later ones would miss them."""
    counts = np.asarray(counts)
    short = capacity // SHORT
    out: list[tuple[list[int], int]] = []
    gaps: dict[int, list[tuple[list[int], int]]] = {}

    def put(gap: int, held: list[int], n: int) -> None:
        if n and gap:
            gaps.setdefault(gap, []).append((held, n))
        elif n:
            out.append((held, n))

    def least(at_least: int) -> tuple[int, list[int], int]:
        gap = min((g for g in gaps if g >= at_least), default=0)
        held, n = gaps[gap].pop() if gap else ([], 0)
        if gap and not gaps[gap]:
            del gaps[gap]
        return gap, held, n

    def begin(length: int, n: int) -> int:
        """New sequences of one length; how many pieces went."""
        each = min(capacity // length, n)
        put(capacity - each * length, [length] * each, n // each)
        return n // each * each

    for length in range(capacity, short, -1):
        n = int(counts[length])
        while n:
            gap, held, m = least(length)
            k = min(m, n)
            if k:
                put(gap, held, m - k)
                put(gap - length, [*held, length], k)
            n -= k or begin(length, n)
    pieces = _Lengths(counts, short)
    while gaps or pieces.longest(short):
        if not gaps:
            x = pieces.longest(short)
            pieces.use([x], begin(x, int(pieces.left[x])))
            continue
        gap, held, m = least(1)
        found = pieces.exact(gap) or [x for x in [pieces.longest(gap)] if x]
        if not found:
            out.append((held, m))
            continue
        k = min(pieces.times(found), m)
        pieces.use(found, k)
        put(gap, held, m - k)
        put(gap - sum(found), [*held, *found], k)
    return out


def tokenise(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, end: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """``(id, piece, start, length, ids)`` of each text: its token ids and then ``end``. Longer ones are cut into
    pieces of ``capacity``, the first of which may be shorter. ``ids`` is binary, little-endian unsigned 32-bit.
    Null text: empty, so only ``end``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column(0)
            for lo, hi, ids, n in token_batches(b.column(1), vocabulary):
                size = n + 1
                ends = np.cumsum(size)
                flat = np.full(int(ends[-1]), end, dtype="<u4")
                inside = np.ones(len(flat), dtype=bool)
                inside[ends - 1] = False
                flat[inside] = ids
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                lead = size - (pieces - 1) * capacity
                start = np.where(piece == 0, 0, lead[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, lead[row], capacity)
                at = np.concatenate([[0], np.cumsum(length)]).astype(np.int32) * 4
                body = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(at), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([key.take(pa.array(row + lo)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), body], names=["id", "piece", "start", "length", "ids"])
            tk.give_back()

    src = docs.select(F.col(id_col).cast("long").alias("id"), text)
    return src.mapInArrow(run, "id long, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


def pack(pieces: DataFrame, *, key: tuple[str, ...] = ("doc_id", "piece"), capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (column ``length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Sequences are filled without gaps from 0. All other columns stay; ``pieces`` is read twice, so give a written
    table. Rows that repeat a key are pieces of their own. Empty table: no rows.
    """
    spark = pieces.sparkSession
    found = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # a row for each length
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in found:
        counts[r["length"]] = r["n"]
    slots, base = [], 0
    taken = np.zeros(capacity + 1, dtype=np.int64)
    for lengths, n in plan(counts, capacity):
        at = 0
        for x in lengths:
            slots.append((x, int(taken[x]), int(taken[x]) + n, base, at))
            taken[x] += n
            at += x
        base += n
    # Patterns times pieces of a pattern; grows with the number of lengths, not of pieces.
    places = spark.createDataFrame(slots, "s_length long, lo long, hi long, base long, offset long")
    places = F.broadcast(places) if len(slots) <= PLAN_ROWS else places
    parts = int(max(1, counts.max() // RANKED))
    bucket = F.pmod(F.xxhash64(*key), F.lit(parts)).alias("bucket")
    rows = pieces.select("*", bucket)
    sizes = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select(F.col("length").alias("b_length"), F.col("bucket").alias("b_bucket"), F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*key)) - 1)
    ranked = ranked.join(before, (F.col("length") == F.col("b_length")) & (F.col("bucket") == F.col("b_bucket"))).withColumn("rank", F.col("rank") + F.col("ahead"))
    put = ranked.join(places, (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return put.select(*pieces.columns, (F.col("base") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its checksum and its place: ``(id, piece, start, length, ids_crc32,
    sequence_id, offset)``."""
    pieces = tokenise(docs, id_col=id_col, text=text, capacity=capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(stage(pieces, "pieces"), key=(id_col, "piece"), capacity=capacity)
