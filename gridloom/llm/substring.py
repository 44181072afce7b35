"""Repeated passages, found by super-k-mer partitioning and removed.

A window is ``k`` consecutive words. Its minimiser is the least hash among its ``M``-word runs (leftmost on ties),
so equal windows have the same minimiser at the same place. Consecutive windows of a text that share one minimiser
occurrence form a super-k-mer, which travels as one packed string to the bucket of its minimiser; there sorting
finds equal windows.

Only minimisers that occur more than once in the corpus can hold a repeated window, so the rest is never packed: a
first pass over (minimiser, place) rows, 14 times fewer than bytes of text, decides that. A bucket with very many
strings is split; what its parts find first is then merged by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .staging import drop_staged, release, stage

#: Words of a minimiser.
M = 5
#: Packed strings of one sorted group at most, about; larger buckets are split.
GROUP_ROWS = 2_000
GROUP_BYTES = 1 << 20
_SECOND = 0xB5297A4D3F84D5A5 | 1


def super_kmers(words: tk.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, first window, number of windows, minimiser hash)`` of a slice's super-k-mers, in order. Windows are
    numbered from each row's first word."""
    h = words.hashes()
    n_words = np.diff(words.bounds)
    n_windows = np.maximum(n_words - k + 1, 0)
    total = int(n_windows.sum())
    if total == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64)
    value = tk.windows(h, M)
    place = np.arange(len(value))
    width, span = k - M + 1, 1
    while span < width:  # sliding minimum by doubling; the left one wins ties
        step = min(span, width - span)
        take = value[step:] < value[:-step]
        value, place = np.where(take, value[step:], value[:-step]), np.where(take, place[step:], place[:-step])
        span += step
    row = np.repeat(np.arange(len(n_windows)), n_windows)
    inside = np.arange(total) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    at = words.bounds[:-1][row] + inside
    new = np.ones(total, dtype=bool)
    new[1:] = (place[at[1:]] != place[at[:-1]]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], inside[first], np.diff(np.append(first, total)), value[at[first]]


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _survey(k: int):
    """Each text's words, its digest if nothing goes, and its super-k-mers as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, words in tk.slice_words(b.column(2), lower=False):
                row, start, count, anchor = super_kmers(words, k)
                cut = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32))
                part = b.slice(lo, hi - lo)
                sha = [_digest((t or "").encode().split()) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(np.diff(words.bounds), pa.int64()), pa.array(sha),
                        pa.ListArray.from_arrays(cut, pa.array(anchor.view(np.int64))),
                        pa.ListArray.from_arrays(cut, pa.array(start << 16 | count)),
                    ],
                    names=["u", "id", "n_words", "sha", "anchors", "spans"],
                )
            tk.give_back()

    return run


def _pack(k: int):
    """The packed string of each super-k-mer that is to travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "part", "split", "id", "u", "start", "packed"]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            rows: list[tuple] = []
            size = 0
            for i in range(b.num_rows):
                u, id_, text, runs = (b.column(c)[i].as_py() for c in range(4))
                words = (text or "").encode().split()
                for anchor, span, part in {(r["anchor"], r["span"], r["part"]) for r in runs}:
                    start, count = span >> 16, span & 0xFFFF
                    packed = b" ".join(words[start : start + count + k - 1])
                    rows.append((anchor, part >> 1, bool(part & 1), id_, u, start, packed))
                    size += len(packed) + 40
                if size > 2 << 20:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)
            tk.give_back()

    return run


def _sort_bucket(k: int):
    """Windows of whole bucket groups, sorted: ``kind`` 1 for a run of places, ``a`` to ``b``, where an earlier equal
    window is known; 0 for the first of a split bucket's part, to be merged by its hashes."""

    names = ["kind", "w1", "w2", "id", "u", "a", "b"]

    def found(part: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, us, starts = (part.column(c).to_numpy() for c in ("id", "u", "start"))
        split = np.asarray(part.column("split"))
        data, offsets = tk.text_rows(part.column("packed").combine_chunks().cast(pa.large_binary()).view(pa.large_string()))
        words = tk.Words(data, offsets, lower=False)
        h = words.hashes()
        n = np.diff(words.bounds) - k + 1
        row = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = words.bounds[:-1][row] + inside
        w1, w2 = tk.windows(h, k)[at], tk.windows(h, k, _SECOND)[at]
        start = starts[row] + inside
        order = np.lexsort((start, us[row], ids[row], w2, w1))
        w1, w2, row, start = w1[order], w2[order], row[order], start[order]
        first = np.ones(len(row), dtype=bool)
        first[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        later = ~first
        place, string = start[later], row[later]
        order = np.lexsort((place, string))
        place, string = place[order], string[order]
        new = np.ones(len(place), dtype=bool)
        new[1:] = (string[1:] != string[:-1]) | (place[1:] != place[:-1] + 1)
        at = np.flatnonzero(new)
        string, a, b = string[at], place[at], place[np.append(at[1:], len(place)) - 1] if len(at) else place
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(at), np.int32)), none, none, none, pa.array(us[string]), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=names)
        keep = first & split[row]
        if keep.any():
            string, place = row[keep], pa.array(start[keep].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(string), np.int32)), pa.array(w1[keep].view(np.int64)), pa.array(w2[keep].view(np.int64)), pa.array(ids[string]), pa.array(us[string]), place, place], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.nbytes
            if size < GROUP_BYTES:
                continue
            whole = pa.Table.from_batches(held)
            key, part = whole.column("anchor").to_numpy(), whole.column("part").to_numpy()
            n = int(np.flatnonzero((key != key[-1]) | (part != part[-1]))[-1]) + 1 if (key[0], part[0]) != (key[-1], part[-1]) else 0
            if n:  # the last group may go on in the next batch
                yield from found(whole.slice(0, n))
                held = whole.slice(n).combine_chunks().to_batches()
                size = sum(x.nbytes for x in held)
        if held:
            yield from found(pa.Table.from_batches(held))

    return run


def _remove(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for u, text, marks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for m in marks:
                    gone[m["a"]] += 1
                    gone[m["b"] + k] -= 1
                keep = np.cumsum(gone[:-1]) == 0
                left = [words[i] for i in np.flatnonzero(keep)]
                out.append((u, len(words) - len(left), b" ".join(left).decode()))
            cols = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["u", "n_removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", k: int = 20) -> tuple[DataFrame, DataFrame]:
    """Two tables: ``(u, id, n_words, sha)`` for every row, ``sha`` of all its words joined by one space; and
    ``(u, n_removed, kept)`` for the texts that lose words, with what is left.

    A word goes if a window that covers it also starts earlier: at a smaller id, or in the same text at an earlier
    start. Windows are judged on the input. Rows that repeat an id and a text are one text and lose the same words;
    different texts of one id go by a hash of the text. Null text: no words. A text with a null id has no place in the
    order: it loses nothing and makes no other lose words. Ids are cast to long. Empty table: no rows.
    """
    src = docs.select(F.xxhash64(id_col, text).alias("u"), F.col(id_col).cast("long").alias("id"), text)
    survey = stage(src.mapInArrow(_survey(k), "u long, id long, n_words long, sha string, anchors array<long>, spans array<long>"), "survey")
    rows = stage(survey.select("u", "id", "n_words", "sha"), "texts")
    # Written first: a join with a table, not with an aggregate of the same key, lets Spark split a common anchor.
    repeated = stage(survey.where("id is not null").select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    runs = survey.where("id is not null").select("u", F.explode(F.arrays_zip("anchors", "spans")).alias("r")).select(F.col("r.anchors").alias("anchor"), "u", F.col("r.spans").alias("span"))
    parts = F.ceil(F.col("n") / GROUP_ROWS)
    part = (F.pmod("u", parts) * 2 + (parts > 1).cast("long")).cast("int").alias("part")
    met = runs.join(repeated, "anchor").select("u", F.struct("anchor", "span", part).alias("r"))
    # A text's own super-k-mers: as many as it has words at most.
    wanted = stage(met.groupBy("u").agg(F.collect_list("r").alias("runs")), "wanted")
    drop_staged(survey, repeated)
    release(docs.sparkSession)
    held = stage(src.join(wanted, "u").dropDuplicates(["u"]), "candidates")
    drop_staged(wanted)
    release(docs.sparkSession)
    packed = held.mapInArrow(_pack(k), "anchor long, part int, split boolean, id long, u long, start int, packed binary")
    dealt = packed.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    places = stage(dealt.mapInArrow(_sort_bucket(k), "kind int, w1 long, w2 long, id long, u long, a int, b int"), "places")
    release(docs.sparkSession)
    merged = places.where("kind = 0").withColumn("n", F.row_number().over(Window.partitionBy("w1", "w2").orderBy("id", "u", "a"))).where("n > 1")
    marks = places.where("kind = 1").select("u", "a", "b").union(merged.select("u", "a", "b"))
    # Ranges of one text: as many as it has words at most.
    by_text = marks.groupBy("u").agg(F.collect_list(F.struct("a", "b")).alias("marks"))
    lost = held.select("u", text).join(by_text, "u").mapInArrow(_remove(k), "u long, n_removed long, kept string")
    return rows, lost


def removal_report(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", k: int = 20) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256)`` for each row of ``docs``."""
    rows, lost = remove_repeats(docs, id_col=id_col, text=text, k=k)
    lost = stage(lost.select("u", "n_removed", F.sha2("kept", 256).alias("left")), "lost")
    return rows.join(lost, "u", "left").select(F.col("id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("left", "sha").alias("kept_sha256"))
