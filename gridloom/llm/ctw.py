"""Language-model scoring by context-tree weighting over bytes.

Each byte is eight binary decisions, each with a context tree over the ``DEPTH`` bytes before it. A node keeps how
often either bit followed its context in the training texts; its Krichevsky-Trofimov estimate is mixed with what its
longer contexts say, with weights given by how well each would have coded the training data. Texts end with a byte
that UTF-8 does not have, so scores are log10 probabilities of whole texts.

All counts come from the corpus by shuffles. Texts are dealt into blocks; a block asks only for the contexts and the
words it has, once each, and these answers meet its texts again. Trees with different last two bytes are apart, so
they are weighted in parallel; only the two top levels (at most 256 * 255 nodes) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .staging import release, stage

DEPTH = 4
END = 0xFF
_PAIR = 8 * (DEPTH - 1)  # bits of a gram below its last two context bytes
#: Bytes of text that share one set of answers, about.
BLOCK_BYTES = 24 << 20
#: Blocks that are numbered, so that each has a partition of its own; of more, several meet in one, by a hash.
NUMBERED, TOGETHER = 100_000, 8
#: Bytes of text handled at once here.
_SLICE = 1 << 19
#: Fixed point for summing log probabilities in any order with one result.
_FIXED = float(1 << 20)
_HALF = np.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Log of the gamma function for x >= 0.5, by Stirling's series after eight steps up."""
    low = np.ones_like(x)
    for i in range(8):
        low = low * (x + i)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) - np.log(low)


def kt_block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - np.log(np.pi)


def _kt_next(zeros: np.ndarray, ones: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1)


def _mixed(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted log probability of nodes, and the weight of their own estimates; ``below``: their children's sum."""
    own = _HALF + kt_block(zeros, ones)
    both = np.logaddexp(own, _HALF + below)
    return both, np.exp(own - both)


def grams(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end: the bytes before it, the last one first, and itself, as one number;
    and where texts begin among these (``offsets`` cumulated with one end each)."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    padded = np.full(len(data) + rows * (depth + 1), END, dtype=np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(rows) * (depth + 1) + depth, size)] = data
    p = padded.astype(np.uint64)
    n = max(0, len(p) - depth)
    g = p[depth:].copy() if n else np.zeros(0, np.uint64)
    for back in range(1, depth + 1):
        g |= p[depth - back : depth - back + n] << np.uint64(8 * (depth + 1 - back))
    first = offsets[:-1] + np.arange(rows) * (depth + 1)  # a text's first gram; those after its last cross to the next
    bounds = np.concatenate([[0], np.cumsum(size + 1)])
    take = np.arange(bounds[-1]) + np.repeat(first - bounds[:-1], size + 1)
    return g[take].view(np.int64), bounds


class _Tally:
    """Counts of distinct keys, merged from time to time."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size, self.distinct = 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts.astype(np.int32))
        self.size += len(keys)
        if self.size > max(400_000, self.distinct // 2) and len(self.keys) > 1:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int32)
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]
        self.keys, self.counts, self.size, self.distinct = [keys], [counts], 0, len(keys)
        return keys, counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: grams (kind 0) and words (kind 1) with their counts in training texts (0 where only others have
    them), and training tokens and texts (kind 2, keys 0 and 1). A block's rows come together."""
    now: int | None = None
    tally: tuple[_Tally, _Tally] = (_Tally(), _Tally())
    tokens = texts = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for kind in (0, 1):
            keys, counts = tally[kind].merge()
            for at in range(0, len(keys), 1 << 16):
                k = keys[at : at + (1 << 16)].astype(np.uint64).view(np.int64)
                yield _answers(now, kind, k, counts[at : at + (1 << 16)])
        yield _answers(now, 2, np.array([0, 1]), np.array([tokens, texts]))

    for b in batches:
        block, trained = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
        data, offsets = tk.text_rows(b.column(2))
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for x, y in zip(edges, edges[1:]):
            if y == x:
                continue
            if now is not None and now != int(block[x]):
                yield from flush()
                tally, tokens, texts = (_Tally(), _Tally()), 0, 0
            now = int(block[x])
            for lo, hi in tk.slices(offsets[x : y + 1], _SLICE):
                lo, hi = lo + x, hi + x
                part = data[offsets[lo] : offsets[hi]]
                at = offsets[lo : hi + 1] - offsets[lo]
                g, bounds = grams(part, at)
                words = tk.Words(part, at, lower=True)
                h = words.hashes()
                use = trained[lo:hi]
                for t, keys, ends in ((tally[0], g, bounds), (tally[1], h, words.bounds)):
                    mine = np.repeat(use, np.diff(ends))
                    t.add(*np.unique(keys[mine], return_counts=True))
                    rest = np.unique(keys[~mine])
                    t.add(rest, np.zeros(len(rest), np.int64))
                tokens += int((np.diff(words.bounds) + 1)[use].sum())
                texts += int(use.sum())
    if now is not None:
        yield from flush()


def _answers(block: int, kind: int, keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    n = len(keys)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, block, np.int64)), pa.array(np.full(n, kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(values.astype(np.int64))], names=["block", "kind", "key", "n"])


def weigh(keys: np.ndarray, n: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """Whole trees of some last two bytes: for each gram (ascending) the probabilities of its eight bits as mixed
    from ``depth`` up to 2, and by bit the depth-2 nodes: (last byte, bit prefix, zeros, ones, weighted log)."""
    byte = keys & 255
    out = np.empty((len(keys), 8))
    nodes = []
    for t in range(8):
        prefix, bit = (1 << t) | (byte >> (8 - t)), (byte >> (7 - t) & 1).astype(bool)
        node = (keys >> 8 << 8) | prefix  # ascending, as the grams are
        new = np.concatenate([[True], node[1:] != node[:-1]])
        first = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        node = node[first]
        ones = np.add.reduceat(np.where(bit, n, 0), first).astype(np.float64)
        zeros = np.add.reduceat(np.where(bit, 0, n), first).astype(np.float64)
        levels = [(zeros, ones, np.ones(len(node)), number)]  # the deepest nodes stand for themselves
        weighted = kt_block(zeros, ones)
        for d in range(depth - 1, 1, -1):
            node, up = np.unique((node >> 16 << 8) | (node & 255), return_inverse=True)
            below = np.bincount(up, weighted, len(node))
            zeros, ones = np.bincount(up, zeros, len(node)), np.bincount(up, ones, len(node))
            weighted, own = _mixed(zeros, ones, below)
            number = up[number]
            levels.append((zeros, ones, own, number))
        p = np.zeros(len(keys))
        for zeros, ones, own, at in levels:
            p = own[at] * _kt_next(zeros[at], ones[at], bit) + (1 - own[at]) * p
        out[:, t] = p
        nodes.append((node >> 16, node & 255, zeros, ones, weighted))
    return out, nodes


def _weigh_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, n), sorted by key, with all grams of a last pair of bytes in one partition."""
    names = ["key", "bits", "last", "prefix", "zeros", "ones", "fixed"]

    def done(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        bits, nodes = weigh(keys, n)
        raw = pa.array([r.tobytes() for r in bits], pa.binary())
        k = len(keys)
        yield pa.RecordBatch.from_arrays([pa.array(keys), raw, *(pa.nulls(k, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=names)
        last, prefix, zeros, ones, weighted = (np.concatenate(x) for x in zip(*nodes))
        k = len(last)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(last.astype(np.int32)), pa.array(prefix.astype(np.int32)), pa.array(zeros.astype(np.int64)), pa.array(ones.astype(np.int64)), pa.array(np.rint(weighted * _FIXED).astype(np.int64))],
            names=names,
        )

    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for b in batches:
        keys, n = np.concatenate([keys, b.column(0).to_numpy()]), np.concatenate([n, b.column(1).to_numpy()])
        if len(keys) > 100_000 and keys[0] >> _PAIR != keys[-1] >> _PAIR:
            cut = int(np.searchsorted(keys, keys[-1] >> _PAIR << _PAIR))
            yield from done(keys[:cut], n[:cut])
            keys, n = keys[cut:], n[cut:]
    if len(keys):
        yield from done(keys, n)


@dataclass
class Top:
    """Weights and counts of the two top levels, by (last byte, bit prefix) and by bit prefix."""

    own1: np.ndarray
    zeros1: np.ndarray
    ones1: np.ndarray
    own0: np.ndarray
    zeros0: np.ndarray
    ones0: np.ndarray

    @staticmethod
    def of(last: np.ndarray, prefix: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> Top:
        z, o, s = (np.zeros((256, 256)) for _ in range(3))
        z[last, prefix], o[last, prefix], s[last, prefix] = zeros, ones, below
        weighted, own1 = _mixed(z, o, s)
        z0, o0 = z.sum(axis=0), o.sum(axis=0)
        _, own0 = _mixed(z0, o0, weighted.sum(axis=0))
        return Top(own1, z, o, own0, z0, o0)

    def log10(self, keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """Of each gram's byte in its context."""
        byte, last = keys & 255, keys >> 8 * DEPTH
        out = np.zeros(len(keys))
        for t in range(8):
            prefix, bit = (1 << t) | (byte >> (8 - t)), (byte >> (7 - t) & 1).astype(bool)
            p = self.own1[last, prefix] * _kt_next(self.zeros1[last, prefix], self.ones1[last, prefix], bit) + (1 - self.own1[last, prefix]) * bits[:, t]
            out += np.log10(self.own0[prefix] * _kt_next(self.zeros0[prefix], self.ones0[prefix], bit) + (1 - self.own0[prefix]) * p)
        return out


def score(docs: DataFrame, trained: Column, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of each row.

    ``trained`` is a condition on the columns: the texts that counts come from. ``score`` is the log10 probability of
    the whole text (unchanged bytes and the end). ``base_score`` is of add-one unigrams over words (A-Z lower-cased)
    and one end: the sum of log10((c + 1) / (N + V + 1)). Null text: empty, so only the end. Without training texts
    every bit has probability one half. Words are counted by 64-bit hashes. Empty table: no rows.
    """
    columns = [F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(trained, F.lit(False)).alias("trained")]
    place = [F.input_file_name().alias("file"), F.input_file_block_start().alias("start"), F.col("_metadata.row_index").alias("at")]
    try:
        src = docs.select(*columns, *place)
    except AnalysisException:  # not rows of Parquet files
        src = stage(docs.select(*columns), "texts").select("id", "text", "trained", *place)
    # A block is a stretch of what one task reads of a file, so counting needs no shuffle of the texts.
    whole = src.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    step = max(1, int(whole["n"] * BLOCK_BYTES / max(1, whole["bytes"] or 0)))
    src = src.select("id", "text", "trained", F.xxhash64("file", "start", F.floor(F.col("at") / step)).alias("block"))
    found = [r["block"] for r in src.select("block").distinct().limit(NUMBERED + 1).collect()]
    if len(found) <= NUMBERED:
        number = F.broadcast(docs.sparkSession.createDataFrame([(x, i) for i, x in enumerate(sorted(found))], "block long, number int"))
        src = src.join(number, "block").select("id", "text", "trained", F.col("number").cast("long").alias("block"))
        deal = lambda df: df.repartitionById(max(1, len(found)), F.col("block").cast("int"))
    else:
        parts = src.select("block").distinct().count() // TOGETHER
        deal = lambda df: df.repartition(parts, "block")
    asked = stage(src.select("block", "trained", "text").mapInArrow(_count, "block long, kind int, key long, n long"), "asked")
    gram = asked.where("kind = 0").groupBy("key").agg(F.sum("n").alias("n"))
    trees = gram.repartition(F.shiftright("key", _PAIR)).sortWithinPartitions("key").select("key", "n")
    weighed = stage(trees.mapInArrow(_weigh_trees, "key long, bits binary, last int, prefix int, zeros long, ones long, fixed long"), "trees")
    top_rows = weighed.where("last is not null").groupBy("last", "prefix").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("fixed").alias("fixed")).toArrow()
    top = Top.of(*(top_rows.column(c).to_numpy() for c in ("last", "prefix", "zeros", "ones")), top_rows.column("fixed").to_numpy() / _FIXED)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float64).reshape(-1, 8)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(top.log10(b.column(0).to_numpy(), bits))], names=["key", "x"])

    release(docs.sparkSession)
    coded = weighed.where("key is not null").select("key", "bits").mapInArrow(finish, "key long, x double")
    totals = {r["key"]: r["n"] for r in asked.where("kind = 2").groupBy("key").agg(F.sum("n").alias("n")).collect()}
    n_tokens, n_texts = totals.get(0) or 0, totals.get(1) or 0
    # A word has a row for each part of a block at most, so counting it in its partition meets no hot key.
    word = asked.where("kind = 1").select("block", "key", F.sum("n").over(Window.partitionBy("key")).alias("n"))
    known = asked.where("kind = 1").groupBy("key").agg(F.max("n").alias("n")).where("n > 0").count()
    distinct = known + (1 if n_texts else 0)
    answers = asked.where("kind = 0").select("block", "key").join(coded, "key").select("block", F.lit(0).alias("kind"), "key", "x")
    answers = answers.union(word.select("block", F.lit(1), "key", F.col("n").cast("double")))
    empty = [F.lit(None).cast(t) for t in ("long", "double")]
    rows = answers.select("block", "kind", "key", "x", F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("boolean").alias("trained"))
    rows = deal(rows.union(src.select("block", F.lit(2), *empty, "id", "text", "trained"))).sortWithinPartitions("block", "kind")
    denominator = np.log10(n_tokens + distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        told: dict[int, list] = {0: [], 1: []}
        tables: dict[int, tuple[tk.Known, np.ndarray]] = {}

        def table(kind: int) -> tuple[tk.Known, np.ndarray]:
            if kind not in tables:
                keys = np.concatenate([k for k, _ in told[kind]] or [np.zeros(0, np.int64)]).view(np.uint64)
                if kind == 0:
                    keys = tk.mix64(keys)
                values = np.concatenate([v for _, v in told[kind]] or [np.zeros(0)])
                t = tk.Known(max(4, int(2 * len(keys) + 1).bit_length()))
                t.add(keys, np.arange(len(keys)))
                told[kind].clear()
                tables[kind] = (t, values)
            return tables[kind]

        for b in batches:
            block, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            edges = [0, *(np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist(), len(block)]
            for x, y in zip(edges, edges[1:]):
                if y == x:
                    continue
                if now != int(block[x]):
                    now = int(block[x])
                    told, tables = {0: [], 1: []}, {}
                part = b.slice(x, y - x)
                if kind[x] < 2:
                    told[int(kind[x])].append((part.column(2).to_numpy(), part.column(3).to_numpy()))
                    continue
                data, offsets = tk.text_rows(part.column(5))
                use = part.column(6).to_numpy(zero_copy_only=False)
                for lo, hi in tk.slices(offsets, _SLICE):
                    at = offsets[lo : hi + 1] - offsets[lo]
                    text_part = data[offsets[lo] : offsets[hi]]
                    g, bounds = grams(text_part, at)
                    where, values = table(0)
                    logs = np.add.reduceat(values[where.find(tk.mix64(g.view(np.uint64)))], bounds[:-1])
                    words = tk.Words(text_part, at, lower=True)
                    where, values = table(1)
                    h = words.hashes()
                    c = values[where.find(h)] if len(h) else np.zeros(0)
                    sums = np.concatenate([[0], np.cumsum(np.log10(c + 1))])
                    seen = np.concatenate([[0], np.cumsum(c > 0)])
                    n = np.diff(words.bounds) + 1
                    base = np.diff(sums[words.bounds]) + np.log10(n_texts + 1) - n * denominator
                    have = np.diff(seen[words.bounds]) + (1 if n_texts else 0)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(4).slice(lo, hi - lo), pa.array(~use[lo:hi].astype(bool)), pa.array(n.astype(np.int64)), pa.array(have.astype(np.int64)), pa.array(np.full(hi - lo, n_tokens, np.int64)), pa.array(base), pa.array(logs)],
                        names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                    )

    return rows.mapInArrow(run, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").withColumnRenamed("id", id_col)
