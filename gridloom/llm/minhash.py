"""Near duplicates by MinHash: banded signatures, checks on signatures and on full sets, connected components.

1. Texts with equal shingle sets form one class; only its least id goes on (copies are never paired).
2. Each class has ``BANDS * ROWS`` minima of universal hashes. Classes that share a band meet in a bucket.
3. Every member of a bucket is compared with the member that has most company in its buckets, the middle of a group:
   signatures first, then full sets. That is linear in the bucket, and joins a group of near copies at once. Members that
   are not in that one's component then do the same among themselves, until that links nothing more.
4. Members of buckets that still hold several components may have links that step 3 did not try. For these, exact
   prefix filtering finds every pair of different components that can reach the similarity: with all sets in one
   order, rare shingles first, such a pair's first common shingle stands so early in both that enough can follow; and
   parities of the sets' parts, carried along, bound from below how many shingles a pair does not share. So a group of
   near misses does not yield its pairs, nor does a group of near copies, most of which are of one component by then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .components import components
from .staging import drop_staged, release, stage

#: A pair of similarity 0.8 shares no band with probability (1 - 0.8**5)**32, 3 in a million.
BANDS, ROWS = 32, 5
#: Signatures agree in fewer than this share of their minima: rejected without a look at the sets. At similarity
#: 0.8 the share is 0.8 on average with a standard deviation of 0.032, so 0.62 is more than 5 deviations off.
SIGNATURE_FLOOR = 0.62
#: Counters of the sketch that orders shingles, as powers of 2: twice as many as shingles are counted, within these (1 MB
#: to 16 MB on each worker). Beyond, a counter holds as many other shingles as shingles exceed counters; what is more
#: frequent than that still comes last, and what is not pairs up with no more than that many.
SKETCH_BITS = (18, 22)

#: Times that members of buckets look for links with a member in the middle. What is linked after that is found by
#: prefixes too, only with more pairs to look at.
ROUNDS = 6

#: Parities of a set, whose differences bound how many shingles two sets do not share.
PARITIES = 512

_rng = np.random.Generator(np.random.PCG64(99991))
_A = _rng.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct 64-bit shingle hashes)``. Fewer than k words: all of them as one; no words: empty."""
    for lo, hi, words in tk.slice_words(column, lower=True):
        h = words.hashes()
        w = tk.windows(h, k)
        for i in range(hi - lo):
            a, b = words.bounds[i], words.bounds[i + 1]
            if b - a >= k:
                yield lo + i, np.unique(w[a : b - k + 1])
            elif b > a:
                yield lo + i, tk.windows(h[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield lo + i, np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``BANDS * ROWS`` minima, 32 bits each."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 2048):
        part = x[at : at + 2048]
        h = _A[:, None] * part[None, :]
        h += _B[:, None]
        np.minimum(out, h.min(axis=1), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    m = tk.mix64(sig.astype(np.uint64) + (np.arange(BANDS * ROWS, dtype=np.uint64) << np.uint64(32))).reshape(BANDS, ROWS)
    return tk.mix64(m.sum(axis=1, dtype=np.uint64)).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether each of ``PARITIES`` parts of all shingles holds an odd number of these, packed into 64-bit numbers."""
    part = tk.mix64(shingles) >> np.uint64(64 - PARITIES.bit_length() + 1)
    odd = np.bincount(part.astype(np.int64), minlength=PARITIES).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk.kept_by("minhash")
        for b in batches:
            n, fp, bands, sigs = [], [], [], []
            for _, s in shingle_sets(b.column(1), k):
                n.append(len(s))
                fp.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                if len(s):
                    sig = signature(s)
                    bands.append(band_keys(sig))
                    sigs.append((sig & np.uint32(0xFF)).astype(np.uint8).tobytes())
                else:
                    bands.append(None)
                    sigs.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], names=["id", "n", "fp", "bands", "sig"])
            tk.give_back()

    return run


def _sets(k: int):
    """Full sets, each known by the fingerprint of its class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets: list[bytes] = []
            size = 0
            for _, s in shingle_sets(b.column(0), k):
                sets.append(s.tobytes())
                size += len(sets[-1])
                if size > 8 << 20:
                    yield _set_rows(sets)
                    sets, size = [], 0
            if sets:
                yield _set_rows(sets)
            tk.give_back()

    return run


def _set_rows(sets: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in sets], pa.binary()), pa.array(sets, pa.binary())], names=["fp", "set"])


def _alike(limit: int):
    """Keeps the pairs whose full sets have 100 * intersection >= limit * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= limit * (len(p) + len(q) - both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            tk.give_back()

    return run


def _signs_alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(b.num_rows, -1) for i in (2, 3))
        # 1 of 256 unequal minima agree in the byte that is kept
        yield b.select([0, 1]).filter(pa.array((x == y).mean(axis=1) >= SIGNATURE_FLOOR))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for each row of ``docs``.

    Two texts are linked when ``100 * |A & B| >= percent * |A | B|`` over their sets of distinct k-word shingles
    (A-Z lower-cased). A text of fewer words has its whole sequence as one shingle; a null text or one without
    words has an empty set and no link. ``component_id`` is the least id that links reach. Rows that repeat an id
    are one node, linked by any of their texts, and each gets its own row. A row with a null id is linked with nothing:
    its component is null and it is kept. Ids are cast to long. Empty table: no rows. ``percent`` must be at least 62,
    for which signatures are built.
    """
    if percent < 62:
        raise ValueError("signatures are built for percent >= 62")
    src = docs.select(F.col(id_col).cast("long").alias("id"), text)
    all_rows = stage(src.mapInArrow(_signatures(k), "id long, n long, fp binary, bands array<long>, sig binary"), "minhash")
    slim = all_rows.select("id", "n", "fp")
    classes = stage(slim.where("n > 0 and id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    # A class is known by the hash of its set; the row with its least id brings the signature.
    reps = stage(all_rows.join(classes.select("fp", F.col("rep").alias("id")), ["fp", "id"], "left_semi").dropDuplicates(["fp"]).withColumn("node", F.xxhash64("fp")), "reps")
    banded = reps.select("node", "id", "n", F.posexplode("bands").alias("band", "b")).select("node", "id", "n", F.xxhash64("band", "b").alias("key"))

    def close(x: str, y: str):
        return F.greatest(x, y) * percent <= F.least(x, y) * 100

    # Written first: a join with a table, not with an aggregate of the same key, lets Spark split a large bucket.
    keys = stage(banded.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "keys")
    met = stage(banded.join(keys, "key"), "buckets")
    drop_staged(keys)
    company = stage(met.groupBy("node").agg(F.sum("m").alias("company")), "company")
    left = stage(met.join(company, "node").select("key", "node", "id", "n", "company", F.col("node").alias("c")), "left")
    drop_staged(company)
    tested, links, comps, sets = [], None, None, None
    for _ in range(ROUNDS):
        middle = F.min(F.struct((-F.col("company")).alias("_"), "id", "node", "n", "c")).alias("p")
        pivots = stage(left.groupBy("key").agg(middle, F.count("*").alias("m")).where("m > 1").select("key", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.c").alias("pc")), "pivots")
        pairs = left.join(pivots, "key").where("c <> pc").where(close("n", "pn"))
        tested.append(stage(pairs.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), "pairs"))
        likely = _likely(tested[-1], reps)
        if sets is None:  # of all that this and later steps can ask for: texts are read once
            sets = _full_sets(likely.select(F.col("a").alias("node")).union(likely.select("b")).union(met.where("m > 2").select("node")), reps, src, k)
            release(docs.sparkSession)
        more = _confirmed(likely, sets, percent)
        drop_staged(likely)
        found = more.count()
        if found or links is None:
            drop_staged(comps)
            links = more if links is None else links.union(more)
            comps = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        before, ours = left, comps.select(F.col("u").alias("pivot"), F.col("v").alias("pc"))
        others = pivots.select("key", "pivot").join(ours, "pivot", "left").withColumn("pc", F.coalesce("pc", "pivot")).select("key", "pc")
        left = stage(_placed(left.drop("c"), comps).join(others, "key").where("c <> pc").drop("pc"), "left")
        drop_staged(before, pivots)
        if not found:
            break
    drop_staged(left)
    # Buckets whose members are not all joined yet
    member = _placed(met.select("key", "node", "n"), comps)
    mixed = stage(member.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m")).where("lo < hi and m > 2").select("key"), "mixed")
    open_ = member.join(mixed, "key", "left_semi").select("node", "n", "c").distinct()
    many = comps.groupBy("v").agg(F.count("*").alias("many")).withColumnRenamed("v", "c")
    open_ = stage(open_.join(many, "c", "left").withColumn("many", F.coalesce("many", F.lit(0))), "open")
    drop_staged(met)
    release(docs.sparkSession)
    cross = _prefix_pairs(sets.join(open_, "node").select("node", "n", "c", "many", "set"), percent)
    done = reduce(DataFrame.union, tested).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _confirmed(_likely(cross.join(done, ["a", "b"], "left_anti"), reps), sets, percent)
    drop_staged(sets, open_, comps, mixed, *tested)
    # The links as ids; classes that hold rows of one id are one node.
    name = reps.select("node", "id")
    ends = links.union(more).join(name.select(F.col("node").alias("a"), F.col("id").alias("u")), "a").join(name.select(F.col("node").alias("b"), F.col("id").alias("v")), "b").select("u", "v")
    owned = slim.where("n > 0 and id is not null").join(classes, "fp").select("id", "rep")
    several = owned.groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("id", "lo")
    roots = components(ends.union(owned.join(several, "id").select(F.col("rep").alias("u"), F.col("lo").alias("v"))))
    out = slim.join(classes, "fp", "left").withColumn("rep", F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("rep")).otherwise(F.col("id")))
    out = out.join(roots.select(F.col("u").alias("rep"), F.col("v").alias("root")), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("root").alias("component_id"), F.coalesce(F.col("id") == F.col("root"), F.lit(True)).alias("kept"))


def _placed(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` with the component ``c`` of each ``node``: a node without links is its own."""
    return rows.join(comps.select(F.col("u").alias("node"), F.col("v").alias("c")), "node", "left").withColumn("c", F.coalesce("c", "node"))


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose signatures agree well enough, as a staged table."""
    sig = reps.select("node", "sig")
    with_sigs = pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb")
    return stage(with_sigs.mapInArrow(_signs_alike, "a long, b long"), "likely")


def _full_sets(nodes: DataFrame, reps: DataFrame, src: DataFrame, k: int) -> DataFrame:
    """``(node, set)`` of some classes, from the texts, as a staged table."""
    need = nodes.distinct().join(reps.select("node", "id", "fp"), "node")
    sets = src.join(need.select("id").distinct(), "id", "left_semi").select(src.columns[1]).mapInArrow(_sets(k), "fp binary, set binary")
    return stage(need.select("node", "fp").join(sets, "fp").dropDuplicates(["node"]).select("node", "set"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that pass on their full sets, as a staged table."""
    full = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("xa")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("xb")), "b").select("a", "b", "xa", "xb")
    return stage(full.mapInArrow(_alike(percent), "a long, b long"), "links")


def _prefix_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components ``c`` that can have the similarity, from ``(node, n, c, many, set)``.

    The order is by a sketch of how many of these sets have a shingle, which has about twice as many counters as there
    are shingles (``SKETCH_BITS``). Any order is exact; the sketch only makes shingles of single texts come first.
    """
    shingles = rows.agg(F.sum("n")).first()[0] or 0
    bits = min(max(SKETCH_BITS[0], (2 * shingles).bit_length()), SKETCH_BITS[1])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for b in batches:
            for x in b.column(0):
                np.add.at(total, (np.frombuffer(x.as_buffer(), np.uint64) >> np.uint64(64 - bits)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        for lo in range(0, len(at), 1 << 16):
            part = at[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["slot", "n"])

    sums = rows.select("set").mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    sketch = np.zeros(1 << bits, dtype=np.int32)
    sketch[sums.column("slot").to_numpy()] = np.minimum(sums.column("n").to_numpy(), 2**31 - 1)
    shared = rows.sparkSession.sparkContext.broadcast(sketch)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                keep, sizes, odd = [], [], []
                for x in b.column(4):
                    h = np.frombuffer(x.as_buffer(), np.uint64)
                    odd.append(parities(h))
                    h = h[np.lexsort((h, count[(h >> np.uint64(64 - bits)).astype(np.int64)]))]
                    keep.append(h[: len(h) - -(-percent * len(h) // 100) + 1])
                    sizes.append(len(keep[-1]))
                row = np.repeat(np.arange(b.num_rows), sizes)
                place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
                cols = [b.column(i).take(pa.array(row)) for i in range(4)]
                odd = [pa.array(x[row]) for x in np.array(odd).T]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keep).view(np.int64)), *cols, pa.array(place), *odd], names=["h", "node", "n", "c", "many", "i", *odds])

    odds = [f"o{k}" for k in range(PARITIES // 64)]
    post = stage(rows.mapInArrow(prefixes, ", ".join(["h long, node long, n long, c long, many long, i long", *(f"{o} long" for o in odds)])), "prefixes")
    # Of the components that have a shingle, the largest is not compared with itself.
    met = post.groupBy("h").agg(F.min("n").alias("least"), F.max(F.struct("many", "c")).alias("top"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("h", "least", F.col("top.c").alias("top"))

    def need(x, y):
        """Common shingles that sets of x and y shingles must have."""
        return F.ceil(percent * (x + y) / (100 + percent))

    n, i = F.col("n"), F.col("i")
    left = post.join(met, "h").where("c <> top").where(n - i + 1 >= need(n, F.greatest(F.ceil(percent * n / 100), F.col("least"))))
    left = left.select("h", F.col("node").alias("a"), F.col("n").alias("an"), F.col("c").alias("ac"), F.col("i").alias("ai"), *(F.col(o).alias(f"a{o}") for o in odds))
    right = post.select("h", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("c").alias("bc"), F.col("i").alias("bi"), *(F.col(o).alias(f"b{o}") for o in odds))
    an, bn = F.col("an"), F.col("bn")
    # Each shingle that only one of two sets has turns one parity, so as many parities as differ, or more, are not shared.
    apart = reduce(Column.__add__, (F.bit_count(F.col(f"a{o}").bitwiseXOR(F.col(f"b{o}"))) for o in odds))
    possible = (F.least(an - F.col("ai"), bn - F.col("bi")) + 1 >= need(an, bn)) & (apart <= an + bn - 2 * need(an, bn))
    found = left.join(right, (left["h"] == right["h"]) & (F.col("ac") != F.col("bc")) & possible)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
