"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length one, where the largest cosine is the least distance. Each of some tables hashes a vector by
Gaussian projections cut into slots. A query visits its own bucket and those that are likeliest to hold near vectors, in
estimated order: a bucket is reached by stepping over some of the slot boundaries, and the squared distances to these add
up. The order of the sets of boundaries is computed once, from the expected distance of the j-th nearest boundary. How
many functions, how wide slots and how many visits is fitted to a bounded sample.

Buckets hold a byte for each component, with a bound of the error that this makes, so a visit finds a few vectors among
which the nearest visited ones are for certain. What the tables find is merged; only then are the vectors themselves
fetched, and cosines taken in double precision. Probing finds near vectors, not far ones: a query that it leaves with
fewer than k, or whose k-th is farther than it finds safely, is compared with all vectors, block by block.

Equal vectors are kept once, with their least ids, as many as can be wanted; so copies make no hot bucket.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .staging import drop_staged, stage

SEED = 4242
#: Settings that a fit chooses from: (functions, width of a slot, tables, visits beside the own bucket).
SETTINGS = ((6, 2.5, 4, 30), (8, 2.5, 4, 60), (8, 2.0, 4, 60), (10, 2.0, 4, 60), (12, 2.0, 4, 60), (12, 1.5, 4, 60))
#: Vectors that settings are fitted to, those of them that ask, and the share of the nearest that a setting must find.
SAMPLE, ASKING, RECALL = 4_096, 128, 0.97
#: A cosine is safe if this share of the sample's pairs of about that cosine meet, and so do all nearer ones.
MEET = 0.95
#: Queries whose best are held by a task before they are passed on, and vectors compared at once.
HELD, BLOCK = 20_000, 2_048
#: Candidates of a query that one task may find undecided; a query with more is compared with all vectors.
UNDECIDED = 256
#: Pairs that are sent to all vectors to fetch them; more are joined by shuffle.
BROADCAST_PAIRS = 1_000_000
#: Vectors of one bucket part, about.
PART_ROWS = 20_000
#: Queries and vectors of one block of the exact comparison, about.
EXACT_QUERIES, EXACT_ROWS = 8_192, 2_048


def probe_sets(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of boundaries, by rank of their distance, in order of expected squared distance."""
    k = functions
    score = [j * (j + 1) / (4 * (k + 1) * (k + 2)) if j <= k else 1 - (2 * k + 1 - j) / (k + 1) + (2 * k + 1 - j) * (2 * k + 2 - j) / (4 * (k + 1) * (k + 2)) for j in range(1, 2 * k + 1)]
    out: list[tuple[int, ...]] = []
    heap = [(score[0], (0,))]
    while heap and len(out) < probes:
        s, a = heapq.heappop(heap)
        last = a[-1]
        if last + 1 < 2 * k:
            heapq.heappush(heap, (s - score[last] + score[last + 1], (*a[:-1], last + 1)))
            heapq.heappush(heap, (s + score[last + 1], (*a, last + 1)))
        if all(2 * k - 1 - x not in a for x in a):  # never both boundaries of one slot
            out.append(a)
    return out


class Hasher:
    def __init__(self, dim: int, functions: int, width: float, tables: int, probes: int, seed: int):
        rng = np.random.Generator(np.random.PCG64([seed, dim]))
        self.k, self.w, self.tables = functions, width, tables
        self.a = rng.standard_normal((tables, dim, functions))
        self.b = rng.random((tables, functions)) * width
        self.mult = rng.integers(1, 2**62, (tables, functions), dtype=np.int64) | 1
        self.base = rng.integers(1, 2**62, tables, dtype=np.int64)
        self.sets = probe_sets(functions, probes)

    def _slots(self, unit: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        place = (unit @ self.a[t] + self.b[t]) / self.w
        slot = np.floor(place)
        return slot.astype(np.int64), place - slot

    def _key(self, number: np.ndarray) -> np.ndarray:
        return tk.mix64(number.view(np.uint64)).view(np.int64)

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, tables)"""
        return np.stack([self._key((self._slots(unit, t)[0] * self.mult[t]).sum(axis=1) + self.base[t]) for t in range(self.tables)], axis=1)

    def visits(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, tables, probes + 1), in order."""
        out = []
        for t in range(self.tables):
            slot, part = self._slots(unit, t)
            own = (slot * self.mult[t]).sum(axis=1) + self.base[t]
            order = np.argsort(np.concatenate([part, 1 - part], axis=1), axis=1, kind="stable")
            step = np.where(order < self.k, -1, 1) * self.mult[t][order % self.k]
            out.append(np.stack([self._key(own + step[:, list(s)].sum(axis=1)) for s in ((), *self.sets)], axis=1))
        return np.stack(out, axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def _by_length(b: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose vectors are of one length."""
    sizes = np.asarray(pc.list_value_length(b.column(at)))
    for d in np.unique(sizes):
        yield b if (sizes == d).all() else b.filter(pa.array(sizes == d))


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, each sum in the same order whatever the batch."""
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _coded(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A signed byte for each component, the step it counts, and the length of what that leaves out, rounded up."""
    step = (np.abs(u).max(axis=1) / 127).astype(np.float32)
    code = np.rint(u / step[:, None].astype(np.float64)).astype(np.int8)
    left = u - code * step[:, None].astype(np.float64)
    return code, step, (np.sqrt((left * left).sum(axis=1)) * 1.001 + 1e-6).astype(np.float32)


def _binary(code: np.ndarray) -> pa.Array:
    n, d = code.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * d).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(code))])


@dataclass(frozen=True)
class Setting:
    functions: int
    width: float
    tables: int
    probes: int
    safe: float


def fit(sample: np.ndarray, k: int, seed: int = SEED, settings: tuple[tuple[int, float, int, int], ...] = SETTINGS) -> Setting:
    """The setting that makes a query visit the fewest vectors while it finds ``RECALL`` of the ``k`` nearest in the
    sample, or finds the most; and the least cosine that it finds safely (2, so none, if nothing tells). A sample is
    sparser than the whole, so the nearest there are farther than those that will be asked for."""
    n = len(sample)
    if n < 2:
        return Setting(*settings[0], 2.0)
    u = _unit(sample.astype(np.float64))
    q = u[:ASKING]
    close = q @ u.T
    close[np.arange(len(q)), np.arange(len(q))] = -2
    top = np.argsort(-close, axis=1)[:, : min(k, n - 1)]
    best = None
    for functions, width, tables, probes in settings:
        hasher = Hasher(u.shape[1], functions, width, tables, probes, seed)
        buckets, visits = hasher.buckets(u), hasher.visits(q)
        met = np.zeros((len(q), n), dtype=bool)
        for i in range(len(q)):
            for t in range(tables):
                met[i] |= np.isin(buckets[:, t], visits[i, t])
        recall, visited = np.take_along_axis(met, top, 1).mean(), met.mean()
        rank = (recall < RECALL, visited if recall >= RECALL else -recall)
        if best is None or rank < best[0]:
            best = (rank, (functions, width, tables, probes), met)
    safe = 2.0
    for low in np.arange(0.95, -1.0, -0.05):
        here = (close >= low) & (close < low + 0.1)
        if here.sum() >= 20:
            if best[2][here].mean() < MEET:
                break
            safe = float(low)
    return Setting(*best[1], safe)


def nearest(vectors: DataFrame, is_query, *, id_col: str = "vec_id", vector: str = "embedding", k: int = 5, seed: int = SEED, setting: Setting | None = None) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest found of each query among all other rows.

    ``is_query`` is a condition on the columns. Rank from 1; larger cosine first, ties to the smaller id. A query has
    k rows, or all candidates if there are fewer; where the visited buckets hold fewer than k, or the k-th found has
    a cosine below what the setting finds safely, all its rows are exact. Vectors that are null, empty, all zero or hold
    a null, NaN or infinite component take no part; vectors of other lengths than the query's are no candidates. Ids are
    cast to long; rows with a null id take no part, rows that repeat an id are one candidate and one query (of the last in
    order of vector). Empty table: no rows. Without a ``setting`` one is fitted to ``SAMPLE`` vectors of the length that
    is most frequent among as many.
    """
    single = dict(vectors.dtypes)[vector] == "array<float>"
    kind_v = "array<float>" if single else "array<double>"
    v = F.col(vector) if single else F.col(vector).cast("array<double>")
    fit_ = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(fit_).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: x + F.lit(0.0).cast("float" if single else "double")).alias("v"), is_query.alias("q"))
    rows = rows.withColumn("h", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v"))
    # The least ids of equal vectors: a query's own one and k others. The limit is applied before the shuffle too. Vectors
    # are known by 128 bits here, which saves a second shuffle by their normalised components.
    few = rows.withColumn("n", F.row_number().over(Window.partitionBy("h", "h2").orderBy("id"))).where(F.col("n") <= k + 1)
    distinct = stage(few.groupBy("h", "h2").agg(F.first("v").alias("v"), F.sort_array(F.collect_set("id")).alias("ids")).drop("h2"), "vectors")
    asked = stage(rows.where("q").select("h", "id").distinct(), "queries")
    distinct = distinct.withColumn("least", F.element_at("ids", 1))
    queries = distinct.join(asked.select("h").distinct(), "h", "left_semi").select("h", "v", "least")
    if setting is None:
        sample = [r["v"] for r in distinct.orderBy(F.xxhash64(F.lit(seed), "h"), "h").limit(SAMPLE).select("v").collect()]
        sizes = Counter(map(len, sample))
        dim = max(sizes, key=lambda d: (sizes[d], d)) if sizes else 0
        setting = fit(np.array([x for x in sample if len(x) == dim]), k, seed)
    most, safe = k + 1, setting.safe
    hashed = (setting.functions, setting.width, setting.tables, setting.probes, seed)

    def hasher(dim: int, made: dict = {}) -> Hasher:  # noqa: B006  one for each worker and length
        if dim not in made:
            made[dim] = Hasher(dim, *hashed)
        return made[dim]

    def coded(asking: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in _by_length(whole, 1):
                    for at in range(0, b.num_rows, BLOCK):
                        part = b.slice(at, BLOCK)
                        u = _unit(_matrix(part.column(1)))
                        code, step, left = _coded(u)
                        columns = [pa.array(np.full(len(u), 0 if asking else 1, np.int8)), part.column(0), _binary(code), pa.array(step), pa.array(left)]
                        keys = hasher(u.shape[1]).visits(u).reshape(len(u), -1) if asking else hasher(u.shape[1]).buckets(u)
                        for c in range(keys.shape[1]):
                            yield pa.RecordBatch.from_arrays([pa.array(keys[:, c]), *columns], names=["key", "kind", "h", "code", "step", "left"])

        return run

    schema = "key long, kind byte, h long, code binary, step float, left float"
    indexed, visits = distinct.select("h", "v").mapInArrow(coded(False), schema), queries.select("h", "v").mapInArrow(coded(True), schema)
    # A bucket of many vectors is dealt out in parts, and its visits go to each.
    sizes = stage(indexed.groupBy("key").agg(F.count("*").alias("n")).select("key", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts")), "bucket-sizes")
    left = indexed.join(sizes, "key").withColumn("part", F.pmod("h", F.col("parts")).cast("int"))
    right = visits.join(sizes, "key").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = ["key", "part", "kind", "h", "code", "step", "left"]
    met = left.select(columns).union(right.select(columns)).repartition("key", "part").sortWithinPartitions("key", "part", "kind", "h")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Candidates of each query with bounds of their cosines; without bounds, a query that has too many."""
        found: dict[int, dict[int, tuple[float, float]]] = {}
        full: set[int] = set()
        now, ask = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [(q, c, lo, hi) for q, mine in found.items() for c, (lo, hi) in trimmed(mine).items()] + [(q, 0, None, None) for q in full]
            found.clear()
            full.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=["q", "c", "lo", "hi"])

        def trimmed(mine: dict[int, tuple[float, float]]) -> dict[int, tuple[float, float]]:
            bar = sorted((lo for lo, _ in mine.values()), reverse=True)[:most][-1] if len(mine) >= most else -9.0
            return {c: x for c, x in mine.items() if x[1] >= bar}

        def compare(h: np.ndarray, x: np.ndarray, left: np.ndarray) -> None:
            for qh, qx, ql in ask:
                if qx.shape[1] != x.shape[1]:
                    continue
                close = qx.astype(np.float64) @ x.T
                slack = ql[:, None] + left[None, :] + 1e-5
                lo = close - slack
                n = min(most, len(h))
                bar = np.partition(lo, len(h) - n, axis=1)[:, len(h) - n]
                i, j = np.nonzero((close + slack >= bar[:, None]) if n == most else np.ones(close.shape, bool))
                for a, b, x_, y_ in zip(i.tolist(), h[j].tolist(), lo[i, j].tolist(), (close + slack)[i, j].tolist()):
                    q = int(qh[a])
                    if q not in full:
                        found.setdefault(q, {})[b] = (x_, y_)
                for q in map(int, qh):
                    if len(found.get(q, ())) > 64:
                        found[q] = trimmed(found[q])
                        if len(found[q]) > UNDECIDED:
                            del found[q]
                            full.add(q)

        def plain(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            sizes = np.asarray(pc.binary_length(b.column(4)))
            for d in np.unique(sizes):
                sub = b if (sizes == d).all() else b.filter(pa.array(sizes == d))
                code = np.frombuffer(b"".join(sub.column(4).to_pylist()), np.int8).reshape(-1, d)
                yield sub.column(3).to_numpy(), code * sub.column(5).to_numpy()[:, None].astype(np.float64), sub.column(6).to_numpy().astype(np.float64)

        for b in batches:
            key, part, kind = (b.column(c).to_numpy() for c in range(3))
            cut = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
                if hi == lo:
                    continue
                if now != (key[lo], part[lo]):
                    now, ask = (key[lo], part[lo]), []
                if kind[lo] == 1 and not ask:
                    continue  # nobody visits
                for at in range(lo, hi, 512):
                    for one in plain(b.slice(at, min(512, hi - at))):
                        if kind[lo] == 0:
                            ask.append(one)
                        else:
                            compare(*one)
            if len(found) + len(full) > HELD:
                yield from flush()
        yield from flush()

    candidates = stage(met.mapInArrow(meet, "q long, c long, lo double, hi double").groupBy("q", "c").agg(F.max("lo").alias("lo"), F.max("hi").alias("hi")), "candidates")
    over = candidates.where("lo is null").select("q").distinct()
    sound = candidates.where("lo is not null").join(over, "q", "left_anti")
    bar = sound.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("lo"), "c"))).where(F.col("n") == most).select("q", F.col("lo").alias("bar"))
    pairs = stage(sound.join(bar, "q", "left").where(F.col("bar").isNull() | (F.col("hi") >= F.col("bar"))).select("q", "c"), "pairs")
    few_pairs = F.broadcast if pairs.count() <= BROADCAST_PAIRS else (lambda df: df)
    own = distinct.select(F.col("h").alias("q"), F.col("v").alias("qv"))
    other = distinct.select(F.col("h").alias("c"), F.col("v").alias("cv"))

    def exactly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _by_length(whole, 2):
                for at in range(0, b.num_rows, BLOCK):
                    part = b.slice(at, BLOCK)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(_cosines(_matrix(part.column(2)), _matrix(part.column(3))))], names=["q", "c", "score"])

    found = stage(other.join(few_pairs(pairs), "c").join(own.join(asked.select(F.col("h").alias("q")).distinct(), "q", "left_semi"), "q").select("q", "c", "qv", "cv").mapInArrow(exactly, "q long, c long, score double"), "found")
    drop_staged(candidates, sizes, pairs)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best few of each query in a block, by the vectors themselves."""
        best: dict[int, dict[int, tuple[float, int]]] = {}
        now, ask_h, ask_v = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [(q, c, -s) for q, found in best.items() for c, (s, _) in found.items()]
            best.clear()
            if rows:
                a, b, c = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], names=["q", "c", "score"])

        def compare(h: np.ndarray, m: np.ndarray, least: np.ndarray) -> None:
            mu = _unit(m)
            alike = [x for x in range(len(ask_h)) if len(ask_v[x]) == m.shape[1]]
            for at in range(0, len(alike), 512):
                qh, q = [ask_h[x] for x in alike[at : at + 512]], np.stack([ask_v[x] for x in alike[at : at + 512]])
                close = _unit(q) @ mu.T
                n = min(most, len(h))
                bar = np.partition(close, len(h) - n, axis=1)[:, len(h) - n] - 1e-9  # rounding may swap what is this near
                i, j = np.nonzero(close >= bar[:, None])
                scores = _cosines(q[i], m[j])
                order = np.lexsort((least[j], -scores, i))
                i, j, scores = i[order], j[order], scores[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                for x, y, score in zip(i[place < n].tolist(), j[place < n].tolist(), scores[place < n].tolist()):
                    best.setdefault(qh[x], {})[int(h[y])] = (-score, int(least[y]))
                for x in qh:
                    if len(best[x]) > 64:
                        best[x] = dict(sorted(best[x].items(), key=lambda e: e[1])[:most])

        for b in batches:
            key, part, kind = (b.column(c).to_numpy() for c in range(3))
            cut = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
                if hi == lo:
                    continue
                if now != (key[lo], part[lo]):
                    now, ask_h, ask_v = (key[lo], part[lo]), [], []
                if kind[lo] == 1 and not ask_h:
                    continue  # nobody visits
                for sub in _by_length(b.slice(lo, hi - lo), 4):
                    h, m, least = sub.column(3).to_numpy(), _matrix(sub.column(4)), sub.column(5).to_numpy()
                    if kind[lo] == 0:
                        ask_h.extend(h.tolist())
                        ask_v.extend(m)
                    else:
                        for at in range(0, len(h), BLOCK):
                            compare(h[at : at + BLOCK], m[at : at + BLOCK], least[at : at + BLOCK])
            if len(best) > HELD:
                yield from flush()
        yield from flush()

    ids = distinct.select(F.col("h").alias("c"), "ids")

    def rank(found: DataFrame) -> DataFrame:
        """The best few vectors of each query vector, then their ids for each query that has it."""
        ranked = found.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "c")))
        edge = found.join(ranked.where(F.col("n") == most).select("q", F.col("score").alias("least")), "q", "left").where(F.col("least").isNull() | (F.col("score") >= F.col("least")))
        per_query = edge.join(asked.select(F.col("h").alias("q"), F.col("id").alias("query_id")), "q").join(ids, "c").select("query_id", "score", F.explode("ids").alias("id")).where("id <> query_id")
        per_query = per_query.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        return per_query.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)

    first = stage(rank(found), "ranked")
    sure = first.where((F.col("rank") == k) & (F.col("score") >= safe)).select(F.col("query_id").alias("id"))
    weak = stage(asked.join(sure, "id", "left_anti").select("h").distinct(), "weak")
    n_weak = weak.count()
    if n_weak:
        # Each block of vectors meets each block of queries in one place, by the same search as a bucket.
        groups, parts = -(-n_weak // EXACT_QUERIES), -(-distinct.count() // EXACT_ROWS)
        group, part = F.pmod(F.xxhash64(F.lit(1), "h"), F.lit(groups)), F.pmod(F.xxhash64(F.lit(2), "h"), F.lit(parts)).cast("int")
        every = lambda n, kind: F.explode(F.sequence(F.lit(0).cast(kind), F.lit(n - 1).cast(kind)))
        left = distinct.select(every(groups, "long").alias("key"), part.alias("part"), F.lit(1).alias("kind"), "h", "v", "least")
        right = queries.join(weak, "h", "left_semi").select(group.cast("long").alias("key"), every(parts, "int").alias("part"), F.lit(0).alias("kind"), "h", "v", "least")
        met = left.union(right).repartition("key", "part").sortWithinPartitions("key", "part", "kind", "h")
        exact = stage(met.mapInArrow(search, "q long, c long, score double"), "exact")
        found = found.join(weak.select(F.col("h").alias("q")), "q", "left_anti").unionByName(exact)
        first = rank(found)
    return first.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
