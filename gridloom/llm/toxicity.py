"""Toxicity by a string-subsequence kernel machine with Nystroem landmarks.

The kernel of two strings sums, over all subsequences of three letters with gaps (spanning at most ``SPAN``
letters), the product of their weights ``DECAY ** span``; so a word with letters inserted or left out keeps much of
its likeness. Words are folded first: case, accents, look-alike digits and signs; other signs inside a word are
dropped, and runs of single letters are read as one word too. A letter is a code point of any script. Words of fewer
than three letters have no kernel value.

Landmarks are words and stems that go with the label in a bounded sample of labelled texts. A text's kernel value
with a landmark is the largest among its words, sharpened by a power; with the kernel matrix of the landmarks this
gives the Nystroem features, on which a linear support vector machine is trained and calibrated.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .minhash import band_keys, shingle_sets, signature
from .staging import drop_staged, stage

SPAN, DECAY = 6, 0.5
#: Kernel values are raised to POWER; below FLOOR (before that) they count as none.
POWER, FLOOR = 4, 0.3
LANDMARKS = 64
#: Labelled texts of each label that the machine is trained on, at most.
SAMPLE = 4096
#: Toxic texts of the sample that a stem must be found in to be weighed as a landmark, whatever the sample's size.
SUPPORT = 2
#: Stems that are weighed as landmarks, at most.
CANDIDATES = 2_000
#: Share of landmarks that may be there by chance: of the stems in as many texts, as many toxic ones among these are to be
#: expected less often than that, if labels had nothing to do with them.
CHANCE = 0.3
#: Kernel value from which a stem is covered by an earlier one. Insults that go on from a common harmless word differ in
#: their last letters only, and need landmarks of their own.
COVERED = 0.85
#: Share of minima (of three-word shingles) in which labelled texts agree that count as one.
ALIKE = 0.6
_STEMS = range(4, 13)
_KNOWN_BITS = 19
#: Stems that a task counts before it passes them on.
HELD_STEMS = 100_000

#: Runs of scripts that put no blanks between words: a stem may begin at any letter there.
_UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U000323af]+")
_STEMS_UNSPACED = range(3, 9)

_LETTER = np.zeros(256, dtype=np.uint32)  # ASCII; what is longer than a byte is folded by code point
for _i in range(26):
    _LETTER[ord("a") + _i] = _LETTER[ord("A") + _i] = ord("a") + _i
for _c, _like in zip("0134578@$", "oieastbas"):
    _LETTER[ord(_c)] = ord(_like)
_ACCENTED = np.array([0 if c == " " else ord(c) for c in "aaaaaaaceeeeiiiidnooooo ouuuuypsaaaaaaaceeeeiiiidnooooo ouuuuypy"], dtype=np.uint32)  # from U+00C0
_PAIRS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


_FOLDED = np.zeros(0x110000, dtype=np.uint32)  # letter + 1; 0 where no text has had the code point yet


def _letter(code: int) -> int:
    """Of a code point beyond ASCII: without case and accents; 0 for what is no letter."""
    c = chr(code)
    if unicodedata.category(c)[0] not in "LM" or unicodedata.combining(c):
        return 0
    c = c.lower() if len(c.lower()) == 1 else c
    parts = [x for x in unicodedata.normalize("NFKD", c.casefold()) if not unicodedata.combining(x)]
    like = ord(parts[0]) if len(parts) == 1 else ord(c)
    like = int(_LETTER[like]) if like < 0x80 else like
    return int(_ACCENTED[like - 0xC0]) if 0xC0 <= like < 0x100 else like


def _folded(codes: np.ndarray) -> np.ndarray:
    new = np.unique(codes[_FOLDED[codes] == 0])
    if len(new):
        _FOLDED[new] = [_letter(c) + 1 for c in new.tolist()]
    return _FOLDED[codes] - np.uint32(1)


def fold(data: np.ndarray) -> np.ndarray:
    """A letter (its code point) for the first byte of each letter, 0 for the other bytes and those dropped."""
    out = _LETTER[data]
    at = np.flatnonzero(data >= 0xC0)
    if len(at):
        lead = data[at].astype(np.int64)
        more = 1 + (lead >= 0xE0) + (lead >= 0xF0)
        code = lead & (0x3F >> more)
        for i in (1, 2, 3):
            long = np.flatnonzero(more >= i)
            code[long] = code[long] << 6 | data[at[long] + i] & 0x3F
        out[at] = _folded(code)
    return out


class Units:
    """The folded words of a slice's rows, with merged runs of single letters: letters, bounds, row of each."""

    def __init__(self, words: tk.Words):
        letters = fold(words.data)
        seen = np.concatenate([[0], np.cumsum(letters > 0)])
        self.letters = letters[letters > 0]
        a, b = seen[words.start], seen[words.end]
        row = np.searchsorted(words.bounds, np.arange(len(a)), "right") - 1
        single = np.concatenate([[False], b - a == 1, [False]])
        first = np.flatnonzero(single[1:] & ~single[:-1])
        last = np.flatnonzero(single[:-1] & ~single[1:]) - 1
        more = [(a[x], b[y], row[x]) for x, y in zip(first, last) if y - x >= 2 and row[x] == row[y]]
        if more:
            m = np.array(more)
            a, b, row = np.concatenate([a, m[:, 0]]), np.concatenate([b, m[:, 1]]), np.concatenate([row, m[:, 2]])
        full = b - a >= 3
        self.a, self.b, self.row = a[full], b[full], row[full]

    def hashes(self) -> np.ndarray:
        n = len(self.letters)
        power, inverse = tk._powers(tk._BASE, n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((tk.mix64(self.letters.astype(np.uint64)) | np.uint64(1)) * power[:n], out=total[1:])
        return tk.mix64((total[self.b] - total[self.a]) * inverse[self.a] ^ (self.b - self.a).astype(np.uint64))


def _codes(w: np.ndarray, a: int, b: int) -> np.ndarray:
    """Three letters, at distances a and b from the first, as one number."""
    return (w[:-b] << 42) | (w[a : len(w) - b + a] << 21) | w[b:]


def _features(word: np.ndarray) -> dict[int, float]:
    """Explicit kernel features of one folded word."""
    out: dict[int, float] = {}
    w = word.astype(np.int64)
    for a, b in _PAIRS:
        if len(w) > b:
            for code in _codes(w, a, b).tolist():
                out[code] = out.get(code, 0.0) + DECAY ** (b + 1)
    return out


def _product(f: dict[int, float], g: dict[int, float]) -> float:
    return sum(x * g[code] for code, x in f.items() if code in g)


def _spell(s: str) -> np.ndarray:
    letters = fold(np.frombuffer(s.encode(), np.uint8))
    return letters[letters > 0]


def _letters(s: str) -> np.ndarray:
    """Of a landmark or stem, which is folded already."""
    return np.array([ord(c) for c in s], dtype=np.uint32)


class Landmarks:
    """Kernel values of words with fixed folded strings, each scaled to 1 with itself and held to 1."""

    def __init__(self, strings: list[str]):
        self.n = len(strings)
        found = [_features(_letters(s)) for s in strings]
        self.codes = np.array(sorted({c for f in found for c in f}), dtype=np.int64)
        self.table = np.zeros((len(self.codes), self.n), dtype=np.float32)
        for i, f in enumerate(found):
            self.table[np.searchsorted(self.codes, np.array(list(f), dtype=np.int64)), i] = np.array(list(f.values())) / _product(f, f)
        self.used = np.zeros(1 << 18, dtype=bool)
        self.used[self._slot(self.codes)] = True
        self._clear()

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return (code * np.int64(tk._BASE - (1 << 64))) >> 46 & (1 << 18) - 1

    def _clear(self) -> None:
        self.known = tk.Known(_KNOWN_BITS)
        self.hits = np.zeros((1024, self.n), dtype=np.float32)  # words without a hit share row 0
        self.n_hits = 1

    def _keep(self, rows: np.ndarray) -> None:
        need = self.n_hits + len(rows)
        if need > len(self.hits):
            self.hits = np.concatenate([self.hits[: self.n_hits], np.zeros((need + need // 4 - self.n_hits, self.n), dtype=np.float32)])
        self.hits[self.n_hits : need] = rows
        self.n_hits = need

    def values(self, letters: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """(words, landmarks), before sharpening; words are letters[a:b]."""
        size = b - a
        flat = letters[np.repeat(a - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))].astype(np.int64)
        word = np.repeat(np.arange(len(a)), size)
        left = np.repeat(np.cumsum(size), size) - np.arange(len(flat))  # letters from here to the word's end
        out = np.zeros((len(a), self.n), dtype=np.float32)
        for x, y in _PAIRS:
            if len(flat) <= y:
                continue
            code = _codes(flat, x, y)
            at = np.flatnonzero(self.used[self._slot(code)] & (left[:-y] > y))
            number = np.searchsorted(self.codes, code[at])
            same = number < len(self.codes)
            same[same] = self.codes[number[same]] == code[at[same]]
            at, number = at[same], number[same]
            if len(at):
                w = word[at]
                begin = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                out[w[begin]] += np.add.reduceat(self.table[number], begin, axis=0) * np.float32(DECAY ** (y + 1))
        return np.minimum(out, 1)

    def rows(self, units: Units, rows: int) -> np.ndarray:
        """(rows, landmarks): the largest value among each row's words, sharpened."""
        out = np.zeros((rows, self.n), dtype=np.float32)
        if not len(units.a) or not self.n:
            return out
        h = units.hashes()
        number = self.known.find(h)
        new = np.flatnonzero(number < 0)
        if len(new):
            keys, first = np.unique(h[new], return_index=True)
            if self.known.n + len(keys) > 1 << (_KNOWN_BITS - 1):
                self._clear()
                new = np.arange(len(h))
                keys, first = np.unique(h, return_index=True)
            at = new[first]
            hit = np.zeros(len(at), dtype=np.int64)
            for lo in range(0, len(at), 16384):
                part = at[lo : lo + 16384]
                v = self.values(units.letters, units.a[part], units.b[part])
                keep = np.flatnonzero((v >= FLOOR).any(axis=1))
                hit[lo + keep] = self.n_hits + np.arange(len(keep))
                self._keep(np.where(v[keep] >= FLOOR, v[keep], 0) ** POWER)
            if len(keys) <= 1 << (_KNOWN_BITS - 1):
                self.known.add(keys, hit)
                number[new] = self.known.find(h[new])
            else:  # one slice with more distinct words than the table takes
                number[new] = hit[np.searchsorted(keys, h[new])]
        some = np.flatnonzero(number > 0)
        np.maximum.at(out, units.row[some], self.hits[number[some]])
        return out


def text_features(column: pa.Array, marks: Landmarks) -> np.ndarray:
    out = np.zeros((len(column), marks.n), dtype=np.float32)
    for lo, hi, words in tk.slice_words(column, lower=False):
        out[lo:hi] = marks.rows(Units(words), hi - lo)
    return out


@dataclass(frozen=True)
class Model:
    """Landmarks, the machine's weights on sharpened kernel values (the Nystroem map is folded in), its bias, and
    the two numbers of the calibration."""

    landmarks: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    slope: float
    shift: float

    def score(self, features: np.ndarray) -> np.ndarray:
        margin = features.astype(np.float64) @ np.array(self.weights) + self.bias if len(self.weights) else np.full(len(features), self.bias)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _marks(strings: tuple[str, ...]) -> Landmarks:
    kept = tk.kept_by("toxicity")
    if strings not in kept:
        kept.clear()
        kept[strings] = Landmarks(list(strings))
    return kept[strings]


def train_machine(x: np.ndarray, y: np.ndarray, *, c: float = 1.0, rounds: int = 500) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, both labels weighing the same; accelerated descent."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * c * 100
    ridge = np.append(np.ones(x.shape[1]), 1e-4)
    step = 1 / (1 + 2 * np.linalg.norm(x1.T * weight @ x1, 2))
    w = v = np.zeros(x1.shape[1])
    for i in range(rounds):
        slack = np.maximum(0, 1 - sign * (x1 @ v))
        gradient = ridge * v - 2 * x1.T @ (weight * sign * slack)
        after = v - step * gradient
        v = after + i / (i + 3) * (after - w)
        w = after
    return w[:-1], float(w[-1])


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through smoothed labels, by Newton steps."""
    n1, n0 = max(1, int((y > 0).sum())), max(1, int((y <= 0).sum()))
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[(w * margin**2).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]])
        d = np.linalg.solve(h, g)
        a, b = a - np.clip(d[0], -2, 2), b - np.clip(d[1], -2, 2)
        if np.abs(d).max() < 1e-9:
            break
    return float(max(a, 1e-3)), float(b)


def choose_landmarks(stems: list[tuple[str, int, int]], toxic: int, clean: int, most: int = LANDMARKS) -> list[str]:
    """From (stem, toxic texts with it, clean texts with it): the strongest, leaving out what an earlier one covers.
    Of stems found in the same texts the longest stands for them."""

    def strength(t: int, n: int) -> float:
        pt, pc = t / toxic, n / clean
        p = (t + n + 1) / (toxic + clean + 2)
        return (pt - pc) / np.sqrt(p * (1 - p) * (1 / toxic + 1 / clean))

    ranked = sorted(((round(strength(t, n), 6), len(s), s) for s, t, n in stems if t / toxic > 4 * n / clean), key=lambda x: (-x[0], -x[1], x[2]))
    out: list[str] = []
    found: list[tuple[dict[int, float], float]] = []
    for _, _, s in ranked[:CANDIDATES]:
        f = _features(_letters(s))
        norm = _product(f, f)
        if norm and all(_product(f, g) / min(norm, other) < COVERED for g, other in found):
            out.append(s)
            found.append((f, norm))
            if len(out) == most:
                break
    return out


def _tail(n: int, least: int, p: float) -> float:
    """Probability of ``least`` or more among ``n`` that each come with probability p."""
    k = np.arange(least, n + 1)
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in k.tolist()]
    return float(np.exp(np.array(log) + k * math.log(p) + (n - k) * math.log1p(-p)).sum())


def beyond_chance(stems: list[tuple[str, int, int]], number: dict[int, int], as_toxic: dict[tuple[int, int], int], rate: float, chance: float = CHANCE) -> list[tuple[str, int, int]]:
    """Of (stem, toxic texts with it, clean texts with it) those that labels explain. ``number`` of stems by how many texts
    have them; ``as_toxic``, how many of these are in so many toxic texts; ``rate``: the share of toxic texts."""
    more: dict[tuple[int, int], int] = {}
    for (d, t), m in as_toxic.items():
        for less in range(SUPPORT, t + 1):
            more[d, less] = more.get((d, less), 0) + m
    return [(s, t, n) for s, t, n in stems if number[t + n] * _tail(t + n, t, rate) <= chance * more.get((t + n, t), 1)]


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        signs = [signature(s) if len(s) else None for _, s in shingle_sets(b.column(2), 3)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([None if s is None else s.tobytes() for s in signs], pa.binary())], names=["id", "y", "sign"])


def one_of_each(texts: list[tuple[int, int, bytes]]) -> list[tuple[int, int]]:
    """Of (id, label, signature), the first of those that are alike, with the largest label among them. Texts that share a
    band are alike if ``ALIKE`` of their minima agree with those of the first that has it."""
    signs = [np.frombuffer(s, np.uint32) for _, _, s in texts]
    root = list(range(len(texts)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    seen: dict[tuple[int, int], int] = {}
    for i, sign in enumerate(signs):
        for key in enumerate(band_keys(sign).tolist() if len(sign) else ()):
            j = seen.setdefault(key, i)
            a, b = find(i), find(j)
            if a != b and (sign == signs[j]).mean() >= ALIKE:
                root[max(a, b)] = min(a, b)
    label: dict[int, int] = {}
    for i, (_, y, _) in enumerate(texts):
        label[find(i)] = max(label.get(find(i), y), y)
    return [(texts[i][0], texts[i][1]) for i in label if texts[i][1] == label[i]] + [min((t[0], t[1]) for j, t in enumerate(texts) if find(j) == i and t[1] == y) for i, y in label.items() if texts[i][1] != y]


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each label have a word that begins with each stem, or, in a script without blanks, holds it."""
    count: tuple[Counter, Counter] = (Counter(), Counter())
    for b in batches:
        y = b.column(1).to_pylist()
        for lo, hi, words in tk.slice_words(b.column(0), lower=False):
            units = Units(words)
            spelled = units.letters.astype("<u4").tobytes().decode("utf-32-le")
            order = np.argsort(units.row, kind="stable")
            cut = np.searchsorted(units.row[order], np.arange(hi - lo + 1))
            a, b_ = units.a.tolist(), units.b.tolist()
            for i in range(hi - lo):
                mine = {spelled[a[j] : b_[j]] for j in order[cut[i] : cut[i + 1]].tolist()}
                stems = {w[:n] for w in mine for n in _STEMS if len(w) >= n}
                runs = {run for w in mine for run in _UNSPACED.findall(w)}
                stems |= {run[at : at + n] for run in runs for n in _STEMS_UNSPACED for at in range(len(run) - n + 1)}
                count[1 if y[lo + i] else 0].update(stems)
                if sum(map(len, count)) > HELD_STEMS:
                    yield _counted(count)
    if any(count):
        yield _counted(count)


def _counted(count: tuple[Counter, Counter]) -> pa.RecordBatch:
    keys = list(count[0].keys() | count[1].keys())
    out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([count[1][k] for k in keys], pa.int64()), pa.array([count[0][k] for k in keys], pa.int64())], names=["stem", "t", "n"])
    for c in count:
        c.clear()
    return out


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "toxic", use: Column | None = None, sample: int = SAMPLE, landmarks: int = LANDMARKS, support: int = SUPPORT) -> Model:
    """Fit on at most ``sample`` texts of each label, drawn by a hash of the id among the labelled rows that ``use``
    keeps; near copies among them count as one text (by three-word shingles); landmarks are stems of at least ``support`` toxic ones. An id labelled more than once counts as toxic if any label says so; null labels count as none. Without
    texts of both labels the score is the same for all: 0, or 1 if all are toxic."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    known = known.where(use) if use is not None else known
    known = known.groupBy(id_col).agg(F.max(F.col(label).cast("int")).alias("y"))
    drawn = [known.where(c).orderBy(F.xxhash64(F.lit(3), id_col), id_col).limit(sample) for c in (F.col("y") > 0, F.col("y") <= 0)]
    ids = [(r[id_col], r["y"]) for d in drawn for r in d.collect()]
    constant = Model((), (), 30.0 if ids and all(y > 0 for _, y in ids) else -30.0, 1.0, 0.0)
    if len({y > 0 for _, y in ids}) < 2:
        return constant
    # At most twice ``sample`` ids.
    chosen = F.broadcast(docs.sparkSession.createDataFrame(ids, "id long, y int"))
    rows = stage(docs.select(F.col(id_col).alias("id"), text).join(chosen, "id").repartition(12, "id"), "labelled")
    # Copies of a text, exact or near, say no more than one of it.
    alike = rows.select("id", "y", text).mapInArrow(_bands, "id long, y int, sign binary").collect()  # of the sample
    first = one_of_each(sorted((r["id"], r["y"], bytes(r["sign"] or b"")) for r in alike))
    rows = rows.join(F.broadcast(docs.sparkSession.createDataFrame([(i, y) for i, y in first], "id long, y int")), ["id", "y"]).dropDuplicates(["id"])
    toxic, clean = (sum((y > 0) == want for _, y in first) for want in (True, False))
    if not toxic or not clean:
        return constant
    counts = stage(rows.select(text, "y").mapInArrow(_stem_counts, "stem string, t long, n long").groupBy("stem").agg(F.sum("t").alias("t"), F.sum("n").alias("n")), "stems")
    strongest = counts.where(F.col("t") >= support).where(F.col("t") * clean > F.col("n") * 4 * toxic).orderBy(F.desc(F.col("t") / toxic - F.col("n") / clean), F.desc(F.length("stem")), "stem").limit(CANDIDATES)
    several = counts.groupBy((F.col("t") + F.col("n")).alias("d"), "t").agg(F.count("*").alias("m")).collect()  # a row for each pair of counts
    number, as_toxic = Counter(), {}
    for r in several:
        number[r["d"]] += r["m"]
        as_toxic[r["d"], r["t"]] = r["m"]
    stems = beyond_chance([(r["stem"], r["t"], r["n"]) for r in strongest.collect()], number, as_toxic, toxic / (toxic + clean))
    drop_staged(counts)
    marks = tuple(choose_landmarks(stems, toxic, clean, landmarks))
    if not marks:
        return constant

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = text_features(b.column(0), _marks(marks))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(f.ravel().astype(np.float64)), len(marks)).cast(pa.list_(pa.float64())), b.column(1), b.column(2)], names=["f", "y", "id"])
            tk.give_back()

    got = rows.select(text, "y", "id").mapInArrow(featured, "f array<double>, y int, id long").collect()
    got.sort(key=lambda r: (r["id"], r["f"]))
    x, y = np.array([r["f"] for r in got]), np.array([r["y"] for r in got])
    own = Landmarks(list(marks))
    spelled = [_letters(s) for s in marks]
    ends = np.cumsum([len(s) for s in spelled])
    gram = own.values(np.concatenate(spelled), ends - [len(s) for s in spelled], ends).astype(np.float64)
    gram = np.where(gram >= FLOOR, gram, 0) ** POWER
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    nystroem = vector / np.sqrt(np.maximum(value, 1e-2)) @ vector.T
    w, bias = train_machine(x @ nystroem, y)
    weights = nystroem @ w
    slope, shift = calibrate(x @ weights + bias, y)
    return Model(marks, tuple(weights.tolist()), bias, slope, shift)


def score_texts(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) of each whole text. Null, empty and other texts without words have the
    score of no evidence. A column named score is replaced."""
    src = docs.drop("score")
    at = src.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(text_features(b.column(at), _marks(model.landmarks)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], names=[*b.schema.names, "score"])
            tk.give_back()

    from pyspark.sql.types import DoubleType, StructField, StructType

    return src.mapInArrow(run, StructType([*src.schema.fields, StructField("score", DoubleType())]))
