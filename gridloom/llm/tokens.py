"""Token ids of whole batches of texts, equal to those of the byte-level BPE tokenizer file.

Texts are cut into the tokenizer's own pieces with numpy (class changes, white space, contractions). Each distinct
piece is encoded once a worker and kept in a bounded table; ids of a batch are then gathered. Texts with other
characters than ASCII and Latin letters are encoded whole, as are texts that hold a special token's string.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

from . import textkit as tk

_L, _N, _P, _S = 1, 2, 3, 4
_CLASS = np.full(256, _P, dtype=np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = _L
_CLASS[0xC3] = _L
_CLASS[0x80:0xC0] = _L  # second bytes of Latin letters
_CLASS[48:58] = _N
_CLASS[[0x20, *range(0x09, 0x0E)]] = _S
#: Bytes of texts that are encoded whole: other leads, and separators on which the splitters differ.
_OTHER = np.zeros(256, dtype=bool)
_OTHER[[*range(0x1C, 0x20), *range(0xC0, 0xC3), *range(0xC4, 0x100)]] = True

#: Distinct pieces that a worker keeps; the table starts anew beyond.
KEPT = 500_000
_BITS = 20


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin, for texts of ASCII and Latin letters (``offsets``: where texts begin and end)."""
    n = len(data)
    kind = _CLASS[data]
    begin = np.zeros(n + 1, dtype=bool)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begin[0] = True
    begin[1:n] = kind[1:] != kind[:-1]
    begin |= edge
    # A run of white space gives its last character to what follows, if that is in the same text: a blank joins
    # it, another character stands alone.
    ends = np.flatnonzero(begin[1:n] & (kind[:-1] == _S) & ~edge[1:n]) + 1
    begin[ends - 1] = True
    begin[ends[data[ends - 1] == 0x20]] = False
    # 's 't 'm 'd 're 've 'll, where the apostrophe begins a piece of its own.
    at = np.flatnonzero(data == 0x27)
    if len(at):
        at = at[begin[at] & begin[at + 1] & ~edge[at + 1]]
        at = at[at + 1 < n]
        one = data[at + 1]
        two = np.where((at + 2 < n) & ~edge[np.minimum(at + 2, n)], data[np.minimum(at + 2, n - 1)], 0)
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        begin[at[long | short] + 1] = False
        begin[at[short] + 2] = True
        begin[at[long] + 3] = True
    return np.flatnonzero(begin[:n])


class Encoder:
    """Encodes batches; ``path`` names the vocabulary as a JSON tokenizer file."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        spec = json.load(open(path, encoding="utf-8"))
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        special = {t["content"] for t in spec["added_tokens"]}
        # The file writes bytes as printable characters; ids are merge ranks.
        chars = _byte_chars()
        ranks = {bytes(chars[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        del spec
        self.fast = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for piece, i in ranks.items():
            self.width[i] = len(piece)
        self._clear()

    @cached_property
    def whole(self):
        """The tokenizer itself; only texts that hold a special token's string need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _clear(self) -> None:
        self.known = tk.Known(_BITS)
        self.n = 0
        self.first = np.zeros(KEPT + 1, dtype=np.int64)
        self.ids = np.zeros(1 << 20, dtype=np.uint16)

    def _learn(self, h: np.ndarray, pieces: list[bytes]) -> None:
        """Encode new pieces. Those of a blank and a text are encoded in one go, since each begins anew there."""
        joined = [i for i, p in enumerate(pieces) if len(p) > 1 and p[0] == 0x20 and p[1] not in b" \t\n\r\x0b\x0c"]
        got: list = [None] * len(pieces)
        if joined:
            ids = np.array(self.fast.encode_ordinary(b"".join(pieces[i] for i in joined).decode()), dtype=np.int64)
            ends = np.cumsum(self.width[ids])
            cut = np.searchsorted(ends, np.cumsum([len(pieces[i]) for i in joined])) + 1
            for i, a, b in zip(joined, [0, *cut[:-1]], cut):
                got[i] = ids[a:b]
        for i, p in enumerate(pieces):
            if got[i] is None:
                got[i] = self.fast.encode_ordinary(p.decode())
        flat = np.concatenate([np.asarray(g, dtype=np.uint16) for g in got])
        base, used = self.n, int(self.first[self.n])
        while used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used : used + len(flat)] = flat
        self.first[base + 1 : base + len(got) + 1] = used + np.cumsum([len(g) for g in got])
        self.n += len(got)
        self.known.add(h, base + np.arange(len(h)))

    def _latin(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in a row, and their numbers by text."""
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(len(offsets) - 1, np.int64)
        start = piece_starts(data, offsets)
        end = np.append(start[1:], len(data))
        n = len(data)
        power, inverse = tk._powers(tk._BASE, n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(tk._BYTE[data] * power[:n], out=total[1:])
        h = tk.mix64((total[end] - total[start]) * inverse[start] ^ (end - start).astype(np.uint64))
        found = self.known.find(h)
        new = np.flatnonzero(found < 0)
        if len(new):
            keys, first = np.unique(h[new], return_index=True)
            if self.n + len(keys) > KEPT:
                self._clear()
                keys, first = np.unique(h, return_index=True)
                new = np.arange(len(h))
            at = new[first]
            raw = data.tobytes()
            self._learn(keys, [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())])
            found[new] = self.known.find(h[new])
        first = self.first[found]
        count = self.first[found + 1] - first
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(first - (ends - count), count) + np.arange(int(ends[-1]))]
        by_text = np.concatenate([[0], ends])[np.searchsorted(start, offsets)]
        return ids, np.diff(by_text)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(ids, numbers by text)`` for consecutive groups of texts."""
        rows = len(offsets) - 1
        odd = _OTHER[data]
        if len(data) > 1:
            odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # the two signs among the letters
        raw = data.tobytes()
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                odd[at] = True
                at = raw.find(s, at + 1)
        seen = np.concatenate([[0], np.cumsum(odd)])
        other = np.flatnonzero(np.diff(seen[offsets]))
        lo = 0
        for row in [*other.tolist(), rows]:
            if row > lo:
                a, b = offsets[lo], offsets[row]
                yield self._latin(data[a:b], offsets[lo : row + 1] - a)
            if row < rows:
                text = raw[offsets[row] : offsets[row + 1]]
                special = any(s in text for s in self.special)
                ids = self.whole.encode(text.decode(), add_special_tokens=False).ids if special else self.fast.encode_ordinary(text.decode())
                yield np.array(ids, dtype=np.uint16), np.array([len(ids)])
            lo = row + 1


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in such a file: itself where it prints, else the next
    free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a file; a bare name is looked up among the public tokenizer files there."""
    kept = tk.kept_by("tokens")
    if path not in kept:
        at = path
        if "/" not in path:
            import public_tokenizers

            at = public_tokenizers.path(path)
        kept[path] = Encoder(at)
        tk.give_back()
    return kept[path]


def token_batches(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after last, ids, numbers by row)`` of a column of texts; null texts have no ids."""
    enc = encoder(path)
    data, offsets = tk.text_rows(column)
    for lo, hi in tk.slices(offsets):
        a, b = offsets[lo], offsets[hi]
        parts = list(enc.encode(data[a:b], offsets[lo : hi + 1] - a))
        if parts:
            yield lo, hi, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
