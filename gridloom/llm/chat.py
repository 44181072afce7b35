"""Chat formatting by columnar byte assembly.

A turn becomes ``<s>[INST]`` role ``[/INST]`` text ``</s>``. Inside roles and texts every backslash is doubled and
every control string gets a backslash after its first character, so a marker in the output is always the
template's own and :func:`parse` gives back roles and texts exactly. The loss mask covers each assistant text.

For a batch, segment lengths, their cumulated offsets and the place each content byte moves to are numpy arrays;
headers and contents are copied once, into one preallocated Arrow buffer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

OPEN, MID, CLOSE = b"<s>[INST]", b"[/INST]", b"</s>"
CONTROL = (b"<s>", b"</s>", b"[INST]", b"[/INST]")
_FIND = re.compile(rb"(?=(\\|" + b"|".join(re.escape(c) for c in CONTROL) + rb"))")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
#: Text of one assembled batch, about.
BATCH_BYTES = 8 << 20


def _inserts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte places before which a backslash goes, ascending."""
    places, row = [], 0
    for m in _FIND.finditer(data.tobytes()):
        at, n = m.start(), len(m.group(1))
        row = int(np.searchsorted(offsets, at, "right")) - 1
        if at + n <= offsets[row + 1]:  # a control string across two texts is none
            places.append(at if n == 1 else at + 1)
    return np.array(places, dtype=np.int64)


def _scatter(out: np.ndarray, data: np.ndarray, offsets: np.ndarray, at: np.ndarray, inserts: np.ndarray) -> None:
    """Copy each row's bytes to its place ``at``, with the backslashes."""
    if not len(data):
        return
    rows = np.diff(offsets)
    seen = np.searchsorted(inserts, offsets[:-1])
    shift = np.repeat(at - offsets[:-1] - seen, rows)
    source = np.arange(len(data))
    gone = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(gone, inserts, 1)
    target = source + shift + np.cumsum(gone[:-1])
    out[target] = data
    out[target[inserts] - 1] = ord("\\")


def assemble(roles: pa.Array, texts: pa.Array, conv: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Formatted conversations, and the (row, begin, end) of assistant texts in code points of the output.

    ``conv`` numbers the conversation of each turn from 0, ascending.
    """
    (rd, ro), (td, to) = tk.text_rows(roles), tk.text_rows(texts)
    ri, ti = _inserts(rd, ro), _inserts(td, to)
    role_len = np.diff(ro) + np.diff(np.searchsorted(ri, ro))
    text_len = np.diff(to) + np.diff(np.searchsorted(ti, to))
    turn = len(OPEN) + role_len + len(MID) + text_len + len(CLOSE)
    begin = np.concatenate([[0], np.cumsum(turn)])
    buffer = pa.allocate_buffer(int(begin[-1]))
    out = np.frombuffer(buffer, dtype=np.uint8)
    at_role = begin[:-1] + len(OPEN)
    at_text = at_role + role_len + len(MID)
    for marker, at in ((OPEN, begin[:-1]), (MID, at_role + role_len), (CLOSE, at_text + text_len)):
        out[at[:, None] + np.arange(len(marker))] = np.frombuffer(marker, np.uint8)
    _scatter(out, rd, ro, at_role, ri)
    _scatter(out, td, to, at_text, ti)
    n = int(conv[-1]) + 1 if len(conv) else 0
    first = np.searchsorted(conv, np.arange(n + 1))
    ends = begin[first]
    formatted = pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends.astype(np.int64)), buffer)
    points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])  # code points before each byte
    said = np.flatnonzero(np.array(roles.fill_null("").to_pylist(), dtype=object) == "assistant") if len(conv) else np.zeros(0, int)
    base = points[ends[:-1]][conv[said]] if len(said) else np.zeros(0, np.int64)
    return formatted, conv[said] if len(said) else said, points[at_text[said]] - base, points[(at_text + text_len)[said]] - base


def unescape(s: str) -> str:
    return _UNESCAPE.sub(r"\1", s) if "\\" in s else s


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def format_chats(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: Column | int | None = None) -> DataFrame:
    """One row a conversation: ``(conv, n_turns, formatted, loss)``; ``loss`` has the begin and end, in code points
    of ``formatted``, of each assistant text (escaped), in order.

    Turns go by ``turn``, null first; ties by role and text. Null role or text: empty. Rows with a null
    conversation id make one conversation. A conversation is one row of output and so must fit in a task, as any
    row must; conversations are dealt by id and streamed in order. Empty table: no rows.
    """
    src = rows.select(F.col(conv).cast("long").alias("c"), F.col(turn).cast("long").alias("t"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = src.repartition("c").sortWithinPartitions("c", "t", "role", "text").select("c", "role", "text")
    schema = "c long, n_turns long, formatted string, loss array<struct<begin: long, end: long>>"

    def made(part: pa.Table) -> pa.RecordBatch:
        ids = part.column("c").combine_chunks()
        key = ids.fill_null(-(2**63)).to_numpy(zero_copy_only=False)
        null = ids.is_null().to_numpy(zero_copy_only=False)
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (null[1:] != null[:-1])
        number = np.cumsum(new) - 1
        formatted, row, a, b = assemble(part.column("role").combine_chunks(), part.column("text").combine_chunks(), number)
        n = len(formatted)
        spans = pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["begin", "end"])
        loss = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32)), spans)
        turns = np.diff(np.append(np.flatnonzero(new), len(key)))
        return pa.RecordBatch.from_arrays([ids.filter(pa.array(new)), pa.array(turns, pa.int64()), formatted.cast(pa.string()), loss], names=["c", "n_turns", "formatted", "loss"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for lo, hi in tk.slices(tk.text_rows(batch.column(2))[1], BATCH_BYTES):
                b = batch.slice(lo, hi - lo)
                held.append(b)
                size += b.nbytes
                if size < BATCH_BYTES:
                    continue
                last = b.column(0)[-1]
                whole = pa.Table.from_batches(held)
                # The last conversation may go on in the next batch.
                ids = whole.column(0)
                same = ids.is_null() if not last.is_valid else pc.equal(ids, last).fill_null(False)
                n = whole.num_rows - int(pc.sum(same).as_py())
                if n:
                    yield made(whole.slice(0, n))
                    held, size = whole.slice(n).combine_chunks().to_batches(), 0
        if held:
            yield made(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, schema).withColumnRenamed("c", conv)


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digests of what the output says, by parsing it: turns, and the text under the loss mask."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = []
                for s, loss in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    turns = parse(s)
                    told = "".join(f"{r}\n{t}\n" for r, t in turns)
                    masked = "".join(unescape(s[x["begin"] : x["end"]]) for x in loss)
                    rows.append((len(turns), hashlib.sha256(told.encode()).hexdigest(), len(masked), hashlib.sha256(masked.encode()).hexdigest(), len(s)))
                cols = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())))], names=[conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select(conv, "formatted", "loss").mapInArrow(run, f"`{conv}` long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
