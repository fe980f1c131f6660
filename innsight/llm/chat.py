"""Chat formatting: turns assembled column by column into one Arrow buffer, and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.llm.common import key_of

# --- fixed values of the template: what stands before and after a turn's text, by role; any other role is spelled out
OPEN = {"system": "<<SYS>>", "user": "[INST]", "assistant": "<s>"}
CLOSE = {"system": "<</SYS>>", "user": "[/INST]", "assistant": "</s>"}
ROLE_OPEN, ROLE_CLOSE, OTHER_CLOSE = "[ROLE]", "[/ROLE]", "</s>"
#: Any control string; split by it, a formatted text gives its parts back.
CONTROL = re.compile(r"(<</?SYS>>|\[/?INST\]|\[/?ROLE\]|</?s>)")
ESCAPED = r"([<\[])(</?SYS>>|/?INST\]|/?ROLE\]|/?s>)"

#: A part of a conversation is at most about so long; only conversations beyond it, or cut by a border of the ranges that
#: tasks take, have more than one part.
PART_BYTES = 8_000_000
#: Characters of a role and a text that say to which range a turn goes.
RANGE_CHARS = 64
#: Parts are numbered inside a range; the number of the range stands above these bits.
RANGE_BITS = 32

PARTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("part", T.LongType()), T.StructField("formatted", T.StringType()),
    T.StructField("loss_start", T.ArrayType(T.LongType())), T.StructField("loss_end", T.ArrayType(T.LongType())),
    T.StructField("open", T.BooleanType())])
_PARTS_ARROW = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()),
                          ("loss_start", pa.list_(pa.int64())), ("loss_end", pa.list_(pa.int64())), ("open", pa.bool_())])


def escape(texts: pa.Array) -> pa.Array:
    """Double backslashes, then break control strings with one behind their first character. Null counts as empty."""
    t = pc.replace_substring(pc.fill_null(texts, ""), "\\", "\\\\")
    return pc.replace_substring_regex(t, ESCAPED, r"\1\\\2")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def _raw(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without nulls."""
    a = a.cast(pa.large_string())
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)
    return offsets, data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns one after the other, the offset of each turn, and that of its text within them.

    Four segments a turn (opening, spelled-out role, text, closing): their
    lengths are summed to offsets, the buffer is allocated once, and every
    column of segments is scattered into it by index arithmetic.
    """
    roles = pc.fill_null(roles, "")
    kinds = [*OPEN, ""]
    kind = np.full(len(roles), len(OPEN))
    for i, r in enumerate(OPEN):
        kind[pc.equal(roles, r).to_numpy(zero_copy_only=False)] = i
    other = pa.array(kind == len(OPEN))
    spelled = pc.if_else(other, pc.binary_join_element_wise(escape(roles), pa.scalar(ROLE_CLOSE), ""), "")
    fixed = [_Fixed([OPEN.get(k, ROLE_OPEN) for k in kinds], kind), spelled, escape(texts),
             _Fixed([CLOSE.get(k, OTHER_CLOSE) for k in kinds], kind)]
    columns = [c.segments() if isinstance(c, _Fixed) else _contiguous(c) for c in fixed]
    lengths = np.stack([n for n, _ in columns], 1)
    ends = np.cumsum(lengths.ravel())
    begins = (ends - lengths.ravel()).reshape(lengths.shape)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for j, (n, data) in enumerate(columns):
        # the k-th byte of the column goes to its segment's begin plus its place in the segment
        shift = begins[:, j] - (np.cumsum(n) - n)
        out[np.repeat(shift, n) + np.arange(len(data))] = data
    return out, np.append(begins[:, 0], len(out)), begins[:, 2:4]


class _Fixed:
    """A column of constants chosen by number."""

    def __init__(self, texts: list[str], choice: np.ndarray):
        self.raw, self.choice = [np.frombuffer(t.encode(), np.uint8) for t in texts], choice

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(r) for r in self.raw])
        starts = np.cumsum(sizes) - sizes
        n = sizes[self.choice]
        at = np.repeat(starts[self.choice] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return n, np.concatenate(self.raw)[at]


def _contiguous(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets, data = _raw(a)
    return np.diff(offsets), data[offsets[0]:offsets[-1]]


def sorted_turns(conversations: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """Turns in ranges of (conversation, turn, role, text; nulls first), sorted inside each range.

    A conversation with very many turns fills several ranges. What the ranges are cut by is a prefix of that order of
    bounded length, as Spark draws a sample of it to the driver.
    """
    t = conversations.select(conv.cast("long").alias("conv_id"), turn.cast("long").alias("turn"),
                             role.cast("string").alias("role"), text.cast("string").alias("text"))
    # the text counts only among equal roles, so only where the prefix holds the whole role
    whole = F.col("role").isNull() | (F.length("role") <= RANGE_CHARS)
    return t.repartitionByRange(F.col("conv_id"), F.col("turn"), F.substring("role", 1, RANGE_CHARS + 1),
                                F.when(whole, F.substring("text", 1, RANGE_CHARS))
                                ).sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """(conv_id, part, formatted, loss_start, loss_end, open): every conversation as one text with its loss mask.

    The template marks each turn by its role; control strings in texts and in
    other roles are escaped reversibly. The mask holds byte ranges of assistant
    texts. A null text or role counts as empty; rows with a null conversation
    id form one conversation; equal turn numbers are ordered by role and text,
    and repeated rows stay repeated turns. Other columns are not read, whatever their names; an empty table gives no row.

    Tasks take ranges of turns, not conversations, so that one with a third of all rows is formatted by many. A conversation
    beyond ``PART_BYTES``, or cut by a border of ranges, comes in several parts whose texts follow each other in the
    order of ``part`` (ascending, not gapless); no task holds more than one part. ``open`` is false where a row is known to
    be its whole conversation.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << RANGE_BITS
        held = _TURNS.empty_table()  # turns of the conversation that the last batch ended in
        part, border = 0, True  # parts of it that are out already; whether the range's first conversation comes next
        for b in batches:
            turns = pa.concat_tables([held, pa.Table.from_batches([b]).cast(_TURNS)]).combine_chunks()
            cuts = _cuts(turns)
            for lo, hi, same in cuts[:-1]:
                yield _format(turns.slice(lo, hi - lo), base + part, border or same or part > 0)
                part, border = part + 1 if same else 0, False
            lo, hi, _ = cuts[-1] if cuts else (0, 0, False)
            held = turns.slice(lo, hi - lo)
        if held.num_rows:
            yield _format(held, base + part, True)

    return sorted_turns(conversations, conv, turn, role, text).mapInArrow(run, PARTS)


_TURNS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _starts(turns: pa.Table) -> np.ndarray:
    """First row of each conversation."""
    ids = turns.column("conv_id")
    null = pc.is_null(ids).to_numpy()
    value = pc.fill_null(ids, 0).to_numpy()
    return np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (null[1:] != null[:-1]))) if len(value) else np.zeros(0, int)


def _cuts(turns: pa.Table) -> list[tuple[int, int, bool]]:
    """Ranges of rows (from, to, the next range goes on with the same conversation) of bounded size.

    The last range is the conversation that the next batch may go on with, or the rest of it.
    """
    n = turns.num_rows
    if not n:
        return []
    size = pc.add(pc.fill_null(pc.binary_length(turns.column("text")), 0), pc.fill_null(pc.binary_length(turns.column("role")), 0))
    upto = np.append(0, np.cumsum(size.to_numpy().astype(np.int64) + 32))
    starts = _starts(turns)
    out: list[tuple[int, int, bool]] = []
    lo = 0  # first row that is in no range yet
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
        if a > lo and (upto[b] - upto[lo] > PART_BYTES or b == n):
            out.append((lo, a, False))
            lo = a
        while upto[b] - upto[lo] > PART_BYTES and b - lo > 1 and lo >= a:
            to = int(np.searchsorted(upto, upto[lo] + PART_BYTES, "right")) - 1
            to = min(max(to, lo + 1), b - 1)
            out.append((lo, to, True))
            lo = to
        if a <= lo < b < n and out and out[-1][2]:  # the rest of a conversation in parts
            out.append((lo, b, False))
            lo = b
    out.append((lo, n, False))
    return out


def _format(turns: pa.Table, first_part: int, first_open: bool) -> pa.RecordBatch:
    """Whole conversations or a part of one -> a row for each; number and openness of the first row are given."""
    turns = turns.combine_chunks()
    one = lambda name: turns.column(name).chunk(0) if turns.num_rows else pa.array([], _TURNS.field(name).type)
    roles, texts = one("role"), one("text")
    data, offsets, inside = assemble(roles, texts)
    starts = _starts(turns)
    bounds = offsets[np.append(starts, turns.num_rows)]
    formatted = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data)])
    learn = pc.fill_null(pc.equal(roles, "assistant"), False).to_numpy(zero_copy_only=False)
    at = np.searchsorted(starts, np.flatnonzero(learn), "right") - 1
    lists = np.append(0, np.cumsum(np.bincount(at, minlength=len(starts)))).astype(np.int32)
    mask = [pa.ListArray.from_arrays(pa.array(lists), pa.array(inside[learn, j] - bounds[at])) for j in (0, 1)]
    part, is_open = np.full(len(starts), first_part >> RANGE_BITS << RANGE_BITS, np.int64), np.zeros(len(starts), bool)
    part[:1], is_open[:1] = first_part, first_open
    return pa.RecordBatch.from_arrays([one("conv_id").take(pa.array(starts)), pa.array(part), formatted, *mask, pa.array(is_open)],
                                      schema=_PARTS_ARROW)


DIGESTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
    T.StructField("formatted_chars", T.LongType())])


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    named = {v: k for k, v in OPEN.items()}
    parts = CONTROL.split(formatted)
    out, i = [], 1
    while i < len(parts):
        if parts[i] == ROLE_OPEN:
            out.append((unescape(parts[i + 1]), unescape(parts[i + 3])))
            i += 6
        else:
            out.append((named[parts[i]], unescape(parts[i + 1])))
            i += 4
    return out


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of each conversation, from the formatted parts alone as ``format_conversations`` gives them.

    Whole conversations are read where they lie. Only the parts of open ones (at most two to a range, but for those beyond
    ``PART_BYTES``) travel: a digest of a whole conversation runs over its bytes in order, part after part.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            is_open = b.column("open")
            rows = []
            for r in b.filter(pc.invert(is_open)).to_pylist():
                state = _state(r["conv_id"])
                _read(state, r)
                rows.append(_row(state))
            yield _carried(rows, b.filter(is_open))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        for b in batches:
            done = b.filter(pc.is_null(b.column("part")))
            yield done.select(DIGESTS.names)
            rows = []
            for r in b.filter(pc.is_valid(b.column("part"))).to_pylist():
                if state is None or state[0] != r["conv_id"]:
                    rows += [_row(state)] if state else []
                    state = _state(r["conv_id"])
                _read(state, r)
            yield _digests(rows)
        yield _digests([_row(state)] if state else [])

    read = parts.mapInArrow(whole, T.StructType(DIGESTS.fields + PARTS.fields[1:5]))
    return (read.repartition(key_of(F.col("conv_id"))).sortWithinPartitions("conv_id", "part").mapInArrow(rest, DIGESTS))


def _state(conv_id: int | None) -> list:
    return [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]


def _read(state: list, r: dict) -> None:
    """Take the turns of one part into the running digests of its conversation."""
    turns = read_turns(r["formatted"])
    for role, text in turns:
        state[2].update(f"{role}\n{text}\n".encode())
    raw = r["formatted"].encode()
    for i, j in zip(r["loss_start"], r["loss_end"], strict=True):
        text = unescape(raw[i:j].decode())
        state[3] += len(text)
        state[4].update(text.encode())
    state[1] += len(turns)
    state[5] += len(r["formatted"])


def _carried(rows: list[dict], parts: pa.RecordBatch) -> pa.RecordBatch:
    """Digests of whole conversations, then open parts as they are; what a row does not have is null."""
    done = pa.Table.from_batches([_digests(rows)])
    return pa.concat_tables([done, pa.Table.from_batches([parts.drop_columns(["open"])])], promote_options="default").select(
        [*DIGESTS.names, *PARTS.names[1:5]]).combine_chunks().to_batches()[0] if rows or parts.num_rows else _NOTHING


def _row(s: list) -> dict:
    return {"conv_id": s[0], "n_turns": s[1], "turns_sha256": s[2].hexdigest(), "loss_chars": s[3],
            "loss_sha256": s[4].hexdigest(), "formatted_chars": s[5]}


def _digests(rows: list[dict]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(DIGESTS.names, types, strict=True))))


_NOTHING = pa.RecordBatch.from_pylist([], pa.schema([*_digests([]).schema, *list(_PARTS_ARROW)[1:5]]))
