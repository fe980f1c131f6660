"""Harmonic packing of token pieces into fixed-length sequences."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.llm.common import materialise

#: A piece is cut shorter if packing it whole would leave more than this many tokens of its share of a sequence unused.
MAX_WASTE = 12
#: Rows tokenised at a time are cut so that their ids stay within this many characters of text.
BLOCK_CHARS = 2_000_000
#: Sequence ids: the worker's number is shifted by so many bits; closing sequences follow from here.
WORKER_BITS, CLOSING = 32, 1 << 61

#: Texts of nothing but these characters split alike in both libraries; others go through the vocabulary's own library.
PLAIN = re.compile("[\x00-\x1b !-~À-ÖØ-öø-ÿ‘’“”–—…]*")


@cache
def _encoders(path: str):
    """The tokenizers library's encoder of a byte-level file, and a faster one over the same merges."""
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = {c: b for b, c in enumerate(_byte_chars())}
    ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in spec["model"]["vocab"].items()
             if all(c in byte_of for c in t)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    if any(spec["model"]["vocab"][a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        return slow, None  # ids that are not ranks: only the slow encoder is right
    ranks = {k: v for k, v in ranks.items() if v not in special.values()}
    return slow, tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


# --- fixed value: how byte-level vocabularies split text before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_chars() -> list[str]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text as the tokenizers library gives them, without special tokens added."""
    slow, fast = _encoders(path)
    if fast and PLAIN.fullmatch(text):
        return fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
    return np.array(slow.encode(text, add_special_tokens=False).ids, "<u4")


def cut_lengths(n: int, capacity: int, max_waste: int = MAX_WASTE) -> list[int]:
    """Lengths of the pieces of n tokens: full sequences, then cuts at class sizes until little of a share is unused.

    A piece of r tokens is of class k = capacity // r: k of its class fill a
    sequence, each with a share of capacity / k. If r leaves more than
    ``max_waste`` of its share, the largest size of the next class,
    capacity // (k + 1), is cut off, and the rest is treated alike; the rest shrinks at least by half with each cut.
    """
    out = [capacity] * (n // capacity)
    r = n % capacity
    while r:
        k = capacity // r
        if capacity / k - r <= max_waste:
            out.append(r)
            break
        cut = capacity // (k + 1)
        out.append(cut)
        r -= cut
    return out


PIECE = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType()),
         ("sequence_id", T.LongType()), ("offset", T.LongType())]


def pack(docs: DataFrame, vocab_path: str, end_id: int, text_col: str = "text", carry: list[str] | None = None,
         capacity: int = 2048, max_waste: int = MAX_WASTE, with_ids: bool = False) -> DataFrame:
    """Tokenise every text, end it with ``end_id``, and pack all ids into sequences of at most ``capacity``.

    One row per piece: the columns in ``carry`` (all but the text, if None),
    ``start`` (its document's ids before it), ``length``, ``ids_crc32`` (of
    little-endian unsigned 32-bit ids), ``doc_tokens`` (with the end id),
    ``sequence_id`` and ``offset`` (gapless from 0 in each sequence), with
    ``with_ids`` also ``ids``. Columns of these names are replaced. A null text
    counts as empty: its one piece is the end id. Repeated rows are packed like any others; an empty table gives no piece.

    Lengths fall into classes of reciprocal capacity, and ``capacity // length``
    pieces of a class fill a sequence. Every worker fills the sequences of its
    classes by itself while it tokenises; only its last, unfilled sequence of each class
    stays open. The pieces of open sequences (under k for each class and
    worker) are then ranked by class over all workers and fill sequences in
    the same way; what is left at last, less than a sequence for each class,
    shares closing sequences, longest rests first.
    """
    new = [n for n, _ in PIECE] + ["ids"]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in new and (carry is not None or c != text_col)]
    inner = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"),
                        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)])
    kept = [T.StructField(f"c{i}", inner.schema[f"c{i}"].dataType) for i in range(len(carry))]
    added = [T.StructField(n, t) for n, t in PIECE] + ([T.StructField("ids", T.BinaryType())] if with_ids else [])
    marks = [T.StructField("k", T.IntegerType()), T.StructField("worker", T.LongType()),
             T.StructField("loose", T.BooleanType())]
    schema = T.StructType(kept + added + marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, worker = _arrow(schema), _task_number()
        fill = _Filler(capacity, worker)
        for b in batches:
            done = 0
            for i in range(b.num_rows):
                text = b.column(0)[i].as_py()
                own = tuple(b.column(1 + j)[i].as_py() for j in range(len(carry)))
                ids = np.append(token_ids(text, vocab_path), np.uint32(end_id)).astype("<u4")
                at = 0
                for n in cut_lengths(len(ids), capacity, max_waste):
                    raw = ids[at:at + n].tobytes()
                    fill.put((*own, at, n, zlib.crc32(raw), len(ids)), n, (raw,) if with_ids else ())
                    at += n
                done += len(text)
                if done > BLOCK_CHARS:
                    yield _batch(fill.take(), shape)
                    done = 0
            yield _batch(fill.take(), shape)
        yield _batch(fill.rest(), shape)

    pieces = materialise(inner.mapInArrow(run, schema), "pieces")
    filled, last = _fill_loose(pieces.where("loose"), capacity)
    cols = [f.name for f in kept + added]
    out = (pieces.where("not loose").select(cols).unionByName(filled.select(cols))
           .unionByName(_close(last, capacity).select(cols)))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], *[f.name for f in added])


class _Filler:
    """The open sequences of one worker, one for each class; a bounded number of pieces waits in them."""

    def __init__(self, capacity: int, worker: int):
        self.capacity, self.worker, self.made = capacity, worker, 0
        self.waiting: dict[int, list[tuple]] = {}
        self.used: dict[int, int] = {}
        self.full: list[tuple] = []

    def put(self, piece: tuple, n: int, more: tuple) -> None:
        k = self.capacity // n
        used = self.used.get(k, 0)
        group = self.waiting.setdefault(k, [])
        group.append((piece, used, more))
        self.used[k] = used + n
        if len(group) == k:
            seq = (self.worker << WORKER_BITS) + self.made
            self.made += 1
            self.full += [(*p, seq, off, *m, k, self.worker, False) for p, off, m in group]
            self.waiting[k], self.used[k] = [], 0

    def take(self) -> list[tuple]:
        out, self.full = self.full, []
        return out

    def rest(self) -> list[tuple]:
        return [(*p, k, i, *m, k, self.worker, True) for k, group in self.waiting.items()
                for i, (p, _, m) in enumerate(group)]


def _task_number() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[] for _ in shape]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, shape, strict=True)], schema=shape)


def _fill_loose(loose: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame]:
    """Rank the loose pieces of each class over all workers; full sequences, and the pieces left over."""
    counts = loose.groupBy("k", "worker").agg(F.count(F.lit(1)).alias("m"))
    in_class = Window.partitionBy("k")
    counts = counts.withColumn("before", F.sum("m").over(in_class.orderBy("worker")) - F.col("m")).withColumn(
        "total", F.sum("m").over(in_class)).drop("m")
    ranked = (loose.join(counts, ["k", "worker"])
              .withColumn("r", F.col("before") + F.row_number().over(Window.partitionBy("k", "worker").orderBy("offset")) - 1)
              .withColumn("s", F.expr("r div k")))
    whole = (F.col("s") + 1) * F.col("k") <= F.col("total")
    seq = F.lit(CLOSING >> 1) + F.col("s") * (capacity + 1) + F.col("k")
    # the pieces of one new sequence, at most k of them, come together to get their offsets
    together = Window.partitionBy("k", "s").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    full = ranked.where(whole).withColumn("offset", F.sum("length").over(together) - F.col("length")).withColumn("sequence_id", seq)
    return full, ranked.where(~whole)


def _close(last: DataFrame, capacity: int) -> DataFrame:
    """What is left of each class is less than a sequence long: these few rests (one a class) share sequences, first fit by
    falling length."""
    rests = last.groupBy("k").agg(F.sum("length").alias("n"))

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((r["n"], r["k"]) for t in tables for r in t.to_pylist()), reverse=True)
        room: list[int] = []
        out = []
        for n, k in rows:
            j = next((j for j, free in enumerate(room) if free >= n), len(room))
            if j == len(room):
                room.append(capacity)
            out.append({"c": k, "seq": CLOSING + j, "base": capacity - room[j]})
            room[j] -= n
        yield pa.RecordBatch.from_pylist(out, pa.schema([("c", pa.int32()), ("seq", pa.int64()), ("base", pa.int64())]))

    places = rests.repartition(1).mapInArrow(run, "c int, seq long, base long")
    before = Window.partitionBy("k").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    return (last.join(places, F.col("k") == F.col("c"))
            .withColumn("offset", F.col("base") + F.sum("length").over(before) - F.col("length"))
            .withColumn("sequence_id", F.col("seq")))
