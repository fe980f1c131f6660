"""Near-duplicate texts by SimHash: fingerprints, and links between them found in a table of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.llm.common import map_text, materialise
from innsight.llm.jaccard import _each_group
from innsight.operators.components import components

#: Words of a shingle, seed of its hash, and the most differing bits of a link.
WORDS, SEED, MOST_BITS = 3, 42, 2
#: A cell of at most so many fingerprints is compared; a larger one is split, and in the end compared in blocks of so many.
CELL = 1024
#: Parts that a cell's open strips are cut into; a pair within two bits leaves all but two of them alone.
PARTS = 4
#: Strips of two bits. Reference 1 + j differs from reference 0 in strip j alone; the references after them are independent.
STRIPS, SPREAD = 32, 31
#: Names that the result adds.
ADDED = ("fingerprint", "component_id")


def _references() -> np.ndarray:
    rng = np.random.default_rng(13)
    base = rng.integers(0, 1 << 64, 1, dtype=np.uint64)
    strips = base ^ (np.uint64(3) << (np.uint64(2) * np.arange(STRIPS, dtype=np.uint64)))
    return np.concatenate([base, strips, rng.integers(0, 1 << 64, SPREAD, dtype=np.uint64)])


#: The reference fingerprints of the distance table.
REFERENCES = _references()


# --- fingerprints ---------------------------------------------------------------------------------

def fingerprint(text: str | None) -> int:
    """64 bits, each set if it is set in over half of the hashes of the text's word 3-grams, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return 0
    size = min(n, WORDS)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[:n - size + 1].tolist()
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    h = np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist(), strict=True)), np.uint64, n - size + 1)
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(h), 8192):
        bits = np.unpackbits(h[lo:lo + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * counts > len(h)).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
    """The carried columns and ``fp``, the fingerprint as a long."""
    def make():
        def run(texts: pa.Array) -> list:
            return [np.array([fingerprint(t.as_py()) for t in texts], np.uint64).view(np.int64)]
        return run

    return map_text(docs, text_col, [T.StructField("fp", T.LongType())], make, carry)


# --- the distance table ----------------------------------------------------------------------------

def distances(fp: np.ndarray) -> np.ndarray:
    """Number of bits in which each fingerprint differs from each reference."""
    return np.bitwise_count(fp.view(np.uint64)[:, None] ^ REFERENCES[None]).astype(np.int8)


def _split(cells: np.ndarray, opens: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, new cell, strips left open): the smaller cells of every row.

    ``opens`` are the strips, as bits, that do not yet bind the rows of a cell. They are cut into four parts; a
    pair that differs in two bits differs in two parts at most, so it has equal distances in two of them, and meets in the cell of these two.
    """
    # distance to reference 1 + j less that to reference 0 says how many bits of strip j differ from reference 0
    steps = ((table[:, 1:1 + STRIPS] - table[:, :1] + 2) // 2).astype(np.uint64)
    at, new, left = [], [], []
    for mask in np.unique(opens).tolist():
        rows = np.flatnonzero(opens == mask)
        strips = [j for j in range(STRIPS) if mask >> j & 1]
        cut = [strips[len(strips) * i // PARTS:len(strips) * (i + 1) // PARTS] for i in range(PARTS)]
        codes = []
        for part in cut:
            code = np.zeros(len(rows), np.uint64)
            for j in part:
                code = code * np.uint64(3) + steps[rows, j]
            codes.append(code)
        for a, b in combinations(range(PARTS), 2):
            h = cells[rows].view(np.uint64)
            for x in (np.full(len(rows), (mask << 4) + a * PARTS + b, np.uint64), codes[a], codes[b]):
                h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
            at.append(rows)
            new.append(h.view(np.int64))
            left.append(np.full(len(rows), sum(1 << j for i, p in enumerate(cut) for j in p if i not in (a, b)), np.int64))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *at]), np.concatenate([none, *new]), np.concatenate([none, *left])


_CELLS = "cell long, open long, fp long, dist binary"


def _to_cells(rows: DataFrame) -> DataFrame:
    """Rows (cell, open, fp, dist) in the smaller cells of each; a row without distances gets them first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(lo, 2048) for x in batches for lo in range(0, x.num_rows, 2048)):
            cell, opened, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if b.column(3).null_count:
                table = distances(fp)
                dist = pa.array([r.tobytes() for r in table], pa.binary())
            else:
                dist = b.column(3)
                table = np.frombuffer(b"".join(dist.to_pylist()), np.int8).reshape(b.num_rows, len(REFERENCES))
            at, new, left = _split(cell, opened, table)
            yield pa.RecordBatch.from_arrays([pa.array(new), pa.array(left), pa.array(fp[at]), dist.take(pa.array(at))],
                                             names=["cell", "open", "fp", "dist"])

    return rows.select("cell", "open", "fp", "dist").mapInArrow(run, _CELLS)


def _cells(fps: DataFrame) -> DataFrame:
    """(cell, m, fp, dist): cells of at least two fingerprints, every pair within two bits together in one of them.

    Cells of more than ``CELL`` are split until no strips are left to split by.
    """
    rows = fps.select(F.lit(0).cast("long").alias("cell"), F.lit((1 << STRIPS) - 1).cast("long").alias("open"), "fp",
                      F.lit(None).cast("binary").alias("dist"))
    done, strips = None, STRIPS
    while True:
        rows, strips = materialise(_to_cells(rows), "cells"), strips // 2
        # the key as a struct: both sides are shuffled for the join itself, so that a large cell can be split
        sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.struct("cell").alias("k"), "m")
        met = rows.withColumn("k", F.struct("cell")).join(sizes, "k").drop("k")
        last = strips < PARTS
        small = met if last else met.where(F.col("m") <= CELL)
        done = small if done is None else done.unionByName(small)
        rows = met.where(F.col("m") > CELL).drop("m")
        if last or rows.isEmpty():
            return done.drop("open")


def _near(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (i, j) those within two bits: first the distance table discards, then the fingerprints themselves decide."""
    for c in range(0, table.shape[1], 16):
        keep = (np.abs(table[i, c:c + 16] - table[j, c:c + 16]) <= MOST_BITS).all(1)
        i, j = i[keep], j[keep]
    near = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= MOST_BITS
    return i[near], j[near]


def _linked(fp: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows within two bits. Row by row of the whole square, a pair differing by more than two in one distance is discarded."""
    far = table[:, 1 + STRIPS:]  # the independent references tell most
    out_i, out_j = [], []
    for lo in range(0, len(fp), 256):
        keep = np.arange(len(fp))[None] > np.arange(lo, min(len(fp), lo + 256))[:, None]
        for c in range(8):
            keep &= np.abs(far[lo:lo + 256, c][:, None] - far[:, c][None]) <= MOST_BITS
        i, j = np.nonzero(keep)
        i, j = _near(fp, table, i + lo, j)
        out_i.append(i)
        out_j.append(j)
    return np.concatenate(out_i), np.concatenate(out_j)


def _least(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the least row that the pairs connect it with."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(cells: DataFrame) -> DataFrame:
    """Links (a, b) that connect whatever is within two bits: inside a block, each row with the least one it is connected with."""
    n = F.ceil(F.col("m") / CELL).cast("int")
    own = F.pmod(F.xxhash64("fp", "cell"), n).cast("int")
    # a cell of several blocks: any two blocks meet once, as one group of rows
    dealt = (cells.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
             .select("cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp", "dist"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for t in _each_group(batches, ["cell", "x", "y"]):
            held.append(t)
            rows += t.num_rows
            if rows >= 4096:
                yield links(pa.concat_tables(held))
                held, rows = [], 0
        if held:
            yield links(pa.concat_tables(held))

    def links(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        fp = t.column("fp").to_numpy()
        table = np.frombuffer(b"".join(t.column("dist").to_pylist()), np.int8).reshape(len(fp), len(REFERENCES))
        new = np.zeros(len(fp), bool)
        new[0] = True
        for k in ("cell", "x", "y"):
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        group = np.cumsum(new) - 1
        sizes = np.bincount(group)
        pairs = [(np.zeros(0, np.int64),) * 2]
        # small groups together: each row with the row s places on, while it is in the same group
        for s in range(1, min(64, int(sizes.max()))):
            i = np.flatnonzero((group[s:] == group[:-s]) & (sizes[group[s:]] <= 64))
            pairs.append(_near(fp, table, i, i + s))
        first = np.flatnonzero(new)
        for g in np.flatnonzero(sizes > 64).tolist():
            lo, hi = first[g], first[g] + sizes[g]
            i, j = _linked(fp[lo:hi], table[lo:hi])
            pairs.append((i + lo, j + lo))
        i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
        least = _least(len(fp), i, j)
        at = np.flatnonzero(least != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[least[at]])], names=["a", "b"])

    return (dealt.repartition("cell", "x", "y").sortWithinPartitions("cell", "x", "y", "fp")
            .mapInArrow(run, "a long, b long"))


def _joined(rows: DataFrame, more: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join on a key that most rows may share: the key as a struct, so that its partition can be split."""
    return (rows.withColumn("k", F.struct(key)).join(more.withColumn("k", F.struct(key)).drop(key), "k", how).drop("k"))


def link_fingerprints(fps: DataFrame) -> DataFrame:
    """(fp, root) for every fingerprint of ``fps`` (distinct ``fp`` long) that has one within two bits; ``root`` names its component."""
    found = materialise(_links(_cells(fps)).distinct(), "links")
    return components(found).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, key: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Fingerprint and component of every document; two are linked if their fingerprints differ in two bits at most.

    Returns the columns named in ``carry`` (all, if None) and fingerprint (16 lowercase hex digits), component_id
    (the least ``key`` that links reach from the document, itself included); a column of ``docs`` with one of
    these names is replaced. Texts are lower-cased in A-Z and cut at ASCII blanks; a text of fewer than three words is one
    shingle, a null or empty text or one of blanks has fingerprint zero and is linked like any other. A null key never
    becomes a component's id unless all its keys are null; repeated rows and keys get the same answer; an empty table gives an empty one.

    Every distinct fingerprint gets its distances to 64 references once. Distances to references that differ in a strip of
    two bits alone place it in cells of the table (two of four bands equal); cells hold all pairs within two bits. Inside a cell a pair whose distances to any
    reference differ by more than two is discarded, the others are verified. Cells that are too large are split by the distances of
    the bands not used yet; what is left too large is compared in blocks. All links are kept up to connection.
    """
    cols = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    rows = docs.select(F.col(f"`{text_col}`").alias("t"), F.col(f"`{key}`").alias("key"),
                       *[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(cols)])
    own = ["key", *[f"in{i}" for i in range(len(cols))]]
    rows = materialise(fingerprints(rows, "t", own), "fingerprints")
    fps = materialise(rows.groupBy("fp").agg(F.min("key").alias("least")), "distinct-fingerprints")
    linked = materialise(link_fingerprints(fps.select("fp")), "components")
    member = linked.join(fps, "fp")
    ids = _joined(member.select("fp", "root"), member.groupBy("root").agg(F.min("least").alias("joint")), "root").select("fp", "joint")
    answer = materialise(fps.join(ids, "fp", "left").select(
        "fp", F.when(F.col("joint").isNull(), F.col("least")).otherwise(F.col("joint")).alias("component_id")), "answers")
    return _joined(rows, answer, "fp").select(
        *[F.col(f"in{i}").alias(c) for i, c in enumerate(cols)], hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
