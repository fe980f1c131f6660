"""Merkle manifest of a dataset: a tree of SHA-256 digests whose parents keep hash states, and a check of every row against its root."""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.llm.common import key_of, materialise

#: Children of a node.
FANOUT = 16
#: Levels of a tree that one group of rows covers: 16 ** 3 = 4096 nodes, the most that one call holds.
TIER_LEVELS = 3
_SHIFT = 4 * TIER_LEVELS
#: Columns that the check of rows adds.
ADDED = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def encoded(value: Column) -> Column:
    """One value inside a leaf: ``-`` if null, else its length in UTF-8 bytes, a colon and the value."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(values: list[Column]) -> Column:
    """Lowercase hex digest of the encoded values of a row."""
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


# --- inside one group of nodes ------------------------------------------------------------------

def _levels(n: int) -> int:
    """Levels from ``n`` nodes to a single one."""
    k = 0
    while n > 1:
        n, k = -(-n // FANOUT), k + 1
    return k


class _Level:
    """One level of nodes: of each node the state of its parent's hash before its slot, and the siblings left and right of it."""

    def __init__(self, nodes: list[bytes]) -> None:
        self.states, self.left, self.right, self.parents = [], [], [], []
        for lo in range(0, len(nodes), FANOUT):
            run, h = nodes[lo:lo + FANOUT], sha256()
            for i, d in enumerate(run):
                self.states.append(h.copy())
                self.left.append(b"".join(run[:i]))
                self.right.append(b"".join(run[i + 1:]))
                h.update(d)
            self.parents.append(h.hexdigest().encode())

    def resume(self, slot: int, digest: bytes) -> bytes:
        """Digest of the parent if the node in ``slot`` were ``digest``: its state goes on from there, nothing left of it is hashed again."""
        h = self.states[slot].copy()
        h.update(digest + self.right[slot])
        return h.hexdigest().encode()


def _grown(nodes: list[bytes], size: int) -> list[_Level]:
    """The levels above a group's nodes; ``size`` is the number of nodes of the whole tree at the lowest level."""
    out = []
    for _ in range(min(TIER_LEVELS, _levels(size))):
        out.append(_Level(nodes))
        nodes = out[-1].parents
    return out


def _ordered(t: pa.Table) -> tuple[pa.Table, list[bytes], int]:
    t = t.sort_by("pos")
    return t, [d.encode() for d in t.column("d").to_pylist()], t.column("n")[0].as_py()


_NODES = pa.schema([("t", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("d", pa.string())])


def _tops(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """One row: what a group of nodes becomes, a node of the next tier."""
    _, nodes, size = _ordered(t)
    levels = _grown(nodes, size)
    top = levels[-1].parents[0] if levels else nodes[0]
    return pa.Table.from_pylist([{"t": key[0].as_py(), "pos": key[1].as_py(), "n": -(-size // FANOUT ** TIER_LEVELS), "d": top.decode()}], _NODES)


_WAYS = pa.schema([("t", pa.string()), ("pos", pa.int64()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])


def _ways(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """Of each node of a group the siblings left and right of its way up inside the group, level by level."""
    t, nodes, size = _ordered(t)
    levels = _grown(nodes, size)
    left, right = [], []
    for i in range(len(nodes)):
        left.append([level.left[i >> 4 * k].decode() for k, level in enumerate(levels)])
        right.append([level.right[i >> 4 * k].decode() for k, level in enumerate(levels)])
    return pa.table([t.column("t"), t.column("pos"), pa.array(left, _WAYS[2].type), pa.array(right, _WAYS[3].type)], schema=_WAYS)


_FOLDED = pa.schema([("r", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("proof", pa.string()), ("folded", pa.string())])


def _folded(rows: pa.Table, above: pa.Table) -> pa.Table:
    """Proof of each row of a group, and the root that its presented leaf folds to.

    Inside the group, states are those that its parents kept; above it, one state a level, hashed once from
    the siblings left of the group's way up, serves all rows of the group.
    """
    rows, nodes, size = _ordered(rows)
    shown = [d.encode() for d in rows.column("shown").to_pylist()]
    levels = _grown(nodes, size)
    left, right = ([x.encode() for x in above.column(c)[0].as_py()] for c in ("left", "right"))
    outer, rest = [sha256(x) for x in left], b"".join(a + b for a, b in zip(left, right, strict=True))
    proofs, folds = [], []
    for i, d in enumerate(shown):
        proof = sha256()
        for k, level in enumerate(levels):
            slot = i >> 4 * k
            proof.update(level.left[slot])
            proof.update(level.right[slot])
            d = level.resume(slot, d)
        proof.update(rest)
        for state, siblings in zip(outer, right, strict=True):
            h = state.copy()
            h.update(d + siblings)
            d = h.hexdigest().encode()
        proofs.append(proof.hexdigest())
        folds.append(d.decode())
    same = [pa.array([above.column(c)[0].as_py()] * len(shown), pa.string()) for c in ("subroot", "root")]
    return pa.table([rows.column("r"), *same, pa.array(proofs), pa.array(folds)], schema=_FOLDED)


# --- the forest ------------------------------------------------------------------------------------

def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add pos (0, 1, ... in ``order`` inside each tree ``t``) and n (rows of the tree).

    Rows are range-partitioned and sorted by (t, order), written with an ascending number, and
    every tree's places start anew: counts of (partition, tree) give what lies before. No task holds a tree.
    """
    keys = ["t", *order]
    placed = materialise(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("m", F.monotonically_increasing_id()), "numbered").withColumn("part", F.shiftright("m", 33))
    w = Window.partitionBy("t")
    parts = (placed.groupBy("t", "part").agg(F.min("m").alias("first"), F.count(F.lit(1)).alias("c"))
             .select("t", "part", "first", (F.sum("c").over(w.orderBy("part")) - F.col("c")).alias("before"), F.sum("c").over(w).alias("n")))
    return placed.join(parts, ["t", "part"]).withColumn("pos", F.col("before") + F.col("m") - F.col("first")).drop("m", "part", "first", "before")


def _group() -> list[Column]:
    return [F.col("t"), F.shiftright("pos", _SHIFT).alias("g")]


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """The given nodes (t, pos, n, d), then each tier of nodes above them until every tree is one node."""
    out = [nodes]
    while True:
        up = materialise(out[-1].select("t", "pos", "n", "d").groupBy(*_group())
                         .applyInArrow(_tops, "t string, pos long, n long, d string"), "tier")
        out.append(up)
        if (up.agg(F.max("n")).first()[0] or 0) <= 1:
            return out


def _ways_up(tiers: list[DataFrame]) -> DataFrame:
    """(t, pos, left, right): siblings on the way from every node of the lowest tier to the top of its tree."""
    none = F.array().cast("array<string>")
    way = tiers[-1].select("t", "pos", none.alias("left"), none.alias("right"))
    for nodes in tiers[-2::-1]:
        inner = nodes.select("t", "pos", "n", "d").groupBy(*_group()).applyInArrow(
            _ways, "t string, pos long, left array<string>, right array<string>").withColumn("g", F.shiftright("pos", _SHIFT))
        outer = way.select("t", F.col("pos").alias("g"), F.col("left").alias("l"), F.col("right").alias("r"))
        way = inner.join(outer, ["t", "g"]).select("t", "pos", F.concat("left", "l").alias("left"), F.concat("right", "r").alias("right"))
    return way


def manifest(leaves: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Trees over numbered leaves (t, pos, n, d): one row per source, and the tiers of nodes.

    The rows hold t, subroot, root and the siblings (left, right) on the subroot's way to the root.
    """
    tiers = _tiers(leaves)
    tops = materialise(_numbered(tiers[-1].select(F.lit("").alias("t"), F.col("t").alias("of"), "d"), ["of"]), "subroots")
    forest = _tiers(tops)
    root = forest[-1].select("t", F.col("d").alias("root"))
    rows = tops.join(_ways_up(forest), ["t", "pos"]).join(root, "t").select(
        F.col("of").alias("t"), F.col("d").alias("subroot"), "root", "left", "right")
    return materialise(rows, "subroots"), tiers


def verify_rows(docs: DataFrame, source: Column, key: Column, leaf: Column, presented: Column,
                carry: list[str] | None = None) -> DataFrame:
    """Build the manifest of ``docs`` and check every row's presented leaf against its root.

    ``leaf`` is the digest of a row as it was when the manifest was built,
    ``presented`` that of the row as it is met now (both lowercase hex, not null).
    Leaves of one source ascend by ``key`` (null first; rows with one key by their leaf); while more than
    one node remains, every 16 consecutive ones (the last run may hold fewer) become the digest of
    their digests. What remains is the source's subroot; the subroots, ordered by source (null first, then
    bytewise), become the root likewise.

    Returns the columns named in ``carry`` (all, if None) and leaf, subroot, root, proof_sha256 (digest of all
    siblings, level by level, left to right), folded_root (the root that the presented leaf gives with the
    original siblings) and verified (whether that is the root). A column of ``docs`` with one of these names is
    replaced. Null keys and sources are values like any other, repeated rows are leaves
    of their own, a lone leaf is the root, and an empty table gives an empty one.

    Parents keep a copy of their hash state before each child, so a fold hashes only the
    new digest and the siblings right of it. Rows are dealt to groups of 4,096 consecutive leaves and each tier of nodes above
    likewise; a group gets the siblings above it once, not once a row.
    """
    cols = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    rows = materialise(docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)], key_of(source).alias("t"), key.alias("key"),
        leaf.alias("d"), presented.alias("shown"), F.monotonically_increasing_id().alias("r")), "leaves")
    leaves = materialise(_numbered(rows.select("t", "key", "d", "r", "shown"), ["key", "d", "r"]), "leaves")
    subroots, tiers = manifest(leaves)
    ends = subroots.select("t", "subroot", "root", F.col("left").alias("l"), F.col("right").alias("r"))
    above = _ways_up(tiers[1:]).join(ends, "t").select(
        "t", F.col("pos").alias("g"), "subroot", "root", F.concat("left", "l").alias("left"), F.concat("right", "r").alias("right"))
    proved = leaves.select("t", "pos", "n", "d", "shown", "r").groupBy(*_group()).cogroup(above.groupBy("t", "g")).applyInArrow(
        _folded, "r long, subroot string, root string, proof string, folded string")
    return rows.join(proved, "r").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)], F.col("d").alias("leaf"), "subroot", "root",
        F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
