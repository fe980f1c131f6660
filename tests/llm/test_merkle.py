"""Merkle manifest: digests, proofs and folds against a plain tree."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from innsight.llm.merkle import _grown, _Level, encoded, leaf_digest, verify_rows


def digest(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def tree(nodes):
    """All layers of a tree."""
    layers = [nodes]
    while len(layers[-1]) > 1:
        layers.append([digest(*layers[-1][i:i + 16]) for i in range(0, len(layers[-1]), 16)])
    return layers


def climb(layers, i, d):
    """Siblings and the top that digest ``d`` in place ``i`` folds to."""
    siblings = ""
    for layer in layers[:-1]:
        lo = i // 16 * 16
        run = layer[lo:lo + 16]
        siblings += "".join(run[:i - lo] + run[i - lo + 1:])
        run[i - lo] = d
        d, i = digest(*run), i // 16
    return siblings, d


def plain(rows):
    """rows (key, source, leaf, shown) -> set of (key, leaf, subroot, root, proof, folded, verified)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[s] = tree([r[2] for r in by[s]])
    top = tree([trees[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for at, s in enumerate(order):
        for i, (key, _, leaf, shown) in enumerate(by[s]):
            inner, d = climb(trees[s], i, shown)
            outer, d = climb(top, at, d)
            out.append((key, leaf, trees[s][-1][0], root, digest(inner + outer), d, d == root))
    return out


def check(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "doc_id long, source string, a string, b string").repartition(parts)
    got = verify_rows(df, F.col("source"), F.col("doc_id"), F.col("a"), F.col("b"), ["doc_id"])
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows), key=repr)


def made(rng, sizes, tampered=0.2):
    rows = []
    for s, n in sizes.items():
        for _ in range(n):
            leaf = digest(str(rng.random()))
            rows.append((rng.randrange(-10 ** 9, 10 ** 9), s, leaf, digest("x" + leaf) if rng.random() < tampered else leaf))
    return rows


def test_sources_of_all_depths(spark):
    check(spark, made(random.Random(1), {None: 1, "": 2, "a": 15, "b": 16, "é": 17, "Z": 33, "z": 257, "日": 300}))


def test_a_hot_source_needs_several_tiers(spark):
    check(spark, made(random.Random(2), {"hot": 16 ** 3 * 2 + 1, "even": 16 ** 3, **{f"s{i}": 1 for i in range(40)}}), 7)


def test_one_source_and_repeated_rows(spark):
    leaf = digest("same")
    check(spark, [(1, "a", leaf, leaf)] * 40 + [(1, "a", digest("other"), leaf)] + [(None, "a", leaf, leaf)] * 3)
    check(spark, [(5, None, leaf, digest("tampered"))])


def test_no_rows_and_clashing_columns(spark):
    schema = "doc_id long, source string, t string, key string, leaf string, r int, pos int"
    empty = verify_rows(spark.createDataFrame([], schema), F.col("source"), F.col("doc_id"), F.col("t"), F.col("t"))
    assert empty.count() == 0
    row = (1, "a", digest("t"), "k", "old", 7, 8)
    got = verify_rows(spark.createDataFrame([row], schema), F.col("source"), F.col("doc_id"), F.col("t"), F.col("t"))
    assert got.columns == ["doc_id", "source", "t", "key", "r", "pos", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    r = got.first()
    assert (r["key"], r["r"], r["pos"]) == ("k", 7, 8) and r["leaf"] == r["root"] == r["folded_root"] == digest("t")
    assert r["proof_sha256"] == digest("") and r["verified"]


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4096])
def test_parents_keep_their_states(n):
    nodes = [digest(str(i)).encode() for i in range(n)]
    layers = tree([d.decode() for d in nodes])
    levels = _grown(nodes, n)
    assert [[p.decode() for p in level.parents] for level in levels] == layers[1:]
    level = _Level(nodes)
    for slot in range(0, n, max(1, n // 20)):
        assert level.resume(slot, nodes[slot]) == level.parents[slot // 16]
        assert level.resume(slot, digest("no").encode()) != level.parents[slot // 16]


def test_leaves(spark):
    df = spark.createDataFrame([(1, None, "é"), (None, "", "-")], "a long, b string, c string")
    got = df.select(leaf_digest([F.col("a"), F.col("b"), F.col("c")]).alias("d"), encoded(F.col("c")).alias("e")).collect()
    assert [r["d"] for r in got] == [digest("1:1-2:é"), digest("-0:1:-")] and got[0]["e"] == "2:é"
