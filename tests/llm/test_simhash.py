"""SimHash near-duplicates against a comparison of all pairs."""

import random

import numpy as np
import pytest
import xxhash

from innsight.llm import simhash as S
from innsight.llm.common import table
from innsight.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(keyed):
    """(key, fingerprint) rows -> component of each row."""
    fps = sorted({f for _, f in keyed})
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    a = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 2).tolist():
            parent[find(i)] = find(j)
    least = {}
    for k, f in keyed:
        r = find(fps.index(f)) if len(fps) < 50 else find(int(np.searchsorted(a, np.uint64(f))))
        if k is not None and (least.get(r) is None or k < least[r]):
            least[r] = k
    return [least.get(find(int(np.searchsorted(a, np.uint64(f))))) for _, f in keyed]


def test_the_query_is_that_of_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    keyed = [(k, plain_fingerprint(t)) for k, t in docs]
    want = {(k, f"{f:016x}", c) for (k, f), c in zip(keyed, plain_components(keyed), strict=True)}
    got = QUERIES["op13_simhash"](spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {tuple(r) for r in got.collect()} == want and len(want) == len(docs)
    assert len({c for _, _, c in want}) < len(docs)  # the table holds copies


@pytest.mark.parametrize("cell", [4, 40, 1024])
def test_links_of_dense_and_sparse_fingerprints(spark, monkeypatch, cell):
    monkeypatch.setattr(S, "CELL", cell)
    rng = random.Random(cell)
    fps = {rng.getrandbits(64) for _ in range(1500)} | {0, 1, 3, (1 << 64) - 1}
    for f in list(fps)[:150]:  # pairs that differ in 1, 2 and 3 bits
        fps.add(f ^ 1 << rng.randrange(64))
        fps.add(f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
        fps.add(f ^ sum(1 << b for b in rng.sample(range(64), 3)))
    hub = rng.getrandbits(64)  # many fingerprints around one: large cells
    while len(fps) < 2700:
        fps.add(hub ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))))
    hub = rng.getrandbits(64)  # all values of one byte: large cells that only its own bits tell apart
    fps |= {hub ^ b << 8 for b in range(256)}
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long").repartition(4)
    got = {int(np.int64(r["fp"]).astype(np.uint64)): r["root"] for r in S.link_fingerprints(df).collect()}
    want = plain_components([(i, f) for i, f in enumerate(fps)])
    by_root, by_component = {}, {}
    for f, c in zip(fps, want, strict=True):
        by_component.setdefault(c, set()).add(f)
        by_root.setdefault(got.get(f, ("alone", f)), set()).add(f)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_component.values()))


def test_odd_texts_and_tables(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    data = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a B"), (7, "A b"), (8, "É x y"), (9, "é x y"), (10, long),
            (11, long.upper()), (None, long), (12, "a b c d"), (12, "a b c d"), (13, "one two three four"), (None, "alone and unlike any other")]
    rows = [(k, t, "f", k) for k, t in data]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, fp long")
    got = S.near_duplicates(df, "doc_id")
    assert got.columns == ["doc_id", "text", "fp", "fingerprint", "component_id"]
    keyed = [(k, plain_fingerprint(t)) for k, t in data]
    want = sorted(((k, f"{f:016x}", c) for (k, f), c in zip(keyed, plain_components(keyed), strict=True)), key=repr)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()), key=repr) == want
    assert S.near_duplicates(spark.createDataFrame([], df.schema), "doc_id").count() == 0


def test_distances_never_exceed_the_bits():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 64, 200, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    far = np.abs(S.distances(a.view(np.int64)).astype(int) - S.distances(b.view(np.int64)))
    assert far.max() == 1
    assert len(set(S.REFERENCES.tolist())) == 64
