"""Importance resampling and its radix sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from innsight.llm import radix
from innsight.llm.resample import features, gains, resample


@pytest.mark.parametrize("keys, block, digit", [
    (lambda rng: (rng.randrange(50), rng.randrange(1000)), 3, 4),
    (lambda rng: (rng.choice([-(1 << 63), -1, 0, (1 << 63) - 1]), rng.randrange(-5, 5)), 5, 12),
    (lambda rng: (7, 7), 4, 12),
    (lambda rng: (0 if rng.random() < 0.4 else rng.randrange(1 << 40), rng.randrange(3)), 6, 11)])
def test_places_are_those_of_a_sort(spark, monkeypatch, keys, block, digit):
    monkeypatch.setattr(radix, "BLOCK_BITS", block)
    monkeypatch.setattr(radix, "DIGIT_BITS", digit)
    rng = random.Random(4)
    data = [(i, *keys(rng)) for i in range(700)]
    df = spark.createDataFrame(data, "id long, a long, b long").repartition(5)
    placed, n = radix.places(df, "id", ["a", "b"])
    got = {r["id"]: r["place"] for r in placed.collect()}
    assert n == 700 and sorted(got.values()) == list(range(700))
    by_place = [(a, b) for _, a, b in sorted(data, key=lambda r: got[r[0]])]
    assert by_place == sorted((a, b) for _, a, b in data)


def test_places_of_no_rows(spark):
    placed, n = radix.places(spark.createDataFrame([], "id long, a long"), "id", ["a"])
    assert n == 0 and placed.count() == 0 and placed.columns == ["id", "place"]


WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, target, share, least, longest, buckets, seed):
    """rows (key, text) -> (key, n_features, weight, score, rank) by the definition."""
    def grams(text):
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets
                            for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    rows = [(k, *grams(t)) for k, t in docs]
    s = Counter(b for _, _, g in rows for b in g)
    t = Counter(b for x in target for b in grams(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (n_s + buckets) / ((s[b] + 1.0) * (n_t + buckets))))
    out = []
    for k, n, g in rows:
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        w = sum(map(gain, g)) // len(g) if g else 0
        out.append([k, n, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = order[:len(order) * share[0] // share[1]]
    ranks = {id(r): i + 1 for i, r in enumerate(drawn)}
    return [(k, f, w, sc, ranks.get(id(r))) for r in out for k, _, f, w, sc in [r]]


@pytest.mark.parametrize("longest, least, share", [(1, 20, (10, 100)), (2, 3, (1, 3)), (3, 0, (1, 1))])
def test_a_draw_is_that_of_the_definition(spark, longest, least, share):
    rng = random.Random(longest)
    vocabulary = ["Été", "a", "B2", "the", "x-y", "naïve_Word", "日本", "ſ", "İ", "of", "end."] + [f"w{i}" for i in range(40)]
    docs = [(i - 30, " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(150)]
    docs += [(1000, None), (1001, ""), (1002, "?! \n"), (None, "the a " * 30), (5000, "long text " * 50_000)]
    target = ["The A of w1 w2", None, "w3 été " * 20]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = resample(df, spark.createDataFrame([(t,) for t in target], "text string"), "doc_id", share=share, least_words=least,
                   longest=longest, n_buckets=64, carry=["doc_id"])
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(docs, target, share, least, longest, 64, 2024), key=repr)


def test_odd_tables(spark):
    schema = "doc_id long, text string, weight string, t string, in0 int, key int"
    row = (3, "some words here", "x", "y", 1, 2)
    target = spark.createDataFrame([("some",)], "text string")
    got = resample(spark.createDataFrame([row, row, row, (None,) * 6], schema), target, "doc_id", least_words=1, share=(1, 1))
    assert got.columns == ["doc_id", "text", "t", "in0", "key", "n_features", "weight", "score", "rank"]
    rows = got.collect()
    assert sorted(r["rank"] for r in rows if r["text"]) == [1, 2, 3] and len({r["score"] for r in rows if r["text"]}) == 1
    assert [r["rank"] for r in rows if r["text"] is None] == [None]
    assert resample(spark.createDataFrame([], schema), target, "doc_id").count() == 0
    none = spark.createDataFrame([], "text string")
    alone = resample(spark.createDataFrame([row], schema), none, "doc_id", least_words=1, share=(1, 1)).first()
    assert alone["rank"] == 1 and alone["weight"] == math.floor(1000 * math.log(10003 / (2 * 10000)))


def test_the_draw_comes_near_the_target(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choices([f"{'t' if i % 4 == 0 else 'o'}{k}" for k in range(30)], k=40))) for i in range(400)]
    target = spark.createDataFrame([(" ".join(f"t{k}" for k in range(30)),)] * 100, "text string")
    got = resample(spark.createDataFrame(docs, "doc_id long, text string"), target, "doc_id", n_buckets=500)
    drawn = got.where(F.col("rank").isNotNull()).collect()
    assert len(drawn) == 40 and sum(r["doc_id"] % 4 == 0 for r in drawn) >= 30


def test_gains_and_features():
    assert features("A-b ü9 A", 2, 1000)[0] == 4
    assert len(features("A-b ü9 A", 2, 1000)[1]) == 7
    g = gains(np.array([0, 10]), np.array([10, 0]))
    assert g[0] > 0 > g[1]
