"""Names found by grams of adaptive length."""

import random

import pytest
from pyspark.sql import functions as F

from innsight.operators import resolve as R


def tables(spark, n, seed, alphabet="ab", length=(18, 40)):
    rng = random.Random(seed)
    names = sorted({"".join(rng.choices(alphabet, k=rng.randrange(*length))) for _ in range(n)})
    needles = {"".join(rng.choices(alphabet, k=rng.randrange(3, 30))) for _ in range(200)}
    needles |= {(lambda s, a, b: s[a:a + b])(rng.choice(names), rng.randrange(10), rng.randrange(3, 25)) for _ in range(200)}
    needles = sorted(x for x in needles if len(x) >= 3)
    texts = spark.createDataFrame([("c", i % 3, t) for i, t in enumerate(names)], "city string, source int, _lname string")
    return names, needles, texts, spark.createDataFrame([("c", x) for x in needles], "city string, _needle string")


def test_names_that_share_all_their_3_grams(spark):
    names, needles, texts, wanted = tables(spark, 10_000, 1)
    assert all(len({t[i:i + 3] for i in range(len(t) - 2)}) >= 4 for t in names[:500])
    met = {}
    for chosen, grams in R._gram_levels(wanted, texts, ["city"], ["source"]):
        for r in chosen.where("not _whole").join(grams, ["city", "source", "_gram"]).groupBy("_needle", "source").count().collect():
            met[r["_needle"], r["source"]] = r["count"]
    assert met and max(met.values()) <= R.COMMON_GRAM and sum(met.values()) < 30 * len(met)


@pytest.mark.parametrize("common", [2, 64])
def test_containment_is_that_of_all_pairs(spark, monkeypatch, common):
    monkeypatch.setattr(R, "COMMON_GRAM", common)
    names, needles, texts, wanted = tables(spark, 1200, 2)
    cand = texts.select("city", "source", F.col("_lname").alias("homename"), F.concat(F.lit("i"), F.col("_lname")).alias("id"))
    anchors = wanted.select(F.lit(9).alias("anchor_source"), F.col("_needle").alias("anchor_id"), "city", F.col("_needle").alias("needle"))
    got = {(r["anchor_id"], r["source"], r["match_name"]) for r in R.containment_match(anchors, cand).collect()}
    want = set()
    for x in needles:
        for s in range(3):
            held = [t for i, t in enumerate(names) if i % 3 == s and x in t]
            if held:
                want.add((x, s, min(held)))
    assert got == want and len(want) > 300


def test_types_inside_types(spark, monkeypatch):
    monkeypatch.setattr(R, "COMMON_GRAM", 3)
    names, _, _, _ = tables(spark, 150, 3, length=(1, 14))
    names += ["", "ab cd", "d", "ü", "xü y"]
    got = R._contained(spark.createDataFrame([(1, t) for t in names] * 2, "home int, low string"), "home", "low").collect()
    assert sorted((r["x"], r["y"]) for r in got) == sorted((x, y) for x in set(names) for y in set(names) if x != y and x in y)
