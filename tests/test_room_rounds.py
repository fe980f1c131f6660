"""Rooms matched in rounds over tables are those of the fold and of the recursive SQL."""

import random
import time

import pytest
from pyspark.sql import functions as F

from innsight.operators import resolve as R
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "home string, source int, id string, seq long, roomtype string, facilities array<string>, photos array<string>, availables array<struct<occupancy:int,price:string>>"


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", ["greedy_room_match", "greedy_room_match_merge_equal"])
def test_rounds_match_the_recursive_sql(spark, monkeypatch, name):
    monkeypatch.setattr(R, "LARGE_GROUP", 0)
    monkeypatch.setattr(R, "ROUND", 5)
    assert compare(spark, duck(SF), name, SF)["status"] == "ok"


@pytest.mark.parametrize("mode", ["reference", "merge_equal"])
@pytest.mark.parametrize("round_size", [9, 1000])
def test_rounds_match_the_fold(spark, monkeypatch, mode, round_size):
    rng = random.Random(round_size)
    words = ["Sea", "sea", "Deluxe Double Room", "family room", "attic", "a", "", "Queen Room", "view", "loft"]
    data = []
    for home in ("h1", "h2"):
        for i in range(30):
            text = " ".join(rng.choices(words, k=rng.randrange(1, 3)))
            seq = None if rng.random() < 0.1 else rng.randrange(12)
            data.append((home, rng.randrange(1, 4), f"r{i}", seq, text, [str(i)] * rng.randrange(3), [f"p{i}"], [(i, "1")]))
    df = spark.createDataFrame(data, SCHEMA)
    want = rows(R.matched_rooms(df, mode=mode))
    monkeypatch.setattr(R, "LARGE_GROUP", 3)  # large and small groups together
    monkeypatch.setattr(R, "ROUND", round_size)
    assert rows(R.matched_rooms(df, mode=mode)) == want and len(want) > 10


def test_a_home_with_very_many_types_without_a_keyword(spark):
    n = 4000
    one = spark.range(n).select(F.lit("hot").alias("home"), F.col("id").alias("seq"))
    data = None
    for source in (1, 2, 3):
        part = one.select("home", F.lit(source).alias("source"), F.concat(F.lit(f"{source}-"), "seq").alias("id"), "seq",
                          F.concat(F.lit("zq"), F.lpad(F.hex(F.xxhash64(F.lit(source), "seq")), 16, "0")).alias("roomtype"),
                          F.array().cast("array<string>").alias("facilities"), F.array().cast("array<string>").alias("photos"),
                          F.lit(None).cast("array<struct<occupancy:int,price:string>>").alias("availables"))
        data = part if data is None else data.unionByName(part)
    t = time.time()
    got = R.matched_rooms(data).select("anchor_seq", "id_1", "id_2", "id_3").collect()
    assert len(got) == n and all(tuple(r)[1:] == (f"1-{r[0]}", f"2-{r[0]}", f"3-{r[0]}") for r in got)
    assert time.time() - t < 240
