"""Pairs of rooms of whole homes, whatever their number, and of rooms that come with several types or without an id."""

import random

import pytest
from pyspark.sql import functions as F

from innsight.operators import resolve as R
from innsight.plans.registry import ORACLES, QUERIES, load_all


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    rng = random.Random(2)
    names, at = ["cold ring", "old ring", "blue bolt", "hot bolt"], str(tmp_path_factory.mktemp("parts"))
    rows = [(i, rng.choice(names), f"Brand#{i % 2 + 1}", rng.choice(["LARGE", "SMALL"]), rng.randrange(1, 50), 900.0) for i in range(120)]
    df = spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    df.write.parquet(f"{at}/part.parquet")
    return at


def test_all_rooms_of_a_brand_are_compared(spark, parts):
    import duckdb

    load_all()
    got = sorted(map(tuple, QUERIES["room_candidates"](spark, parts).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{parts}/part.parquet/*.parquet'")
    assert got == sorted(map(tuple, con.execute(ORACLES["room_candidates"]).fetchall()))
    assert any(abs(r[2] - r[4]) > 24 for r in got)  # rooms whose keys lie far apart meet too


@pytest.mark.parametrize("mode", ["reference", "merge_equal"])
@pytest.mark.parametrize("size", [3, 256])
def test_pairs_are_those_of_all_pairs_once(spark, monkeypatch, mode, size):
    monkeypatch.setattr(R, "LIST", size)
    rng = random.Random(size)
    types = ["Deluxe Room", "deluxe room", "Phòng Deluxe", "Suite", "suite king", "Bungalow", "a", "", "room", "Family Room", "family room 2", None]
    rows = [(rng.choice(["h1", "h2", None]), rng.choice([1, 2, 3, None]), rng.choice([i, i, i, i % 9, None]), i, rng.choice(types)) for i in range(220)]
    rows += [r for r in rows if rng.random() < 0.2]
    df = spark.createDataFrame(rows, "home string, source int, id bigint, seq bigint, roomtype string")
    got = [tuple(r) for r in R.room_candidates(df, mode=mode).collect()]
    keys = {t: k for t, k in df.select("roomtype", R.shorten_room_type(F.col("roomtype"))).distinct().collect()}
    want = set()
    for h1, s1, i1, _, t1 in rows:
        for h2, s2, i2, _, t2 in rows:
            if None in (h1, s1, s2, t1, t2) or h1 != h2 or s1 >= s2:
                continue
            same = keys[t1] == keys[t2] and (mode == "reference" or keys[t1] != "")
            if same or t1.lower() in t2.lower() or t2.lower() in t1.lower():
                want.add((h1, s1, i1, s2, i2))
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500
