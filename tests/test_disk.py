"""Steps give their disk back: scratch tables and shuffle files do not add up over a query."""

import os
import random
import time

import pytest

from innsight.operators import resolve as R
from innsight.plans.registry import QUERIES, load_all
from innsight.session import freed, scratch_path, written

SF = "/root/testdata/sf0.001"
ROOMS = "home string, source int, id string, seq long, roomtype string, facilities array<string>, photos array<string>"


def stored(spark):
    """Names of the scratch tables that are there."""
    base = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    return {t for t in (os.listdir(base) if os.path.isdir(base) else [])}


def test_a_step_drops_its_tables_but_those_it_keeps(spark):
    before = stored(spark)
    with freed(spark):
        with freed(spark) as keep:
            written(spark.range(3), "inner")
            kept = keep(written(spark.range(5), "kept"))
        assert [t.rsplit("-", 1)[0] for t in stored(spark) - before] == ["kept"] and kept.count() == 5
    assert stored(spark) == before
    with pytest.raises(ValueError), freed(spark):
        written(spark.range(3), "failed")
        raise ValueError
    assert stored(spark) == before
    with freed(spark) as keep:
        out = keep(written(spark.range(7), "out"))
    assert out.count() == 7


def test_shuffle_files_of_steps_do_not_add_up(spark):
    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    at = kept.size()
    for i in range(8):
        with freed(spark):
            written(spark.range(1000).repartition(4).groupBy("id").count(), f"step{i}")
    end = time.time() + 20
    while kept.size() > at + 2 and time.time() < end:  # Spark's cleaner works beside the driver; the last step may still be held
        time.sleep(0.2)
    assert kept.size() <= at + 2


def test_documents_leave_their_two_tables_only(spark):
    load_all()
    before = stored(spark)
    out = QUERIES["combined_documents"](spark, SF)
    assert {t.rsplit("-", 1)[0] for t in stored(spark) - before} == {"combined_documents"}
    assert out.count() > 0


@pytest.mark.parametrize("mode", ["reference", "merge_equal"])
def test_small_homes_are_folded_without_a_search_for_groups(spark, monkeypatch, mode):
    rng = random.Random(5)
    words = ["Sea", "sea", "Deluxe Double Room", "family room", "attic", "a", "", "Queen Room", "view", "loft"]
    data = [(rng.choice([f"h{i % 12}", None]) if i % 9 == 0 else f"h{i % 12}", rng.randrange(1, 4), f"r{i}", None if i % 11 == 0 else rng.randrange(12),
             None if i % 13 == 0 else " ".join(rng.choices(words, k=rng.randrange(1, 3))), [str(i)] * rng.randrange(3), [f"p{i}"]) for i in range(180)]
    data.append(("h0", 7, "other source", 1, "Sea", [], []))
    df = spark.createDataFrame({d[:2] + d[3:5]: d for d in data}.values(), ROOMS)  # no ties of the stored order

    def rows():
        return sorted(map(repr, R.matched_rooms(df, mode=mode).collect()))

    searched, plain = [], R._type_groups
    monkeypatch.setattr(R, "_type_groups", lambda *a: searched.append(1) or plain(*a))
    got = rows()
    assert not searched and len(got) > 20
    for most in (0, 8):  # all homes by groups; some of them
        monkeypatch.setattr(R, "SMALL_HOME", most)
        assert rows() == got
    assert len(searched) == 2
