"""Work that is heavy by row does not stay in the few tasks of a small file."""

from pyspark.sql import functions as F

from innsight.plans.registry import QUERIES, load_all
from innsight.session import spread

SF = "/root/testdata/sf0.01"


def test_a_file_of_one_row_group_is_dealt_to_all_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1_000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert df.rdd.getNumPartitions() == 1
    dealt = spread(df)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sorted(sizes) == [250] * 4
    assert sorted(r["id"] for r in dealt.collect()) == list(range(1_000))
    assert spread(dealt).rdd.getNumPartitions() == 4


def test_pages_are_scanned_by_all_tasks(spark):
    load_all()
    for name in ("property_page", "room_text_extract", "decode_entities"):
        assert QUERIES[name](spark, SF).rdd.getNumPartitions() == 4, name


def test_texts_are_cleaned_by_all_tasks(spark):
    from innsight.plans.q_text import cleaned

    assert cleaned(spark, SF).rdd.getNumPartitions() == 4


def test_names_are_dealt_before_they_are_cut_into_grams(spark):
    load_all()
    files = QUERIES["fallback_match"](spark, SF).inputFiles()
    assert len([f for f in files if "/names-" in f]) >= 4


def test_passes_are_stored_tables(spark, monkeypatch):
    from innsight.operators import resolve as R
    from innsight.plans.bindings import homes_from_part

    names, plain = [], R.written
    monkeypatch.setattr(R, "written", lambda df, name: names.append(name) or plain(df, name))
    R.resolve_passes(homes_from_part(spark, SF, block=60))
    assert names.count("pass") == names.count("pass-matches") == 3 and {"first-homes", "matches"} <= set(names)


def test_rooms_are_not_sent_through_the_driver(spark):
    load_all()
    for name, joins in (("type_candidates", 6), ("room_candidates", 8)):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= joins, name
