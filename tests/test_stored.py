"""Updates of stored tables: only touched buckets change, cut-off updates are finished, batches are merged once."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.operators import incremental as I
from innsight.streaming import streams as ST


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def stored(spark, tmp_path):
    base = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.lit("other").alias("o"))
    base = base.unionByName(spark.createDataFrame([(None, "null key", "o"), (7, "second row of a key", "o")], "k long, v string, o string"))
    path = str(tmp_path / "table")
    I.store_bucketed(base, path, "k", 32)
    return base, path


def in_buckets(n, at):
    return F.pmod(F.xxhash64("k"), F.lit(n)).isin(at)


def test_only_touched_buckets_change(spark, stored):
    base, path = stored
    before = files(path)
    up = spark.range(6000).select(F.col("id").alias("k"), F.lit("new").alias("v"), (F.col("id") % 3).alias("t")).where(in_buckets(32, [3, 17]))
    up = up.unionByName(up.withColumn("v", F.lit("newer")).withColumn("t", F.col("t") + 5).where("k % 2 = 0"))
    assert I.upsert_stored(spark, path, up, "k", ["v"], order="t") == [3, 17]
    after = files(path)
    kept = {f: t for f, t in before.items() if "bucket_32=3/" not in f and "bucket_32=17/" not in f}
    assert len(kept) == 30 and kept.items() <= after.items()
    assert not set(after) & (set(before) - set(kept))
    assert rows(I.read_stored(spark, path)) == rows(I.keyed_upsert(base, up, "k", ["v"], "t"))
    again = rows(I.read_stored(spark, path))
    I.upsert_stored(spark, path, up, "k", ["v"], order="t")
    assert rows(I.read_stored(spark, path)) == again
    assert I.upsert_stored(spark, path, up.where("false"), "k", ["v"]) == []


def test_new_keys_null_keys_and_missing_columns(spark, stored):
    base, path = stored
    up = spark.createDataFrame([(None, "x"), (10 ** 12, "new"), (7, "both rows")], "k long, v string")
    I.upsert_stored(spark, path, up, "k", ["v"])
    assert rows(I.read_stored(spark, path)) == rows(I.keyed_upsert(base, up, "k", ["v"]))
    with pytest.raises(ValueError):
        I.upsert_stored(spark, path, up.withColumn("w", F.lit(1)), "k", ["w"])
    spark.range(3).write.parquet(path + "-plain")
    with pytest.raises(ValueError):
        I.read_stored(spark, path + "-plain")


@pytest.mark.parametrize("complete", [True, False])
def test_an_update_cut_off_is_finished_or_dropped(spark, stored, monkeypatch, complete):
    base, path = stored
    up = spark.createDataFrame([(i, "new") for i in range(50)], "k long, v string")
    monkeypatch.setattr(I, "_finish", lambda *a: None)
    I.upsert_stored(spark, path, up, "k", ["v"])  # writes the merged buckets, then is cut off
    monkeypatch.undo()
    if complete:  # cut off while buckets were moved: one is already gone
        shutil.rmtree(next(os.path.join(path, d) for d in os.listdir(path + "/_pending") if d.startswith("bucket")))
    else:  # cut off while they were written
        os.remove(path + "/_pending/_SUCCESS")
    want = I.keyed_upsert(base, up, "k", ["v"]) if complete else base
    assert rows(I.read_stored(spark, path)) == rows(want)
    assert not os.path.exists(path + "/_pending")
    assert rows(I.read_stored(spark, path)) == rows(want)


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("review_content", T.StringType()), T.StructField("score", T.DoubleType())])


def enrich_args(spark):
    return dict(lexicon=spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double"),
                topics=[(0, ["good"])], score_col="score", already_numeric=True)


def test_a_call_merges_new_batches_only(spark, tmp_path, monkeypatch):
    base = spark.range(40).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("sentiment"), F.lit(None).cast("string").alias("label"))
    path, src, out, ckpt = (str(tmp_path / n) for n in ("table", "src", "out", "ckpt"))
    I.store_bucketed(base, path, "k", 8)

    def arrive(ids, score):
        spark.createDataFrame([(i, "good room", float(score)) for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(src)

    def call():
        return ST.stream_enrich_stored(spark, src, SCHEMA, path, "k", enrich_args(spark), max_files=1, out_dir=out, checkpoint_dir=ckpt)

    arrive(range(10), 9)
    assert call() == [0] and call() == [] and I.last_applied(spark, path) == 0
    shutil.rmtree(out + "/batch=0")  # the second call does not read it any more
    arrive(range(5, 15), 1)
    arrive(range(100, 103), 9)
    monkeypatch.setattr(I, "log_applied", lambda *a: None)
    assert call() == [1, 2]  # cut off before the log
    monkeypatch.undo()
    cut = rows(I.read_stored(spark, path))
    assert call() == [1, 2] and I.last_applied(spark, path) == 2 and rows(I.read_stored(spark, path)) == cut
    got = {r["k"]: r["sentiment"] for r in I.read_stored(spark, path).collect()}
    assert {got[i] for i in range(5)} == {"positive"} and {got[i] for i in range(5, 15)} == {"negative"}
    assert {got[i] for i in range(15, 40)} == {None} and len(got) == 43
