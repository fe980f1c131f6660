"""Enrichment pipeline, keyed upsert and completeness gating (batch forms).

Streaming forms are in :mod:`innsight.streaming.streams`; they reuse these.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innsight.functions import text as T
from innsight.operators import reviews as RV


# --- T7 -----------------------------------------------------------------------------------

def enrich_reviews(reviews: DataFrame, key: str, lexicon: DataFrame, topics: list[tuple[int, list[str]]] | DataFrame,
                   topic_labels: DataFrame | None = None, translations: DataFrame | None = None,
                   lemmas: dict[str, str] | DataFrame | None = None, stop_words: list[str] | None = None,
                   text_col: str = "review_content", score_col: str = "review_score",
                   already_numeric: bool = False) -> DataFrame:
    """P1 -> P2 -> J9 -> T1 (T2) -> A7 -> T6 -> T5 as one lazy plan.

    ``topics`` is the fitted topic summary (topic, rank, word) of
    :func:`RV.topic_model`, or lists; ``topic_labels`` is (topic, label), by
    default from :func:`RV.topic_autolabel` over the topics. ``lemmas`` is a
    table (token, lemma) of any size (then lemmas and valences come by one token join), its
    :func:`RV.token_index` with the lexicon, or a small dict. ``key`` must be unique.
    Returns the input columns plus clean_review, neg, neu, pos, compound,
    sentiment and label.
    """
    spark = reviews.sparkSession
    topics = RV.topic_lists(topics)
    if topic_labels is None:
        topic_labels = RV.topic_autolabel(RV.topics_table(spark, topics), RV.keywords_table(spark))
    r = RV.valid_reviews(reviews, text_col)
    r = r.withColumn("score", F.col(score_col).cast("double")) if already_numeric else RV.with_score(r, score_col, "score")
    if translations is not None:
        r = RV.translation_lookup(r, translations, text_col, out="en_review")
    else:
        r = r.withColumn("en_review", F.col(text_col))
    if isinstance(lemmas, DataFrame):
        index = lemmas if "n_valued" in lemmas.columns else RV.token_index(lemmas, lexicon)
        r = r.withColumn("_tokens", T.review_tokens(F.col("en_review"), stop_words))
        r = RV.lemmatise_and_score(r, key, "_tokens", index, "clean_review")
    else:
        r = RV.clean_reviews(r, "en_review", "clean_review", stop_words, lemmas)
        r = RV.polarity_scores(r, key, lexicon)
    r = RV.label_sentiment(r, "score", "sentiment")
    return RV.assign_topics(r, topics, topic_labels, "clean_review", "label")


def fit_and_enrich(reviews: DataFrame, key: str, lexicon: DataFrame, lemmas: DataFrame, keywords: DataFrame | None = None,
                   translations: DataFrame | None = None, text_col: str = "review_content", score_col: str = "review_score",
                   already_numeric: bool = False, k: int = 5, max_iter: int = 10, seed: int = 42) -> DataFrame:
    """T3 -> T4 -> T7: fit topics on the cleaned reviews, label them by keyword groups, enrich with them."""
    spark = reviews.sparkSession
    r = RV.valid_reviews(reviews, text_col)
    r = RV.translation_lookup(r, translations, text_col) if translations is not None else r.withColumn("en_review", F.col(text_col))
    clean = RV.lemmatise(r.select(key, T.review_tokens(F.col("en_review")).alias("_tokens")), key, "_tokens", lemmas)
    summary = RV.topic_lists(RV.topic_model(clean, k=k, max_iter=max_iter, seed=seed))
    table = RV.topics_table(spark, summary)
    labels = RV.topic_autolabel(table, RV.keywords_table(spark) if keywords is None else keywords)
    return enrich_reviews(reviews, key, lexicon, summary, labels, translations, lemmas, None, text_col, score_col, already_numeric)


# --- S5 -------------------------------------------------------------------------------------

def keyed_upsert(base: DataFrame, updates: DataFrame, key: Sequence[str] | str, cols: Sequence[str],
                 order: str | None = None) -> DataFrame:
    """Set ``cols`` from ``updates`` on rows with the same key; insert unmatched keys.

    Matched rows keep their other columns; inserted rows carry NULL in the
    columns ``updates`` does not have. Of several updates of one key the last
    by ``order`` counts (without ``order``, or on ties, the one with the
    greatest values, so the result does not depend on row order). Idempotent:
    applying the same updates twice gives the same table.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(cols)
    rank = F.struct(*([F.col(order)] if order else []), *[F.col(c) for c in cols])
    updates = updates.groupBy(*keys).agg(F.max_by(F.struct(*cols), rank).alias("_r")).select(*keys, "_r.*")
    up = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols]).withColumn("_u_hit", F.lit(True))
    j = base.join(up, keys, "full_outer")
    out = []
    for c in base.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in cols:
            out.append(F.when(F.col("_u_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    extra = [F.col(f"_u_{c}").alias(c) for c in cols if c not in base.columns]
    return j.select(*out, *extra)


# --- S5 over a stored table -----------------------------------------------------------------

#: Folders below a stored table; names with an underscore are no data to readers.
PENDING, APPLIED = "_pending", "_applied"


def _bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _write_buckets(rows: DataFrame, path: str, column: str, keys: list[str], files: int) -> None:
    """Replace a folder by these rows: each bucket in ``files`` files at most, whatever the number of tasks; a success marker ends it."""
    part = F.pmod(F.xxhash64(F.lit("file"), *keys), F.lit(files))
    (rows.repartition(F.col(column), part).write.partitionBy(column).mode("overwrite")
     .option("partitionOverwriteMode", "static").parquet(path))


def store_bucketed(df: DataFrame, path: str, key: Sequence[str] | str, buckets: int = 64, files: int = 1) -> None:
    """Write a table for :func:`upsert_stored`: one folder per bucket of the key's hash.

    The folder column is named ``bucket_<number of buckets>``, so the table itself says how it is cut. Choose as many
    buckets as make one fit for a rewrite (say 1 GB), and ``files`` per bucket as many tasks as shall write one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    column = f"bucket_{buckets}"
    _write_buckets(df.withColumn(column, _bucket(keys, buckets)), path, column, keys, files)


def _bucket_column(df: DataFrame) -> str:
    found = [c for c in df.columns if re.fullmatch(r"bucket_[0-9]+", c)]
    if len(found) != 1:
        raise ValueError("not a table written by store_bucketed")
    return found[0]


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored table, after finishing an update that was cut off."""
    _finish(spark, path)
    df = spark.read.parquet(path)
    return df.drop(_bucket_column(df))


def _finish(spark: SparkSession, path: str) -> None:
    """Move the merged buckets of a pending update into the table, also again after a crash; a pending folder that is not complete is dropped."""
    pending = f"{path}/{PENDING}"
    if _exists(spark, f"{pending}/_SUCCESS"):
        rows = spark.read.parquet(pending)
        column = _bucket_column(rows)
        # the files of a bucket as they are: one task takes over each
        rows.write.partitionBy(column).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    fs, p = _fs(spark, pending)
    fs.delete(p, True)


def upsert_stored(spark: SparkSession, path: str, updates: DataFrame, key: Sequence[str] | str, cols: Sequence[str],
                  order: str | None = None, files: int = 1) -> list[int]:
    """S5 in place: :func:`keyed_upsert` into a stored table, rewriting only buckets that hold a key of ``updates``.

    Only those buckets are read (partition pruning) and joined; files of other buckets are neither read nor written. Returns the buckets touched.
    The table keeps its columns, so ``cols`` must be among them. Merged buckets are first written beside the table and then
    replace theirs: an update that is cut off before that leaves the table as it was, one cut off later is finished by
    the next call or read. One writer at a time. Applying the same updates again changes no row.
    """
    keys, cols = [key] if isinstance(key, str) else list(key), list(cols)
    _finish(spark, path)
    base = spark.read.parquet(path)
    column = _bucket_column(base)
    n = int(column.removeprefix("bucket_"))
    missing = [c for c in [*keys, *cols] if c not in base.columns]
    if missing:
        raise ValueError(f"the table has no column {', '.join(missing)}")
    touched = sorted(r[0] for r in updates.select(_bucket(keys, n)).distinct().collect())  # at most n numbers
    if not touched:
        return touched
    old = base.where(F.col(column).isin(touched))
    merged = keyed_upsert(old.drop(column), updates, keys, cols, order)
    # null keys join nothing and are kept as they are
    _write_buckets(merged.withColumn(column, _bucket(keys, n)), f"{path}/{PENDING}", column, keys, files)
    _finish(spark, path)
    return touched


def last_applied(spark: SparkSession, path: str) -> int:
    """Number of the last batch merged into a stored table; -1 if none was."""
    fs, p = _fs(spark, f"{path}/{APPLIED}")
    return max((int(f.getPath().getName()) for f in fs.listStatus(p)), default=-1) if fs.exists(p) else -1


def log_applied(spark: SparkSession, path: str, batch: int) -> None:
    """Note that all batches up to ``batch`` are merged; the marker before it goes afterwards."""
    before = last_applied(spark, path)
    fs, p = _fs(spark, f"{path}/{APPLIED}/{batch}")
    fs.mkdirs(p)
    if 0 <= before < batch:
        fs, p = _fs(spark, f"{path}/{APPLIED}/{before}")
        fs.delete(p, True)


# --- A2 ----------------------------------------------------------------------------------------

def complete_homes(homes: DataFrame, arrivals: DataFrame, key: Sequence[str] | str,
                   announced: str = "announced") -> DataFrame:
    """A2: a home is released when its counted arrivals equal the announced total.

    homes: key + ``announced`` (NULL = no total announced -> released at once).
    arrivals: key per arrived review. Released once (the reference's extra empty
    page could release twice). Returns key, announced, arrived, released.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cnt = arrivals.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("arrived"))
    j = homes.join(cnt, keys, "left").withColumn("arrived", F.coalesce(F.col("arrived"), F.lit(0).cast("bigint")))
    return j.withColumn("released", F.col(announced).isNull() | (F.col("arrived") == F.col(announced)))
