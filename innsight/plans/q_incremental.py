"""Scans, sinks, upsert, completeness and stream queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.operators import incremental as I
from innsight.operators import reviews as RV
from innsight.plans import q_text as QT
from innsight.plans.registry import register
from innsight.session import scratch_path
from innsight.sources import tables as S
from innsight.sources.tables import read_table
from innsight.streaming import streams as ST


# --- S1 / S2 / S3 / S4 -------------------------------------------------------------------------

def _brand_src():
    return F.substring("p_brand", 7, 10).cast("int") % 3 + 1


@register("scan_entity", """
SELECT '1' AS source, p_partkey AS id, p_name AS homename, CAST(p_size AS VARCHAR) AS rating, NULL::VARCHAR AS url
FROM part WHERE CAST(substr(p_brand, 7) AS INTEGER) % 3 + 1 = 1
UNION ALL SELECT '2', p_partkey, p_name, CAST(p_size AS VARCHAR), 'b/' || CAST(p_partkey AS VARCHAR)
FROM part WHERE CAST(substr(p_brand, 7) AS INTEGER) % 3 + 1 = 2
UNION ALL SELECT '3', p_partkey, p_name, NULL::VARCHAR, 't/' || CAST(p_partkey AS VARCHAR)
FROM part WHERE CAST(substr(p_brand, 7) AS INTEGER) % 3 + 1 = 3""")
def q_scan_entity(spark, sf):
    p = read_table(spark, sf, "part")
    s1 = p.where(_brand_src() == 1).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("homename"),
                                             F.col("p_size").cast("string").alias("rating"))
    s2 = p.where(_brand_src() == 2).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("homename"),
                                             F.col("p_size").cast("string").alias("rating"),
                                             F.concat(F.lit("b/"), F.col("p_partkey").cast("string")).alias("url"))
    s3 = p.where(_brand_src() == 3).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("homename"),
                                             F.concat(F.lit("t/"), F.col("p_partkey").cast("string")).alias("url"))
    out = S.scan_entity({"1": s1, "2": s2, "3": s3})
    return out.select("source", "id", "homename", "rating", "url")


@register("read_json_entity", """SELECT 'x' AS source, CAST(p_partkey AS VARCHAR) AS id, p_partkey AS seq, p_name AS homename,
  p_type AS vn, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS rating, NULL::VARCHAR AS address FROM part""")
def q_read_json_entity(spark, sf):
    """S1 from JSON lines with the declared schema: absent fields are NULL."""
    p = read_table(spark, sf, "part")
    path = scratch_path(spark, "homes-json")
    p.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("homename"),
             F.struct(F.lit("e").alias("en"), F.col("p_type").alias("vn")).alias("city"),
             F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).alias("rating")).write.json(path)
    h = S.read_json_entity(spark, path, S.HOME_SCHEMA, "x")
    return h.select("source", "id", "seq", "homename", "city.vn", "rating", "address")


@register("city_dimension", """SELECT n_nationkey AS ord, n_name AS vn, lower(n_name) AS en FROM nation
UNION ALL SELECT (SELECT count(*) FROM nation), n_name, lower(n_name) FROM nation WHERE n_nationkey = 0""")
def q_city_dimension(spark, sf):
    n = read_table(spark, sf, "nation")
    items = n.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("vn"), F.lower("n_name").alias("en"))
    dup = items.where(F.col("k") == 0).withColumn("k", F.lit(10**9))  # the file repeats one city at the end
    cities = items.unionByName(dup)
    # the dimension file is one JSON document; nation is a fixed 25-row table
    doc = cities.agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("k", "vn", "en"))),
                                                    lambda c: F.struct(c["vn"].alias("vn"), c["en"].alias("en"))).alias("cities"))).alias("value"))
    path = scratch_path(spark, "cities")
    doc.coalesce(1).write.mode("overwrite").text(path)
    out = S.city_dimension(spark, path)
    return out.select(F.col("ord").cast("int").alias("ord"), "vn", "en")


def _round_trip(spark, sf, mode_twice):
    d = read_table(spark, sf, "documents").select("doc_id", "lang")
    path = scratch_path(spark, "rows")
    S.replace_table(d, path)
    if mode_twice == "replace":
        S.replace_table(d, path)
    else:
        S.append_rows(d, path)
    return spark.read.parquet(path)


@register("replace_table", "SELECT doc_id, lang FROM documents")
def q_replace_table(spark, sf):
    return _round_trip(spark, sf, "replace")


@register("append_rows", "SELECT doc_id, lang FROM documents UNION ALL SELECT doc_id, lang FROM documents")
def q_append_rows(spark, sf):
    return _round_trip(spark, sf, "append")


# --- S5 -----------------------------------------------------------------------------------------

_UPSERT_SQL = """WITH base AS (SELECT doc_id, lang, NULL::VARCHAR AS sentiment, NULL::VARCHAR AS label FROM documents),
upd AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment,
               CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS label FROM labels
        UNION ALL SELECT doc_id + 1000000000, 'neutral', 'inserted' FROM labels WHERE toxic = 1)
SELECT coalesce(b.doc_id, u.doc_id) AS doc_id, b.lang,
  CASE WHEN u.doc_id IS NOT NULL THEN u.sentiment ELSE b.sentiment END AS sentiment,
  CASE WHEN u.doc_id IS NOT NULL THEN u.label ELSE b.label END AS label
FROM base b FULL OUTER JOIN upd u ON b.doc_id = u.doc_id"""


def _upsert_inputs(spark, sf):
    d = read_table(spark, sf, "documents")
    base = d.select("doc_id", "lang", F.lit(None).cast("string").alias("sentiment"), F.lit(None).cast("string").alias("label"))
    lab = read_table(spark, sf, "labels")
    upd = lab.select("doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("sentiment"),
                     F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("label"))
    ins = lab.where(F.col("toxic") == 1).select((F.col("doc_id") + 1000000000).alias("doc_id"),
                                                 F.lit("neutral").alias("sentiment"), F.lit("inserted").alias("label"))
    return base, upd.unionByName(ins)


@register("keyed_upsert", _UPSERT_SQL)
def q_keyed_upsert(spark, sf):
    base, upd = _upsert_inputs(spark, sf)
    return I.keyed_upsert(base, upd, "doc_id", ["sentiment", "label"]).select("doc_id", "lang", "sentiment", "label")


@register("keyed_upsert_stored", _UPSERT_SQL)
def q_keyed_upsert_stored(spark, sf):
    """S5 into a stored table: the updates come in two parts, each rewriting only the buckets it touches."""
    base, upd = _upsert_inputs(spark, sf)
    path = scratch_path(spark, "stored")
    I.store_bucketed(base, path, "doc_id", 32)
    few = F.pmod(F.xxhash64("doc_id"), F.lit(32)) < 4
    for part in (upd.where(few), upd.where(~few)):
        I.upsert_stored(spark, path, part, "doc_id", ["sentiment", "label"])
    return I.read_stored(spark, path).select("doc_id", "lang", "sentiment", "label")


# --- A2 / R1 ------------------------------------------------------------------------------------------

_HOMES_SQL = """h AS (SELECT conv_id, CASE WHEN conv_id % 10 = 0 THEN NULL ELSE max(turn) + 1 END AS announced
       FROM conversations GROUP BY conv_id),
arr AS (SELECT conv_id, count(*) AS arrived FROM conversations WHERE role <> 'system' GROUP BY conv_id)"""


@register("complete_homes", "WITH " + _HOMES_SQL + """
SELECT h.conv_id, h.announced, coalesce(arr.arrived, 0) AS arrived,
       h.announced IS NULL OR coalesce(arr.arrived, 0) = h.announced AS released
FROM h LEFT JOIN arr USING (conv_id)""")
def q_complete_homes(spark, sf):
    c = read_table(spark, sf, "conversations")
    homes = c.groupBy("conv_id").agg(F.when(F.col("conv_id") % 10 == 0, F.lit(None)).otherwise(F.max("turn") + 1)
                                     .cast("bigint").alias("announced"))
    arrivals = c.where(F.col("role") != "system").select("conv_id")
    return I.complete_homes(homes, arrivals, "conv_id").select("conv_id", "announced", "arrived", "released")


PAGE_SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("announced", T.LongType()),
                            T.StructField("page", T.LongType()), T.StructField("n_reviews", T.LongType())])


_RELEASED_SQL = "WITH " + _HOMES_SQL + """
SELECT h.conv_id, h.announced, CASE WHEN h.announced IS NOT NULL THEN coalesce(arr.arrived, 0) END AS arrived
FROM h LEFT JOIN arr USING (conv_id) WHERE h.announced IS NULL OR coalesce(arr.arrived, 0) = h.announced"""


def _review_pages(spark, sf):
    """Review pages (two turns a page) of all homes as files in arrival order: later pages first, spread over four
    files, then the empty last page of every home (P4) in a fifth. A tenth of the homes announces no total."""
    c = read_table(spark, sf, "conversations")
    total = F.when(F.col("conv_id") % 10 == 0, F.lit(None)).otherwise(F.max("turn") + 1).cast("bigint")
    ann = c.groupBy("conv_id").agg(total.alias("announced"), F.max("turn").alias("last"))
    pages = (c.withColumn("page", F.floor(F.col("turn") / 2).cast("bigint"))
             .groupBy("conv_id", "page").agg(F.count(F.when(F.col("role") != "system", 1)).cast("bigint").alias("n_reviews")))
    pages = pages.join(ann, "conv_id").select("conv_id", "announced", "page", "n_reviews")
    empty = ann.select("conv_id", "announced", (F.floor(F.col("last") / 2) + 1).cast("bigint").alias("page"), F.lit(0).cast("bigint").alias("n_reviews"))
    src = scratch_path(spark, "review-pages")
    pages.repartition(4, (F.col("page") * 7 + F.col("conv_id")) % 4).write.mode("overwrite").parquet(src)
    empty.coalesce(1).write.mode("append").parquet(src)
    return src


@register("stream_complete_homes", _RELEASED_SQL)
def q_stream_complete_homes(spark, sf):
    """Every home is released once, those without a total too, also with an empty page after the release."""
    return ST.stream_complete_homes(spark, _review_pages(spark, sf), PAGE_SCHEMA, key="conv_id", max_files=1)


@register("stream_complete_homes_expiring", _RELEASED_SQL)
def q_stream_complete_homes_expiring(spark, sf):
    """R1 with bounded state (per-home state removed on release, expired when idle)."""
    return ST.stream_complete_homes_expiring(spark, _review_pages(spark, sf), PAGE_SCHEMA, key="conv_id", max_files=1)


# --- R2 ----------------------------------------------------------------------------------------------

REVIEW_FILE_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("review_content", T.StringType()),
                                   T.StructField("score", T.DoubleType())])


_R2_SQL = QT._with(QT.ENRICH_CLEAN_CTE, QT.LEX_CTE, QT.POL_CTE, QT.TOPIC_LABEL_CTE) + f"""
, res AS (SELECT s.doc_id, {QT.LABEL_SQL} AS sentiment, coalesce(l.label, 'Unknown') AS label
  FROM (SELECT *, {QT._argmax_sql('clean_review', QT.TEST_TOPICS)} AS topic FROM scores) s
  LEFT JOIN labels l ON l.topic = s.topic)
SELECT d.doc_id, d.lang, res.sentiment, res.label FROM documents d LEFT JOIN res USING (doc_id)"""


def _review_files(d):
    k = F.col("doc_id")
    content = (F.when(k % 7 == 0, F.lit(QT.T.NO_COMMENT_PLACEHOLDER)).when(k % 11 == 0, F.lit(None).cast("string"))
               .otherwise(F.col("text")))
    score = (F.when(k % 17 == 0, F.lit(None).cast("double")).when(k % 19 == 0, F.lit(float("nan")))
             .otherwise((k % 101) / F.lit(10.0)))
    return d.select("doc_id", content.alias("review_content"), score.alias("score"))


def _r2_inputs(spark, d):
    base = d.select("doc_id", "lang", F.lit(None).cast("string").alias("sentiment"), F.lit(None).cast("string").alias("label"))
    labels = RV.topic_autolabel(RV.topics_table(spark, QT.TEST_TOPICS), RV.keywords_table(spark))
    kwargs = dict(lexicon=QT.lexicon_df(spark), topics=RV.topics_table(spark, QT.TEST_TOPICS), topic_labels=labels,
                  translations=d.where(F.col("lang") == "de").select("text", F.upper("text").alias("en")),
                  lemmas=QT.lemmas_df(spark), score_col="score", already_numeric=True)
    return base, kwargs


@register("stream_enrich_reviews", _R2_SQL)
def q_stream_enrich_reviews(spark, sf):
    """R2: documents arrive as review files; enriched rows are upserted into the base table."""
    d = read_table(spark, sf, "documents")
    src = scratch_path(spark, "review-files")
    _review_files(d).repartition(4, "doc_id").write.mode("overwrite").parquet(src)
    base, kwargs = _r2_inputs(spark, d)
    out = ST.stream_enrich_reviews(spark, src, REVIEW_FILE_SCHEMA, base, "doc_id", kwargs, max_files=1)
    return out.select("doc_id", "lang", "sentiment", "label")


@register("stream_enrich_stored", _R2_SQL)
def q_stream_enrich_stored(spark, sf):
    """R2 into a stored table: files arrive before two calls, and the second merges only what the first has not."""
    d = read_table(spark, sf, "documents")
    base, kwargs = _r2_inputs(spark, d)
    src, path, out, ckpt = (scratch_path(spark, n) for n in ("review-files", "stored", "enriched", "enriched-ckpt"))
    I.store_bucketed(base, path, "doc_id", 16)
    early = F.xxhash64("doc_id") % 3 == 0
    for part in (early, ~early):
        _review_files(d).where(part).write.mode("append").parquet(src)
        ST.stream_enrich_stored(spark, src, REVIEW_FILE_SCHEMA, path, "doc_id", kwargs, out_dir=out, checkpoint_dir=ckpt)
    return I.read_stored(spark, path).select("doc_id", "lang", "sentiment", "label")
