"""Review analytics operators (DataFrame -> DataFrame).

Plan notes
----------
* Cleaning, topic counts, argmax and labels are in-row expressions (higher-order
  functions over the token array): no shuffle, whole-stage codegen.
* Table lookups (lexicon, large lemma tables, translations) are equi-joins; the
  exploded rows of one review sit in one input partition, so the per-review
  re-aggregation is collapsed by the partial aggregate before the exchange and
  the shuffle moves one row per review.
* No broadcast is forced: parameter tables made from Python rows are local
  relations, so the planner knows their size; other tables are left to the
  planner and AQE.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from innsight.functions import text as T
from innsight.functions.parse import score_normalise
from innsight.session import written

def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small parameter table as a local relation (its size is known to the planner)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = to_arrow_schema(spark.createDataFrame([], schema).schema)
    cols = list(zip(*rows)) if rows else [[] for _ in shape]
    return spark.createDataFrame(pa.table([pa.array(list(c), f.type) for c, f in zip(cols, shape)], schema=shape))


# --- P1 / P2 -----------------------------------------------------------------

def valid_reviews(df: DataFrame, col: str = "review_content",
                  placeholder: str = T.NO_COMMENT_PLACEHOLDER) -> DataFrame:
    """Drop reviews whose text is NULL or the placeholder text."""
    c = F.col(col)
    return df.filter(c.isNotNull() & (c != F.lit(placeholder)))


def with_score(df: DataFrame, col: str = "review_score", out: str = "score") -> DataFrame:
    """Comma decimal to a double (NULL when not a number)."""
    return df.withColumn(out, score_normalise(F.col(col)))


# --- J9 -----------------------------------------------------------------------

def translation_index(translations: DataFrame) -> DataFrame:
    """translations(text, en) by a 64-bit hash of the text: the form that J9 joins."""
    tr = translations.where(F.col("text").isNotNull()).groupBy("text").agg(F.min("en").alias("en"))
    return tr.groupBy(F.xxhash64("text").alias("_tr_h")).agg(
        F.map_from_entries(F.collect_list(F.struct("text", "en"))).alias("_tr_m"))


def translation_lookup(df: DataFrame, translations: DataFrame, text_col: str = "review_content",
                       out: str = "en_review") -> DataFrame:
    """Left equi-join to translations(text, en), or their index; untranslated text stays as is.

    The join key is a 64-bit hash of the text, not the text; texts with one
    hash sit in one small map, and the text itself is looked up there, so a
    chance collision changes nothing. The least translation of a text counts.
    """
    tr = translations if "_tr_h" in translations.columns else translation_index(translations)
    j = df.withColumn("_tr_k", F.xxhash64(text_col)).join(tr, F.col("_tr_k") == F.col("_tr_h"), "left")
    return j.withColumn(out, F.coalesce(F.try_element_at("_tr_m", F.col(text_col)), F.col(text_col))).drop("_tr_k", "_tr_h", "_tr_m")


# --- T1 / T2 ------------------------------------------------------------------

def clean_reviews(df: DataFrame, text_col: str = "review_content", out: str = "clean_review",
                  stop_words: list[str] | None = None, lemmas: dict[str, str] | None = None) -> DataFrame:
    """T1 with a literal lemma table (in-row, no shuffle)."""
    return df.withColumn(out, T.clean_review(F.col(text_col), stop_words, lemmas))


def lemma_index(lemmas: DataFrame) -> DataFrame:
    """lemmas(token, lemma), one lemma a token (the least): the form that T2 joins."""
    lem = lemmas.where(F.col("token").isNotNull() & F.col("lemma").isNotNull())
    return lem.groupBy(F.col("token").alias("_tok")).agg(F.min("lemma").alias("_lemma"))


def _lookup(df: DataFrame, key: str, tokens_col: str, index: DataFrame, sums: list[str]) -> DataFrame:
    """(_k, _text, sums): the rows' texts rebuilt from what their tokens stand for, and sums of the tokens' entries: one token join.

    ``index``: _tok, _out and the columns ``sums``; a token that it does not have stands for itself. Tokens are exploded once and
    combined by row before the shuffle, so one row per text travels. Parts of one character or none are dropped.
    """
    # the outer form: the plain one would repeat the tokens in an inferred filter
    ex = df.select(F.col(key).alias("_k"), F.posexplode_outer(tokens_col).alias("_pos", "_tok"))
    out = F.coalesce("_out", F.col("_tok"))
    part = F.when(F.length(out) > 1, F.struct("_pos", out.alias("w")))
    g = ex.join(index, "_tok", "left").groupBy("_k").agg(
        F.array_sort(F.collect_list(part)).alias("_parts"),
        *[F.sum(F.when(F.length(out) > 1, F.coalesce(c, F.lit(1 if c == "n_tokens" else 0)))).alias(c) for c in sums])
    return g.select("_k", F.array_join(F.transform("_parts", lambda p: p["w"]), " ").alias("_text"), *sums)


def _looked_up(df: DataFrame, key: str, tokens_col: str, index: DataFrame, out: str, sums: list[str]) -> DataFrame:
    hits = _lookup(df, key, tokens_col, index, sums)
    rest = [c for c in df.columns if c != tokens_col]
    return df.select(*rest).join(hits, F.col(key).eqNullSafe(F.col("_k")), "left").select(*rest, F.coalesce("_text", F.lit("")).alias(out), *sums)


def lemmatise(df: DataFrame, key: str, tokens_col: str, lemmas: DataFrame,
              out: str = "clean_review") -> DataFrame:
    """T2 with a lemma table of any size (token, lemma), or its index.

    ``tokens_col`` is the token array before lemmatisation (``T.review_tokens``);
    ``key`` must be unique per row. One token join; see :func:`_lookup`.
    """
    lem = lemmas if "_lemma" in lemmas.columns else lemma_index(lemmas)
    return _looked_up(df, key, tokens_col, lem.withColumnRenamed("_lemma", "_out"), out, [])


SUMS = ["n_tokens", "s10", "p10", "n10", "n_valued"]


def token_index(lemmas: DataFrame, lexicon: DataFrame) -> DataFrame:
    """One dictionary of tokens for T2 and J8: _tok, _out (the lemma, or the token itself) and the J8 sums of ``_out``.

    Holds every token with a lemma or a valence; a lemma of several words has the sums of its words.
    """
    lem = lemmas if "_lemma" in lemmas.columns else lemma_index(lemmas)
    lex = lexicon if "_v" in lexicon.columns else lexicon_index(lexicon)
    entries = lem.select("_tok", F.col("_lemma").alias("_out")).unionByName(
        lex.join(lem, "_tok", "left_anti").select("_tok", F.col("_tok").alias("_out")))
    scored = lexicon_hits(entries.withColumnRenamed("_tok", "_entry"), "_entry", lex, "_out").withColumnRenamed("_entry", "_tok")
    return entries.join(scored, "_tok").select("_tok", "_out", *SUMS)


def lemmatise_and_score(df: DataFrame, key: str, tokens_col: str, index: DataFrame, out: str = "clean_review") -> DataFrame:
    """T2 and A7 by one token join with :func:`token_index`: the clean text, neg, neu, pos and compound in place of the tokens."""
    j = _looked_up(df, key, tokens_col, index, out, SUMS)
    return j.select(*[c for c in j.columns if c not in SUMS],
                    *_scores(F.col("s10"), F.col("p10"), F.col("n10"), F.col("n_tokens") - F.col("n_valued")))


# --- A5 / A6 ------------------------------------------------------------------

def term_counts(df: DataFrame, key: str, text_col: str = "clean_review") -> DataFrame:
    """(key, term, cnt) document-term counts."""
    ex = df.select(key, F.explode_outer(T.terms(F.col(text_col))).alias("term")).where("term is not null")
    return ex.groupBy(key, "term").agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))


def vocabulary_top_k(df: DataFrame, text_col: str = "clean_review", k: int = 1000) -> DataFrame:
    """A5: the k most frequent corpus terms, ties by term; planned as a partial top-k."""
    ex = df.select(F.explode_outer(T.terms(F.col(text_col))).alias("term")).where("term is not null")
    counts = ex.groupBy("term").agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), F.asc("term")).limit(k)


# --- A7 / J8 / P18 --------------------------------------------------------------

def lexicon_index(lexicon: DataFrame) -> DataFrame:
    """lexicon(token, valence), one valence a token, in tenths: the form that J8 joins."""
    return lexicon.where(F.col("token").isNotNull()).groupBy(F.col("token").alias("_tok")).agg(
        F.coalesce(F.max(F.round(F.col("valence") * 10).cast("bigint")), F.lit(0)).alias("_v"))


def lexicon_hits(df: DataFrame, key: str, lexicon: DataFrame, text_col: str = "clean_review") -> DataFrame:
    """(key, n_tokens, n_known, s10, p10, n10) per row from lexicon(token, valence), or its index.

    Tokens are joined to the lexicon by equality. Valences are read to one
    decimal place and summed as integers (s10: sum, p10: sum of v + 10 over
    v > 0, n10: sum of 10 - v over v < 0), so nothing depends on the order of
    summation. A token listed twice has its largest valence, a NULL valence
    counts as 0, a NULL token is no entry. ``key`` must be unique per row.
    Only (key, token) travel; a row's tokens are summed up before the shuffle.
    """
    lex = lexicon if "_v" in lexicon.columns else lexicon_index(lexicon)
    toks = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), " "), lambda w: F.length(w) > 0)
    ex = df.select(F.col(key), F.explode_outer(toks).alias("_tok"))
    v = F.col("_v")
    return ex.join(lex, "_tok", "left").groupBy(key).agg(
        F.count("_tok").alias("n_tokens"), F.count("_v").alias("n_known"), F.coalesce(F.sum(v), F.lit(0)).alias("s10"),
        F.coalesce(F.sum(F.when(v > 0, v + 10)), F.lit(0)).alias("p10"),
        F.coalesce(F.sum(F.when(v < 0, 10 - v)), F.lit(0)).alias("n10"),
        F.count(F.when(v != 0, 1)).alias("n_valued"))


def polarity_scores(df: DataFrame, key: str, lexicon: DataFrame, text_col: str = "clean_review") -> DataFrame:
    """Neg, neu, pos (3 places) and compound (4 places) per row from a lexicon of any size.

    Unknown tokens are neutral; an empty text scores 0 everywhere. Rounding of
    the ratios is exact half-up on the rational value. One path for every
    lexicon: J8 sums (see :func:`lexicon_hits`), joined back by key.
    """
    hits = lexicon_hits(df, key, lexicon, text_col).withColumnRenamed(key, "_k")
    out = df.join(hits, df[key].eqNullSafe(hits["_k"]), "left")
    return out.select(*[df[c] for c in df.columns],
                      *_scores(F.col("s10"), F.col("p10"), F.col("n10"), F.col("n_tokens") - F.col("n_valued")))


def _scores(s10: Column, p10: Column, n10: Column, u: Column) -> list[Column]:
    s10, p10, n10, u = (F.coalesce(c, F.lit(0)) for c in (s10, p10, n10, u))
    tot10 = p10 + n10 + u * 10

    def ratio(num10: Column) -> Column:
        # round-half-up(num/tot, 3) computed exactly in integers
        milli = F.floor((num10 * 2000 + tot10) / (tot10 * 2))
        return F.when(tot10 > 0, milli / F.lit(1000.0)).otherwise(F.lit(0.0))

    s = s10 / F.lit(10.0)
    compound = F.when(tot10 > 0, F.round(s / F.sqrt(s * s + F.lit(float(T.COMPOUND_ALPHA))), 4)).otherwise(F.lit(0.0))
    return [ratio(n10).alias("neg"), ratio(u * 10).alias("neu"), ratio(p10).alias("pos"), compound.alias("compound")]


def drop_columns_widen(df: DataFrame, struct_col: str) -> DataFrame:
    """A struct column becomes top-level columns."""
    return df.select("*", f"{struct_col}.*").drop(struct_col)


def label_sentiment(df: DataFrame, score_col: str = "score", out: str = "sentiment") -> DataFrame:
    """T6 over the rounded pos/neg columns."""
    return df.withColumn(out, T.sentiment_label(F.col("pos"), F.col("neg"), F.col(score_col)))


# --- T3 / W6 --------------------------------------------------------------------

@dataclass
class TopicFit:
    """A fitted topic model over the A5 vocabulary of a corpus."""

    spark: SparkSession
    vocabulary: list[str]
    model: object
    text_col: str

    def vectors(self, df: DataFrame) -> DataFrame:
        """``df`` and ``_tf``, the counts of the vocabulary's terms; texts without a term have none."""
        from pyspark.ml.feature import CountVectorizerModel

        cv = CountVectorizerModel.from_vocabulary(self.vocabulary, inputCol="_terms", outputCol="_tf")
        return cv.transform(df.withColumn("_terms", T.terms(F.col(self.text_col)))).drop("_terms")

    def summary(self, top_words: int) -> DataFrame:
        """(topic, rank, word, weight): k x top_words rows."""
        words = local_table(self.spark, list(enumerate(self.vocabulary)), "term_index int, word string")
        ex = self.model.describeTopics(top_words).select(
            F.col("topic").cast("int").alias("topic"), F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "tw"))
        ex = ex.select("topic", "rank", F.col("tw.termIndices").alias("term_index"), F.col("tw.termWeights").alias("weight"))
        return ex.join(words, "term_index").select("topic", "rank", "word", "weight")

    def mixtures(self, df: DataFrame, key: str) -> DataFrame:
        """(key, n_terms, mixture array<double>, topic): the share of each topic in each text, and the largest one (first on ties).

        The variational E-step of the model, run where the rows are. A text without a term of the
        vocabulary has a mixture of zeros and no topic.
        """
        from pyspark.ml.functions import vector_to_array

        v = self.model.setTopicDistributionCol("_mix").transform(self.vectors(df.select(key, self.text_col)))
        v = v.select(key, F.aggregate(vector_to_array("_tf"), F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("n_terms"),
                     vector_to_array("_mix").alias("mixture"))
        best = F.array_position("mixture", F.array_max("mixture")) - 1
        return v.withColumn("topic", F.when(F.col("n_terms") > 0, best.cast("int")))

    def bound(self, df: DataFrame) -> float:
        """Lower bound of the log likelihood of the texts, topics included; the larger, the better the fit."""
        return self.model.logLikelihood(self.vectors(df.select(self.text_col)).select("_tf"))


def fit_topics(df: DataFrame, text_col: str = "clean_review", k: int = 5, max_iter: int = 10, seed: int = 42,
               vocab_size: int = 1000) -> TopicFit | None:
    """Online LDA over the whole corpus; None if no text holds a term.

    Settings follow the batch learner being replaced: full passes
    (subsamplingRate=1), learningOffset=10, learningDecay=0.7. The fit is distributed.
    """
    from pyspark import StorageLevel
    from pyspark.ml.clustering import LDA

    spark = df.sparkSession
    # the vocabulary is A5 (ties by term), a bounded list; the vectors are read
    # by every pass of the fit and keep the partitioning of the input
    df = df.select(text_col).persist(StorageLevel.MEMORY_AND_DISK)  # the text is cleaned once, for vocabulary and vectors
    vocab = [r["term"] for r in vocabulary_top_k(df, text_col, vocab_size).collect()]
    if not vocab:
        df.unpersist()
        return None
    fit = TopicFit(spark, vocab, None, text_col)
    vec = fit.vectors(df.where(F.size(T.terms(F.col(text_col))) > 0)).select("_tf", F.xxhash64(text_col).alias("_h"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if vec.rdd.getNumPartitions() < n:  # few input splits: spread the vectors (not the texts)
        vec = vec.repartition(n)
    # the learner draws a text's start by its place in the partition: it must not follow the order in which tasks end
    vec = vec.sortWithinPartitions("_h").select("_tf").persist(StorageLevel.MEMORY_AND_DISK)
    lda = LDA(k=k, maxIter=max_iter, seed=seed, optimizer="online", featuresCol="_tf",
              subsamplingRate=1.0, learningOffset=10.0, learningDecay=0.7)
    fit.model = lda.fit(vec)
    vec.unpersist()
    df.unpersist()
    return fit


def topic_model(df: DataFrame, text_col: str = "clean_review", k: int = 5, max_iter: int = 10,
                seed: int = 42, vocab_size: int = 1000, top_words: int = 10) -> DataFrame:
    """T3 + W6: (topic, rank, word, weight) of :func:`fit_topics`; only this summary of the model becomes a table."""
    fit = fit_topics(df, text_col, k, max_iter, seed, vocab_size)
    if fit is None:
        return df.sparkSession.createDataFrame([], "topic int, rank int, word string, weight double")
    return fit.summary(top_words)


def topic_mixtures(df: DataFrame, key: str, text_col: str = "clean_review", k: int = 5, max_iter: int = 10, seed: int = 42,
                   vocab_size: int = 1000) -> DataFrame:
    """Topics fitted on the texts and the mixture of each text (see :meth:`TopicFit.mixtures`)."""
    df = written(df.select(key, text_col), "topic-texts")  # cleaned once, for the fit and for the mixtures
    fit = fit_topics(df, text_col, k, max_iter, seed, vocab_size)
    if fit is None:
        return df.select(key, F.lit(0).cast("bigint").alias("n_terms"), F.array_repeat(F.lit(0.0), k).alias("mixture"), F.lit(None).cast("int").alias("topic"))
    return fit.mixtures(df, key)


def topic_top_words(topic_terms: DataFrame, n: int = 10) -> DataFrame:
    """The n heaviest words per topic, heaviest first, from (topic, word, weight)."""
    w = Window.partitionBy("topic").orderBy(F.desc("weight"), F.asc("word"))
    # filter on row_number itself so Catalyst plans a WindowGroupLimit (a
    # partial top-n per topic before the exchange: a topic's vocabulary never
    # lands whole in one task)
    top = topic_terms.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return top.withColumn("rank", F.col("_rn") - 1).drop("_rn")


# --- T4 / J7 --------------------------------------------------------------------

def topics_table(spark: SparkSession, topics: list[tuple[int, list[str]]]) -> DataFrame:
    rows = [(int(t), int(r), w) for t, ws in topics for r, w in enumerate(ws)]
    return local_table(spark, rows, "topic int, rank int, word string")


def keywords_table(spark: SparkSession, keywords: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    kw = T.TOPIC_KEYWORDS if keywords is None else keywords
    rows = [(i, name, w) for i, (name, ws) in enumerate(kw) for w in ws]
    return local_table(spark, rows, "ord int, name string, word string")


#: Most rows of a topic summary (k topics of a few words each); it becomes literals of an expression.
MAX_TOPIC_ROWS = 10_000


def topic_lists(topics: list[tuple[int, list[str]]] | DataFrame) -> list[tuple[int, list[str]]]:
    """The topics as lists: given, or from a summary (topic, rank, word), which must be small."""
    if not isinstance(topics, DataFrame):
        return topics
    rows = topics.select("topic", "rank", "word").limit(MAX_TOPIC_ROWS + 1).collect()
    if len(rows) > MAX_TOPIC_ROWS:
        raise ValueError(f"a topic summary has at most {MAX_TOPIC_ROWS} rows")
    out: dict[int, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["topic"], r["rank"])):
        out.setdefault(int(r["topic"]), []).append(r["word"])
    return list(out.items())


def topic_keyword_overlap(topic_words: DataFrame, keywords: DataFrame) -> DataFrame:
    """(topic, ord, name) for keyword groups sharing a word with the topic's words."""
    tw = topic_words.select("topic", "word").distinct()
    j = tw.join(keywords.select("ord", "name", "word"), "word")
    return j.select("topic", "ord", "name").distinct()


def topic_autolabel(topic_words: DataFrame, keywords: DataFrame) -> DataFrame:
    """T4: (topic, label): matching group names in group order joined by ' ', else 'Uncategorized'.

    One pass: topic words left-joined to the keyword table, grouped by topic.
    """
    tw = topic_words.select("topic", "word")
    kw = keywords.select(F.col("word").alias("_kw"), "ord", "name")
    j = tw.join(kw, tw["word"] == kw["_kw"], "left")
    hits = F.collect_set(F.when(F.col("name").isNotNull(), F.struct("ord", "name")))
    g = j.groupBy("topic").agg(F.array_sort(hits).alias("_h"))
    label = F.when(F.size("_h") > 0, F.array_join(F.transform("_h", lambda s: s["name"]), " ")) \
        .otherwise(F.lit(T.UNCATEGORIZED))
    return g.select("topic", label.alias("label"))


# --- J6 / A8 / W7 / T5 ------------------------------------------------------------

def review_topic_cross(df: DataFrame, topics: list[tuple[int, list[str]]] | DataFrame,
                       text_col: str = "clean_review") -> DataFrame:
    """J6 + A8: one row per review and topic with the number of topic words found.

    The topics (k x 10 words, a model summary) are literals of the expression,
    so the pairing is a row generator, not a join.
    """
    return df.select("*", F.inline(T.topic_counts(F.col(text_col), topic_lists(topics))).alias("topic", "match_count"))


def assign_topics(df: DataFrame, topics: list[tuple[int, list[str]]] | DataFrame, labels: DataFrame,
                  text_col: str = "clean_review", out: str = "label") -> DataFrame:
    """T5: best topic by W7, then its label from (topic, label); no matching word -> 'Unknown'."""
    with_topic = df.withColumn("_topic", T.argmax_first(T.topic_counts(F.col(text_col), topic_lists(topics))))
    lab = labels.select(F.col("topic").alias("_lt"), F.col("label").alias("_lab"))
    j = with_topic.join(lab, with_topic["_topic"] == lab["_lt"], "left")
    return j.withColumn(out, F.coalesce(F.col("_lab"), F.lit(T.UNKNOWN))).drop("_lt", "_lab", "_topic")


# --- W5 -------------------------------------------------------------------------

def batch_number(df: DataFrame, order_col: str, size: int = 500, out: str = "batch") -> DataFrame:
    """Consecutive blocks of ``size`` rows in ``order_col`` order.

    One shuffle of the rows: they are range-partitioned and sorted inside the
    partitions, where ``monotonically_increasing_id`` numbers them; a row's
    global position is the number of rows in the partitions before plus its
    number. Offsets are one row per partition.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # counts and numbers must see the same partitions: written once in the shared folder
    ranked = written(df.repartitionByRange(n, F.col(order_col)).sortWithinPartitions(order_col)
                     .withColumn("_id", F.monotonically_increasing_id()), "batch-rows")
    ranked = ranked.withColumn("_pid", F.shiftright("_id", 33)).withColumn("_rn", F.col("_id").bitwiseAND((1 << 33) - 1))
    counts = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_pid")) - F.col("_n")  # one row a partition
    j = ranked.join(counts.select("_pid", before.alias("_off")), "_pid")
    return j.withColumn(out, F.floor((F.col("_off") + F.col("_rn")) / size).cast("bigint")).drop("_id", "_pid", "_rn", "_off", "_n")
