"""Review-text queries (P1, P2, J9, T1-T7, A5-A8, J6-J8, W5-W7, P18) on ``documents``.

``documents`` stands for reviews: doc_id is id and seq, text is the review
content, the review score is (doc_id mod 101) / 10 with NULL and NaN cases.
The lexicon, lemma and topic tables are fixed test parameters (the real ones
are external tables or the fitted model); every query still reads all documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from innsight.functions import text as T
from innsight.operators import incremental as I
from innsight.operators import reviews as RV
from innsight.plans.registry import register
from innsight.session import spread, written
from innsight.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed test parameters (words of the synthetic corpus).
TEST_LEXICON: dict[str, float] = {
    "worthless": -1.9, "best": 3.2, "orre": 1.5, "rewh": -0.7, "thatin": 0.8, "ononst": -1.2,
    "inoran": 2.1, "hehely": -2.5, "orantion": 0.4, "ther": 1.1, "tion": -0.3, "thon": 0.9,
}
TEST_LEMMAS: dict[str, str] = {"ther": "thor", "thes": "th", "thnt": "thnd", "erin": "er", "ing": "i"}
TEST_TOPICS: list[tuple[int, list[str]]] = [
    (0, ["the", "room", "orre", "home"]),
    (1, ["thon", "ther", "service", "staff"]),
    (2, ["ing", "tion", "clean", "quiet"]),
    (3, ["worthless", "best", "noise"]),
    (4, ["zzzz"]),
]
# ---------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list_sql(words) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]::VARCHAR[]"


def tokens_sql(expr: str, stops=None) -> str:
    """DuckDB form of T.review_tokens."""
    stops = T.ENGLISH_STOP_WORDS if stops is None else stops
    t = f"string_split(lower(replace(replace(coalesce({expr}, ''), chr(9), ' '), chr(10), ' ')), ' ')"
    t = f"list_transform({t}, lambda w: regexp_replace(w, '^[[:punct:]]+|[[:punct:]]+$', '', 'g'))"
    t = f"list_filter({t}, lambda w: NOT regexp_matches(w, '[\\p{{Nd}}\\p{{No}}]'))"
    t = f"list_filter({t}, lambda w: NOT list_contains({_list_sql(stops)}, w))"
    return f"list_filter({t}, lambda w: length(w) > 0)"


def clean_sql(expr: str, lemmas=None, stops=None) -> str:
    """DuckDB form of T.clean_review."""
    t = tokens_sql(expr, stops)
    if lemmas:
        case = "CASE w " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in sorted(lemmas.items())) + " ELSE w END"
        t = f"list_transform({t}, lambda w: {case})"
    return f"array_to_string(list_filter({t}, lambda w: length(w) > 1), ' ')"


def terms_sql(expr: str) -> str:
    return f"regexp_extract_all(coalesce({expr}, ''), '[\\pL\\pN_]{{2,}}')"


def _values_sql(rows, cols) -> str:
    vals = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else repr(v) for v in r) + ")" for r in rows)
    return f"(VALUES {vals}) AS t({', '.join(cols)})"


LEX_CTE = f"lex AS (SELECT token, CAST(round(valence * 10) AS BIGINT) AS v10 FROM {_values_sql(sorted(TEST_LEXICON.items()), ['token', 'valence'])})"

SCORE_SQL = ("CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 'NaN'::DOUBLE "
             "ELSE (doc_id % 101) / 10.0 END")

CLEAN_CTE = f"c AS (SELECT doc_id, text, lang, {SCORE_SQL} AS score, {clean_sql('text', TEST_LEMMAS)} AS clean_review FROM documents)"

POL_CTE = """pol_agg AS (
  SELECT doc_id, sum(v) AS s10, sum(CASE WHEN v > 0 THEN v + 10 END) AS p10,
         sum(CASE WHEN v < 0 THEN 10 - v END) AS n10, count(CASE WHEN v = 0 THEN 1 END) AS u
  FROM (SELECT x.doc_id, coalesce(lex.v10, 0) AS v
        FROM (SELECT doc_id, unnest(list_filter(string_split(clean_review, ' '), lambda w: length(w) > 0)) AS tok FROM c) x
        LEFT JOIN lex ON lex.token = x.tok)
  GROUP BY doc_id),
pol AS (
  SELECT c.doc_id, c.score, c.clean_review, c.text, c.lang,
         coalesce(s10, 0) AS s10, coalesce(p10, 0) AS p10, coalesce(n10, 0) AS n10, coalesce(u, 0) AS u,
         coalesce(p10, 0) + coalesce(n10, 0) + coalesce(u, 0) * 10 AS tot10
  FROM c LEFT JOIN pol_agg USING (doc_id)),
scores AS (
  SELECT doc_id, score, clean_review, text, lang,
    CASE WHEN tot10 > 0 THEN ((n10 * 2000 + tot10) // (tot10 * 2)) / 1000.0 ELSE 0.0 END AS neg,
    CASE WHEN tot10 > 0 THEN ((u * 10 * 2000 + tot10) // (tot10 * 2)) / 1000.0 ELSE 0.0 END AS neu,
    CASE WHEN tot10 > 0 THEN ((p10 * 2000 + tot10) // (tot10 * 2)) / 1000.0 ELSE 0.0 END AS pos,
    CASE WHEN tot10 > 0 THEN round((s10 / 10.0) / sqrt((s10 / 10.0) * (s10 / 10.0) + 15.0), 4) ELSE 0.0 END AS compound
  FROM pol)"""

LABEL_SQL = """CASE WHEN neg > pos THEN 'negative'
     WHEN score IS NULL OR isnan(score) THEN 'neutral'
     WHEN pos > neg AND score >= 6.0 THEN 'positive'
     WHEN score <= 6.0 THEN 'negative' ELSE 'neutral' END"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- Spark side inputs ---------------------------------------------------------------------

def reviews_from_documents(spark, sf):
    d = spread(read_table(spark, sf, "documents"))
    k = F.col("doc_id")
    score = (F.when(k % 17 == 0, F.lit(None).cast("double")).when(k % 19 == 0, F.lit(float("nan")))
             .otherwise((k % 101) / F.lit(10.0)))
    return d.select("doc_id", "text", "lang", score.alias("score"))


def cleaned(spark, sf):
    return RV.clean_reviews(reviews_from_documents(spark, sf), "text", lemmas=TEST_LEMMAS)


def lexicon_df(spark):
    return RV.local_table(spark, sorted(TEST_LEXICON.items()), "token string, valence double")


def lemmas_df(spark):
    return RV.local_table(spark, sorted(TEST_LEMMAS.items()), "token string, lemma string")


def scored(spark, sf):
    return RV.polarity_scores(cleaned(spark, sf), "doc_id", lexicon_df(spark))


# --- P1 / P2 / J9 ----------------------------------------------------------------------------

_CONTENT = (f"CASE WHEN doc_id % 7 = 0 THEN {_q(T.NO_COMMENT_PLACEHOLDER)} "
            "WHEN doc_id % 11 = 0 THEN NULL ELSE text END")


@register("valid_reviews", f"SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, {_CONTENT} AS review_content FROM documents) "
          f"WHERE review_content IS NOT NULL AND review_content <> {_q(T.NO_COMMENT_PLACEHOLDER)}")
def q_valid_reviews(spark, sf):
    d = read_table(spark, sf, "documents")
    k = F.col("doc_id")
    content = (F.when(k % 7 == 0, F.lit(T.NO_COMMENT_PLACEHOLDER)).when(k % 11 == 0, F.lit(None).cast("string"))
               .otherwise(F.col("text")))
    return RV.valid_reviews(d.select("doc_id", "n_chars", content.alias("review_content"))).select("doc_id", "n_chars")


@register("score_normalise", """SELECT event_id,
  TRY_CAST(replace(CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE replace(CAST(value AS VARCHAR), '.', ',') END, ',', '.') AS DOUBLE) AS score
FROM events""")
def q_score_normalise(spark, sf):
    e = read_table(spark, sf, "events")
    txt = F.when(F.col("event_id") % 13 == 0, F.lit("n/a")).otherwise(F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")))
    return RV.with_score(e.select("event_id", txt.alias("review_score"))).select("event_id", "score")


@register("translation_lookup", """WITH tr AS (SELECT text, min(upper(text)) AS en FROM documents WHERE lang = 'fr' GROUP BY text)
SELECT d.doc_id, coalesce(tr.en, d.text) AS en_review FROM documents d LEFT JOIN tr ON tr.text = d.text""")
def q_translation_lookup(spark, sf):
    d = read_table(spark, sf, "documents")
    tr = d.where(F.col("lang") == "fr").select("text", F.upper("text").alias("en"))
    return RV.translation_lookup(d.select("doc_id", F.col("text").alias("review_content")), tr).select("doc_id", "en_review")


# --- T1 / T2 ------------------------------------------------------------------------------

@register("clean_review", _with(CLEAN_CTE) + "SELECT doc_id, clean_review FROM c")
def q_clean_review(spark, sf):
    return cleaned(spark, sf).select("doc_id", "clean_review")


@register("lemmatise", _with(CLEAN_CTE) + "SELECT doc_id, clean_review FROM c")
def q_lemmatise(spark, sf):
    """T2 through the table-join path (lemma table of any size)."""
    d = reviews_from_documents(spark, sf).select("doc_id", T.review_tokens(F.col("text")).alias("tokens"))
    return RV.lemmatise(d, "doc_id", "tokens", lemmas_df(spark)).select("doc_id", "clean_review")


# --- A5 / A6 --------------------------------------------------------------------------------

@register("vocabulary_top_k", _with(CLEAN_CTE) + f"""
SELECT term, count(*) AS cnt FROM (SELECT unnest({terms_sql('clean_review')}) AS term FROM c)
GROUP BY term ORDER BY cnt DESC, term LIMIT 1000""")
def q_vocabulary_top_k(spark, sf):
    return RV.vocabulary_top_k(cleaned(spark, sf), k=1000)


@register("term_counts", _with(CLEAN_CTE) + f"""
SELECT doc_id, term, count(*) AS cnt FROM (SELECT doc_id, unnest({terms_sql('clean_review')}) AS term FROM c)
GROUP BY doc_id, term""")
def q_term_counts(spark, sf):
    return RV.term_counts(cleaned(spark, sf), "doc_id")


# --- A7 / J8 / P18 / T6 ------------------------------------------------------------------------

@register("polarity_scores", _with(CLEAN_CTE, LEX_CTE, POL_CTE) + "SELECT doc_id, neg, neu, pos, compound FROM scores")
def q_polarity_scores(spark, sf):
    return scored(spark, sf).select("doc_id", "neg", "neu", "pos", "compound")


# A lexicon as large as the corpus' vocabulary: a valence for every token (by its length), NULL rows among them.
_BIG_LEX = """lexrows AS (SELECT tok AS token, (length(tok) * 13 % 81 - 40) / 10.0 AS valence FROM (
    SELECT DISTINCT unnest(list_filter(string_split(clean_review, ' '), lambda w: length(w) > 0)) AS tok FROM c)
  UNION ALL SELECT NULL, 1.0 UNION ALL SELECT 'of', NULL UNION ALL SELECT 'the', NULL),
lex AS (SELECT token, coalesce(max(CAST(round(valence * 10) AS BIGINT)), 0) AS v10 FROM lexrows WHERE token IS NOT NULL GROUP BY token)"""


def big_lexicon(spark, clean):
    toks = F.filter(F.split("clean_review", " "), lambda w: F.length(w) > 0)
    # the outer form: the plain one would clean every text again in an inferred filter
    t = clean.select(F.explode_outer(toks).alias("token")).where("token is not null").distinct()
    rows = t.select("token", ((F.length("token") * 13 % 81 - 40) / F.lit(10.0)).alias("valence"))
    return rows.unionByName(RV.local_table(spark, [(None, 1.0), ("of", None), ("the", None)], "token string, valence double"))


@register("polarity_scores_large_lexicon", _with(CLEAN_CTE, _BIG_LEX, POL_CTE) + "SELECT doc_id, neg, neu, pos, compound FROM scores")
def q_polarity_scores_large_lexicon(spark, sf):
    """A7 with a valence for every token of the corpus, and with NULL tokens and valences."""
    # the texts are cleaned once, for the lexicon and for the scores
    c = written(cleaned(spark, sf).select("doc_id", "clean_review"), "clean-reviews")
    s = RV.polarity_scores(c, "doc_id", big_lexicon(spark, c))
    return s.select("doc_id", "neg", "neu", "pos", "compound")


@register("drop_columns_widen", _with(CLEAN_CTE, LEX_CTE, POL_CTE) + "SELECT doc_id, neg, neu, pos, compound FROM scores")
def q_drop_columns_widen(spark, sf):
    s = scored(spark, sf).select("doc_id", F.struct("neg", "neu", "pos", "compound").alias("sentiments"))
    return RV.drop_columns_widen(s, "sentiments")


@register("lexicon_join", _with(CLEAN_CTE, LEX_CTE) + """
SELECT c.doc_id, count(x.tok) AS n_tokens, count(lex.token) AS n_known, coalesce(sum(lex.v10), 0) AS sum_v10
FROM c LEFT JOIN (SELECT doc_id, unnest(list_filter(string_split(clean_review, ' '), lambda w: length(w) > 0)) AS tok FROM c) x
  ON x.doc_id = c.doc_id
LEFT JOIN lex ON lex.token = x.tok
GROUP BY c.doc_id""")
def q_lexicon_join(spark, sf):
    h = RV.lexicon_hits(cleaned(spark, sf), "doc_id", lexicon_df(spark))
    return h.select("doc_id", "n_tokens", "n_known", F.col("s10").cast("bigint").alias("sum_v10"))


@register("sentiment_label", _with(CLEAN_CTE, LEX_CTE, POL_CTE) + f"SELECT doc_id, score, pos, neg, {LABEL_SQL} AS sentiment FROM scores")
def q_sentiment_label(spark, sf):
    return RV.label_sentiment(scored(spark, sf)).select("doc_id", "score", "pos", "neg", "sentiment")


# --- topics: J6 / A8 / W7 / T5 with fixed topic words --------------------------------------------

def _count_sql(expr: str, words) -> str:
    return f"len(list_filter({_list_sql(words)}, lambda w: contains(coalesce({expr}, ''), w)))"


def _argmax_sql(expr: str, topics) -> str:
    """First topic with the strictly greatest count, NULL when all counts are zero."""
    cnt = {t: _count_sql(expr, ws) for t, ws in topics}
    parts = []
    for t, _ in topics:
        earlier = [u for u, _ in topics if u < t]
        later = [u for u, _ in topics if u > t]
        conds = [f"{cnt[t]} > 0"] + [f"{cnt[t]} > {cnt[u]}" for u in earlier] + [f"{cnt[t]} >= {cnt[u]}" for u in later]
        parts.append(f"WHEN {' AND '.join(conds)} THEN {t}")
    return "CASE " + " ".join(parts) + " END"


TOPICS_ROWS = [(t, r, w) for t, ws in TEST_TOPICS for r, w in enumerate(ws)]
KW_ROWS = [(i, n, w) for i, (n, ws) in enumerate(T.TOPIC_KEYWORDS) for w in ws]
TOPIC_LABEL_CTE = f"""tw AS (SELECT * FROM {_values_sql(TOPICS_ROWS, ['topic', 'rnk', 'word'])}),
kw AS (SELECT * FROM {_values_sql(KW_ROWS, ['ord', 'name', 'word'])}),
hits AS (SELECT DISTINCT tw.topic, kw.ord, kw.name FROM tw JOIN kw ON tw.word = kw.word),
labels AS (SELECT t.topic, coalesce(string_agg(h.name, ' ' ORDER BY h.ord), 'Uncategorized') AS label
           FROM (SELECT DISTINCT topic FROM tw) t LEFT JOIN hits h ON h.topic = t.topic GROUP BY t.topic)"""


@register("review_topic_cross", _with(CLEAN_CTE) + " UNION ALL ".join(
    f"SELECT doc_id, {t} AS topic, {_count_sql('clean_review', ws)} AS match_count FROM c" for t, ws in TEST_TOPICS))
def q_review_topic_cross(spark, sf):
    return RV.review_topic_cross(cleaned(spark, sf), TEST_TOPICS).select("doc_id", "topic", "match_count")


@register("topic_match_count", _with(CLEAN_CTE) + "SELECT doc_id, " + ", ".join(
    f"{_count_sql('clean_review', ws)} AS c{t}" for t, ws in TEST_TOPICS) + " FROM c")
def q_topic_match_count(spark, sf):
    c = cleaned(spark, sf)
    counts = T.topic_counts(F.col("clean_review"), TEST_TOPICS)
    return c.select("doc_id", *[counts[i]["cnt"].alias(f"c{t}") for i, (t, _) in enumerate(TEST_TOPICS)])


@register("argmax_first", _with(CLEAN_CTE) + f"SELECT doc_id, {_argmax_sql('clean_review', TEST_TOPICS)} AS topic FROM c")
def q_argmax_first(spark, sf):
    c = cleaned(spark, sf)
    return c.select("doc_id", T.argmax_first(T.topic_counts(F.col("clean_review"), TEST_TOPICS)).alias("topic"))


@register("review_topic_assignment", _with(CLEAN_CTE, TOPIC_LABEL_CTE) + f"""
SELECT c.doc_id, coalesce(l.label, 'Unknown') AS label
FROM (SELECT doc_id, {_argmax_sql('clean_review', TEST_TOPICS)} AS topic FROM c) c LEFT JOIN labels l ON l.topic = c.topic""")
def q_review_topic_assignment(spark, sf):
    labels = RV.topic_autolabel(RV.topics_table(spark, TEST_TOPICS), RV.keywords_table(spark))
    return RV.assign_topics(cleaned(spark, sf), TEST_TOPICS, labels).select("doc_id", "label")


# --- topics from the corpus: W6 / J7 / T4 -----------------------------------------------------

LANG_TOPIC_SQL = "CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 WHEN 'es' THEN 3 ELSE 4 END"
CORPUS_TOPICS_CTE = f"""tc AS (SELECT {LANG_TOPIC_SQL} AS topic, term AS word, count(*) AS weight
  FROM (SELECT lang, unnest({terms_sql('clean_review')}) AS term FROM c) GROUP BY 1, 2),
tw AS (SELECT topic, word, weight, rnk FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, word) - 1 AS rnk FROM tc) WHERE rnk < 10)"""

# Fixed test keyword groups over corpus words, plus the reference's groups.
CORPUS_KEYWORDS: list[tuple[str, list[str]]] = [*T.TOPIC_KEYWORDS, ("frequent", ["orre", "rewh", "thatin", "que", "der"])]
CKW_ROWS = [(i, n, w) for i, (n, ws) in enumerate(CORPUS_KEYWORDS) for w in ws]


def corpus_topic_words(spark, sf):
    c = cleaned(spark, sf)
    topic = (F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1).when(F.col("lang") == "de", 2)
             .when(F.col("lang") == "es", 3).otherwise(4))
    ex = c.select(topic.alias("topic"), F.explode(T.terms(F.col("clean_review"))).alias("word"))
    tc = ex.groupBy("topic", "word").agg(F.count(F.lit(1)).alias("weight"))
    return RV.topic_top_words(tc, 10)


@register("topic_top_words", _with(CLEAN_CTE, CORPUS_TOPICS_CTE) + "SELECT topic, rnk AS rank, word, weight FROM tw")
def q_topic_top_words(spark, sf):
    return corpus_topic_words(spark, sf).select("topic", "rank", "word", F.col("weight").cast("bigint").alias("weight"))


@register("topic_keyword_overlap", _with(CLEAN_CTE, CORPUS_TOPICS_CTE) + f"""
SELECT DISTINCT tw.topic, kw.ord, kw.name FROM tw JOIN (SELECT * FROM {_values_sql(CKW_ROWS, ['ord', 'name', 'word'])}) kw ON tw.word = kw.word""")
def q_topic_keyword_overlap(spark, sf):
    return RV.topic_keyword_overlap(corpus_topic_words(spark, sf), RV.keywords_table(spark, CORPUS_KEYWORDS))


@register("topic_autolabel", _with(CLEAN_CTE, CORPUS_TOPICS_CTE) + f"""
SELECT t.topic, coalesce(string_agg(h.name, ' ' ORDER BY h.ord), 'Uncategorized') AS label
FROM (SELECT DISTINCT topic FROM tw) t
LEFT JOIN (SELECT DISTINCT tw.topic, kw.ord, kw.name FROM tw JOIN (SELECT * FROM {_values_sql(CKW_ROWS, ['ord', 'name', 'word'])}) kw
           ON tw.word = kw.word) h ON h.topic = t.topic
GROUP BY t.topic""")
def q_topic_autolabel(spark, sf):
    return RV.topic_autolabel(corpus_topic_words(spark, sf), RV.keywords_table(spark, CORPUS_KEYWORDS))


@register("topic_model")
def q_topic_model(spark, sf):
    """Online LDA over the cleaned corpus (no exact oracle exists)."""
    return RV.topic_model(cleaned(spark, sf))


@register("topic_mixtures")
def q_topic_mixtures(spark, sf):
    """The topic mixture of every document under the fitted model (tested against a plain E-step)."""
    m = RV.topic_mixtures(cleaned(spark, sf), "doc_id")
    return m.select("doc_id", "n_terms", F.array_join(F.transform("mixture", lambda x: F.round(x, 3).cast("string")), "|").alias("mixture"), "topic")


# --- W5 ------------------------------------------------------------------------------------------

@register("batch_number", "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 500 AS batch FROM documents")
def q_batch_number(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id")
    return RV.batch_number(d, "doc_id", 500).select("doc_id", "batch")


# --- T7 -------------------------------------------------------------------------------------------

ENRICH_CLEAN_CTE = f"""src AS (SELECT doc_id, {_CONTENT} AS review_content, {SCORE_SQL} AS score, lang FROM documents
                      WHERE ({_CONTENT}) IS NOT NULL AND ({_CONTENT}) <> {_q(T.NO_COMMENT_PLACEHOLDER)}),
tr AS (SELECT text, min(upper(text)) AS en FROM documents WHERE lang = 'de' GROUP BY text),
c AS (SELECT s.doc_id, s.score, s.lang, coalesce(tr.en, s.review_content) AS text,
             {clean_sql('coalesce(tr.en, s.review_content)', TEST_LEMMAS)} AS clean_review
      FROM src s LEFT JOIN tr ON tr.text = s.review_content)"""


@register("enrich_reviews", _with(ENRICH_CLEAN_CTE, LEX_CTE, POL_CTE, TOPIC_LABEL_CTE) + f"""
SELECT s.doc_id, {LABEL_SQL} AS sentiment, coalesce(l.label, 'Unknown') AS label
FROM (SELECT *, {_argmax_sql('clean_review', TEST_TOPICS)} AS topic FROM scores) s
LEFT JOIN labels l ON l.topic = s.topic""")
def q_enrich_reviews(spark, sf):
    d = spread(read_table(spark, sf, "documents"))
    k = F.col("doc_id")
    content = (F.when(k % 7 == 0, F.lit(T.NO_COMMENT_PLACEHOLDER)).when(k % 11 == 0, F.lit(None).cast("string"))
               .otherwise(F.col("text")))
    score = (F.when(k % 17 == 0, F.lit(None).cast("double")).when(k % 19 == 0, F.lit(float("nan")))
             .otherwise((k % 101) / F.lit(10.0)))
    reviews = d.select("doc_id", content.alias("review_content"), score.alias("score"))
    translations = d.where(F.col("lang") == "de").select("text", F.upper("text").alias("en"))
    labels = RV.topic_autolabel(RV.topics_table(spark, TEST_TOPICS), RV.keywords_table(spark))
    out = I.enrich_reviews(reviews, "doc_id", lexicon=lexicon_df(spark), topics=RV.topics_table(spark, TEST_TOPICS),
                           topic_labels=labels, translations=translations, lemmas=lemmas_df(spark),
                           score_col="score", already_numeric=True)
    return out.select("doc_id", "sentiment", "label")


@register("fit_and_enrich", _with(ENRICH_CLEAN_CTE, LEX_CTE, POL_CTE) + f"SELECT doc_id, {LABEL_SQL} AS sentiment FROM scores")
def q_fit_and_enrich(spark, sf):
    """T3 -> T4 -> T5 -> T7 on the fitted path; the sentiment does not depend on the topics, the label does (tested for
    determinism)."""
    d = spread(read_table(spark, sf, "documents"))
    k = F.col("doc_id")
    content = (F.when(k % 7 == 0, F.lit(T.NO_COMMENT_PLACEHOLDER)).when(k % 11 == 0, F.lit(None).cast("string"))
               .otherwise(F.col("text")))
    score = (F.when(k % 17 == 0, F.lit(None).cast("double")).when(k % 19 == 0, F.lit(float("nan")))
             .otherwise((k % 101) / F.lit(10.0)))
    reviews = d.select("doc_id", content.alias("review_content"), score.alias("score"))
    translations = d.where(F.col("lang") == "de").select("text", F.upper("text").alias("en"))
    out = I.fit_and_enrich(reviews, "doc_id", lexicon_df(spark), lemmas_df(spark), translations=translations,
                           score_col="score", already_numeric=True)
    return out.select("doc_id", "sentiment")
