"""Golden cases for the review-text rules."""

import math

import pytest
from pyspark.sql import functions as F

from innsight.functions import text as T
from innsight.operators import reviews as RV


def test_clean_review_rules(spark):
    rows = [(1, "Great\tROOM!!\nvery clean, 2nd floor ²x (the) bathroom."), (2, None), (3, "!!! ... 123"),
            (4, "a b cd")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = dict(df.select("id", T.clean_review(F.col("text"), lemmas={"bathroom": "bath"})).collect())
    assert got[1] == "great room clean floor bath"
    assert got[2] == ""
    assert got[3] == ""
    assert got[4] == "cd"


@pytest.mark.parametrize("pos,neg,score,want", [
    (0.5, 0.1, 7.0, "positive"), (0.5, 0.1, 6.0, "positive"), (0.5, 0.1, 5.0, "negative"),
    (0.5, 0.1, float("nan"), "neutral"), (0.5, 0.1, None, "neutral"),
    (0.2, 0.2, 7.0, "neutral"), (0.2, 0.2, 6.0, "negative"), (0.2, 0.2, 5.0, "negative"),
    (0.2, 0.2, float("nan"), "neutral"),
    (0.1, 0.5, 7.0, "negative"), (0.1, 0.5, 6.0, "negative"), (0.1, 0.5, 5.0, "negative"),
    (0.1, 0.5, float("nan"), "negative"),
])
def test_sentiment_truth_table(spark, pos, neg, score, want):
    df = spark.createDataFrame([(pos, neg, score)], "pos double, neg double, score double")
    assert df.select(T.sentiment_label(F.col("pos"), F.col("neg"), F.col("score"))).first()[0] == want


def _vader_model(tokens, lex):
    vals = [lex.get(t, 0.0) for t in tokens]
    if not vals:
        return 0.0, 0.0, 0.0, 0.0
    s = sum(vals)
    comp = s / math.sqrt(s * s + 15)
    p = sum(v + 1 for v in vals if v > 0)
    n = sum(abs(v - 1) for v in vals if v < 0)
    u = sum(1 for v in vals if v == 0)
    tot = p + n + u
    return round(n / tot, 3), round(u / tot, 3), round(p / tot, 3), round(comp, 4)


@pytest.mark.parametrize("more", [0, 8000])
def test_polarity_matches_formula(spark, more):
    lex = {"good": 1.9, "bad": -2.5, "ok": 0.9, "awful": -3.1}
    docs = [(1, "good ok room"), (2, "bad awful"), (3, ""), (4, "good bad"), (5, "room view")]
    df = spark.createDataFrame(docs, "id long, clean_review string")
    others = [(f"other{i}", 1.0) for i in range(more)]
    lx = spark.createDataFrame(list(lex.items()) + others, "token string, valence double")
    got = {r["id"]: (r["neg"], r["neu"], r["pos"], r["compound"]) for r in RV.polarity_scores(df, "id", lx).collect()}
    for i, txt in docs:
        want = _vader_model([t for t in txt.split(" ") if t], lex)
        assert got[i] == pytest.approx(want, abs=1e-3), (i, got[i], want)


def test_topic_assignment_rules(spark):
    topics = [(0, ["room", "bath"]), (1, ["view", "bath"]), (2, ["zzz"])]
    df = spark.createDataFrame([(1, "bathroom view"), (2, "room bath"), (3, "nothing"), (4, "view")],
                               "id long, clean_review string")
    counts = T.topic_counts(F.col("clean_review"), topics)
    got = dict(df.select("id", T.argmax_first(counts)).collect())
    # 'room' found inside 'bathroom'; ties go to the lower topic; no word -> NULL
    assert got == {1: 0, 2: 0, 3: None, 4: 1}
    labels = RV.topic_autolabel(RV.topics_table(spark, topics), RV.keywords_table(spark))
    lab = dict(labels.collect())
    assert lab[0] == "location" and lab[1] == "Uncategorized" and lab[2] == "Uncategorized"
    out = dict(RV.assign_topics(df, topics, labels).select("id", "label").collect())
    assert out[3] == "Unknown" and out[1] == "location"


def test_vocabulary_tie_order(spark):
    df = spark.createDataFrame([("bb aa cc aa bb",), ("dd x",)], "clean_review string")
    got = [(r["term"], r["cnt"]) for r in RV.vocabulary_top_k(df, k=3).collect()]
    assert got == [("aa", 2), ("bb", 2), ("cc", 1)]


def test_batch_number_consecutive(spark):
    df = spark.range(0, 1234).withColumnRenamed("id", "k")
    got = {r["k"]: r["batch"] for r in RV.batch_number(df, "k", 500).collect()}
    assert all(got[k] == k // 500 for k in range(1234))


def test_lemmatise_table_path(spark):
    df = spark.createDataFrame([(1, "rooms were clean"), (2, None)], "id long, text string")
    toks = df.select("id", T.review_tokens(F.col("text")).alias("tokens"))
    lem = spark.createDataFrame([("rooms", "room"), ("clean", "c")], "token string, lemma string")
    got = dict(RV.lemmatise(toks, "id", "tokens", lem).select("id", "clean_review").collect())
    assert got == {1: "room", 2: ""}


def test_py_strip_equals_python_strip(spark):
    from innsight.functions.keys import py_strip

    samples = ["  a b  ", "  x　", "\x1c\ty\r\n", "", "   ", "​z​", "é\x85"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(py_strip(F.col("s"))).collect()]
    assert got == [s.strip() for s in samples]


def test_text_plans_stay_in_jvm(spark):
    from innsight.operators import incremental as I

    docs = spark.createDataFrame([(1, "Good room, 7.5", "8,5")], "id long, review_content string, review_score string")
    lex = spark.createDataFrame([("good", 1.9)], "token string, valence double")
    topics = [(0, ["room"]), (1, ["view"])]
    labels = RV.topic_autolabel(RV.topics_table(spark, topics), RV.keywords_table(spark))
    out = I.enrich_reviews(docs, "id", lexicon=lex, topics=topics, topic_labels=labels)
    plan = out._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, node
    r = out.first()
    assert r["sentiment"] == "positive" and r["label"] == "location"


def test_topic_top_words_plans_partial_limit(spark):
    df = spark.createDataFrame([(0, "a", 3), (0, "b", 2), (1, "c", 5)], "topic int, word string, weight long")
    out = RV.topic_top_words(df, 1)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted((r["topic"], r["word"], r["rank"]) for r in out.collect()) == [(0, "a", 0), (1, "c", 0)]


def test_lexicon_with_nulls_and_repeats(spark):
    """One path for every lexicon: a NULL token is no entry, a NULL valence counts 0, the largest valence of a token counts."""
    df = spark.createDataFrame([(1, "best bad best"), (2, ""), (3, None), (4, "unknown odd")], "id long, clean_review string")
    lex = RV.local_table(spark, [("best", 3.0), ("best", 1.0), ("bad", -3.0), (None, 2.0), ("odd", None)], "token string, valence double")
    hits = {r["id"]: (r["n_tokens"], r["n_known"], r["s10"]) for r in RV.lexicon_hits(df, "id", lex).collect()}
    assert hits == {1: (3, 3, 30), 2: (0, 0, 0), 3: (0, 0, 0), 4: (2, 1, 0)}
    got = {r["id"]: (r["neg"], r["neu"], r["pos"]) for r in RV.polarity_scores(df, "id", lex).collect()}
    assert got[1] == (0.333, 0.0, 0.667) and got[2] == got[3] == (0.0, 0.0, 0.0) and got[4] == (0.0, 1.0, 0.0)
    empty = RV.local_table(spark, [], "token string, valence double")
    assert {r["neu"] for r in RV.polarity_scores(df.where("id = 4"), "id", empty).collect()} == {1.0}


def test_translations_and_lemmas_by_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "")], "id long, review_content string")
    tr = spark.createDataFrame([("a", "A2"), ("a", "A1"), (None, "n"), ("c", "C"), ("", "E")], "text string, en string")
    assert {r["id"]: r["en_review"] for r in RV.translation_lookup(df, tr).collect()} == {1: "A1", 2: "b", 3: None, 4: "E"}
    toks = spark.createDataFrame([(1, ["xs", "y", "xs", "zz"]), (2, []), (3, None)], "id long, tokens array<string>")
    lem = RV.local_table(spark, [("xs", "xx"), ("xs", "xy"), ("zz", None), (None, "q")], "token string, lemma string")
    assert {r["id"]: r["clean_review"] for r in RV.lemmatise(toks, "id", "tokens", lem).collect()} == {1: "xx xx zz", 2: "", 3: ""}


def test_batch_numbers_take_one_shuffle_of_the_rows(spark):
    df = spark.range(0, 2345, 1, 7).select((F.lit(9999) - F.col("id")).alias("k"))
    out = RV.batch_number(df, "k", 500)
    assert sorted((r["k"], r["batch"]) for r in out.collect()) == [(9999 - 2344 + i, i // 500) for i in range(2345)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "RepartitionByExpression" not in plan


def test_fitted_topics_are_deterministic(spark):
    from innsight.plans import q_text as QT

    clean = QT.cleaned(spark, "/root/testdata/sf0.001").persist()
    one, two = ([tuple(r) for r in RV.topic_model(clean, k=3, max_iter=3).orderBy("topic", "rank").collect()] for _ in range(2))
    clean.unpersist()
    assert one == two and len(one) == 30
    lists = RV.topic_lists(RV.topic_model(clean, k=3, max_iter=3))
    assert [t for t, _ in lists] == [0, 1, 2] and all(len(w) == 10 for _, w in lists)
    assert RV.topic_model(clean.limit(0)).count() == 0
