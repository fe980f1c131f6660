"""Review-text helpers (Column -> Column, higher-order functions, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.
# Placeholder text that marks a review without content.
NO_COMMENT_PLACEHOLDER = "There are no comments available for this review"
# Label names of the sentiment rule.
POSITIVE, NEGATIVE, NEUTRAL = "positive", "negative", "neutral"
# Score boundary of the sentiment rule.
SCORE_BOUNDARY = 6.0
# Names given when no keyword group or no topic matches.
UNCATEGORIZED, UNKNOWN = "Uncategorized", "Unknown"
# Keyword groups used to name topics, in dictionary order.
TOPIC_KEYWORDS: list[tuple[str, list[str]]] = [
    ("location", ["location", "place", "area", "room", "home", "homestay"]),
    ("amenity", ["amenity", "facility", "service", "equipment"]),
    ("host", ["host", "owner", "manager", "staff"]),
    ("noise", ["noise", "sound", "quiet", "noisy"]),
    ("cleanliness", ["cleanliness", "clean", "tidy", "dirty"]),
]
# English stop words of the NLTK corpus (179 words, corpus order).
ENGLISH_STOP_WORDS: list[str] = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them
their theirs themselves what which who whom this that that'll these those am is are was
were be been being have has had having do does did doing a an the and but if or because
as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there
when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don don't should should've now d ll m o re ve y
ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()
# VADER normalisation constant of the compound score.
COMPOUND_ALPHA = 15
# ---------------------------------------------------------------------------

# Python's string.punctuation: the 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Python str.isdigit() is true for decimal digits and other digits such as '²'.
_ANY_DIGIT = "[\\p{Nd}\\p{No}]"
# sklearn's default token pattern (?u)\b\w\w+\b, written as maximal runs of \w.
TOKEN_PATTERN = "[\\p{L}\\p{N}_]{2,}"


def review_tokens(text: Column, stop_words: list[str] | None = None) -> Column:
    """T1 up to lemmatisation: array of cleaned tokens, in order, duplicates kept.

    tab/newline -> space, lower, split on single spaces, strip ASCII punctuation
    at both ends, drop tokens with any digit, drop stop words, drop empties.
    The strip is ``btrim`` with the punctuation set (no regex) and the three
    drop rules are one filter.
    """
    stops = ENGLISH_STOP_WORDS if stop_words is None else stop_words
    t = F.lower(F.translate(F.coalesce(text, F.lit("")), "\t\n", "  "))
    toks = F.transform(F.split(t, " ", -1), lambda w: F.btrim(w, F.lit(PUNCTUATION)))

    def keep(w: Column) -> Column:
        ok = (F.length(w) > 0) & ~w.rlike(_ANY_DIGIT)
        return ok & ~w.isin(stops) if stops else ok

    return F.filter(toks, keep)


def finish_tokens(tokens: Column, lemmas: dict[str, str] | None = None) -> Column:
    """T1 tail: lemmatise with a small literal table, drop tokens of length <= 1, join."""
    if lemmas:
        m = F.create_map(*[x for kv in sorted(lemmas.items()) for x in (F.lit(kv[0]), F.lit(kv[1]))])
        tokens = F.transform(tokens, lambda w: F.coalesce(F.element_at(m, w), w))
    return F.array_join(F.filter(tokens, lambda w: F.length(w) > 1), " ")


def clean_review(text: Column, stop_words: list[str] | None = None,
                 lemmas: dict[str, str] | None = None) -> Column:
    """Cleaned review text (NULL -> '')."""
    return finish_tokens(review_tokens(text, stop_words), lemmas)


def terms(text: Column) -> Column:
    """Vectoriser tokens of a (cleaned) text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN_PATTERN), 0)


def sentiment_label(pos: Column, neg: Column, score: Column) -> Column:
    """Label from rounded pos/neg and the review score; NULL or NaN score = NaN."""
    nan = score.isNull() | F.isnan(score)
    return (
        F.when(neg > pos, F.lit(NEGATIVE))
        .when(nan, F.lit(NEUTRAL))
        .when((pos > neg) & (score >= SCORE_BOUNDARY), F.lit(POSITIVE))
        .when(score <= SCORE_BOUNDARY, F.lit(NEGATIVE))
        .otherwise(F.lit(NEUTRAL))
    )


def topic_counts(text: Column, topics: list[tuple[int, list[str]]]) -> Column:
    """A8 for every topic: array<struct<topic int, cnt int>> of words found as substrings."""
    items = []
    for t, words in topics:
        arr = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
        cnt = F.size(F.filter(arr, lambda w: F.coalesce(text, F.lit("")).contains(w)))
        items.append(F.struct(F.lit(int(t)).alias("topic"), cnt.cast("int").alias("cnt")))
    return F.array(*items)


def argmax_first(counts: Column) -> Column:
    """Topic with the strictly greatest count, first on ties, NULL when all are zero."""
    init = F.struct(F.lit(None).cast("int").alias("topic"), F.lit(0).alias("cnt"))
    best = F.aggregate(counts, init, lambda acc, x: F.when(x["cnt"] > acc["cnt"], x).otherwise(acc))
    return best["topic"]
