"""Language identification: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.llm.common import map_text
from innsight.session import written

#: Bounds of the model, not of what it is fitted on: entries for each language and for all of them, and languages (those of most labelled rows).
MAX_WORDS, MAX_GRAMS, MAX_ENTRIES, MAX_LANGS = 20_000, 10_000, 400_000, 200
#: Parts in which a language's entries are ranked first.
RANK_PARTS = 64
#: n-gram orders, longest first, and the weight of a word that only they know.
ORDERS, GRAM_WEIGHT = (4, 3, 2, 1), 0.5
#: Characters of texts that a worker scores at once (a longer text alone), and bytes of words that it cuts into n-grams at once.
CHARS_AT_ONCE, WORD_BYTES_AT_ONCE = 1_000_000, 500_000

UNDETERMINED = "und"
FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
KNOWN = T.StructField("known", T.DoubleType())
_LETTERS = regex.compile(r"\p{L}+")
#: Letters of scripts written without blanks: a run of them is no word, so its pairs of letters are looked up.
UNSPACED = "[" + "".join(rf"\p{{Is{x}}}" for x in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")) + "]"
_UNSPACED = regex.compile(UNSPACED)


class Entries:
    """Entry -> log frequencies by language, held only for the languages that have the entry, one language after the other.

    The others get ``base``, the log frequency of no count.
    """

    def __init__(self, names: list[str], entry: np.ndarray, lang: np.ndarray, log: np.ndarray, base: np.ndarray):
        self.names, self.base = pa.array(names, pa.string()), base
        order = np.argsort(lang, kind="stable")
        self.entry, self.log = entry[order].astype(np.int32), log[order]
        self.begin = np.searchsorted(lang[order], np.arange(len(base) + 1))

    @classmethod
    def counted(cls, counts: list[tuple[str, list[tuple[int, int]]]], langs: int) -> Entries:
        """From the counts of every entry by language: (language, count)."""
        entry = np.repeat(np.arange(len(counts)), [len(row) for _, row in counts])
        lang, n = np.array([c for _, row in counts for c in row], np.int64).reshape(-1, 2).T
        every = np.log(np.bincount(lang, n, langs) + 0.1 * len(counts))
        return cls([w for w, _ in counts], entry, lang, np.log(n + 0.1) - every[lang], np.log(0.1) - every)

    @classmethod
    def spelled(cls, rows: Mapping | Entries, langs: int) -> Entries:
        """From whole rows of log frequencies."""
        if isinstance(rows, Entries):
            return rows
        n = len(rows)
        log = np.array([*rows.values()], np.float64).reshape(n * langs)
        return cls([*rows], np.repeat(np.arange(n), langs), np.tile(np.arange(langs), n), log, np.zeros(langs))

    def __len__(self) -> int:
        return len(self.names)

    def column(self, lang: int) -> np.ndarray:
        """Log frequencies of all entries in one language."""
        out, at = np.full(len(self), self.base[lang]), slice(*self.begin[lang:lang + 2])
        out[self.entry[at]] = self.log[at]
        return out

    def get(self, w: str) -> tuple[float, ...] | None:
        i = pc.index(self.names, w).as_py()
        return None if i < 0 else tuple(float(self.column(x)[i]) for x in range(len(self.base)))


@dataclass
class Model:
    """Log frequencies by language; the rows of ``words`` and ``grams`` follow ``langs``.

    ``pairs`` holds pairs of letters of scripts written without blanks; ``no_word`` and ``no_pair`` the log frequency of
    a word and of a pair that was never met in a language.
    """

    langs: list[str]
    words: Mapping | Entries
    grams: Mapping | Entries
    no_word: np.ndarray | float = -np.inf
    pairs: Mapping | Entries = field(default_factory=dict)
    no_pair: np.ndarray | float = -np.inf


def labelled(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(t, l): whole texts and labels of all rows that have both."""
    return docs.select(F.col(f"`{text_col}`").cast("string").alias("t"),
                       F.col(f"`{lang_col}`").cast("string").alias("l")).where("t is not null and l is not null")


def fit(docs: DataFrame, text_col: str, lang_col: str, key: Column | None = None, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS,
        with_pairs: bool = False, max_langs: int = MAX_LANGS, max_entries: int = MAX_ENTRIES) -> Model:
    """Count words and n-grams of all labelled rows (``key`` has no part in it: no row is drawn).

    Of each language the model holds the ``max_words`` words and ``max_grams`` n-grams counted most often in it
    (ties by text), and as many pairs of letters if ``with_pairs``; with so many languages that this makes more than
    ``max_entries``, an equal share of these each. So one language takes no place from another. Labels beyond the ``max_langs``
    with most rows (ties by name) are left out, so that a dirty label column cannot make the model grow without bound. Only these
    bounded tables reach the driver; no column or condition is made per language.
    """
    rows = labelled(docs, text_col, lang_col)
    most_rows = rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(max_langs).collect()
    langs = sorted(r["l"] for r in most_rows)
    if not langs:
        return Model([], {}, {})
    most_words, most_grams = (max(1, min(m, max_entries // len(langs))) for m in (max_words, max_grams))
    # at most max_langs rows: the hint is bounded
    few = F.broadcast(docs.sparkSession.createDataFrame([(x,) for x in langs], "l string"))
    # the outer form: the plain one would cut every text again in an inferred filter
    pieces = F.explode_outer(F.split(F.regexp_replace(F.lower("t"), r"[^\p{L}]+", " "), " ")).alias("w")
    words = written(rows.join(few, "l", "left_semi").select("l", pieces).where("w <> ''")
                    .groupBy("l", "w").agg(F.count(F.lit(1)).alias("n")), "words")
    grams = written(words.select("l", "w", "n").mapInArrow(_gram_counts, "l string, w string, n long")
                    .groupBy("l", "w").agg(F.sum("n").alias("n")), "grams")
    (known, no_word), (parts, _) = _frequencies(words, langs, most_words), _frequencies(grams, langs, most_grams)
    model = Model(langs, known, parts, no_word)
    if with_pairs:
        pair = F.transform(F.sequence(F.lit(1), F.greatest(F.length("w") - 1, F.lit(1))), lambda i: F.substr("w", i, F.lit(2)))
        pairs = written(words.where(F.col("w").rlike(UNSPACED)).select("l", "n", F.explode(pair).alias("w"))
                        .groupBy("l", "w").agg(F.sum("n").alias("n")), "pairs")
        model.pairs, model.no_pair = _frequencies(pairs, langs, most_grams)
    return model


def _frequencies(counts: DataFrame, langs: list[str], most: int) -> tuple[Mapping | Entries, np.ndarray | float]:
    """Smoothed log frequencies of the entries counted most often in some language, and that of no count by language."""
    order = [F.desc("n"), F.col("w")]
    # every part's first entries, then the first of those: no task ranks all entries of a language
    for by in (["l", F.pmod(F.xxhash64("w"), F.lit(RANK_PARTS))], ["l"]):
        first = (counts if len(by) > 1 else first).withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        first = first.where(F.col("r") <= most).drop("r")
    top = (counts.join(first.select("w").distinct(), "w", "left_semi").groupBy("w")
           .agg(F.collect_list(F.struct("l", "n")).alias("c")).collect())
    if not top:
        return {}, -np.inf
    number = {x: i for i, x in enumerate(langs)}
    made = Entries.counted(sorted((r["w"], sorted((number[x["l"]], x["n"]) for x in r["c"])) for r in top), len(langs))
    return made, made.base


def _codes(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@functools.cache
def _matched(pattern: regex.Pattern) -> np.ndarray:
    """Whether a match of ``pattern`` holds it, for every code point."""
    out = np.zeros(0x110000, bool)
    for m in pattern.finditer(np.arange(len(out), dtype=np.uint32).tobytes().decode("utf-32-le", "surrogatepass")):
        out[m.start():m.end()] = True
    return out


def _end_to_end(words: list[str], head: str = "", tail: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, and of each place its word and how many places of that word are left, itself included."""
    codes = _codes("".join([f"{head}{w}{tail}" for w in words]) if head or tail else "".join(words)).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + len(head) + len(tail)
    word = np.repeat(np.arange(len(words)), sizes)
    return codes, word, np.cumsum(sizes)[word] - np.arange(len(codes))


def _packed(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """One number for the ``n`` (at most 3) code points from each place: 21 bits each."""
    key = codes[at]
    for j in range(1, n):
        key = key << 21 | codes[at + j]
    return key


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(l, w, n): the n-grams of counted words, added up over as many words as are cut at once."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(1).nbytes
        if size >= WORD_BYTES_AT_ONCE:
            yield from _grams_of(pa.Table.from_batches(held))
            held, size = [], 0
    if held:
        yield from _grams_of(pa.Table.from_batches(held))


def _grams_of(words: pa.Table) -> Iterator[pa.RecordBatch]:
    for label in words.column(0).unique().to_pylist():
        of = words.filter(pc.equal(words.column(0), label))
        codes, word, left = _end_to_end(of.column(1).to_pylist(), "^", "$")
        count = of.column(2).to_numpy()
        two = np.flatnonzero(left >= 2)
        pair = np.zeros(len(codes), np.int64)
        pair[two] = np.unique(_packed(codes, two, 2), return_inverse=True)[1]
        for n in ORDERS:
            at = np.flatnonzero(left >= n)
            # four code points do not fit into one number, the numbers of two pairs do
            key = pair[at] << 32 | pair[at + 2] if n == 4 else _packed(codes, at, n)
            _, first, same = np.unique(key, return_index=True, return_inverse=True)
            sums = np.zeros(len(first), np.int64)
            np.add.at(sums, same, count[word[at]])
            cut = codes[at[first][:, None] + np.arange(n)].astype(np.uint32)
            grams = np.ascontiguousarray(cut).view(f"<U{n}").ravel().tolist()
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(sums)],
                                             names=["l", "w", "n"])


def _place(of: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in sorted keys, or -1."""
    if not len(of):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(of, keys), len(of) - 1)
    return np.where(of[at] == keys, at, -1)


class _Grams:
    """Looks up the n-grams of ``entries`` by code points, many at once."""

    def __init__(self, entries: Entries):
        names = entries.names.to_pylist()
        self.pairs, self.keys = np.zeros(0, np.int64), {}
        for n in ORDERS:
            which = np.array([i for i, w in enumerate(names) if len(w) == n], np.int64)
            codes = _codes("".join(names[i] for i in which)).astype(np.int64)
            if n == 4:
                self.pairs = np.unique(_packed(codes, np.arange(0, len(codes), 2), 2))
            keys = self.keys_of(codes, np.arange(0, len(codes), n), n)
            order = np.argsort(keys)
            self.keys[n] = keys[order], which[order]

    def keys_of(self, codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        if n < 4:
            return _packed(codes, at, n)
        if not len(at):
            return at
        pair = _place(self.pairs, codes[:-1] << 21 | codes[1:])
        head, tail = pair[at], pair[at + 2]
        return np.where((head < 0) | (tail < 0), -1, head << 32 | tail)

    def find(self, codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """The entry of the ``n`` code points from each place, or -1."""
        keys, which = self.keys[n]
        found = _place(keys, self.keys_of(codes, at, n))
        return np.where(found < 0, -1, which[found]) if len(which) else found


class _Scores:
    """Scores of texts in every language: different words are looked up once for many texts.

    With ``known``, the share of a text's words known in its best language as well. Nothing is remembered from one lot of
    texts to the next, so memory is bounded by the lot and the model.
    """

    def __init__(self, model: Model, known: bool = False):
        self.langs, self.k, self.known = model.langs, len(model.langs), known
        self.words, self.grams, self.pairs = (Entries.spelled(x, self.k) for x in (model.words, model.grams, model.pairs))
        self.no_word, self.no_pair = (np.broadcast_to(x, self.k) + 0.5 for x in (model.no_word, model.no_pair))
        self.in_grams, self.in_pairs = _Grams(self.grams), _Grams(self.pairs)

    def word(self, w: str) -> tuple[float, ...]:
        """Scores of one word."""
        found = _Found(self, pa.array([w]))
        return tuple(float(found.scores(i)[0]) for i in range(self.k))

    def texts(self, texts: list[str]) -> list[tuple[str, float, float]]:
        """Language, score and share of known words of each text."""
        words, text = _words(texts)
        if not self.k or not len(words):
            return [(UNDETERMINED, 0.0, 0.0)] * len(texts)
        n = np.bincount(text, minlength=len(texts))
        words = words.dictionary_encode()
        which, found = words.indices.to_numpy(), _Found(self, words.dictionary)
        sums = np.stack([np.bincount(text, found.scores(i)[which], len(texts)) for i in range(self.k)], 1)
        best = sums.argmax(1)
        share = 1 / np.exp(np.minimum(sums - sums.max(1, keepdims=True), 0)).sum(1)
        known = np.zeros(len(texts))
        for i in np.unique(best[n > 0]) if self.known else ():
            own = np.flatnonzero(best[text] == i)
            known += np.bincount(text[own], found.met(i)[which[own]], len(texts))
        return [(self.langs[best[i]], round(float(share[i]), 6), round(float(known[i]) / m, 6)) if m else (UNDETERMINED, 0.0, 0.0)
                for i, m in enumerate(n.tolist())]


class _Found:
    """Different words, found among the entries of ``of``, or else their n-grams of the longest order that has any; columns by language."""

    def __init__(self, of: _Scores, words: pa.Array):
        self.of = of
        self.at = pc.index_in(words, value_set=of.words.names).fill_null(-1).to_numpy(zero_copy_only=False)
        self.unseen = np.flatnonzero(self.at < 0)
        unseen = words.take(pa.array(self.unseen)).to_pylist()
        codes, word, left = _end_to_end(unseen, "^", "$")
        still, hits = np.ones(len(unseen), bool), []
        for n in ORDERS:
            at = np.flatnonzero((left >= n) & still[word])
            found = of.in_grams.find(codes, at, n)
            hits.append((word[at[found >= 0]], found[found >= 0]))
            still[hits[-1][0]] = False
        self.hit_word, self.hit = (np.concatenate(x) for x in zip(*hits, strict=True))
        n = np.bincount(self.hit_word, minlength=len(unseen))
        self.scale = GRAM_WEIGHT * np.minimum(n, 8) / np.maximum(n, 1)
        if of.known:
            self.find_pairs(unseen)

    def find_pairs(self, unseen: list[str]) -> None:
        """Pairs of letters of words that hold letters of scripts written without blanks; a letter alone is looked up itself."""
        codes, word, left = _end_to_end(unseen)
        runs = np.bincount(word[_matched(_UNSPACED)[codes]], minlength=len(unseen)) > 0
        size = np.bincount(word, minlength=len(unseen))
        self.n_pairs = np.maximum(size - 1, 1)
        hits = []
        for n, cut in ((2, left >= 2), (1, size[word] == 1)):
            at = np.flatnonzero(cut & runs[word])
            found = self.of.in_pairs.find(codes, at, n)
            hits.append((word[at[found >= 0]], found[found >= 0]))
        self.pair_word, self.pair = (np.concatenate(x) for x in zip(*hits, strict=True))

    def scores(self, lang: int) -> np.ndarray:
        out = self.of.words.column(lang)[self.at] if len(self.of.words) else np.zeros(len(self.at))
        weights = self.of.grams.column(lang)[self.hit]
        out[self.unseen] = self.scale * np.bincount(self.hit_word, weights, len(self.unseen))
        return out

    def met(self, lang: int) -> np.ndarray:
        """Whether the words were met in a language; for a run of a script without blanks, the share of its pairs that were."""
        out = (self.of.words.column(lang) > self.of.no_word[lang])[self.at].astype(float) if len(self.of.words) else np.zeros(len(self.at))
        weights = self.of.pairs.column(lang)[self.pair] > self.of.no_pair[lang]
        out[self.unseen] = np.bincount(self.pair_word, weights, len(self.unseen)) / self.n_pairs
        return out


def _words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Lower-case runs of letters of all texts in their order, and the number of the text of each."""
    low = [t.lower() for t in texts]
    codes = _codes(" ".join(low))
    letter = _matched(_LETTERS)[codes]
    first = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]]))
    if not len(first):
        return pa.array([], pa.string()), first
    ends = np.cumsum([len(t) + 1 for t in low])
    blank = np.where(letter, codes, np.uint32(32)).tobytes().decode("utf-32-le").strip()
    return pc.ascii_split_whitespace(pa.array([blank])).values, np.searchsorted(ends, first, "right")


def _lots(texts: list[str]) -> Iterator[list[str]]:
    """Texts in lots of ``CHARS_AT_ONCE`` characters or one text more."""
    lot, size = [], 0
    for t in texts:
        lot.append(t)
        size += len(t)
        if size >= CHARS_AT_ONCE:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None,
            with_known: bool = False) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the columns in ``carry`` (all, if None), from the whole text alone.

    Each word known to the model adds its log frequency in every language, an
    unseen word the log frequencies of its longest known n-grams. ``score`` is
    the share of the best language in the softmax of these sums. Ties go to the
    first language by name; columns of the new names are replaced. ``und`` and 0 if the text is
    null or has no letter, or the model knows no language.

    The score runs to 1 with the length of the text, in whatever language it is. ``known``, added if
    ``with_known``, does not depend on length: the share of the words that were met in the best language
    (of a run in a script without blanks, the share of its pairs; the model has them if fitted ``with_pairs``).
    """
    fields = FIELDS + ([KNOWN] if with_known else [])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scores = _Scores(shared.value, with_known)

        def run(texts: pa.Array) -> list:
            rows = [r for lot in _lots([t or "" for t in texts.to_pylist()]) for r in scores.texts(lot)]
            return [[r[i] for r in rows] for i in range(len(fields))]
        return run

    return map_text(docs, text_col, fields, make, carry)


def least_known(held: DataFrame, model: Model, text_col: str, lang_col: str, key: Column | None, most: float,
                share: float = 0.4) -> dict[str, float]:
    """Language -> the ``known`` below which a text is not taken for that language.

    ``share`` of the median over all of the language's own held-out texts (as far as the model recognises them; ``key`` has no
    part in it), and ``most`` at most: a language of many forms, whose texts hold more unseen words,
    gets a lower bound, and wrong labels do not move it. A language without held-out texts has no entry.
    """
    met = predict(labelled(held, text_col, lang_col), model, "t", ["l"], with_known=True).where("lang_pred = l and lang_pred <> 'und'")
    rows = met.groupBy("l").agg(F.percentile_approx("known", 0.5, 10_000).alias("q")).collect()
    return {r["l"]: min(most, share * r["q"]) for r in rows}
