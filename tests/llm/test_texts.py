"""Quality rules, byte-pair encoding, language identification, packing."""

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from innsight.llm import bpe, langid, packing, quality
from innsight.llm.queries import QUERIES, held_out

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = "abcXYZ .,!?'\"\n\t0123é ÀßẞΣςİıǆ漢字\u3000\u00a0\u0085\u2028\x1c\x0b\x0c\x00\U0001f389éﬁ½²ªµº×÷\u200b\ufeff"
EDGE = ["<|endoftext|>", "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "it's I'LL don'T", "x" * 5000, "ab" * 400,
        "a\x0bb", "  ", "", "ΑΣ ΑΣΑ", "don't.’s", "a<|end oftext|>", " \u0301a b\u0301", "a  b\n\n c   ", "\t\t"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return EDGE + ["".join(rng.choice(ODD) for _ in range(rng.randrange(60))) for _ in range(n)]


# --- quality

def model_measures(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_measures_match_their_definition():
    rng = random.Random(5)
    texts = odd_texts(300, 1) + [None]
    texts += ["".join(rng.choice(["a", "b", "é", "|", "\u00a0"]) + rng.choice([" ", "\n", "\x0b", "  "]) for _ in range(rng.randrange(80)))
              for _ in range(400)]
    for t in texts:
        got = quality.judge(t)
        assert got[:5] == model_measures(t), repr(t)
        assert got[5] == (got[0] < 10 or 100 * got[4] > 20 * got[0])
        assert not (got[5] and got[6])


GOOD = "This is a plain line of prose that ends as it should, with a full stop."


@pytest.mark.parametrize("line, fails", [
    (GOOD, False), ("Read more", True), ("Home", True), ("Short heading", False), ("We use this site uses cookies notice", True),
    ("this line of prose has quite some words but no end at all", True), ("a | b | c | d | e.", True),
    ("SHOUTED WORDS ALL OVER THE LINE, NO END OF THEM!", True), ("buy### now### and%%% then$$$ again*** here.", True),
    ("this this this that that that with with with them. them.", True), ("same same same same same same same same other same.", True), ("He said: “Why not?”", False), ("Über die Brücke gehen wir, sagte sie.", False)])
def test_line_rules(line, fails):
    assert quality.line_fails(line, line.split()) is fails


def test_lines_go_first_then_documents(spark):
    schema = "doc_id long, text string, kept string, c0 int"
    second = "Another one follows here, unlike any other line above it."
    texts = [GOOD + "\nRead more\n" + second, GOOD + "\n" + "WORDS SHOUTED ALL AROUND HERE AND THERE! " * 9, None, "", GOOD]
    df = spark.createDataFrame([(i, t, "k", i) for i, t in enumerate(texts)] + [(4, GOOD, "k", 4)], schema)
    rows = {r["doc_id"]: r for r in quality.clean_documents(df).collect()}
    assert [rows[i]["kept"] for i in range(5)] == [True, False, False, False, True]
    assert rows[0]["clean_text"] == GOOD + "\n" + second and rows[0]["removed_chars"] == 8
    assert rows[4]["clean_text"] == GOOD and rows[2]["clean_text"] is None and rows[3]["c0"] == 3
    assert quality.clean_documents(df.limit(0)).count() == 0


CLEAN = {
    "fr": "Le train est parti à l'heure et les voyageurs ont lu leurs journaux.\nPlus tard, la pluie a cessé et chacun est rentré chez soi.",
    "de": "Der Zug fuhr pünktlich ab und die Reisenden lasen ihre Zeitungen.\nSpäter hörte der Regen auf und alle gingen nach Hause.",
    "es": "El tren salió a su hora y los viajeros leyeron sus periódicos.\nMás tarde dejó de llover y cada uno volvió a su casa.",
    "hi": "आज सुबह गाड़ी समय पर चली और सभी यात्री अपने अखबार पढ़ते रहे।\nशाम को बारिश रुक गई और सब लोग अपने घर लौट गए।",
    "ar": "هل غادر القطار في موعده هذا الصباح مع كل المسافرين إلى المدينة؟\nفي المساء توقف المطر وعاد الجميع إلى بيوتهم سيرا على الأقدام.",
    "ur": "آج صبح گاڑی وقت پر روانہ ہوئی اور سب مسافر اپنے اخبار پڑھتے رہے۔\nشام کو بارش رک گئی اور سب لوگ اپنے گھر واپس چلے گئے۔",
    "am": "ዛሬ ጠዋት ባቡሩ በሰዓቱ ተነሳ ሁሉም ተጓዦች ጋዜጣቸውን አነበቡ።\nማታ ዝናቡ ቆመ እና ሁሉም ሰው ወደ ቤቱ በእግሩ ተመለሰ።"}
PAGES = {
    "fr": "Accueil\nMentions légales\nTous droits réservés\nAccepter tous les cookies\nPolitique de confidentialité du site\nLire la suite",
    "de": "Startseite\nÜber uns\nAlle Rechte vorbehalten\nAlle Cookies akzeptieren\nDatenschutzerklärung lesen\nNutzungsbedingungen hier",
    "es": "Inicio\nAviso legal\nTodos los derechos reservados\nAceptar todas las cookies\nPolítica de privacidad\nLeer más"}


@pytest.mark.parametrize("lang", CLEAN)
def test_clean_text_of_any_language_stays(lang):
    got = quality.judge(CLEAN[lang])
    assert got[6] and got[7] == 0 and got[8] == CLEAN[lang]


@pytest.mark.parametrize("lang", PAGES)
def test_page_furniture_of_any_language_goes(lang):
    got = quality.judge(PAGES[lang])
    assert not got[6] and not got[8].strip()
    both = quality.judge(CLEAN[lang] + "\n" + "\n".join(PAGES[lang].split("\n")[:2]))
    assert both[6] and both[8] == CLEAN[lang]


def test_quality_separates_labelled_documents(spark):
    got = {r["doc_id"]: r for r in QUERIES["op4_quality_rules"](spark, SF).collect()}
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert not any(got[i]["kept"] for i, q in labels if q == 0)
    assert all(got[i]["kept"] or got[i]["base_failed"] for i, q in labels if q == 1)


# --- byte-pair encoding

def test_encoding_is_the_library_s(spark):
    tok = Tokenizer.from_file(WORDS)
    texts = odd_texts(1500, 2) + [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    enc = bpe.Encoder(bpe.vocabulary(WORDS))
    for t, (ids, decoded) in zip(texts, enc.encode(texts), strict=True):
        want = tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(t)
        assert decoded == tok.decode(want, skip_special_tokens=False)


def test_rank_array_and_heap_agree():
    v, rng = bpe.vocabulary(WORDS), random.Random(3)
    words = ["".join(rng.choice("aeinorst") for _ in range(rng.randrange(1, 60))).encode() for _ in range(300)]
    merged = v.merge(words)
    for w in words:
        ids = v._merge_long(w)
        assert merged[w] == (ids.astype("<u4").tobytes(), bpe.decode(ids.tolist(), v))


def test_bounded_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    enc, texts = bpe.Encoder(bpe.vocabulary(WORDS)), ["one two three four five", "two six", "one seven"]
    assert [enc.encode([t])[0] for t in texts] == bpe.Encoder(bpe.vocabulary(WORDS)).encode(texts)


def test_encoded_table(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "a b", 7), (3, "a b", 7), (4, "w" * 100_000, 8)], "doc_id long, text string, ids int")
    rows = bpe.encode_texts(df, WORDS).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in rows)[:4] == [(1, 0), (2, 0), (3, 2), (3, 2)]
    assert all(r["ids_sha256"] == hashlib.sha256(r["ids"]).hexdigest() for r in rows)
    assert [r["decoded_sha256"] for r in rows if r["doc_id"] < 3] == [empty, empty]
    assert bpe.encode_texts(df.limit(0), WORDS).count() == 0


# --- language

def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_language_id"](spark, SF).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_scorer(docs):
    """Word-first backoff over whole texts, from counts of all labelled texts; no table is cut."""
    langs = sorted({d["lang"] for d in docs if d["text"] is not None and d["lang"] is not None})
    words, grams = {x: Counter() for x in langs}, {x: Counter() for x in langs}
    for d in docs:
        if d["text"] is not None and d["lang"] is not None:
            words[d["lang"]].update(regex.findall(r"\p{L}+", d["text"].lower()))
    cut = lambda w, n: [f"^{w}$"[i:i + n] for i in range(len(w) + 3 - n)]
    for x in langs:
        for w, c in words[x].items():
            for n in (1, 2, 3, 4):
                for g in cut(w, n):
                    grams[x][g] += c

    def logs(counts):
        every = {e for c in counts.values() for e in c}
        total = [sum(counts[x].values()) + 0.1 * len(every) for x in langs]
        return {e: np.array([np.log((counts[x][e] + 0.1) / t) for x, t in zip(langs, total)]) for e in every}
    words, grams = logs(words), logs(grams)

    def score(text):
        found = regex.findall(r"\p{L}+", (text or "").lower())
        if not found:
            return "und", 0.0
        sums = np.zeros(len(langs))
        for w in found:
            if w in words:
                sums += words[w]
                continue
            for n in (4, 3, 2, 1):
                hits = [grams[g] for g in cut(w, n) if g in grams]
                if hits:
                    sums += 0.5 * min(len(hits), 8) / len(hits) * sum(hits)
                    break
        best = int(np.argmax(sums))
        return langs[best], float(1 / np.exp(sums - sums[best]).sum())
    return score


def test_whole_texts_against_a_plain_scorer(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    score = plain_scorer([d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 4 != 2])
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.fit(frame.where(~held_out()), "text", "lang", F.col("doc_id"), max_words=10**6, max_grams=10**6, max_entries=10**7)
    mixed = [(d["doc_id"] + 10**6, " ".join(w[::-1] for w in d["text"].split()[:30])) for d in docs if d["text"]]  # mostly unseen words
    rows = langid.predict(frame.select("doc_id", "text").union(spark.createDataFrame(mixed, "doc_id long, text string")), model).collect()
    assert len(rows) == len(docs) + len(mixed)
    for r in rows:
        lang, share = score(r["text"])
        assert (r["lang_pred"], round(share, 5)) == (lang, pytest.approx(r["score"], abs=2e-5)), r["doc_id"]


def test_no_language_takes_another_s_place(spark):
    """A language with few texts keeps its own most frequent words; labels beyond the bound are not learnt."""
    rng = random.Random(2)
    word = lambda a: "".join(rng.choice(a) for _ in range(7))
    rows = [(i, " ".join(word("abcdef") for _ in range(40)), "aa") for i in range(200)]
    rows += [(1000 + i, "uvw xyz uvx", "zz") for i in range(3)] + [(2000, "lone", "only")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, "text", "lang", F.col("doc_id"), max_words=20, max_grams=30, max_langs=2)
    assert model.langs == ["aa", "zz"] and len(model.words) == 23 and model.words.get("lone") is None
    assert all(model.words.get(w)[1] > model.no_word[1] for w in ("uvw", "xyz", "uvx"))
    assert len(langid.fit(df, "text", "lang", F.col("doc_id"), max_words=20, max_entries=6, max_langs=2).words) == 6


def test_every_labelled_row_is_counted(spark):
    """Counts of the model and the bounds by language come from all rows, however many a language has."""
    rows = [(i, f"common w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "aa") for i in range(5_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, "text", "lang", F.col("doc_id"))
    assert len(model.words) == 5_001
    total = math.log(10_000 + 0.1 * 5_001)
    assert model.words.get("common")[0] == pytest.approx(math.log(5_000.1) - total)
    n = 1_501
    held = [(i, " ".join(["common"] * i + ["zzz"] * (n - i)), "aa") for i in range(n)]
    got = langid.least_known(spark.createDataFrame(held, df.schema), model, "text", "lang", F.col("doc_id"), 1.0)
    assert got == {"aa": pytest.approx(0.4 * round(750 / n, 6))}


def test_a_column_of_very_many_labels(spark):
    df = spark.range(5_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), "id").alias("text"),
                                   F.concat(F.lit("label"), F.col("id")).alias("lang"))
    model = langid.fit(df, "text", "lang", F.col("doc_id"))
    assert len(model.langs) == langid.MAX_LANGS and len(model.words) <= langid.MAX_ENTRIES
    assert langid.predict(df.limit(50), model, "text", ["doc_id"]).where("score between 0 and 1").count() == 50


def test_words_first_then_shorter_grams(spark):
    m = langid.Model(["a", "b"], {"known": np.array([0.0, -5.0])},
                     {"^unk": np.array([-1.0, -2.0]), "^u": np.array([-9.0, -1.0]), "z": np.array([-3.0, -1.0])})
    s = langid._Scores(m)
    assert s.word("known") == (0.0, -5.0)
    assert s.word("unkno") == pytest.approx(langid.GRAM_WEIGHT * np.array([-1.0, -2.0]))  # 4-grams are known
    assert s.word("uz") == pytest.approx(langid.GRAM_WEIGHT * np.array([-9.0, -1.0]))  # only a 2-gram is
    assert s.word("xz") == pytest.approx(langid.GRAM_WEIGHT * np.array([-3.0, -1.0]))
    assert s.word("qq") == (0.0, 0.0)
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 ..", "x"), (4, "known known", "x"), (5, "known", None), (6, "漢字", "x"),
                                (7, "known " * 100_000, "x")], "doc_id long, text string, score string")
    rows = {r["doc_id"]: r for r in langid.predict(df, m).collect()}
    assert [rows[i]["lang_pred"] for i in range(1, 8)] == ["und", "und", "und", "a", "a", "a", "a"]
    assert rows[3]["score"] == 0 and rows[6]["score"] == 0.5 and rows[7]["score"] == 1
    assert langid.predict(df.limit(0), m).count() == 0


def test_n_grams_are_cut_once_and_counted_whole(spark, monkeypatch):
    """Counts that two readers share are stored, and n-grams of any code points are counted apart."""
    texts = [("ab abc", "x"), ("ab \U00010400\U00010401\U00020000 é漢字", "x"), ("ab é", "y"), ("abc" * 50, "y")] * 3
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(texts)], "doc_id long, text string, lang string")
    seen, plain = [], langid._frequencies
    monkeypatch.setattr(langid, "_frequencies", lambda counts, *a: (seen.append(counts), plain(counts, *a))[1])
    langid.fit(df, "text", "lang", with_pairs=True)
    for counts in seen:
        plan = counts._jdf.queryExecution().optimizedPlan().toString()
        assert "Relation" in plan and not any(x in plan for x in ("Generate", "Aggregate", "MapInArrow"))
    want = Counter()
    for text, lang in texts:
        for w in regex.findall(r"\p{L}+", text.lower()):
            want.update((lang, f"^{w}$"[i:i + n]) for n in (1, 2, 3, 4) for i in range(len(w) + 3 - n))
    assert len(seen) == 3 and {(r["l"], r["w"]): r["n"] for r in seen[1].collect()} == want


def test_workers_remember_no_words(spark, monkeypatch):
    """Memory of a worker does not grow with the different words it has met."""
    made = []
    monkeypatch.setattr(langid, "map_text", lambda docs, text_col, fields, make, carry: made.append(make))
    m = langid.Model(["a", "b"], {"known": np.array([0.0, -5.0])}, {x: np.array([-1.0, -2.0]) for x in "abcdefghij"})
    langid.predict(spark.range(0), m, with_known=True)
    run = made[0]()
    lot = lambda k: pa.array([" ".join(f"w{chr(97 + k)}" + "".join(chr(97 + int(c)) for c in str(i)) for i in range(20_000))] + ["known"])
    assert run(lot(0)) == [["a", "a"], [1.0, round(1 / (1 + math.exp(-5)), 6)], [0.0, 1.0]]
    tracemalloc.start()
    for k in range(1, 4):
        run(lot(k))
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 1_000_000


def test_fit_of_odd_tables(spark):
    df = spark.createDataFrame([(1, None, "en"), (2, "some words here", None), (None, "", "en")], "doc_id long, text string, lang string")
    model = langid.fit(df, "text", "lang", F.col("doc_id"))
    assert model.langs == ["en"] and not model.words
    assert langid.fit(df.limit(0), "text", "lang", F.col("doc_id")).langs == []
    assert langid.predict(df, langid.fit(df.limit(0), "text", "lang", F.col("doc_id"))).where("lang_pred <> 'und'").count() == 0


# --- packing

def check_packing(rows, texts, end=1, capacity=2048):
    """Every id in one piece, sequences gapless; the share of padding."""
    tok = Tokenizer.from_file(BYTES)
    pieces, seqs = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    tokens = 0
    for i, ps in pieces.items():
        ids = np.array([*tok.encode(texts[i] or "", add_special_tokens=False).ids, end], "<u4")
        at = 0
        for p in sorted(ps, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
        tokens += at
    padding = 0
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / (tokens + padding)


def test_all_documents_packed(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert check_packing(QUERIES["op9_packing"](spark, SF).collect(), docs) < 0.02


def test_packing_over_many_workers(spark):
    texts = dict(enumerate(odd_texts(300, 4) + [None, "word " * 30_000]))
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, offset int").repartition(7)
    rows = packing.pack(df, BYTES, 1, with_ids=True).collect()
    assert check_packing(rows, texts) < 0.05
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    assert packing.pack(df.limit(0), BYTES, 1).count() == 0


def test_repeated_rows_are_packed_each(spark):
    rows = packing.pack(spark.createDataFrame([(1, "a b c")] * 9, "doc_id long, text string"), BYTES, 1).collect()
    assert len(rows) == 9 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 9


def test_cuts():
    for n in [*range(1, 3000), 100_000]:
        cuts = packing.cut_lengths(n, 2048)
        assert sum(cuts) == n and len(cuts) <= n // 2048 + 5
        assert all(2048 / (2048 // c) - c <= max(packing.MAX_WASTE, 1) for c in cuts)


def test_both_encoders_agree():
    tok = Tokenizer.from_file(BYTES)
    for t in odd_texts(1500, 6) + [" \n  a\t b  \r\n\r\n", "“quoted” – text…", "\x00\x01a\x1b b"]:
        assert packing.token_ids(t, BYTES).tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
