"""Jaccard join, components, nearest neighbours, pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from innsight.llm import jaccard, langid, neighbours
from innsight.operators.components import components
from innsight.llm.queries import QUERIES, held_out
from innsight.llm.quality import judge
from tests.llm.test_texts import check_packing

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- Jaccard join

def word_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().split()
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def model_links(texts):
    """(linked texts of each text, component of each text) by brute force over shared 5-grams."""
    sets, holders, links = word_sets(texts), defaultdict(list), defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j != i).items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[i].add(j)
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, js in links.items():
        for j in js:
            root[find(i)] = find(j)
    return [links[i] for i in range(len(texts))], [find(i) for i in range(len(texts))], sets


def model_classes(rows):
    """doc_id -> (least doc_id of its group, links)."""
    texts = sorted({t for _, t in rows if t is not None})
    at = {t: i for i, t in enumerate(texts)}
    links, root, sets = model_links(texts)
    least = {}
    for i, t in rows:
        if t is not None and sets[at[t]]:
            r = root[at[t]]
            least[r] = min(least.get(r, i), i)
    return {i: (least[root[at[t]]], len(links[at[t]])) if t is not None and sets[at[t]] else (i, 0) for i, t in rows}


def near_copies(rng, n, words=60):
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(words)] = f"e{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def check_classes(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.link_documents(df).collect()}
    want = model_classes(rows)
    assert got == want, {k: (got.get(k), v) for k, v in want.items() if got.get(k) != v}


def test_given_documents(spark):
    check_classes(spark, [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()])


@pytest.mark.parametrize("limit, block, alike", [(256, 768, 0.6), (8, 16, 0.6), (8, 16, 2.0)])
def test_large_groups_lose_no_link(spark, monkeypatch, limit, block, alike):
    """Buckets split, and near copies compared in many blocks; the last case splits them as often as allowed."""
    monkeypatch.setattr(jaccard, "BRUTE_FORCE", limit)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "ALIKE", alike)
    monkeypatch.setattr(jaccard, "MOST_SPLITS", 3)
    rng = random.Random(limit)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = near_copies(rng, 70) + near_copies(rng, 20) + near_copies(rng, 6, 12)
    texts += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) for _ in range(40)]
    texts += ["a b", "a b", "a  b", "b a", "one", " ", "", None, None, "x " * 50_000, "x " * 49_999]
    check_classes(spark, list(enumerate(texts)))


def test_runs_follow_the_target():
    assert jaccard.runs_needed(0.9) < jaccard.runs_needed(0.9999) == 4


def test_one_of_each_group_stays(spark):
    rng = random.Random(9)
    copies = near_copies(rng, 5, 200)
    data = [(7, copies[0], "td"), (3, copies[1], "td"), (3, copies[1], "td"), (None, copies[0], "x"), (9, "alone here", None), (9, "alone here", None),
            (None, "no key", "k"), (None, None, "n"), (5, "", "e"), (5, "", "e"), (8, copies[2], "root")]
    df = spark.createDataFrame(data, "doc_id long, text string, td string")
    out = jaccard.drop_near_duplicates(df)
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == sorted([(3, copies[1], "td"), (9, "alone here", None), (None, "no key", "k"), (None, None, "n"), (5, "", "e"), (5, "", "e")], key=repr)
    assert jaccard.drop_near_duplicates(df.limit(0)).count() == 0
    assert jaccard.link_documents(df.limit(0)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (5, 5), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- nearest neighbours

def model_nearest(rows, every, top=10):
    out = {}
    for q, v in rows:
        if q % every:
            continue
        near = sorted({(float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), i) for i, w in rows if i != q})
        best = {}
        for d, i in near:
            best.setdefault(i, d)
        out.setdefault(q, {}).update({i: min(d, out.get(q, {}).get(i, d)) for i, d in best.items()})
    return {q: sorted(((d, i) for i, d in x.items()))[:top] for q, x in out.items()}


def search(spark, rows, every, schema="vec_id long, embedding array<float>"):
    df = spark.createDataFrame(rows, schema)
    got = defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id"), F.col("embedding"), F.col("vec_id") % every == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    return dict(got)


def recall(got, want):
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / len(want[q]) for q in want])


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).round(2).tolist()) for i in range(30)]
    rows += [(40 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(25)] + [(20, [1.0, 1.0, 1.0, 1.0]), (3, rows[3][1])]
    odd = [(60, None), (61, [0.0] * 4), (62, [float("nan")] * 4), (63, [float("inf"), 1.0, 1.0, 1.0]), (64, [None, 1.0, 1.0, 1.0]), (65, [1.0]), (None, [1.0] * 4)]
    rows32 = [(i, np.float32(v).astype(float).tolist()) for i, v in rows]
    want = model_nearest(rows32, 20)
    got = search(spark, rows + odd, 20)
    assert {q: [i for _, i in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items()}
    assert all(abs(a - b) < 1e-12 for q in want for (a, _), (b, _) in zip(got[q], want[q], strict=True))
    assert search(spark, rows[:4], 2).keys() == {0, 2} and all(len(x) == 3 for x in search(spark, rows[:4], 2).values())
    assert search(spark, [], 2) == {} and search(spark, rows[:1], 2) == {} and search(spark, odd, 2) == {}


@pytest.mark.parametrize("most_probes", [4096, 1])
def test_index_beyond_its_sample(spark, monkeypatch, most_probes):
    """With a small sample the probes do the work; with too few probes allowed, all rows are compared in blocks."""
    monkeypatch.setattr(neighbours, "SAMPLE_ROWS", 300)
    monkeypatch.setattr(neighbours, "MOST_PROBES", most_probes)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 16))
    rows = [(i, np.float32(centres[i % 8] + 0.3 * rng.normal(size=16)).astype(float).tolist()) for i in range(2000)]
    r = recall(search(spark, rows, 25), model_nearest(rows, 25))
    assert r >= (0.9 if most_probes > 1 else 1.0)


def test_one_id_with_very_many_vectors(spark):
    """Ten ids come back, however many rows of one id are nearer than the others."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=8)
    rows = [(0, base.tolist())] + [(1, (base + rng.normal(size=8) * 0.001).tolist()) for _ in range(39)]
    rows += [(i, (base + rng.normal(size=8) * (0.1 + i / 50)).tolist()) for i in range(2, 60)]
    got = search(spark, rows, 100, "vec_id long, embedding array<double>")
    d = {}
    for i, v in rows[1:]:
        d[i] = min(d.get(i, np.inf), float(np.sqrt(((base - np.array(v)) ** 2).sum())))
    assert [i for _, i in got[0]] == sorted(d, key=lambda i: (d[i], i))[:10]


def test_given_embeddings(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = defaultdict(list)
    for r in QUERIES["op10_nearest_neighbours"](spark, SF).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    assert recall(got, model_nearest(rows, 100)) >= 0.9


def test_probes_come_in_order_of_cost():
    cells, place = np.zeros(3, np.int64), np.array([0.1, 0.6, 0.95])
    got = neighbours.probe_cells(cells, place, 27)
    cost = [sum(place[i] ** 2 if c < 0 else (1 - place[i]) ** 2 for i, c in enumerate(x) if c) for x in got.tolist()]
    assert cost == sorted(cost) and len({tuple(x) for x in got.tolist()}) == len(got) == 27


# --- pipeline

def plain_known(docs, languages):
    """doc_id -> share of its words that other, not held-out documents of its predicted language hold; and the bound by language."""
    held = {d["doc_id"] for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2}
    words = {d["doc_id"]: regex.findall(r"\p{L}+", (d["text"] or "").lower()) for d in docs}
    met = defaultdict(set)
    for d in docs:
        if d["doc_id"] not in held and d["lang"] is not None:
            met[d["lang"]].update(words[d["doc_id"]])
    pred = {i: r["lang_pred"] for i, r in languages.items()}
    known = {i: round(sum(w in met[pred[i]] for w in ws) / len(ws), 6) if ws else 0.0 for i, ws in words.items()}
    own = defaultdict(list)
    for d in docs:
        if d["doc_id"] in held and pred[d["doc_id"]] == d["lang"]:
            own[d["lang"]].append(known[d["doc_id"]])
    return known, {x: min(corpus_pipeline.LEAST_KNOWN, 0.4 * sorted(v)[math.ceil(0.5 * len(v)) - 1]) for x, v in own.items()}


def test_bounds_follow_held_out_documents(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    # a language whose held-out texts hold mostly unseen words
    more = [(i, " ".join(f"{'xyz'[i % 3] if j % 6 else 'kept'}{chr(97 + j % 26)}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" if j % 6 else "kept"
                         for j in range(30)), "qq", "s", 100) for i in range(9000, 9100)]
    frame = spark.createDataFrame([tuple(d.values()) for d in docs] + more, spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    docs += [dict(zip(docs[0], r)) for r in more]
    train = frame.where(~F.coalesce(held_out(), F.lit(False)))
    model = langid.fit(train, "text", "lang", F.col("doc_id"), with_pairs=True)
    languages = {r["doc_id"]: r for r in langid.predict(frame.select("doc_id", "text"), model, with_known=True).collect()}
    known, least = plain_known(docs, languages)
    assert all(r["known"] == pytest.approx(known[i], abs=1e-6) for i, r in languages.items())
    got = langid.least_known(frame.where(held_out()), model, "text", "lang", F.col("doc_id"), corpus_pipeline.LEAST_KNOWN)
    assert got == pytest.approx(least) and got["qq"] < 0.2 and got["en"] <= 0.3
    left = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, frame, SMALL).collect()}
    assert {r[0] for r in more} <= left


def test_pipeline_against_a_model(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    languages = {r["doc_id"]: r for r in QUERIES["op8_language_id"](spark, SMALL).collect()}
    kept = {}
    known, least = plain_known(docs, languages)
    for d in docs:
        r = languages[d["doc_id"]]
        j = judge(d["text"])
        if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_SCORE and known[d["doc_id"]] >= least[r["lang_pred"]] and j[6]:
            kept[d["doc_id"]] = j[8]
    classes = model_classes(list(kept.items()))
    kept = {i: t for i, t in kept.items() if classes[i][0] == i}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert check_packing(rows, kept) < 0.1
    assert len(kept) < len(docs)


FOREIGN = {
    "it": "Il governo ha annunciato ieri una nuova serie di misure per sostenere le famiglie e le piccole imprese che negli ultimi "
          "mesi hanno dovuto affrontare costi molto alti, mentre la gente aspetta ancora una risposta chiara dal ministro. ",
    "pt": "O governo anunciou ontem uma nova série de medidas para apoiar as famílias e as pequenas empresas que nos últimos meses "
          "tiveram de enfrentar custos de energia muito altos, enquanto as pessoas ainda esperam uma resposta do ministro. ",
    "nl": "De regering heeft gisteren een nieuwe reeks maatregelen aangekondigd om gezinnen en kleine bedrijven te steunen die de "
          "afgelopen maanden met zeer hoge energiekosten te maken kregen, terwijl de mensen nog steeds wachten. ",
    "fi": "Hallitus ilmoitti eilen uusista toimista joilla tuetaan perheitä ja pieniä yrityksiä jotka ovat viime kuukausina "
          "joutuneet maksamaan erittäin korkeita energiakustannuksia. "}


def test_long_foreign_and_noise_texts_have_no_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(5)
    noise = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(1, 11))) for _ in range(50)) for _ in range(50)]
    texts = [t * n for t in FOREIGN.values() for n in (1, 20)] + noise
    held = [i for i in range(10**6, 10**6 + 1000) if zlib.crc32(str(i).encode()) % 4 == 2]
    more = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in zip(held, texts, strict=False)], docs.schema)
    left = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs.unionByName(more), SF).collect()}
    assert len(texts) <= len(held) and not left & set(held)
    clean = {r["doc_id"] for r in docs.where("length(text) > 0").collect()}
    assert len(clean - left) <= 1 and clean


def test_scripts_without_blanks_are_known_by_pairs(spark):
    zh, ja = "政府昨天宣布了一系列新的措施以支持家庭和小企业", "彼らはまだ大臣の明確な答えを待っています"
    df = spark.createDataFrame([(1, zh, "zh"), (2, "some plain words", "en")], "doc_id long, text string, lang string")
    model = langid.fit(df, "text", "lang", F.col("doc_id"), with_pairs=True)
    asked = spark.createDataFrame([(1, "昨天宣布了新的措施"), (2, ja), (3, "plain words 12 some other")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in langid.predict(asked, model, with_known=True).collect()}
    assert rows[1]["lang_pred"] == "zh" and rows[1]["known"] > 0.7 and rows[2]["known"] < 0.1
    assert (rows[3]["lang_pred"], rows[3]["known"]) == ("en", 0.75)


def test_stages_take_odd_rows(spark):
    text = "This is a plain line of prose that ends as it should, with a full stop, number {}."
    data = [(i, text.format(" ".join(f"n{i}{j}" for j in range(20))), "en", "s", 1, True) for i in range(6)]
    data += [data[0], (None, None, None, None, None, None), (50, "", "en", None, 0, False), (51, text.format("x"), None, None, None, None),
             (52, "漢字 漢字", "en", "s", 5, True), (53, text.format(" ".join(f"y{j}" for j in range(60_000))), "en", "s", 1, True)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, kept boolean")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SMALL)
        assert stage(spark, df.limit(0), SMALL).count() == 0, name
        if name != "packing":
            assert out.columns == df.columns
            rows = out.collect()
            assert {r["doc_id"] for r in rows} >= {0, 1, 2, 3, 4, 5, 53}, name
            assert all(tuple(r) in data for r in rows), name
        else:
            assert {r["doc_id"] for r in out.collect()} == {r[0] for r in data}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "jaccard_join", "packing"]
