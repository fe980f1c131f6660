"""Golden cases: table rows -> rooms, review pages, upsert, completeness, stream = batch."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.functions import parse as PZ
from innsight.operators import extract as X
from innsight.operators import incremental as I
from innsight.streaming import streams as ST
from innsight.session import scratch_path

ROW_SCHEMA = "page_id long, pos int, has_cell boolean, is_last boolean, roomtype string, occupancy int, price string"


def test_row_islands_cases(spark):
    rows = [
        (1, 0, False, False, None, 1, "a"),       # before the first cell: ignored
        (1, 1, True, False, "Suite", 2, "b"),
        (1, 2, True, False, "Deluxe", 2, "c"),    # second cell overwrites the type
        (1, 3, False, True, None, 3, "d"),        # closes the room
        (1, 4, False, True, None, 1, "e"),        # flag without a cell: nothing
        (1, 5, True, False, "Family", 4, "f"),
        (1, 6, False, False, None, 4, "g"),       # never closed: not written
        (2, 0, True, True, " Twin ", 2, "h"),     # cell and flag on one row
    ]
    df = spark.createDataFrame(rows, ROW_SCHEMA)
    out = {(r["page_id"], r["room"]): r for r in X.row_islands(df).collect()}
    assert set(out) == {(1, 0), (2, 0)}
    assert out[(1, 0)]["roomtype"] == "Deluxe"
    assert [a["price"] for a in out[(1, 0)]["availables"]] == ["b", "c", "d"]
    assert out[(2, 0)]["roomtype"] == "Twin"


def test_review_page_expand_totals(spark):
    df = spark.createDataFrame([(1, 0), (2, 24), (3, 25), (4, 26), (5, None)], "h int, total int")
    got = {}
    for r in X.review_page_expand(df).collect():
        got.setdefault(r["h"], []).append(r["offset"])
    assert got == {1: [0], 2: [0], 3: [0, 25], 4: [0, 25]}


def test_room_text_extract(spark):
    txt = "18.0 m²\nVòi Tắm Đứng\nTủ Lạnh\nXem chi tiết phòng\n850.000 VND\n1.050.000 VND\n2 khách"
    df = spark.createDataFrame([(txt,), ("no size 12 VND",)], "text string")
    r = X.room_text_extract(df).collect()
    assert r[0]["roomsize"] == 18.0 and list(r[0]["facilities"]) == ["Vòi Tắm Đứng", "Tủ Lạnh"]
    assert r[0]["price"] == "1.050.000" and r[0]["price_vnd"] == 1050000
    assert r[1]["roomsize"] is None and r[1]["facilities"] is None and r[1]["price"] == "12"


def test_zip_shortest_and_text_join(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["x"], [" n/a ", "Good "])], "a array<string>, b array<string>, p array<string>")
    r = df.select(X.zip_shortest(F.col("a"), F.col("b")).alias("z"), X.review_text_join(F.col("p")).alias("j"),
                  X.review_text_join(F.col("p"), drop_fillers=True).alias("k")).first()
    assert [(x["a"], x["b"]) for x in r["z"]] == [("a", "x")]
    assert r["j"] == "n/a. Good" and r["k"] == "Good"


def test_embedded_json_invalid_is_skipped(spark):
    good = ('<script id="__NEXT_DATA__" type="application/json"> {"props": {"pageProps": {"hotel": {"address": "A",'
            ' "userRating": 8.5, "assets": [{"url": "u1"}, {"url": "u2"}]}, "reviewSummary": {"reviewList": '
            '[{"timestamp": 1700000000000, "reviewerName": "n", "overallScore": 9, "reviewText": "t"}]}}}} </script>')
    bad = '<script id="__NEXT_DATA__">{"props": {</script>'
    df = spark.createDataFrame([(1, good), (2, bad), (3, "<html></html>")], "page_id long, html string")
    p = X.embedded_json(df)
    rows = p.collect()
    assert [r["page_id"] for r in rows] == [1]
    assert rows[0]["address"] == "A" and list(rows[0]["images"]) == ["u1", "u2"] and list(rows[0]["property_highlights"]) == []
    rv = X.reviews_explode(p).collect()
    assert len(rv) == 1 and str(rv[0]["review_date"]) == "2023-11-14"


def test_keyed_upsert_idempotent(spark):
    base = spark.createDataFrame([(1, "a", None, None), (2, "b", "x", "y")], "id long, lang string, sentiment string, label string")
    up = spark.createDataFrame([(2, "pos", "loc"), (3, "neg", "host")], "id long, sentiment string, label string")
    once = I.keyed_upsert(base, up, "id", ["sentiment", "label"])
    twice = I.keyed_upsert(once, up, "id", ["sentiment", "label"])
    a = sorted(map(tuple, once.collect()))
    assert a == sorted(map(tuple, twice.collect()))
    assert a == [(1, "a", None, None), (2, "b", "pos", "loc"), (3, None, "neg", "host")]


def test_complete_homes_and_stream_equal(spark):
    homes = spark.createDataFrame([(1, 0), (2, 3), (3, 2), (4, None)], "home long, announced long")
    arr = spark.createDataFrame([(2,), (2,), (2,), (3,)], "home long")
    batch = {r["home"]: r["released"] for r in I.complete_homes(homes, arr, "home").collect()}
    assert batch == {1: True, 2: True, 3: False, 4: True}
    # stream: pages in any order, each with its review count
    pages = spark.createDataFrame([(2, 3, 1, 1), (1, 0, 0, 0), (3, 2, 0, 1), (2, 3, 0, 2)],
                                  "home long, announced long, page long, n_reviews long")
    src = scratch_path(spark, "test-pages")
    pages.repartition(4).write.mode("overwrite").parquet(src)
    schema = T.StructType([T.StructField("home", T.LongType()), T.StructField("announced", T.LongType()),
                           T.StructField("page", T.LongType()), T.StructField("n_reviews", T.LongType())])
    released = {r["home"] for r in ST.stream_complete_homes(spark, src, schema, max_files=1).collect()}
    assert released == {h for h, ok in batch.items() if ok and h != 4}


def test_frontier_encoding(spark):
    df = spark.createDataFrame([("Ho Chi Minh ~*",)], "en string")
    r = X.crawl_frontier(df, "2024-02-28").first()
    assert "ss=Ho+Chi+Minh+~%2A&checkin=2024-02-29&checkout=2024-03-01" in r["search_url"]
    assert r["search_url_2"].endswith("spec=29-02-2024.01-03-2024")


def test_expiring_stream_equals_plain_stream(spark):
    pages = spark.createDataFrame([(2, 3, 1, 1), (1, 0, 0, 0), (3, 2, 0, 1), (2, 3, 0, 2), (5, 4, 0, 1)],
                                  "home long, announced long, page long, n_reviews long")
    src = scratch_path(spark, "test-pages-ttl")
    pages.repartition(3).write.mode("overwrite").parquet(src)
    schema = T.StructType([T.StructField("home", T.LongType()), T.StructField("announced", T.LongType()),
                           T.StructField("page", T.LongType()), T.StructField("n_reviews", T.LongType())])
    plain = sorted(map(tuple, ST.stream_complete_homes(spark, src, schema, max_files=1).collect()))
    ttl = sorted(map(tuple, ST.stream_complete_homes_expiring(spark, src, schema, max_files=1).collect()))
    assert plain == ttl == [(1, 0, 0), (2, 3, 3)]


def test_card_price_and_rating(spark):
    df = spark.createDataFrame([("VND 509.259", "7,1"), ("509", None)], "p string, r string")
    got = df.select(X.card_price(F.col("p")).alias("p"), X.card_rating(F.col("r")).alias("r")).collect()
    assert (got[0]["p"], got[0]["r"]) == ("509.259", "7.1")
    assert (got[1]["p"], got[1]["r"]) == (None, None)


def test_entities_are_decoded_as_the_standard_library_does(spark):
    import html
    from html.entities import html5

    texts = ["C&agrave; ph&ecirc; &#225; &ndash; &#x27;", "&amp;amp;", "a & b &bogus; &;", "&#8364;&#x1F389;&#128;", "&NotEqualTilde;", "", "no entity"]
    texts += [f"<{'&' + k}>" for k in list(html5)[::23] if k.endswith(";")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts), None)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(X.decode_entities(F.col("t"))).collect()]
    assert got == [html.unescape(t) for t in texts] + [None]
    odd = spark.createDataFrame([("&#0;&#xD800;&#9999999;&copy &#x41",)], "t string").select(X.decode_entities(F.col("t"))).first()[0]
    assert odd == "���&copy &#x41"  # only what a semicolon closes


def test_json_is_parsed_once(spark):
    pages = spark.createDataFrame([(1, "<x>")], "page_id long, html string")
    for df in (X.embedded_json(pages).select("address", "rating"), X.reviews_explode(X.embedded_json(pages))):
        plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("parse_json(") + plan.count("parsejson(") <= 1, plan


def test_url_segment_of_tolerated_links(spark):
    urls = ["/hotel/vn/a b.vi.html", "https://x.example/hotel/vn/n{1}.html?q={|}", "https://x.example/hotel/vn/p.vi.html#f", "https://x.example", "", None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").orderBy("i")
    assert [r[0] for r in df.select(PZ.url_path_segment(F.col("u"))).collect()] == ["a b", "n{1}", "p", None, None, None]


def test_last_update_of_a_key_wins(spark):
    base = spark.createDataFrame([(1, "a", None)], "id long, lang string, label string")
    up = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (2, "z", 1), (2, "w", 1)], "id long, label string, at int")
    got = sorted(map(tuple, I.keyed_upsert(base, up, "id", ["label"], order="at").select("id", "lang", "label").collect()))
    assert got == [(1, "a", "x"), (2, None, "z")]


PAGES = "home long, announced long, page long, n_reviews long"


def _write_pages(spark, rows, path):
    spark.createDataFrame(rows, PAGES).coalesce(1).write.mode("append").parquet(path)


def test_release_stream_stops_and_resumes(spark):
    from innsight.session import scratch_path

    schema = spark.createDataFrame([], PAGES).schema
    for stream in (ST.stream_complete_homes, ST.stream_complete_homes_expiring):
        src, out, ckpt = (scratch_path(spark, n) for n in ("resume-pages", "resume-out", "resume-ckpt"))
        _write_pages(spark, [(1, 25, 0, 20), (2, None, 0, 3), (3, 10, 0, 10)], src)
        first = {tuple(r) for r in stream(spark, src, schema, out_dir=out, checkpoint_dir=ckpt).collect()}
        assert first == {(2, None, None), (3, 10, 10)}
        # home 1 completes, homes 1 and 3 get the empty page of an exact multiple, home 2 another page
        _write_pages(spark, [(1, 25, 1, 5), (3, 10, 1, 0), (2, None, 1, 9)], src)
        stream(spark, src, schema, out_dir=out, checkpoint_dir=ckpt)
        _write_pages(spark, [(1, 25, 2, 0)], src)
        again = stream(spark, src, schema, out_dir=out, checkpoint_dir=ckpt).collect()
        assert sorted(map(tuple, again), key=repr) == sorted([(1, 25, 25), (2, None, None), (3, 10, 10)], key=repr)
    try:
        ST.stream_complete_homes(spark, src, schema, out_dir=out)
    except ValueError:
        return
    raise AssertionError("one folder alone is an error")


def test_expired_homes_keep_their_count(spark):
    import time

    from innsight.session import scratch_path

    schema = spark.createDataFrame([], PAGES).schema
    src, out, ckpt = (scratch_path(spark, n) for n in ("idle-pages", "idle-out", "idle-ckpt"))
    _write_pages(spark, [(1, 25, 0, 20)], src)
    run = lambda: ST.stream_complete_homes_expiring(spark, src, schema, idle_timeout_ms=500, out_dir=out, checkpoint_dir=ckpt)
    assert run().count() == 0
    time.sleep(1.5)
    _write_pages(spark, [(2, 1, 0, 1)], src)
    assert [tuple(r) for r in run().collect()] == [(2, 1, 1)]
    assert [(r["home"], r["announced"], r["arrived"]) for r in ST.expired_homes(spark, out, schema).collect()] == [(1, 25, 20)]


def test_enrich_stream_stops_and_resumes(spark):
    from innsight.operators import reviews as RV
    from innsight.session import scratch_path

    src, out, ckpt = (scratch_path(spark, n) for n in ("rv-files", "rv-out", "rv-ckpt"))
    schema = spark.createDataFrame([], "id long, review_content string, score double").schema
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, who string")
    kwargs = dict(lexicon=RV.local_table(spark, [("best", 3.0), ("bad", -3.0), (None, 1.0)], "token string, valence double"),
                  topics=[(0, ["room"])], lemmas=RV.local_table(spark, [("rooms", "room")], "token string, lemma string"),
                  score_col="score", already_numeric=True)
    run = lambda: sorted(tuple(r) for r in ST.stream_enrich_reviews(
        spark, src, schema, base, "id", kwargs, out_dir=out, checkpoint_dir=ckpt).select("id", "who", "sentiment").collect())
    spark.createDataFrame([(1, "best rooms", 9.0), (1, "best rooms", 9.0)], schema).coalesce(1).write.mode("append").parquet(src)
    assert run() == [(1, "a", "positive"), (2, "b", None)]
    spark.createDataFrame([(1, "bad", 9.0), (3, "best", 8.0)], schema).coalesce(1).write.mode("append").parquet(src)
    assert run() == [(1, "a", "negative"), (2, "b", None), (3, None, "positive")]
    assert run() == [(1, "a", "negative"), (2, "b", None), (3, None, "positive")]


def test_no_sink_no_rows(spark):
    from innsight.session import scratch_path

    schema = spark.createDataFrame([], PAGES).schema
    src = scratch_path(spark, "never-released")
    _write_pages(spark, [(1, 25, 0, 20)], src)
    assert ST.stream_complete_homes(spark, src, schema).count() == 0


def test_a_cluster_needs_its_checkpoint_folder(spark):
    import pytest

    from innsight import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
