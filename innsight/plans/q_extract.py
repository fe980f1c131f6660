"""Extraction queries (P3-P15, W4, A4, W8, scalar parsers) on pages, events, part,
lineitem, nation, customer and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from innsight.functions import parse as PZ
from innsight.functions.keys import py_strip
from innsight.operators import extract as X
from innsight.plans.registry import register
from innsight.session import spread
from innsight.sources.tables import read_table

RUN_DATE = "2024-01-01"  # fixed run date of the frontier query (a parameter, never now())


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _entities_sql(expr: str) -> str:
    """Named and numeric entities, from the standard library's tables."""
    from html.entities import html5

    names = "MAP {" + ", ".join(f"{_q(k[:-1])}: {_q(v)}" for k, v in sorted(html5.items()) if k.endswith(";")) + "}"
    old = "MAP {" + ", ".join(f"{i}: {_q(bytes([i]).decode('cp1252'))}" for i in range(128, 160)
                              if bytes([i]).decode("cp1252", "ignore")) + "}"
    num = ("CASE WHEN regexp_matches(e, '^#[xX]') THEN CAST('0x' || substr(e, 3) AS INTEGER) ELSE CAST(substr(e, 2) AS INTEGER) END")
    point = (f"CASE WHEN {num} = 0 OR {num} > 1114111 OR {num} BETWEEN 55296 AND 57343 THEN chr(65533) "
             f"ELSE coalesce(element_at({old}, {num})[1], chr({num})) END")
    one = f"CASE WHEN e LIKE '#%' THEN {point} ELSE coalesce(element_at({names}, e)[1], '&' || e || ';') END"
    ents = f"list_transform(regexp_extract_all({expr}, {_q(X.ENTITY_RE)}, 1), lambda e: {one})"
    pieces = f"regexp_split_to_array({expr}, {_q(X.ENTITY_RE.replace('(#', '(?:#'))})"
    whole = f"array_to_string(list_transform(list_zip({pieces}, {ents}), lambda z: coalesce(z[1], '') || coalesce(z[2], '')), '')"
    return f"CASE WHEN contains({expr}, '&') THEN {whole} ELSE {expr} END"


def _html_text_sql(expr: str) -> str:
    body = f"regexp_replace({expr}, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g')"
    pieces = f"regexp_split_to_array({body}, '<[^>]*>')"
    pieces = f"list_transform({pieces}, lambda p: trim({_entities_sql('p')}))"
    return f"array_to_string(list_filter({pieces}, lambda p: length(p) > 0), ' ')"


# --- P8 / P7 / P10 / W8 / url segment on pages -------------------------------------------------

@register("page_fields", f"""SELECT page_id,
  trim({_entities_sql("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}) AS title,
  {_html_text_sql("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS heading,
  array_to_string(regexp_extract_all(html, '<li><a href="([^"]*)">', 1), '|') AS links,
  len(regexp_extract_all(html, '<p>')) AS n_paragraphs
FROM pages""")
def q_page_fields(spark, sf):
    p = X.page_fields(read_table(spark, sf, "pages"))
    return p.select("page_id", "title", "heading", F.array_join("links", "|").alias("links"),
                    F.col("n_paragraphs").cast("bigint").alias("n_paragraphs"))


@register("page_cards", """SELECT page_id, i - 1 AS pos, links[i] AS link, trim(""" + _entities_sql("names[i]") + """) AS name
FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 1) AS links,
             regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 2) AS names FROM pages),
     LATERAL (SELECT unnest(generate_series(1, len(links))) AS i)""")
def q_page_cards(spark, sf):
    c = X.page_cards(read_table(spark, sf, "pages").select("page_id", "html"))
    return c.select("page_id", F.col("pos").cast("bigint").alias("pos"), "link", "name")


@register("html_text", f"SELECT page_id, {_html_text_sql('html')} AS text FROM pages")
def q_html_text(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", X.html_text(F.col("html")).alias("text"))


@register("last_match", """SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1)[-1] AS last_href,
  regexp_extract_all(html, '<b>([^<]*)</b>', 1)[-1] AS last_bold FROM pages""")
def q_last_match(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", X.last_match(F.col("html"), 'href="([^"]*)"').alias("last_href"),
                    X.last_match(F.col("html"), "<b>([^<]*)</b>").alias("last_bold"))


_ODD_URL = "'https://stay.example/hotel/vn/a b{' || CAST(page_id AS VARCHAR) || '|c.vi.html?x={1}|2'"
_HOTEL_URL = "'https://stay.example/hotel/vn/p' || CAST(page_id AS VARCHAR) || '.vi.html?aid=1'"


def _seg_sql(u: str) -> str:
    path = f"regexp_extract({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
    return f"split_part(string_split({path}, '/')[4], '.', 1)"


@register("url_path_segment", f"SELECT page_id, {_seg_sql('url')} AS seg, {_seg_sql(_HOTEL_URL)} AS hotel_seg, {_seg_sql(_ODD_URL)} AS odd_seg FROM pages")
def q_url_path_segment(spark, sf):
    p = read_table(spark, sf, "pages")
    hotel = F.concat(F.lit("https://stay.example/hotel/vn/p"), F.col("page_id").cast("string"), F.lit(".vi.html?aid=1"))
    odd = F.concat(F.lit("https://stay.example/hotel/vn/a b{"), F.col("page_id").cast("string"), F.lit("|c.vi.html?x={1}|2"))
    return p.select("page_id", PZ.url_path_segment(F.col("url")).alias("seg"),
                    PZ.url_path_segment(hotel).alias("hotel_seg"), PZ.url_path_segment(odd).alias("odd_seg"))


# --- P9 / P11 / P12 on events wrapped as pages ----------------------------------------------------

def _event_pages(spark, sf):
    e = read_table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    ms = PZ.epoch_millis(F.col("ts")).cast("string")
    s = lambda c: F.col(c).cast("string")
    reviews = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.concat(
        F.lit('{"timestamp": '), ms, F.lit(', "reviewerName": "user'), s("user_id"),
        F.lit('", "overallScore": '), s("value"), F.lit(', "reviewText": "'), s("event_type"), F.lit('"}')))
    js = F.concat(
        F.lit('{"props": {"pageProps": {"hotel": {"address": "addr '), s("event_id"),
        F.lit('", "userRating": '), k, F.lit(', "attribute": {"description": "<p>'), s("event_type"),
        F.lit(' &amp; <b>more</b></p>"}, "assets": [{"url": "u/'), k, F.lit('"}, {"url": "v/'), s("user_id"),
        F.lit('"}], "hotelFacilitiesTagDisplay": [{"name": "'), s("event_type"),
        F.lit('"}]}, "reviewSummary": {"reviewList": ['), reviews, F.lit("]}}}}"))
    js = F.when(F.col("event_type") == "error", F.substring(js, 1, 40)).otherwise(js)
    html = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">\n'), js, F.lit("\n</script></html>"))
    return e.select(F.col("event_id").alias("page_id"), html.alias("html"))


_EVENT_JSON_SQL = """ev AS (
  SELECT event_id AS page_id,
    CASE WHEN event_type = 'error' THEN substr(js, 1, 40) ELSE js END AS js
  FROM (SELECT event_id, event_type,
    '{"props": {"pageProps": {"hotel": {"address": "addr ' || CAST(event_id AS VARCHAR) ||
    '", "userRating": ' || json_extract_string(props, '$.k') ||
    ', "attribute": {"description": "<p>' || event_type || ' &amp; <b>more</b></p>"}, "assets": [{"url": "u/' ||
    json_extract_string(props, '$.k') || '"}, {"url": "v/' || CAST(user_id AS VARCHAR) ||
    '"}], "hotelFacilitiesTagDisplay": [{"name": "' || event_type ||
    '"}]}, "reviewSummary": {"reviewList": [' ||
    CASE WHEN event_type = 'view' THEN '' ELSE '{"timestamp": ' || CAST((epoch_us(ts) // 1000) AS VARCHAR) ||
      ', "reviewerName": "user' || CAST(user_id AS VARCHAR) || '", "overallScore": ' || CAST(value AS VARCHAR) ||
      ', "reviewText": "' || event_type || '"}' END || ']}}}}' AS js
  FROM events)),
ok AS (SELECT page_id, js FROM ev WHERE json_valid(js))"""


@register("embedded_json", "WITH " + _EVENT_JSON_SQL + f"""
SELECT page_id, json_extract_string(js, '$.props.pageProps.hotel.address') AS address,
  CAST(json_extract(js, '$.props.pageProps.hotel.userRating') AS DOUBLE) AS rating,
  {_html_text_sql("json_extract_string(js, '$.props.pageProps.hotel.attribute.description')")} AS description
FROM ok""")
def q_embedded_json(spark, sf):
    p = X.embedded_json(_event_pages(spark, sf))
    return p.select("page_id", "address", "rating", "description")


@register("json_array_field", "WITH " + _EVENT_JSON_SQL + """
SELECT page_id,
  array_to_string(json_extract_string(js, '$.props.pageProps.hotel.assets[*].url'), '|') AS images,
  array_to_string(json_extract_string(js, '$.props.pageProps.hotel.hotelFacilitiesTagDisplay[*].name'), '|') AS highlights
FROM ok""")
def q_json_array_field(spark, sf):
    p = X.embedded_json(_event_pages(spark, sf))
    return p.select("page_id", F.array_join("images", "|").alias("images"),
                    F.array_join("property_highlights", "|").alias("highlights"))


@register("reviews_explode", "WITH " + _EVENT_JSON_SQL + """
SELECT page_id, 0 AS pos, json_extract_string(js, '$.props.pageProps.reviewSummary.reviewList[0].reviewerName') AS user_name,
  CAST(DATE '1970-01-01' + CAST(floor(CAST(json_extract(js, '$.props.pageProps.reviewSummary.reviewList[0].timestamp') AS BIGINT) / 86400000) AS INTEGER) AS VARCHAR) AS review_date,
  CAST(json_extract(js, '$.props.pageProps.reviewSummary.reviewList[0].overallScore') AS DOUBLE) AS review_score,
  json_extract_string(js, '$.props.pageProps.reviewSummary.reviewList[0].reviewText') AS review_content
FROM ok WHERE json_array_length(js, '$.props.pageProps.reviewSummary.reviewList') > 0""")
def q_reviews_explode(spark, sf):
    r = X.reviews_explode(X.embedded_json(_event_pages(spark, sf)))
    return r.select("page_id", F.col("pos").cast("int").alias("pos"), "user_name",
                    F.col("review_date").cast("string").alias("review_date"), "review_score", "review_content")


# --- 2.8 scalar parsers ---------------------------------------------------------------------------

@register("epoch_ms_date", """SELECT event_id, (epoch_us(ts) // 1000) AS ms,
  CAST(DATE '1970-01-01' + CAST(floor((epoch_us(ts) // 1000) / 86400000) AS INTEGER) AS VARCHAR) AS review_date FROM events""")
def q_epoch_ms_date(spark, sf):
    e = read_table(spark, sf, "events")
    ms = PZ.epoch_millis(F.col("ts"))
    return e.select("event_id", ms.alias("ms"), PZ.epoch_ms_date(ms).cast("string").alias("review_date"))


@register("review_date_parse", """SELECT event_id,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS review_date FROM events""")
def q_review_date_parse(spark, sf):
    e = read_table(spark, sf, "events")
    month = F.when(F.col("event_id") % 9 == 0, F.lit("Foo")).otherwise(F.date_format("ts", "MMMM"))
    txt = F.concat(F.lit("Reviewed: "), F.dayofmonth("ts").cast("string"), F.lit(" "), month, F.lit(" "),
                   F.year("ts").cast("string"), F.lit(" "))
    return e.select("event_id", PZ.review_date_parse(txt).cast("string").alias("review_date"))


@register("dotted_count", """SELECT p_partkey, TRY_CAST(split_part(trim(replace(
  replace(format('{:,}', p_partkey * 1234 + p_size), ',', '.') || ' đánh giá', '.', '')), ' ', 1) AS INTEGER) AS total,
  TRY_CAST(replace(replace(format('{:,}', p_partkey * 50000 + 300000), ',', '.'), '.', '') AS BIGINT) AS price_vnd
FROM part""")
def q_dotted_count(spark, sf):
    p = read_table(spark, sf, "part")
    txt = F.concat(F.replace(F.format_number(F.col("p_partkey") * 1234 + F.col("p_size"), 0), F.lit(","), F.lit(".")),
                   F.lit(" đánh giá"))
    price = F.replace(F.format_number(F.col("p_partkey") * 50000 + 300000, 0), F.lit(","), F.lit("."))
    return p.select("p_partkey", PZ.dotted_count(txt).alias("total"), PZ.price_vnd(price).alias("price_vnd"))


# --- P3 / P4 / P5 / P6 --------------------------------------------------------------------------------

def _frontier_sql() -> str:
    def enc(x: str) -> str:
        return f"replace(url_encode({x}), '%20', '+')"
    cin, cout = f"DATE '{RUN_DATE}' + 1", f"DATE '{RUN_DATE}' + 2"
    parts = [f"'ss=' || {enc('en')}", f"'&checkin=' || {enc(f'strftime({cin}, ' + _q('%Y-%m-%d') + ')')}",
             f"'&checkout=' || {enc(f'strftime({cout}, ' + _q('%Y-%m-%d') + ')')}"]
    parts += [f"'&{k}=' || {enc(_q(v))}" for k, v in X.SEARCH_PARAMS_1]
    spec = f"strftime({cin}, '%d-%m-%Y') || '.' || strftime({cout}, '%d-%m-%Y')"
    return (f"SELECT n_nationkey, {_q(X.SEARCH_BASE_1)} || {' || '.join(parts)} AS search_url, "
            f"{_q(X.SEARCH_BASE_2 + 'spec=')} || {enc(spec)} AS search_url_2 "
            f"FROM (SELECT n_nationkey, n_name || ' & co/' || CAST(n_regionkey AS VARCHAR) || ' ~x*y' AS en FROM nation)")


@register("crawl_frontier", _frontier_sql())
def q_crawl_frontier(spark, sf):
    n = read_table(spark, sf, "nation")
    cities = n.select("n_nationkey", F.concat(F.col("n_name"), F.lit(" & co/"), F.col("n_regionkey").cast("string"),
                                              F.lit(" ~x*y")).alias("en"))
    return X.crawl_frontier(cities, RUN_DATE).select("n_nationkey", "search_url", "search_url_2")


@register("review_page_expand", """SELECT p.p_partkey, p.total, pg AS page, pg * 25 AS "offset"
FROM (SELECT l_partkey AS p_partkey, count(*) - 1 + (l_partkey % 3) * 12 AS total FROM lineitem GROUP BY l_partkey) p,
     LATERAL (SELECT unnest(generate_series(0, p.total // 25)) AS pg)""")
def q_review_page_expand(spark, sf):
    li = read_table(spark, sf, "lineitem")
    tot = li.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        (F.count(F.lit(1)) - 1 + (F.col("l_partkey") % 3) * 12).alias("total"))
    out = X.review_page_expand(tot, "total")
    return out.select("p_partkey", F.col("total").cast("bigint").alias("total"), F.col("page").cast("bigint").alias("page"),
                      F.col("offset").cast("bigint").alias("offset"))


_HEADING_SQL = f"""CASE WHEN p_size % 10 = 0 THEN 'Kết quả: ' || {_q(X.NOTHING_FOUND)}
  WHEN p_size % 7 = 0 THEN 'Nothing here' ELSE 'Kết quả: ' || p_type || ': ' || p_name END"""


@register("no_result_gate", f"""SELECT p_partkey, notice FROM (
  SELECT p_partkey, string_split({_HEADING_SQL}, ': ')[2] AS notice FROM part)
WHERE notice IS NOT NULL AND notice <> {_q(X.NOTHING_FOUND)}""")
def q_no_result_gate(spark, sf):
    p = read_table(spark, sf, "part")
    heading = (F.when(F.col("p_size") % 10 == 0, F.lit("Kết quả: " + X.NOTHING_FOUND))
               .when(F.col("p_size") % 7 == 0, F.lit("Nothing here"))
               .otherwise(F.concat(F.lit("Kết quả: "), F.col("p_type"), F.lit(": "), F.col("p_name"))))
    return X.no_result_gate(p.select("p_partkey", heading.alias("heading"))).select("p_partkey", "notice")


@register("first_containing", """SELECT n.n_nationkey AS city_id, c.c_custkey AS pos, c.text AS text
FROM nation n JOIN (
  SELECT c_nationkey, c_custkey, text, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rk FROM (
    SELECT c.c_nationkey, c.c_custkey, c.text FROM (
      SELECT c_nationkey, c_custkey,
             c_name || ', ' || CASE WHEN c_custkey % 3 = 0 THEN (SELECT n_name FROM nation WHERE n_nationkey = (c_nationkey + 1) % 25)
                                    WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE 'VN' END AS text FROM customer) c
    JOIN nation n2 ON n2.n_nationkey = c.c_nationkey
    WHERE contains(c.text, n2.n_name) OR contains(c.text, CASE WHEN c.c_nationkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END))
) c ON c.c_nationkey = n.n_nationkey AND c.rk = 1""")
def q_first_containing(spark, sf):
    n = read_table(spark, sf, "nation")
    c = read_table(spark, sf, "customer")
    nxt = n.select(F.col("n_nationkey").alias("_nk"), F.col("n_name").alias("_next_name"))
    opts = c.join(F.broadcast(nxt), ((c["c_nationkey"] + 1) % 25) == nxt["_nk"], "left")  # 25-row dimension
    text = F.concat(F.col("c_name"), F.lit(", "),
                    F.when(F.col("c_custkey") % 3 == 0, F.col("_next_name"))
                    .when(F.col("c_custkey") % 4 == 0, F.col("c_mktsegment")).otherwise(F.lit("VN")))
    options = opts.select(F.col("c_nationkey").alias("city_id"), F.col("c_custkey").alias("pos"), text.alias("text"))
    en = F.when(F.col("n_nationkey") % 2 == 0, F.lit("BUILDING")).otherwise(F.lit("MACHINERY"))
    cities = n.select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("vn"), en.alias("en"))
    return X.first_containing(options, cities).select(F.col("city_id").cast("int").alias("city_id"), "pos", "text")


# --- P13 / P14 on room text blocks built from part ---------------------------------------------------

def _room_block(spark, sf):
    p = spread(read_table(spark, sf, "part"))
    size = F.when(F.col("p_size") % 4 == 0, F.lit("")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5 m²\n")))
    p1 = F.replace(F.format_number(F.col("p_partkey") * 1000 + 850000, 0), F.lit(","), F.lit("."))
    p2 = F.replace(F.format_number(F.col("p_partkey") * 700 + 450000, 0), F.lit(","), F.lit("."))
    prices = F.when(F.col("p_size") % 5 == 0, F.lit("Liên hệ")).otherwise(
        F.concat(p1, F.lit(" VND\n"), p2, F.lit(" VND")))
    txt = F.concat(size, F.col("p_type"), F.lit("\n"), F.col("p_brand"), F.lit("\nXem chi tiết phòng\n"), prices,
                   F.lit("\n"), (F.col("p_size") % 4 + 1).cast("string"), F.lit(" khách"))
    return p.select("p_partkey", "p_name", "p_type", txt.alias("text"))


_ROOM_BLOCK_SQL = """blk AS (SELECT p_partkey, p_name, p_type,
  CASE WHEN p_size % 4 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) || '.5 m²' || chr(10) END || p_type || chr(10) || p_brand ||
  chr(10) || 'Xem chi tiết phòng' || chr(10) ||
  CASE WHEN p_size % 5 = 0 THEN 'Liên hệ' ELSE replace(format('{:,}', p_partkey * 1000 + 850000), ',', '.') || ' VND' || chr(10) ||
       replace(format('{:,}', p_partkey * 700 + 450000), ',', '.') || ' VND' END || chr(10) ||
  CAST(p_size % 4 + 1 AS VARCHAR) || ' khách' AS text FROM part)"""


@register("room_text_extract", "WITH " + _ROOM_BLOCK_SQL + """
SELECT p_partkey, TRY_CAST(nullif(regexp_extract(text, '(\\d+\\.\\d+)\\s*m²', 1), '') AS DOUBLE) AS roomsize,
  CASE WHEN regexp_matches(text, '(?s)\\d+\\.\\d+\\s*m²(.+?)Xem chi tiết phòng')
       THEN array_to_string(string_split(trim(regexp_extract(text, '(?s)\\d+\\.\\d+\\s*m²(.+?)Xem chi tiết phòng', 1), chr(10) || ' '), chr(10)), '|') END AS facilities,
  regexp_extract_all(text, '(\\d{1,3}(?:\\.\\d{3})*|\\d+)\\s+VND', 1)[-1] AS price,
  TRY_CAST(replace(regexp_extract_all(text, '(\\d{1,3}(?:\\.\\d{3})*|\\d+)\\s+VND', 1)[-1], '.', '') AS BIGINT) AS price_vnd
FROM blk""")
def q_room_text_extract(spark, sf):
    r = X.room_text_extract(_room_block(spark, sf))
    return r.select("p_partkey", "roomsize", F.array_join("facilities", "|").alias("facilities"), "price", "price_vnd")


@register("zip_shortest", """SELECT p_partkey, i - 1 AS pos, a[i] AS roomtype, b[i] AS info FROM (
  SELECT p_partkey, string_split(p_name, ' ') AS a,
         [p_type, p_brand, CAST(p_size AS VARCHAR)][1:(p_size % 4)] AS b FROM part),
  LATERAL (SELECT unnest(generate_series(1, least(len(a), len(b)))) AS i)""")
def q_zip_shortest(spark, sf):
    p = read_table(spark, sf, "part")
    a = F.split("p_name", " ")
    b = F.slice(F.array("p_type", "p_brand", F.col("p_size").cast("string")), 1, (F.col("p_size") % 4).cast("int"))
    z = p.select("p_partkey", F.posexplode(X.zip_shortest(a, b)).alias("pos", "z"))
    return z.select("p_partkey", F.col("pos").cast("bigint").alias("pos"), F.col("z.a").alias("roomtype"),
                    F.col("z.b").alias("info"))


# --- P15 / W4 / A4 on conversations --------------------------------------------------------------------

@register("review_text_join", """SELECT conv_id,
  string_agg(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '. ' ORDER BY turn) AS review_content
FROM conversations GROUP BY conv_id""")
def q_review_text_join(spark, sf):
    c = read_table(spark, sf, "conversations")
    g = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("parts"))
    return g.select("conv_id", X.review_text_join(F.transform("parts", lambda s: s["text"])).alias("review_content"))


def table_rows(spark, sf):
    c = read_table(spark, sf, "conversations")
    rt = F.get(F.split(py_strip(F.col("text")), " "), 0)
    block = F.concat(F.lit("b_"), F.col("conv_id").cast("string"), F.lit("_"),
                     (F.length("text") % 4 + 1).cast("string"), F.lit("_0"))
    return c.select(F.col("conv_id").alias("page_id"), F.col("turn").alias("pos"),
                    (F.col("role") == "user").alias("has_cell"),
                    ((F.col("role") == "assistant") & (F.length("text") % 3 != 0)).alias("is_last"),
                    F.when(F.col("role") == "user", rt).alias("roomtype"),
                    X.block_occupancy(block).alias("occupancy"),
                    (F.length("text") * 1000).cast("string").alias("price"))


_ROWS_SQL = """tr AS (SELECT conv_id AS page_id, turn AS pos, role = 'user' AS has_cell,
    role = 'assistant' AND length(text) % 3 <> 0 AS is_last,
    CASE WHEN role = 'user' THEN string_split(trim(text), ' ')[1] END AS roomtype,
    length(text) % 4 + 1 AS occupancy, CAST(length(text) * 1000 AS VARCHAR) AS price FROM conversations),
g AS (SELECT *, coalesce(sum(CAST(is_last AS INTEGER)) OVER (PARTITION BY page_id ORDER BY pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM tr),
f AS (SELECT *, min(CASE WHEN has_cell THEN pos END) OVER (PARTITION BY page_id, room) AS first_cell FROM g),
act AS (SELECT * FROM f WHERE pos >= first_cell),
rooms AS (SELECT page_id, room,
    arg_max(CASE WHEN has_cell AND trim(roomtype) <> '' THEN trim(roomtype) END, pos)
      FILTER (WHERE has_cell AND trim(roomtype) <> '') AS roomtype,
    string_agg(CAST(occupancy AS VARCHAR) || ':' || price, '|' ORDER BY pos) AS availables,
    count(*) AS n_avail
  FROM act GROUP BY page_id, room HAVING max(CAST(is_last AS INTEGER)) = 1)"""


def _rooms_flat(spark, sf):
    r = X.row_islands(table_rows(spark, sf))
    av = F.array_join(F.transform("availables", lambda x: F.concat(x["occupancy"].cast("string"), F.lit(":"), x["price"])), "|")
    return r.select("page_id", F.col("room").cast("bigint").alias("room"), "roomtype", av.alias("availables"),
                    F.size("availables").cast("bigint").alias("n_avail"))


@register("row_islands", "WITH " + _ROWS_SQL + " SELECT page_id, room, roomtype, n_avail FROM rooms")
def q_row_islands(spark, sf):
    return _rooms_flat(spark, sf).select("page_id", "room", "roomtype", "n_avail")


@register("collect_availabilities", "WITH " + _ROWS_SQL + " SELECT page_id, room, availables FROM rooms")
def q_collect_availabilities(spark, sf):
    return _rooms_flat(spark, sf).select("page_id", "room", "availables")


# --- pages built from table rows; the SQL gives the fields those pages were made of -----------------------

def _esc(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&#34;"))


def _page_of(rows, page, key, html):
    """One page per ``page`` value: its pieces in key order (a bounded number)."""
    g = rows.groupBy(page.alias("page_id")).agg(F.array_sort(F.collect_list(F.struct(key.alias("k"), html.alias("h")))).alias("p"))
    return g.select("page_id", F.array_join(F.transform("p", lambda x: x["h"]), "\n").alias("body"))


ENTITY_NAMES = [("agrave", "à"), ("ecirc", "ê"), ("ndash", "–"), ("hellip", "…"), ("Dstrok", "Đ"), ("nbsp", " "), ("NotEqualTilde", "≂̸")]


@register("decode_entities", f"""SELECT p_partkey, 'C' || [{', '.join(_q(v) for _, v in ENTITY_NAMES)}][p_size % {len(ENTITY_NAMES)} + 1] || ' ' ||
  chr(CAST(p_partkey * 37 % 50000 + 160 AS INTEGER)) || chr(CAST(p_partkey * 41 % 50000 + 160 AS INTEGER)) || '–' || chr(65533) || ' &bogus; & ' || p_name AS text FROM part""")
def q_decode_entities(spark, sf):
    p = spread(read_table(spark, sf, "part"))
    k = F.col("p_partkey")
    names = F.array(*[F.lit(n) for n, _ in ENTITY_NAMES])
    text = F.concat(F.lit("C&"), F.element_at(names, (F.col("p_size") % len(ENTITY_NAMES) + 1).cast("int")), F.lit("; &#"),
                    (k * 37 % 50000 + 160).cast("string"), F.lit(";&#x"), F.lower(F.hex(k * 41 % 50000 + 160)),
                    F.lit(";&#150;&#xD800; &bogus; & "), F.col("p_name"))
    return p.select("p_partkey", X.decode_entities(text).alias("text"))


@register("property_cards", """SELECT p_partkey // 5 AS page_id, row_number() OVER (PARTITION BY p_partkey // 5 ORDER BY p_partkey) - 1 AS pos,
  p_name || ' & ' || p_type AS homename,
  CASE WHEN p_size % 4 <> 0 THEN replace(format('{:,}', p_partkey * 1000 + 9000), ',', '.') END AS cheapest_price,
  CASE WHEN p_size % 3 <> 0 THEN CAST(p_size % 10 AS VARCHAR) || '.' || CAST(p_size % 7 AS VARCHAR) END AS rating,
  '/hotel/vn/p' || CAST(p_partkey AS VARCHAR) || '.vi.html?a=1&b=2' AS link FROM part""")
def q_property_cards(spark, sf):
    p = spread(read_table(spark, sf, "part"))
    k, size = F.col("p_partkey"), F.col("p_size")
    price = F.replace(F.format_number(k * 1000 + 9000, 0), F.lit(","), F.lit("."))
    card = F.concat(
        F.lit('<div data-testid="property-card-container" class="c"><h3><a class="t" href="/hotel/vn/p'), k.cast("string"),
        F.lit('.vi.html?a=1&amp;b=2" data-testid="title-link"><div data-testid="title" class="n">'),
        _esc(F.concat(F.col("p_name"), F.lit(" & "), F.col("p_type"))), F.lit("</div></a></h3>"),
        F.when(size % 4 != 0, F.concat(F.lit('<span class="p" data-testid="price-and-discounted-price">VND&nbsp;'), price, F.lit("</span>"))).otherwise(F.lit("")),
        F.when(size % 3 != 0, F.concat(F.lit('<div data-testid="review-score"><div class="s">'), (size % 10).cast("string"), F.lit(","),
                                       (size % 7).cast("string"), F.lit("</div></div>"))).otherwise(F.lit("")), F.lit("</div>"))
    pages = _page_of(p, F.floor(k / 5), k, card).select("page_id", F.concat(F.lit("<html><body>"), "body", F.lit("</body></html>")).alias("html"))
    return X.property_cards(pages).select(F.col("page_id").cast("bigint").alias("page_id"), F.col("pos").cast("bigint").alias("pos"),
                                          "homename", "cheapest_price", "rating", "link")


@register("property_page", """SELECT p_partkey AS page_id, CASE WHEN p_size % 6 <> 0 THEN 'Street ' || p_size || ' & Co' END AS address,
  CASE WHEN p_size % 5 <> 0 THEN p_name || ' – ' || p_type END AS description,
  CASE WHEN p_size % 3 = 0 THEN '' ELSE p_type || '|' || p_brand END AS property_highlights,
  CASE WHEN p_size % 4 = 0 THEN '' ELSE 'img/' || CAST(p_partkey AS VARCHAR) || '?w=1&h=2|img/b' END AS images,
  CASE WHEN p_size % 7 <> 0 THEN CAST(p_partkey * 17 AS INTEGER) END AS total_reviews FROM part""")
def q_property_page(spark, sf):
    p = spread(read_table(spark, sf, "part"))
    k, size, s = F.col("p_partkey").cast("string"), F.col("p_size"), F.lit
    part = lambda cond, *cols: F.when(cond, F.concat(*cols)).otherwise(s(""))
    html = F.concat(
        s("<html><body>"),
        part(size % 6 != 0, s('<span class="x hp_address_subtitle y">\n Street '), size.cast("string"), s(" &amp; Co\n</span>")),
        part(size % 5 != 0, s('<div data-capla-component-boundary="b-property-web-property-page/PropertyDescriptionDesktop"><div><p class="d"> '),
             _esc(F.col("p_name")), s(" &ndash; "), _esc(F.col("p_type")), s(" </p><p>more</p></div></div>")),
        part(size % 3 != 0, s(f'<ul class="{X.HIGHLIGHTS_CLASS}"><li><div> '), _esc(F.col("p_type")),
             s("</div><ul><li> "), _esc(F.col("p_brand")), s(" <b>x</b></li></ul></li></ul>")),
        s('<ul><li>other</li></ul><a class="bh-photo-grid-item"><img src="before"></a>'),
        part(size % 4 != 0, s('<div class="nha_large_photo_main_content"><a href="#" class="bh-photo-grid-item big"><img alt="" src="img/'), k,
             s('?w=1&amp;h=2"></a>\n<a class="bh-photo-grid-item">\n<img src="img/b"></a><div></div></div><a class="bh-photo-grid-item"><img src="after"></a>')),
        part(size % 7 != 0, s(f'<span class="{X.REVIEW_COUNT_CLASS}">7,1</span><span class="{X.REVIEW_COUNT_CLASS}"> '),
             F.replace(F.format_number(F.col("p_partkey") * 17, 0), s(","), s(".")), s(" đánh giá</span>")), s("</body></html>"))
    out = X.property_page(p.select(F.col("p_partkey").alias("page_id"), html.alias("html")))
    return out.select("page_id", "address", "description", F.array_join("property_highlights", "|").alias("property_highlights"),
                      F.array_join("images", "|").alias("images"), "total_reviews")


@register("review_rows", """SELECT p_partkey // 5 AS page_id, p_name AS user_name, CASE WHEN p_size % 3 <> 0 THEN p_brand END AS user_country,
  CAST(CASE WHEN p_size % 9 <> 0 THEN make_date(2023, CAST(p_size % 12 + 1 AS BIGINT), CAST(p_size % 28 + 1 AS BIGINT)) END AS VARCHAR) AS review_date,
  CASE WHEN p_size % 4 <> 0 THEN p_type || ' & more' END AS review_title,
  CASE WHEN p_size % 5 <> 0 THEN CAST(p_size % 10 AS VARCHAR) || '.5' END AS review_score,
  CASE WHEN p_size % 8 = 0 THEN '' ELSE p_name || '. n/a' END AS review_content
FROM part WHERE p_size % 10 <> 0""")
def q_review_rows(spark, sf):
    p = spread(read_table(spark, sf, "part"))
    k, size, s = F.col("p_partkey"), F.col("p_size"), F.lit
    part = lambda cond, *cols: F.when(cond, F.concat(*cols)).otherwise(s(""))
    day = F.make_date(s(2023), (size % 12 + 1).cast("int"), (size % 28 + 1).cast("int"))
    date = F.when(size % 9 == 0, s("yesterday")).otherwise(F.date_format(day, "d MMMM yyyy"))
    block = F.concat(
        s('<li class="review">'), part(size % 10 != 0, s('<img class="bui-avatar__image x" src="u.png">')),
        s('<div class="bui-avatar-block__text"><span class="bui-avatar-block__title">'), _esc(F.col("p_name")), s("</span>"),
        part(size % 3 != 0, s('<span class="bui-avatar-block__subtitle">'), _esc(F.col("p_brand")), s("</span>")),
        s('</div><div class="c-review-block__row"><span class="c-review-block__date">Reviewed: '), date, s("</span>"),
        part(size % 4 == 1, s('<ul class="pros"><li>quiet<ul><li>very</li></ul></li><li>near</ul><span class="c-review-block__title-x">no</span>')),
        part(size % 4 != 0, s('<h3 class="c-review-block__title-x">none</h3><h3 class="c-review-block__title">\n'), _esc(F.col("p_type")), s(" &amp; more </h3>")),
        part(size % 5 != 0, s('<div class="bui-review-score__badge"> '), (size % 10).cast("string"), s(",5 </div>")),
        part(size % 8 != 0, s('<div class="c-review"><span class="c-review__body"><i title="a > b">&quot;</i> '), _esc(F.col("p_name")),
             s("</span><span lang=x class='wide c-review__body'>n/a </span></div>")), s("</div>"), part(size % 3 == 0, s("</li>")))
    pages = _page_of(p, F.floor(k / 5), k, block).select(
        F.col("page_id").cast("bigint").alias("page_id"), F.concat(s('<!-- <ul class="review_list"><li> --><ul class="review_list_top"><li>x</li></ul><UL id=r class="a review_list">'), "body", s("</UL><ul><li>x</li></ul>")).alias("html"))
    r = X.review_rows(pages)
    return r.select("page_id", "user_name", "user_country", F.col("review_date").cast("string").alias("review_date"), "review_title",
                    "review_score", "review_content")


def _room_pages(spark, sf):
    c = read_table(spark, sf, "conversations")
    n, user, s = F.length("text"), F.col("role") == "user", F.lit
    word = F.get(F.split(py_strip(F.col("text")), " "), 0)
    last = (F.col("role") == "assistant") & (n % 3 != 0)
    basic = n % 7 == 0
    occ = (n % 4 + 1).cast("string")
    part = lambda cond, *cols: F.when(cond, F.concat(*cols)).otherwise(s(""))
    row = F.concat(
        s('<tr class="js-rt-block-row'), part(last, s(" hprt-table-last-row")), s('" data-block-id="'),
        F.when(basic, s("bbasic_0")).otherwise(F.concat(s("b_1_"), occ, s("_0"))), s('"'),
        part(~basic, s(' data-hotel-rounded-price="'), (n * 1000).cast("string"), s('"')), s('><td class="hprt-table-cell-occupancy">x</td>'),
        part(user, s('<td class="a hprt-table-cell b"><table><tr class="js-rt-block-row"><td>inner</td></tr></table><a class="hprt-roomtype-link"><span class="hprt-roomtype-icon-link"> '), _esc(word), s(" </span></a>"),
             part(n % 5 != 0, s('<div class="hprt-facilities-facility" data-name-en="room size"><span>'), (n % 60).cast("string"),
                  s(' m²</span></div><div class="hprt-facilities-facility" data-name-en="privacy"><span>Private</span></div>'
                    '<div class="hprt-facilities-facility"><div><span>Wifi</span></div> &amp; TV</div><div class="hprt-facilities-facility">f'),
                  (n % 3).cast("string"), s("</div>")), s("</td>")),
        part(basic, s('<div class="wholesalers_table__occupancy__icons jq_tooltip"><span class="bui-u-sr-only">Max people: '), occ,
             s('</span></div><div class="bui-price-display__value">VND '), (n * 1000).cast("string"), s("</div>")), s("</tr>"))
    pages = _page_of(c, F.col("conv_id"), F.col("turn"), row)
    return pages.select("page_id", F.concat(s("<table><tr class=\"head\"><th>x</th></tr>"), "body", s("</table>")).alias("html"))


@register("room_table_rows", "WITH " + _ROWS_SQL.replace("AS price FROM conversations)", """AS price,
    CASE WHEN role = 'user' AND length(text) % 5 <> 0 THEN length(text) % 60 END AS roomsize,
    CASE WHEN role = 'user' AND length(text) % 5 <> 0 THEN 'Wifi & TV|f' || CAST(length(text) % 3 AS VARCHAR) END AS facilities
    FROM conversations)""").replace("    string_agg(", """    arg_max(roomsize, pos) FILTER (WHERE has_cell AND facilities IS NOT NULL) AS roomsize,
    arg_max(facilities, pos) FILTER (WHERE has_cell AND facilities IS NOT NULL) AS facilities,
    string_agg(""") + " SELECT page_id, room, roomtype, CAST(roomsize AS INTEGER) AS roomsize, facilities, availables FROM rooms")
def q_room_table_rows(spark, sf):
    """The room table of pages, row by row, and the rooms its rows make up."""
    r = X.row_islands(X.room_table_rows(_room_pages(spark, sf)))
    av = F.array_join(F.transform("availables", lambda x: F.concat(x["occupancy"].cast("string"), F.lit(":"), x["price"])), "|")
    return r.select("page_id", F.col("room").cast("bigint").alias("room"), "roomtype", "roomsize",
                    F.array_join("facilities", "|").alias("facilities"), av.alias("availables"))


def _links_sql() -> str:
    def enc(x: str) -> str:
        return f"replace(url_encode({x}), '%20', '+')"
    spec = (f"strftime(DATE '{RUN_DATE}' + 1, '%d-%m-%Y') || '.' || strftime(DATE '{RUN_DATE}' + 2, '%d-%m-%Y') || "
            "'.1.1.HOTEL.' || CAST(p_partkey AS VARCHAR) || '.' || p_name || ' & ' || p_type || '.1'")
    params = " || ".join([_q("&".join(f"{k}={v}" for k, v in X.REVIEW_LIST_PARAMS)), "'&pagename='", enc("p_name"), "'&rows=25&offset='",
                          "CAST(p_size * 25 AS VARCHAR)"])
    return (f"SELECT p_partkey, {_q(X.DETAIL_BASE)} || 'spec=' || {enc(spec)} AS detail_link, "
            f"{_q(X.REVIEW_LIST_BASE)} || {params} AS review_link FROM part")


@register("page_links", _links_sql())
def q_page_links(spark, sf):
    """Links of a home's page (P3) and of a page of its review list."""
    p = read_table(spark, sf, "part")
    name = F.concat("p_name", F.lit(" & "), "p_type")
    return p.select("p_partkey", X.detail_link(F.col("p_partkey"), name, RUN_DATE).alias("detail_link"),
                    X.review_list_link(F.col("p_name"), F.col("p_size") * 25).alias("review_link"))


# --- S1 over JSON text of every form ------------------------------------------------------------------------

@register("scan_json_entity", """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS homename, CASE WHEN p_size % 5 <> 0 THEN p_type END AS roomtype,
  CASE p_size % 4 WHEN 0 THEN p_size + 0.5 WHEN 1 THEN p_size WHEN 2 THEN p_size + 0.25 END::DOUBLE AS roomsize,
  CASE p_size % 3 WHEN 0 THEN p_brand || '|3' WHEN 1 THEN p_brand END AS facilities,
  CASE WHEN p_size % 7 >= 2 THEN CASE p_size % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 END END::INTEGER AS occupancy,
  CASE WHEN p_size % 7 >= 2 THEN CASE p_size % 5 WHEN 0 THEN '1.050.000' WHEN 1 THEN CAST(p_partkey AS VARCHAR) WHEN 2 THEN replace(format('{:,}', p_partkey * 1000 + 9000), ',', '.') END END AS price,
  CASE WHEN p_size % 7 >= 2 THEN CASE p_size % 5 WHEN 0 THEN 1050000 WHEN 1 THEN p_partkey WHEN 2 THEN p_partkey * 1000 + 9000 END END::BIGINT AS price_vnd,
  CASE WHEN p_size % 7 = 0 THEN 0 WHEN p_size % 7 = 1 THEN NULL ELSE 1 END::INTEGER AS n_availables, 'x' AS source
FROM part WHERE p_size % 11 <> 0""")
def q_scan_json_entity(spark, sf):
    """Rooms written as JSON lines in which every field takes several forms, and read into the declared schema."""
    from innsight.session import scratch_path
    from innsight.sources.tables import ROOM_SCHEMA, read_json_entity

    k, size, s = F.col("p_partkey").cast("string"), F.col("p_size"), F.lit
    q = lambda c: F.concat(s('"'), c, s('"'))
    pick = lambda n, *forms: F.element_at(F.array(*[f if not isinstance(f, str) else s(f) for f in forms]), (size % n + 1).cast("int"))
    price = F.replace(F.format_number(F.col("p_partkey") * 1000 + 9000, 0), s(","), s("."))
    one = F.concat(
        s('{"occupancy": '), pick(4, "2", '"3"', '"4.0"', "null"), s(', "price": '),
        pick(5, '"1.050.000"', k, F.concat(s('["VND", "'), price, s('"]')), "null", "[]"), s("}"))
    row = F.concat(
        s('{"_id": '), F.when(size % 2 == 0, F.concat(s('{"$oid": '), q(k), s("}"))).otherwise(k),
        s(', "homename": '), q(F.col("p_name")), F.when(size % 5 != 0, F.concat(s(', "roomtype": '), q(F.col("p_type")))).otherwise(s("")),
        s(', "roomsize": '), pick(4, q(F.concat(size.cast("string"), s(".5"))), size.cast("string"), q(F.concat(size.cast("string"), s(",25"))), '"large"'),
        F.when(size % 3 == 2, s(', "facilities": null')).otherwise(F.concat(
            s(', "facilities": '), F.when(size % 3 == 0, F.concat(s("["), q(F.col("p_brand")), s(", 3]"))).otherwise(q(F.col("p_brand"))))),
        F.when(size % 7 == 0, s(', "availables": []')).when(size % 7 == 1, s("")).when(size % 7 == 2, F.concat(s(', "availables": '), one))
        .otherwise(F.concat(s(', "availables": ['), one, s("]"))), s("}"))
    line = F.when(size % 11 == 0, F.substring(row, 1, 30)).otherwise(row)
    path = scratch_path(spark, "rooms-json")
    read_table(spark, sf, "part").select(line.alias("value")).write.text(path)
    r = read_json_entity(spark, path, ROOM_SCHEMA, "x")
    a = F.get("availables", F.lit(0))
    return r.select("id", "homename", "roomtype", "roomsize", F.array_join("facilities", "|").alias("facilities"),
                    a["occupancy"].alias("occupancy"), a["price"].alias("price"), a["price_vnd"].alias("price_vnd"),
                    F.when(F.col("availables").isNotNull(), F.size("availables")).alias("n_availables"), "source")
