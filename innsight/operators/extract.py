"""Page -> record extraction over stored pages (DataFrame -> DataFrame).

Fields are found by the marker attributes and classes they stand behind.

Pages are not fetched here; they arrive as rows (page_id, url, html) and every
step is a Spark job over them: regex extraction, JSON parsing and windowed
row-to-room assembly, all JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.functions import html as H
from innsight.functions.html import ENTITY_RE, decode_entities, elements, first_text, html_text, inners, visible  # noqa: F401
from innsight.functions.keys import py_strip
from innsight.functions.parse import form_url_encode, price_vnd, text_after

# ---------------------------------------------------------------------------
# Fixed values.
NOTHING_FOUND = "Không tìm thấy chỗ nghỉ"
SEARCH_BASE_1 = "https://www.booking.com/searchresults.vi.html?"
SEARCH_BASE_2 = "https://www.traveloka.com/vi-vn/hotel/search?"
SEARCH_PARAMS_1 = [("group_adults", "1"), ("no_rooms", "1"), ("group_children", "0"), ("nflt", "ht_id=222")]
REVIEW_PAGE_SIZE = 25
ROOM_SIZE_RE = "(?U)(\\d+\\.\\d+)\\s*m²"
ROOM_FACILITIES_RE = "(?Us)\\d+\\.\\d+\\s*m²(.+?)Xem chi tiết phòng"
ROOM_PRICE_RE = "(?U)(\\d{1,3}(?:\\.\\d{3})*|\\d+)\\s+VND"
EMBEDDED_SCRIPT_RE = "(?s)<script id=\"__NEXT_DATA__\"[^>]*>(.*?)</script>"
DETAIL_BASE = "https://www.traveloka.com/vi-vn/hotel/detail?"
REVIEW_LIST_BASE = "https://www.booking.com/reviewlist.vi.html?"
REVIEW_LIST_PARAMS = [("type", "total"), ("lang", "vn"), ("sort", "f_recent_desc"), ("cc1", "vn"), ("dist", "1")]
FILLERS = ["n/a", "ko", "không", "no", "nothing"]
# Markers of the stored pages: tag, class tokens and attribute values of the elements that hold the fields.
CARD, CARD_LINK = {"data-testid": "property-card-container"}, {"data-testid": "title-link"}
CARD_TITLE, CARD_PRICE = {"data-testid": "title"}, {"data-testid": "price-and-discounted-price"}
CARD_SCORE = {"data-testid": "review-score"}
ADDRESS_CLASS = "hp_address_subtitle"
DESCRIPTION = {"data-capla-component-boundary": "b-property-web-property-page/PropertyDescriptionDesktop"}
HIGHLIGHTS_CLASS = "aca0ade214 aaf30230d9 c2931f4182 e7d9f93f4d ed5cdd3fb3 fb5b81c565"
PHOTOS_CLASS, PHOTO_LINK_CLASS = "nha_large_photo_main_content", "bh-photo-grid-item"
REVIEW_COUNT_CLASS = "f13857cc8c a5cc9f664c c4b07b6aa8"
ROW_CLASS, ROW_CELL_CLASS, ROW_LAST_CLASS = "js-rt-block-row", "hprt-table-cell", "hprt-table-last-row"
ROW_TYPE_CLASS, ROW_FACILITY_CLASS, ROW_FACILITY = "hprt-roomtype-icon-link", "hprt-facilities-facility", "data-name-en"
ROW_PRICE_CLASS, ROW_OCCUPANCY_CLASS, BASIC_BLOCK = "bui-price-display__value", "bui-u-sr-only", "bbasic_0"
REVIEW_LIST_CLASS, AVATAR_CLASS = "review_list", "bui-avatar__image"
REVIEWER_CLASS, COUNTRY_CLASS = "bui-avatar-block__title", "bui-avatar-block__subtitle"
REVIEW_DATE_CLASS, REVIEW_TITLE_CLASS = "c-review-block__date", "c-review-block__title"
REVIEW_SCORE_CLASS, REVIEW_BODY_CLASS = "bui-review-score__badge", "c-review__body"
# ---------------------------------------------------------------------------


# --- P3 / P4 / P5 / P6 ------------------------------------------------------------------

def crawl_frontier(cities: DataFrame, run_date: str, en: str = "en") -> DataFrame:
    """Per city the two search links for the stay (run+1, run+2)."""
    d = F.to_date(F.lit(run_date))
    cin, cout = F.date_add(d, 1), F.date_add(d, 2)
    params = [("ss", F.col(en)), ("checkin", F.date_format(cin, "yyyy-MM-dd")),
              ("checkout", F.date_format(cout, "yyyy-MM-dd"))] + [(k, F.lit(v)) for k, v in SEARCH_PARAMS_1]
    pieces = []
    for i, (k, v) in enumerate(params):
        pieces += ([F.lit("&")] if i else []) + [F.lit(k + "="), form_url_encode(v)]
    spec = F.concat(F.date_format(cin, "dd-MM-yyyy"), F.lit("."), F.date_format(cout, "dd-MM-yyyy"))
    return cities.select("*", F.concat(F.lit(SEARCH_BASE_1), *pieces).alias("search_url"),
                         F.concat(F.lit(SEARCH_BASE_2 + "spec="), form_url_encode(spec)).alias("search_url_2"))


def detail_link(home_id: Column, homename: Column, run_date: str) -> Column:
    """Link of one home's page for the stay (run+1, run+2); NULL without id or name."""
    d = F.to_date(F.lit(run_date))
    spec = F.concat(F.date_format(F.date_add(d, 1), "dd-MM-yyyy"), F.lit("."), F.date_format(F.date_add(d, 2), "dd-MM-yyyy"),
                    F.lit(".1.1.HOTEL."), home_id.cast("string"), F.lit("."), homename, F.lit(".1"))
    return F.concat(F.lit(DETAIL_BASE + "spec="), form_url_encode(spec))


def review_list_link(pagename: Column, offset: Column, page_size: int = REVIEW_PAGE_SIZE) -> Column:
    """Link of one page of a home's review list; ``pagename`` is the home's url segment."""
    params = [(k, F.lit(v)) for k, v in REVIEW_LIST_PARAMS] + [
        ("pagename", pagename), ("rows", F.lit(str(page_size))), ("offset", offset.cast("string"))]
    pieces = []
    for i, (k, v) in enumerate(params):
        pieces += [F.lit(("&" if i else "") + k + "="), form_url_encode(v)]
    return F.concat(F.lit(REVIEW_LIST_BASE), *pieces)


def review_page_expand(homes: DataFrame, total: str = "total", page_size: int = REVIEW_PAGE_SIZE) -> DataFrame:
    """Pages 0..total div page_size (the extra empty page at exact multiples is kept)."""
    pages = F.sequence(F.lit(0), F.floor(F.col(total) / page_size).cast("int"))
    out = homes.where(F.col(total).isNotNull()).select("*", F.explode(pages).alias("page"))
    return out.withColumn("offset", F.col("page") * page_size)


def no_result_gate(df: DataFrame, heading: str = "heading", notice: str = NOTHING_FOUND) -> DataFrame:
    """P5: keep pages whose heading text after ': ' is not the 'nothing found' notice."""
    t = text_after(F.col(heading), ": ")
    return df.withColumn("notice", t).where(F.col("notice").isNotNull() & (F.col("notice") != notice))


def first_containing(options: DataFrame, cities: DataFrame, key: str = "city_id",
                     pos: str = "pos", text: str = "text") -> DataFrame:
    """Per city the first option (by ``pos``) whose text contains the vn or en name.

    options: key, pos, text (the option list shown for that city).
    """
    j = options.join(cities.select(key, "vn", "en"), key)
    hit = j.where(F.col(text).contains(F.col("vn")) | F.col(text).contains(F.col("en")))
    best = hit.groupBy(key).agg(F.min(F.struct(F.col(pos), F.col(text))).alias("_b"))
    return best.select(key, F.col("_b")[pos].alias(pos), F.col("_b")[text].alias(text))


# --- P7 / P8 / P10 / W8 ----------------------------------------------------------------------

def page_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """One page -> title, heading, link list, paragraph count (trimmed, decoded)."""
    h = F.col(html)
    return pages.select(
        "*",
        py_strip(decode_entities(F.regexp_extract(h, "(?s)<title>(.*?)</title>", 1))).alias("title"),
        html_text(F.regexp_extract(h, "(?s)<h1>(.*?)</h1>", 1)).alias("heading"),
        F.regexp_extract_all(h, F.lit("<li><a href=\"([^\"]*)\">"), 1).alias("links"),
        F.size(F.regexp_extract_all(h, F.lit("<p>"), 0)).alias("n_paragraphs"),
    )


def page_cards(pages: DataFrame, html: str = "html") -> DataFrame:
    """One page -> one card per list link (pos, link, name)."""
    pat = "<li><a href=\"([^\"]*)\">([^<]*)</a>"
    links = F.regexp_extract_all(F.col(html), F.lit(pat), 1)
    names = F.regexp_extract_all(F.col(html), F.lit(pat), 2)
    z = F.arrays_zip(links.alias("link"), names.alias("name"))
    out = pages.select("*", F.posexplode(z).alias("pos", "_c")).drop(html)
    return out.select(*[c for c in out.columns if c != "_c"], F.col("_c.link").alias("link"),
                      py_strip(decode_entities(F.col("_c.name"))).alias("name"))


def card_price(c: Column) -> Column:
    """Card price text 'VND\u00a0509.259' -> '509.259' (the piece after the first no-break space)."""
    return F.get(F.split(c, "\u00a0"), 1)


def card_rating(c: Column) -> Column:
    """Card rating '7,1' -> '7.1' (text kept; NULL stays NULL)."""
    return F.replace(c, F.lit(","), F.lit("."))


def _shown(pages: DataFrame, html: str) -> DataFrame:
    """The page without comments and scripts as ``_h``, behind a generator, so that no field repeats the work."""
    return pages.select(*[c for c in pages.columns if c != html], F.explode_outer(F.array(visible(F.col(html)))).alias("_h"))


def _each(pages: DataFrame, found: str, html: str) -> DataFrame:
    """One row per element found in ``_h``: pos, _e (open, inner) in place of the page."""
    rows = _shown(pages, html)
    # the outer form: the plain one would scan every page again in an inferred filter
    return rows.select(*[c for c in rows.columns if c != "_h"], F.posexplode_outer(F.expr(found)).alias("pos", "_e")).where("pos is not null")


def _decoded(rows: DataFrame, drop: list[str], **fields: str) -> DataFrame:
    """The rows without ``drop``, with a struct ``_t`` of decoded texts, each the SQL text of an expression: one decoding of all, behind a generator."""
    texts = F.transform(F.expr(f"array({', '.join(fields.values())})"), decode_entities)
    rows = rows.select("*", F.explode(F.array(texts)).alias("_a"))
    named = F.struct(*[F.get("_a", F.lit(i)).alias(n) for i, n in enumerate(fields)])
    return rows.select(*[c for c in rows.columns if c not in (*drop, "_a")], named.alias("_t"))


def _others(rows: DataFrame, *own: str) -> list[str]:
    return [c for c in rows.columns if c not in ("_t", *own)]


def property_cards(pages: DataFrame, html: str = "html") -> DataFrame:
    """P7 over search pages: one row per property card: pos, homename, cheapest_price, rating, link.

    A card without a price or rating has NULL there; a page without cards gives no row.
    """
    cards, c = _each(pages, elements("_h", "div", attrs=CARD), html), "_e.inner"
    score = f"get(filter(transform({inners(c, 'div', attrs=CARD_SCORE)}, v -> {H.leading_text('get(' + inners('v', 'div') + ', 0)')}), v -> v IS NOT NULL), 0)"
    cards = _decoded(cards, ["_e"], name=first_text(c, "div", attrs=CARD_TITLE), price=first_text(c, "span", attrs=CARD_PRICE),
                     score=score, link=H.attribute(f"get({elements(c, 'a', attrs=CARD_LINK)}, 0).open", "href"))
    return cards.select(*_others(cards), py_strip("_t.name").alias("homename"), card_price(F.col("_t.price")).alias("cheapest_price"),
                        card_rating(py_strip("_t.score")).alias("rating"), F.col("_t.link").alias("link"))


def property_page(pages: DataFrame, html: str = "html") -> DataFrame:
    """P8 over property pages: address, description, property_highlights, images, total_reviews.

    Texts are decoded and trimmed; what a page lacks is NULL, lists are empty.
    Every item of the highlight list counts, also those of lists inside it, and only photos inside the photo block.
    ``total_reviews`` is the number in the second counter of the page (NULL: none announced).
    """
    from innsight.functions.parse import dotted_count

    items = H.each(inners("_h", "ul", tuple(HIGHLIGHTS_CLASS.split())), "slice(split(v, '(?i)<li(?=[ />])[^>]*>', -1), 2, 1000000)")
    items = f"transform({items}, v -> coalesce({H.leading_text('v')}, ''))"
    photos = H.each(inners("_h", "div", (PHOTOS_CLASS,)), inners("v", "a", (PHOTO_LINK_CLASS,)))
    images = f"transform({H.each(photos, 'regexp_extract_all(v, ' + H.quoted('(?i)<(img(?=[ />])[^>]*>)') + ', 1)')}, v -> {H.attribute('v', 'src')})"
    described = H.each(inners("_h", "div", attrs=DESCRIPTION), H.texts_of("v", "p"))
    counters = H.texts_of("_h", "span", tuple(REVIEW_COUNT_CLASS.split()))
    # four lists in one column, so that all are decoded by one expression
    lists = [f"slice({H.texts_of('_h', 'span', (ADDRESS_CLASS,))}, 1, 1)", f"slice({described}, 1, 1)", items, images, f"slice({counters}, 2, 1)"]
    page = _shown(pages, html)
    decoded = F.transform(F.expr("array(" + ", ".join(f"coalesce({x}, array())" for x in lists) + ")"), lambda x: F.transform(x, decode_entities))
    page = page.select(*_others(page, "_h"), F.explode(F.array(decoded)).alias("_t"))
    at = lambda i: F.get("_t", F.lit(i))
    return page.select(
        *_others(page), py_strip(F.get(at(0), 0)).alias("address"), py_strip(F.get(at(1), 0)).alias("description"),
        F.transform(at(2), py_strip).alias("property_highlights"), at(3).alias("images"), dotted_count(F.get(at(4), 0)).alias("total_reviews"))


def review_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Review-list pages -> one row per review: pos, user_name, user_country, review_date, review_title, review_score, review_content.

    Only items of the review list with an avatar image are reviews; lists inside an item belong to its review. The date
    is a DATE (NULL if it does not parse), the score keeps its text with a dot, body texts are joined by P15.
    """
    from innsight.functions.parse import review_date_parse

    rows, b = _each(pages, H.each(inners("_h", "ul", (REVIEW_LIST_CLASS,)), elements("v", "li")), html), "_e.inner"
    avatars = f"regexp_extract_all({b}, {H.quoted('<(' + H.tag_pattern('img', (AVATAR_CLASS,)) + '[^>]*>)')}, 1)"
    rows = rows.where(F.expr(f"coalesce({H.attribute(f'get({avatars}, 0)', 'src')}, '') <> ''"))
    rows = rows.withColumn("_b", F.transform(F.expr(H.texts_of(b, "span", (REVIEW_BODY_CLASS,))), decode_entities))
    rows = _decoded(rows, ["_e"], name=first_text(b, "span", (REVIEWER_CLASS,)), country=first_text(b, "span", (COUNTRY_CLASS,)),
                    day=first_text(b, "span", (REVIEW_DATE_CLASS,)), title=first_text(b, "h3", (REVIEW_TITLE_CLASS,)),
                    score=first_text(b, "div", (REVIEW_SCORE_CLASS,)))
    return rows.select(
        *_others(rows, "_b"), F.col("_t.name").alias("user_name"), F.col("_t.country").alias("user_country"),
        review_date_parse(F.col("_t.day")).alias("review_date"), py_strip("_t.title").alias("review_title"),
        F.replace(py_strip("_t.score"), F.lit(","), F.lit(".")).alias("review_score"), review_text_join(F.col("_b")).alias("review_content"))


def room_table_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Property pages -> ordered rows of the room table, the input of :func:`row_islands`.

    pos, has_cell, is_last, roomtype, roomsize (of the room-size facility, square
    metres), facilities (without room size and privacy; NULL if the row lists none), occupancy, price.
    Tables inside a cell belong to the row that holds the cell.
    """
    rows, r = _each(pages, elements("_h", "tr", (ROW_CLASS,)), html), "_e.inner"
    named = f"transform({elements(r, 'div', (ROW_FACILITY_CLASS,))}, v -> named_struct('name', {H.attribute('v.open', ROW_FACILITY)}, 'html', v.inner))"
    listed = F.transform(F.expr(named), lambda x: F.struct(x["name"].alias("name"), py_strip(html_text(x["html"])).alias("text")))
    rows = rows.select("*", F.explode(F.array(listed)).alias("_l"), F.expr(H.has_tag(r, "td", (ROW_CELL_CLASS,))).alias("has_cell"),
                       F.expr(H.has_tag("concat('<', _e.open)", "tr", (ROW_LAST_CLASS,))).alias("is_last"))
    rows = _decoded(rows, ["_e"], block=H.attribute("_e.open", "data-block-id"), rounded=H.attribute("_e.open", "data-hotel-rounded-price"),
                    price=first_text(r, "div", (ROW_PRICE_CLASS,)), type=first_text(r, "span", (ROW_TYPE_CLASS,)),
                    people=first_text(r, "span", (ROW_OCCUPANCY_CLASS,)))
    listed, block = F.col("_l"), F.col("_t.block")
    size = F.get(F.filter(listed, lambda x: x["name"].eqNullSafe("room size")), 0)["text"]
    rest = F.filter(listed, lambda x: ~F.coalesce(x["name"].isin("room size", "privacy"), F.lit(False)))
    return rows.select(
        *_others(rows, "_l", "has_cell", "is_last"), "has_cell", "is_last", F.col("_t.type").alias("roomtype"),
        F.get(F.split(size, " "), 0).try_cast("int").alias("roomsize"),
        F.when(F.size(listed) > 0, F.transform(rest, lambda x: x["text"])).alias("facilities"),
        block_occupancy(block, F.col("_t.people")).alias("occupancy"),
        F.when(block == BASIC_BLOCK, F.get(F.split("_t.price", "\u00a0"), 1)).otherwise(F.col("_t.rounded")).alias("price"))


def last_match(c: Column, pattern: str, group: int = 1) -> Column:
    """Last of all regex matches, NULL when none."""
    return F.try_element_at(F.regexp_extract_all(c, F.lit(pattern), group), F.lit(-1))


# --- P9 / P11 / P12 ------------------------------------------------------------------------------

REVIEW_ITEM = T.StructType([
    T.StructField("timestamp", T.LongType()), T.StructField("reviewerName", T.StringType()),
    T.StructField("overallScore", T.DoubleType()), T.StructField("reviewText", T.StringType()),
])


def embedded_json(pages: DataFrame, html: str = "html") -> DataFrame:
    """P9 + P11: parse the embedded page data once; pages with invalid JSON are skipped.

    The payload (first '{' to last '}') is parsed into a VARIANT; fields are
    read by path with defaults (missing -> NULL / []), so each page is parsed
    once. Adds address, rating, description (P10 text), images and highlights
    (P11) and the review list (for P12).
    """
    payload = py_strip(F.regexp_extract(F.col(html), EMBEDDED_SCRIPT_RE, 1))
    clipped = F.regexp_extract(payload, "(?s)(\\{.*\\})", 1)
    # through a generator, so that no later filter or projection repeats the regexes and the parse
    parsed = F.explode_outer(F.array(F.try_parse_json(F.nullif(clipped, F.lit("")))))
    df = pages.select(*[c for c in pages.columns if c != html], parsed.alias("_v")).where(F.col("_v").isNotNull())

    def get(path: str, typ) -> Column:
        t = typ if isinstance(typ, str) else typ.simpleString()
        return F.try_variant_get(F.col("_v"), "$.props.pageProps." + path, t)

    assets = get("hotel.assets", T.ArrayType(T.StructType([T.StructField("url", T.StringType())])))
    tags = get("hotel.hotelFacilitiesTagDisplay", T.ArrayType(T.StructType([T.StructField("name", T.StringType())])))
    reviews = get("reviewSummary.reviewList", T.ArrayType(REVIEW_ITEM))
    return df.select(
        *[c for c in pages.columns if c != html],
        get("hotel.address", "string").alias("address"),
        get("hotel.userRating", "double").alias("rating"),
        html_text(F.coalesce(get("hotel.attribute.description", "string"), F.lit(""))).alias("description"),
        json_array_field(assets, "url").alias("images"),
        json_array_field(tags, "name").alias("property_highlights"),
        F.coalesce(reviews, F.array().cast(T.ArrayType(REVIEW_ITEM))).alias("review_list"),
    )


def json_array_field(arr: Column, field: str) -> Column:
    """Pluck one field of every object of an array (NULL array -> [])."""
    return F.when(arr.isNull(), F.array().cast("array<string>")).otherwise(F.transform(arr, lambda x: x[field]))


def reviews_explode(parsed: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per review of the parsed list; an empty list gives no row."""
    ex = parsed.select(key, F.posexplode("review_list").alias("pos", "r"))
    from innsight.functions.parse import epoch_ms_date

    return ex.select(key, "pos", F.col("r.reviewerName").alias("user_name"),
                     epoch_ms_date(F.col("r.timestamp")).alias("review_date"),
                     F.col("r.overallScore").alias("review_score"), F.col("r.reviewText").alias("review_content"))


# --- P13 / P14 ------------------------------------------------------------------------------------

def room_text_extract(df: DataFrame, text: str = "text") -> DataFrame:
    """Size, facilities and last price of a free-text room block."""
    t = F.col(text)
    size = F.nullif(F.regexp_extract(t, ROOM_SIZE_RE, 1), F.lit("")).try_cast("double")
    fac_raw = F.regexp_extract(t, ROOM_FACILITIES_RE, 1)
    facilities = F.when(t.rlike(ROOM_FACILITIES_RE), F.split(py_strip(fac_raw), "\n"))
    price = last_match(t, ROOM_PRICE_RE, 1)
    return df.select("*", size.alias("roomsize"), facilities.alias("facilities"), price.alias("price"),
                     price_vnd(price).alias("price_vnd"))


def zip_shortest(a: Column, b: Column) -> Column:
    """Positional pairs cut at the shorter list (arrays_zip pads with NULL)."""
    n = F.least(F.size(a), F.size(b))
    return F.arrays_zip(F.slice(a, 1, n).alias("a"), F.slice(b, 1, n).alias("b"))


# --- P15 --------------------------------------------------------------------------------------------

def review_text_join(parts: Column, drop_fillers: bool = False) -> Column:
    """P15: '. '-join of the stripped parts.

    The reference's filter is always true (an `or` of `!=`), so nothing is dropped
    by default; ``drop_fillers=True`` applies the intended rule.
    """
    stripped = F.transform(parts, lambda p: py_strip(p))
    if drop_fillers:
        stripped = F.filter(stripped, lambda p: ~F.lower(p).isin(FILLERS))
    return F.array_join(stripped, ". ")


# --- W4 / A4 -------------------------------------------------------------------------------------------

def row_islands(rows: DataFrame, page: str = "page_id", pos: str = "pos") -> DataFrame:
    """W4 + A4: ordered table rows -> rooms (page, room, roomtype, roomsize, facilities, availables).

    rows: page, pos, has_cell, is_last, roomtype (of the cell, may be NULL),
    occupancy, price; roomsize and facilities (of the cell, NULL when it lists
    none) are optional. A room starts at the first cell after the previous
    room's last-row flag; every row from there appends an availability; a cell
    with a non-empty type sets the type and one with facilities sets size and
    facilities (later cells overwrite); the last-row flag closes the room. Rows
    before the first cell are ignored and a room never closed is not written.
    Windows are per page (one page's rows).
    """
    for c, t in (("roomsize", "int"), ("facilities", "array<string>")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(t))
    w_run = Window.partitionBy(page).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    r = rows.withColumn("room", F.coalesce(F.sum(F.col("is_last").cast("int")).over(w_run), F.lit(0)))
    w_room = Window.partitionBy(page, "room")
    r = r.withColumn("_first_cell", F.min(F.when(F.col("has_cell"), F.col(pos))).over(w_room))
    active = r.where(F.col(pos) >= F.col("_first_cell"))
    rt = py_strip(F.col("roomtype"))
    typed, listed = F.col("has_cell") & (rt != ""), F.col("has_cell") & F.col("facilities").isNotNull()
    g = active.groupBy(page, "room").agg(
        F.max(F.col("is_last").cast("int")).alias("_closed"),
        F.max_by(F.when(typed, rt), F.when(typed, F.col(pos))).alias("roomtype"),
        F.max_by(F.when(listed, F.struct("roomsize", "facilities")), F.when(listed, F.col(pos))).alias("_f"),
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("pos"), F.col("occupancy"), F.col("price")))).alias("_av"),
    )
    g = g.where(F.col("_closed") == 1)
    return g.select(page, "room", "roomtype", F.col("_f.roomsize").alias("roomsize"), F.col("_f.facilities").alias("facilities"),
                    F.transform("_av", lambda x: F.struct(x["occupancy"].alias("occupancy"), x["price"].alias("price"))).alias("availables"))


def block_occupancy(block_id: Column, fallback_text: Column | None = None) -> Column:
    """Occupancy of a table row: third '_' piece of the block id; for 'bbasic_0' the text after ': '."""
    main = F.get(F.split(block_id, "_"), 2).try_cast("int")
    if fallback_text is None:
        return main
    return F.when(block_id == BASIC_BLOCK, text_after(fallback_text, ": ").try_cast("int")).otherwise(main)
