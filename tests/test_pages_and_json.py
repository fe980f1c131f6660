"""Elements of nested pages, and JSON records of every form."""

import json
import random

import pytest
from pyspark.sql import functions as F

from innsight.functions import html as H
from innsight.operators import extract as X
from innsight.sources.tables import HOME_SCHEMA, ROOM_SCHEMA, read_json_entity


def run(spark, texts, sql):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, h string")
    return [r[0] for r in df.orderBy("i").select(F.expr(sql)).collect()]


def random_page(rng, depth=0):
    """(markup, the contents of its outermost div.x elements, in order)"""
    if depth == 5 or rng.random() < 0.2:
        return rng.choice(["t", "&amp;", "<br>", "<div/>", "<img alt='a > b'>", ""]), []
    markup, found = "", []
    for _ in range(rng.randrange(4)):
        inner, below = random_page(rng, depth + 1)
        kind = rng.choice(["div", "DIV class='x'", 'div id=1 class="a x  b"', 'div class="x-y xx"', "span class=x", 'div title="class=x"'])
        markup += f"<{kind}>{inner}</{kind.split()[0]}>"
        hit = kind in ("DIV class='x'", 'div id=1 class="a x  b"')
        found += [inner] if hit else below
    return markup, found


def test_elements_end_at_their_own_closing_tag(spark):
    rng = random.Random(3)
    pages = [random_page(rng) for _ in range(300)]
    assert sum(len(f) for _, f in pages) > 150
    assert run(spark, [m for m, _ in pages], H.inners("h", "div", ("x",))) == [f for _, f in pages]


def test_implied_ends_and_open_elements(spark):
    texts = ["<li>a<ul><li>b<li>c</ul>d<li>e</ul><li>f", "<table><tr><td>1<td>2<table><tr><td>3</table>4</td><tr><td>5</table>", "x <div>never closed <div>in", None, ""]
    assert run(spark, texts[:1], H.inners("h", "li")) == [["a<ul><li>b<li>c</ul>d", "e", "f"]]
    assert run(spark, texts[1:2], H.inners("h", "tr")) == [["<td>1<td>2<table><tr><td>3</table>4</td>", "<td>5"]]
    assert run(spark, texts[1:2], H.inners("h", "td")) == [["1", "2<table><tr><td>3</table>4", "5"]]
    assert run(spark, texts[2:], H.inners("h", "div")) == [["never closed <div>in"], None, []]
    assert run(spark, texts[2:], H.texts_of("h", "div")) == [["never closed "], None, []]


def test_texts_and_attributes(spark):
    assert run(spark, ["<b>x</b> a <br> c <i>d<u>e</u></i>f", "plain", ""], H.own_texts("h")) == [[" a ", " c ", "f"], ["plain"], []]
    assert run(spark, ["<b> </b>\n<i>x</i>y", " "], H.leading_text("h")) == ["x", None]
    tags = ['a x="1>2" href="u&amp;v">', "a data-href=no HREF='q'>", "a href=bare id=2>", "a>", 'a title=" href=z" >']
    assert run(spark, tags, H.attribute("h", "href")) == ["u&amp;v", "q", "bare", None, None]


REVIEW = '<li class="r"><img class="x bui-avatar__image" src="u"><span class="bui-avatar-block__title">{}</span>{}<span class="c-review__body">{}</span></li>'


def test_reviews_with_lists_inside(spark):
    inner = '<ul><li>good<ul><li>very</li></ul></li><li>near</ul>'
    page = ('<ul class="review_list_old"><li>no</li></ul><ul class="wide review_list">'
            + REVIEW.format("A", inner, "one") + REVIEW.format("B", "", "two") + REVIEW.format("C", inner, "three") + "</ul>" + REVIEW.format("D", "", "out"))
    rows = X.review_rows(spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string")).orderBy("pos").collect()
    assert [(r["page_id"], r["pos"], r["user_name"], r["review_content"]) for r in rows] == [(1, 0, "A", "one"), (1, 1, "B", "two"), (1, 2, "C", "three")]


def test_room_cells_by_class_token(spark):
    page = ('<table><tr class="js-rt-block-row"><td class="hprt-table-cell-occupancy">2</td></tr>'
            '<tr class="js-rt-block-row hprt-table-last-row-x"><td class="hprt-table-cell"><table><tr class="js-rt-block-row"><td>in</td></tr></table></td></tr>'
            '<tr class="js-rt-block-row hprt-table-last-row" data-block-id="b_1_3_0"><td>x</td></tr><tr class="js-rt-block-rows"></tr></table>')
    rows = X.room_table_rows(spark.createDataFrame([(1, page)], "page_id int, html string")).orderBy("pos").collect()
    assert [(r["has_cell"], r["is_last"], r["occupancy"]) for r in rows] == [(False, False, None), (True, False, None), (False, True, 3)]


@pytest.mark.parametrize("multi_line", [False, True])
def test_json_of_every_form(spark, tmp_path, multi_line):
    rooms = [
        {"_id": {"$oid": "ab"}, "homename": "h", "roomtype": 5, "roomsize": "18.0", "facilities": "one",
         "availables": [{"occupancy": "2", "price": ["VND", "509.259"]}, {"occupancy": 2.0, "price": 700}, {"price": None}, None]},
        {"id": 7, "roomsize": 18, "facilities": ["a", 3, None], "availables": {"occupancy": "x", "price": "1.050.000"}},
        {"_id": "z", "roomsize": "18,5", "facilities": None, "availables": "odd"}, {}]
    path = tmp_path / "rooms.json"
    path.write_text(json.dumps(rooms, indent=1) if multi_line else "\n".join(map(json.dumps, rooms)) + "\nnot json\n[1]\n\n")
    df = read_json_entity(spark, str(path), ROOM_SCHEMA, "s", multi_line)
    assert df.schema["availables"].dataType.elementType.fieldNames() == ["occupancy", "price", "price_vnd"]
    rows = df.select("id", "roomtype", "roomsize", "facilities", "photos", "availables", "source").collect()
    assert [tuple(r)[:5] for r in rows] == [("ab", "5", 18.0, ["one"], None), ("7", None, 18.0, ["a", "3", None], None),
                                            ("z", None, 18.5, None, None), (None, None, None, None, None)]
    got = [[None if a is None else tuple(a) for a in r["availables"]] if r["availables"] else None for r in rows]
    assert got == [[(2, "509.259", 509259), (2, "700", 700), (None, None, None), None], [(None, "1.050.000", 1050000)], [(None, None, None)], None]
    assert {r["source"] for r in rows} == {"s"}


def test_json_homes(spark, tmp_path):
    homes = [{"homename": "h", "city": {"vn": "a", "en": "b"}, "cheapest_price": "509.259", "rating": 7.1, "reviews": "12", "images": ["i"]},
             {"city": "Hue", "cheapest_price": ["VND", "1.000"], "rating": "7,1", "reviews": "many", "url": ["a", "b"]}]
    (tmp_path / "h.json").write_text("\n".join(map(json.dumps, homes)))
    rows = read_json_entity(spark, str(tmp_path / "h.json"), HOME_SCHEMA, "s").select(
        "homename", "city", "cheapest_price", "rating", "reviews", "images", "url", "price_vnd").collect()
    assert [tuple(r) for r in rows] == [("h", ("a", "b"), "509.259", "7.1", 12, ["i"], None, 509259), (None, ("Hue", None), "1.000", "7,1", None, None, "a b", 1000)]
