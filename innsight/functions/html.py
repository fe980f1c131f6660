"""Elements, attributes and texts of stored pages, all JVM-side.

A page is cut at the tags that matter and folded over these tokens with a
depth, so an element ends at its own closing tag, whatever it holds; classes
are compared by whole tokens. Nothing is exploded: a page stays one row.

The scanning functions take the SQL text of an expression and give the SQL text of another (for ``F.expr``): a fold
of some sixty operators is parsed at once, where building it column by column costs half a second each time.
Texts come as they stand in the page; :func:`decode_entities` is for columns.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from innsight.functions.keys import py_strip

# --- entities ---------------------------------------------------------------------------------

ENTITY_RE = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
#: Buckets of the lookup of names: about four names each, instead of one map that is scanned whole.
ENTITY_BUCKETS = 512


def _old_code_points() -> dict[int, str]:
    """Numbers 128-159 name characters of the Windows code page in pages, not control characters."""
    return {i: bytes([i]).decode("cp1252") for i in range(0x80, 0xA0) if bytes([i]).decode("cp1252", "ignore")}


@lru_cache(maxsize=1)
def _entity_table() -> str:
    """Names of HTML 5 (closed by a semicolon), from the standard library, in buckets by the checksum of the name, as JSON."""
    from html.entities import html5

    buckets: list[dict[str, str]] = [{} for _ in range(ENTITY_BUCKETS)]
    for name, text in sorted((k[:-1], v) for k, v in html5.items() if k.endswith(";")):
        buckets[zlib.crc32(name.encode()) % ENTITY_BUCKETS][name] = text
    return json.dumps(buckets, ensure_ascii=False)


def _named(name: Column) -> Column:
    """Text of a name, NULL if there is none; the table is one literal that Catalyst folds."""
    table = F.from_json(F.lit(_entity_table()), "array<map<string,string>>")
    return F.try_element_at(F.get(table, (F.crc32(name.cast("binary")) % ENTITY_BUCKETS).cast("int")), name)


def decode_entities(c: Column) -> Column:
    """Decode named (HTML 5) and numeric entities that a semicolon closes; anything else stays as it is.

    A number that is no character (0, surrogates, beyond Unicode) becomes U+FFFD.
    """
    old = F.from_json(F.lit(json.dumps(_old_code_points())), "map<string,string>")

    def point(n: Column) -> Column:
        good = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        utf32 = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(~good, F.lit("\ufffd")).when(n.between(0x80, 0x9F), F.coalesce(F.try_element_at(old, n.cast("string")), utf32)).otherwise(utf32)

    def one(e: Column) -> Column:
        number = F.when(e.rlike("^#[xX]"), F.conv(F.substring(e, 3, 8), 16, 10)).otherwise(F.substring(e, 2, 8)).cast("int")
        return F.when(e.startswith("#"), point(number)).otherwise(F.coalesce(_named(e), F.concat(F.lit("&"), e, F.lit(";"))))

    decoded = F.transform(F.regexp_extract_all(c, F.lit(ENTITY_RE), F.lit(1)), one)
    whole = F.array_join(F.zip_with(F.split(c, ENTITY_RE, -1), F.array_append(decoded, F.lit("")), lambda a, b: F.concat(a, b)), "")
    return F.when(c.contains("&"), whole).otherwise(c)


# --- tags -------------------------------------------------------------------------------------------

#: What follows a tag's name up to its '>': quoted values may hold that sign. Possessive, so that it never backtracks.
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
#: As few whole attributes as needed.
_BEFORE = r"""(?:[^>"']|"[^"]*"|'[^']*')*?"""
#: Elements without a closing tag.
VOID = "area|base|br|col|embed|hr|img|input|link|meta|source|track|wbr"
#: Elements whose closing tag may be missing, and the elements inside which another one of their kind is not theirs.
IMPLIED_END = {"li": "ul|ol|menu", "tr": "table", "td": "table", "th": "table", "dt": "dl", "dd": "dl", "option": "select"}


def quoted(s: str) -> str:
    """SQL literal of a text."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def visible(c: Column) -> Column:
    """The page without comments, scripts and style sheets, whose contents may look like tags."""
    return F.regexp_replace(c, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", "")


def tag_pattern(tag: str, classes: tuple[str, ...] = (), attrs: dict[str, str] | None = None) -> str:
    """Pattern of an opening tag (behind its '<') that has all the classes, as whole tokens, and the attribute values."""
    def value(text: str, before: str = "", after: str = "") -> str:
        v = re.escape(text)
        one = lambda q: f"{q}{before.replace('Q', q)}{v}{after.replace('Q', q)}{q}"
        return f"(?:{one(chr(34))}|{one(chr(39))}|{v}(?=[\\s/>]))"

    out = f"(?i:{tag})(?=[\\s/>])"
    for c in classes:
        out += f"(?={_BEFORE}\\s(?i:class)\\s*=\\s*" + value(c, r"(?:[^Q]*\s)?", r"(?:\s[^Q]*)?") + ")"
    for name, text in (attrs or {}).items():
        out += f"(?={_BEFORE}\\s(?i:{re.escape(name)})\\s*=\\s*{value(text)})"
    return out


def has_tag(x: str, tag: str, classes: tuple[str, ...] = (), attrs: dict[str, str] | None = None) -> str:
    """Whether a tag like this stands anywhere in the text."""
    return f"rlike({x}, {quoted('<' + tag_pattern(tag, classes, attrs))})"


def attribute(opening: str, name: str) -> str:
    """Value of an attribute of an opening tag, quoted or not; NULL if the tag has none."""
    pattern = f"^{_BEFORE}\\s(?i:{re.escape(name)})\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s\"'>]+)"
    return f"regexp_replace(get(regexp_extract_all({opening}, {quoted(pattern)}, 1), 0), {quoted(chr(94) + '[' + chr(34) + chr(39) + ']|[' + chr(34) + chr(39) + ']$')}, '')"


def elements(x: str, tag: str, classes: tuple[str, ...] = (), attrs: dict[str, str] | None = None) -> str:
    """Elements with the tag, all classes and attribute values: an array of (open, inner), in page order.

    ``open`` is the opening tag behind its '<' and up to its '>', ``inner`` all up to the element's own closing tag. An element
    inside another that is found belongs to that one and is not listed apart. Where a closing tag may be
    missing (list items, table rows and cells, ...), the next one of the same list or table, or the end of that, closes it; any
    other element never closed runs to the end of the text. NULL gives NULL, a text without such a tag an empty array.
    """
    tag = tag.lower()
    outer = IMPLIED_END.get(tag, tag)
    # what a token does is found out once, before the fold: it closes, it opens an element searched for, it is of the kind itself, and its move of the depth
    closing = "startswith(t, '/')"
    starts = f"NOT {closing} AND rlike(t, {quoted('^' + tag_pattern(tag, classes, attrs))})"
    alone = f"rlike(t, {quoted('^' + _REST + '(?<=/)>')})"  # <x/> holds nothing
    mine = "true" if outer == tag else f"rlike(t, {quoted('(?i)^/?' + tag + '[' + chr(92) + 's/>]')})"
    # where a closing tag may be missing, lists or tables inside move the depth, and the kind itself does not
    move = f"CASE WHEN {closing} THEN -1 WHEN {alone} THEN 0 ELSE 1 END"
    done = f"transform(p, t -> named_struct('close', {closing}, 'starts', {starts}, 'mine', {mine}, 'alone', {alone}, 'move', {move}))"
    if outer == tag:
        # the element ends where one more of its kind closes than opened since
        depth, again, ends = "s.depth + t.move", "false", "(s.at >= 0 AND s.depth + t.move < 0)"
    else:
        depth = "s.depth + if(t.mine, 0, t.move)"
        again = "(s.at >= 0 AND t.mine AND NOT t.close AND s.depth = 0)"
        ends = f"(s.at >= 0 AND (t.mine AND s.depth = 0 OR {depth} < 0))"
    begins = f"((s.at < 0 OR {again}) AND s.i >= 0 AND t.starts AND NOT t.alone)"  # token 0 is the text before any tag
    span = "named_struct('a', {}, 'b', {})"
    fold = f"""aggregate({done}, named_struct('i', -1, 'at', -1, 'depth', 0, 'found', cast(array() AS array<struct<a:int,b:int>>)),
      (s, t) -> named_struct('i', s.i + 1,
        'at', CASE WHEN {begins} THEN s.i + 1 WHEN {ends} THEN -1 ELSE s.at END,
        'depth', CASE WHEN s.at < 0 OR {ends} THEN 0 ELSE {depth} END,
        'found', CASE WHEN {ends} THEN array_append(s.found, {span.format('s.at', 's.i + 1')})
                      WHEN s.at < 0 AND s.i >= 0 AND t.starts AND t.alone THEN array_append(s.found, {span.format('s.i + 1', 's.i + 2')}) ELSE s.found END),
      s -> if(s.at >= 0, array_append(s.found, {span.format('s.at', 's.i + 1')}), s.found))"""
    opening = f"regexp_extract(get(p, e.a), {quoted('^' + _REST)}, 0)"
    cut = f"""transform({fold}, e -> named_struct('open', concat({opening}, '>'),
      'inner', substr(array_join(slice(p, e.a + 1, e.b - e.a), '<'), length({opening}) + 2)))"""
    tokens = f"split({x}, {quoted(f'(?i)<(?=/?(?:{tag}|{outer})[{chr(92)}s/>])')}, -1)"
    # the tokens are bound to a name, so that they are made once a page and not once for every element
    return f"""CASE WHEN {x} IS NOT NULL THEN if({has_tag(x, tag, classes, attrs)}, get(transform(array({tokens}), p -> {cut}), 0),
      cast(array() AS array<struct<open:string,inner:string>>)) END"""


def inners(x: str, tag: str, classes: tuple[str, ...] = (), attrs: dict[str, str] | None = None) -> str:
    """Only the contents of :func:`elements`."""
    return f"transform({elements(x, tag, classes, attrs)}, e -> e.inner)"


def each(array: str, body: str, var: str = "v") -> str:
    """``body`` over every item ``var`` of an array of arrays' worth, in one array."""
    return f"flatten(transform({array}, {var} -> {body}))"


# --- texts ------------------------------------------------------------------------------------------

def own_texts(x: str) -> str:
    """Texts that stand directly in an element, not in elements inside it, in order: a fold over all its tags with the depth."""
    alone = f"rlike(t, {quoted(f'(?i)^(?:{VOID})[{chr(92)}s/>]|^{_REST}(?<=/)>')})"
    moves = f"transform(p, (t, i) -> CASE WHEN i = 0 THEN 0 WHEN startswith(t, '/') THEN -1 WHEN {alone} THEN 0 ELSE 1 END)"
    fold = f"""aggregate({moves}, named_struct('i', 0, 'depth', 0, 'at', cast(array() AS array<int>)),
      (s, m) -> named_struct('i', s.i + 1, 'depth', greatest(s.depth + m, 0),
        'at', if(greatest(s.depth + m, 0) = 0, array_append(s.at, s.i), s.at)), s -> s.at)"""
    text = f"if(i = 0, get(p, 0), regexp_replace(get(p, i), {quoted(f'^{_REST}>?')}, ''))"
    found = f"get(transform(array(split({x}, '<(?=/?[a-zA-Z])', -1)), p -> filter(transform({fold}, i -> {text}), w -> w <> '')), 0)"
    return f"""CASE WHEN contains({x}, '<') THEN {found}
      WHEN {x} <> '' THEN array({x}) ELSE cast(array() AS array<string>) END"""


def texts_of(x: str, tag: str, classes: tuple[str, ...] = (), attrs: dict[str, str] | None = None) -> str:
    """Texts that stand directly in the elements found."""
    return each(inners(x, tag, classes, attrs), own_texts("w"), "w")


def first_text(x: str, tag: str, classes: tuple[str, ...] = (), attrs: dict[str, str] | None = None) -> str:
    """First text that stands directly in an element found; NULL if there is none."""
    return f"get({texts_of(x, tag, classes, attrs)}, 0)"


def leading_text(x: str) -> str:
    """First text that is not blank, at any depth; NULL if there is none."""
    return f"get(filter(split({x}, {quoted(f'<{_REST}>')}, -1), q -> rlike(q, {quoted(chr(92) + 'S')})), 0)"


def html_text(c: Column) -> Column:
    """P10: text nodes outside script/style/comments, entity-decoded, stripped, joined by one space."""
    body = F.regexp_replace(c, "(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", "")
    pieces = F.split(body, "<[^>]*>")
    pieces = F.transform(pieces, lambda p: py_strip(decode_entities(p)))
    return F.array_join(F.filter(pieces, lambda p: F.length(p) > 0), " ")
