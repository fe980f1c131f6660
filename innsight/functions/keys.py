"""Name and room-type keys (Column -> Column, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes the characters for which str.isspace() is true.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")
# `.` stops only at "\n" (UNIX_LINES), as in Python's re.
_CUT_CONTACT = "(?d)(Phone|sđt).*"
_OUTSIDE_INSIDE = "(?d)^(.*?)\\((.*?)\\)$"

# ---------------------------------------------------------------------------
# Room-type keywords and their Vietnamese variants, in table
# order. Keep the surrounding spaces of " phòng loại sang " and
# " phòng bốn người"; they are part of the values.
ROOM_KEYWORDS: list[tuple[str, list[str]]] = [
    ("bed in", ["giường trong phòng"]),
    ("deluxe double room", ["phòng đôi loại sang", "phòng deluxe giường đôi"]),
    ("deluxe room", [" phòng loại sang ", "phòng deluxe"]),
    ("balcony", ["ban công"]),
    ("standard", ["tiêu chuẩn"]),
    ("classic", ["cổ điển"]),
    ("double room", ["phòng đôi"]),
    ("single room", ["phòng đơn"]),
    ("triple room", ["phòng 3 người", "phòng ba người"]),
    ("quadruple room", ["phòng 4 người", " phòng bốn người"]),
    ("dormitory room", ["phòng tập thể"]),
    ("family room", ["phòng gia đình"]),
    ("king room", ["giường lớn", "giường cỡ king"]),
    ("queen room", ["giường cỡ queen", "giường đôi lớn"]),
    ("extra bed", ["giường phụ"]),
    ("private bathroom", ["phòng tắm riêng"]),
]
# ---------------------------------------------------------------------------


def py_strip(c: Column) -> Column:
    """Strip whitespace at both ends as Python's str.strip() does (Spark ``trim``
    removes spaces only); a character-set ``btrim``, no regex."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def clean_homename(c: Column) -> Column:
    """K1: cut from 'Phone' or 'sđt' (case-sensitive) to the end of the line, strip."""
    return py_strip(F.regexp_replace(c, _CUT_CONTACT, ""))


def needle_outside(c: Column) -> Column:
    """Outside part of a name shaped 'outside (inside)', else NULL."""
    return F.when(c.rlike(_OUTSIDE_INSIDE), py_strip(F.regexp_extract(c, _OUTSIDE_INSIDE, 1)))


def needle_inside(c: Column) -> Column:
    """Inside part of a name shaped 'outside (inside)', else NULL."""
    return F.when(c.rlike(_OUTSIDE_INSIDE), py_strip(F.regexp_extract(c, _OUTSIDE_INSIDE, 2)))


def match_needle(c: Column) -> Column:
    """K2: the cleaned text searched for: the outside part when the name has one."""
    return clean_homename(F.coalesce(needle_outside(c), c))


def fallback_needle(c: Column) -> Column:
    """K3: cleaned inside part (the second try), NULL when the name has none."""
    return clean_homename(needle_inside(c))


def shorten_room_type(c: Column, keywords: list[tuple[str, list[str]]] | None = None) -> Column:
    """K4: keywords whose text or any variant occurs in the lower-cased type, table order."""
    table = ROOM_KEYWORDS if keywords is None else keywords
    low = F.lower(c)
    parts = []
    for kw, variants in table:
        hit = low.contains(kw)
        for v in variants:
            hit = hit | low.contains(v)
        parts.append(F.when(hit, F.lit(kw)))
    return F.concat_ws(" ", *parts)


def room_keywords_sql(col: str, keywords: list[tuple[str, list[str]]] | None = None) -> str:
    """The same key as ANSI SQL text (for oracles)."""
    table = ROOM_KEYWORDS if keywords is None else keywords

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    parts = []
    for kw, variants in table:
        conds = " OR ".join(f"contains(lower({col}), {q(t)})" for t in [kw, *variants])
        parts.append(f"CASE WHEN {conds} THEN {q(kw)} END")
    return "concat_ws(' ', " + ", ".join(parts) + ")"
