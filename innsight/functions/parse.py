"""Scalar parsing helpers of the extraction and normalisation steps (JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from innsight.functions.keys import py_strip


def score_normalise(c: Column) -> Column:
    """Comma decimal -> dot, then a double; anything else -> NULL (never raises)."""
    return F.regexp_replace(c.cast("string"), ",", ".").try_cast("double")


def dotted_count(c: Column) -> Column:
    """Thousands-dotted count ('1.234 đánh giá') -> 1234: first word after removing dots."""
    words = F.split(py_strip(F.regexp_replace(c, "\\.", "")), "(?U)\\s+")
    return F.get(words, 0).try_cast("int")


def price_vnd(c: Column) -> Column:
    """Dotted price text '1.050.000' -> 1050000 (bigint), NULL when not a number."""
    return F.regexp_replace(py_strip(c), "\\.", "").try_cast("bigint")


def url_path_segment(c: Column) -> Column:
    """Fourth '/'-piece of the URL path, up to its first dot ('/hotel/vn/abc.vi.html' -> 'abc')."""
    # by pattern, not by a URL parser: those give NULL for blanks, braces or pipes, which links contain
    path = F.regexp_extract(c, "(?s)^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    seg = F.get(F.split(path, "/"), 3)
    return F.get(F.split(seg, "\\."), 0)


def form_url_encode(c: Column) -> Column:
    """application/x-www-form-urlencoded value as Python's urlencode writes it.

    Spark's url_encode leaves '*' and writes '~' as %7E; Python does the reverse.
    """
    e = F.url_encode(c)
    return F.replace(F.replace(e, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def review_date_parse(c: Column, prefix: str = "Reviewed: ") -> Column:
    """'Reviewed: 3 March 2023' -> DATE 2023-03-03; NULL when it does not parse."""
    return F.try_to_date(py_strip(F.replace(c, F.lit(prefix), F.lit(""))), "d MMMM yyyy")


def epoch_ms_date(c: Column) -> Column:
    """Epoch milliseconds -> UTC calendar date, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(c.cast("double") / F.lit(86400000.0)).cast("int"))


def text_after(c: Column, sep: str = ": ") -> Column:
    """Text after the first ``sep`` (second piece); NULL when there is none."""
    return F.get(F.split(c, _quote_re(sep)), 1)


def _quote_re(s: str) -> str:
    import re

    return re.escape(s)


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970-01-01 of a TIMESTAMP_NTZ (wall clock taken as UTC), no session zone involved."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
