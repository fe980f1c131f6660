"""Licence scan by canonical digest lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: spellings that count as equal (from, to), after lower-casing; no "to" holds its "from"
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"),
    ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfill", "fulfil"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"),
    ("licence", "license"), ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"), ("noncommercial", "non commercial"), ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"), ("per cent", "percent"), ("sub license", "sublicense"),
]

# --- fixed values: texts of known licences
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

"""
_ZERO = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

"""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.

"""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: Known licences: (id, text). The short notices are whole texts and whole lines too.
KNOWN_LICENSES = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("ISC", _ISC + _AS_IS), ("ISC", "ISC License\n\n" + _ISC + _AS_IS),
    ("0BSD", _ZERO + _AS_IS), ("0BSD", "BSD Zero Clause License\n\n" + _ZERO + _AS_IS),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Released under CC0 1.0 Universal."),
]

#: Other usual titles of the same texts.
_TITLES = [(_MIT, "MIT", ("The MIT License (MIT)", "The MIT License", "MIT License (MIT)")),
           (_ISC + _AS_IS, "ISC", ("The ISC License", "ISC License (ISC)", "The ISC License (ISC)")),
           (_ZERO + _AS_IS, "0BSD", ("Zero-Clause BSD", "Zero-Clause BSD License", "BSD Zero Clause License (0BSD)")),
           (_BSD_HEAD + _BSD_TAIL, "BSD-2-Clause", ("The 2-Clause BSD License", "The BSD 2-Clause License", "Simplified BSD License",
                                                    'BSD 2-Clause "Simplified" License')),
           (_BSD_HEAD + _BSD_THIRD + _BSD_TAIL, "BSD-3-Clause", ("The 3-Clause BSD License", "The BSD 3-Clause License",
                                                                'BSD 3-Clause "New" or "Revised" License'))]
KNOWN_LICENSES += [(i, f"{title}\n\n{text}") for text, i, titles in _TITLES for title in titles]

#: A line that only states a copyright: it names the owner, so no two are equal.
COPYRIGHT_LINE = r"(?m)^[ \t#*;/-]*(?:copyright\b|\(c\)|©)[^\n]*(?:\d{4}|all rights reserved)[^\n]*$"
#: More such lines, for the lookup of whole texts: rights reserved alone or an owner behind a sign (OWNED), and owners named
#: without a year, unless the line goes on with one of NO_OWNER.
MARGIN = r"[ \t#*;/-]*"
OWNED = r"(?:all rights reserved[ \t\r.!]*|(?:copyright[ \t]*(?:\(c\)|©|by\b)|\(c\)|©)[^\n]*)"
NO_OWNER = r"(?:holder|owner|notice|law|licen|and\b|or\b)"
OWNER_LINE = rf"(?m)^{MARGIN}(?:{OWNED}|copyright[ \t]+(?!{NO_OWNER})[^\n]{{1,60}})$"
PUNCTUATION = r"[!-/:-@\[-`{-~“”‘’«»–—…©\t\r\f\x0B ]+"


def canonical_lines(text: Column) -> Column:
    """Canonical text, line by line: lower case, no copyright lines, no punctuation, one spelling, single spaces."""
    c = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    c = F.regexp_replace(c, PUNCTUATION, " ")
    for a, b in SPELLINGS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(c, " +", " "), "(?m)^ | $", "")


def known_digests(spark: SparkSession, known: Sequence[tuple[str, str]] = KNOWN_LICENSES) -> DataFrame:
    """(license_id, digest) of the known licences, canonicalised as documents are; one row per digest."""
    entries = F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("t")) for i, t in known])
    lic = spark.range(1).select(F.inline(entries))
    return (lic.select("license_id", lookup_digest(F.col("t"), canonical_lines(F.col("t"))).alias("digest"))
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def whole_digest(canonical: Column) -> Column:
    return F.sha2(F.trim(F.regexp_replace(canonical, "[ \n]+", " ")), 256)


def lookup_digest(text: Column, canonical: Column) -> Column:
    """Digest by which a whole text is looked up: it depends neither on where lines wrap nor on copyright lines of any form.

    ``canonical`` is the text's. Of the spellings only those of two words can meet where lines were joined.
    """
    low = F.lower(text)
    c = F.when(low.rlike(OWNER_LINE), canonical_lines(F.regexp_replace(low, OWNER_LINE, ""))).otherwise(canonical)
    c = F.trim(F.regexp_replace(c, "[ \n]+", " "))
    for a, b in SPELLINGS:
        if " " in a:
            c = F.replace(c, F.lit(a), F.lit(b))
    return F.sha2(c, 256)


#: A list of at most so many known texts is broadcast (a digest and an id each: under 2 MB); a longer one is shuffled.
BROADCAST_KNOWN = 10_000


def scan_licenses(docs: DataFrame, text_col: str,
                  known: Sequence[tuple[str, str]] = KNOWN_LICENSES) -> DataFrame:
    """Look up the digest of every whole canonical text, and of each of its lines, among known licence digests.

    docs -> its columns and ``license_digest`` (of the whole text, line by line; null if the
    text is null), ``license_id`` (by ``lookup_digest``, however its lines wrap; null: not a known text), ``line_license_ids``
    (sorted, distinct licences stated by whole lines; never null). Columns of
    ``docs`` with these names are replaced. An empty text, or one of nothing but
    copyright lines and punctuation, matches no licence. A text listed for two
    licences goes by the smaller id. Repeated rows each get their own result.

    Both lookups are one equi-join on the digest. Of a document's lines only
    distinct digests that matched go into the shuffle that puts rows together again; texts never do.
    """
    out = ("license_digest", "license_id", "line_license_ids")
    carry = [c for c in docs.columns if c not in out]
    text = F.col(f"`{text_col}`").cast("string")
    base = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)],
                       text.alias("t"), canonical_lines(text).alias("canon"))
    empty = F.sha2(F.lit(""), 256)
    lines = F.array_distinct(F.transform(F.filter(F.split("canon", "\n"), lambda x: F.length(x) > 0), whole_digest))
    base = base.select(*[f"c{i}" for i in range(len(carry))], whole_digest(F.col("canon")).alias("digest"),
                       lookup_digest(F.col("t"), F.col("canon")).alias("wanted"),
                       F.coalesce(lines, F.array().cast("array<string>")).alias("lines"),
                       F.monotonically_increasing_id().alias("row"))
    hits = known_digests(docs.sparkSession, known).where(F.col("digest") != empty).select(
        F.col("digest").alias("kd"), "license_id")
    if len(known) <= BROADCAST_KNOWN:
        hits = F.broadcast(hits)
    # position 0 carries the row itself, the others one line digest each
    units = base.select(*[f"c{i}" for i in range(len(carry))], "digest", "row",
                        F.posexplode(F.concat(F.array(F.coalesce("wanted", F.lit(""))), "lines")).alias("pos", "u"))
    found = units.join(hits, F.col("u") == F.col("kd"), "left").where((F.col("pos") == 0) | F.col("kd").isNotNull())
    whole = F.col("pos") == 0
    res = found.groupBy("row").agg(
        *[F.any_value(F.when(whole, F.col(f"c{i}")), True).alias(f"c{i}") for i in range(len(carry))],
        F.any_value(F.when(whole, F.col("digest")), True).alias("license_digest"),
        F.max(F.when(whole, F.col("license_id"))).alias("license_id"),
        F.array_sort(F.collect_set(F.when(~whole, F.col("license_id")))).alias("line_license_ids"))
    return res.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], *out)
