"""Multi-source entity resolution (DataFrame -> DataFrame).

Input model: one ``homes`` frame for all sources with columns
``source, id, seq bigint, homename string, city <any comparable>`` (ids and
sources of any type)
plus attribute columns (url, rating, cheapest_price, address, description,
property_highlights, images). ``seq`` is the stored order inside a source.

Plan notes (scale)
------------------
* first_per_name is ``groupBy`` + ``min_by``: partial aggregation, so a name held
  by a third of all rows collapses map-side instead of filling one window task.
* containment_match never pairs a city with itself. Needles of 3+ characters
  join on (city, source, rarest gram of the needle; longer grams where 3-grams are common) and are verified with
  ``contains``; 1-2 character needles join to a pre-aggregated table of the best
  name per (city, source, substring); an empty needle joins to the best name per
  (city, source). Every per-key table is built with partial aggregates.
* claim_once is an aggregate (min of (pass, anchor order) per matched id) joined
  back, not a window, for the same reason.
* Passes are sequential only through small anchor/match tables; matching itself
  is computed once for all anchors of all sources.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.functions.keys import match_needle, shorten_room_type
from innsight.operators.components import components
from innsight.operators.numbering import running_number
from innsight.session import ensure_checkpoint_dir, freed, task_count, written

HOME_ATTRS = ["url", "rating", "cheapest_price", "address", "description", "property_highlights", "images"]


# --- W1 / A1 -----------------------------------------------------------------------

def first_per_name(homes: DataFrame, name: str = "homename", order: str = "seq",
                   by: Sequence[str] = ("source",)) -> DataFrame:
    """The first stored row (lowest ``order``) of every distinct name per source.

    Rows without a name are dropped (as in A1); a NULL order comes after all others.
    """
    cols = [c for c in homes.columns]
    keys = [*by, name]
    rank = F.struct(F.col(order).isNull(), F.col(order))
    agg = homes.where(F.col(name).isNotNull()).groupBy(*keys).agg(
        F.min_by(F.struct(*[c for c in cols if c not in keys]), rank).alias("_r"))
    return agg.select(*keys, "_r.*").select(*cols)


def distinct_homenames(homes: DataFrame, name: str = "homename", by: Sequence[str] = ("source",)) -> DataFrame:
    """A1: distinct names (per source)."""
    return homes.select(*by, name).where(F.col(name).isNotNull()).distinct()


# --- J3 / W2 -----------------------------------------------------------------------

def _grams(s: Column, n: int) -> Column:
    """Distinct substrings of length n of s (empty array when s is shorter)."""
    seq = F.sequence(F.lit(1), F.length(s) - (n - 1))
    return F.when(F.length(s) >= n, F.array_distinct(F.transform(seq, lambda i: F.substring(s, i, n)))) \
        .otherwise(F.array().cast("array<string>"))


def _dealt(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, in files of as many tasks as work that is heavy by row asks for: few bytes make many grams, and every level reads them."""
    return written(df.repartition(task_count(df.sparkSession)), name)


#: A gram that more names of a block hold than this is too common to find names by: longer ones are taken.
COMMON_GRAM = 64


def _gram_levels(needles: DataFrame, texts: DataFrame, by: list[str], group: list[str], allowed=lambda df: df) -> list[tuple[DataFrame, DataFrame]]:
    """How needles of 3+ characters find the texts that hold them: (chosen, grams) per level of gram lengths.

    needles: ``by``, ``_needle`` and more; texts: ``by``, ``group``, ``_lname`` and more. ``chosen`` adds to a needle a value of
    ``group``, the ``_gram`` its texts are found by and ``_whole`` (the gram is the needle); ``grams`` are the texts by gram.
    A needle takes the rarest of its 3-grams if at most ``COMMON_GRAM`` texts of the block hold it; else it goes on with grams
    of twice the length (at most its own), over the blocks that still have such a needle. A gram as long as its needle
    holds it for certain. A needle with a gram that no text has finds nothing.
    """
    cols = needles.columns
    rest = allowed(needles.where(F.length("_needle") >= 3).withColumn("_g", F.lit(3)).join(texts.select(*by, *group).distinct(), by))
    levels, first = [], True
    while True:
        if first:  # every text has its 3-grams
            grams = texts.withColumn("_g", F.lit(3))
        else:
            grams = texts.join(rest.select(*by, *group, "_g").distinct(), [*by, *group])
        grams = grams.where("length(_lname) >= _g").select(*texts.columns, F.explode(F.expr(
            "array_distinct(transform(sequence(1, length(_lname) - _g + 1), i -> substring(_lname, i, _g)))")).alias("_gram"))
        freq = grams.groupBy(*by, *group, "_gram").agg(F.count(F.lit(1)).alias("_freq"))
        own = rest.withColumn("_own", F.expr("array_distinct(transform(sequence(1, length(_needle) - _g + 1), i -> substring(_needle, i, _g)))"))
        own = own.select(*cols, *group, "_g", F.size("_own").alias("_n"), F.explode("_own").alias("_gram"))
        rare = own.join(freq.hint("merge"), [*by, *group, "_gram"]).groupBy(*cols, *group, "_g", "_n").agg(
            F.count(F.lit(1)).alias("_hit"), F.min(F.struct("_freq", "_gram")).alias("_r"))
        with freed(needles.sparkSession) as keep:
            rare = keep(written(rare.where("_hit = _n").select(
                *cols, *group, "_g", F.col("_r._gram").alias("_gram"), (F.col("_g") == F.length("_needle")).alias("_whole"),
                (F.col("_r._freq") > COMMON_GRAM).alias("_common")), "rare-grams"))
        levels.append((rare.where("_whole or not _common").drop("_g", "_common"), grams))
        rest = rare.where("_common and not _whole").select(*cols, *group, F.least(F.col("_g") * 2, F.length("_needle")).alias("_g"))
        if rest.isEmpty():
            return levels
        first = False


def containment_match(anchors: DataFrame, candidates: DataFrame, key: Sequence[str] = ("anchor_source", "anchor_id"),
                      anchor_group: str | None = "anchor_source", by: Sequence[str] = ("city",),
                      group: str = "source", name: str = "homename", cid: str = "id", stored: bool = False) -> DataFrame:
    """J3 + W2: best candidate per anchor and candidate group.

    anchors: ``key`` columns, ``by`` columns and ``needle`` (cleaned, lower-cased).
    candidates: ``by``, ``group``, ``name``, ``cid``. A candidate matches when it
    has the anchor's ``by`` values, another ``group`` than ``anchor_group`` and its
    lower-cased name contains the needle. Best = lowest (name, id), binary order.
    Returns ``key`` + ``group`` + ``match_name`` + ``match_id``. With ``stored`` what a level finds is a table of its own, so
    the shuffled grams of two levels never lie on disk together.
    """
    key, by = list(key), list(by)
    spark = anchors.sparkSession
    cand = candidates.select(*by, group, name, cid).where(F.col(name).isNotNull())
    for b in by:
        cand = cand.where(F.col(b).isNotNull())
    # identical names in one (city, source) compete only through their lowest id
    cand = cand.groupBy(*by, group, name).agg(F.min(cid).alias(cid)).withColumn("_lname", F.lower(F.col(name)))
    cand = _dealt(cand, "names")
    best = F.struct(F.col(name).alias("match_name"), F.col(cid).alias("match_id"))

    anc = anchors.select(*key, *by, F.col("needle").alias("_needle")).where(F.col("_needle").isNotNull())
    for b in by:
        anc = anc.where(F.col(b).isNotNull())
    # anchors with the same needle are matched once: the verify join sees distinct needles only
    same = ([anchor_group] if anchor_group else []) + by + ["_needle"]
    needles = _dealt(anc.select(*same).distinct(), "needles")
    nlen = F.length("_needle")

    def other_group(df: DataFrame) -> DataFrame:
        return df.where(F.col(anchor_group) != F.col(group)) if anchor_group else df

    # 0-2 characters: exact substring table, pre-aggregated per (city, source,
    # substring); the empty needle is the substring '' that every name has
    parts = []
    subs = cand.select(*by, group, best.alias("_b"), F.explode(F.concat(
        F.array(F.lit("")), _grams(F.col("_lname"), 1), _grams(F.col("_lname"), 2))).alias("_needle"))
    s_tab = subs.groupBy(*by, group, "_needle").agg(F.min("_b").alias("_m"))
    short = other_group(needles.where(nlen <= 2).join(s_tab, [*by, "_needle"])).select(*same, group, "_m")

    def add(part: DataFrame) -> None:
        if stored:
            with freed(spark) as keep:
                part = keep(written(part, "found"))
        parts.append(part)

    if not needles.where(nlen <= 2).isEmpty():
        add(short)

    # 3+ characters: the rarest gram of the needle finds the names, which are verified by contains; where the gram is
    # the whole needle, the best name of the gram is the answer
    for chosen, grams in _gram_levels(needles, cand, by, [group], other_group):
        some, whole = chosen.where("not _whole"), chosen.where("_whole")
        if not some.isEmpty():
            pairs = some.join(grams, [*by, group, "_gram"]).where(F.col("_lname").contains(F.col("_needle")))
            add(pairs.groupBy(*same, group).agg(F.min(best).alias("_m")))
        if not whole.isEmpty():
            tops = grams.groupBy(*by, group, "_gram").agg(F.min(best).alias("_m"))
            add(whole.join(tops, [*by, group, "_gram"]).select(*same, group, "_m"))

    out = anc.join(_union(parts or [short]), same)
    return out.select(*key, group, F.col("_m.match_name").alias("match_name"), F.col("_m.match_id").alias("match_id"))


def anchors_of(homes_first: DataFrame, use_inside: bool = False) -> DataFrame:
    """Anchor rows of W1 output with the cleaned, lower-cased needle (K1/K2)."""
    from innsight.functions.keys import fallback_needle

    nd = fallback_needle(F.col("homename")) if use_inside else match_needle(F.col("homename"))
    return homes_first.select(F.col("source").alias("anchor_source"), F.col("id").alias("anchor_id"),
                              F.col("seq").alias("anchor_seq"), "homename", "city", F.lower(nd).alias("needle"))


def best_matches(homes: DataFrame, use_inside_fallback: bool = False, w1: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """J3 for every W1 anchor of every source against every other source.

    With ``use_inside_fallback`` (K3), anchors shaped 'outside (inside)' that find
    nothing with the outside part try the inside part.
    """
    if w1 is None:
        w1 = first_per_name(homes)
    anc = anchors_of(w1)
    m = containment_match(anc, homes, stored=stored)
    if use_inside_fallback:
        inside = anchors_of(w1, use_inside=True).where(F.col("needle").isNotNull())
        m2 = containment_match(inside, homes, stored=stored)
        m2 = m2.join(m.select("anchor_source", "anchor_id", "source"), ["anchor_source", "anchor_id", "source"], "left_anti")
        m = m.withColumn("used_inside", F.lit(False)).unionByName(m2.withColumn("used_inside", F.lit(True)))
    return m


# --- O1 / O2 / W3 / J4 ---------------------------------------------------------------

def resolve_passes(homes: DataFrame, sources: Sequence = (1, 2, 3),
                   use_inside_fallback: bool = False) -> tuple[DataFrame, DataFrame]:
    """O1 core: anchors of every pass and their matches with the claim flag.

    Returns (anchors, matches):
      anchors: pass, anchor_source, anchor_id, anchor_seq, homename, city
      matches: pass, anchor_source, anchor_id, anchor_seq, source, match_id, match_name, owned
    Pass p takes the W1 rows of source p not matched by an earlier pass (J4).
    A matched id gives rooms and reviews ("owned") only to the first anchor that
    claims it: earliest pass, then anchor order (W3).
    """
    # W1 and the match table are read by every pass, and a pass by every later one and by the claim rule: each is
    # written once, so a plan starts from small scans, whose tasks follow their size, and a lost executor replays no pass.
    spark = homes.sparkSession
    ensure_checkpoint_dir(spark)
    with freed(spark):
        w1 = written(first_per_name(homes.select("source", "id", "seq", "homename", "city")), "first-homes")
        anc_all = anchors_of(w1, use_inside=False)
        with freed(spark) as keep:
            m_all = keep(written(best_matches(homes, use_inside_fallback, w1=w1, stored=True), "matches"))
        pass_anchors, pass_matches = [], []
        for p_idx, src in enumerate(sources, start=1):
            a = anc_all.where(F.col("anchor_source") == src)
            if pass_matches:
                claimed = _union(pass_matches).where(F.col("source") == src).select(F.col("match_id").alias("anchor_id"))
                a = a.join(claimed, "anchor_id", "left_anti")
            a = written(a.withColumn("pass", F.lit(p_idx)), "pass")
            m = m_all.join(a.select("anchor_source", "anchor_id", "anchor_seq", "pass"), ["anchor_source", "anchor_id"])
            pass_anchors.append(a)
            pass_matches.append(written(m, "pass-matches"))
        anchors = _union(pass_anchors).select("pass", "anchor_source", "anchor_id", "anchor_seq", "homename", "city")
        matches = _union(pass_matches)
        claim = matches.groupBy("source", "match_id").agg(F.min(F.struct("pass", "anchor_seq")).alias("_c"))
        matches = matches.join(claim, ["source", "match_id"]).withColumn(
            "owned", (F.col("_c.pass") == F.col("pass")) & (F.col("_c.anchor_seq") == F.col("anchor_seq"))).drop("_c")
        matches = matches.select("pass", "anchor_source", "anchor_id", "anchor_seq", "source", "match_id", "match_name", "owned")
        # both are read by the assembled row, the details and the documents: a reliable checkpoint in the shared folder cuts the lineage
        anchors, matches = anchors.checkpoint(eager=True), matches.checkpoint(eager=True)
    return anchors, matches


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def claimed_ids(matches: DataFrame) -> DataFrame:
    """O2: ids matched by any pass (the set the reference grows)."""
    return matches.select("source", F.col("match_id").alias("id")).distinct()


def combine_three_sources(homes: DataFrame, sources: Sequence = (1, 2, 3),
                          use_inside_fallback: bool = False) -> DataFrame:
    """O1 + P16 + P17: one row per anchor of every pass.

    Columns: pass, anchor_id, homename, city, and per source s: id_s (anchor or
    match), own_s (rooms/reviews given), rating_s, price_s, url_s ('' when no
    match); description, address, property_highlights, images are the first
    non-empty value in source order (else the last source's value or '' / []).
    """
    anchors, matches = resolve_passes(homes, sources, use_inside_fallback)
    return combine_from(anchors, matches, homes, sources)


def combine_from(anchors: DataFrame, matches: DataFrame, homes: DataFrame,
                 sources: Sequence = (1, 2, 3)) -> DataFrame:
    """Assemble the per-anchor row of :func:`combine_three_sources` from resolved passes."""
    # long form: (pass, anchor_id) x (source, id, own)
    own_rows = anchors.select("pass", "anchor_id", F.col("anchor_source").alias("source"),
                              F.col("anchor_id").alias("hid"), F.lit(True).alias("own"))
    match_rows = matches.select("pass", "anchor_id", "source", F.col("match_id").alias("hid"), F.col("owned").alias("own"))
    long = own_rows.unionByName(match_rows)
    attrs = [c for c in HOME_ATTRS if c in homes.columns]
    h = homes.select("source", F.col("id").alias("hid"), *attrs)
    j = long.join(h, ["source", "hid"])
    aggs = []
    for s in sources:
        hit = F.col("source") == s
        aggs.append(F.max(F.when(hit, F.col("hid"))).alias(f"id_{s}"))
        aggs.append(F.max(F.when(hit, F.col("own"))).alias(f"own_{s}"))
        for a in attrs:
            aggs.append(F.max_by(F.when(hit, F.col(a)), F.when(hit, F.lit(1))).alias(f"_{a}_{s}"))
    wide = j.groupBy("pass", "anchor_id").agg(*aggs)
    out = anchors.select("pass", "anchor_id", "homename", "city").join(wide, ["pass", "anchor_id"])
    sel = [F.col("pass"), F.col("anchor_id"), F.col("homename"), F.col("city")]
    for s in sources:
        sel += [F.col(f"id_{s}"), F.coalesce(F.col(f"own_{s}"), F.lit(False)).alias(f"own_{s}")]
    for a, outname in (("rating", "rating"), ("cheapest_price", "price"), ("url", "url")):
        if a in attrs:
            sel += [per_source_value(F.col(f"id_{s}"), F.col(f"_{a}_{s}")).alias(f"{outname}_{s}") for s in sources]
    for a in ("description", "address", "property_highlights", "images"):
        if a in attrs:
            sel.append(truthy_coalesce([F.col(f"_{a}_{s}") for s in sources],
                                       is_array=a in ("property_highlights", "images"),
                                       last_present=F.col(f"id_{sources[-1]}").isNotNull()).alias(a))
    return out.select(*sel)


def truthy_coalesce(values: list[Column], is_array: bool = False, last_present: Column | None = None) -> Column:
    """First value that is not NULL, '' or []; else the last source's value ('' / [] if absent)."""
    empty = F.array().cast("array<string>") if is_array else F.lit("")
    picks = []
    for v in values[:-1]:
        picks.append(F.when(F.size(v) > 0, v) if is_array else F.when(v != "", v))
    last = values[-1]
    if last_present is not None:
        last = F.when(last_present, F.coalesce(last, empty)).otherwise(empty)
    return F.coalesce(*picks, F.coalesce(last, empty))


def per_source_value(matched_id: Column, value: Column) -> Column:
    """Value of a source's home, '' when the source has no match (or no value)."""
    return F.when(matched_id.isNull(), F.lit("")).otherwise(F.coalesce(value.cast("string"), F.lit("")))


# --- J1 / J2 / A3 ---------------------------------------------------------------------

def details_of(anchors: DataFrame, matches: DataFrame, homes: DataFrame) -> DataFrame:
    """(pass, anchor_id, source, homename) of every home that gives its rooms and reviews."""
    own = anchors.select("pass", "anchor_id", F.col("anchor_source").alias("source"), "homename")
    got = matches.where("owned").select("pass", "anchor_id", "source", F.col("match_name").alias("homename"))
    return own.unionByName(got)


def rows_of_home(details: DataFrame, rows: DataFrame) -> DataFrame:
    """All rows (rooms or reviews) of the same source with exactly the home's name."""
    return details.join(rows, ["source", "homename"])


def nest_by_source(rows: DataFrame, key: Sequence[str], sources: Sequence = (1, 2, 3),
                   payload: Sequence[str] = ("review_id",), order: str = "seq") -> DataFrame:
    """A3: per key, one array per source of the rows' payload, in stored order.

    The arrays hold one property's rows; use :func:`nest_in_chunks` where a key
    may be hot, or :func:`count_by_source` for a bounded summary.
    """
    item = F.struct(F.col(order).alias("_o"), *[F.col(c) for c in payload])
    aggs = [F.array_sort(F.collect_list(F.when(F.col("source") == s, item))).alias(f"rows_{s}") for s in sources]
    return rows.groupBy(*key).agg(*aggs)


def nest_in_chunks(rows: DataFrame, key: Sequence[str], payload: Sequence[str] = ("review_id",), order: str = "seq",
                   size: int = 1_000) -> DataFrame:
    """A3 for keys of any size: (key, source, chunk, rows), at most ``size`` rows each, in stored order.

    Chunk 0 holds the first rows of a key and source, chunk 1 the next, and so on; only the last may hold fewer. Rows are numbered by
    :func:`running_number`, so the chunks of a hot key are built by different tasks. Ties of ``order`` follow the payload.
    """
    parts = [*key, "source"]
    n = running_number(rows.select(*parts, F.col(order).alias("_o"), *[F.col(c).alias(f"_p{i}") for i, c in enumerate(payload)]),
                       parts, [F.col("_o"), *[F.col(f"_p{i}") for i in range(len(payload))]], "_n")
    item = F.struct("_n", *[F.col(f"_p{i}").alias(c) for i, c in enumerate(payload)])
    grouped = n.withColumn("chunk", F.expr(f"_n div {int(size)}")).groupBy(*parts, "chunk").agg(F.array_sort(F.collect_list(item)).alias("_rows"))
    return grouped.select(*parts, "chunk", F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in payload])).alias("rows"))


def count_by_source(rows: DataFrame, key: Sequence[str], sources: Sequence = (1, 2, 3),
                    value: str | None = None) -> DataFrame:
    """A3 summary: per key and source the row count (and sum of ``value``)."""
    aggs = []
    for s in sources:
        hit = F.col("source") == s
        aggs.append(F.count(F.when(hit, 1)).cast("bigint").alias(f"n_{s}"))
        if value:
            aggs.append(F.sum(F.when(hit, F.col(value))).alias(f"sum_{s}"))
    return rows.groupBy(*key).agg(*aggs)


# --- K4 / J5 -----------------------------------------------------------------------------

def with_room_key(rooms: DataFrame, keywords=None, col: str = "roomtype", out: str = "room_key") -> DataFrame:
    return rooms.withColumn(out, shorten_room_type(F.col(col), keywords))


MATCH_MODES = ("reference", "merge_equal")


def _check_mode(mode: str) -> None:
    if mode not in MATCH_MODES:
        raise ValueError(f"mode must be one of {MATCH_MODES}, not {mode!r}")


def _contained(strings: DataFrame, by: str, col: str) -> DataFrame:
    """(by, x, y): distinct strings x, y of one ``by`` value where y contains x, x <> y.

    A string of 3+ characters joins the strings that hold its rarest gram
    (see :func:`_gram_levels`; verified by ``contains``), a shorter one the strings that hold it among
    their 0-2 character substrings: a few rows per string, no theta join.
    """
    d = _dealt(strings.select(F.col(by).alias("_h"), F.col(col).alias("_s")).where(F.col("_s").isNotNull()).distinct(), "strings")
    long = None
    for chosen, grams in _gram_levels(d.withColumnRenamed("_s", "_needle"), d.withColumnRenamed("_s", "_lname"), ["_h"], []):
        found = (chosen.join(grams.hint("merge"), ["_h", "_gram"]).where(F.col("_whole") | F.col("_lname").contains(F.col("_needle")))
                 .select("_h", F.col("_needle").alias("_x"), F.col("_lname").alias("_y")))
        long = found if long is None else long.unionByName(found)
    parts = d.select("_h", F.col("_s").alias("_y"), F.explode(F.concat(
        F.array(F.lit("")), _grams(F.col("_s"), 1), _grams(F.col("_s"), 2))).alias("_x"))
    short = d.where(F.length("_s") <= 2).select("_h", F.col("_s").alias("_x")).join(parts.hint("merge"), ["_h", "_x"])
    both = long.unionByName(short.select("_h", "_x", "_y")).where("_x <> _y")
    return both.select(F.col("_h").alias(by), F.col("_x").alias("x"), F.col("_y").alias("y"))


def type_candidates(rooms: DataFrame, home: str = "home", keywords=None, mode: str = "reference") -> DataFrame:
    """J5 over distinct types: (home, a_source, a_type, b_source, b_type), a before b by source.

    Two types of one home in different sources match if one's lower-cased text
    contains the other's, or their K4 keys are equal (with ``merge_equal``
    empty keys do not match). Rooms without a type match nothing.

    All sides grow with the rooms, and a stored table is smaller than its rows: the joins are merged, none is sent round through the driver.
    """
    _check_mode(mode)
    t = with_room_key(rooms.where(F.col("roomtype").isNotNull()), keywords).select(
        F.col(home).alias("_home"), "source", F.col("roomtype").alias("type"), F.lower("roomtype").alias("low"), "room_key").distinct()
    t = _dealt(t, "types")  # read by seven sides

    def side(p: str) -> DataFrame:
        return t.select("_home", F.col("source").alias(f"{p}_source"), F.col("type").alias(f"{p}_type"),
                        F.col("low").alias(f"{p}_low"), F.col("room_key").alias(f"{p}_key"))

    a, b = side("a"), side("b")
    cols = ["_home", "a_source", "a_type", "b_source", "b_type"]
    keyed = a.join(b.withColumnRenamed("b_key", "a_key").hint("merge"), ["_home", "a_key"])
    if mode == "merge_equal":
        keyed = keyed.where("a_key <> ''")
    same = a.join(b.withColumnRenamed("b_low", "a_low").hint("merge"), ["_home", "a_low"])
    inside = _contained(t, "_home", "low")
    inside = inside.unionByName(inside.select("_home", F.col("x").alias("y"), F.col("y").alias("x")))
    held = inside.withColumnsRenamed({"x": "a_low", "y": "b_low"}).join(a.hint("merge"), ["_home", "a_low"]).join(b.hint("merge"), ["_home", "b_low"])
    pairs = keyed.select(cols).unionByName(same.select(cols)).unionByName(held.select(cols))
    return pairs.where("a_source < b_source").distinct().withColumnRenamed("_home", home)


#: Rooms of a list of :func:`_listed`, about: two lists give the square of it in pairs.
LIST = 256


def _listed(rooms: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ids: the ids of the rooms of a key (as structs) in lists of about ``LIST``, so that no key is one row."""
    k = F.struct(*keys)
    sizes = rooms.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / LIST).alias("_lists")).select(k.alias("_k"), "_lists")
    dealt = rooms.withColumn("_k", k).join(sizes.hint("merge"), "_k").withColumn("_list", F.expr("pmod(xxhash64(id), _lists)"))
    return dealt.groupBy(*keys, "_list").agg(F.collect_list(F.struct("id")).alias("ids")).drop("_list")


def room_candidates(rooms: DataFrame, home: str = "home", keywords=None, mode: str = "reference") -> DataFrame:
    """Pairs of rooms of one home in different sources (a < b by source) that may merge.

    The rule is that of :func:`type_candidates`. The pairs of a home grow with the square of its rooms and are the result, so they
    are neither shuffled nor made distinct: lists of rooms with one key, and lists of rooms with one type where types
    hold each other and their keys differ, are joined, dealt out, and taken apart into pairs at last. A room (home, source, id) that
    comes with several types may meet a room more than once; only its pairs are made distinct.
    """
    _check_mode(mode)
    spark = rooms.sparkSession
    with freed(spark) as keep:
        one = rooms.where(F.col("roomtype").isNotNull() & F.col(home).isNotNull() & F.col("source").isNotNull()).groupBy(
            F.col(home).alias("_home"), "source", "id").agg(F.collect_set("roomtype").alias("_types"))
        r = with_room_key(one.select("_home", "source", "id", (F.size("_types") > 1).alias("several"), F.explode("_types").alias("roomtype")), keywords)
        r = keep(written(r.withColumn("low", F.lower("roomtype")), "typed-rooms"))
        of_key = keep(written(_listed(r.where("not several"), ["_home", "source", "room_key"]), "rooms-by-key"))
        of_type = keep(written(_listed(r.where("not several"), ["_home", "source", "roomtype", "low", "room_key"]).drop("roomtype"), "rooms-by-type"))
        inside = _contained(r, "_home", "low")
        inside = inside.unionByName(inside.select("_home", F.col("x").alias("y"), F.col("y").alias("x")))
        inside = keep(written(inside.withColumnsRenamed({"x": "a_low", "y": "b_low"}), "types-inside"))
    equal = "a_room_key = b_room_key" + (" and a_room_key <> ''" if mode == "merge_equal" else "")

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{p}_{c}" for c in df.columns if c != "_home"})

    def by_key(a: DataFrame, b: DataFrame) -> DataFrame:
        a, b = side(a, "a"), side(b, "b").withColumn("_key", F.col("b_room_key"))
        return a.withColumn("_key", F.col("a_room_key")).join(b.hint("merge"), ["_home", "_key"]).where("a_source < b_source").where(equal)

    def by_text(a: DataFrame, b: DataFrame) -> DataFrame:
        """By a type in a type, or the same type where that does not mean the same key; pairs by key are left out."""
        a, b = side(a, "a"), side(b, "b")
        found = inside.join(a.hint("merge"), ["_home", "a_low"]).join(b.hint("merge"), ["_home", "b_low"])
        if mode == "merge_equal":
            same = a.withColumn("b_low", F.col("a_low")).join(b.hint("merge"), ["_home", "b_low"])
            found = found.unionByName(same.select(found.columns))
        return found.where("a_source < b_source").where(f"not ({equal})")

    def apart(lists: DataFrame) -> DataFrame:
        dealt = lists.select("_home", "a_source", "a_ids", "b_source", "b_ids").repartition(task_count(spark))
        one = dealt.select("_home", "a_source", F.explode("a_ids").alias("a"), "b_source", "b_ids")
        return one.select("_home", "a_source", F.col("a.id").alias("a_id"), "b_source", F.explode("b_ids").alias("b")).select(
            "_home", "a_source", "a_id", "b_source", F.col("b.id").alias("b_id"))

    cols = ["_home", "a_source", "a_id", "b_source", "b_id"]
    rest = [join(a, b).select(cols) for join in (by_key, by_text)
            for a, b in ((r.where("several"), r), (r.where("not several"), r.where("several")))]
    out = apart(by_key(of_key, of_key)).unionByName(apart(by_text(of_type, of_type))).unionByName(_union(rest).distinct())
    return out.withColumnRenamed("_home", home)


# --- A9 / A10 ----------------------------------------------------------------------------

AVAILABLES_TYPE = "array<struct<occupancy:int,price:string>>"


def _type_groups(types: DataFrame, mode: str) -> DataFrame:
    """(home, roomtype, grp): types of a home that matches join, directly or over other types.

    types: home, roomtype, low, room_key. Equal keys and equal lower-cased
    texts are linked to their least type (a star, not all pairs).
    """
    node = F.concat(F.length("home").cast("string"), F.lit(":"), F.col("home"), F.col("roomtype"))
    t = types.select("home", "roomtype", "low", "room_key", node.alias("node")).distinct()

    def star(key: str) -> DataFrame:
        least = t.groupBy("home", key).agg(F.min("node").alias("b"))
        return t.join(least, ["home", key]).select("home", key, F.col("node").alias("a"), "b")

    keyed = star("room_key")
    if mode == "merge_equal":
        keyed = keyed.where("room_key <> ''")
    least = t.groupBy("home", "low").agg(F.min("node").alias("n"))
    inside = (_contained(t, "home", "low").join(least.withColumnsRenamed({"low": "x", "n": "a"}), ["home", "x"])
              .join(least.withColumnsRenamed({"low": "y", "n": "b"}), ["home", "y"]))
    links = keyed.select("a", "b").unionByName(star("low").select("a", "b")).unionByName(inside.select("a", "b"))
    roots = components(links)
    return t.join(roots, "node", "left").select("home", "roomtype", F.coalesce("root", "node").alias("grp"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _assign(items: Column, n_sources: int, mode: str, item_type: str) -> Column:
    """The ordered rule over the sorted items of one group: array of (anchor, picks).

    A left fold over the items carries the strings taken so far. An item whose
    string is free opens a room; an inner fold over the source ranks adds the
    first free, matching item of every other source.
    """
    out_type = f"array<struct<anchor:{item_type},picks:array<{item_type}>>>"
    strings, picks = F.array().cast("array<string>"), F.array().cast(f"array<{item_type}>")
    ranks = F.array(*[F.lit(i) for i in range(n_sources)])

    def fits(x: Column, y: Column) -> Column:
        same_key = x["room_key"] == y["room_key"]
        if mode == "merge_equal":
            same_key = same_key & (x["room_key"] != "")
        return x["low"].contains(y["low"]) | y["low"].contains(x["low"]) | same_key

    def opened(acc: Column, x: Column) -> Column:
        start = F.struct(F.array_append(acc["taken"], x["roomtype"]).alias("taken"), picks.alias("picks"))

        def pick(st: Column, rank: Column) -> Column:
            # equal strings stay apart in the reference mode; else they are blocked only by earlier rooms
            blocked = acc["taken"] if mode == "merge_equal" else st["taken"]
            free = F.filter(items, lambda y: (y["rank"] == rank) & (rank != x["rank"])
                            & ~F.array_contains(blocked, y["roomtype"]) & fits(x, y))
            return _let(free, lambda c: F.when(F.size(c) > 0, F.struct(
                F.array_append(st["taken"], c[0]["roomtype"]).alias("taken"),
                F.array_append(st["picks"], c[0]).alias("picks"))).otherwise(st))

        return _let(F.aggregate(ranks, start, pick), lambda st: F.struct(
            st["taken"].alias("taken"),
            F.array_append(acc["out"], F.struct(x.alias("anchor"), st["picks"].alias("picks"))).alias("out")))

    init = F.struct(strings.alias("taken"), F.array().cast(out_type).alias("out"))
    step = lambda acc, x: F.when(F.array_contains(acc["taken"], x["roomtype"]), acc).otherwise(opened(acc, x))
    return F.aggregate(items, init, step)["out"]


#: A home of at most so many types (of all sources) is folded in its row, without looking for its groups: the rooms are the same.
SMALL_HOME = 64
#: A group of more types than this is matched in rounds over tables; a smaller one is folded in its row. Both give the same rooms.
LARGE_GROUP = 400
#: Anchors of a group that one round settles.
ROUND = 2_000


def _settle(n_sources: int, mode: str):
    """One round of one group: its next anchors in order, and for them enough of the free types that they match.

    Rows: kind 'anchor'; 'class' (a free type, for all anchors with its key); 'pair' (a free type whose text holds, or is held by, that of ``x``).
    """
    import pyarrow as pa

    schema = pa.schema([("home", pa.string()), ("grp", pa.string()), ("rank", pa.int32()), ("roomtype", pa.string()),
                        ("picks", pa.list_(pa.struct([("rank", pa.int32()), ("roomtype", pa.string())])))])

    def order(r: dict) -> tuple:
        return r["rank"], r["seq"] is not None, r["seq"] or 0, r["id"] is not None, r["id"], r["roomtype"]

    def run(key, t):
        rows = sorted(t.to_pylist(), key=order)
        classes: dict[tuple, list] = {}
        pairs: dict[tuple, list] = {}
        for r in rows:
            if r["kind"] == "class":
                classes.setdefault((r["room_key"], r["rank"]), []).append(r)
            elif r["kind"] == "pair":
                pairs.setdefault((r["x"], r["rank"]), []).append(r)
        taken: set[str] = set()
        out = []

        for listed in (*classes.values(), *pairs.values()):
            listed.reverse()

        def first(listed: list, mine: set[str]):
            """First type that is free; what earlier rooms took is dropped for good."""
            while listed and listed[-1]["roomtype"] in taken:
                listed.pop()
            return next((r for r in reversed(listed) if r["roomtype"] not in taken and r["roomtype"] not in mine), None)

        for x in rows:
            if x["kind"] != "anchor" or x["roomtype"] in taken:
                continue
            # equal strings stay apart in the reference mode; else they are blocked only by earlier rooms
            mine, picks = {x["roomtype"]}, []
            for rank in range(n_sources):
                if rank == x["rank"]:
                    continue
                blocked = set() if mode == "merge_equal" else mine
                keyed = classes.get((x["room_key"], rank), []) if mode != "merge_equal" or x["room_key"] else []
                found = [first(listed, blocked) for listed in (keyed, pairs.get((x["roomtype"], rank), []))]
                best = min((r for r in found if r), key=order, default=None)
                if best:
                    picks.append({"rank": rank, "roomtype": best["roomtype"]})
                    mine.add(best["roomtype"])
            taken |= mine
            out.append({"home": x["home"], "grp": x["grp"], "rank": x["rank"], "roomtype": x["roomtype"], "picks": picks})
        return pa.Table.from_pylist(out, schema)

    return run


def _in_rounds(items: DataFrame, n_sources: int, mode: str) -> DataFrame:
    """(home, grp, rank, roomtype, picks) of every room that opens in the given groups, by the ordered rule of :func:`_assign`.

    items: home, grp, rank, seq, id, roomtype, low, room_key. A round takes the next ``ROUND`` free types of each group as
    anchors. They can take only so many types, so for each key that is how many free types of every source
    a round needs, and as many of those that contain an anchor's text or are contained in it. The round's rows are bounded and
    settled exactly in order; then what was taken leaves the table. All groups move on together.
    """
    cols = ["home", "grp", "rank", "seq", "id", "roomtype"]
    sort = [F.col("rank"), F.col("seq").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("roomtype")]
    texts = items.select("home", "low").distinct()
    inside = _contained(texts, "home", "low")
    pairs = inside.select("home", "x", "y").unionByName(inside.select("home", F.col("y").alias("x"), F.col("x").alias("y")))
    pairs = written(pairs.unionByName(texts.select("home", F.col("low").alias("x"), F.col("low").alias("y"))), "room-pairs")
    free, opened = written(items, "room-free"), None
    while True:
        top = Window.partitionBy("home", "grp").orderBy(*sort)
        anchors = written(free.withColumn("n", F.row_number().over(top)).where(F.col("n") <= ROUND).drop("n"), "room-anchors")
        if anchors.isEmpty():
            return opened
        most = n_sources * ROUND + 1
        held = (anchors.select("home", "grp", F.col("roomtype").alias("of"), F.col("low").alias("x"), F.col("rank").alias("own"))
                .join(pairs, ["home", "x"]).join(free.withColumnRenamed("low", "y"), ["home", "grp", "y"])
                .where("rank <> own").select(*cols, "room_key", F.col("of").alias("x")))
        near = Window.partitionBy("home", "grp", "x", "rank").orderBy(*sort)
        held = written(held.withColumn("n", F.row_number().over(near)).where(F.col("n") <= most).drop("n"), "room-held")
        # of a key: every anchor with it may take one type of each source and itself, every pair one more
        per_key = (anchors.select("home", "grp", "room_key", F.lit(n_sources + 1).alias("w"))
                   .unionByName(held.select("home", "grp", "room_key", F.lit(1).alias("w"))).groupBy("home", "grp", "room_key").agg((F.sum("w") + 1).alias("need")))
        bound = int(per_key.agg(F.max("need")).first()[0])
        of_key = Window.partitionBy("home", "grp", "room_key", "rank").orderBy(*sort)
        keyed = (free.withColumn("n", F.row_number().over(of_key)).where(F.col("n") <= bound)
                 .join(per_key, ["home", "grp", "room_key"]).where("n <= need").select(*cols, "room_key", F.lit(None).cast("string").alias("x")))
        kind = lambda df, k: df.select(*cols, "room_key", "x", F.lit(k).alias("kind"))
        rows = kind(anchors.withColumn("x", F.lit(None).cast("string")), "anchor").unionByName(kind(keyed, "class")).unionByName(kind(held, "pair"))
        done = written(rows.groupBy("home", "grp").applyInArrow(
            _settle(n_sources, mode), "home string, grp string, rank int, roomtype string, picks array<struct<rank:int,roomtype:string>>"), "room-opened")
        opened = done if opened is None else opened.unionByName(done)
        taken = done.select("home", "roomtype").unionByName(done.select("home", F.explode("picks").alias("p")).select("home", "p.roomtype"))
        # an anchor that found its string taken is settled too
        gone = taken.unionByName(anchors.select("home", "roomtype")).distinct()
        free = written(free.join(gone, ["home", "roomtype"], "left_anti").select(items.columns), "room-free")


def _with_items(opened: DataFrame, first: DataFrame) -> DataFrame:
    """Rooms of :func:`_in_rounds` as (home, m), m the anchor and its picks with all their fields."""
    of = first.select("home", F.col("item.rank").alias("rank"), "roomtype", "item")
    rooms = opened.withColumn("own", F.col("roomtype"))
    picks = (rooms.select("home", "own", F.explode("picks").alias("p")).select("home", "own", "p.rank", "p.roomtype").join(of, ["home", "rank", "roomtype"])
             .groupBy("home", "own").agg(F.array_sort(F.collect_list("item")).alias("picks")))  # at most one a source
    none = F.array().cast(picks.schema["picks"].dataType)
    both = rooms.select("home", "own", "rank", "roomtype").join(of, ["home", "rank", "roomtype"]).join(picks, ["home", "own"], "left")
    return both.select("home", F.struct(F.col("item").alias("anchor"), F.coalesce("picks", none).alias("picks")).alias("m"))


def matched_rooms(rooms: DataFrame, home: str = "home", sources: Sequence = (1, 2, 3), keywords=None,
                  mode: str = "reference") -> DataFrame:
    """A9 (+A10) without numbering: home, anchor_rank, anchor_seq, roomtype, anchor_source, id_<s>, facilities, photos, availables_<s>.

    See :func:`greedy_room_match`; ``anchor_rank`` (place of the source) and
    ``anchor_seq`` order the rooms of a home.
    """
    _check_mode(mode)
    sources = list(sources)
    rank = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source").cast(rooms.schema["source"].dataType)) - 1
    avail = (F.col("availables") if "availables" in rooms.columns else F.lit(None)).cast(AVAILABLES_TYPE)
    empty = F.array().cast("array<string>")
    r = rooms.where(F.col("roomtype").isNotNull()).select(
        F.col(home).cast("string").alias("home"), rank.cast("int").alias("rank"), F.col("seq").cast("long").alias("seq"), "id",
        "roomtype", F.coalesce("facilities", empty).alias("facilities"),
        F.coalesce("photos", empty).alias("photos"), avail.alias("availables")).where("rank >= 0 and home is not null")
    spark = rooms.sparkSession
    # only the first room of a string in a source can ever be taken: a partial
    # aggregate bounds a home by its distinct types, not by its rooms
    of = {"low": F.lower, "room_key": lambda t: shorten_room_type(t, keywords)}  # both follow from the type: they are not shuffled
    carried, fields = ["seq", "id", "facilities", "photos", "availables"], ["rank", "seq", "id", "roomtype", "low", "room_key", "facilities", "photos", "availables"]
    first = r.groupBy("home", "rank", "roomtype").agg(
        F.min_by(F.struct(*carried), F.struct(F.col("seq").isNull(), F.col("seq"))).alias("item"))
    with freed(spark) as keep:
        first = keep(written(first.select("home", "rank", "roomtype", "item.*"), "room-types"))
        most = min(SMALL_HOME, LARGE_GROUP)
        wide = keep(written(first.groupBy("home").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("home"), "wide-homes"))
    narrow = [c for c in fields if c not in of]
    filled = lambda x: F.struct(*[(of[c](x["roomtype"]) if c in of else x[c]).alias(c) for c in fields])

    def folded(items: DataFrame, item_type: str) -> DataFrame:
        return items.select("home", F.explode(_assign(F.col("items"), len(sources), mode, item_type)).alias("m"))

    with_items = lambda df: df.select("home", "roomtype", filled({c: F.col(c) for c in narrow}).alias("item"))
    item_type = with_items(first).schema["item"].dataType.simpleString()
    wide_homes = not wide.isEmpty()
    small = first
    if wide_homes:  # as structs: a home with very many types is not shuffled to one task
        small = first.withColumn("k", F.struct("home")).join(wide.select(F.struct("home").alias("k")), "k", "left_anti").drop("k")
    small = small.groupBy("home").agg(F.array_sort(F.collect_list(F.struct(*narrow))).alias("items"))
    rec = folded(small.select("home", F.transform("items", filled).alias("items")), item_type)
    if wide_homes:
        first = with_items(first.withColumn("k", F.struct("home")).join(wide.select(F.struct("home").alias("k")), "k", "left_semi").drop("k"))
        # rooms act on each other only inside a group of matching types, so a wide home is folded group by group
        with freed(spark) as keep:
            groups = _type_groups(first.select("home", "roomtype", "item.low", "item.room_key"), mode)
            grouped = keep(written(first.join(groups, ["home", "roomtype"]), "room-groups"))
        sizes = grouped.groupBy("home", "grp").agg(F.count(F.lit(1)).alias("size"))
        # as structs: a large group is split where it is set apart, not shuffled to one task
        sized = grouped.withColumn("k", F.struct("home", "grp")).join(sizes.select(F.struct("home", "grp").alias("k"), "size"), "k").drop("k")
        items = sized.where(F.col("size") <= LARGE_GROUP).groupBy("home", "grp").agg(F.array_sort(F.collect_list("item")).alias("items"))
        rec = rec.unionByName(folded(items, item_type))
        if not sizes.where(F.col("size") > LARGE_GROUP).isEmpty():
            large = sized.where(F.col("size") > LARGE_GROUP).select("home", "grp", *[f"item.{c}" for c in ("rank", "seq", "id", "roomtype", "low", "room_key")])
            rec = rec.unionByName(_with_items(_in_rounds(large, len(sources), mode), first))
    a, picks = F.col("m.anchor"), F.col("m.picks")
    lead = F.filter(picks, lambda p: p["rank"] == 0)
    out = rec.select(
        "home", a["rank"].alias("anchor_rank"), a["seq"].alias("anchor_seq"), a["roomtype"].alias("roomtype"),
        F.element_at(F.array(*[F.lit(s) for s in sources]), a["rank"] + 1).alias("anchor_source"),
        F.aggregate(picks, a["facilities"], lambda f, p: F.when(F.size(p["facilities"]) > F.size(f), p["facilities"]).otherwise(f)).alias("facilities"),
        F.when(F.size(lead) > 0, F.get(lead, 0)["photos"]).otherwise(a["photos"]).alias("photos"),
        F.concat(F.array(a), picks).alias("all"))

    def of(rank: int, field: str) -> Column:
        return F.get(F.filter("all", lambda p: p["rank"] == rank), 0)[field]

    return out.select(*[c for c in out.columns if c != "all"], *[of(i, "id").alias(f"id_{s}") for i, s in enumerate(sources)],
                      *[of(i, "availables").alias(f"availables_{s}") for i, s in enumerate(sources)])


def greedy_room_match(rooms: DataFrame, home: str = "home", sources: Sequence = (1, 2, 3),
                      keywords=None, mode: str = "reference") -> DataFrame:
    """A9 (+A10): rooms of one home matched across sources by the ordered greedy rule.

    rooms: home, source, id, seq, roomtype, facilities, photos (ids and sources
    of any type; rows of sources not listed are left out). Sources are taken in
    the given order and rooms by ``seq``. A room whose type string was taken is
    skipped; else it opens a matched room and takes from every other source the
    first room whose string is free and which matches it (J5). Rooms without a
    type are dropped; NULL facilities count as []. With ``mode='merge_equal'``
    equal strings of different sources merge and empty keys do not match.

    Plan: types that cannot meet, directly or over other types, are apart
    (connected groups of J5; in the reference mode all types of a home without a keyword are one group). A home of up to ``SMALL_HOME`` types
    is taken for one group. A group of up to
    ``LARGE_GROUP`` types is one row whose sorted items are folded by a built-in aggregate expression; a larger one is matched in rounds
    over tables (:func:`_in_rounds`), of which each holds a bounded part of it.
    """
    m = matched_rooms(rooms, home, sources, keywords, mode)
    order = Window.partitionBy("home").orderBy("anchor_rank", "anchor_seq", "roomtype")
    ids, avs = [f"id_{s}" for s in sources], [f"availables_{s}" for s in sources]
    return m.withColumn("room_ord", F.row_number().over(order) - 1).select(
        "home", "room_ord", "roomtype", "anchor_source", *ids, "facilities", "photos", *avs)


def longest_facilities(rooms: DataFrame, key: Sequence[str], order: Sequence[str] = ("source", "seq"),
                       col: str = "facilities") -> DataFrame:
    """A10: per key the longest list; ties keep the first in ``order``. NULL counts as []."""
    fac = F.coalesce(F.col(col), F.array().cast("array<string>"))
    rank = F.struct(F.size(fac).alias("_n"), *[(-F.col(o)).alias(f"_o{i}") for i, o in enumerate(order)])
    return rooms.groupBy(*key).agg(F.max_by(fac, rank).alias(col))


# --- S6 ----------------------------------------------------------------------------------------

def combined_document_tables(homes: DataFrame, rooms: DataFrame, reviews: DataFrame,
                             sources: Sequence = (1, 2, 3), use_inside_fallback: bool = False,
                             review_payload: Sequence[str] = ("id", "score")) -> tuple[DataFrame, DataFrame]:
    """S6 as two tables: (documents, reviews).

    documents: one row per resolved property (flat fields of O1 and its matched
    rooms, A9, nested). reviews: pass, anchor_id, source, seq and the payload of
    every review the property owns (A3 by key): a property's reviews are not
    bounded, so they are not collected into its row. rooms/reviews input:
    source, homename, id, seq (+ roomtype, facilities, photos for rooms). Rooms
    and reviews come only from homes that gave them (anchor, or first claim).
    """
    anchors, matches = resolve_passes(homes, sources, use_inside_fallback)
    flat = combine_from(anchors, matches, homes, sources)
    det = details_of(anchors, matches, homes)
    hkey = F.concat_ws("/", F.col("pass").cast("string"), F.col("anchor_id").cast("string"))
    # what joins, the first room of each type and the matching shuffle lies on disk one after the other, not together
    with freed(homes.sparkSession) as keep:
        cols = [c for c in ("source", "seq", "id", "roomtype", "facilities", "photos", "availables") if c in rooms.columns]
        with freed(homes.sparkSession) as keep_rows:
            rj = keep_rows(written(rows_of_home(det, rooms).select(hkey.alias("home"), *cols), "home-rooms"))
        rm = matched_rooms(rj, home="home", sources=sources)
        # at most one room per distinct type of the property: bounded
        rooms_n = keep(written(rm.groupBy("home").agg(F.array_sort(F.collect_list(F.struct(
            "anchor_rank", "anchor_seq", "roomtype", "anchor_source", *[f"id_{s}" for s in sources], "facilities", "photos",
            *[f"availables_{s}" for s in sources]))).alias("rooms")), "document-rooms"))
    doc = flat.withColumn("home", hkey).join(rooms_n, "home", "left").drop("home")
    empty_rooms = F.array().cast(rooms_n.schema["rooms"].dataType)
    doc = doc.withColumn("rooms", F.coalesce("rooms", empty_rooms))
    rv = rows_of_home(det, reviews).select("pass", "anchor_id", "source", "seq",
                                           *[c for c in review_payload if c != "seq"])
    return doc, rv


def combined_documents(homes: DataFrame, rooms: DataFrame, reviews: DataFrame,
                       sources: Sequence = (1, 2, 3), use_inside_fallback: bool = False,
                       review_payload: Sequence[str] = ("id", "score")) -> DataFrame:
    """S6 fully nested: the documents with the reviews as one array per source.

    Only for properties with a bounded number of reviews; at scale write
    :func:`combined_document_tables` instead (the reviews array of a hot
    property is one row built by one task).
    """
    doc, rv = combined_document_tables(homes, rooms, reviews, sources, use_inside_fallback, review_payload)
    return doc.join(nest_by_source(rv, ["pass", "anchor_id"], sources, payload=review_payload), ["pass", "anchor_id"], "left")
