"""Room and detail queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from innsight.functions.keys import room_keywords_sql
from innsight.operators import resolve as R
from innsight.plans.bindings import (SOURCE_NAMES, home_rows_cte, home_rows_from_lineitem, homes_cte, homes_from_part,
                                     named_cte, rooms_cte, rooms_from_part, with_named_sources)
from innsight.plans.q_resolve import W1_CTE, _with, combine_ctes
from innsight.plans.registry import register
from innsight.session import freed, scratch_path, written
from innsight.sources.tables import write_document_tables

KEYED_ROOMS = f"r AS (SELECT *, lower(roomtype) AS low, {room_keywords_sql('roomtype')} AS room_key FROM rooms)"


@register("shorten_room_type", _with(rooms_cte(), KEYED_ROOMS) + "SELECT id, roomtype, room_key FROM r")
def q_shorten_room_type(spark, sf):
    return R.with_room_key(rooms_from_part(spark, sf)).select("id", "roomtype", "room_key")


@register("room_candidates", _with(rooms_cte(by_brand=True), KEYED_ROOMS) + """
SELECT DISTINCT a.home, a.source AS a_source, a.id AS a_id, b.source AS b_source, b.id AS b_id
FROM r a JOIN r b ON a.home = b.home AND a.source < b.source
WHERE contains(a.low, b.low) OR contains(b.low, a.low) OR a.room_key = b.room_key""")
def q_room_candidates(spark, sf):
    return R.room_candidates(rooms_from_part(spark, sf, by_brand=True), home="home")


@register("type_candidates", _with(rooms_cte(), KEYED_ROOMS) + """
SELECT DISTINCT a.home, a.source AS a_source, a.roomtype AS a_type, b.source AS b_source, b.roomtype AS b_type
FROM r a JOIN r b ON a.home = b.home AND a.source < b.source
WHERE contains(a.low, b.low) OR contains(b.low, a.low) OR (a.room_key = b.room_key AND a.room_key <> '')""")
def q_type_candidates(spark, sf):
    """J5 over distinct types, empty keys apart."""
    return R.type_candidates(rooms_from_part(spark, sf), home="home", mode="merge_equal")


# --- A9: one step of the recursion takes the next room of each home --------------------------------

def fold_ctes(rooms: str, mode: str = "reference") -> str:
    """CTEs up to ``folded`` (home, n, x, p1, p2, p3): the anchor room x and what it takes from sources 1, 2, 3.

    ``rooms``: a relation home, rank (1 to 3), seq, id, roomtype, low, room_key, facilities, photos, availables.
    """
    def pick(rank: int, strings: str) -> str:
        key = "y.k = x.k" + (" AND x.k <> ''" if mode == "merge_equal" else "")
        blocked = "taken" if mode == "merge_equal" else strings
        return (f"CASE WHEN x.rank <> {rank} THEN list_filter(items, lambda y: y.rank = {rank} AND NOT list_contains({blocked}, y.t) "
                f"AND (contains(x.low, y.low) OR contains(y.low, x.low) OR ({key})))[1] END")

    def add(strings: str, p: str) -> str:
        return f"CASE WHEN {p} IS NULL THEN {strings} ELSE list_append({strings}, {p}.t) END"

    return f"""firsts AS (SELECT * FROM {rooms} WHERE roomtype IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY home, rank, roomtype ORDER BY seq) = 1),
perhome AS (SELECT home, list(struct_pack(rank := rank, seq := seq, id := id, t := roomtype, low := low, k := room_key,
    f := coalesce(facilities, []::VARCHAR[]), p := coalesce(photos, []::VARCHAR[]), a := availables) ORDER BY rank, seq) AS items
  FROM firsts GROUP BY home),
fold AS (
  SELECT home, items, 0 AS n, []::VARCHAR[] AS taken, items[1] AS x, false AS opened, items[1] AS p1, items[1] AS p2, items[1] AS p3
  FROM perhome
  UNION ALL
  SELECT home, items, n + 1, CASE WHEN skip THEN taken ELSE {add('t2', 'p3')} END, x, NOT skip, p1, p2, p3 FROM (
    SELECT *, {pick(3, 't2')} AS p3 FROM (
      SELECT *, {add('t1', 'p2')} AS t2 FROM (
        SELECT *, {pick(2, 't1')} AS p2 FROM (
          SELECT *, {add('t0', 'p1')} AS t1 FROM (
            SELECT *, {pick(1, 't0')} AS p1 FROM (
              SELECT *, list_contains(taken, x.t) AS skip, list_append(taken, x.t) AS t0 FROM (
                SELECT home, items, n, taken, items[n + 1] AS x FROM fold WHERE n < len(items))))))))),
folded AS (SELECT home, n, x, p1, p2, p3 FROM fold WHERE opened)"""


def _facilities_sql() -> str:
    f = "x.f"
    for p in ("p1", "p2", "p3"):
        f = f"CASE WHEN {p} IS NOT NULL AND len({p}.f) > len({f}) THEN {p}.f ELSE {f} END"
    return f


_PHOTOS_SQL = "CASE WHEN p1 IS NOT NULL THEN p1.p ELSE x.p END"


def _of_sql(rank: int, field: str) -> str:
    return f"CASE WHEN x.rank = {rank} THEN x.{field} ELSE p{rank}.{field} END"


def _greedy_sql(mode: str) -> str:
    cols = ", ".join(f"{_of_sql(s, 'id')} AS id_{s}, coalesce({_of_sql(s, 'a')}, '') AS availables_{s}" for s in (1, 2, 3))
    rooms = "ranked AS (SELECT *, source AS rank FROM r)"
    return (_with(rooms_cte(), KEYED_ROOMS, rooms, fold_ctes("ranked", mode)).replace("WITH ", "WITH RECURSIVE ", 1)
            + f"""SELECT home, row_number() OVER (PARTITION BY home ORDER BY n) - 1 AS room_ord, x.t AS roomtype, x.rank AS anchor_source,
  {cols}, array_to_string({_facilities_sql()}, '|') AS facilities, array_to_string({_PHOTOS_SQL}, '|') AS photos FROM folded""")


def _availables_text(c):
    return F.array_join(F.transform(F.coalesce(c, F.array().cast(R.AVAILABLES_TYPE)),
                                    lambda a: F.concat_ws(":", a["occupancy"].cast("string"), a["price"])), "|")


def _greedy_flat(df):
    return df.select("home", "room_ord", "roomtype", "anchor_source", "id_1", "id_2", "id_3",
                     F.array_join("facilities", "|").alias("facilities"), F.array_join("photos", "|").alias("photos"),
                     *[_availables_text(F.col(f"availables_{t}")).alias(f"availables_{t}") for t in (1, 2, 3)])


@register("greedy_room_match", _greedy_sql("reference"))
def q_greedy_room_match(spark, sf):
    return _greedy_flat(R.greedy_room_match(rooms_from_part(spark, sf), home="home"))


@register("greedy_room_match_merge_equal", _greedy_sql("merge_equal"))
def q_greedy_room_match_merge_equal(spark, sf):
    """A9 where equal strings merge and empty keys do not match."""
    return _greedy_flat(R.greedy_room_match(rooms_from_part(spark, sf), home="home", mode="merge_equal"))


@register("longest_facilities", _with(rooms_cte(), KEYED_ROOMS) + """
SELECT home, room_key, array_to_string(coalesce(facilities, []::VARCHAR[]), '|') AS facilities FROM (
  SELECT *, row_number() OVER (PARTITION BY home, room_key
                               ORDER BY len(coalesce(facilities, []::VARCHAR[])) DESC, source, seq) AS rn FROM r)
WHERE rn = 1""")
def q_longest_facilities(spark, sf):
    r = R.with_room_key(rooms_from_part(spark, sf))
    out = R.longest_facilities(r, ["home", "room_key"])
    return out.select("home", "room_key", F.array_join("facilities", "|").alias("facilities"))


# --- J1 / J2 / A3 on W1 homes and the lineitem rows of each named home ---------------------------

def _home_rows(spark, sf, kind):
    w1 = R.first_per_name(homes_from_part(spark, sf, block=60)).select("source", "homename")
    return R.rows_of_home(w1, home_rows_from_lineitem(spark, sf, block=60).where(F.col("kind") == kind))


_HOME_ROWS = _with(homes_cte(60), W1_CTE, home_rows_cte(60))


@register("rooms_of_home", _HOME_ROWS + """
SELECT w.source, w.homename, r.id, r.roomtype, r.availables FROM w1 w
JOIN hrows r ON r.source = w.source AND r.homename = w.homename WHERE r.kind = 'room'""")
def q_rooms_of_home(spark, sf):
    r = _home_rows(spark, sf, "room")
    return r.select("source", "homename", "id", "roomtype", _availables_text(F.col("availables")).alias("availables"))


@register("reviews_of_home", _HOME_ROWS + """
SELECT w.source, w.homename, r.id, r.score FROM w1 w
JOIN hrows r ON r.source = w.source AND r.homename = w.homename WHERE r.kind = 'review'""")
def q_reviews_of_home(spark, sf):
    return _home_rows(spark, sf, "review").select("source", "homename", "id", "score")


_REVIEWS_TEXT = "coalesce(string_agg(CAST(id AS VARCHAR) || ':' || CAST(CAST(score AS INTEGER) AS VARCHAR), '|' ORDER BY seq, id, score) " \
                "FILTER (source = {s}), '') AS reviews_{s}"


def _reviews_text(c):
    return F.array_join(F.transform(F.filter(c, lambda x: x.isNotNull()),
                                    lambda x: F.concat_ws(":", x["id"].cast("string"), x["score"].cast("int").cast("string"))), "|")


@register("nest_by_source", _HOME_ROWS + "SELECT homename, " + ", ".join(_REVIEWS_TEXT.format(s=s) for s in (1, 2, 3))
          + " FROM hrows WHERE kind = 'review' GROUP BY homename")
def q_nest_by_source(spark, sf):
    """A3: every property's reviews as one array per source, in stored order (bounded by the name blocks)."""
    rows = home_rows_from_lineitem(spark, sf, block=60).where(F.col("kind") == "review")
    n = R.nest_by_source(rows, ["homename"], payload=("id", "score"))
    return n.select("homename", *[_reviews_text(F.col(f"rows_{s}")).alias(f"reviews_{s}") for s in (1, 2, 3)])


@register("nest_in_chunks", _with(homes_cte(), home_rows_cte()) + """
SELECT homename, source, n // 20 AS chunk, count(*) AS n_rows,
  string_agg(CAST(id AS VARCHAR) || ':' || CAST(CAST(score AS INTEGER) AS VARCHAR), '|' ORDER BY n) AS rows FROM (
    SELECT *, row_number() OVER (PARTITION BY homename, source ORDER BY seq NULLS FIRST, id NULLS FIRST, score NULLS FIRST) - 1 AS n
    FROM hrows WHERE kind = 'review') GROUP BY homename, source, n // 20""")
def q_nest_in_chunks(spark, sf):
    """A3 for names of any size: chunks of 20 reviews."""
    rows = home_rows_from_lineitem(spark, sf).where(F.col("kind") == "review")
    n = R.nest_in_chunks(rows, ["homename"], payload=("id", "score"), size=20)
    return n.select("homename", "source", "chunk", F.size("rows").cast("long").alias("n_rows"), _reviews_text(F.col("rows")).alias("rows"))


@register("count_by_source", _with(homes_cte(), home_rows_cte()) + """
SELECT homename,
  count(CASE WHEN source = 1 THEN id END) AS n_1, count(CASE WHEN source = 2 THEN id END) AS n_2,
  count(CASE WHEN source = 3 THEN id END) AS n_3,
  sum(CASE WHEN source = 1 THEN score END) AS sum_1, sum(CASE WHEN source = 2 THEN score END) AS sum_2,
  sum(CASE WHEN source = 3 THEN score END) AS sum_3
FROM hrows WHERE kind = 'review' GROUP BY homename""")
def q_count_by_source(spark, sf):
    """A3 summary form (counts and sums per source): bounded output for hot names."""
    rows = home_rows_from_lineitem(spark, sf).where(F.col("kind") == "review")
    return R.count_by_source(rows, ["homename"], value="score")


# --- S6: build nested documents on string ids and named sources, write, read back -------------------

def _documents_sql() -> str:
    names = SOURCE_NAMES
    room = "x.t || '~' || {0} || '~' || array_to_string({1}, '+') || '~' || array_to_string({2}, '+') || '~' || {3}".format(
        "['" + "', '".join(names) + "'][x.rank]", _facilities_sql(), _PHOTOS_SQL,
        " || '~' || ".join(f"coalesce({_of_sql(i, 'id')}, '') || '=' || coalesce({_of_sql(i, 'a')}, '')" for i in (1, 2, 3)))
    reviews = ", ".join(_REVIEWS_TEXT.format(s=f"'{s}'").replace(f"reviews_'{s}'", f"reviews_{s}") for s in names)
    flat, ctes = combine_ctes(named_cte("homes", homes_cte(60)), names)
    return (_with(*ctes, named_cte("hrows", home_rows_cte(60)), f"flat AS ({flat})",
                  """det AS (SELECT pass, anchor_id, anchor_source AS source, homename FROM pa
               UNION ALL SELECT pass, anchor_id, source, match_name AS homename FROM pm WHERE owned)""",
                  f"""rooms AS (SELECT CAST(pass AS VARCHAR) || '/' || d.anchor_id AS home, list_position({list(names)}, d.source) AS rank,
      r.* FROM det d JOIN hrows r ON r.source = d.source AND r.homename = d.homename AND r.kind = 'room')""",
                  KEYED_ROOMS, fold_ctes("r"),
                  f"docrooms AS (SELECT home, string_agg({room}, ';' ORDER BY n) AS rooms FROM folded GROUP BY home)",
                  f"""docreviews AS (SELECT d.pass, d.anchor_id, {reviews.replace('source', 'd.source')} FROM det d
      JOIN hrows h ON h.source = d.source AND h.homename = d.homename AND h.kind = 'review' GROUP BY d.pass, d.anchor_id)"""
                  ).replace("WITH ", "WITH RECURSIVE ", 1)
            + f"""SELECT f.*, coalesce(dr.rooms, '') AS rooms, {', '.join(f"coalesce(v.reviews_{s}, '') AS reviews_{s}" for s in names)}
FROM flat f LEFT JOIN docrooms dr ON dr.home = CAST(f.pass AS VARCHAR) || '/' || f.anchor_id
LEFT JOIN docreviews v ON v.pass = f.pass AND v.anchor_id = f.anchor_id""")


@register("combined_documents", _documents_sql())
def q_combined_documents(spark, sf):
    """S6 on the declared schema (string ids, named sources): all fields, rooms and reviews of every document."""
    homes = with_named_sources(homes_from_part(spark, sf, block=60))
    rows = with_named_sources(home_rows_from_lineitem(spark, sf, block=60))
    path = scratch_path(spark, "combined_documents")
    with freed(spark):  # the rows of each kind lie on disk once they have their homes' names, not while they are shuffled for them
        with freed(spark) as keep:
            rooms = keep(written(rows.where(F.col("kind") == "room").drop("kind", "score"), "room-rows"))
        docs, reviews = R.combined_document_tables(homes, rooms, rows.where(F.col("kind") == "review"), sources=SOURCE_NAMES)
        write_document_tables(docs, reviews, path)
    back = spark.read.schema(docs.schema).parquet(f"{path}/documents")
    rv = R.nest_by_source(spark.read.parquet(f"{path}/reviews"), ["pass", "anchor_id"], SOURCE_NAMES, payload=("id", "score"))
    texts = rv.select("pass", "anchor_id", *[_reviews_text(F.col(f"rows_{s}")).alias(f"reviews_{s}") for s in SOURCE_NAMES])

    def part(r, s):
        return F.concat(F.coalesce(r[f"id_{s}"], F.lit("")), F.lit("="), _availables_text(r[f"availables_{s}"]))

    room = lambda r: F.concat_ws("~", r["roomtype"], r["anchor_source"], F.array_join(r["facilities"], "+"),
                                 F.array_join(r["photos"], "+"), *[part(r, s) for s in SOURCE_NAMES])
    flat = [c for c in docs.columns if c not in ("rooms", "property_highlights", "images")]
    out = back.select(*flat, F.array_join("property_highlights", "|").alias("property_highlights"),
                      F.array_join("images", "|").alias("images"), F.array_join(F.transform("rooms", room), ";").alias("rooms"))
    return out.join(texts, ["pass", "anchor_id"], "left").select(
        *out.columns, *[F.coalesce(f"reviews_{s}", F.lit("")).alias(f"reviews_{s}") for s in SOURCE_NAMES])
