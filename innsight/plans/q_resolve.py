"""Resolve queries (W1, A1, K1-K3, J3, W2, W3, J4, O1, O2, P16, P17) on the part binding."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from innsight.functions import keys as K
from innsight.operators import resolve as R
from innsight.plans.bindings import HOMES_CTE, homes_from_part, needle_sql
from innsight.plans.registry import register

# --- shared SQL pieces ------------------------------------------------------------------

W1_CTE = """w1 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, homename ORDER BY seq) AS rn FROM homes)
  WHERE rn = 1)"""

ANC_CTE = f"""anc AS (
  SELECT source AS anchor_source, id AS anchor_id, seq AS anchor_seq, homename, city,
         {needle_sql('homename')} AS needle
  FROM w1)"""

M_CTE = """m AS (
  SELECT * FROM (
    SELECT a.anchor_source, a.anchor_id, c.source, c.id AS match_id, c.homename AS match_name,
           row_number() OVER (PARTITION BY a.anchor_source, a.anchor_id, c.source ORDER BY c.homename, c.id) AS rk
    FROM anc a JOIN homes c
      ON c.city = a.city AND c.source <> a.anchor_source AND contains(lower(c.homename), a.needle))
  WHERE rk = 1)"""

PASSES_CTE = """a1 AS (SELECT *, 1 AS pass FROM anc WHERE anchor_source = 1),
m1 AS (SELECT m.*, a.anchor_seq, a.pass FROM m JOIN a1 a USING (anchor_source, anchor_id)),
a2 AS (SELECT *, 2 AS pass FROM anc WHERE anchor_source = 2
        AND anchor_id NOT IN (SELECT match_id FROM m1 WHERE source = 2)),
m2 AS (SELECT m.*, a.anchor_seq, a.pass FROM m JOIN a2 a USING (anchor_source, anchor_id)),
a3 AS (SELECT *, 3 AS pass FROM anc WHERE anchor_source = 3
        AND anchor_id NOT IN (SELECT match_id FROM m1 WHERE source = 3 UNION ALL SELECT match_id FROM m2 WHERE source = 3)),
m3 AS (SELECT m.*, a.anchor_seq, a.pass FROM m JOIN a3 a USING (anchor_source, anchor_id)),
pa AS (SELECT * FROM a1 UNION ALL SELECT * FROM a2 UNION ALL SELECT * FROM a3),
pm AS (SELECT *, row_number() OVER (PARTITION BY source, match_id ORDER BY pass, anchor_seq) = 1 AS owned
       FROM (SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- W1 / A1 ------------------------------------------------------------------------------

@register("first_per_name", _with(HOMES_CTE, W1_CTE) + "SELECT source, homename, id, seq, city FROM w1")
def q_first_per_name(spark, sf):
    return R.first_per_name(homes_from_part(spark, sf)).select("source", "homename", "id", "seq", "city")


@register("distinct_homenames", _with(HOMES_CTE) + "SELECT DISTINCT source, homename FROM homes")
def q_distinct_homenames(spark, sf):
    return R.distinct_homenames(homes_from_part(spark, sf))


# --- K1 / K2 / K3 on decorated names ----------------------------------------------------------

def _decorated(spark, sf):
    h = homes_from_part(spark, sf)
    k = F.col("id")
    name = (F.when(k % 6 == 0, F.concat_ws("", "homename", F.lit(" ("), "city", F.lit(")")))
             .when(k % 6 == 1, F.concat_ws("", "homename", F.lit(" Phone 0909 "), "city"))
             .when(k % 6 == 2, F.concat_ws("", F.lit("("), "city", F.lit(") "), "homename"))
             .when(k % 6 == 3, F.concat_ws("", "homename", F.lit(" sđt 0912 ("), "city", F.lit(")")))
             .when(k % 6 == 4, F.concat_ws("", "homename", F.lit(" ("), "city", F.lit(") (x)")))
             .otherwise(F.concat_ws("", F.lit("  "), "homename", F.lit("  "))))
    return h.select("id", name.alias("name"))


DECORATED_CTE = """dec AS (
  SELECT id, CASE id % 6
    WHEN 0 THEN homename || ' (' || city || ')'
    WHEN 1 THEN homename || ' Phone 0909 ' || city
    WHEN 2 THEN '(' || city || ') ' || homename
    WHEN 3 THEN homename || ' sđt 0912 (' || city || ')'
    WHEN 4 THEN homename || ' (' || city || ') (x)'
    ELSE '  ' || homename || '  ' END AS name
  FROM homes)"""

_OI = "'^(.*?)\\((.*?)\\)$'"


@register("clean_homename", _with(HOMES_CTE, DECORATED_CTE) +
          "SELECT id, name, trim(regexp_replace(name, '(Phone|sđt).*', '', 'g')) AS cleaned FROM dec")
def q_clean_homename(spark, sf):
    d = _decorated(spark, sf)
    return d.select("id", "name", K.clean_homename(F.col("name")).alias("cleaned"))


@register("match_needle", _with(HOMES_CTE, DECORATED_CTE) +
          f"SELECT id, name, {needle_sql('name')} AS needle FROM dec")
def q_match_needle(spark, sf):
    d = _decorated(spark, sf)
    return d.select("id", "name", F.lower(K.match_needle(F.col("name"))).alias("needle"))


@register("needle_fallback", _with(HOMES_CTE, DECORATED_CTE) +
          f"""SELECT id, name, CASE WHEN regexp_matches(name, {_OI})
                THEN lower(trim(regexp_replace(trim(regexp_extract(name, {_OI}, 2)), '(Phone|sđt).*', '', 'g')))
              END AS inside_needle FROM dec""")
def q_needle_fallback(spark, sf):
    d = _decorated(spark, sf)
    return d.select("id", "name", F.lower(K.fallback_needle(F.col("name"))).alias("inside_needle"))


# --- J3 / W2 ------------------------------------------------------------------------------

@register("containment_match", _with(HOMES_CTE, W1_CTE, ANC_CTE, M_CTE) +
          "SELECT anchor_source, anchor_id, source, match_id, match_name FROM m")
def q_containment_match(spark, sf):
    return R.best_matches(homes_from_part(spark, sf))


@register("best_match_per_anchor", _with(HOMES_CTE, W1_CTE, ANC_CTE) + """
SELECT anchor_source, anchor_id, match_id, match_name FROM (
  SELECT a.anchor_source, a.anchor_id, c.id AS match_id, c.homename AS match_name,
         row_number() OVER (PARTITION BY a.anchor_source, a.anchor_id ORDER BY c.homename, c.id) AS rk
  FROM anc a JOIN homes c ON c.city = a.city AND c.source <> a.anchor_source AND contains(lower(c.homename), a.needle))
WHERE rk = 1""")
def q_best_match_per_anchor(spark, sf):
    """W2 over all other sources at once: one best candidate per anchor."""
    m = R.best_matches(homes_from_part(spark, sf))
    agg = m.groupBy("anchor_source", "anchor_id").agg(F.min(F.struct("match_name", "match_id")).alias("b"))
    return agg.select("anchor_source", "anchor_id", F.col("b.match_id").alias("match_id"),
                      F.col("b.match_name").alias("match_name"))


# --- W3 / J4 / O2 ----------------------------------------------------------------------------

@register("claim_once", _with(HOMES_CTE, W1_CTE, ANC_CTE, M_CTE, PASSES_CTE) +
          "SELECT pass, anchor_source, anchor_id, source, match_id, owned FROM pm")
def q_claim_once(spark, sf):
    _, m = R.resolve_passes(homes_from_part(spark, sf))
    return m.select("pass", "anchor_source", "anchor_id", "source", "match_id", "owned")


@register("unclaimed_anchors", _with(HOMES_CTE, W1_CTE, ANC_CTE, M_CTE, PASSES_CTE) +
          "SELECT pass, anchor_source, anchor_id, homename FROM pa")
def q_unclaimed_anchors(spark, sf):
    a, _ = R.resolve_passes(homes_from_part(spark, sf))
    return a.select("pass", "anchor_source", "anchor_id", "homename")


@register("claimed_ids", _with(HOMES_CTE, W1_CTE, ANC_CTE, M_CTE, PASSES_CTE) +
          "SELECT DISTINCT source, match_id AS id FROM pm")
def q_claimed_ids(spark, sf):
    _, m = R.resolve_passes(homes_from_part(spark, sf))
    return R.claimed_ids(m)


# --- O1 (flagship) ------------------------------------------------------------------------------

def combine_ctes(homes_cte: str = HOMES_CTE, names: tuple = (1, 2, 3)) -> tuple[str, list[str]]:
    """(final SELECT, CTEs before it) of the assembled row; ``names`` are the three sources."""
    attrs = ["url", "rating", "cheapest_price", "address", "description", "property_highlights", "images"]
    lit = [f"'{s}'" if isinstance(s, str) else str(s) for s in names]
    wide_cols = []
    for s, v in zip(names, lit):
        wide_cols.append(f"max(CASE WHEN l.source = {v} THEN hid END) AS id_{s}")
        wide_cols.append(f"bool_or(CASE WHEN l.source = {v} THEN own END) AS own_{s}")
        for a in attrs:
            wide_cols.append(f"first(h.{a}) FILTER (WHERE l.source = {v}) AS {a}_{s}")
    sel = ["w.pass", "w.anchor_id", "pa.homename", "pa.city"]
    for s in names:
        sel += [f"id_{s}", f"coalesce(own_{s}, false) AS own_{s}"]
    for a, o in (("rating", "rating"), ("cheapest_price", "price"), ("url", "url")):
        for s in names:
            sel.append(f"CASE WHEN id_{s} IS NULL THEN '' ELSE coalesce(CAST({a}_{s} AS VARCHAR), '') END AS {o}_{s}")
    x, y, z = names
    for a in ("description", "address"):
        sel.append(f"coalesce(CASE WHEN {a}_{x} <> '' THEN {a}_{x} END, CASE WHEN {a}_{y} <> '' THEN {a}_{y} END, "
                   f"CASE WHEN id_{z} IS NOT NULL THEN coalesce({a}_{z}, '') ELSE '' END) AS {a}")
    for a in ("property_highlights", "images"):
        sel.append(f"array_to_string(coalesce(CASE WHEN len({a}_{x}) > 0 THEN {a}_{x} END, CASE WHEN len({a}_{y}) > 0 THEN {a}_{y} END, "
                   f"CASE WHEN id_{z} IS NOT NULL THEN coalesce({a}_{z}, []::VARCHAR[]) ELSE []::VARCHAR[] END), '|') AS {a}")
    passes = re.sub(r"source = ([123])\b", lambda m: f"source = {lit[int(m[1]) - 1]}", PASSES_CTE)
    ctes = [homes_cte, W1_CTE, ANC_CTE, M_CTE, passes,
            """lng AS (SELECT pass, anchor_id, anchor_source AS source, anchor_id AS hid, true AS own FROM pa
            UNION ALL SELECT pass, anchor_id, source, match_id AS hid, owned AS own FROM pm)""",
            f"""wide AS (SELECT l.pass, l.anchor_id, {', '.join(wide_cols)}
            FROM lng l JOIN homes h ON h.source = l.source AND h.id = l.hid GROUP BY l.pass, l.anchor_id)"""]
    return f"SELECT {', '.join(sel)} FROM wide w JOIN pa ON pa.pass = w.pass AND pa.anchor_id = w.anchor_id", ctes


def _combine_sql() -> str:
    final, ctes = combine_ctes()
    return _with(*ctes) + final


def combine_flat(spark, sf_dir):
    c = R.combine_three_sources(homes_from_part(spark, sf_dir))
    return c.withColumn("property_highlights", F.array_join("property_highlights", "|")) \
            .withColumn("images", F.array_join("images", "|"))


register("combine_three_sources", _combine_sql())(combine_flat)


# --- P16 / P17 --------------------------------------------------------------------------------

@register("truthy_coalesce", _with(HOMES_CTE, W1_CTE) + """
SELECT homename,
  coalesce(max(CASE WHEN source = 1 AND description <> '' THEN description END),
           max(CASE WHEN source = 2 AND description <> '' THEN description END),
           coalesce(max(CASE WHEN source = 3 THEN description END), '')) AS description,
  array_to_string(coalesce(first(CASE WHEN len(images) > 0 THEN images END) FILTER (WHERE source = 1),
           first(CASE WHEN len(images) > 0 THEN images END) FILTER (WHERE source = 2),
           coalesce(first(images) FILTER (WHERE source = 3), []::VARCHAR[])), '|') AS images
FROM w1 GROUP BY homename""")
def q_truthy_coalesce(spark, sf):
    w1 = R.first_per_name(homes_from_part(spark, sf))
    g = w1.groupBy("homename").agg(
        *[F.max(F.when(F.col("source") == s, F.col("description"))).alias(f"d{s}") for s in (1, 2, 3)],
        *[F.max_by(F.col("images"), F.when(F.col("source") == s, F.lit(1))).alias(f"i{s}") for s in (1, 2, 3)])
    return g.select("homename",
                    R.truthy_coalesce([F.col("d1"), F.col("d2"), F.col("d3")]).alias("description"),
                    F.array_join(R.truthy_coalesce([F.col("i1"), F.col("i2"), F.col("i3")], is_array=True), "|").alias("images"))


@register("per_source_struct", _with(HOMES_CTE, W1_CTE) + """
SELECT homename,
  coalesce(max(CASE WHEN source = 1 THEN rating END), '') AS rating_1,
  coalesce(max(CASE WHEN source = 2 THEN rating END), '') AS rating_2,
  coalesce(max(CASE WHEN source = 3 THEN rating END), '') AS rating_3,
  coalesce(max(CASE WHEN source = 1 THEN url END), '') AS url_1,
  coalesce(max(CASE WHEN source = 2 THEN url END), '') AS url_2,
  coalesce(max(CASE WHEN source = 3 THEN url END), '') AS url_3
FROM w1 GROUP BY homename""")
def q_per_source_struct(spark, sf):
    w1 = R.first_per_name(homes_from_part(spark, sf))
    aggs = []
    for a in ("rating", "url"):
        for s in (1, 2, 3):
            aggs.append(R.per_source_value(F.max(F.when(F.col("source") == s, F.col("id"))),
                                           F.max(F.when(F.col("source") == s, F.col(a)))).alias(f"{a}_{s}"))
    return w1.groupBy("homename").agg(*aggs)


# --- K3 at work: outside parts that match nothing fall back to the inside part -------------------

def _fallback_homes(spark, sf):
    h = homes_from_part(spark, sf)
    name = F.when(F.col("id") % 4 == 0, F.concat(F.lit("V"), F.col("id").cast("string"), F.lit("X ("),
                                                 F.col("homename"), F.lit(")"))).otherwise(F.col("homename"))
    return h.withColumn("homename", name)


_FALLBACK_HOMES = HOMES_CTE.replace(
    "p_name AS homename", "CASE WHEN p_partkey % 4 = 0 THEN 'V' || CAST(p_partkey AS VARCHAR) || 'X (' || p_name || ')' "
    "ELSE p_name END AS homename")
_INSIDE_CTE = f"""anc2 AS (
  SELECT source AS anchor_source, id AS anchor_id, city,
         lower(trim(regexp_replace(trim(regexp_extract(homename, {_OI}, 2)), '(Phone|sđt).*', '', 'g'))) AS needle
  FROM w1 WHERE regexp_matches(homename, {_OI})),
m2 AS (
  SELECT * FROM (
    SELECT a.anchor_source, a.anchor_id, c.source, c.id AS match_id, c.homename AS match_name,
           row_number() OVER (PARTITION BY a.anchor_source, a.anchor_id, c.source ORDER BY c.homename, c.id) AS rk
    FROM anc2 a JOIN homes c
      ON c.city = a.city AND c.source <> a.anchor_source AND contains(lower(c.homename), a.needle))
  WHERE rk = 1)"""


@register("fallback_match", _with(_FALLBACK_HOMES, W1_CTE, ANC_CTE, M_CTE, _INSIDE_CTE) + """
SELECT anchor_source, anchor_id, source, match_id, match_name, false AS used_inside FROM m
UNION ALL
SELECT anchor_source, anchor_id, source, match_id, match_name, true AS used_inside FROM m2
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.anchor_source = m2.anchor_source AND m.anchor_id = m2.anchor_id
                  AND m.source = m2.source)""")
def q_fallback_match(spark, sf):
    """K3 on: anchors shaped 'outside (inside)' whose outside part finds nothing in a source try the inside part."""
    m = R.best_matches(_fallback_homes(spark, sf), use_inside_fallback=True)
    return m.select("anchor_source", "anchor_id", "source", "match_id", "match_name", "used_inside")
