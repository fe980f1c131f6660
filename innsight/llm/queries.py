"""Registered queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innsight.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return put


@_query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards whose row counts differ by one at most, each with the mixture of sources."""
    from innsight.llm.sharding import assign_shards

    text = F.col("text")
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    return assign_shards(d, 40, F.col("source"), F.col("doc_id")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


def _license_sql() -> str:
    from innsight.llm import licenses as L

    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def canon(x: str) -> str:
        c = f"regexp_replace(lower({x}), {lit(L.COPYRIGHT_LINE)}, '', 'g')"
        c = f"regexp_replace({c}, {lit(L.PUNCTUATION.replace(chr(92) + 'x0B', chr(92) + 'v'))}, ' ', 'g')"
        for a, b in L.SPELLINGS:
            c = f"replace({c}, {lit(a)}, {lit(b)})"
        return f"regexp_replace(regexp_replace({c}, ' +', ' ', 'g'), '(?m)^ | $', '', 'g')"

    def whole(x: str) -> str:
        return f"sha256(trim(regexp_replace({x}, '[ \\n]+', ' ', 'g')))"

    # DuckDB's patterns have no look-ahead: the lines are tested one by one
    owned = lit(f"^{L.MARGIN}{L.OWNED}$")
    named = lit(f"^{L.MARGIN}copyright[ \\t]+[^\\n]{{1,60}}$")
    not_named = lit(f"^{L.MARGIN}copyright[ \\t]{L.NO_OWNER}")

    def unowned(x: str) -> str:
        drop = f"regexp_matches(l, {owned}) OR (regexp_matches(l, {named}) AND NOT regexp_matches(l, {not_named}))"
        return f"array_to_string(list_transform(string_split(lower({x}), chr(10)), lambda l: CASE WHEN {drop} THEN '' ELSE l END), chr(10))"

    def wanted(x: str) -> str:
        c = f"trim(regexp_replace({canon(unowned(x))}, '[ \\n]+', ' ', 'g'))"
        for a, b in L.SPELLINGS:
            if " " in a:
                c = f"replace({c}, {lit(a)}, {lit(b)})"
        return f"sha256({c})"

    known = ", ".join(f"({lit(i)}, {lit(t)})" for i, t in L.KNOWN_LICENSES)
    return f"""
WITH known AS (SELECT {wanted('t')} AS d, min(i) AS license_id FROM (VALUES {known}) k(i, t) GROUP BY 1),
canon AS (SELECT doc_id, {canon('text')} AS c, {wanted('text')} AS w, row_number() OVER () AS rn FROM documents),
lines AS (SELECT DISTINCT rn, {whole('l')} AS d FROM (SELECT rn, unnest(string_split(c, chr(10))) AS l FROM canon) WHERE l <> ''),
hits AS (SELECT rn, list_sort(list(DISTINCT license_id)) AS ids FROM lines JOIN known USING (d) GROUP BY rn)
SELECT doc_id, {whole('c')} AS license_digest, known.license_id AS license_id,
       coalesce(array_to_string(hits.ids, ','), '') AS line_license_ids
FROM canon LEFT JOIN known ON known.d = w LEFT JOIN hits USING (rn)"""


@_query("op5_license_scan", _license_sql())
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every whole text, and of its lines, by canonical digest."""
    from innsight.llm.licenses import scan_licenses

    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(d, "text").select(
        "doc_id", "license_digest", "license_id", F.array_join("line_license_ids", ",").alias("line_license_ids"))


def _url_sql() -> str:
    from innsight.llm.urls import HOST_RULES, WORD_RULES

    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    rules = ", ".join(f"({lit(r.name)}, {lit(r.verdict)}, {lit(r.name.partition('/')[0])}, {lit('/' + r.name.partition('/')[2])})"
                      for r in HOST_RULES)
    words = ", ".join(lit(r.name) for r in WORD_RULES)
    return f"""
WITH parts AS (SELECT row_number() OVER () AS rn, page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
rules AS (SELECT * FROM (VALUES {rules}) r(name, v, h, p)),
best AS (SELECT rn, arg_min(name, (-length(name), name)) AS name, arg_min(v, (-length(name), name)) AS v
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rn)
SELECT page_id, host, path, best.name AS rule, coalesce(best.v,
  CASE WHEN list_has_any(regexp_extract_all(lower(host || ' ' || path), '[a-z0-9]+'), [{words}]) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN best USING (rn)"""


@_query("op6_url_filter", _url_sql())
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    from innsight.llm.urls import HOST_RULES, WORD_RULES, judge_urls

    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), "url", HOST_RULES + WORD_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def _quality_sql() -> str:
    from innsight.llm import quality as Q

    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def some(words) -> str:
        return "[" + ", ".join(map(lit, sorted(words))) + "]"

    blank, word = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
    phrases = " OR ".join(f"contains(low, {lit(p)})" for p in Q.BOILERPLATE)
    ends, starts = some(r"#*$%&~^=@\\"[:-1]), some(r"#*$%&~^=\\"[:-1])
    strip = "' ' || chr(9) || chr(13) || chr(11) || chr(12) || '.!:|»›'"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rn, doc_id, t, regexp_extract_all(t, '{word}') AS ws FROM d),
windows AS (SELECT rn, unnest(generate_series(1, len(ws) - 4)) AS i, ws FROM w),
twice AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, ws[i:i + 4]) AS c FROM windows) WHERE c > 1),
rep AS (SELECT rn, count(DISTINCT p) AS n FROM (SELECT rn, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS p FROM twice) GROUP BY rn),
lines AS (SELECT rn, l, lower(l) AS low, regexp_extract_all(l, '{word}') AS ws FROM (SELECT rn, unnest(string_split(t, chr(10))) AS l FROM d)),
counted AS (SELECT rn, l, low, ws, len(ws) AS n,
    len(list_filter(ws, lambda x: list_contains({some(Q.SEPARATORS)}, x))) AS marks,
    len(list_filter(ws, lambda x: list_contains({ends}, right(x, 1)) OR list_contains({starts}, left(x, 1)))) AS marked,
    len(list_filter(ws, lambda x: length(x) > 1 AND upper(x) = x AND lower(x) <> x)) AS shouted,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS echoed,
    list_max(map_values(list_histogram(ws))) AS most
  FROM lines WHERE len(ws) > 0),
judged AS (SELECT rn, l, length(regexp_replace(l, '{blank}', '', 'g')) AS chars,
    (n >= {Q.PROSE_WORDS} AND len(list_filter(ws, lambda x: list_contains({some(Q.TERMINAL)}, right(x, 1)))) = 0)
    OR (n <= 4 AND list_contains({some(Q.NAVIGATION)}, trim(low, {strip})))
    OR (n <= 40 AND ({phrases})) OR (marks >= 3 AND marks > {Q.SEPARATOR_SHARE} * n)
    OR (n >= 5 AND ((regexp_matches(l, '[#*$%&~^=@\\\\]') AND marked > {Q.SYMBOL_SHARE} * n) OR shouted > {Q.SHOUT_SHARE} * n))
    OR (n >= 10 AND (echoed > {Q.SAME_SHARE} * n OR most > {Q.SAME_SHARE} * n)) AS fails
  FROM counted),
byline AS (SELECT rn, count(*) - count(DISTINCT l) AS dups, coalesce(sum(chars) FILTER (fails), 0) AS lost FROM judged GROUP BY rn),
m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '{blank}', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    coalesce(lost, 0)::BIGINT AS removed_chars FROM w LEFT JOIN rep USING (rn) LEFT JOIN byline USING (rn))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND word_chars - removed_chars >= {Q.KEEP_SHARE} * word_chars AS kept FROM m"""


@_query("op4_quality_rules", _quality_sql())
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict on every document."""
    from innsight.llm.quality import clean_documents

    return clean_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ["doc_id"], with_text=False)


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    from innsight.llm.bpe import encode_texts

    return encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), word_vocabulary(), "text", ["doc_id"],
                        digests_only=True)


def held_out():
    """Documents of which no language is learnt."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


@_query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    from innsight.llm.langid import fit, predict

    d = table(spark, sf_dir, "documents")
    model = fit(d.where(~F.coalesce(held_out(), F.lit(False))), "text", "lang", F.col("doc_id"))
    return predict(d.select("doc_id", "text"), model, "text", ["doc_id"]).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


@_query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of at most 2048."""
    from innsight.llm.packing import pack

    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), byte_vocabulary(), 1, "text", ["doc_id"])


_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
parts AS (SELECT *, CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE 17 + length(regexp_replace(replace(role, '\', '\\'), '([<\[])(</?SYS>>|/?INST\]|/?ROLE\]|/?s>)', '\1\\\2', 'g')) END
  + length(regexp_replace(replace(t, '\', '\\'), '([<\[])(</?SYS>>|/?INST\]|/?ROLE\]|/?s>)', '\1\\\2', 'g')) AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM parts GROUP BY conv_id"""


@_query("op2_chat_format", _CHAT_SQL)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the output."""
    from innsight.llm.chat import format_conversations, read_back

    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit("</s>[INST] ok [/INST]").alias("text"))
    parts = format_conversations(t.unionByName(more), F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text"))
    return read_back(parts)


@_query("op10_nearest_neighbours")
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth vector."""
    from innsight.llm.neighbours import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id"), F.col("embedding"), F.col("vec_id") % 100 == 0)


_JACCARD_SQL = r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS id, text, min(doc_id) AS k FROM documents WHERE regexp_matches(text, '[^\x20\x09-\x0D]') GROUP BY text),
w AS (SELECT id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
s AS (SELECT DISTINCT id, CASE WHEN len(ws) < 5 THEN ws ELSE ws[i:i + 4] END AS g
      FROM (SELECT id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM w)),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
p AS (SELECT a.id AS x, b.id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id GROUP BY a.id, b.id),
l AS (SELECT x, y, c = a.n AND c = b.n AS same FROM p JOIN n a ON a.id = x JOIN n b ON b.id = y WHERE 5 * c >= 4 * (a.n + b.n - c)),
reach AS (SELECT id, id AS r FROM t UNION SELECT reach.id, l.y FROM reach JOIN l ON l.x = reach.r),
cls AS (SELECT reach.id, min(t.k) AS class_id FROM reach JOIN t ON t.id = reach.r GROUP BY reach.id),
sets AS (SELECT t.id, least(t.k, coalesce(min(o.k), t.k)) AS set_class, count(l.y) AS n_links
  FROM t LEFT JOIN l ON l.x = t.id LEFT JOIN t o ON o.id = l.y AND l.same GROUP BY t.id, t.k)
SELECT d.doc_id, coalesce(cls.class_id, d.doc_id) AS class_id, coalesce(sets.set_class, d.doc_id) AS set_class,
  coalesce(sets.n_links, 0) AS n_links
FROM documents d LEFT JOIN t ON t.text = d.text LEFT JOIN cls ON cls.id = t.id LEFT JOIN sets ON sets.id = t.id"""


@_query("op3_jaccard_join", _JACCARD_SQL)
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    from innsight.llm.jaccard import link_documents

    return link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The checksums of the 256 octets, by the rule of crc32, as one list.
_CRC_TABLE = """
bits AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) ORDER BY n) AS by_octet
  FROM (SELECT unnest(range(256)) AS n))"""


def _crc_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes, where ``bits`` is joined."""
    h = f"hex(encode({text}))"
    octets = f"list_transform(range(1, length({h}), 2), lambda i: ('0x' || substr({h}, i, 2))::BIGINT)"
    return f"xor(list_reduce({octets}, lambda s, o: xor(s // 256, by_octet[xor(s % 256, o) + 1]), 4294967295::BIGINT), 4294967295)"


_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_RESAMPLE_SQL = rf"""
WITH {_CRC_TABLE.strip()},
d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(coalesce(translate(text, {_ASCII}), ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
words AS (SELECT true AS corpus, rn, unnest(ws) AS w FROM d UNION ALL
  SELECT false, 0, unnest(regexp_extract_all(translate(text, {_ASCII}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
bucket AS (SELECT w, {_crc_sql('w')} % 10000 AS b FROM (SELECT DISTINCT w FROM words), bits),
n AS (SELECT b, count(*) FILTER (corpus) AS s, count(*) FILTER (NOT corpus) AS t FROM words JOIN bucket USING (w) GROUP BY b),
gain AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS g FROM n),
doc AS (SELECT rn, count(*) AS n_features, sum(g)::BIGINT AS total FROM words JOIN bucket USING (w) JOIN gain USING (b) WHERE corpus GROUP BY rn),
scored AS (SELECT rn, doc_id, coalesce(n_features, 0) AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM d LEFT JOIN doc USING (rn)),
placed AS (SELECT rn, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS p, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN p <= 10 * n // 100 THEN p END AS rank
FROM scored LEFT JOIN placed USING (rn)"""


@_query("op11_resampling", _RESAMPLE_SQL)
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the words of the benchmark texts."""
    from innsight.llm.resample import resample

    return resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), "doc_id",
                    carry=["doc_id"])


def _merkle_sql(levels: int = 7) -> str:
    """Levels beyond the depth of a tree leave its lone node alone, so ``levels`` only bounds the table (16 ** 7 documents a source)."""
    def enc(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c} END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(enc, ["doc_id", "source", "lang", "n_chars", text])) + ")"

    parts = [f"""d AS (SELECT row_number() OVER () AS rn, doc_id, source, {leaf('text')} AS leaf,
  CASE WHEN {_crc_sql('doc_id::VARCHAR')} % 5 = 0 THEN {leaf(f'translate(text, {_ASCII})')} ELSE {leaf('text')} END AS shown FROM documents, bits)""",
             """a0 AS (SELECT rn, source AS t, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, rn) - 1 AS pos,
  leaf AS node, shown AS fold, '' AS proof FROM d)"""]

    def level(src: str, out: str) -> str:
        # one row per row of the table and level: the row's node, the fold of its presented leaf and the siblings so far
        return f"""
{out}_nodes AS (SELECT t, pos, any_value(node) AS node, max(pos) OVER (PARTITION BY t) AS last FROM {src} GROUP BY t, pos),
{out}_runs AS (SELECT t, pos // 16 AS up, sha256(string_agg(node, '' ORDER BY pos)) AS node, list(node ORDER BY pos) AS run, any_value(last) AS last
  FROM {out}_nodes GROUP BY t, pos // 16),
{out} AS (SELECT rn, {src}.t, CASE WHEN last = 0 THEN pos ELSE up END AS pos, CASE WHEN last = 0 THEN {src}.node ELSE r.node END AS node,
  CASE WHEN last = 0 THEN fold ELSE sha256(array_to_string(list_concat(run[:pos % 16], [fold], run[pos % 16 + 2:]), '')) END AS fold,
  CASE WHEN last = 0 THEN proof ELSE proof || array_to_string(list_concat(run[:pos % 16], run[pos % 16 + 2:]), '') END AS proof
  FROM {src} JOIN {out}_runs r ON r.t IS NOT DISTINCT FROM {src}.t AND up = pos // 16)"""

    for k in range(levels):
        parts.append(level(f"a{k}", f"a{k + 1}"))
    parts.append(f"b0 AS (SELECT rn, 0 AS t, dense_rank() OVER (ORDER BY encode(t) NULLS FIRST) - 1 AS pos, node, fold, proof FROM a{levels})")
    for k in range(levels):
        parts.append(level(f"b{k}", f"b{k + 1}"))
    return "WITH " + _CRC_TABLE.strip() + ",\n" + ",\n".join(p.strip() for p in parts) + f"""
SELECT doc_id, leaf, a{levels}.node AS subroot, top.node AS root, sha256(top.proof) AS proof_sha256, top.fold AS folded_root, top.fold = top.node AS verified
FROM d JOIN a{levels} USING (rn) JOIN b{levels} top USING (rn)"""


@_query("op12_merkle_manifest", _merkle_sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document checked against the manifest of all; those whose checksum 5 divides come with their text lower-cased."""
    from innsight.llm.merkle import leaf_digest, verify_rows

    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = leaf_digest([*fields, F.col("text")])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    shown = F.when(tampered, leaf_digest([*fields, lowered])).otherwise(leaf)
    return verify_rows(table(spark, sf_dir, "documents"), F.col("source"), F.col("doc_id"), leaf, shown, ["doc_id"])


@_query("op13_simhash")
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    from innsight.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", carry=["doc_id"])
