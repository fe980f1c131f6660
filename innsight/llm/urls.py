"""URL filter: rules indexed by their rarest literal token."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A list of at most so many rules is broadcast (a few hundred bytes each); a longer one is shuffled by token.
BROADCAST_RULES = 10_000
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``regex`` is searched in ``host + ' ' + path``; every text in ``literals`` is a whole token of any match."""

    name: str
    verdict: str
    regex: str
    literals: tuple[str, ...]
    weight: int
    named: bool


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A host with all its subdomains, and the start of a path. The longest rule wins."""
    name = host + path
    # the last run of a path prefix may go on in the url, so only runs closed by the prefix itself are whole tokens
    closed = re.findall(TOKEN, host) + re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path.lower())
    return Rule(name, verdict, rf"^(?:[^/]*\.)?{re.escape(host)} {re.escape(path)}", tuple(closed), len(name), True)


def word_rule(word: str) -> Rule:
    """Block a whole token of the host or path."""
    return Rule(word, "block", rf"(?i)(?:^|[^a-z0-9]){re.escape(word)}(?:$|[^a-z0-9])", (word,), len(word), False)


# --- fixed values: the host rules of the production filter, then tokens of hosts and paths that are never training text
HOST_RULES = [host_rule("block", "net", "/"), host_rule("allow", "example.net", "/en/"),
              host_rule("block", "example.com", "/de/"), host_rule("allow", "org", "/fr/")]
WORD_RULES = [word_rule(w) for w in (
    "adserver", "adult", "baccarat", "betting", "casino", "doubleclick", "escort", "gambling", "hentai", "jackpot",
    "malware", "nsfw", "payday", "phishing", "poker", "porn", "roulette", "sex", "slots", "torrent", "viagra", "warez",
    "xxx")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule_rows(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(r.name).alias("name"), F.lit(r.verdict).alias("rule_verdict"), F.lit(r.regex).alias("regex"),
        F.array(*map(F.lit, r.literals)).alias("literals"), F.lit(r.weight).alias("weight"),
        F.lit(r.named).alias("named")) for r in rules])))


def _tokens(target: Column) -> Column:
    """Distinct tokens of host and path."""
    return F.array_distinct(F.regexp_extract_all(F.lower(target), F.lit(f"({TOKEN})"), F.lit(1)))


def judge_urls(pages: DataFrame, url_col: str, rules: Sequence[Rule]) -> DataFrame:
    """Judge every url by the rules.

    pages -> its columns and ``host``, ``path``, ``rule`` (name of the longest
    fitting host rule, ties to the smaller name; else null), ``verdict``: that rule's; else
    ``block`` if a word rule fits; else ``allow``. Columns of ``pages`` with
    these names are replaced. A null url, an empty one or one without ``://``
    has an empty host and path, fits no rule and is allowed. Repeated rows each get their verdict. Every rule
    needs at least one literal.

    A rule is indexed under that of its literals which the fewest urls hold,
    counted over all urls. The tokens of a url fetch candidate rules by an
    equi-join, and only these run their regular expression. One row per url
    and one per fitting rule go through the shuffle.
    """
    if any(not r.literals for r in rules):
        raise ValueError("a rule without a literal token cannot be indexed")
    spark = pages.sparkSession
    out = ("host", "path", "rule", "verdict")
    carry = [c for c in pages.columns if c not in out]
    url = F.col(f"`{url_col}`").cast("string")
    target = F.concat_ws(" ", host_of(url), path_of(url))

    small = len(rules) <= BROADCAST_RULES
    hint = F.broadcast if small else (lambda x: x)
    rows = _rule_rows(spark, rules)
    literals = rows.select(F.explode("literals").alias("lit")).distinct()
    seen = (pages.select(F.explode(_tokens(target)).alias("tok")).join(hint(literals), F.col("tok") == F.col("lit"))
            .groupBy("lit").agg(F.count(F.lit(1)).alias("urls")))
    each = rows.withColumn("lit", F.explode("literals")).join(seen, "lit", "left")
    rarest = Window.partitionBy("name", "regex").orderBy(F.coalesce("urls", F.lit(0)), "lit")
    index = (each.withColumn("at", F.row_number().over(rarest)).where("at = 1")
             .select(F.col("lit"), "name", "rule_verdict", "regex", "weight", "named"))

    base = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], host_of(url).alias("h"),
                        path_of(url).alias("p"), target.alias("t"), F.monotonically_increasing_id().alias("row"))
    kept = [f"c{i}" for i in range(len(carry))] + ["h", "p"]
    # the first of the exploded tokens is empty and carries the row itself
    cand = base.select(*kept, "t", "row", F.explode(F.concat(F.array(F.lit("")), _tokens(F.col("t")))).alias("tok"))
    fits = F.col("lit").isNotNull() & F.expr("t rlike regex")
    hits = cand.join(hint(index), F.col("tok") == F.col("lit"), "left").where((F.col("tok") == "") | fits)
    best = F.min(F.when(F.col("named") & (F.col("tok") != ""),
                        F.struct((-F.col("weight")).alias("w"), F.col("name").alias("name"),
                                 F.col("rule_verdict").alias("v"))))
    res = hits.groupBy("row").agg(
        *[F.any_value(F.when(F.col("tok") == "", F.col(c)), True).alias(c) for c in kept], best.alias("best"),
        F.max((F.col("tok") != "") & ~F.coalesce("named", F.lit(True))).alias("word"))
    verdict = F.coalesce(F.col("best.v"), F.when(F.col("word"), F.lit("block")).otherwise(F.lit("allow")))
    return res.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], F.col("h").alias("host"),
                      F.col("p").alias("path"), F.col("best.name").alias("rule"), verdict.alias("verdict"))
