"""Sharding by proportional stratified interleaving (law ``rows``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.llm.common import key_of, materialise, uniform
from innsight.operators.numbering import running_number

#: Rows that one cell of the final order holds on average, and the least number of cells.
ROWS_PER_CELL, LEAST_CELLS = 20_000, 256


def assign_shards(docs: DataFrame, n_shards: int, source: Column, key: Column, seed: int = 1) -> DataFrame:
    """Put every row into one of ``n_shards`` shards that all have the mixture of the whole.

    Rows are shuffled by a seeded hash within each source (stratum) and ranked;
    row r of a source of n rows gets the fractional rank (r + u) / n, u being a
    seeded phase of the source. All rows are sorted by fractional rank and cut
    into shards whose row counts differ by one at most (law ``rows``).

    Returns the columns of ``docs`` and ``shard`` int, ``slot`` long (gapless
    from 0 in each shard). A column of ``docs`` with one of these names is replaced.
    Null sources are a stratum of their own, null keys and texts are rows like
    any other, repeated rows (also with one key) each get their own slot, an empty table gives an empty
    one. Equal texts are not held together: the law of row counts decides.

    The order of the shuffle follows from the seed and the key alone, so a row's shard depends neither on the layout of the
    files nor on the order of the rows; only which of several rows with one key comes first depends on their place.

    Ranks are made without collecting a source or the corpus anywhere: rows are sorted by ranges, and counts of ranges
    give what lies before; the final order is cut into cells of bounded size that windows rank.
    """
    cols = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)], key_of(source).alias("s"),
                       F.xxhash64(F.lit(seed), key_of(key)).alias("h"), key_of(key).alias("k"))
    numbered = running_number(rows, ["s"], [F.col("h"), F.col("k")], "rank")
    totals = materialise(numbered.groupBy("s").agg(F.count(F.lit(1)).alias("total")), "shard-sources")
    n = totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    cells = max(LEAST_CELLS, -(-n // ROWS_PER_CELL))
    phase = uniform(F.xxhash64(F.lit(seed), F.lit("phase"), F.col("s")), 1 << 20) / F.lit(float(1 << 20))
    ranked = materialise(numbered.join(totals, "s").withColumn("f", (F.col("rank") + phase) / F.col("total"))
                         .withColumn("g", F.floor(F.col("f") * cells)), "shard-ranked")

    # one row per cell of the fractional rank: its offset among all rows
    offsets = (ranked.groupBy("g").agg(F.count(F.lit(1)).alias("m"))
               .withColumn("first", F.sum("m").over(Window.partitionBy(F.lit(0)).orderBy("g")) - F.col("m")).drop("m"))
    place = F.col("first") + F.row_number().over(Window.partitionBy("g").orderBy("f", "h", "s", "rank")) - 1
    placed = (ranked.join(offsets, "g").withColumn("p", place)
              .withColumn("shard", F.expr(f"(p * {int(n_shards)}) div {max(n, 1)}").cast("int")))
    start = F.expr(f"(cast(shard as bigint) * {n} + {int(n_shards)} - 1) div {int(n_shards)}")
    return placed.withColumn("slot", F.col("p") - start).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)], "shard", "slot")
