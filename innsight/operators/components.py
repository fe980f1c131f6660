"""Connected components of links by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.session import written


def _apart(df: DataFrame) -> DataFrame:
    """The key once more as a struct: a join on it shuffles both sides for itself, so that
    its skewed partitions can be split; on the plain key it would reuse the aggregate's, which cannot."""
    return df.withColumn("k", F.struct("a"))


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, root): every node of a link and the least node of its component.

    Each round joins all larger neighbours of a node to its least one, then
    its smaller ones; both are a pre-aggregated minimum and a join, so a node
    with many links is split like any skewed join. The number of rounds grows
    with the logarithm of the largest component; each ends in a written table
    in the shared folder. Nothing is collected but counts. Null ends and
    self-links are left out; an empty table gives an empty one.
    """
    e = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, state = written(e, "links"), None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = _apart(both).join(_apart(least).drop("a"), "k").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _apart(large).join(_apart(least).drop("a"), "k").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        e = written(small.select("e.*").where("a <> b").distinct(), "links")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
