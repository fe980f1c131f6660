"""Running numbers inside groups of any size."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.session import written


def running_number(rows: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "n") -> DataFrame:
    """Add ``out``: 0, 1, 2, ... inside each group of ``by`` in ``order`` (ascending, nulls first).

    No window holds a group: rows are range-partitioned and sorted by (by, order), written with an ascending number, and the
    counts of (group, partition), a few rows per partition, say what lies before. A group that fills
    many partitions is numbered by as many tasks. Rows equal in everything ordered by get different numbers.
    """
    by = list(by)
    names = [f"_o{i}" for i in range(len(order))]
    keyed = written(rows.select("*", *[c.alias(n) for c, n in zip(order, names, strict=True)], F.monotonically_increasing_id().alias("_r")), "rows")
    keys = [*by, *names, "_r"]
    placed = written(keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .withColumn("_m", F.monotonically_increasing_id()), "numbered").withColumn("_part", F.shiftright("_m", 33))
    group = F.struct(*by)
    before = Window.partitionBy("_g").orderBy("_part")
    parts = (placed.groupBy(group.alias("_g"), "_part").agg(F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_c"))
             .select("_g", "_part", (F.sum("_c").over(before) - F.col("_c") - F.col("_first")).alias("_shift")))
    return (placed.withColumn("_g", group).join(parts, ["_part", "_g"]).withColumn(out, F.col("_m") + F.col("_shift"))
            .select(*[c for c in rows.columns if c != out], out))
