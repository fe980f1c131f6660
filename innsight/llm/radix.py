"""Distributed radix sort: final places of rows by stable counting-sort passes over the digits of a composite key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.llm.common import materialise

#: Most bits of a digit: the per-digit totals (at most 2 ** DIGIT_BITS rows) are the only thing that one task adds up.
DIGIT_BITS = 12
#: Rows of a block, as a power of two: the most rows that one task sorts, also if all of them have one digit.
BLOCK_BITS = 17
#: A long with this bit flipped sorts as an unsigned number.
SIGN = -(1 << 63)


def _digits(keys: list[str], spans: list[int]) -> list[Column]:
    """Digits of the composite key, least significant first; ``spans`` are the low bits of each key that differ between rows."""
    total = sum(spans)
    passes = math.ceil(total / DIGIT_BITS)
    width = math.ceil(total / passes) if passes else 0
    out = []
    for p in range(passes):
        lo, hi, base, digit = p * width, min(total, (p + 1) * width), total, F.lit(0).cast("long")
        for key, span in zip(keys, spans, strict=True):
            base -= span  # this key holds the bits base .. base + span - 1 of the composite
            a, b = max(lo, base), min(hi, base + span)
            if a < b:
                bits = F.shiftrightunsigned(F.col(key).bitwiseXOR(F.lit(SIGN)), a - base).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
                digit = digit.bitwiseOR(F.shiftleft(bits, a - lo))
        out.append(digit)
    return out


def _spans(rows: DataFrame, keys: list[str]) -> tuple[int, list[int]]:
    """Number of rows, and of each key the number of low bits that are not equal in all rows."""
    ends = rows.agg(F.count(F.lit(1)).alias("n"), *[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
    if not ends["n"]:
        return 0, [0] * len(keys)
    # as unsigned numbers; the bits above the highest one that differs between the ends are the same in every row
    flip = 1 << 63
    return ends["n"], [((ends[f"min_{k}"] + flip) ^ (ends[f"max_{k}"] + flip)).bit_length() for k in keys]


def places(rows: DataFrame, row_id: str, keys: list[str]) -> tuple[DataFrame, int]:
    """(row_id, place) of every row in ascending order of ``keys``, most significant first, and the number of rows.

    ``row_id`` (unique long) names a row in the result; ``keys`` are long
    columns without nulls. Places are 0, 1, 2, ...; rows with equal keys
    get different places. An empty table gives an empty one.

    A least-significant-digit radix sort. Rows stand in blocks of 2 ** BLOCK_BITS
    consecutive places. A pass counts the rows of each (digit, block); totals of
    digits and, inside a digit, counts of the blocks before give the place
    of the first row of each (digit, block), and the rank inside it the place of every row.
    A pass keeps the order that the passes before it made, so
    after the most significant digit the places are final. Digits cover only the bits that differ
    between rows. Each pass writes its rows, so a lost executor repeats
    part of one pass.
    """
    cur = materialise(rows.select(F.col(row_id).alias("r"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
                                  F.monotonically_increasing_id().alias("p")), "radix")
    names = [f"k{i}" for i in range(len(keys))]
    n, spans = _spans(cur, names)
    digits = _digits(names, spans)
    if not digits:  # all keys are equal: number the rows as they stand, by one pass over a digit that all share
        digits = [F.lit(0).cast("long")]
    for digit in digits:
        at = cur.withColumn("d", digit).withColumn("b", F.shiftright("p", BLOCK_BITS))
        counts = at.groupBy("d", "b").agg(F.count(F.lit(1)).alias("m"))
        # at most 2 ** DIGIT_BITS rows: the one window without a partition, and a broadcast of that bound
        totals = counts.groupBy("d").agg(F.sum("m").alias("m")).withColumn(
            "first", F.sum("m").over(Window.partitionBy(F.lit(0)).orderBy("d")) - F.col("m")).drop("m")
        before = F.sum("m").over(Window.partitionBy("d").orderBy("b")) - F.col("m")
        start = (counts.withColumn("before", before).join(F.broadcast(totals), "d")
                 .select("d", "b", (F.col("first") + F.col("before")).alias("start")))
        rank = F.row_number().over(Window.partitionBy("d", "b").orderBy("p")) - 1
        cur = materialise(at.join(start, ["d", "b"]).withColumn("p", F.col("start") + rank).select("r", *names, "p"), "radix")
    return cur.select(F.col("r").alias(row_id), F.col("p").alias("place")), n
