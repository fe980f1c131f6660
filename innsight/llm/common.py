"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.session import written


#: Write once below ``spark.checkpoint.dir`` and read back: cuts the lineage.
materialise = written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def key_of(col: Column) -> Column:
    """A non-null string key: null is told apart from every text."""
    return F.when(col.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), col.cast("string")))


def uniform(hash_col: Column, n: int) -> Column:
    """A long hash mapped evenly to 0..n-1 by its upper 31 bits, in hash order (as unsigned); n < 2**31."""
    return F.shiftright(F.shiftrightunsigned(hash_col, 33) * F.lit(n).cast("long"), 31)


#: Rows whose results a worker holds at a time.
ROWS_AT_ONCE = 1_000


def map_text(df: DataFrame, text_col: str, fields: list[T.StructField],
             make: Callable[[], Callable[[pa.Array], list]], carry: list[str] | None = None) -> DataFrame:
    """Add ``fields`` computed from a text column, one Arrow batch at a time.

    ``make`` is called once per task and returns a function from a string array
    to one list or Arrow array per field. The columns named in ``carry`` (all, if
    None) pass through untouched; a carried column that has the name of a new
    field is replaced by it. Column names inside the batch are positions, so
    no name of the input can clash. A text column that is carried too travels to the worker once.
    """
    new = {f.name for f in fields}
    carry = [c for c in (df.columns if carry is None else carry) if c not in new]
    types_of = {f.name: f.dataType for f in df.schema}
    as_is = types_of.get(text_col) == T.StringType()
    sent = [c for c in carry if not (as_is and c == text_col)]
    place = {c: i + 1 for i, c in enumerate(sent)}
    inner = df.select(F.col(f"`{text_col}`").cast("string").alias("t"),
                      *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(sent)])
    kept = [T.StructField(f"c{i}", types_of[c], True) for i, c in enumerate(carry)]
    added = [T.StructField(f"n{i}", f.dataType, True) for i, f in enumerate(fields)]
    schema = T.StructType(kept + added)
    types = [_ARROW[f.dataType.simpleString()] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in (x.slice(lo, ROWS_AT_ONCE) for x in batches for lo in range(0, x.num_rows, ROWS_AT_ONCE)):
            out = fn(b.column(0))
            arrays = [b.column(place.get(c, 0)) for c in carry]
            arrays += [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    made = inner.mapInArrow(run, schema)
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
                       *[F.col(f"n{i}").alias(f.name) for i, f in enumerate(fields)])


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
          "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
          "array<int>": pa.list_(pa.int32())}
