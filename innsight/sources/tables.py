"""Scans and sinks.

Every entity of every source is one DataFrame with a ``source`` column. Tables
are Parquet (the document store of the reference is not rebuilt); JSON inputs
are read with an explicit schema in PERMISSIVE mode, absent fields -> NULL.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.session import freed

#: Fields that hold a price: a list of pieces stands for its number.
PRICES = ("price", "cheapest_price")

CITY = T.StructType([T.StructField("vn", T.StringType()), T.StructField("en", T.StringType())])

HOME_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("homename", T.StringType()), T.StructField("city", CITY),
    T.StructField("cheapest_price", T.StringType()), T.StructField("rating", T.StringType()),
    T.StructField("address", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("property_highlights", T.ArrayType(T.StringType())),
    T.StructField("images", T.ArrayType(T.StringType())), T.StructField("reviews", T.IntegerType()),
])

ROOM_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("homename", T.StringType()), T.StructField("roomtype", T.StringType()),
    T.StructField("bedtype", T.StringType()), T.StructField("roomsize", T.DoubleType()),
    T.StructField("facilities", T.ArrayType(T.StringType())), T.StructField("photos", T.ArrayType(T.StringType())),
    T.StructField("availables", T.ArrayType(T.StructType([
        T.StructField("occupancy", T.IntegerType()), T.StructField("price", T.StringType())]))),
])

REVIEW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("homename", T.StringType()), T.StructField("user_name", T.StringType()),
    T.StructField("user_country", T.StringType()), T.StructField("review_date", T.DateType()),
    T.StructField("review_title", T.StringType()), T.StructField("review_score", T.StringType()),
    T.StructField("review_content", T.StringType()), T.StructField("sentiment", T.StringType()),
    T.StructField("label", T.StringType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_entity(frames: dict[str, DataFrame], order: Sequence[str] | None = None) -> DataFrame:
    """One entity of all sources -> one frame with a ``source`` column.

    ``frames`` maps a source name to its frame; columns missing in one source are
    NULL (``unionByName(allowMissingColumns=True)``).
    """
    names = list(order or frames.keys())
    out = None
    for s in names:
        f = frames[s].withColumn("source", F.lit(s))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bound(x: str, var: str, body: str) -> str:
    """SQL text of ``body`` with ``var`` bound to the value of ``x``, which is computed once."""
    return f"get(transform(array({x}), {var} -> {body}), 0)"


def _kind(v: str, *kinds: str) -> str:
    return f"coalesce(schema_of_variant({v}) RLIKE '^({'|'.join(kinds)})', false)"


def _settled(x: str, t: T.DataType, price: bool = False, depth: int = 0) -> str:
    """SQL text that settles a VARIANT into type ``t``, whatever form the value has."""
    v, e = f"v{depth}", f"e{depth}"
    text = f"CASE WHEN NOT {_kind(v, 'ARRAY', 'OBJECT', 'VOID')} THEN try_variant_get({v}, '$', 'string') END"
    items = f"try_variant_get({v}, '$', 'array<variant>')"
    if isinstance(t, T.StructType):
        fields = [f"{_quoted(f.name)}, {_settled(f'try_variant_get({v}, ' + _quoted('$.' + f.name) + ', ' + _quoted('variant') + ')', f.dataType, f.name in PRICES, depth + 1)}"
                  for f in t.fields]
        alone = [f"{_quoted(f.name)}, {_settled(v, f.dataType, f.name in PRICES, depth + 1) if i == 0 else f'cast(NULL AS {f.dataType.simpleString()})'}"
                 for i, f in enumerate(t.fields)]
        body = f"""CASE WHEN {_kind(v, 'OBJECT')} THEN named_struct({', '.join(fields)})
          WHEN {text} IS NOT NULL THEN named_struct({', '.join(alone)}) END"""
    elif isinstance(t, T.ArrayType):
        one = _settled(e, t.elementType, price, depth + 1)
        body = f"CASE WHEN {_kind(v, 'ARRAY')} THEN transform({items}, {e} -> {one}) WHEN {v} IS NOT NULL AND NOT {_kind(v, 'VOID')} THEN transform(array({v}), {e} -> {one}) END"
    elif isinstance(t, T.StringType):
        pieces = f"try_variant_get({v}, '$', 'array<string>')"
        chosen = f"try_element_at(filter({pieces}, s -> rlike(s, '[0-9]')), -1)" if price else f"array_join({pieces}, ' ')"
        body = f"CASE WHEN {_kind(v, 'ARRAY')} THEN {chosen} ELSE {text} END"
    elif isinstance(t, T.DateType):
        body = f"try_to_date(left({text}, 10), 'yyyy-MM-dd')"
    else:
        number = f"try_cast(replace(trim({text}), ',', '.') AS double)"
        whole = isinstance(t, (T.IntegerType, T.LongType))
        body = _bound(number, "n", f"CASE WHEN n = floor(n) THEN try_cast(n AS {t.simpleString()}) END") if whole else f"cast({number} AS {t.simpleString()})"
    return _bound(x, v, body)


def settle_entity(records: DataFrame, schema: T.StructType, variant: str = "v") -> DataFrame:
    """One VARIANT record per row -> the declared columns, each settled by its own type, whatever form the record gives it.

    A number may come as text ("18.0", "7,1") and a text as a number; a whole number may have a fraction of zero ("2.0"), any other
    text is no number (NULL). A list may come as a single value, a text as a list (joined by blanks; of a price's list the last
    piece with a digit is the price). A structure may come as a bare value, which is then its first field. An id may be
    under ``_id``, also in the form {"$oid": ...}. Absent and null are NULL. Adds ``price_vnd`` (BIGINT): of ``cheapest_price``
    where the schema has it, and inside each of ``availables``. Records that are not objects are left out.
    """
    from innsight.functions.parse import price_vnd

    rows = records.where(F.expr(_kind(variant, "OBJECT")))
    def field(f: T.StructField) -> str:
        value = f"try_variant_get({variant}, {_quoted('$.' + f.name)}, 'variant')"
        if f.name == "id":
            value = f"""coalesce({value}, try_variant_get({variant}, '$._id[\\'$oid\\']', 'variant'), try_variant_get({variant}, '$._id', 'variant'))"""
        return _settled(value, f.dataType, f.name in PRICES)

    out = rows.select(*[c for c in records.columns if c != variant], *[F.expr(field(f)).cast(f.dataType).alias(f.name) for f in schema.fields])
    if "cheapest_price" in schema.names:
        out = out.withColumn("price_vnd", price_vnd(F.col("cheapest_price")))
    if "availables" in schema.names:
        out = out.withColumn("availables", F.transform("availables", lambda a: a.withField("price_vnd", price_vnd(a["price"]))))
    return out


def read_json_entity(spark: SparkSession, path: str, schema: T.StructType, source: str, multi_line: bool = False) -> DataFrame:
    """S1 for JSON exported from a document store: each record is read once, as a VARIANT, and settled into the schema.

    JSON lines by default (split over tasks); ``multi_line`` reads files that hold one value over several lines, a
    record or a list of records. Lines that are not JSON objects are left out.
    """
    raw = spark.read.option("singleVariantColumn", "v").option("mode", "PERMISSIVE").option("multiLine", multi_line).json(path)
    listed = f"CASE WHEN {_kind('v', 'ARRAY')} THEN try_variant_get(v, '$', 'array<variant>') ELSE array(v) END"
    records = raw.select(F.explode(F.expr(listed)).alias("v")) if multi_line else raw
    return settle_entity(records, T.StructType([f for f in schema.fields if f.name != "source"])).withColumn("source", F.lit(source))


def city_dimension(spark: SparkSession, path: str, distinct: bool = False) -> DataFrame:
    """A ``{"cities": [{vn, en}, ...]}`` file -> one row per city, file order kept in ``ord``."""
    schema = T.StructType([T.StructField("cities", T.ArrayType(CITY))])
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    out = df.select(F.posexplode("cities").alias("ord", "city")).select("ord", "city.vn", "city.en")
    if distinct:
        out = out.groupBy("vn", "en").agg(F.min("ord").alias("ord")).select("ord", "vn", "en")
    return out


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S3: drop and recreate a table with the frame's rows."""
    df.write.mode("overwrite").format(fmt).save(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Bulk insert."""
    df.write.mode("append").format(fmt).save(path)


def write_documents(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S6 sink: one nested document per row (parquet or JSON lines)."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_document_tables(docs: DataFrame, reviews: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S6 sink at scale: ``path/documents`` (one row per property) and
    ``path/reviews`` (keyed child rows, one folder per source, sorted by
    property inside each file so a property's reviews sit in few row groups)."""
    with freed(docs.sparkSession):  # the shuffles of the documents do not lie on disk beside those of the reviews
        write_documents(docs, f"{path}/documents", fmt)
    (reviews.sortWithinPartitions("pass", "anchor_id", "seq")
     .write.mode("overwrite").partitionBy("source").format(fmt).save(f"{path}/reviews"))
