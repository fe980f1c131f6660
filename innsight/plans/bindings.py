"""Bindings of the listing model to the driver's test tables.

Each binding is written twice, as DataFrame code and as a DuckDB CTE, so that
every query and its oracle read the same derived rows.

homes   <- part: id = seq = p_partkey, source = brand number mod 3 + 1,
           city = p_type, homename = p_name (64 names; 'cold ring' contains
           'old ring', so containment has real cases).
rooms   <- part: home = p_partkey div 24 (bounded rooms per home at every scale),
           source = p_partkey mod 3 + 1, roomtype = p_name + a room word;
rooms and reviews of named homes <- lineitem joined to part: the row belongs to the part's (source, name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innsight.session import spread
from innsight.sources.tables import read_table


def _brand_no(c):
    return F.substring(c, 7, 10).cast("int")


#: Source names of the named binding (ids are then strings too, as in the declared schemas).
SOURCE_NAMES = ("alpha", "beta", "gamma")


def with_named_sources(df: DataFrame) -> DataFrame:
    """Sources 1, 2, 3 by name and ids as strings, as the declared entity schemas have them."""
    names = F.array(*[F.lit(s) for s in SOURCE_NAMES])
    return df.withColumn("source", F.element_at(names, F.col("source").cast("int"))).withColumn(
        "id", F.concat(F.lit("x"), F.col("id").cast("string")))


def named_cte(name: str, cte: str) -> str:
    """The same over a CTE called ``name``: it becomes ``<name>0``, with the named form under its name."""
    names = "[" + ", ".join(f"'{s}'" for s in SOURCE_NAMES) + "]"
    return (cte.replace(f"{name} AS (", f"{name}0 AS (", 1)
            + f",\n{name} AS (SELECT * REPLACE ({names}[source] AS source, 'x' || CAST(id AS VARCHAR) AS id) FROM {name}0)")


def homes_from_part(spark: SparkSession, sf_dir: str, block: int | None = None) -> DataFrame:
    """Homes; with ``block`` the name gets the block number p_partkey div block
    appended, so names (and rooms/reviews per name) stay bounded as data grows."""
    p = read_table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    name = F.col("p_name") if block is None else F.concat_ws(" ", "p_name", F.floor(k / block).cast("string"))
    return p.select(
        k.alias("id"), k.alias("seq"), (_brand_no(F.col("p_brand")) % 3 + 1).alias("source"),
        name.alias("homename"), F.col("p_type").alias("city"),
        F.concat(F.lit("https://stay.example/h/"), k.cast("string")).alias("url"),
        F.concat((size % 10).cast("string"), F.lit(","), (size % 7).cast("string")).alias("rating"),
        (size * 1013 + k % 997).cast("string").alias("cheapest_price"),
        F.when(size % 2 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("addr "), k.cast("string"))).alias("address"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.concat_ws(" / ", "p_name", "p_type")).alias("description"),
        F.when(size % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("p_type", "p_brand")).alias("property_highlights"),
        F.when(size % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("img/"), k.cast("string")))).alias("images"),
    )


def homes_cte(block: int | None = None) -> str:
    name = "p_name" if block is None else f"p_name || ' ' || CAST(p_partkey // {block} AS VARCHAR)"
    return HOMES_CTE.replace("p_name AS homename", f"{name} AS homename")


HOMES_CTE = """homes AS (
  SELECT p_partkey AS id, p_partkey AS seq, CAST(substr(p_brand, 7) AS INTEGER) % 3 + 1 AS source,
         p_name AS homename, p_type AS city,
         'https://stay.example/h/' || CAST(p_partkey AS VARCHAR) AS url,
         CAST(p_size % 10 AS VARCHAR) || ',' || CAST(p_size % 7 AS VARCHAR) AS rating,
         CAST(p_size * 1013 + p_partkey % 997 AS VARCHAR) AS cheapest_price,
         CASE WHEN p_size % 2 = 0 THEN NULL ELSE 'addr ' || CAST(p_partkey AS VARCHAR) END AS address,
         CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name || ' / ' || p_type END AS description,
         CASE WHEN p_size % 4 = 0 THEN []::VARCHAR[] ELSE [p_type, p_brand] END AS property_highlights,
         CASE WHEN p_size % 5 = 0 THEN []::VARCHAR[] ELSE ['img/' || CAST(p_partkey AS VARCHAR)] END AS images
  FROM part)"""

# needle = lower(clean_homename(outside part or whole name)), as DuckDB SQL over a column
def needle_sql(col: str) -> str:
    pat = "'^(.*?)\\((.*?)\\)$'"
    base = (f"CASE WHEN regexp_matches({col}, {pat}) "
            f"THEN trim(regexp_extract({col}, {pat}, 1)) ELSE {col} END")
    return f"lower(trim(regexp_replace({base}, '(Phone|sđt).*', '', 'g')))"


# --- rooms ----------------------------------------------------------------------------

# Fixed test words appended to room types: English keyword, Vietnamese variant,
# case variant and words without any keyword.
ROOM_WORDS = ["deluxe room", "phòng đôi", "standard", "family room", "Balcony", "suite", "phòng tập thể", "classic"]


def rooms_from_part(spark: SparkSession, sf_dir: str, by_brand: bool = False) -> DataFrame:
    p = spread(read_table(spark, sf_dir, "part"))
    k, size = F.col("p_partkey"), F.col("p_size")
    words = F.array(*[F.lit(w) for w in ROOM_WORDS])
    home = F.col("p_brand") if by_brand else F.concat(F.lit("H"), (k.cast("bigint") / 24).cast("bigint").cast("string"))
    return p.select(
        home.alias("home"),
        (k % 3 + 1).cast("int").alias("source"), k.alias("id"), k.alias("seq"),
        F.concat_ws(" ", "p_name", F.element_at(words, (size % len(ROOM_WORDS) + 1).cast("int"))).alias("roomtype"),
        F.when(size % 5 == 0, F.lit(None).cast("array<string>"))
         .otherwise(F.slice(F.array(F.col("p_type"), F.col("p_brand"), F.split("p_name", " ")[0]), 1, (size % 3 + 1).cast("int")))
         .alias("facilities"),
        F.when(k % 3 == 0, F.array(F.concat(F.lit("photo/"), k.cast("string")))).alias("photos"),
        F.array(F.struct((size % 4 + 1).cast("int").alias("occupancy"),
                         (k * 50000 + 300000).cast("string").alias("price"))).alias("availables"),
    )


def _words_sql() -> str:
    return "[" + ", ".join("'" + w + "'" for w in ROOM_WORDS) + "]"


def rooms_cte(by_brand: bool = False) -> str:
    home = "p_brand" if by_brand else "'H' || CAST(p_partkey // 24 AS VARCHAR)"
    return f"""rooms AS (
  SELECT {home} AS home, CAST(p_partkey % 3 + 1 AS INTEGER) AS source,
         p_partkey AS id, p_partkey AS seq,
         p_name || ' ' || {_words_sql()}[p_size % {len(ROOM_WORDS)} + 1] AS roomtype,
         CASE WHEN p_size % 5 = 0 THEN NULL
              ELSE [p_type, p_brand, string_split(p_name, ' ')[1]][1:(p_size % 3 + 1)] END AS facilities,
         CASE WHEN p_partkey % 3 = 0 THEN ['photo/' || CAST(p_partkey AS VARCHAR)] END AS photos,
         CAST(p_size % 4 + 1 AS VARCHAR) || ':' || CAST(p_partkey * 50000 + 300000 AS VARCHAR) AS availables
  FROM part)"""


# --- rooms and reviews of named homes (bounded per home: lineitem rows of one part) -----------

def home_rows_from_lineitem(spark: SparkSession, sf_dir: str, block: int | None = None) -> DataFrame:
    """Rows that belong to a named home: every lineitem row of a part belongs to the
    home (source, name) of that part. kind = 'room' for the first two line numbers."""
    li = read_table(spark, sf_dir, "lineitem")
    k = F.col("p_partkey")
    name = F.col("p_name") if block is None else F.concat_ws(" ", "p_name", F.floor(k / block).cast("string"))
    p = read_table(spark, sf_dir, "part").select(
        "p_partkey", name.alias("homename"), (_brand_no(F.col("p_brand")) % 3 + 1).alias("source"))
    j = li.join(p, li["l_partkey"] == p["p_partkey"])
    words = F.array(*[F.lit(w) for w in ROOM_WORDS])
    rid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return j.select(
        rid.alias("id"), rid.alias("seq"), "source", "homename",
        F.when(F.col("l_linenumber") <= 2, F.lit("room")).otherwise(F.lit("review")).alias("kind"),
        F.concat_ws(" ", F.element_at(words, (F.col("l_orderkey") % len(ROOM_WORDS) + 1).cast("int")),
                    F.col("l_returnflag")).alias("roomtype"),
        F.col("l_quantity").alias("score"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit(None).cast("array<string>"))
         .otherwise(F.array(F.col("l_returnflag"), F.col("l_linestatus"))).alias("facilities"),
        F.lit(None).cast("array<string>").alias("photos"),
        F.array(F.struct((F.col("l_orderkey") % 4 + 1).cast("int").alias("occupancy"),
                         F.round("l_extendedprice").cast("bigint").cast("string").alias("price"))).alias("availables"))


def home_rows_cte(block: int | None = None) -> str:
    name = "p_name" if block is None else f"p_name || ' ' || CAST(p_partkey // {block} AS VARCHAR)"
    return f"""hrows AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey * 10 + l_linenumber AS seq,
         CAST(substr(p_brand, 7) AS INTEGER) % 3 + 1 AS source, {name} AS homename,
         CASE WHEN l_linenumber <= 2 THEN 'room' ELSE 'review' END AS kind, l_quantity AS score,
         {_words_sql()}[l_orderkey % {len(ROOM_WORDS)} + 1] || ' ' || l_returnflag AS roomtype,
         CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE [l_returnflag, l_linestatus] END AS facilities,
         NULL::VARCHAR[] AS photos,
         CAST(l_orderkey % 4 + 1 AS VARCHAR) || ':' || CAST(CAST(round(l_extendedprice) AS BIGINT) AS VARCHAR) AS availables
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
