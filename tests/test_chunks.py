"""Running numbers and nesting in chunks."""

from pyspark.sql import functions as F

from innsight.operators.numbering import running_number
from innsight.operators.resolve import nest_in_chunks


def test_numbers_of_a_hot_group(spark):
    n = 20_000
    df = spark.range(n).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 3 == 0, F.concat(F.lit("g"), F.col("id") % 30)).alias("g"),
                               (F.col("id") * 7919 % 1000).alias("o"), "id")
    df = df.unionByName(spark.createDataFrame([(None, None, 1), (None, 5, 2), ("hot", None, 3), ("hot", None, 3)], "g string, o long, id long"))
    got = running_number(df.repartition(7), ["g"], [F.col("o"), F.col("id")], "n").collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append(r)
    assert sum(map(len, by.values())) == n + 4
    for rows in by.values():
        rows.sort(key=lambda r: r["n"])
        assert [r["n"] for r in rows] == list(range(len(rows)))
        keys = [(r["o"] is not None, r["o"] or 0, r["id"]) for r in rows]
        assert keys == sorted(keys)
    assert running_number(df.where("false"), ["g"], [F.col("o")]).count() == 0


def test_no_chunk_holds_more_than_its_size(spark):
    rows = spark.range(5_000).select(F.lit("hot").alias("home"), F.when(F.col("id") % 5 == 0, 2).otherwise(1).alias("source"),
                                     (F.col("id") * 31 % 5000).alias("seq"), F.col("id").alias("review_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or small tables would become one task
    try:
        got = nest_in_chunks(rows, ["home"], size=64).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tasks = len({r["task"] for r in got})
    assert tasks > 1 and len(got) == 63 + 16 and max(len(r["rows"]) for r in got) == 64
    for source in (1, 2):
        chunks = sorted((r["chunk"], [x["review_id"] for x in r["rows"]]) for r in got if r["source"] == source)
        ids = [i for _, c in chunks for i in c]
        assert [c for c, _ in chunks] == list(range(len(chunks))) and all(len(c) == 64 for _, c in chunks[:-1])
        assert ids == sorted((i for i in range(5000) if (2 if i % 5 == 0 else 1) == source), key=lambda i: i * 31 % 5000)
