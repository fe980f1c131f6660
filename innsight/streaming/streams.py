"""Structured Streaming forms of the incremental operators.

R1: review pages arrive in any order, each with its home, the home's announced
total and the number of reviews on the page; a home is released when its sum
reaches the total, at once if no total is announced.
R2: new reviews are enriched statelessly and upserted by key.

All run with ``trigger(availableNow=True)``. The caller names the checkpoint
and output folders: a later call with the same two goes on where the last one
stopped (only new files are read, state is kept), also after a crash. Sinks
overwrite one folder per micro-batch, so a replayed batch writes the same rows
again, and readers take one row per key. Without folders given, a run is a
one-off below the session's scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.operators import incremental as I
from innsight.operators import reviews as RV
from innsight.session import scratch_path, written

# Files read per micro-batch: large enough that a backlog is a few big batches,
# small enough that one batch's state update and commit stay bounded.
MAX_FILES_PER_TRIGGER = 1000


def _batch_sink(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def _read_sink(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows that any batch wrote, with the ``batch`` they came in; none if no batch has been written yet."""
    schema = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _folders(spark: SparkSession, name: str, out_dir: str | None, checkpoint_dir: str | None) -> tuple[str, str]:
    if (out_dir is None) != (checkpoint_dir is None):
        raise ValueError("give both folders, or none for a one-off run")
    return out_dir or scratch_path(spark, name), checkpoint_dir or scratch_path(spark, f"{name}-ckpt")


def _once(rows: DataFrame, key: str, announced: str) -> DataFrame:
    """One row per released home, whatever was replayed or reached the total again with an empty page."""
    return rows.groupBy(key).agg(F.min(announced).alias(announced), F.min("arrived").alias("arrived"))


def stream_complete_homes(spark: SparkSession, pages_dir: str, schema: T.StructType, key: str = "home",
                          announced: str = "announced", n: str = "n_reviews", max_files: int = MAX_FILES_PER_TRIGGER,
                          out_dir: str | None = None, checkpoint_dir: str | None = None) -> DataFrame:
    """R1 as a streaming aggregate: (key, announced, arrived) of every home released so far, once each.

    The state is one running sum per home. Homes without an announced total
    are released with their first page and carry a NULL ``arrived``. A page of
    no reviews after the release (P4 produces one at multiples of the page
    size) releases nothing anew. Use the expiring form where homes that never complete must not stay in the state.
    """
    out, ckpt = _folders(spark, "released", out_dir, checkpoint_dir)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(pages_dir)
    total, arrived = F.col(announced), F.col("arrived")
    agg = src.groupBy(key).agg(F.max(announced).cast("bigint").alias(announced), F.sum(n).cast("bigint").alias("arrived"))
    released = agg.where(total.isNull() | (arrived == total)).withColumn("arrived", F.when(total.isNotNull(), arrived))
    q = (released.writeStream.outputMode("update").option("checkpointLocation", ckpt)
         .foreachBatch(_batch_sink(out)).trigger(availableNow=True).start())
    q.awaitTermination()
    shape = T.StructType([schema[key], T.StructField(announced, T.LongType()), T.StructField("arrived", T.LongType())])
    return _once(_read_sink(spark, out, shape), key, announced)


def stream_complete_homes_expiring(spark: SparkSession, pages_dir: str, schema: T.StructType, key: str = "home",
                                   announced: str = "announced", n: str = "n_reviews", max_files: int = MAX_FILES_PER_TRIGGER,
                                   idle_timeout_ms: int = 3_600_000, out_dir: str | None = None,
                                   checkpoint_dir: str | None = None) -> DataFrame:
    """R1 with bounded state: the released homes, those of the plain form.

    One value state (arrived, announced, timer) per home in flight, in a RocksDB state store and so not bound by memory; it is
    removed on release. A home that no page reached for ``idle_timeout_ms`` (processing time) leaves
    the state when its timer fires, and a row with the count reached goes to the same sink (see
    :func:`expired_homes`); its later pages count anew.
    """
    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    made = _expiring_rows(schema, key, announced)
    made_row = Row(*made.names)

    class Homes(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.home = handle.getValueState("home", T.StructType([T.StructField(n, T.LongType()) for n in ("arrived", "announced", "timer")]))

        def handleInputRows(self, key, rows, timerValues):
            arrived, total, timer = self.home.get() if self.home.exists() else (0, None, None)
            for r in rows:
                arrived += r[2] or 0
                if r[1] is not None:
                    total = r[1] if total is None else max(total, r[1])
            if timer is not None:
                self.handle.deleteTimer(timer)
            if total is None or arrived == total:
                self.home.clear()
                yield made_row(key[0], total, None if total is None else arrived, False)
            else:
                timer = timerValues.getCurrentProcessingTimeInMs() + int(idle_timeout_ms)
                self.handle.registerTimer(timer)
                self.home.update((arrived, total, timer))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            arrived, total, _ = self.home.get()
            self.home.clear()
            yield made_row(key[0], total, arrived, True)

        def close(self):
            pass

    out, ckpt = _folders(spark, "released-ttl", out_dir, checkpoint_dir)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(pages_dir)
    rel = src.select(key, F.col(announced).cast("long"), F.col(n).cast("long")).groupBy(key).transformWithState(
        Homes(), made, "append", "processingTime")
    # Pending timers make a query run no-data batches forever, so an
    # availableNow run would not end; this query runs without them (the
    # streaming query snapshots the session conf at start) and timers fire
    # with the next batch that carries data.
    confs = {"spark.sql.streaming.noDataMicroBatches.enabled": "false",
             "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        q = (rel.writeStream.outputMode("append").option("checkpointLocation", ckpt)
             .foreachBatch(_batch_sink(out)).trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    return _once(_read_sink(spark, out, made).where("not expired"), key, announced)


def _expiring_rows(schema: T.StructType, key: str, announced: str) -> T.StructType:
    return T.StructType([T.StructField(key, schema[key].dataType), T.StructField(announced, T.LongType()),
                         T.StructField("arrived", T.LongType()), T.StructField("expired", T.BooleanType())])


def expired_homes(spark: SparkSession, out_dir: str, schema: T.StructType, key: str = "home", announced: str = "announced") -> DataFrame:
    """(key, announced, arrived, batch) of homes that left the state of the expiring form incomplete, from its sink."""
    rows = _read_sink(spark, out_dir, _expiring_rows(schema, key, announced)).where("expired")
    return rows.groupBy(key, "batch").agg(F.max(announced).alias(announced), F.max("arrived").alias("arrived")).select(
        key, announced, "arrived", "batch")


def _enriched_batches(spark: SparkSession, reviews_dir: str, schema: T.StructType, key: str, enrich_kwargs: dict, cols,
                      max_files: int, out: str, ckpt: str) -> None:
    """Enrich every file not yet read; one folder per micro-batch, one row per key (of rows with one key, the greatest)."""
    kwargs = dict(enrich_kwargs)
    for name, index in (("lexicon", RV.lexicon_index), ("translations", RV.translation_index)):
        if isinstance(kwargs.get(name), DataFrame):
            kwargs[name] = written(index(kwargs[name]), name)
    if isinstance(kwargs.get("lemmas"), DataFrame):
        kwargs["lemmas"] = written(RV.token_index(kwargs["lemmas"], kwargs["lexicon"]), "tokens")
    kwargs["topics"] = RV.topic_lists(kwargs["topics"])
    if isinstance(kwargs.get("topic_labels"), DataFrame):
        kwargs["topic_labels"] = written(kwargs["topic_labels"], "labels")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(reviews_dir)
    rest = [c for c in src.columns if c != key]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        one = batch.groupBy(key).agg(F.max(F.struct(*rest)).alias("_r")).select(key, "_r.*")
        I.enrich_reviews(one, key, **kwargs).select(key, *cols).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = src.writeStream.option("checkpointLocation", ckpt).foreachBatch(per_batch).trigger(availableNow=True).start()
    q.awaitTermination()


def _enriched_shape(schema: T.StructType, key: str, cols) -> T.StructType:
    return T.StructType([schema[key], *[T.StructField(c, T.StringType()) for c in cols]])


def stream_enrich_reviews(spark: SparkSession, reviews_dir: str, schema: T.StructType, base: DataFrame, key: str,
                          enrich_kwargs: dict, cols=("sentiment", "label"), max_files: int = MAX_FILES_PER_TRIGGER,
                          out_dir: str | None = None, checkpoint_dir: str | None = None) -> DataFrame:
    """R2: enrich every new review file and upsert (key) the result into the frame ``base``.

    Parameter tables (lexicon, lemmas, translations, labels) are brought into
    the form that joins need once, before the stream starts. Each micro-batch
    writes its enriched rows to its own folder; the upsert (S5) takes the latest batch per key of all batches ever written.
    Use :func:`stream_enrich_stored` where the base is a table that calls go on updating.
    """
    out, ckpt = _folders(spark, "enriched", out_dir, checkpoint_dir)
    _enriched_batches(spark, reviews_dir, schema, key, enrich_kwargs, cols, max_files, out, ckpt)
    return I.keyed_upsert(base, _read_sink(spark, out, _enriched_shape(schema, key, cols)), key, list(cols), order="batch")


def new_batches(spark: SparkSession, out_dir: str, after: int) -> list[int]:
    """Numbers of the batch folders of a sink above ``after``, ascending."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(b for b in (int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")) if b > after)


def stream_enrich_stored(spark: SparkSession, reviews_dir: str, schema: T.StructType, base_path: str, key: str,
                         enrich_kwargs: dict, cols=("sentiment", "label"), max_files: int = MAX_FILES_PER_TRIGGER,
                         out_dir: str | None = None, checkpoint_dir: str | None = None) -> list[int]:
    """R2 into a stored table (:func:`I.store_bucketed`): enrich every new review file and merge only batches not merged yet.

    The table logs the last batch merged into it. A call reads the batch folders above that number and rewrites only
    the buckets their keys are in, so its cost follows the new rows and not the history. A call cut off between the merge
    and the log merges the same batches again, which changes no row. Returns the batches merged by this call.
    """
    out, ckpt = _folders(spark, "enriched", out_dir, checkpoint_dir)
    _enriched_batches(spark, reviews_dir, schema, key, enrich_kwargs, cols, max_files, out, ckpt)
    batches = new_batches(spark, out, I.last_applied(spark, base_path))
    if batches:
        shape = T.StructType([*_enriched_shape(schema, key, cols).fields, T.StructField("batch", T.LongType())])
        rows = spark.read.schema(shape).option("basePath", out).parquet(*[f"{out}/batch={b}" for b in batches])
        I.upsert_stored(spark, base_path, rows, key, list(cols), order="batch")
        I.log_applied(spark, base_path, batches[-1])
    return batches
