"""Session helpers.

Nothing here changes how a cluster is configured: settings are only filled in
where the session leaves them unset (local runs and tests).
"""

from __future__ import annotations

import os
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of an unreferenced checkpoint are removed, not left in the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "innsight", driver_memory: str = "16g") -> SparkSession:
    """Session for local runs, tests and the bench."""
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.driver.memory", driver_memory)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` names a shared folder and is used as is. Only in a
    local session that leaves it unset (tests, the bench) a folder below the
    session's warehouse is taken; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints-{sc.applicationId}"
        spark.conf.set("spark.checkpoint.dir", d)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a scratch table and read it back.

    Cuts the lineage: a lost executor replays nothing before this point, and
    every later reader sees the same rows in the same files.
    """
    path = scratch_path(df.sparkSession, name)
    if getattr(_freeing, "open", None):
        _freeing.open[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Per thread: the scratch tables written inside each open :func:`freed` block.
_freeing = threading.local()


@contextmanager
def freed(spark: SparkSession):
    """A step whose disk is given back at its end: the scratch tables written inside it and the shuffle files of its jobs.

    Yields ``keep(table)``: the table written last outlives the step (it goes to the enclosing one, if any). No other frame
    read from a table of the step may be used afterwards. Spark drops shuffle files once the driver's JVM has collected
    the plans that wrote them, which a driver with memory left does every half hour only; so it is asked to.
    """
    stack = _freeing.open = getattr(_freeing, "open", None) or []
    stack.append([])

    def keep(table: DataFrame) -> DataFrame:
        path = stack[-1].pop()
        if len(stack) > 1:
            stack[-2].append(path)
        return table

    try:
        yield keep
    finally:
        for path in stack.pop():
            _delete(spark, path)
        spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def task_count(spark: SparkSession) -> int:
    """Tasks for work that is heavy by row: three a core, and no more than a shuffle has, since each sets up its expressions for itself."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scanned frame evenly to :func:`task_count` tasks, unless it has as many splits already.

    A file of one row group is one task, however many rows it holds.
    """
    n = task_count(df.sparkSession)
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def drop_scratch(spark: SparkSession) -> None:
    """Remove the scratch tables this application wrote; no frame read from them may be used afterwards."""
    _delete(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}")
