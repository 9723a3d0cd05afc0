"""Session helpers: a local session for tests and benches, the shared folder
for lineage cuts, and a broadcast hint that is only given behind a size check.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound for a side that may be broadcast (bytes, optimizer estimate).
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# Bytes of stored tables read for each task of those put together.
FEW_BYTES = 2 * 1024 * 1024
# From so many tasks on (also where a table's size is not known) none are put together.
MANY_TASKS = 1 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("catchment")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CATCHMENT_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a folder every executor can reach; it is
    read, never replaced, and a cluster session without it is an error. Only
    a local session without it (tests) gets a folder of our own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        sc = None
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: name a folder every executor can reach "
                "(a machine-local temporary folder would not survive the loss of an executor)"
            )
        path = tempfile.mkdtemp(prefix="catchment-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
        if sc is not None:
            sc.setCheckpointDir(path)
    elif sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (Parquet footers, row counts), or None."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - plan API unavailable (e.g. Connect)
        return None


def checked_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the estimated size is known and bounded.

    Above the bound (or when unknown) the frame is returned as is: the planner
    picks a shuffle join, and AQE may still switch to a broadcast at run time
    from the real size of the shuffled side.
    """
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def input_tasks(*tables: DataFrame, bytes_per_task: int = 4 * 1024 * 1024, least: int | None = None) -> int:
    """Into how many tasks to deal rows that a step makes many more of than it
    shuffles: by the stored size of ``tables`` (their files, as compressed), at
    least one for each core (or ``least``)."""
    size = 0
    for df in tables:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        size += sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(least or tables[0].sparkSession.sparkContext.defaultParallelism, -(-size // bytes_per_task))


def stored_dir(spark: SparkSession) -> str:
    """The folder of this application's stored tables below the shared one."""
    return f"{shared_dir(spark)}/catchment-tables/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, few: bool = False) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder
    and continue from the written table: one computation (a plain
    ``checkpoint()`` computes its input twice unless it is also persisted),
    lineage cut, and it survives the loss of executors. Used where an
    operator reads the same intermediate several times, so that the plan
    above it is neither re-run nor re-planned per reader.

    ``few``, for a last step that is light for each of its rows: partitions are
    put together (no shuffle) to one for each core or 2 MB of the stored tables
    read, whichever are more. A session with many shuffle partitions else writes
    as many tiny files, and on a mounted folder without Hadoop's native library
    each file costs its executor some three started processes (``chmod``)."""
    import uuid

    spark = df.sparkSession
    if few and (tasks := input_tasks(df, bytes_per_task=FEW_BYTES)) < MANY_TASKS:
        df = df.coalesce(tasks)
    path = f"{stored_dir(spark)}/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    """Delete every table that :func:`materialize` has written in this
    application (other applications that share the folder keep theirs). Only when
    no DataFrame that reads one is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(stored_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
