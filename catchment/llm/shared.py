"""Files and tables in the shared folder (``spark.checkpoint.dir``).

Task-written files get a name of their own per attempt and count only once the
job that lists them has ended, so a lost executor or a second attempt of a task
leaves at most an unused file behind.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, stored_dir

# Bytes of an Arrow batch from which on no row is added to it.
BATCH_BYTES = 4 << 20


def new_folder(spark: SparkSession, kind: str) -> str:
    """The name of an unused folder below the shared one (not yet made)."""
    return f"{stored_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def open_folder(url: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URL or of a plain path."""
    return pafs.FileSystem.from_uri(url) if "://" in url else (pafs.LocalFileSystem(), url.removeprefix("file:"))


def write_file(folder: str, name: str, parts: list[bytes]) -> str:
    """Write a file under a name no other attempt uses; return its URL."""
    fs, path = open_folder(folder)
    fs.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex[:12]}"
    with fs.open_output_stream(f"{path}/{name}") as out:
        for p in parts:
            out.write(p)
    return f"{folder}/{name}"


def map_file(url: str) -> np.ndarray:
    """A file's bytes: memory-mapped where the shared folder is mounted, else
    read through its file system."""
    fs, path = open_folder(url)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r") if fs.get_file_info(path).size else np.empty(0, np.uint8)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), np.uint8)


def by_position(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns named ``c0, c1, ...``, whatever names they had
    (also names that an operator uses itself, or the same name twice), and
    these names. ``toDF(*docs.columns)`` gives the old names back."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names


def attach_groups(rows: DataFrame, keys: list[str], aggregates: dict, number: str | None = None) -> DataFrame:
    """``rows`` with aggregates of the rows that share their keys, where at
    least two do (else null), and ``_n``, their number (else 1). ``number``
    names a further column, a number that no other group has.

    The aggregate is summed up before its shuffle and stored; the rows then
    meet it in a merge join of two plain shuffles, which Spark splits at hot
    keys (adaptive skew join)."""
    groups = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in aggregates.items()]).where(F.col("_n") > 1)
    groups = materialize(groups.withColumn(number, F.monotonically_increasing_id()) if number else groups, few=True)
    joined = rows.alias("r").join(groups.hint("merge").alias("g"), [F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys], "left")
    return joined.select("r.*", F.coalesce("g._n", F.lit(1).cast("long")).alias("_n"), *[f"g.{n}" for n in [*aggregates, *([number] if number else [])]])


def numbered(rows: DataFrame, groups: list[str], order: list, name: str, per_bucket: int = 4_000) -> DataFrame:
    """``rows`` (a stored table) with ``name``: their number from 0 within
    their groups, by hashed order of ``order``. A group of any size is dealt
    over buckets by the hash; bucket sizes are summed up to offsets and only
    the rows of a bucket are sorted together."""
    h = F.xxhash64(*order)
    total = rows.count()
    buckets = max(1, -(-total // per_bucket))
    rows = rows.withColumn("_h", h).withColumn("_b", F.pmod(F.shiftrightunsigned("_h", 20), F.lit(buckets)))
    from pyspark.sql import Window

    w = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        rows.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_s", F.coalesce(F.sum("_c").over(w), F.lit(0))).drop("_c"),
        few=True,
    )
    keys = [*groups, "_b"]
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("_h", *order)) - F.lit(1)
    placed = rows.withColumn("_k", at)
    joined = placed.alias("r").join(starts.alias("s"), [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    return joined.select("r.*", (F.col("s._s") + F.col("r._k")).cast("long").alias(name)).drop("_h", "_b", "_k")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that tasks hand to Python by ``BATCH_BYTES``, where
    the session allows larger ones. With texts the default (10,000 rows or 64 MB)
    takes some 34 MB in each Python worker and up to twice that in its task."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    allowed = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < allowed <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``, as
    ``--py-files`` would, once per application; and bound their batches."""
    import os
    import tempfile
    import zipfile

    bound_batches(spark)
    sc = spark.sparkContext
    if getattr(sc, "_catchment_shipped", None) == sc.applicationId:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="catchment-pyfiles-"), "catchment.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)  # Spark hands it to every executor
    sc._catchment_shipped = sc.applicationId
