"""Writers. Large tables go to Parquet; the zone-sized published tables may
go to CSV with a header and ``NA`` for missing values, as the analysis
publishes them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


# As the analysis publishes: a header, NA for missing values, quotes doubled.
CSV = {"header": True, "nullValue": "NA", "escape": '"'}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = "NA") -> DataFrame:
    """Write ``df`` as CSV and pass it on (a tee), so a chain can continue."""
    df.write.mode(mode).options(**CSV | {"nullValue": null_value}).csv(path)
    return df


def _partition_writer(df: DataFrame, by: str, mode: str, replace: str):
    if by not in df.columns:
        raise ValueError(f"column {by!r} is required: it names the output partitions")
    if replace not in ("given", "all"):
        raise ValueError(f"replace is 'given' or 'all', not {replace!r}")
    kind = "dynamic" if replace == "given" else "static"
    return df.write.mode(mode).partitionBy(by).option("partitionOverwriteMode", kind)


def drop_partitions(spark: SparkSession, path: str, by: str, values: Sequence) -> None:
    """Remove the outputs of some values of the partition column."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for v in values:
        at = hadoop.Path(path, f"{by}={'__HIVE_DEFAULT_PARTITION__' if v is None else escape(str(v))}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_partitioned(
    df: DataFrame, path: str, by: str = "mode", fmt: str = "parquet", mode: str = "overwrite",
    replace: str = "given", expect: Sequence | None = None,
) -> DataFrame:
    """One output per travel mode, as a partitioned directory (``by=...``
    sub-folders, pruned on read). The partition column must exist.

    Overwriting replaces the outputs of the values that ``df`` holds and leaves
    the others (``replace="given"``: they are written aside and put in place when
    the job commits, so a failed job changes nothing), or the whole directory
    (``replace="all"``). ``expect`` names the values that this call is about: the
    old output of one that ``df`` has no row of goes as well."""
    w = _partition_writer(df, by, mode, replace)
    if fmt == "csv":
        w.options(**CSV).csv(path)
    else:
        w.parquet(path)
    if expect is not None and mode == "overwrite":
        # one row per output value comes back; the values are the caller's own short list
        held = {r[0] for r in df.select(by).distinct().collect()}
        drop_partitions(df.sparkSession, path, by, [v for v in expect if v not in held])
    return df


def write_od_buckets(od: DataFrame, path: str, buckets: int, mode: str = "overwrite") -> DataFrame:
    """The OD table dealt into ``buckets`` by ``block_id``, below ``path``: read
    by :func:`..files.read_od_buckets`, nearest-k and every other grouping by
    origin needs no further exchange. ``buckets`` is about the OD's bytes by 128 MiB."""
    import uuid

    spark, name = od.sparkSession, f"od_{uuid.uuid4().hex}"
    cols = [f.name for f in schemas.OD_CSV.fields]
    # dealt as the buckets are, so that a task writes one file per mode
    od.select(*cols).repartition(buckets, "block_id").write.mode(mode).partitionBy("mode").bucketBy(buckets, "block_id").sortBy(
        "block_id").option("path", path).saveAsTable(name)
    kind = od.schema["block_id"].dataType.simpleString(), od.schema["dest_id"].dataType.simpleString()
    spark.createDataFrame([(buckets, *kind)], "buckets int, block_id string, dest_id string").coalesce(1).write.mode("overwrite").json(
        f"{path.rstrip('/')}/_layout")
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table names an outside path
    return od


def write_table_file(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """A published table (a few rows) as a single CSV file. Only for tables
    whose size is bounded by the number of groups; never for block-level
    data."""
    # a shuffle before the one writing task, so that the stages above keep theirs
    df.repartition(1).write.mode(mode).options(**CSV).csv(path)
    return df


def ordered(df: DataFrame, order: list[tuple[str, bool]]) -> DataFrame:
    """Sort for publication: ``order`` is a list of (column, descending);
    missing values go last either way. Only at a sink: sorting inside a plan
    buys nothing."""
    from pyspark.sql import functions as F

    return df.orderBy(*[F.desc_nulls_last(c) if desc else F.asc_nulls_last(c) for c, desc in order])


def write_published(
    df: DataFrame, path: str, order: list[tuple[str, bool]] | None = None, by: str | None = None,
    mode: str = "overwrite", replace: str = "given",
) -> DataFrame:
    """A zone-sized published table: sorted (``order``), one CSV file, or one
    per value of ``by`` (e.g. per travel mode), header and ``NA``. With ``by``,
    overwriting leaves the values that ``df`` does not hold (``replace="all"``
    removes them too)."""
    from pyspark.sql import functions as F

    if by is None:
        sort = [F.desc_nulls_last(c) if desc else F.asc_nulls_last(c) for c, desc in (order or [])]
        one = df.repartition(1)
        (one.sortWithinPartitions(*sort) if sort else one).write.mode(mode).options(**CSV).csv(path)
        return df
    # Each value's rows meet in one task, sorted by the partition column first,
    # then the publication order: the writer finds the order it needs.
    keys = [F.asc(by)] + [F.desc_nulls_last(c) if desc else F.asc_nulls_last(c) for c, desc in (order or [])]
    if by not in df.columns:
        raise ValueError(f"column {by!r} is required: it names the output partitions")
    dealt = df.repartition(F.col(by)).sortWithinPartitions(*keys)
    _partition_writer(dealt, by, mode, replace).options(**CSV).csv(path)
    return df
