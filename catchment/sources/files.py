"""Readers for the analysis inputs.

Every reader takes an explicit schema (no inference pass over large files).
CSV columns are read as text and converted with Spark expressions: numbers
the lenient way (grouping marks dropped, text without a number -> NULL),
booleans from the usual spellings, ``NA`` and empty fields -> NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import lenient_number, prefix
from .. import schemas

_TRUE = ["true", "t", "yes", "y", "1"]
_FALSE = ["false", "f", "no", "n", "0"]


def lenient_bool(col: Column) -> Column:
    v = F.lower(F.trim(col))
    return F.when(v.isin(_TRUE), F.lit(True)).when(v.isin(_FALSE), F.lit(False))


def _convert(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.BooleanType):
        return lenient_bool(col)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return lenient_number(col).try_cast(dtype)
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType)):
        num = lenient_number(col)
        return F.when(num == F.floor(num), num.try_cast(dtype))
    return col.try_cast(dtype)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rename: Mapping[str, str] | None = None,
    header: bool = True,
    null_value: str = "NA",
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """Typed CSV scan. ``schema`` names the columns as they appear in the
    header, in any order and among others; a missing column is an error.
    ``aliases`` maps a schema name to another header name that is taken when
    the first is absent; ``rename`` maps schema names to ours. Without a header
    the columns are taken by position. Conversion never raises: a value that
    does not parse becomes NULL (:func:`read_csv_checked` lists these)."""
    raw, names = _scan(spark, path, schema, header, null_value, aliases)
    return _typed(raw, schema, names, rename)


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rename: Mapping[str, str] | None = None,
    header: bool = True,
    null_value: str = "NA",
    aliases: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """:func:`read_csv` and what it could not convert: ``file, row, column,
    text``, one row per value that is there but has become NULL (``column`` by
    its name in ``schema``), and one per line that has another number of fields
    than the header (``column`` NULL, ``text`` the line). ``row`` is the line's
    fields by name as JSON. Both come from one definition of the scan; a line
    with failures is in the typed table as well."""
    raw, names = _scan(spark, path, schema, header, null_value, aliases, lines=True)
    found = []
    for f in schema.fields:
        text = _filled(names[f.name])
        bad = text.isNotNull() & _convert(text, f.dataType).isNull()
        found.append(F.when(bad, F.struct(F.lit(f.name).alias("column"), text.alias("text"))))
    found.append(F.when(F.col(_LINE).isNotNull(), F.struct(F.lit(None).cast("string").alias("column"), F.col(_LINE).alias("text"))))
    fields = [c for c in raw.columns if c != _LINE]
    row = F.to_json(F.struct(*[F.col(_quoted(c)).alias(c.strip().lstrip("\ufeff")) for c in fields]))
    failed = raw.select(F.col("_metadata.file_name").alias("file"), row.alias("row"), F.explode(F.array_compact(F.array(*found))).alias("f"))
    return _typed(raw, schema, names, rename), failed.select("file", "row", "f.column", "f.text")


_LINE = "__line_with_other_fields"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _filled(name: str) -> Column:
    """The text of a field; blank is missing."""
    text = F.col(_quoted(name))
    return F.when(F.trim(text) != F.lit(""), text)


def _scan(spark, path, schema, header, null_value, aliases, lines: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """The file's fields as text (with ``lines``, also every line whose number of
    fields is another one), and the field of each schema name."""
    reader = spark.read.option("nullValue", null_value).option("emptyValue", None).option("mode", "PERMISSIVE").option("escape", '"')
    names = {f.name: f.name for f in schema.fields}
    if header:
        raw = reader.option("header", True).csv(path)  # reads the header line; every column is text
        found = {c.strip().lstrip("\ufeff"): c for c in raw.columns}
        for name in names:
            at = name if name in found else (aliases or {}).get(name)
            if at not in found:
                raise ValueError(f"column {name!r} is not in the header of {path}: {list(found)}")
            names[name] = found[at]
    else:
        raw = reader.schema(T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])).csv(path)
    if lines:
        kept = T.StructType([*raw.schema.fields, T.StructField(_LINE, T.StringType(), True)])
        raw = reader.option("header", header).option("enforceSchema", True).option("columnNameOfCorruptRecord", _LINE).schema(kept).csv(path)
    return raw, names


def _typed(raw: DataFrame, schema: T.StructType, names: dict[str, str], rename: Mapping[str, str] | None) -> DataFrame:
    rename = dict(rename or {})
    return raw.select(*[_convert(_filled(names[f.name]), f.dataType).alias(rename.get(f.name, f.name)) for f in schema.fields])


def read_block_pops(spark: SparkSession, path: str, area_width: int = 8) -> DataFrame:
    """block_id, pop, area_id (the first ``area_width`` characters of the block
    id)."""
    df = read_csv(spark, path, schemas.BLOCK_POPS_CSV, rename={"DBUID": "block_id", "pop": "pop"})
    return df.withColumn("area_id", prefix("block_id", area_width))


def read_area_attributes(spark: SparkSession, path: str) -> DataFrame:
    """area_id, attribute_id, value of the long area table; further columns of
    the file are left out."""
    return read_csv(spark, path, schemas.AREA_ATTRIBUTES_CSV, aliases=schemas.AREA_ATTRIBUTES_ALIASES)


def read_destinations(spark: SparkSession, path: str) -> DataFrame:
    """dest_id, lat, lon, in_scope, sub (file names cpso, lat, lng,
    family_physician, french)."""
    return read_csv(spark, path, schemas.DESTINATIONS_CSV, rename=schemas.DESTINATIONS_RENAME)


def read_block_points(spark: SparkSession, path: str) -> DataFrame:
    """block_id, lon, lat."""
    return read_csv(spark, path, schemas.BLOCK_POINTS_CSV, rename={"DBUID": "block_id"})


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None) -> DataFrame:
    """A small dimension or lookup table (zone classes, zone attributes,
    block -> zone lookup) from CSV or Parquet, by extension unless ``fmt``."""
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt == "csv":
        return read_csv(spark, path, schema)
    df = spark.read.schema(schema).parquet(path)
    return df


def read_od(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """An OD table already computed: block_id, dest_id, mode, distance, time.
    Parquet is the default (a directory partitioned by ``mode`` is read with
    partition pruning on ``mode``); CSV is read typed."""
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt == "csv":
        return read_csv(spark, path, schemas.OD_CSV)
    return spark.read.parquet(path).select("block_id", "dest_id", "mode", "distance", "time")


def read_od_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The OD table that :func:`.sinks.write_od_buckets` wrote below ``path``:
    the scan knows the buckets."""
    import uuid

    path = path.rstrip("/")
    layout = spark.read.schema("buckets int, block_id string, dest_id string").json(f"{path}/_layout").first()
    name = f"od_{uuid.uuid4().hex}"
    quoted = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} (block_id {layout['block_id']}, dest_id {layout['dest_id']}, distance DOUBLE, time DOUBLE, mode STRING) "
        f"USING parquet PARTITIONED BY (mode) CLUSTERED BY (block_id) SORTED BY (block_id) INTO {layout['buckets']} BUCKETS LOCATION '{quoted}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name).select("block_id", "dest_id", "mode", "distance", "time")


_POLY = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def read_zones_geojson(
    spark: SparkSession,
    path: str,
    id_prop: str = "zone_id",
    name_prop: str = "name",
    alt_prop: str = "name_alt",
    feature_per_line: bool = False,
) -> DataFrame:
    """Zone outlines from GeoJSON: zone_id, name, name_alt, rings.

    A FeatureCollection file is one JSON document (one task per file); for
    many zones write one Feature per line and pass ``feature_per_line``.
    Polygon and MultiPolygon geometries are both read; the rings of all parts
    go into one ring list (even-odd tests stay right for disjoint parts).
    """
    props = T.StructType([
        T.StructField(id_prop, T.StringType()), T.StructField(name_prop, T.StringType()),
        T.StructField(alt_prop, T.StringType()),
    ])
    geom = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    feature = T.StructType([T.StructField("properties", props), T.StructField("geometry", geom)])
    if feature_per_line:
        feats = spark.read.schema(feature).json(path)
    else:
        coll = T.StructType([T.StructField("features", T.ArrayType(feature))])
        feats = spark.read.schema(coll).option("multiLine", True).json(path).select(F.explode("features").alias("f")).select("f.*")
    coords = F.col("geometry.coordinates")
    rings = F.when(F.col("geometry.type") == "Polygon", F.from_json(coords, _POLY)).when(
        F.col("geometry.type") == "MultiPolygon", F.flatten(F.from_json(coords, _MULTI))
    )
    to_struct = F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(
        F.element_at(p, 1).alias("x"), F.element_at(p, 2).alias("y"))))
    zid = F.col(f"properties.{id_prop}")
    return feats.select(
        F.when(zid.rlike(r"^\s*[-+]?[0-9]+\s*$"), F.trim(zid).try_cast("int")).alias("zone_id"),
        F.col(f"properties.{name_prop}").alias("name"),
        F.col(f"properties.{alt_prop}").alias("name_alt"),
        to_struct.alias("rings"),
    )


def literal_table(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    """A small literal table (a parameter list written as rows)."""
    return spark.createDataFrame(list(rows), schema)
