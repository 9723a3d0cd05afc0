"""Schemas of the analysis inputs (file layouts) and of our own tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# File layouts (names as in the files).
BLOCK_POPS_CSV = struct(("DBUID", S), ("pop", D))
AREA_ATTRIBUTES_CSV = struct(("area_id", S), ("attribute_id", S), ("value", D))
AREA_ATTRIBUTES_ALIASES = {"area_id": "DAUID", "attribute_id": "TEXT_ID", "value": "T_DATA_DONNEE"}
DESTINATIONS_CSV = struct(("cpso", S), ("lat", D), ("lng", D), ("family_physician", B), ("french", B))
DESTINATIONS_RENAME = {"cpso": "dest_id", "lng": "lon", "family_physician": "in_scope", "french": "sub"}
BLOCK_POINTS_CSV = struct(("DBUID", S), ("lon", D), ("lat", D))
OD_CSV = struct(("block_id", S), ("dest_id", S), ("mode", S), ("distance", D), ("time", D))

# Our tables.
BLOCK_POPS = struct(("block_id", S), ("pop", D), ("area_id", S))
LOOKUP = struct(("block_id", S), ("zone_id", I))
ZONE_NAMES = struct(("zone_id", I), ("name", S), ("name_alt", S))
ZONE_CLASS = struct(("zone_id", I), ("name", S), ("zone_class", S))
ZONE_ATTRIBUTES = struct(("zone_id", S), ("attribute", S), ("value", D))
OD = struct(("block_id", S), ("dest_id", S), ("mode", S), ("distance", D), ("time", D))
POINT = T.StructType([T.StructField("x", D, True), T.StructField("y", D, True)])
RINGS = T.ArrayType(T.ArrayType(POINT))
ZONES = T.StructType(list(ZONE_NAMES.fields) + [T.StructField("rings", RINGS, True)])
CLASS_OUTLINES = struct(("zone_class", S), ("rings", RINGS))
FIGURE_SPEC = struct(("data_table", S), ("fill_column", S), ("fill_label", S), ("filename", S))
