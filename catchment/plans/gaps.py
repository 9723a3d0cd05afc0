"""Analysis inputs with gaps, derived from the roles of :mod:`.roles`: blocks
without a zone, areas without a share or with a share of 0, a zone that reaches
no destination, an unclassified zone, zones left out by their id, co-located
destinations, points without valid coordinates, and a very large zone among
small ones. ``SQL_*`` is the same derivation for the oracle, under the CTE names
of the input it replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import roles

# Which driver rows have which gap.
NO_ZONE_SEGMENT = "MACHINERY"      # blocks without a zone
MIN_SHARE = 18.0                   # areas below have no share at all
NO_AREA_ZONE, ZERO_SHARE_ZONE = 7, 9
UNREACHABLE_ZONE = 11
UNCLASSIFIED_ZONE = 12
CLEAN_EXCLUDE, CLASS_EXCLUDE = (13,), (14,)
WIDE_ZONE_ID = 99
WIDE_ZONE = [(0.1, 0.1), (4.9, 0.2), (2.6, 2.5), (4.7, 4.9), (0.2, 4.6), (1.1, 2.4)]  # in grid cells


def block_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = roles.table(spark, sf_dir, "customer")
    zone = F.when(F.col("c_mktsegment") != NO_ZONE_SEGMENT, F.col("c_nationkey"))
    return c.select(F.col("c_custkey").alias("block_id"), zone.alias("zone_id"))


SQL_LOOKUP = f"""lookup AS (
  SELECT c_custkey AS block_id, CASE WHEN c_mktsegment <> '{NO_ZONE_SEGMENT}' THEN c_nationkey END AS zone_id FROM customer
)"""


def block_pops(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = roles.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("block_id"), "c_nationkey")
    area = F.when(F.col("c_nationkey") == ZERO_SHARE_ZONE, F.lit("none")).when(
        F.col("c_nationkey") != NO_AREA_ZONE, F.col("area_id"))
    return roles.block_pops(spark, sf_dir).join(c, "block_id").select("block_id", "pop", area.alias("area_id"))


SQL_POPS = f"""pops AS (
  SELECT c_custkey AS block_id, CAST(floor(greatest(c_acctbal, 0.0::DOUBLE)) AS DOUBLE) AS pop,
         CASE WHEN c_nationkey = {ZERO_SHARE_ZONE} THEN 'none'
              WHEN c_nationkey <> {NO_AREA_ZONE} THEN substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 1, 6) END AS area_id
  FROM customer
)"""


def area_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = spark.createDataFrame([("none", roles.SUB_ATTRIBUTE, 0.0)], "area_id string, attribute_id string, value double")
    known = roles.area_attributes(spark, sf_dir)
    return known.where(F.col("value") >= MIN_SHARE).unionByName(zero)


SQL_SHARES = f"""shares AS (
  SELECT area_id, value / 100.0::DOUBLE AS share FROM area_attr
  WHERE attribute_id = '{roles.SUB_ATTRIBUTE}' AND value >= {MIN_SHARE}::DOUBLE
  UNION ALL SELECT 'none', 0.0::DOUBLE
)"""


def od_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The OD table without the rows of one zone's blocks."""
    c = roles.table(spark, sf_dir, "customer").where(F.col("c_nationkey") != UNREACHABLE_ZONE)
    keep = c.select(F.col("c_custkey").alias("block_id"))
    tasks = roles.origin_tasks(spark, sf_dir, keep)  # the means then need no other exchange
    return roles.od_table(spark, sf_dir, tasks).join(keep.repartition(tasks, "block_id").hint("merge"), "block_id", "left_semi")


SQL_OD_POP = f"""od_pop AS (
  SELECT od.block_id, od.dest_id, od.mode, p.population, od.distance, od.time
  FROM od JOIN dest ON od.dest_id = dest.dest_id
  CROSS JOIN (VALUES ('all'), ('sub')) p(population)
  WHERE dest.in_scope AND (p.population = 'all' OR dest.sub)
    AND od.block_id IN (SELECT c_custkey FROM customer WHERE c_nationkey <> {UNREACHABLE_ZONE})
)"""


def zone_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.zone_classes(spark, sf_dir).where(F.col("zone_id") != UNCLASSIFIED_ZONE)


SQL_CLASSES = f"""classes AS (
  SELECT n_nationkey AS zone_id, n_name AS name, r_name AS zone_class
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey NOT IN ({UNCLASSIFIED_ZONE}, {CLASS_EXCLUDE[0]})
)"""


def dest_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All destinations at three addresses."""
    s = roles.table(spark, sf_dir, "supplier")
    lon = F.lit(roles.BOX_LON0) + (F.col("s_suppkey") % 3).cast("double") * F.lit(0.4)
    return s.select(F.col("s_suppkey").alias("dest_id"), lon.alias("lon"), F.lit(roles.BOX_LAT0 + 0.25).alias("lat"))


SQL_DEST_POINTS = f"""dpts AS (
  SELECT s_suppkey AS dest_id, {roles.BOX_LON0}::DOUBLE + CAST(s_suppkey % 3 AS DOUBLE) * 0.4::DOUBLE AS lon,
         {roles.BOX_LAT0 + 0.25!r}::DOUBLE AS lat
  FROM supplier
)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of which two segments have no valid longitude."""
    seg = roles.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("point_id"), "c_mktsegment")
    lon = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(float("nan"))).when(
        F.col("c_mktsegment") != "FURNITURE", F.col("lon"))
    return roles.points(spark, sf_dir).join(seg, "point_id").select("point_id", lon.alias("lon"), "lat")


SQL_POINTS = roles.sql_points("pts_every") + """,
pts AS (
  SELECT p.* FROM pts_every p JOIN customer c ON p.point_id = c.c_custkey
  WHERE c.c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')
)"""


def _wide_vertices() -> list[tuple[int, float, float]]:
    ring = [*WIDE_ZONE, WIDE_ZONE[0]]
    return [(i, roles.BOX_LON0 + u * roles.CELL_W, roles.BOX_LAT0 + v * roles.CELL_H) for i, (u, v) in enumerate(ring)]


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones and one that reaches across nearly all of them."""
    known = roles.zones(spark, sf_dir)
    rings = [[{"x": x, "y": y} for _, x, y in _wide_vertices()]]
    return known.unionByName(spark.createDataFrame([(WIDE_ZONE_ID, "wide", "", [rings[0]])], known.schema))


SQL_VERTICES = roles.SQL_VERTICES.replace("vertices AS (", "grid_vertices AS (") + """,
vertices AS (
  SELECT * FROM grid_vertices
  UNION ALL SELECT * FROM (VALUES
    """ + ",\n    ".join(f"({WIDE_ZONE_ID}, 0, {i}, {x!r}::DOUBLE, {y!r}::DOUBLE)" for i, x, y in _wide_vertices()) + """
  ) w(zone_id, ring, seq, x, y)
)"""
