"""Roles of the driver tables: each function reads the given parquet tables and
derives one input of the analysis, and ``SQL_*`` is the same derivation for
the DuckDB oracle (views named like the tables). Both sides spell the same
arithmetic in the same order, with explicit doubles, so that they produce the
same values.

| Role                       | Derived from                                   |
| -------------------------- | ---------------------------------------------- |
| OD table (2 modes)         | lineitem JOIN orders: origin o_custkey, dest l_suppkey |
| destinations + flags       | supplier: in scope s_acctbal >= 0, sub >= 5500  |
| block population, area     | customer: floor(max(c_acctbal, 0)), custkey prefix |
| area attributes (long)     | customer: percent of each market segment per area |
| block -> zone lookup       | customer: c_custkey -> c_nationkey              |
| zone names, zone classes   | nation, region                                  |
| zone attributes (long)     | events JOIN customer, per nation and city-wide  |
| zone outlines              | nation + fixed shape templates on a 5 x 5 grid  |
| points (all / sub)         | customer location rule; sub = BUILDING segment  |
| street network             | orders: customers of successive orders of a day, priority and status are neighbours |
"""

from __future__ import annotations

import math
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checked_broadcast, input_tasks

# Fixed values of the role mapping.
MODES = ("auto", "pedestrian")
SUB_ATTRIBUTE = "BUILDING"          # area attribute that is the sub-population share
IN_SCOPE_MIN_BALANCE = 0.0         # destination in scope
SUB_MIN_BALANCE = 5500.0           # destination serves the sub-population
TOTAL_ZONE_ID = -1                 # city-wide row of the zone attributes / counts
TOTAL_NAME = "Total"
POP_ATTRIBUTE = "purchase"         # zone population attribute
SUB_ONLY_ATTRIBUTE = "pct_error"   # percent sub-population only
SUB_EXTRA_ATTRIBUTE = "pct_click"  # percent sub-population, second group
BOX_LON0, BOX_LAT0 = -76.5, 45.0   # south-west corner of the zone grid
CELL_W, CELL_H = 0.3, 0.1          # zone grid cell size in degrees
GRID_COLS = 5
BOX_CORNERS = ((-76.3, 45.05), (-75.2, 45.05), (-75.2, 45.35), (-76.0, 45.45), (-76.3, 45.05))  # a zone over most of the grid
PLANE_LON0, PLANE_LAT0 = -75.75, 45.25  # origin of the local metre plane
TOLERANCE_M = 50.0
EARTH_RADIUS_M = 6371008.8

# Shape templates in unit cell coordinates: (shape, ring, seq, u, v); ring 0 is
# the outline, ring 1 a hole. Shape = the nation's region key.
SHAPES = [
    # 0: full cell (neighbours share edges)
    (0, 0, 0, 0.0, 0.0), (0, 0, 1, 1.0, 0.0), (0, 0, 2, 1.0, 1.0), (0, 0, 3, 0.0, 1.0), (0, 0, 4, 0.0, 0.0),
    # 1: L shape (concave)
    (1, 0, 0, 0.0, 0.0), (1, 0, 1, 1.0, 0.0), (1, 0, 2, 1.0, 0.5), (1, 0, 3, 0.5, 0.5),
    (1, 0, 4, 0.5, 1.0), (1, 0, 5, 0.0, 1.0), (1, 0, 6, 0.0, 0.0),
    # 2: full cell with a square hole
    (2, 0, 0, 0.0, 0.0), (2, 0, 1, 1.0, 0.0), (2, 0, 2, 1.0, 1.0), (2, 0, 3, 0.0, 1.0), (2, 0, 4, 0.0, 0.0),
    (2, 1, 0, 0.25, 0.25), (2, 1, 1, 0.25, 0.75), (2, 1, 2, 0.75, 0.75), (2, 1, 3, 0.75, 0.25), (2, 1, 4, 0.25, 0.25),
    # 3: diamond
    (3, 0, 0, 0.5, 0.0), (3, 0, 1, 1.0, 0.5), (3, 0, 2, 0.5, 1.0), (3, 0, 3, 0.0, 0.5), (3, 0, 4, 0.5, 0.0),
    # 4: tiny square in the middle (usually no point inside)
    (4, 0, 0, 0.49, 0.49), (4, 0, 1, 0.51, 0.49), (4, 0, 2, 0.51, 0.51), (4, 0, 3, 0.49, 0.51), (4, 0, 4, 0.49, 0.49),
]

DEG = math.pi / 180.0
KX = EARTH_RADIUS_M * math.cos(PLANE_LAT0 * DEG) * DEG   # metres per degree of longitude
KY = EARTH_RADIUS_M * DEG                                # metres per degree of latitude


_TABLES: WeakKeyDictionary[SparkSession, dict[tuple[str, str], DataFrame]] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table ``name`` (one scan definition per session, so the
    file listing and footer read happen once)."""
    known, key = _TABLES.setdefault(spark, {}), (sf_dir.rstrip("/"), name)
    df = known.get(key)
    if df is None:
        df = known[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df


def _d(x: float):
    return F.lit(float(x))


# --------------------------------------------------------------------- OD
def od_table(spark: SparkSession, sf_dir: str, origin_tasks: int | None = None) -> DataFrame:
    """block_id, dest_id, mode, distance (km), time (s): one row per line item
    and mode. With ``origin_tasks`` the rows are dealt by origin into so many tasks,
    before there is a row per mode: what ranks an origin's rows then needs no other
    exchange, whose tasks would be as many as the session says."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_discount", "l_quantity", "l_tax"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # A join of two fact tables: shuffled on the order key at any scale (never
    # a broadcast, whatever the statistics of a small test file say).
    # In tasks by the tables' size: a line item becomes up to eight rows of the
    # nearest-k means before they are sorted, which its shuffled size says nothing of.
    tasks = input_tasks(li, orders)
    li, orders = li.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    joined = li.join(orders.hint("merge"), li["l_orderkey"] == orders["o_orderkey"])
    if origin_tasks:
        joined = joined.drop("l_orderkey", "o_orderkey").repartition(origin_tasks, "o_custkey")
    auto = F.struct(
        F.lit("auto").alias("mode"),
        (F.col("l_extendedprice") / _d(1000.0)).alias("distance"),
        (F.col("l_quantity") * _d(60.0)).alias("time"),
    )
    walk = F.struct(
        F.lit("pedestrian").alias("mode"),
        (F.col("l_extendedprice") * (_d(1.0) - F.col("l_discount")) / _d(1000.0)).alias("distance"),
        (F.col("l_quantity") * _d(600.0) * (_d(1.0) + F.col("l_tax"))).alias("time"),
    )
    return joined.select(
        F.col("o_custkey").alias("block_id"), F.col("l_suppkey").alias("dest_id"),
        F.inline(F.array(auto, walk)),
    )


def origin_tasks(spark: SparkSession, sf_dir: str, *more: DataFrame, least: int | None = None) -> int:
    """Into how many tasks to deal the OD rows by origin: by the stored size of the
    tables they come from, and of ``more``."""
    return input_tasks(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), *more, least=least)


def od_to_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`od_table` for the nearest-k means. The limit on the map side leaves
    their exchange up to ``k`` rows per origin and measure of every task, and it
    has as many tasks as the session says. Where the tables need more than that, the
    rows are dealt by origin in as many as needed, and no other exchange follows."""
    tasks = origin_tasks(spark, sf_dir, least=1)
    few = int(spark.conf.get("spark.sql.shuffle.partitions")) < tasks
    return od_table(spark, sf_dir, tasks if few else None)


SQL_OD = """od AS (
  SELECT o.o_custkey AS block_id, l.l_suppkey AS dest_id, m.mode,
         CASE WHEN m.mode = 'auto' THEN l.l_extendedprice / 1000.0::DOUBLE
              ELSE l.l_extendedprice * (1.0::DOUBLE - l.l_discount) / 1000.0::DOUBLE END AS distance,
         CASE WHEN m.mode = 'auto' THEN l.l_quantity * 60.0::DOUBLE
              ELSE l.l_quantity * 600.0::DOUBLE * (1.0::DOUBLE + l.l_tax) END AS time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  CROSS JOIN (VALUES ('auto'), ('pedestrian')) m(mode)
)"""


def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dest_id, in_scope, sub."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("dest_id"),
        (F.col("s_acctbal") >= _d(IN_SCOPE_MIN_BALANCE)).alias("in_scope"),
        (F.col("s_acctbal") >= _d(SUB_MIN_BALANCE)).alias("sub"),
    )


SQL_DEST = f"""dest AS (
  SELECT s_suppkey AS dest_id, s_acctbal >= {IN_SCOPE_MIN_BALANCE}::DOUBLE AS in_scope,
         s_acctbal >= {SUB_MIN_BALANCE}::DOUBLE AS sub
  FROM supplier
)"""


SQL_OD_POP = """od_pop AS (
  SELECT od.block_id, od.dest_id, od.mode, p.population, od.distance, od.time
  FROM od JOIN dest ON od.dest_id = dest.dest_id
  CROSS JOIN (VALUES ('all'), ('sub')) p(population)
  WHERE dest.in_scope AND (p.population = 'all' OR dest.sub)
)"""


# ------------------------------------------------------------- blocks, areas
def block_pops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """block_id, pop, area_id."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("block_id"),
        F.floor(F.greatest(F.col("c_acctbal"), _d(0.0))).cast("double").alias("pop"),
        F.substring(F.lpad(F.col("c_custkey").cast("string"), 8, "0"), 1, 6).alias("area_id"),
    )


SQL_POPS = """pops AS (
  SELECT c_custkey AS block_id, CAST(floor(greatest(c_acctbal, 0.0::DOUBLE)) AS DOUBLE) AS pop,
         substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 1, 6) AS area_id
  FROM customer
)"""


def area_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long area table: area_id, attribute_id (market segment), value (percent
    of the area's blocks in that segment)."""
    c = table(spark, sf_dir, "customer").select(
        F.substring(F.lpad(F.col("c_custkey").cast("string"), 8, "0"), 1, 6).alias("area_id"), "c_mktsegment"
    )
    counts = c.groupBy("area_id", F.col("c_mktsegment").alias("attribute_id")).count()
    total = F.sum("count").over(Window.partitionBy("area_id"))
    return counts.select(
        "area_id", "attribute_id", (_d(100.0) * F.col("count") / total).alias("value")
    )


SQL_AREA_ATTR = """area_attr AS (
  SELECT area_id, attribute_id,
         100.0::DOUBLE * n / sum(n) OVER (PARTITION BY area_id) AS value
  FROM (SELECT substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 1, 6) AS area_id,
               c_mktsegment AS attribute_id, count(*) AS n
        FROM customer GROUP BY 1, 2) t
)"""

SQL_SHARES = f"""shares AS (
  SELECT area_id, value / 100.0::DOUBLE AS share FROM area_attr WHERE attribute_id = '{SUB_ATTRIBUTE}'
)"""


def block_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """block_id, zone_id."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("block_id"), F.col("c_nationkey").alias("zone_id"))


SQL_LOOKUP = """lookup AS (SELECT c_custkey AS block_id, c_nationkey AS zone_id FROM customer)"""


# ------------------------------------------------------------------ zones
def zone_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zone_id, name, name_alt (blank for one region, as second names can be)."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("name"),
        F.when(F.col("n_regionkey") == 3, F.lit("")).otherwise(F.lower("n_name")).alias("name_alt"),
    )


SQL_NAMES = """names AS (
  SELECT n_nationkey AS zone_id, n_name AS name,
         CASE WHEN n_regionkey = 3 THEN '' ELSE lower(n_name) END AS name_alt
  FROM nation
)"""


def zone_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zone_id, name, zone_class."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(checked_broadcast(r), n["n_regionkey"] == r["r_regionkey"], "left").select(
        F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("name"), F.col("r_name").alias("zone_class")
    )


SQL_CLASSES = """classes AS (
  SELECT n_nationkey AS zone_id, n_name AS name, r_name AS zone_class
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""


def zone_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long zone table: zone_id (text, as in census extracts), attribute,
    value. Per nation and city-wide (``TOTAL_ZONE_ID``): the rounded sum of
    event values per type, and the percent of events of each type
    (``pct_<type>``)."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey"))
    joined = ev.join(cust, "user_id")
    g = (
        joined.groupingSets([["c_nationkey", "event_type"], ["event_type"]], "c_nationkey", "event_type")
        .agg(F.round(F.sum("value"), 2).alias("total"), F.count("*").alias("n"),
             F.grouping("c_nationkey").alias("_g"))
    )
    zone = F.when(F.col("_g") == 1, F.lit(TOTAL_ZONE_ID)).otherwise(F.col("c_nationkey")).cast("string")
    g = g.select(zone.alias("zone_id"), "event_type", "total", "n")
    g = g.withColumn("share", _d(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy("zone_id")))
    return g.select(
        "zone_id",
        F.inline(F.array(
            F.struct(F.col("event_type").alias("attribute"), F.col("total").alias("value")),
            F.struct(F.concat(F.lit("pct_"), F.col("event_type")).alias("attribute"), F.col("share").alias("value")),
        )),
    )


SQL_ZONE_ATTR = f"""zone_attr_base AS (
  SELECT CAST(CASE WHEN grouping(c.c_nationkey) = 1 THEN {TOTAL_ZONE_ID} ELSE c.c_nationkey END AS VARCHAR) AS zone_id,
         e.event_type, round(sum(e.value), 2) AS total, count(*) AS n
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  GROUP BY GROUPING SETS ((c.c_nationkey, e.event_type), (e.event_type))
),
zone_attr AS (
  SELECT zone_id, event_type AS attribute, total AS value FROM zone_attr_base
  UNION ALL
  SELECT zone_id, 'pct_' || event_type AS attribute,
         100.0::DOUBLE * n / sum(n) OVER (PARTITION BY zone_id) AS value
  FROM zone_attr_base
)"""


def _shape_templates(spark: SparkSession) -> DataFrame:
    schema = "shape int, ring int, seq int, u double, v double"
    return spark.createDataFrame(SHAPES, schema)


def zone_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zone_id, ring, seq, x (lon), y (lat): the outline vertices of each zone."""
    n = table(spark, sf_dir, "nation")
    col = F.col("n_nationkey") % GRID_COLS
    row = F.floor(F.col("n_nationkey") / GRID_COLS)
    t = _shape_templates(spark)
    j = n.join(F.broadcast(t), n["n_regionkey"] == t["shape"])
    return j.select(
        F.col("n_nationkey").alias("zone_id"), "ring", "seq",
        (_d(BOX_LON0) + (col.cast("double") + F.col("u")) * _d(CELL_W)).alias("x"),
        (_d(BOX_LAT0) + (row.cast("double") + F.col("v")) * _d(CELL_H)).alias("y"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zone_id, name, name_alt, rings: array<array<struct<x,y>>> (lon/lat)."""
    v = zone_vertices(spark, sf_dir)
    ring = v.groupBy("zone_id", "ring").agg(
        F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("_pts")
    ).select("zone_id", "ring", F.transform("_pts", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("pts"))
    rings = ring.groupBy("zone_id").agg(F.sort_array(F.collect_list(F.struct("ring", "pts"))).alias("_r")).select(
        "zone_id", F.transform("_r", lambda r: r["pts"]).alias("rings")
    )
    return zone_names(spark, sf_dir).join(rings, "zone_id", "inner")


_SHAPE_VALUES = ",\n    ".join(f"({s}, {r}, {q}, {u!r}::DOUBLE, {v!r}::DOUBLE)" for s, r, q, u, v in SHAPES)

SQL_VERTICES = f"""shapes(shape, ring, seq, u, v) AS (
  VALUES
    {_SHAPE_VALUES}
),
vertices AS (
  SELECT n.n_nationkey AS zone_id, s.ring, s.seq,
         {BOX_LON0}::DOUBLE + (CAST(n.n_nationkey % {GRID_COLS} AS DOUBLE) + s.u) * {CELL_W}::DOUBLE AS x,
         {BOX_LAT0}::DOUBLE + (CAST(floor(n.n_nationkey / {GRID_COLS}) AS DOUBLE) + s.v) * {CELL_H}::DOUBLE AS y
  FROM nation n JOIN shapes s ON n.n_regionkey = s.shape
)"""


# ----------------------------------------------------------------- streets
# Metres per second of a street by its order's key; walking speed.
AUTO_SPEEDS = (8.0, 12.0, 16.0)
WALK_SPEED = 1.4


def streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mode, from_node, to_node, distance (m), time (s), whole numbers: a
    street joins the customers of two successive orders of a day, priority and
    status. Orders of status P make one-way streets for cars, urgent ones are
    closed to pedestrians."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    w = Window.partitionBy("o_orderdate", "o_orderpriority", "o_orderstatus").orderBy("o_orderkey")
    s = o.withColumn("b", F.lead("o_custkey").over(w)).where("b is not null and b <> o_custkey")
    length = (_d(100.0) + (F.floor("o_totalprice") % 5000).cast("double"))
    speed = F.element_at(F.array(*[_d(v) for v in AUTO_SPEEDS]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    s = s.select(F.col("o_custkey").alias("a"), "b", "o_orderstatus", "o_orderpriority", length.alias("distance"), speed.alias("speed"))

    def way(mode: str, start: str, end: str, open_, speed_) -> list:
        return F.when(open_, F.struct(F.lit(mode).alias("mode"), F.col(start).alias("from_node"), F.col(end).alias("to_node"),
                                      "distance", F.ceil(F.col("distance") / speed_).cast("double").alias("time")))

    two_way, walk = F.col("o_orderstatus") != "P", F.col("o_orderpriority") != "1-URGENT"
    ways = F.array(way("auto", "a", "b", F.lit(True), F.col("speed")), way("auto", "b", "a", two_way, F.col("speed")),
                   way("pedestrian", "a", "b", walk, _d(WALK_SPEED)), way("pedestrian", "b", "a", walk, _d(WALK_SPEED)))
    return s.select(F.inline(F.filter(ways, lambda x: x.isNotNull())))


SQL_STREETS = f"""streets AS (
  SELECT m.mode, CASE WHEN m.back THEN b ELSE a END AS from_node, CASE WHEN m.back THEN a ELSE b END AS to_node, distance,
         CASE WHEN m.mode = 'auto' THEN ceil(distance / speed) ELSE ceil(distance / {WALK_SPEED}::DOUBLE) END AS time
  FROM (
    SELECT o_custkey AS a, lead(o_custkey) OVER (PARTITION BY o_orderdate, o_orderpriority, o_orderstatus ORDER BY o_orderkey) AS b,
           o_orderstatus, o_orderpriority, 100.0::DOUBLE + CAST(CAST(floor(o_totalprice) AS BIGINT) % 5000 AS DOUBLE) AS distance,
           CASE o_orderkey % 3 WHEN 0 THEN {AUTO_SPEEDS[0]}::DOUBLE WHEN 1 THEN {AUTO_SPEEDS[1]}::DOUBLE ELSE {AUTO_SPEEDS[2]}::DOUBLE END AS speed
    FROM orders) s
  CROSS JOIN (VALUES ('auto', false), ('auto', true), ('pedestrian', false), ('pedestrian', true)) m(mode, back)
  WHERE b IS NOT NULL AND a <> b
    AND CASE WHEN m.mode = 'auto' THEN NOT m.back OR o_orderstatus <> 'P' ELSE o_orderpriority <> '1-URGENT' END
)"""


# ------------------------------------------------------------------ points
def points(spark: SparkSession, sf_dir: str, sub_only: bool = False) -> DataFrame:
    """point_id, lon, lat: one point per customer (placed by a fixed rule);
    the sub-population points are those of the BUILDING segment."""
    c = table(spark, sf_dir, "customer")
    if sub_only:
        c = c.where(F.col("c_mktsegment") == F.lit(SUB_ATTRIBUTE))
    return c.select(
        F.col("c_custkey").alias("point_id"),
        (_d(BOX_LON0) + ((F.col("c_custkey") * 7919) % 1500).cast("double") / _d(1000.0)).alias("lon"),
        (_d(BOX_LAT0) + ((F.col("c_custkey") * 104729) % 500).cast("double") / _d(1000.0)).alias("lat"),
    )


def block_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """block_id, lon, lat: origin locations (the customer location rule)."""
    return points(spark, sf_dir).withColumnRenamed("point_id", "block_id")


def dest_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dest_id, lon, lat: destination locations (the same rule on the supplier
    key), in-scope destinations only."""
    s = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= _d(IN_SCOPE_MIN_BALANCE))
    return s.select(
        F.col("s_suppkey").alias("dest_id"),
        (_d(BOX_LON0) + ((F.col("s_suppkey") * 7919) % 1500).cast("double") / _d(1000.0)).alias("lon"),
        (_d(BOX_LAT0) + ((F.col("s_suppkey") * 104729) % 500).cast("double") / _d(1000.0)).alias("lat"),
    )


SQL_DEST_POINTS = f"""dpts AS (
  SELECT s_suppkey AS dest_id,
         {BOX_LON0}::DOUBLE + CAST((s_suppkey * 7919) % 1500 AS DOUBLE) / 1000.0::DOUBLE AS lon,
         {BOX_LAT0}::DOUBLE + CAST((s_suppkey * 104729) % 500 AS DOUBLE) / 1000.0::DOUBLE AS lat
  FROM supplier WHERE s_acctbal >= {IN_SCOPE_MIN_BALANCE}::DOUBLE
)"""


def town_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dest_id, lon, lat: nine of ten destinations in a town of a few hundred
    metres, the others over the whole box."""
    far = F.col("dest_id") % 10 == 0
    return dest_points(spark, sf_dir).select(
        "dest_id",
        F.when(far, F.col("lon")).otherwise(_d(BOX_LON0 + 1.0) + (F.col("lon") - _d(BOX_LON0)) / _d(500.0)).alias("lon"),
        F.when(far, F.col("lat")).otherwise(_d(BOX_LAT0 + 0.1) + (F.col("lat") - _d(BOX_LAT0)) / _d(500.0)).alias("lat"))


SQL_TOWN_POINTS = SQL_DEST_POINTS.replace("dpts AS", "wide AS", 1) + f""",
dpts AS (
  SELECT dest_id, CASE WHEN dest_id % 10 = 0 THEN lon ELSE ({BOX_LON0 + 1.0!r})::DOUBLE + (lon - {BOX_LON0}::DOUBLE) / 500.0::DOUBLE END AS lon,
         CASE WHEN dest_id % 10 = 0 THEN lat ELSE ({BOX_LAT0 + 0.1!r})::DOUBLE + (lat - {BOX_LAT0}::DOUBLE) / 500.0::DOUBLE END AS lat
  FROM wide
)"""


def points_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """point_id, lon, lat, population: every point as 'all', and once more as
    'sub' when it is in the sub-population."""
    c = table(spark, sf_dir, "customer")
    pops = F.array(F.lit("all"), F.when(F.col("c_mktsegment") == F.lit(SUB_ATTRIBUTE), F.lit("sub")))
    return c.select(
        F.col("c_custkey").alias("point_id"),
        (_d(BOX_LON0) + ((F.col("c_custkey") * 7919) % 1500).cast("double") / _d(1000.0)).alias("lon"),
        (_d(BOX_LAT0) + ((F.col("c_custkey") * 104729) % 500).cast("double") / _d(1000.0)).alias("lat"),
        F.explode(pops).alias("population"),
    ).where(F.col("population").isNotNull())


def sql_points(name: str = "pts", sub_only: bool = False) -> str:
    where = f" WHERE c_mktsegment = '{SUB_ATTRIBUTE}'" if sub_only else ""
    return f"""{name} AS (
  SELECT c_custkey AS point_id,
         {BOX_LON0}::DOUBLE + CAST((c_custkey * 7919) % 1500 AS DOUBLE) / 1000.0::DOUBLE AS lon,
         {BOX_LAT0}::DOUBLE + CAST((c_custkey * 104729) % 500 AS DOUBLE) / 1000.0::DOUBLE AS lat
  FROM customer{where}
)"""
