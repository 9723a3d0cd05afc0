"""Points in zones with a tolerance buffer, and zone point counts.

Join strategy: a grid cuts the plane into cells (cell size ~ the median zone
extent); every point falls in exactly one cell. Each (zone, cell) keeps only
the edges that touch the cell or come within the tolerance of it, and one bit:
whether the cell's reference point lies inside the zone. A point is inside when
the path from it to the reference point, which stays in the cell, crosses the
cell's edges an even number of times (reference inside) or an odd one (outside).
So an edge is kept only where it passes, however wide the zone is. A cell no edge
comes near has one status for all its points: inside (kept without a test) or
outside (not listed); such cells are listed as large as they can be, doubling in
size from level to level (a quadtree), so that the number of a zone's cells
follows the length of its outline, not its area. Candidate (point, zone) pairs come from an equi-join on the
cell of every level in use; only points in cells with edges are tested, against those few edges. A
point may match several zones when their buffers overlap; a (point, zone) pair
is found once, because a zone's cells do not overlap.

The zone-cell table is broadcast only when its counted cells and edges are small;
then a dense cell (a third of all points in one downtown cell) costs no shuffle.
Otherwise the join is shuffled, and AQE's skew handling splits the hot cell.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import buffer_rings, close_rings, near_any, path_parity, ring_edges, rings_bbox, valid_lonlat
from ..functions.projection import LocalPlane, Plane, map_points
from ..session import DEFAULT_BROADCAST_BYTES, materialize


def zone_origin(zones: DataFrame) -> tuple[float, float]:
    """Centre of all zones' bounding boxes (one small aggregate)."""
    bb = zones.select(rings_bbox(F.col("rings")).alias("b")).agg(
        F.min("b.min_x").alias("a"), F.min("b.min_y").alias("b"),
        F.max("b.max_x").alias("c"), F.max("b.max_y").alias("d"),
    ).first()
    return ((bb["a"] + bb["c"]) / 2.0, (bb["b"] + bb["d"]) / 2.0)


def zones_on_plane(zones: DataFrame, plane: Plane | tuple[float, float]) -> DataFrame:
    """zone_id, rings_m (closed rings in metres), bbox in metres. A (lon, lat)
    pair stands for the local plane around it."""
    plane = LocalPlane(plane) if isinstance(plane, tuple) else plane
    z = zones.select("zone_id", map_points(close_rings(F.col("rings")), plane.forward).alias("rings_m"))
    return z.withColumn("bbox", rings_bbox(F.col("rings_m")))


def median_extent(zones_m: DataFrame) -> float:
    """Median of the zones' larger bounding-box side, in metres."""
    ext = F.greatest(F.col("bbox.max_x") - F.col("bbox.min_x"), F.col("bbox.max_y") - F.col("bbox.min_y"))
    v = zones_m.agg(F.percentile_approx(ext, 0.5).alias("m")).first()["m"]
    return float(v) if v else 1000.0


# Where a cell's reference point lies in it, as a share of the cell's side: no
# simple fraction, so that outlines on round coordinates do not pass through it.
REFERENCE = 0.6180339887
# Bytes of a listed cell and of an edge in it, for the broadcast check.
CELL_BYTES, EDGE_BYTES = 96, 48


def zone_cell_edges(zones_m: DataFrame, cell_m: float, tolerance_m: float) -> DataFrame:
    """level, cx, cy, zone_id, ref_in, edges: the cells of each zone that hold a
    point of its tolerance buffer, whether the cell's reference point is inside,
    and the edges that touch the cell or come within the tolerance of it (none
    for cells wholly inside). A cell of level l has a side of ``cell_m * 2 ** l``;
    cells with edges are of level 0.

    An edge is clipped to every row of cells it comes near and names the cells
    along that piece. Those cells and all above them are open; the quarters of
    an open cell that are not open themselves have one status. The status of a
    reference point is the parity of the edges that cross its row's reference
    line on its left.
    """
    cs, tol = F.lit(float(cell_m)), F.lit(float(tolerance_m) + 1e-6)  # slack for rounding at cell borders
    widest = F.greatest(F.col("bbox.max_x") - F.col("bbox.min_x"), F.col("bbox.max_y") - F.col("bbox.min_y")) + 2 * tol
    top = F.greatest(F.ceil(F.log2(widest / cs)).cast("int") + 1, F.lit(0))  # no cell of this level is wholly inside
    edges = zones_m.select("zone_id", top.alias("top"), F.explode(ring_edges(F.col("rings_m"))).alias("e"))
    lo_y, hi_y = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    slope = F.try_divide(F.col("e.x2") - F.col("e.x1"), F.col("e.y2") - F.col("e.y1"))  # NULL: horizontal

    def x_at(y):
        return F.col("e.x1") + slope * (y - F.col("e.y1"))

    rows = edges.select("zone_id", "top", "e", F.explode(F.sequence(F.floor((lo_y - tol) / cs), F.floor((hi_y + tol) / cs))).alias("cy"))
    y_from = F.least(F.greatest(lo_y, F.col("cy") * cs - tol), hi_y)
    y_to = F.greatest(F.least(hi_y, (F.col("cy") + 1) * cs + tol), lo_y)
    xa = F.coalesce(x_at(y_from), F.col("e.x1"))
    xb = F.coalesce(x_at(y_to), F.col("e.x2"))
    touched = rows.select("zone_id", "top", "e", "cy", F.explode(F.sequence(
        F.floor((F.least(xa, xb) - tol) / cs), F.floor((F.greatest(xa, xb) + tol) / cs))).alias("cx"))

    row = ["zone_id", "level", "cy"]
    level = F.explode(F.sequence(F.lit(0), F.col("top"))).alias("level")

    def cell(lv: Column, x: Column, y: Column, is_open: bool, e: Column) -> Column:
        return F.struct(lv.alias("level"), x.alias("cx"), y.alias("cy"), F.lit(is_open).alias("open"), e.alias("e"))

    none = F.lit(None).cast(touched.schema["e"].dataType)
    above = touched.select("zone_id", "e", level, F.expr("shiftright(cx, level)").alias("cx"), F.expr("shiftright(cy, level)").alias("cy"))
    quarters = [cell(F.col("level") - 1, F.col("cx") * 2 + i, F.col("cy") * 2 + j, False, none) for i in (0, 1) for j in (0, 1)]
    own = cell(F.col("level"), F.col("cx"), F.col("cy"), True, F.when(F.col("level") == 0, F.col("e")))
    named = F.when(F.col("level") == 0, F.array(own)).otherwise(F.array(own, *quarters))
    listed = above.select("zone_id", F.inline(named)).withColumn("crossed", F.lit(0))

    side = F.pow(F.lit(2.0), F.col("level")) * cs
    ref_y = (F.col("cy") + REFERENCE) * side
    crossings = edges.select("zone_id", "e", level).select(
        "zone_id", "level", "e", F.explode(F.sequence(F.floor(lo_y / side), F.floor(hi_y / side))).alias("cy"),
    ).where((F.col("e.y1") > ref_y) != (F.col("e.y2") > ref_y)).select(
        # the last column whose reference point is left of the crossing
        "zone_id", "level", (F.ceil(x_at(ref_y) / side - REFERENCE) - 1).alias("cx"), "cy", F.lit(1).alias("crossed"))
    # one exchange by row of cells: for the cells, then for the crossings along a row
    placed = listed.unionByName(crossings, allowMissingColumns=True).repartition(*row).groupBy(*row, "cx", "crossed").agg(
        F.collect_list("e").alias("edges"), F.max("open").alias("open"), F.sum("crossed").alias("_n"))
    along = Window.partitionBy(*row).orderBy("cx", "crossed").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("ref_in", F.sum("_n").over(along) % 2 == 1)
    # open cells are listed with their edges at level 0, by their quarters above it
    boundary = (F.col("level") == 0) & F.col("open")
    return placed.where((F.col("crossed") == 0) & (boundary | (~F.col("open") & F.col("ref_in")))).select(
        "zone_id", "level", "cx", "cy", "edges", "ref_in")


def cell_join_side(cells: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, list[int]]:
    """``cells`` with a join hint after their counted size (one zone-sized
    aggregate: the optimizer's estimate does not see how many cells and edges
    the outlines make), and the levels in use."""
    size = cells.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("e"),
                     F.sort_array(F.collect_set("level")).alias("levels")).first()
    small = size["n"] * CELL_BYTES + size["e"] * EDGE_BYTES <= max_bytes
    return F.broadcast(cells) if small else cells.hint("merge"), list(size["levels"])


def points_in_zones(
    points: DataFrame,
    zones: DataFrame,
    tolerance_m: float = 50.0,
    cell_m: float | None = None,
    origin: tuple[float, float] | None = None,
    lon: str = "lon",
    lat: str = "lat",
    plane: Plane | None = None,
) -> DataFrame:
    """Every (point, zone) pair where the point lies inside the zone or within
    ``tolerance_m`` metres of its boundary, on ``plane`` (the local plane around
    ``origin``, by default the middle of the zones, unless another is given; an
    outline's edges are straight there). Output: the point's columns plus
    ``zone_id``. Points without valid coordinates (missing, not finite, out of
    range) match nothing."""
    if plane is None:
        plane = LocalPlane(origin or zone_origin(zones))
    zm = zones_on_plane(zones, plane)
    if cell_m is None:
        cell_m = max(median_extent(zm), 4.0 * tolerance_m)
    if not (cell_m > 0 and math.isfinite(cell_m)):
        raise ValueError("cell_m must be a positive number")
    cells, levels = cell_join_side(materialize(zone_cell_edges(zm, cell_m, tolerance_m)))
    px, py = plane.forward(F.col(lon), F.col(lat))
    cs = F.lit(float(cell_m))
    at_level = F.array(*[F.lit(x) for x in levels]) if levels else F.array().cast("array<int>")
    pts = points.where(valid_lonlat(F.col(lon), F.col(lat))).select(
        *points.columns, px.alias("_px"), py.alias("_py"), F.explode(at_level).alias("level"),
    ).withColumn("_side", F.pow(F.lit(2.0), F.col("level")) * cs).withColumns(
        {"cx": F.floor(F.col("_px") / F.col("_side")), "cy": F.floor(F.col("_py") / F.col("_side"))})
    cand = pts.join(cells, ["level", "cx", "cy"])
    ppx, ppy = F.col("_px"), F.col("_py")
    odd = path_parity(F.col("edges"), ppx, ppy, (F.col("cx") + REFERENCE) * F.col("_side"), (F.col("cy") + REFERENCE) * F.col("_side"))
    hit = cand.where((F.col("ref_in") != odd) | near_any(F.col("edges"), ppx, ppy, tolerance_m))
    return hit.select(*points.columns, "zone_id")


def zone_buffers(zones: DataFrame, distance_m: float = 50.0, plane: Plane | tuple[float, float] | None = None, arc_steps: int = 16) -> DataFrame:
    """Outlines of the zones widened by ``distance_m``: the columns of ``zones``
    with ``rings`` replaced by the widened curves in lon/lat, and ``curves``, the
    same on the plane. They overlap themselves at inward corners: a point is
    inside where they wind around it (``geo.in_buffer``; the rule that drawing
    programs call non-zero)."""
    plane = LocalPlane(plane or zone_origin(zones)) if plane is None or isinstance(plane, tuple) else plane
    rings_m = map_points(close_rings(F.col("rings")), plane.forward)
    wide = zones.withColumn("curves", buffer_rings(rings_m, distance_m, arc_steps))
    return wide.withColumn("rings", map_points(F.col("curves"), plane.inverse)).select(*zones.columns, "curves")


def zone_counts(
    pairs: DataFrame,
    zones: DataFrame,
    points: DataFrame | None = None,
    count_col: str = "n",
    total_id: int | None = 0,
    total_name: str = "Total",
    total_alt: str | None = None,
    keys: tuple[str, ...] = ("zone_id", "name", "name_alt"),
    by: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Points per zone, with every zone present (0 where none) and, when
    ``points`` is given and ``total_id`` is not None, a total row holding the
    number of points (not the sum of zone counts: a point in two buffers is
    counted in both zones).

    ``by`` counts several point sets in one pass, e.g. ``{"population":
    ["all", "sub"]}`` when the points carry a ``population`` column: every zone
    is listed once per value (a fixed fan-out)."""
    by = dict(by or {})
    counts = pairs.groupBy("zone_id", *by).agg(F.count("*").alias(count_col))
    z = zones.select(*keys)
    for col, vals in by.items():
        z = z.withColumn(col, F.explode(F.array(*[F.lit(v) for v in vals])))
    full = z.join(counts, ["zone_id", *by], "full").select(
        *keys, *by, F.coalesce(F.col(count_col), F.lit(0)).cast("long").alias(count_col)
    )
    if points is None or total_id is None:
        return full
    total = points.groupBy(*by).agg(F.count("*").cast("long").alias(count_col))
    if by:
        # every listed value gets a total row, 0 when it has no point at all
        listed = points.sparkSession.range(1).select(*[F.explode(F.array(*[F.lit(v) for v in vals])).alias(c)
                                                      for c, vals in list(by.items())[:1]])
        for c, vals in list(by.items())[1:]:
            listed = listed.withColumn(c, F.explode(F.array(*[F.lit(v) for v in vals])))
        total = listed.join(total, list(by), "left").withColumn(
            count_col, F.coalesce(F.col(count_col), F.lit(0).cast("long")))
    total = total.select(
        F.lit(total_id).cast(zones.schema["zone_id"].dataType).alias("zone_id"),
        F.lit(total_name).alias(keys[1]),
        F.lit(total_alt if total_alt is not None else total_name).alias(keys[2]),
        *by, count_col,
    )
    return full.unionByName(total)
