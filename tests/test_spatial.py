import math
import random

import pytest
from pyspark.sql import functions as F

from catchment.functions.geo import plane_scale
from catchment.operators.spatial import cell_join_side, points_in_zones, zone_cell_edges, zone_counts, zones_on_plane
from catchment.schemas import ZONES
from helpers import rows

ORIGIN = (-75.7, 45.4)
KX, KY = plane_scale(ORIGIN[1])


def m2deg(x, y):
    """metres on the plane -> lon/lat."""
    return ORIGIN[0] + x / KX, ORIGIN[1] + y / KY


def ring(*pts, close=True):
    r = [dict(zip("xy", m2deg(x, y))) for x, y in pts]
    return r + ([r[0]] if close else [])


# square 0..1000, adjacent square 1000..2000 sharing an edge, concave L, square with a hole
ZONE_ROWS = [
    (1, "sq", "", [ring((0, 0), (1000, 0), (1000, 1000), (0, 1000))]),
    (2, "adj", "adj2", [ring((1000, 0), (2000, 0), (2000, 1000), (1000, 1000), close=False)]),
    (3, "L", "l", [ring((0, 2000), (1000, 2000), (1000, 2500), (500, 2500), (500, 3000), (0, 3000))]),
    (4, "hole", "h", [ring((3000, 0), (4000, 0), (4000, 1000), (3000, 1000)),
                      ring((3250, 250), (3250, 750), (3750, 750), (3750, 250))]),
    (5, "empty", "e", [ring((9000, 9000), (9010, 9000), (9010, 9010))]),
]


@pytest.fixture()
def zones(spark):
    return spark.createDataFrame(ZONE_ROWS, ZONES)


def pts(spark, xy):
    data = [(i, *m2deg(x, y)) for i, (x, y) in enumerate(xy)]
    return spark.createDataFrame(data, "point_id long, lon double, lat double")


def hits(spark, zones, xy, tol=50.0, cell=None):
    out = points_in_zones(pts(spark, xy), zones, tolerance_m=tol, cell_m=cell, origin=ORIGIN)
    return rows(out.select("point_id", "zone_id"))


def test_inside_edges_tolerance(spark, zones):
    xy = [(500, 500), (1000, 500), (1030, 500), (1100, 500), (-40, 500), (-60, 500),
          (750, 2750), (520, 2600), (3500, 500), (3280, 500), (3200, 500), (5000, 5000)]
    got = hits(spark, zones, xy)
    assert got == sorted([
        (0, 1), (1, 1), (1, 2), (2, 1), (2, 2), (3, 2), (4, 1),  # shared edge + buffers overlap
        (7, 3),                      # inside L near the notch edge (20 m)
        (9, 4), (10, 4),             # in the hole but within 50 m of its edge; outside near the outer edge
    ])
    # (5) 60 m away: outside; (6) in the L's notch: outside; (8) hole centre: outside; (11): nowhere


def test_matches_brute_force_for_any_cell_size(spark, zones):
    rnd = random.Random(11)
    xy = [(rnd.uniform(-200, 4200), rnd.uniform(-200, 3200)) for _ in range(400)]
    ref = hits(spark, zones, xy, cell=300.0)
    for cell in (97.0, 1000.0, 5000.0, None):
        assert hits(spark, zones, xy, cell=cell) == ref
    # brute force in plain Python on the same plane
    def inside(px, py, rings):
        c, d2 = 0, math.inf
        for r in rings:
            for (x1, y1), (x2, y2) in zip(r, r[1:]):
                if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                    c += 1
                dx, dy = x2 - x1, y2 - y1
                t = max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy)))
                d2 = min(d2, (x1 + t * dx - px) ** 2 + (y1 + t * dy - py) ** 2)
        return c % 2 == 1 or d2 <= 2500.0
    exp = []
    for zid, _, _, rings in ZONE_ROWS:
        mr = [[((p["x"] - ORIGIN[0]) * KX, (p["y"] - ORIGIN[1]) * KY) for p in r] for r in rings]
        mr = [r if r[0] == r[-1] else r + [r[0]] for r in mr]
        for i, (x, y) in enumerate(xy):
            lon, lat = m2deg(x, y)
            if inside((lon - ORIGIN[0]) * KX, (lat - ORIGIN[1]) * KY, mr):
                exp.append((i, zid))
    assert ref == sorted(exp)


def test_zone_counts_with_empty_zones_and_total(spark, zones):
    p = pts(spark, [(500, 500), (1000, 500), (5000, 5000)])
    pairs = points_in_zones(p, zones, tolerance_m=50.0, origin=ORIGIN)
    got = rows(zone_counts(pairs, zones, p, total_id=0, total_name="City"))
    assert got == [(0, "City", "City", 3), (1, "sq", "", 2), (2, "adj", "adj2", 1), (3, "L", "l", 0),
                   (4, "hole", "h", 0), (5, "empty", "e", 0)]


def test_many_vertex_outline_matches_brute_force(spark):
    # a 240-vertex wavy ring (concave in many places) and 500 random points
    rnd = random.Random(2)
    ring_m = []
    for i in range(240):
        a = 2 * math.pi * i / 240
        r = 1500 + 300 * math.sin(7 * a)
        ring_m.append((2000 + r * math.cos(a), 2000 + r * math.sin(a)))
    zones = spark.createDataFrame([(9, "wavy", "w", [ring(*ring_m)])], ZONES)
    xy = [(rnd.uniform(0, 4000), rnd.uniform(0, 4000)) for _ in range(500)]
    got = hits(spark, zones, xy, cell=250.0)
    closed = ring_m + [ring_m[0]]

    def inside(px, py):
        c, d2 = 0, math.inf
        for (x1, y1), (x2, y2) in zip(closed, closed[1:]):
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                c += 1
            dx, dy = x2 - x1, y2 - y1
            t = max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy)))
            d2 = min(d2, (x1 + t * dx - px) ** 2 + (y1 + t * dy - py) ** 2)
        return c % 2 == 1 or d2 <= 2500.0

    exp = []
    for i, (x, y) in enumerate(xy):
        lon, lat = m2deg(x, y)
        if inside((lon - ORIGIN[0]) * KX, (lat - ORIGIN[1]) * KY):
            exp.append((i, 9))
    # vertices go through degrees and back: compare away from the boundary +- 1 mm
    assert got == sorted(exp)


def test_zone_counts_by_population_with_an_empty_population(spark, zones):
    from pyspark.sql import functions as F
    p = pts(spark, [(500, 500), (1000, 500)]).withColumn("population", F.lit("all"))
    pairs = points_in_zones(p, zones, tolerance_m=50.0, origin=ORIGIN)
    got = {(r["zone_id"], r["population"]): r["n"] for r in
           zone_counts(pairs, zones, p, total_id=0, by={"population": ["all", "sub"]}).collect()}
    assert got[(0, "all")] == 2 and got[(0, "sub")] == 0
    assert got[(1, "all")] == 2 and got[(1, "sub")] == 0 and got[(3, "sub")] == 0


def test_wide_zone_among_small_ones_lists_edges_only_where_they_pass(spark):
    # a ring of 4,000 vertices, 60 km wide, among six small squares; 800 m cells
    n, out = 4000, []
    for i in range(n):
        a = 2 * math.pi * i / n
        r = 30000 + 300 * math.sin(40 * a)
        out.append((r * math.cos(a), r * math.sin(a)))
    small = [(i, "s", "", [ring((i * 900, 0), (i * 900 + 700, 0), (i * 900 + 700, 700), (i * 900, 700))]) for i in range(6)]
    zones = spark.createDataFrame([(9, "wide", "w", [ring(*out)])] + small, ZONES)
    cells = zone_cell_edges(zones_on_plane(zones, ORIGIN), 800.0, 50.0).where("zone_id = 9")
    got = cells.agg(F.sum(F.size("edges")).alias("e"), F.count(F.when(F.size("edges") > 0, 1)).alias("touched")).first()
    length = sum(math.dist(p, q) for p, q in zip(out, out[1:] + out[:1]))
    assert cells.count() < 12 * length / 800         # with the inner cells of all levels; 60 km wide holds 4,400 cells of 800 m
    assert got["e"] < 2.5 * n                       # short edges: the cell they lie in, sometimes a second
    assert got["touched"] < 4 * length / 800
    rnd = random.Random(5)
    xy = [(rnd.uniform(-31000, 31000), rnd.uniform(-31000, 31000)) for _ in range(600)]
    found = hits(spark, zones.where("zone_id = 9"), xy, cell=800.0)
    assert found == hits(spark, zones.where("zone_id = 9"), xy, cell=100000.0)   # one cell holds every edge
    inner = {i for i, (x, y) in enumerate(xy) if math.hypot(x, y) < 29600}
    outer = {i for i, (x, y) in enumerate(xy) if math.hypot(x, y) > 30400}
    assert inner <= {i for i, _ in found} and not outer & {i for i, _ in found}


def test_cells_beyond_the_broadcast_bound_are_shuffled(spark, zones):
    cells = zone_cell_edges(zones_on_plane(zones, ORIGIN), 300.0, 50.0)
    p = pts(spark, [(500, 500)]).select("point_id", *[F.col("point_id").alias(c) for c in ("level", "cx", "cy")])
    for bound, join in ((0, "SortMergeJoin"), (1 << 26, "BroadcastHashJoin")):
        side, levels = cell_join_side(cells, bound)
        assert 0 in levels
        plan = p.join(side, ["level", "cx", "cy"])._jdf.queryExecution().executedPlan().toString()
        assert join in plan


def test_zero_tolerance_and_missing_coordinates(spark, zones):
    p = spark.createDataFrame(
        [(0, *m2deg(500, 500)), (1, float("nan"), 45.4), (2, None, 45.4), (3, *m2deg(-10, 500)), (4, float("inf"), 45.4)],
        "point_id long, lon double, lat double")
    assert rows(points_in_zones(p, zones, tolerance_m=0.0, cell_m=333.0, origin=ORIGIN).select("point_id", "zone_id")) == [(0, 1)]
