"""Projections against a numerical integral and round trips, widened outlines
against distances, cells of all levels."""

import math
import random

import pytest
from pyspark.sql import functions as F

from catchment.functions.geo import in_buffer, near_any, path_parity, ring_edges, signed_area
from catchment.functions.projection import MTM_ZONE_9, LocalPlane, TransverseMercator
from catchment.operators.spatial import points_in_zones, zone_buffers
from catchment.schemas import ZONES
from helpers import rows

ORIGIN = (-75.7, 45.4)
PLANE = LocalPlane(ORIGIN)


def meridian_arc(lat, a=6378137.0, inv=298.257222101, steps=20000):
    """Length of the meridian from the equator, by Simpson's rule."""
    f = 1 / inv
    e2 = f * (2 - f)

    def g(x):
        return a * (1 - e2) / (1 - e2 * math.sin(x) ** 2) ** 1.5

    h = math.radians(lat) / steps
    return h / 3 * sum((1 if i in (0, steps) else 4 if i % 2 else 2) * g(i * h) for i in range(steps + 1))


def grid_points(spark):
    return spark.createDataFrame([(i, -76.5 + dx, lat) for i, (dx, lat) in enumerate(
        (dx, lat) for dx in (-3.0, -1.5, -0.001, 0.0, 0.7, 1.5, 3.0) for lat in (-60.0, -10.0, 0.0, 30.0, 45.4, 70.0))],
        "i long, lon double, lat double")


def test_northing_on_the_central_meridian_is_the_arc(spark):
    x, y = MTM_ZONE_9.forward(F.col("lon"), F.col("lat"))
    for r in grid_points(spark).where("lon = -76.5").select("lat", x.alias("x"), y.alias("y")).collect():
        assert r.x == pytest.approx(304800.0, abs=1e-6)
        assert r.y == pytest.approx(0.9999 * math.copysign(meridian_arc(abs(r.lat)), r.lat), abs=1e-4)


@pytest.mark.parametrize("plane", [MTM_ZONE_9, LocalPlane(ORIGIN), TransverseMercator(lon0=-75.0, scale=0.9996, east=500000.0, lat0=40.0)])
def test_there_and_back(spark, plane):
    df = grid_points(spark)
    x, y = plane.forward(F.col("lon"), F.col("lat"))
    lon, lat = plane.inverse(F.col("x"), F.col("y"))
    got = df.withColumns({"x": x, "y": y}).select("lon", "lat", lon.alias("u"), lat.alias("v")).collect()
    assert max(max(abs(r.lon - r.u) * math.cos(math.radians(r.lat)), abs(r.lat - r.v)) for r in got) * 111e3 < 1e-3  # 1 mm


def test_the_grid_is_conformal(spark):
    """Small steps east and north have the same length and a right angle, and the
    scale is that of the sphere along the latitude."""
    df = grid_points(spark)
    h = 1e-5
    at = [MTM_ZONE_9.forward(F.col("lon") + dx, F.col("lat") + dy) for dx, dy in ((-h, 0), (h, 0), (0, -h), (0, h))]
    cols = [c.alias(f"{n}{i}") for i, xy in enumerate(at) for n, c in zip("xy", xy)]
    f = 1 / 298.257222101
    e2 = f * (2 - f)
    for r in df.select("lat", "lon", *cols).collect():
        w = math.sqrt(1 - e2 * math.sin(math.radians(r.lat)) ** 2)
        nu, rho = 6378137.0 / w, 6378137.0 * (1 - e2) / w ** 3
        east = ((r.x1 - r.x0) / (nu * math.cos(math.radians(r.lat))), (r.y1 - r.y0) / (nu * math.cos(math.radians(r.lat))))
        north = ((r.x3 - r.x2) / rho, (r.y3 - r.y2) / rho)
        unit = 2 * math.radians(h)
        assert math.hypot(*east) / unit == pytest.approx(math.hypot(*north) / unit, abs=2e-6)
        assert abs(east[0] * north[0] + east[1] * north[1]) / unit ** 2 < 4e-6
        assert 0.9999 - 1e-6 <= math.hypot(*east) / unit < 1.0016


def ring(*pts):
    kx, ky = math.cos(math.radians(ORIGIN[1])) * 6371008.8 * math.pi / 180, 6371008.8 * math.pi / 180
    return [{"x": ORIGIN[0] + x / kx, "y": ORIGIN[1] + y / ky} for x, y in pts]


# a square (clockwise), an L, a wide hole, a hole that closes, two parts of which
# one has a hole, a star with narrow inward corners, a spike
SHAPES = {
    1: [ring((0, 0), (0, 400), (400, 400), (400, 0), (0, 0))],
    2: [ring((0, 0), (600, 0), (600, 150), (150, 150), (150, 600), (0, 600))],
    3: [ring((0, 0), (900, 0), (900, 900), (0, 900)), ring((200, 200), (200, 700), (700, 700), (700, 200))],
    4: [ring((0, 0), (500, 0), (500, 500), (0, 500)), ring((200, 200), (260, 200), (260, 260), (200, 260))],
    5: [ring((0, 0), (300, 0), (300, 300), (0, 300)), ring((500, 0), (1100, 0), (1100, 600), (500, 600)),
        ring((600, 100), (600, 500), (1000, 500), (1000, 100))],
    6: [ring(*[((500 if i % 2 else 90) * math.cos(i * math.pi / 7), (500 if i % 2 else 90) * math.sin(i * math.pi / 7)) for i in range(14)])],
    7: [ring((0, 0), (300, 0), (300, 100), (150, 100), (150, 400), (150, 100), (0, 100))],
}


def test_widened_outlines_against_distances(spark):
    zones = spark.createDataFrame([(i, str(i), "", r) for i, r in SHAPES.items()], ZONES)
    rnd = random.Random(4)
    xy = [(rnd.uniform(-650, 1250), rnd.uniform(-650, 1250)) for _ in range(900)]
    steps, d = 24, 60.0
    wide = zone_buffers(zones, d, ORIGIN, steps).select("zone_id", "curves")
    narrow = spark.createDataFrame([(i, str(i), "", r) for i, r in SHAPES.items()], ZONES)
    from catchment.operators.spatial import zones_on_plane
    edges = zones_on_plane(narrow, ORIGIN).select("zone_id", ring_edges(F.col("rings_m")).alias("edges"))
    pts = spark.createDataFrame([(float(x), float(y)) for x, y in xy], "px double, py double")
    j = pts.crossJoin(F.broadcast(wide.join(edges, "zone_id")))
    x, y = F.col("px"), F.col("py")
    inside = path_parity(F.col("edges"), x, y, F.lit(-5000.0), F.lit(-5000.0))
    slack = d * (1 - math.cos(math.pi / (4 * steps))) + 1e-6
    got = j.select("zone_id", in_buffer(F.col("curves"), x, y).alias("got"), (inside | near_any(F.col("edges"), x, y, d)).alias("within"),
                   (inside | near_any(F.col("edges"), x, y, d - slack)).alias("surely")).collect()
    assert all(r.got <= r.within and r.surely <= r.got for r in got)
    assert all(any(r.got and r.zone_id == z for r in got) and any(not r.got and r.zone_id == z for r in got) for z in SHAPES)
    assert sum(r.got for r in got) > sum(1 for r in got if r.surely) - 5


def test_widened_outlines_come_back_in_degrees(spark):
    zones = spark.createDataFrame([(i, str(i), "", r) for i, r in SHAPES.items()], ZONES)
    got = zone_buffers(zones, 50.0, MTM_ZONE_9)
    assert got.columns == [*zones.columns, "curves"]
    first = got.where("zone_id = 1").select(F.col("rings")[0].alias("r"), signed_area(F.col("curves")[0]).alias("a")).first()
    assert first.a == pytest.approx((400 ** 2 + 4 * 400 * 50 + math.pi * 2500) * 0.99998, rel=2e-3)
    kx, ky = math.cos(math.radians(ORIGIN[1])) * 6371008.8 * math.pi / 180, 6371008.8 * math.pi / 180
    far = [((p["x"] - ORIGIN[0]) * kx, (p["y"] - ORIGIN[1]) * ky) for p in first.r]
    assert min(x for x, _ in far) == pytest.approx(-50, abs=0.3) and max(y for _, y in far) == pytest.approx(450, abs=1.5)
    empty = spark.createDataFrame([(1, "a", "", []), (2, "b", "", [ring((0, 0), (1, 0))])], ZONES)
    assert [r.curves for r in zone_buffers(empty, 50.0, ORIGIN).collect()] == [[], []]


def test_both_planes_find_the_same_points(spark):
    zones = spark.createDataFrame([(i, str(i), "", r) for i, r in SHAPES.items()], ZONES)
    rnd = random.Random(9)
    kx, ky = math.cos(math.radians(ORIGIN[1])) * 6371008.8 * math.pi / 180, 6371008.8 * math.pi / 180
    pts = spark.createDataFrame([(i, ORIGIN[0] + rnd.uniform(-650, 1250) / kx, ORIGIN[1] + rnd.uniform(-650, 1250) / ky) for i in range(500)],
                                "point_id long, lon double, lat double")
    grid, tight, loose = (rows(points_in_zones(pts, zones, t, cell_m=170.0, plane=p).select("point_id", "zone_id"))
                          for t, p in ((50.0, MTM_ZONE_9), (48.0, PLANE), (52.0, PLANE)))
    assert set(tight) <= set(grid) <= set(loose) and len(grid) > 100
