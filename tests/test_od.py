import math
import random

import pytest

from catchment.functions.geo import plane_scale
from catchment.operators.od import nearest_destinations, od_by_population, od_for_destinations, od_straight_line

ORIGIN = (-75.7, 45.4)
KX, KY = plane_scale(ORIGIN[1])


def brute(origins, dests, k):
    out = {}
    for b, olon, olat in origins:
        ds = sorted((math.hypot((dl - olon) * KX, (dt - olat) * KY), d) for d, dl, dt in dests)
        out[b] = [d for _, d in ds[:k]]
    return out


@pytest.mark.parametrize("n_dests,cell", [(40, None), (3, None), (60, 50.0), (1, 10.0), (400, None)])
def test_nearest_destinations_exact(spark, n_dests, cell):
    rnd = random.Random(n_dests)
    # clustered destinations: most in a small downtown square, a few far out
    dests = [(i, ORIGIN[0] + rnd.gauss(0, 0.002), ORIGIN[1] + rnd.gauss(0, 0.002)) for i in range(n_dests)]
    dests[-1] = (n_dests - 1, ORIGIN[0] + 0.3, ORIGIN[1] - 0.2)
    origins = [(1000 + j, ORIGIN[0] + rnd.uniform(-0.4, 0.4), ORIGIN[1] + rnd.uniform(-0.3, 0.3)) for j in range(60)]
    o = spark.createDataFrame(origins, "block_id long, lon double, lat double")
    d = spark.createDataFrame(dests, "dest_id long, lon double, lat double")
    got = nearest_destinations(o, d, k=5, cell_m=cell, plane_origin=ORIGIN).collect()
    by = {}
    for r in got:
        by.setdefault(r["block_id"], []).append((r["dist_m"], r["dest_id"]))
    exp = brute(origins, dests, 5)
    assert set(by) == set(exp)
    for b, lst in by.items():
        assert [x[1] for x in sorted(lst)] == exp[b]


def test_od_straight_line_modes(spark):
    o = spark.createDataFrame([(1, ORIGIN[0], ORIGIN[1])], "block_id long, lon double, lat double")
    d = spark.createDataFrame([(7, ORIGIN[0], ORIGIN[1] + 1000.0 / KY)], "dest_id long, lon double, lat double")
    got = {r["mode"]: r for r in od_straight_line(o, d, k=5, plane_origin=ORIGIN).collect()}
    assert got["auto"]["distance"] == pytest.approx(1.3) and got["auto"]["time"] == pytest.approx(1.3 / 40 * 3600)
    assert got["pedestrian"]["distance"] == pytest.approx(1.2) and got["pedestrian"]["time"] == pytest.approx(1.2 / 5 * 3600)


def test_od_population_tags_and_semi_join(spark):
    od = spark.createDataFrame([("b", 1, 1.0, 60.0), ("b", 2, 2.0, 60.0), ("b", 3, 3.0, 60.0), ("b", 4, 4.0, 60.0)],
                               "block_id string, dest_id long, distance double, time double")
    dests = spark.createDataFrame([(1, True, True), (2, True, False), (3, False, True), (4, None, True)],
                                  "dest_id long, in_scope boolean, sub boolean")
    tagged = sorted((r["dest_id"], r["population"]) for r in od_by_population(od, dests).collect())
    assert tagged == [(1, "all"), (1, "sub"), (2, "all")]
    assert sorted(r["dest_id"] for r in od_for_destinations(od, dests, ["in_scope", "sub"]).collect()) == [1]


def test_proxy_keeps_every_population(spark):
    """One origin, twelve destinations; those that serve the sub-population are
    not among its five nearest."""
    from catchment.operators.od import od_straight_line_by_population

    o = spark.createDataFrame([("b", ORIGIN[0], ORIGIN[1])], "block_id string, lon double, lat double")
    rows = [(f"d{i:02d}", ORIGIN[0] + (i + 1) * 0.001, ORIGIN[1], True, i >= 5) for i in range(12)]
    d = spark.createDataFrame(rows + [("nan", float("nan"), 45.0, True, True), ("far", 500.0, 45.0, True, True)],
                              "dest_id string, lon double, lat double, in_scope boolean, sub boolean")
    got = od_straight_line_by_population(o, d, k=5, modes={"auto": (1.0, 60.0)}).collect()
    ids = {p: sorted(r.dest_id for r in got if r.population == p) for p in ("all", "sub")}
    assert ids == {"all": [f"d{i:02d}" for i in range(5)], "sub": [f"d{i:02d}" for i in range(5, 10)]}


def test_crowded_address(spark):
    """Thousands of destinations at one spot: the first five by id, no more."""
    o = spark.createDataFrame([(i, ORIGIN[0] + i * 0.01, ORIGIN[1]) for i in range(3)], "block_id int, lon double, lat double")
    d = spark.range(5000).selectExpr("id as dest_id", f"double({ORIGIN[0]}) as lon", f"double({ORIGIN[1]}) as lat")
    got = nearest_destinations(o, d, k=5).collect()
    assert sorted((r.block_id, r.dest_id) for r in got) == [(b, i) for b in range(3) for i in range(5)]


def test_candidates_are_bounded_where_densities_mix(spark):
    """A town of 20,000 destinations on 200 m, a suburb, and empty land: whatever
    the densities around, an origin measures a few dozen destinations."""
    from catchment.operators.od import nearest_candidates

    rnd = random.Random(3)
    town = [(i, ORIGIN[0] + rnd.uniform(0, 200) / KX, ORIGIN[1] + rnd.uniform(0, 200) / KY) for i in range(20000)]
    suburb = [(30000 + i, ORIGIN[0] + rnd.uniform(500, 4000) / KX, ORIGIN[1] + rnd.uniform(0, 3000) / KY) for i in range(400)]
    land = [(40000 + i, ORIGIN[0] + rnd.uniform(-90000, 90000) / KX, ORIGIN[1] + rnd.uniform(-90000, 90000) / KY) for i in range(30)]
    dests = town + suburb + land
    spots = [(rnd.uniform(-10, 210), rnd.uniform(-10, 210)) for _ in range(30)]
    spots += [(rnd.uniform(210, 700), rnd.uniform(-300, 400)) for _ in range(30)]  # beside the town
    spots += [(rnd.uniform(-95000, 95000), rnd.uniform(-95000, 95000)) for _ in range(30)]
    origins = [(j, ORIGIN[0] + x / KX, ORIGIN[1] + y / KY) for j, (x, y) in enumerate(spots)]
    o = spark.createDataFrame(origins, "block_id long, lon double, lat double")
    d = spark.createDataFrame(dests, "dest_id long, lon double, lat double")
    measured = {r.block_id: r["count"] for r in nearest_candidates(o, d, k=5, plane_origin=ORIGIN).groupBy("block_id").count().collect()}
    assert len(measured) == 90 and max(measured.values()) <= 300 and sum(measured.values()) / 90 < 100
    got = {}
    for r in nearest_destinations(o, d, k=5, plane_origin=ORIGIN).collect():
        got.setdefault(r.block_id, []).append((r.dist_m, r.dest_id))
    want = brute(origins, dests, 5)
    assert {b: [x[1] for x in sorted(v)] for b, v in got.items()} == want


def test_few_destinations_and_equal_distances(spark):
    o = spark.createDataFrame([(1, ORIGIN[0], ORIGIN[1])], "block_id long, lon double, lat double")
    ring = [(i, ORIGIN[0] + dx / KX, ORIGIN[1] + dy / KY) for i, (dx, dy) in enumerate([(100, 0), (-100, 0), (0, 100), (0, -100)] * 30)]
    d = spark.createDataFrame(ring, "dest_id long, lon double, lat double")
    got = nearest_destinations(o, d.where("dest_id < 3"), k=5, plane_origin=ORIGIN).collect()
    assert sorted(r.dest_id for r in got) == [0, 1, 2]
    assert nearest_destinations(o, d, k=120, plane_origin=ORIGIN).count() == 120
    assert nearest_destinations(o, d.limit(0), k=5, plane_origin=ORIGIN).collect() == []
    assert nearest_destinations(o.limit(0), d, k=5, plane_origin=ORIGIN).collect() == []
