import pytest

from catchment.functions.geo import plane_scale
from catchment.plans.pipeline import Params, run
from catchment.schemas import ZONES

O = (-75.7, 45.4)
KX, KY = plane_scale(O[1])


def deg(x, y):
    return {"x": O[0] + x / KX, "y": O[1] + y / KY}


def sq(x0, x1):
    return [[deg(x0, 0), deg(x1, 0), deg(x1, 1000), deg(x0, 1000), deg(x0, 0)]]


@pytest.fixture()
def inputs(spark):
    zones = spark.createDataFrame([(1, "one", "un", sq(0, 1000)), (51, "fifty-one", "", sq(1000, 2000)),
                                   (2, "two", "deux", sq(3000, 4000))], ZONES)
    lookup = spark.createDataFrame([("a1", 1), ("a2", 1), ("b1", 51), ("c1", 2), ("x1", None)], "block_id string, zone_id int")
    pops = spark.createDataFrame([("a1", 100.0, "A"), ("a2", 300.0, "A"), ("b1", 200.0, "B"), ("c1", 50.0, "C"),
                                  ("x1", 10.0, "X")], "block_id string, pop double, area_id string")
    area = spark.createDataFrame([("A", "7002", 50.0), ("B", "7002", 0.0), ("A", "7001", 1.0)],
                                 "area_id string, attribute_id string, value double")
    p1, p2, p3 = deg(500, 500), deg(1500, 500), deg(3500, 500)
    dests = spark.createDataFrame([("d1", p1["y"], p1["x"], True, True), ("d2", p2["y"], p2["x"], True, False),
                                   ("d3", p3["y"], p3["x"], False, True)],
                                  "dest_id string, lat double, lon double, in_scope boolean, sub boolean")
    rows = []
    for b, base in [("a1", 1.0), ("a2", 2.0), ("b1", 3.0), ("c1", 4.0), ("x1", 5.0)]:
        for dd, extra in [("d1", 0.0), ("d2", 1.0), ("d3", 2.0)]:
            for mode, f in [("auto", 1.0), ("pedestrian", 0.5)]:
                rows.append((b, dd, mode, (base + extra) * f, (base + extra) * 60.0 / f))
    od = spark.createDataFrame(rows, "block_id string, dest_id string, mode string, distance double, time double")
    classes = spark.createDataFrame([(1, "one", "Urban"), (51, "fifty-one", "Urban"), (2, "two", "Rural")],
                                    "zone_id int, name string, zone_class string")
    attrs = spark.createDataFrame(
        [(z, a, v) for z, pop in [("0", 1000.0), ("1", 400.0), ("51", 200.0), ("2", 50.0)]
         for a, v in [("pop2016", pop), ("CDP269b", 10.0), ("CDP269c", 40.0), ("CDP269", 1.0), ("CDP269a", 2.0)]],
        "zone_id string, attribute string, value double")
    return dict(od=od, dests=dests, pops=pops, area_attributes=area, lookup=lookup, zones=zones,
                zone_classes=classes, zone_attributes=attrs)


def test_pipeline_end_to_end(spark, inputs):
    out = run(**inputs, params=Params(fallback_ids=(51,)))
    gap = {(r["mode"], r["zone_id"]): r for r in out["gap"].collect()}
    # zone 1: all = weights 100, 300 over block means (d1, d2 in scope): a1 -> (1+2)/2, a2 -> (2+3)/2
    assert gap[("auto", 1)]["dist_all"] == pytest.approx((100 * 1.5 + 300 * 2.5) / 400)
    # sub-population: only d1 serves it; zone 1 shares 50 %
    assert gap[("auto", 1)]["dist_sub"] == pytest.approx((50 * 1.0 + 150 * 2.0) / 200)
    # zone 51 has share 0 -> falls back to all-resident weights (listed in fallback_ids)
    assert gap[("auto", 51)]["dist_sub"] == pytest.approx(3.0)
    # zone 2 has no share row and is not listed -> missing
    assert gap[("auto", 2)]["dist_sub"] is None
    assert ("auto", None) not in gap
    ct = out["class_table"].collect()
    assert {(r["mode"], r["zone_id"]) for r in ct} == {("auto", 1), ("auto", 51), ("pedestrian", 1), ("pedestrian", 51)}
    pc = {r["zone_id"]: r for r in out["per_capita"].collect()}
    assert pc[0]["num_all"] == 2 and pc[0]["num_sub"] == 1          # total row: raw point counts
    assert pc[1]["num_all"] == 1 and pc[51]["num_all"] == 1 and pc[2]["num_all"] == 0
    assert pc[1]["pop_sub_only"] == 40.0 and pc[1]["pop_sub"] == 200.0
    assert pc[2]["pop_per_point_all"] is None
    assert out["summary"].count() == 2 * 3 * 2   # 2 modes x 3 variables x (Urban + Overall)
    assert {r["zone_class"] for r in out["test_report"].collect()} == {"Urban", "All"}
    assert out["figure_limits"].count() == 4
