import random

import pytest
from pyspark.sql import functions as F

from catchment.operators.nearest import nearest_k_mean
from catchment.operators.weighting import area_shares, block_weights, zone_access, zone_population
from helpers import rows

OD = "block_id string, dest_id string, distance double, time double"


def test_nearest_k_semantics(spark):
    od = spark.createDataFrame([
        # b1: 7 rows, k=5 smallest distances 1..5; times rank on themselves
        *[("b1", f"d{i}", float(i), float(600 - 60 * i)) for i in range(1, 8)],
        # b2: fewer than k rows, one NULL cost
        ("b2", "d1", 2.0, None), ("b2", "d2", None, 120.0), ("b2", "d3", 4.0, 240.0),
        # b3: ties at rank 5
        *[("b3", f"d{i}", 1.0, 60.0) for i in range(6)],
        # b4: only NULL costs
        ("b4", "d1", None, None),
        # no origin: dropped
        (None, "d1", 1.0, 60.0),
    ], OD)
    got = {r["block_id"]: (r["avg_dist"], r["avg_time"]) for r in nearest_k_mean(od, k=5).collect()}
    assert got["b1"] == (3.0, (60 * (3 + 4 + 5 + 6 + 7)) / 5 / 60)
    assert got["b2"] == (3.0, 3.0)
    assert got["b3"] == (1.0, 1.0)
    assert got["b4"] == (None, None)
    assert set(got) == {"b1", "b2", "b3", "b4"}


def test_nearest_k_matches_brute_force(spark):
    rnd = random.Random(7)
    data = [(f"b{rnd.randrange(30)}", f"d{j}", rnd.choice([None, rnd.random() * 10]), rnd.random() * 900) for j in range(600)]
    od = spark.createDataFrame(data, OD)
    for k in (1, 3, 5, 50):
        got = {r[0]: (r[1], r[2]) for r in nearest_k_mean(od, k=k).collect()}
        by = {}
        for b, _, d, t in data:
            by.setdefault(b, []).append((d, t))
        for b, vals in by.items():
            ds = sorted(v[0] for v in vals if v[0] is not None)[:k]
            ts = sorted(v[1] for v in vals)[:k]
            # NULLs rank last: the k first rows hold min(k, non-null) values
            exp_d = sum(ds) / len(ds) if ds else None
            exp_t = sum(ts) / len(ts) / 60
            assert (got[b][0] is None and exp_d is None) or got[b][0] == pytest.approx(exp_d)
            assert got[b][1] == pytest.approx(exp_t)


def test_nearest_k_plan_limits_before_shuffle(spark):
    od = spark.createDataFrame([("b", "d", 1.0, 2.0)], OD)
    plan = nearest_k_mean(od)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.fixture()
def blocks(spark):
    pops = spark.createDataFrame([
        ("A1", 100.0, "A"), ("A2", 300.0, "A"), ("A3", 50.0, "A"),   # A3: no OD (unreachable)
        ("B1", 200.0, "B"), ("B2", None, "B"),                       # NULL population
        ("C1", 0.0, "C"),                                            # zone with zero population
        ("X1", 10.0, "X"),                                           # block without zone
    ], "block_id string, pop double, area_id string")
    lookup = spark.createDataFrame([("A1", 1), ("A2", 1), ("A3", 1), ("B1", 2), ("B2", 2), ("C1", 3), ("X1", None)],
                                   "block_id string, zone_id int")
    shares = spark.createDataFrame([("A", 0.5), ("B", 0.0)], "area_id string, share double")  # C, X: no share row
    means = spark.createDataFrame([("A1", 1.0, 10.0), ("A2", 3.0, 30.0), ("B1", 2.0, 20.0), ("B2", 9.0, 90.0),
                                   ("C1", 5.0, 50.0), ("X1", 7.0, 70.0)], "block_id string, avg_dist double, avg_time double")
    return pops, lookup, shares, means


def test_zone_access_all(spark, blocks):
    pops, lookup, shares, means = blocks
    w = block_weights(pops, lookup, shares)
    got = {r["zone_id"]: (r["dist"], r["time"]) for r in zone_access(means, w, outputs=["dist", "time"]).collect()}
    # denominator counts the unreachable A3 (450), numerator 100*1 + 300*3
    assert got[1] == (pytest.approx(1000 / 450), pytest.approx(10000 / 450))
    assert got[2] == (2.0, 20.0)          # NULL population skipped on both sides
    assert got[3] == (None, None)         # 0 / 0
    assert None not in got                # block without zone dropped
    reach = {r["zone_id"]: r["dist"] for r in zone_access(means, w, outputs=["dist", "time"], reachable_only=True).collect()}
    assert reach[1] == pytest.approx(1000 / 400)


def test_zone_access_sub_fallback(spark, blocks):
    pops, lookup, shares, means = blocks
    w = block_weights(pops, lookup, shares)
    plain = {r["zone_id"]: r["dist"] for r in zone_access(means, w, outputs=["dist", "time"], weight="w_sub").collect()}
    assert plain[1] == pytest.approx((50 * 1 + 150 * 3) / 225) and plain[2] is None and plain[3] is None
    fb = {r["zone_id"]: r["dist"] for r in zone_access(means, w, outputs=["dist", "time"], weight="w_sub",
                                                        fallback_weight="w_all").collect()}
    assert fb[1] == plain[1] and fb[2] == 2.0 and fb[3] is None
    only = {r["zone_id"]: r["dist"] for r in zone_access(means, w, outputs=["dist", "time"], weight="w_sub",
                                                          fallback_weight="w_all", fallback_ids=[3]).collect()}
    assert only[2] is None


def test_zone_access_empty_as_zero(spark):
    pops = spark.createDataFrame([("a", 10.0, "x")], "block_id string, pop double, area_id string")
    lookup = spark.createDataFrame([("a", 1)], "block_id string, zone_id int")
    means = spark.createDataFrame([], "block_id string, avg_dist double, avg_time double")
    w = block_weights(pops, lookup)
    assert zone_access(means, w).collect()[0]["avg_dist"] is None
    assert zone_access(means, w, empty_as_zero=True).collect()[0]["avg_dist"] == 0.0


def test_zone_access_by_fanout(spark, blocks):
    pops, lookup, shares, means = blocks
    m = means.withColumn("mode", F.lit("auto"))
    w = block_weights(pops, lookup, shares)
    got = {(r["zone_id"], r["mode"]): r["avg_dist"] for r in zone_access(m, w, by={"mode": ["auto", "walk"]}).collect()}
    assert got[(1, "auto")] == pytest.approx(1000 / 450)
    assert got[(1, "walk")] is None       # populated, nothing reachable in that mode


def test_equal_weights_give_plain_mean(spark):
    rnd = random.Random(3)
    n = 40
    pops = spark.createDataFrame([(f"b{i}", 7.0, "a") for i in range(n)], "block_id string, pop double, area_id string")
    lookup = spark.createDataFrame([(f"b{i}", i % 4) for i in range(n)], "block_id string, zone_id int")
    vals = [rnd.random() for _ in range(n)]
    means = spark.createDataFrame([(f"b{i}", v, v) for i, v in enumerate(vals)], "block_id string, avg_dist double, avg_time double")
    got = {r["zone_id"]: r["avg_dist"] for r in zone_access(means, block_weights(pops, lookup)).collect()}
    for z in range(4):
        zs = [vals[i] for i in range(n) if i % 4 == z]
        assert got[z] == pytest.approx(sum(zs) / len(zs))
        assert min(zs) <= got[z] <= max(zs)


def test_area_shares_and_zone_population(spark, blocks):
    pops, lookup, _, _ = blocks
    attrs = spark.createDataFrame([("A", "7002", 12.5), ("A", "7001", 90.0), ("B", "7002", None)],
                                  "area_id string, attribute_id string, value double")
    assert rows(area_shares(attrs, "7002")) == [("A", 0.125), ("B", None)]
    zp = {r["zone_id"]: r["zone_pop"] for r in zone_population(lookup, pops).collect()}
    assert zp == {1: 450.0, 2: 200.0, 3: 0.0}


def test_attribute_pivot_duplicates_and_lenient_ids(spark):
    from catchment.operators.percapita import zone_populations
    attrs = spark.createDataFrame([
        ("07", "pop", 1000.0), ("07", "pop", 1000.0),          # exact duplicate
        ("07", "only", 2.5), ("07", "extra", 10.0), ("07", "unused", 99.0),
        (" 8 ", "pop", 400.0), ("8", "only", 0.0), ("8", "extra", 50.0),
        ("x", "pop", 5.0),                                     # not an integer id
    ], "zone_id string, attribute string, value double")
    got = {r["zone_id"]: r for r in zone_populations(attrs, "pop", "only", "extra").collect()}
    assert got[7]["pop_all"] == 1000.0 and got[7]["pop_sub_only"] == 25.0 and got[7]["pop_sub"] == 125.0
    assert got[8]["pop_sub_only"] is None and got[8]["pop_sub"] == 200.0   # 0 -> NULL
    assert None in got and got[None]["pop_all"] == 5.0
