import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from catchment.operators.ranktest import signed_rank_test, test_report as report


def exact_p(d, alternative):
    a = [abs(x) for x in d]
    r = {v: sorted(a).index(v) + 1 for v in a}  # no ties in these cases
    v = sum(r[abs(x)] for x in d if x > 0)
    n = len(d)
    sums = [sum(s) for k in range(n + 1) for s in itertools.combinations(range(1, n + 1), k)]
    le = sum(1 for s in sums if s <= v) / 2 ** n
    ge = sum(1 for s in sums if s >= v) / 2 ** n
    if alternative == "less":
        return v, le
    if alternative == "greater":
        return v, ge
    return v, min(1.0, 2 * (ge if v > n * (n + 1) / 4 else le))


@pytest.mark.parametrize("alternative", ["less", "greater", "two.sided"])
def test_exact_matches_enumeration(spark, alternative):
    rnd = random.Random(5)
    data = []
    for g in range(4):
        n = 6 + 2 * g
        for i in range(n):
            data.append((f"g{g}", rnd.random() * 10, rnd.random() * 10))
    df = spark.createDataFrame(data, "g string, x double, y double")
    got = {r["g"]: r for r in signed_rank_test(df, "x", "y", by=["g"], alternative=alternative).collect()}
    for g in got:
        d = [x - y for gg, x, y in data if gg == g]
        v, p = exact_p(d, alternative)
        assert got[g]["method"] == "exact" and got[g]["statistic"] == v
        assert got[g]["p_value"] == pytest.approx(p, rel=1e-12)


def test_ties_zeros_missing_use_normal(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (3.0, 3.0), (None, 1.0), (5.0, 1.0), (0.5, 2.0)],
                               "x double, y double")
    r = signed_rank_test(df, "x", "y", alternative="less").collect()[0]
    # d = -1, -1, 0 (dropped), 4, -1.5 -> n=4, |d| ranks: 1.5, 1.5, 4, 3 -> V = 4
    assert r["n"] == 4 and r["statistic"] == 4.0 and r["method"] == "normal"
    n, v = 4, 4.0
    sigma = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - (2 ** 3 - 2) / 48)
    z = (v - n * (n + 1) / 4 + 0.5) / sigma
    assert r["p_value"] == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), rel=1e-9)


def test_symmetric_under_swap(spark):
    rnd = random.Random(9)
    df = spark.createDataFrame([(rnd.random(), rnd.random()) for _ in range(30)], "x double, y double")
    a = signed_rank_test(df, "x", "y", alternative="less").collect()[0]
    b = signed_rank_test(df, "y", "x", alternative="greater").collect()[0]
    assert a["p_value"] == pytest.approx(b["p_value"], rel=1e-12)


def test_report_stacks_classes_and_overall(spark):
    rnd = random.Random(1)
    data = [(m, c, rnd.random(), rnd.random() + 0.3, rnd.random(), rnd.random())
            for m in ("auto", "walk") for c in ("A", "B") for _ in range(8)]
    df = spark.createDataFrame(data, "mode string, zone_class string, time_all double, time_sub double, dist_all double, dist_sub double")
    got = report(df, [("auto", "time_all", "time_sub", "Driving", "Time"), ("walk", "dist_all", "dist_sub", "Walking", "Distance")])
    keys = sorted((r["mode"], r["metric"], r["zone_class"]) for r in got.collect())
    assert keys == [("Driving", "Time", "A"), ("Driving", "Time", "All"), ("Driving", "Time", "B"),
                    ("Walking", "Distance", "A"), ("Walking", "Distance", "All"), ("Walking", "Distance", "B")]
    single = signed_rank_test(df.where("mode = 'auto'"), "time_all", "time_sub", alternative="less").collect()[0]
    overall = [r for r in got.collect() if r["mode"] == "Driving" and r["zone_class"] == "All"][0]
    assert overall["p_value"] == pytest.approx(single["p_value"], rel=1e-12)


def test_millions_of_pairs_with_ties(spark):
    """Counts whose products overflow a long; p from the standard library's erfc."""
    import math

    n = 3_000_000
    df = spark.range(n).selectExpr("0.0 as x", "case when id % 1000 < 499 then 1.0 else -1.0 end as y")
    r = signed_rank_test(df, "x", "y", alternative="less").first()
    mean, var = n * (n + 1) / 4, n * (n + 1) * (2 * n + 1) / 24 - (n**3 - n) / 48
    v = n * 501 // 1000 * (n + 1) / 2
    assert r["n"] == n and r["method"] == "normal" and r["statistic"] == v
    assert r["p_value"] == pytest.approx(0.5 * math.erfc(-(v - mean + 0.5) / math.sqrt(2 * var)), abs=1e-6)


def enumerated(d, alternative):
    """p-value by the sign patterns of the average ranks of non-zero differences."""
    from itertools import product

    d = [x for x in d if x]
    size = sorted(abs(x) for x in d)
    rank = {a: (2 * size.index(a) + size.count(a) + 1) / 2 for a in size}
    r = [rank[abs(x)] for x in d]
    v = sum(a for a, x in zip(r, d) if x > 0)
    sums = [sum(a for a, s in zip(r, signs) if s) for signs in product((0, 1), repeat=len(r))]
    low, high = sum(s <= v for s in sums) / len(sums), sum(s >= v for s in sums) / len(sums)
    return {"less": low, "greater": high, "two.sided": min(1.0, 2 * (high if v > sum(r) / 2 else low))}[alternative]


@pytest.mark.parametrize("alternative", ["less", "greater", "two.sided"])
def test_exact_given_ties_and_zeros(spark, alternative):
    groups = {"ties": [1, 1, -1, 2, -2, 2, 3, 0, 0, 3, -4], "one": [5], "same": [2] * 9, "down": [-1, -2, -2, -3, -3, -3], None: [1, -1],
              "plain": [1, -2, 3, 4, -5, 6], "zeros": [0, 0]}
    df = spark.createDataFrame([(g, float(x)) for g, d in groups.items() for x in d], "g string, d double")
    got = {r.g: r for r in signed_rank_test(df, "d", F.lit(0.0), by=["g"], alternative=alternative, exact=True).collect()}
    for g, d in groups.items():
        if any(d):
            assert got[g].p_value == pytest.approx(enumerated(d, alternative), abs=1e-12) and got[g].method == "exact"
    assert got["zeros"].p_value is None and got["zeros"].n == 0
    alone = signed_rank_test(df.where("g = 'ties'"), "d", F.lit(0.0), alternative=alternative, exact=True).collect()
    assert alone[0].p_value == pytest.approx(enumerated(groups["ties"], alternative), abs=1e-12)


def test_exact_agrees_with_the_untied_law_and_stops_at_its_limit(spark, monkeypatch):
    from catchment.operators import ranktest

    df = spark.range(45).select((F.col("id") * 37 % 45 + 1).alias("a")).select(F.when(F.col("a") % 3 == 0, -F.col("a")).otherwise(F.col("a")).cast("double").alias("d"))
    plain = signed_rank_test(df, "d", F.lit(0.0)).first()
    given = signed_rank_test(df, "d", F.lit(0.0), exact=True).first()
    assert plain.method == given.method == "exact" and given.p_value == pytest.approx(plain.p_value, abs=1e-13)
    monkeypatch.setattr(ranktest, "EXACT_LIMIT", 40)
    with pytest.raises(Exception, match="no exact p-value above 40 pairs"):
        signed_rank_test(df, "d", F.lit(0.0), exact=True).collect()
    assert signed_rank_test(df, "d", F.lit(0.0), exact=False).first().method == "normal"
