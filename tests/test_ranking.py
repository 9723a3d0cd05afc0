import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catchment.operators.ranking import distinct_ranks, order_statistics


@pytest.fixture()
def data(spark):
    rnd = random.Random(4)
    rows = []
    for g in ["a", "b", None]:
        for _ in range(300):
            v = rnd.choice([7.0] * 5 + [round(rnd.gauss(0, 3), 1)])   # a value held by most rows
            rows.append((g, v))
        rows.append((g, None))
    return rows, spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("partitions", [None, 1, 2, 7, 64])
def test_distinct_ranks_exact(spark, data, partitions):
    rows, df = data
    got = {(r["g"], r["_v"]): (r["_t"], r["_less"]) for r in distinct_ranks(df, ["g"], "v", partitions=partitions).collect()}
    for (g, v), (t, less) in got.items():
        vals = [x for gg, x in rows if gg == g and x is not None]
        assert t == sum(1 for x in vals if x == v)
        assert less == sum(1 for x in vals if x < v)


def test_order_statistics_type7(spark, data):
    rows, df = data
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in order_statistics(df, ["g"], "v", probs, partitions=5).collect()}
    for g in ["a", "b", None]:
        vals = np.array([x for gg, x in rows if gg == g and x is not None])
        assert got[g] == pytest.approx(list(np.quantile(vals, probs)), abs=1e-12)


def test_without_group_keys(spark, data):
    rows, df = data
    vals = np.array([x for _, x in rows if x is not None])
    got = order_statistics(df, [], "v", [0.0, 0.5, 1.0]).collect()[0]["q"]
    assert got == pytest.approx(list(np.quantile(vals, [0.0, 0.5, 1.0])), abs=1e-12)
    r = {row["_v"]: row["_less"] for row in distinct_ranks(df, [], "v", partitions=3).collect()}
    assert r[7.0] == sum(1 for x in vals if x < 7.0)


def test_ranks_of_extreme_and_crowded_values(spark):
    inf = float("inf")
    vals = [-inf, -1e300, -5.0, -1.0000001, -1.0, -1e-300, 0.0, 5e-324, 1e-300, 0.5, 1.0, 1.0000001, 2.0, 1e300, inf, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double").repartition(3)
    got = distinct_ranks(df, [], "v", extra={"i": F.min("i")}, partitions=6).collect()
    assert {r.i: r._less for r in got} == {i: i for i in range(len(vals))}


def test_crowded_values_are_dealt_evenly(spark):
    """Milliseconds of one minute, far from zero: relative differences below 1e-7."""
    df = spark.range(60000, numPartitions=4).select((F.col("id") * 7919 % 60000 + 1_700_000_000_000).cast("double").alias("v"),
                                                    F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("g"))
    got = distinct_ranks(df, ["g"], "v", partitions=12)
    sizes = [r["count"] for r in got.groupBy("_part").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 2 * 60000 / 12
    out = got.where("g = 'hot'").select("_v", "_less").toPandas().sort_values("_v")
    assert out["_less"].tolist() == list(range(40000))


def test_ranks_of_counts_and_many_values(spark):
    df = spark.range(200000).select((F.col("id") * 7919 % 100003 - 50000).alias("v"))   # whole numbers, some twice
    out = distinct_ranks(df, [], "v").select("_v", "_t", "_less").toPandas().sort_values("_v")
    assert (out["_less"].to_numpy() == np.concatenate([[0], out["_t"].cumsum().to_numpy()[:-1]])).all()
    assert out["_t"].sum() == 200000
