import pytest

from catchment.operators.classes import class_benchmark
from catchment.operators.gap import access_gap, access_gap_long, clean_gap, mode_required
from helpers import rows


def test_access_gap_two_tables_and_long_form_agree(spark):
    a = spark.createDataFrame([(1, 2.0, 10.0), (2, 3.0, 20.0), (3, None, 5.0)], "zone_id int, dist double, time double")
    s = spark.createDataFrame([(1, 2.5, 12.0), (2, 2.0, 18.0)], "zone_id int, dist double, time double")
    names = spark.createDataFrame([(1, "one"), (2, "two")], "zone_id int, name string")
    two = rows(access_gap(a, s, names))
    assert two == [(1, "one", 2.0, 10.0, 2.5, 12.0, 0.5, 2.0), (2, "two", 3.0, 20.0, 2.0, 18.0, -1.0, -2.0),
                   (3, None, None, 5.0, None, None, None, None)]
    from pyspark.sql import functions as F
    long = a.withColumn("population", F.lit("all")).unionByName(s.withColumn("population", F.lit("sub")))
    assert rows(access_gap_long(long, names)) == two


def test_clean_gap_drops_missing_and_excluded(spark):
    gap = spark.createDataFrame([(1, "a", 1.0), (17, "b", 2.0), (None, "c", 3.0), (4, None, 4.0)],
                                "zone_id int, name string, v double")
    assert rows(clean_gap(gap, exclude=[17])) == [(1, "a", 1.0)]
    with pytest.raises(ValueError):
        mode_required(None)


def test_class_benchmark_null_class_and_exclusion(spark):
    gap = spark.createDataFrame([
        (1, "a", 1.0, 10.0, 2.0, 12.0), (2, "b", 3.0, 30.0, 3.0, 33.0), (3, "c", 5.0, 50.0, 4.0, 40.0),
        (9, "z", 7.0, 70.0, 8.0, 80.0),          # zone without class row
    ], "zone_id int, name string, dist_all double, time_all double, dist_sub double, time_sub double")
    gap = gap.selectExpr("*", "dist_sub - dist_all AS diff_d", "time_sub - time_all AS diff_t")
    classes = spark.createDataFrame([(1, "a", "U"), (2, "b", "U"), (3, "c", "R"), (5, "e", "R")],
                                    "zone_id int, name string, zone_class string")
    pops = spark.createDataFrame([(1, 100.0), (2, 300.0), (3, 50.0), (5, 950.0), (9, 10.0)], "zone_id int, zone_pop double")
    got = {r["zone_id"]: r for r in class_benchmark(gap, classes, pops, exclude=[5]).collect()}
    # class U: population 400; dist_all avg = (1*100 + 3*300) / 400
    assert got[1]["dist_all_class_avg"] == pytest.approx(1000 / 400)
    assert got[1]["diff_d_class"] == pytest.approx(2.0 - 1000 / 400)
    # class R: zone 5 excluded from the class population: 50 only
    assert got[3]["dist_sub_class_avg"] == pytest.approx(4.0)
    # unclassified zone: NULL class, no class population -> NULL averages
    assert got[9]["zone_class"] is None and got[9]["dist_all_class_avg"] is None
    sub = {r["zone_id"]: r for r in class_benchmark(gap, classes, pops, exclude=[5], benchmark="sub").collect()}
    assert sub[1]["diff_d_class"] == pytest.approx(2.0 - (2.0 * 100 + 3.0 * 300) / 400)
