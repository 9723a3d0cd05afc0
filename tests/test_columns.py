import math

from pyspark.sql import functions as F

from catchment.functions.columns import (lenient_number, normal_cdf, num_text, range_text, replace_first,
                                         round_half_even, safe_div)


def test_lenient_number(spark):
    df = spark.createDataFrame([("1,234",), ("x",), ("",), (None,), ("12.5",), ("-3",), ("$7.25%",)], "s string")
    got = [r[0] for r in df.select(lenient_number("s")).collect()]
    assert got == [1234.0, None, None, None, 12.5, -3.0, 7.25]


def test_num_text_and_range(spark):
    df = spark.createDataFrame([(2.0, -0.46, 0.37), (-0.0, 10.13, 2.27), (None, 1.0, 1.0)], "a double, b double, c double")
    got = [tuple(r) for r in df.select(num_text("a"), num_text("b"), range_text("c", "b", "a")).collect()]
    assert got[0] == ("2", "-0.46", "0.37 (-0.46-2)")
    assert got[1] == ("0", "10.13", "2.27 (10.13-0)")
    assert got[2] == (None, "1", None)


def test_safe_div_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (3.0, 2.0)], "a double, b double")
    got = [tuple(r) for r in df.select(safe_div("a", "b"), round_half_even(F.col("a") + 1.5), round_half_even(F.lit(2.675), 2)).collect()]
    assert got[0][0] is None and got[1][0] is None and got[2][0] == 1.5
    assert [g[1] for g in got] == [2.0, 2.0, 4.0]  # 2.5 -> 2, 1.5 -> 2, 4.5 -> 4


def test_replace_first(spark):
    df = spark.createDataFrame([("time_all_all",), ("dist_sub",)], "s string")
    got = [r[0] for r in df.select(replace_first("s", "all", "sub")).collect()]
    assert got == ["time_sub_all", "dist_sub"]


def test_normal_cdf_accuracy(spark):
    zs = [-8.0, -5.2, -3.7, -1.0, -0.1, 0.0, 0.5, 2.0, 6.0, 9.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = [r[0] for r in df.select(normal_cdf("z")).collect()]
    for z, p in zip(zs, got):
        exact = 0.5 * math.erfc(-z / math.sqrt(2.0))
        assert abs(p - exact) <= 1e-9 * max(exact, 1e-300) + 1e-15, (z, p, exact)


def test_null_zero_nonfinite_and_if_else(spark):
    from catchment.functions.columns import if_else, nonfinite_to_null, null_to_zero, zero_to_null
    df = spark.createDataFrame([(0.0, None), (2.0, True), (float("nan"), False), (float("inf"), None)],
                               "x double, c boolean")
    got = [tuple(r) for r in df.select(
        null_to_zero(zero_to_null("x")), nonfinite_to_null("x"), if_else(F.col("c"), F.lit("y"), F.lit("n"))
    ).collect()]
    assert got[0] == (0.0, 0.0, None)          # 0 -> NULL -> 0; NULL condition gives NULL
    assert got[1] == (2.0, 2.0, "y")
    assert got[2][1] is None and got[2][2] == "n"
    assert got[3][1] is None and got[3][2] is None
