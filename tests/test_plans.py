"""Plan shape: the properties the design relies on at scale, checked on the
physical plans of the registered queries (smallest driver tables)."""

import os

import pytest

import __spark_entry__ as entry
from catchment.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
need = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()   # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@need
@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_pairs_joins(spark, name):
    p = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    if name in QUERIES:  # the analysis has no Python in its plans
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p and "MapInArrow" not in p


@need
def test_flagship_scans_od_once_and_limits_before_shuffle(spark):
    p = plan_of(entry.queries()["access_gap"](spark, SF))
    assert p.count("lineitem.parquet") == 1
    assert p.count("WindowGroupLimit") == 2          # partial (map side) + final
    # the OD scan reads only the columns it needs
    scan = [line for line in p.splitlines() if "FileScan parquet" in line and "lineitem" in line][0]
    assert "l_shipdate" not in scan and "l_returnflag" not in scan
