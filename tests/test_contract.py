"""The driver contract: entry(), queries() and oracle_sql(), checked against
DuckDB on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
from catchment.plans.oracle import ORACLE  # noqa: E402
from catchment.plans.queries import QUERIES  # noqa: E402
from check_oracle import TABLES, digest, type_mismatches  # noqa: E402

SF = "/root/testdata/sf0.001"
need = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@need
def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["mode", "zone_id", "name", "dist_all", "time_all", "dist_sub", "time_sub", "diff_d", "diff_t"]
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@need
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert type_mismatches(df, res) == {}
    assert len(got) == len(exp)
    assert digest(got, df.columns)[0] == digest(exp, ocols)[0]
