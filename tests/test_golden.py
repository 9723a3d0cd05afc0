"""Golden replay against the analysis's shipped outputs (read in place, never
copied; skipped when absent)."""

import json
import math
import os
import re

import pytest
from pyspark.sql import functions as F

from catchment.operators.classes import class_benchmark
from catchment.operators.gap import clean_gap
from catchment.operators.percapita import per_capita
from catchment.operators.ranktest import signed_rank_test
from catchment.operators.summary import summary_table
from catchment.schemas import struct, S, D, I
from catchment.sources.files import read_csv
from helpers import REF

GAP = struct(("ONS_ID", I), ("Name", S), ("dist_all", D), ("time_all", D), ("dist_fr", D), ("time_fr", D),
             ("diff_d", D), ("diff_t", D))
CLASS = struct(*[(f.name, f.dataType) for f in GAP.fields], ("rurality", S), ("ons_pop", D),
               ("dist_fr_rurality_avg", D), ("time_fr_rurality_avg", D), ("dist_all_rurality_avg", D),
               ("time_all_rurality_avg", D), ("diff_d_rurality", D), ("diff_t_rurality", D))
RENAME = {"ONS_ID": "zone_id", "Name": "name", "dist_fr": "dist_sub", "time_fr": "time_sub", "rurality": "zone_class",
          "ons_pop": "zone_pop"}

need = pytest.mark.skipif(not os.path.isdir(REF), reason="shipped outputs not present")


def _class_table(spark, mode):
    return read_csv(spark, f"{REF}/neighbourhood_tables/ons_table_{mode}_rurality.csv", CLASS, rename=RENAME)


@need
@pytest.mark.parametrize("mode,gap_file", [("auto", "auto"), ("walk", "pedestrian")])
def test_gd1_clean_gap(spark, mode, gap_file):
    gap = read_csv(spark, f"{REF}/ons_weighted_table_{gap_file}.csv", GAP, rename=RENAME)
    assert gap.count() == 110
    cleaned = clean_gap(gap, exclude=[17])
    ct = _class_table(spark, mode)
    assert sorted(r[0] for r in cleaned.select("zone_id").collect()) == sorted(r[0] for r in ct.select("zone_id").collect())


@need
@pytest.mark.parametrize("mode", ["auto", "walk"])
def test_gd2_class_benchmark(spark, mode):
    ct = _class_table(spark, mode)
    gap = ct.select("zone_id", "name", "dist_all", "time_all", "dist_sub", "time_sub", "diff_d", "diff_t")
    got = class_benchmark(gap, ct.select("zone_id", "name", "zone_class"), ct.select("zone_id", "zone_pop"))
    exp = {r["zone_id"]: r for r in ct.collect()}
    n = 0
    for r in got.collect():
        e = exp[r["zone_id"]]
        for ours, theirs in [("dist_sub_class_avg", "dist_fr_rurality_avg"), ("time_sub_class_avg", "time_fr_rurality_avg"),
                             ("dist_all_class_avg", "dist_all_rurality_avg"), ("time_all_class_avg", "time_all_rurality_avg"),
                             ("diff_d_class", "diff_d_rurality"), ("diff_t_class", "diff_t_rurality")]:
            assert r[ours] == pytest.approx(e[theirs], rel=1e-12, abs=1e-12)
        n += 1
    assert n == 108


def _published(mode):
    html = open(f"{REF}/pub_tables/{mode}_table.html").read()
    m = re.search(r'"data":(\[\[.*?\]\])', html)
    cols = json.loads(m.group(1))
    return {(cols[1][i], cols[2][i]): [c[i] for c in cols[3:]] for i in range(len(cols[0]))}


@need
@pytest.mark.parametrize("mode,html,variables", [
    ("auto", "driving", ["time_all", "time_sub", "diff_t"]),
    ("walk", "walking", ["dist_all", "dist_sub", "diff_d"]),
])
def test_gd3_summary(spark, mode, html, variables):
    ct = _class_table(spark, mode)
    got = summary_table(ct, variables)
    pub = _published(html)
    names = {"time_sub": "time_fr", "dist_sub": "dist_fr"}
    assert got.count() == 12
    for r in got.collect():
        e = pub[(r["zone_class"], names.get(r["variable"], r["variable"]))]
        assert [r["p0"], r["p25"], r["p50"], r["p75"], r["p100"]] == pytest.approx(e[:5], abs=1e-9)
        assert r["median_iqr_text"] == e[5] and r["median_min_max_text"] == e[6]


@need
def test_gd4_per_capita(spark):
    schema = struct(("ONS_ID", I), ("Name", S), ("Name_FR", S), ("num_en", D), ("num_fr", D), ("pop2016_en", D),
                    ("pop2016_fr", D), ("pop2016_fr_only", D), ("percap_en", D), ("percap_fr", D), ("percap_fr_only", D),
                    ("pop_per_doc_en", D), ("pop_per_doc_fr", D), ("pop_per_doc_fr_only", D))
    pc = read_csv(spark, f"{REF}/neighbourhood_tables/per_capita_measures.csv", schema)
    keys = [F.col("ONS_ID").alias("zone_id"), F.col("Name").alias("name"), F.coalesce("Name_FR", F.lit("")).alias("name_alt")]
    a = pc.select(*keys, F.col("num_en").alias("n"))
    s = pc.select(*keys, F.col("num_fr").alias("n"))
    pops = pc.select(F.col("ONS_ID").alias("zone_id"), F.col("pop2016_en").alias("pop_all"),
                     F.col("pop2016_fr").alias("pop_sub"), F.col("pop2016_fr_only").alias("pop_sub_only"))
    got = {r["zone_id"]: r for r in per_capita(a, s, pops).collect()}
    assert len(got) == 112
    for e in pc.collect():
        r = got[e["ONS_ID"]]
        for ours, theirs in [("percap_all", "percap_en"), ("percap_sub", "percap_fr"), ("percap_sub_only", "percap_fr_only"),
                             ("pop_per_point_all", "pop_per_doc_en"), ("pop_per_point_sub", "pop_per_doc_fr"),
                             ("pop_per_point_sub_only", "pop_per_doc_fr_only")]:
            if e[theirs] is None:
                assert r[ours] is None, (e["ONS_ID"], ours)
            else:
                assert r[ours] == pytest.approx(e[theirs], rel=1e-12), (e["ONS_ID"], ours)
    # named rows: total row, zone without population, zero points with population
    assert got[0]["num_all"] == 869 and got[0]["pop_per_point_all"] == 1055
    assert got[5]["percap_all"] is None
    assert got[7]["percap_all"] == 0 and got[7]["pop_per_point_all"] is None


@need
def test_signed_rank_on_published_driving_table(spark):
    ct = _class_table(spark, "auto")
    got = {r["zone_class"]: r for r in signed_rank_test(ct, "time_all", "time_sub", by=["zone_class"], alternative="less").collect()}
    assert got["Rural"]["n"] == 18 and got["Rural"]["statistic"] == 1.0 and got["Rural"]["method"] == "exact"
    assert got["Rural"]["p_value"] == pytest.approx(7.62939453125e-06, rel=1e-12)
    for cls, n, v, z in [("Suburban", 41, 46.0, -4.97601), ("Urban", 47, 74.0, -5.17997)]:
        assert got[cls]["n"] == n and got[cls]["statistic"] == v and got[cls]["method"] == "normal"
        assert got[cls]["p_value"] == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), rel=1e-4)


@need
@pytest.mark.parametrize("gap_file", ["auto", "pedestrian"])
def test_gd5_published_order(spark, gap_file, tmp_path):
    from catchment.sources.sinks import ordered, write_published
    path = f"{REF}/ons_weighted_table_{gap_file}.csv"
    gap = read_csv(spark, path, GAP, rename=RENAME)
    shipped = [r["time_all"] for r in gap.collect()]          # file order
    got = [r["time_all"] for r in ordered(gap, [("time_all", True)]).collect()]
    assert got == shipped and got[-1] is None
    out = str(tmp_path / "gap")
    write_published(gap, out, order=[("time_all", True)])
    back = read_csv(spark, out, gap.schema)  # our column names
    assert [r["time_all"] for r in back.collect()] == shipped
