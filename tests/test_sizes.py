"""Steps that make many more rows than they shuffle: dealt into tasks by the
size of their input, and a network search that sheds rows as it goes."""

import heapq
import os
import random

import pytest
from pyspark.sql import functions as F

from catchment.operators import network, od
from catchment.plans import gaps, queries, roles
from catchment.session import input_tasks

SF = "/root/testdata/sf0.001"
need = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_tasks_follow_the_stored_size(spark, tmp_path):
    spark.range(20000).write.parquet(str(tmp_path / "a"))
    df = spark.read.parquet(str(tmp_path / "a"))
    few, many = input_tasks(df, bytes_per_task=4096), input_tasks(df, df, bytes_per_task=4096)
    assert 4 < few and 2 * few - 1 <= many <= 2 * few
    assert input_tasks(df) == spark.sparkContext.defaultParallelism
    assert input_tasks(df.where("id < 0").select("id"), bytes_per_task=4096) == few  # of the files, not of what is left


@need
def test_od_rows_are_dealt_by_number(spark):
    li, orders = roles.table(spark, SF, "lineitem"), roles.table(spark, SF, "orders")
    assert roles.od_table(spark, SF).rdd.getNumPartitions() == input_tasks(li, orders)
    assert gaps.od_table(spark, SF).rdd.getNumPartitions() == input_tasks(li, orders, roles.table(spark, SF, "customer"))


@pytest.fixture
def od_dir(spark, tmp_path):
    """Line items, orders, customers and suppliers: a crowded origin, orders that come twice, null keys."""
    rnd = random.Random(5)
    orders = [(i, 1 if i % 3 == 0 else i % 40, float(i)) for i in range(400)] + [(7, 12, 1.0), (None, 3, 1.0), (8, None, 1.0)]
    items = [(rnd.randrange(410), rnd.randrange(30), float(rnd.randrange(50)), rnd.random() * 1000, 0.05, 0.02) for _ in range(3000)]
    items += [(None, 4, 1.0, 1.0, 0.0, 0.0), (9, None, 1.0, 1.0, 0.0, 0.0)]
    for name, rows, schema in (
        ("orders", orders, "o_orderkey long, o_custkey long, o_totalprice double"),
        ("lineitem", items, "l_orderkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double"),
        ("supplier", [(i, float(i * 400 - 800)) for i in range(28)], "s_suppkey long, s_acctbal double"),
        ("customer", [(i, i % 13) for i in range(42)], "c_custkey long, c_nationkey int"),
    ):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_rows_by_origin_are_the_same_rows(spark, od_dir):
    def rows(df):
        return sorted(map(repr, df.collect()))

    dealt = roles.od_table(spark, od_dir, 5)
    assert dealt.columns == roles.od_table(spark, od_dir).columns
    assert rows(dealt) == rows(roles.od_table(spark, od_dir)) and dealt.count() > 2000
    by_task = dealt.withColumn("task", F.spark_partition_id()).groupBy("block_id").agg(F.countDistinct("task").alias("n"))
    assert by_task.where("n > 1").count() == 0
    left = roles.od_table(spark, od_dir).where(f"block_id is not null and block_id % 13 <> {gaps.UNREACHABLE_ZONE}")
    assert rows(gaps.od_table(spark, od_dir)) == rows(left)


@pytest.mark.parametrize("partitions", ["1", "6"])
def test_ranking_of_an_origin_is_dealt_by_size(spark, od_dir, monkeypatch, partitions):
    """However many shuffle partitions the session has."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(roles, "input_tasks", lambda *tables, **more: 11)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert queries.block_means(spark, od_dir).rdd.getNumPartitions() == 11
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_origins_are_dealt_by_number(spark, monkeypatch):
    monkeypatch.setattr(od, "ORIGINS_PER_TASK", 10)
    places = [(i, -75.0 + (i * 37 % 101) / 500.0, 45.0 + (i * 53 % 97) / 500.0) for i in range(100)]
    o, d = spark.createDataFrame(places, "block_id long, lon double, lat double"), spark.createDataFrame(places, "dest_id long, lon double, lat double")
    assert od.nearest_candidates(o, d, k=2).rdd.getNumPartitions() == 10
    near = {(r.block_id, r.dest_id) for r in od.nearest_destinations(o, d, k=1).collect()}
    assert near == {(i, i) for i in range(100)}


def streets(seed: int, nodes: int, n: int) -> list:
    rnd = random.Random(seed)
    return [("a", rnd.randrange(nodes), rnd.randrange(nodes), float(rnd.randrange(9)), float(rnd.randrange(9))) for _ in range(n)]


EDGES = "mode string, from_node int, to_node int, distance double, time double"


def test_islands_shed_streets(spark, monkeypatch):
    rows = streets(1, 400, 520) + [("b", 7, 3, 1.0, 1.0), ("b", 9, 9, 1.0, 1.0)]
    sizes, stored = [], network.materialize

    def keep(df):
        out = stored(df)
        if "a" in out.columns:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(network, "materialize", keep)
    got = {(r.mode, r.node): r.island for r in network.islands(spark.createDataFrame(rows, EDGES)).collect()}
    want = {(m, x): x for m, a, b, *_ in rows for x in (a, b)}
    for _ in range(400):
        for m, a, b, *_ in rows:
            want[m, a] = want[m, b] = min(want[m, a], want[m, b])
    assert got == want
    assert sizes == sorted(sizes, reverse=True) and sizes[2] < sizes[0] / 2


def test_labels_with_late_ones_left_out(spark):
    """More labels than streets' nodes from the first rounds on, equal costs, two layers."""
    rows, rnd = streets(2, 40, 260), random.Random(3)
    seeds = [("a", p, d, rnd.randrange(40)) for d in range(60) for p in ("x", "y") if p == "x" or d % 3 == 0]
    got = network.network_labels(spark.createDataFrame(rows, EDGES), spark.createDataFrame(
        seeds, "mode string, population string, dest_id int, node int"), k=3, cost="time")
    back = {}
    for _, a, b, dist, t in rows:
        back.setdefault(b, []).append((a, dist, t))
    best = {}
    for _, p, d, at in seeds:
        seen, heap = {}, [(0.0, 0.0, at)]
        while heap:
            t, dist, n = heapq.heappop(heap)
            if n not in seen:
                seen[n] = (t, dist)
                for a, ed, et in back.get(n, []):
                    heapq.heappush(heap, (t + et, dist + ed, a))
        for n, (t, dist) in seen.items():
            best.setdefault((p, n), []).append((t, dist, d))
    want = {(p, n, d, dist, t) for (p, n), found in best.items() for t, dist, d in sorted(found)[:3]}
    assert {(r.population, r.node, r.dest_id, r.distance, r.time) for r in got.collect()} == want
