"""Network OD against Dijkstra's algorithm on small networks."""

import heapq
import random

import pytest

from catchment.operators.network import islands, network_labels, od_network, reachable_network
from helpers import rows

EDGE = "mode string, from_node long, to_node long, distance double, time double"
ORIGIN = (-75.7, 45.4)


def brute_labels(edges, seeds, k, cost):
    """(mode, node) -> the k best (cost, other, dest), by a search from every destination."""
    at, other = (4, 3) if cost == "time" else (3, 4)
    into = {}
    for e in edges:
        into.setdefault((e[0], e[2]), []).append(e)
    best = {}
    for mode, dest, node in seeds:
        done, heap = {}, [(0.0, 0.0, node)]
        while heap:
            c, d, u = heapq.heappop(heap)
            if u in done:
                continue
            done[u] = (c, d)
            for e in into.get((mode, u), []):
                heapq.heappush(heap, (c + e[at], d + e[other], e[1]))
        for u, (c, d) in done.items():
            best.setdefault((mode, u), []).append((c, d, dest))
    return {x: sorted(v)[:k] for x, v in best.items()}


def random_edges(rnd, n, m, modes=("auto", "walk")):
    return [(rnd.choice(modes), rnd.randrange(n), rnd.randrange(n), float(rnd.randrange(0, 9)), float(rnd.randrange(0, 6))) for _ in range(m)]


@pytest.mark.parametrize("cost", ["time", "distance"])
@pytest.mark.parametrize("k", [1, 3])
def test_labels_against_dijkstra(spark, cost, k):
    rnd = random.Random(k)
    edges = random_edges(rnd, 60, 260) + [("auto", 5, i, 1.0, 1.0) for i in range(60)]  # a node with many streets
    seeds = [(m, 100 + d, rnd.randrange(60)) for d in range(12) for m in ("auto", "walk")]
    seeds += [("auto", 200 + d, 7) for d in range(9)]  # many destinations at one node
    got = network_labels(spark.createDataFrame(edges, EDGE), spark.createDataFrame(seeds, "mode string, dest_id long, node long"), k, cost)
    found = {}
    for r in got.collect():
        c, d = (r.time, r.distance) if cost == "time" else (r.distance, r.time)
        found.setdefault((r["mode"], r.node), []).append((c, d, r.dest_id))
    assert {x: sorted(v) for x, v in found.items()} == brute_labels(edges, seeds, k, cost)


def test_rounds_are_bounded(spark):
    chain = spark.createDataFrame([("auto", i + 1, i, 1.0, 1.0) for i in range(12)], EDGE)
    seeds = spark.createDataFrame([("auto", 1, 0)], "mode string, dest_id long, node long")
    assert network_labels(chain, seeds, max_rounds=14).count() == 13
    with pytest.raises(RuntimeError):
        network_labels(chain, seeds, max_rounds=5)
    with pytest.raises(ValueError):
        network_labels(chain, seeds, cost="toll")


def test_islands_and_reachability(spark):
    edges = [("auto", i, i + 1, 1.0, 1.0) for i in range(40)] + [("auto", 100, 101, 1.0, 1.0), ("auto", 200, 200, 1.0, 1.0),
             ("walk", 40, 100, 1.0, 1.0)]
    got = {(r["mode"], r.node): r.island for r in islands(spark.createDataFrame(edges, EDGE)).collect()}
    assert got == {**{("auto", i): 0 for i in range(41)}, ("auto", 100): 100, ("auto", 101): 100, ("auto", 200): 200,
                   ("walk", 40): 40, ("walk", 100): 40}
    bad = [("auto", 1, 2, -1.0, 1.0), ("auto", 1, 2, None, 1.0), (None, 1, 2, 1.0, 1.0), ("auto", None, 2, 1.0, 1.0),
           ("auto", 1, 2, float("nan"), 1.0), ("auto", 1, 2, 1.0, float("inf"))]
    df = spark.createDataFrame(edges + bad, EDGE)
    assert reachable_network(df, 1).count() == len(edges)
    assert sorted(r.from_node for r in reachable_network(df, 3).collect()) == list(range(40))
    assert reachable_network(df, 42).count() == 0


def test_od_over_the_network(spark):
    """A street of six nodes, an island of two, a one-way street."""
    lon = [ORIGIN[0] + 0.01 * i for i in range(6)]
    nodes = [(i, lon[i], ORIGIN[1]) for i in range(6)] + [(10, lon[0], ORIGIN[1] + 0.001), (11, lon[1], ORIGIN[1] + 0.001)]
    edges = [("auto", a, b, 100.0, 10.0) for i in range(5) for a, b in ((i, i + 1), (i + 1, i))]
    edges += [("auto", 10, 11, 1.0, 1.0), ("auto", 11, 10, 1.0, 1.0), ("auto", 0, 4, 1000.0, 15.0), ("walk", 0, 1, 100.0, 70.0)]
    origins = [("a", lon[0], ORIGIN[1] + 0.001), ("b", lon[5], ORIGIN[1]), ("nowhere", None, None), ("nan", float("nan"), 45.0)]
    dests = [(1, lon[0], ORIGIN[1], True, False), (2, lon[4], ORIGIN[1], True, True), (3, lon[1], ORIGIN[1], None, True)]
    args = (spark.createDataFrame(edges, EDGE), spark.createDataFrame(nodes, "node long, lon double, lat double"),
            spark.createDataFrame(origins, "block_id string, lon double, lat double"),
            spark.createDataFrame(dests, "dest_id int, lon double, lat double, in_scope boolean, sub boolean"))
    pops = {"all": ("in_scope",), "sub": ("in_scope", "sub")}
    got = od_network(*args, k=2, min_reachability=3, populations=pops, plane_origin=ORIGIN)
    assert got.columns == ["block_id", "dest_id", "mode", "distance", "time", "population"]
    # node 0 stands for origin a, as 10 lies on the island; the way to 2 takes the quick street
    assert rows(got) == [("a", 1, "auto", 0.0, 0.0, "all"), ("a", 2, "auto", 1000.0, 15.0, "all"), ("a", 2, "auto", 1000.0, 15.0, "sub"),
                         ("b", 1, "auto", 500.0, 50.0, "all"), ("b", 2, "auto", 100.0, 10.0, "all"), ("b", 2, "auto", 100.0, 10.0, "sub")]
    near = od_network(*args, k=1, cost="distance", min_reachability=1, plane_origin=ORIGIN)
    assert near.where("block_id = 'b' and mode = 'auto'").select("dest_id", "distance").collect() == [(2, 100.0)]
    assert od_network(*args, min_reachability=100, plane_origin=ORIGIN).collect() == []


def test_walkers_and_islands(spark):
    nodes = [(i, ORIGIN[0] + 0.01 * i, ORIGIN[1]) for i in range(3)]
    edges = spark.createDataFrame([("walk", 0, 1, 5.0, 7.0)], EDGE)
    place = "long, lon double, lat double"
    args = (edges, spark.createDataFrame(nodes, f"node {place}"), spark.createDataFrame(nodes, f"block_id {place}"),
            spark.createDataFrame(nodes[1:2], f"dest_id {place}"))
    got = od_network(*args, min_reachability=1, plane_origin=ORIGIN)
    # block 2 is nearest to node 1, where the destination is; node 2 has no street
    assert rows(got) == [(0, 1, "walk", 5.0, 7.0), (1, 1, "walk", 0.0, 0.0), (2, 1, "walk", 0.0, 0.0)]
    empty = edges.limit(0)
    assert od_network(empty, *args[1:], plane_origin=ORIGIN).collect() == []
