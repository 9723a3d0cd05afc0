"""Network search from both ends, islands told by their neighbours, chains."""

import random
from collections import Counter

import pytest

from catchment.operators import network
from test_network import EDGE, brute_labels

SEED = "mode string, population string, dest_id long, node long"


def layered_labels(edges, seeds, wanted, k, cost):
    """(mode, population, node) -> labels, of the wanted ones."""
    want = {}
    for pop in {s[1] for s in seeds}:
        found = brute_labels(edges, [(m, d, n) for m, p, d, n in seeds if p == pop], k, cost)
        want |= {(m, pop, n): v for (m, n), v in found.items()}
    return {x: want[x] for x in wanted if x in want}


def searched(spark, edges, seeds, wanted, n_nodes, k, cost):
    got = network.labels_at(spark.createDataFrame(edges, EDGE), spark.createDataFrame(seeds, SEED),
                            spark.createDataFrame(wanted, "mode string, population string, node long"), n_nodes, k, cost)
    found = {}
    for r in got.collect():
        c, d = (r.time, r.distance) if cost == "time" else (r.distance, r.time)
        found.setdefault((r["mode"], r.population, r.node), []).append((c, d, r.dest_id))
    return {x: sorted(v) for x, v in found.items()}


def street_net(rnd, n):
    """Blocks of a town with one-way and free streets, parallel ones, loops, a node
    with very many streets, and a dead end that leads nowhere."""
    side = int(n ** 0.5)
    edges = []
    for i in range(side * side):
        for j in ([i + 1] if (i + 1) % side else []) + ([i + side] if i + side < side * side else []):
            for a, b in ((i, j), (j, i)):
                if rnd.random() < 0.9:
                    edges.append(("auto", a, b, float(rnd.randrange(0, 9)), float(rnd.randrange(0, 6))))
    edges += [("auto", 5, i, 30.0, 30.0) for i in range(side * side)] + [("auto", 3, 3, 0.0, 0.0), ("auto", 7, 8, 1.0, 0.0), ("auto", 7, 8, 0.0, 1.0)]
    edges += [("auto", 10_000 + i, 10_001 + i, 1.0, 1.0) for i in range(5)] + [("auto", 11, 10_000, 1.0, 1.0)]
    return edges, side * side + 6


def test_search_from_both_ends(spark, monkeypatch):
    """Begun with so few nodes around each place that it has to take more."""
    rnd = random.Random(11)
    edges, n = street_net(rnd, 144)
    edges += [("walk", a, b, d + 1.0, t + 2.0) for _, a, b, d, t in edges if a != 5]
    seeds = [(m, p, d, rnd.randrange(144)) for d in range(6) for m in ("auto", "walk") for p in ("all", "sub") if p == "all" or d % 2]
    seeds += [("auto", "all", 100 + d, 44) for d in range(7)]  # more than k at one node, which is asked for
    wanted = [(m, p, x) for m in ("auto", "walk") for p in ("all", "sub") for x in (44, 5, 143, 10_002)]
    monkeypatch.setattr(network, "MEET", 0)
    monkeypatch.setattr(network, "network_labels", lambda *a, **k: pytest.fail("labels of all nodes"))
    got = searched(spark, edges, seeds, wanted, 100 * n, 3, "time")  # as in a network a hundred times as large
    assert got == layered_labels(edges, seeds, wanted, 3, "time") and ("auto", "all", 10_002) not in got


def test_search_of_all_nodes_takes_labels(spark, monkeypatch):
    rnd, called, plain = random.Random(4), [], network.network_labels
    edges, n = street_net(rnd, 64)
    seeds = [("auto", "all", d, rnd.randrange(64)) for d in range(9)]
    wanted = [("auto", "all", x) for x in range(64)]
    monkeypatch.setattr(network, "network_labels", lambda *a, **k: called.append(1) or plain(*a, **k))
    assert searched(spark, edges, seeds, wanted, n, 2, "time") == layered_labels(edges, seeds, wanted, 2, "time")
    assert called == [1]
    assert searched(spark, edges, seeds[:0], wanted, n, 2, "time") == {}


def test_few_places_in_a_large_network(spark, monkeypatch):
    """What is stored follows the places, not the labels of all nodes."""
    rnd = random.Random(2)
    edges, n = street_net(rnd, 900)
    seeds = [("auto", "all", d, x) for d, x in enumerate((40, 41, 42, 600, 601, 602))]
    wanted = [("auto", "all", x) for x in (43, 603)]
    stored, sizes = network.materialize, []

    def keep(df):
        out = stored(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(network, "materialize", keep)
    got = searched(spark, edges, seeds, wanted, n, 2, "time")
    assert got == layered_labels(edges, seeds, wanted, 2, "time")
    assert max(sizes) < n


@pytest.mark.parametrize("least", [3, 5, 70])
def test_large_islands_without_a_search(spark, least):
    rnd = random.Random(least)
    edges = [("auto", a, b, 1.0, 1.0) for a, b in ((rnd.randrange(160), rnd.randrange(160)) for _ in range(95))]
    edges += [("walk", 1, x, 1.0, 1.0) for x in range(2, 80)] + [("walk", 900 + x, 901 + x, 1.0, 1.0) for x in range(6)]
    edges += [("walk", 80, 81, 1.0, 1.0), ("walk", 81, 82, 1.0, 1.0), ("walk", 82, 2, 1.0, 1.0), ("walk", 500, 500, 1.0, 1.0)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for m, a, b, *_ in edges:
        root[find((m, a))] = find((m, b))
    size = Counter(find(x) for x in list(root))
    want = [e for e in edges if size[find((e[0], e[1]))] >= least]
    net, nodes = network.network_parts(spark.createDataFrame(edges, EDGE), least)
    assert Counter(map(tuple, net.collect())) == Counter(want)
    assert sorted(map(tuple, nodes.collect())) == sorted({(e[0], x) for e in want for x in e[1:3]})


def test_a_chain_of_rising_numbers_takes_few_rounds(spark, monkeypatch):
    chain = spark.createDataFrame([("auto", i, i + 1, 1.0, 1.0) for i in range(200)], EDGE)
    stored, rounds = network.materialize, []

    def counted(df):
        rounds.append("a" in df.columns)
        assert sum(rounds) < 25
        return stored(df)

    monkeypatch.setattr(network, "materialize", counted)
    assert {r.island for r in network.islands(chain).collect()} == {0}


def test_means_over_the_network_need_no_exchange(spark, monkeypatch):
    """The OD rows are dealt by origin, by number, before there is one per destination."""
    from catchment.operators.nearest import nearest_k_mean

    monkeypatch.setattr(network, "ROWS_PER_TASK", 1)
    place = "long, lon double, lat double"
    at = [(i, -75.7 + 0.01 * i, 45.4) for i in range(6)]
    edges = [("auto", a, b, 100.0, 10.0) for i in range(5) for a, b in ((i, i + 1), (i + 1, i))]
    # places that come twice, one of them at two spots: the nearest node of all is its own
    od = network.od_network(spark.createDataFrame(edges, EDGE), spark.createDataFrame(at, f"node {place}"), spark.createDataFrame(
        at * 2 + [(5, -75.7, 45.5)], f"block_id {place}"), spark.createDataFrame(at[:3], f"dest_id {place}"), k=2, min_reachability=1)
    assert od.count() == 12 and od.rdd.getNumPartitions() >= 12
    means = nearest_k_mean(od, keys=["block_id", "mode"], k=2)
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    got = {r.block_id: (r.avg_dist, r.avg_time * 60) for r in means.collect()}
    assert got == {0: (50.0, 5.0), 1: (50.0, 5.0), 2: (50.0, 5.0), 3: (150.0, 15.0), 4: (250.0, 25.0), 5: (350.0, 35.0)}
