"""Origin-destination costs over a street network.

The network is an edge table (``mode, from_node, to_node, distance, time``; one
row per direction and mode). Destinations are the sources of one search for all
origins at once: every node keeps at most ``k`` labels (destination, cost of the
best path to it), and labels move against the edges, round by round, until none
improves. A label that is not among the ``k`` best of a node cannot be among the
``k`` best of a node before it (both take the same way on), so nothing is lost
and no row is ever made for a pair of origin and destination that is not among
the results. Each round joins only the labels that changed with the edges;
labels of a node are ranked with a partial limit before the shuffle, so a node
with very many streets hands on ``k`` rows per task.

Places are tied to the nearest node of a large enough island of the network:
nodes that fewer than ``min_reachability`` nodes are connected with (in either
direction) are left out for that mode, as a routing service does with its minimum
reachability. Each round's state is written to the shared ``spark.checkpoint.dir``.

Edges without a node, a mode or a finite cost that is not negative are dropped.
Places without valid coordinates get no row, nor do origins that reach nothing.
Equal costs go to the smaller distance, then to the smaller ``dest_id``; equally
near nodes to the smaller node.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import DEFAULT_BROADCAST_BYTES, checked_broadcast, estimated_bytes, materialize
from .nearest import top_k_per_group
from .od import destination_subset, nearest_destinations

MEASURES = ("distance", "time")
# A search from both ends begins with so many nodes around each place that the nodes
# around both ends would meet MEET * k times if all lay evenly, and takes WIDER times
# as many next for the places that are not done.
MEET = 4
WIDER = 4
# Rows of the OD table that are made by one task.
ROWS_PER_TASK = 250_000
# Bits in which a node's neighbours are told apart.
BITS = 64


def usable_edges(edges: DataFrame) -> DataFrame:
    """``mode, from_node, to_node, distance, time`` of the edges that count."""
    fine = F.col("mode").isNotNull() & F.col("from_node").isNotNull() & F.col("to_node").isNotNull()
    for m in MEASURES:
        fine = fine & (F.col(m) >= F.lit(0.0)) & (F.col(m) < F.lit(float("inf")))
    return edges.where(fine).select("mode", "from_node", "to_node", *[F.col(m).cast("double").alias(m) for m in MEASURES])


def islands(edges: DataFrame) -> DataFrame:
    """``mode, node, island``: the connected parts of each mode's network,
    direction left aside, named by their smallest node. Every round a node takes
    the first among its neighbours, then that one's own, in an order drawn anew for
    the round: the number of rounds grows with the logarithm of a part's width, also
    along a chain of rising numbers. After a round the streets lead between the nodes
    taken, and those within one are gone, so only the first round meets all streets."""
    def pairs(rows: DataFrame) -> DataFrame:
        return materialize(rows.where("a <> b").select("mode", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    def nodes(rows: DataFrame) -> DataFrame:
        return rows.select("mode", F.explode(F.array("a", "b")).alias("node"))

    ends = edges.select("mode", F.col("from_node").alias("a"), F.col("to_node").alias("b"))
    names = nodes(ends).distinct().withColumn("island", F.col("node"))
    ends, rounds = pairs(ends), 0

    def drawn(node: str) -> Column:
        return F.struct(F.xxhash64(F.lit(rounds), node), F.col(node).alias("node"))

    while not ends.isEmpty():
        both = ends.select("mode", F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                                                    F.struct(F.col("b").alias("node"), F.col("a").alias("other")))))
        near = materialize(both.groupBy("mode", "node").agg(F.min(drawn("other")).alias("_near")).select(
            "mode", "node", F.least(drawn("node"), "_near")["node"].alias("_near")))
        jump = near.select("mode", F.col("node").alias("_near"), F.col("_near").alias("_next"))
        taken = materialize(near.join(jump, ["mode", "_near"]).select("mode", "node", F.col("_next").alias("_to")))
        names = materialize(names.join(taken.withColumnRenamed("node", "island"), ["mode", "island"], "left").select(
            "mode", "node", F.coalesce("_to", "island").alias("island")))
        for end in ("a", "b"):
            ends = ends.join(taken.withColumnRenamed("node", end), ["mode", end]).drop(end).withColumnRenamed("_to", end)
        ends, rounds = pairs(ends), rounds + 1
    if not rounds:
        return names
    smallest = names.groupBy("mode", "island").agg(F.min("node").alias("_to"))
    return names.join(smallest, ["mode", "island"]).select("mode", "node", F.col("_to").alias("island"))


def network_nodes(edges: DataFrame, min_reachability: int) -> tuple[DataFrame, DataFrame | None]:
    """``mode, node`` of the islands that have at least ``min_reachability`` nodes,
    and of the smaller ones (None where every island counts).

    A node with so many neighbours less one needs no search: its neighbours are
    told apart by one bit of their hash each, so they are as many as the bits at
    least. Islands are searched among the other nodes and the streets between
    them; one that leads to a node with many neighbours is large."""
    pair = ["mode", "node"]
    both = edges.select("mode", F.inline(F.array(F.struct(F.col("from_node").alias("node"), F.col("to_node").alias("other")),
                                                 F.struct(F.col("to_node").alias("node"), F.col("from_node").alias("other")))))
    if min_reachability <= 1:
        return materialize(both.select(*pair).distinct()), None
    if min_reachability > BITS + 1:
        names, leads = materialize(islands(edges)), None
        sure = names.limit(0).select(*pair)
    else:
        bit = F.when(F.col("other") != F.col("node"), F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64("other"), F.lit(BITS)).cast("int"))).otherwise(F.lit(0).cast("long"))
        known = materialize(both.groupBy(*pair).agg((F.bit_count(F.bit_or(bit)) >= min_reachability - 1).alias("_sure")))
        sure, loose = known.where("_sure").select(*pair), materialize(known.where("not _sure").select(*pair))
        if loose.isEmpty():
            return sure, loose
        side = loose.withColumn("_loose", F.lit(True))
        ends = edges.select("mode", "from_node", "to_node")
        for end in ("from", "to"):
            part = side.select("mode", F.col("node").alias(f"{end}_node"), F.col("_loose").alias(f"_{end}"))
            ends = ends.join(checked_broadcast(part), ["mode", f"{end}_node"], "left")
        ends = materialize(ends.where("_from or _to"))
        names = loose.join(islands(ends.where("_from and _to")), pair, "left").select(*pair, F.coalesce("island", "node").alias("island"))
        leads = ends.where("_from is null").select("mode", F.col("to_node").alias("node")).union(
            ends.where("_to is null").select("mode", F.col("from_node").alias("node"))).distinct().withColumn("_leads", F.lit(True))
    if leads is None:
        leads = sure.withColumn("_leads", F.lit(True))
    names = names.join(leads, pair, "left")
    counts = names.groupBy("mode", "island").agg(F.count(F.lit(1)).alias("_n"), F.max("_leads").alias("_large"))
    named = materialize(names.drop("_leads").join(counts, ["mode", "island"]).select(
        *pair, (F.coalesce("_large", F.lit(False)) | (F.col("_n") >= min_reachability)).alias("_large")))
    return sure.unionByName(named.where("_large").select(*pair)), materialize(named.where("not _large").select(*pair))


def reachable_network(edges: DataFrame, min_reachability: int) -> DataFrame:
    """The usable edges whose island has at least ``min_reachability`` nodes."""
    return network_parts(edges, min_reachability)[0]


def network_parts(edges: DataFrame, min_reachability: int) -> tuple[DataFrame, DataFrame]:
    """:func:`reachable_network` and the nodes of its edges (``mode, node``)."""
    edges = materialize(usable_edges(edges))  # read for the islands and once more for what is kept
    nodes, gone = network_nodes(edges, min_reachability)
    if gone is None or gone.isEmpty():
        return edges, nodes
    kept = edges.join(checked_broadcast(gone.withColumnRenamed("node", "from_node")), ["mode", "from_node"], "left_anti").select(*edges.columns)
    size = estimated_bytes(gone)
    return (kept if size is not None and size <= DEFAULT_BROADCAST_BYTES else materialize(kept)), nodes


def snap(places: DataFrame, met: DataFrame, nodes: DataFrame, modes: Sequence[str], **kw) -> DataFrame:
    """``place, mode, node``: the nearest node of each mode's network (``met``:
    ``mode, node``) for every place (``place, lon, lat``). Places at one spot
    have one nearest node: it is searched once."""
    out = None
    spots = materialize(places.select("lon", "lat").distinct().select(F.struct("lon", "lat").alias("block_id"), "lon", "lat"))
    for mode in modes:
        own = met.where(F.col("mode") == mode).select("node")
        at = nodes.select("node", "lon", "lat").join(own, "node", "left_semi").withColumnRenamed("node", "dest_id")
        near = nearest_destinations(spots, at, k=1, **kw)
        part = near.select("block_id.lon", "block_id.lat", F.lit(mode).alias("mode"), "dist_m", F.col("dest_id").alias("node"))
        out = part if out is None else out.unionByName(part)
    # a place that comes several times has one row, the nearest of all
    return places.join(checked_broadcast(materialize(out)), ["lon", "lat"]).groupBy("place", "mode").agg(
        F.min(F.struct("dist_m", "node"))["node"].alias("node"))


def network_labels(edges: DataFrame, seeds: DataFrame, k: int = 5, cost: str = "time", max_rounds: int | None = None) -> DataFrame:
    """``*layers, node, dest_id, distance, time``: for every node the ``k``
    destinations with the cheapest way to them, by ``cost``, and both measures
    along that way. ``seeds``: ``mode, dest_id, node`` and any further layer
    columns (each combination of layers is searched on its own). ``max_rounds``
    bounds the number of edges of a way; reaching it with labels that still
    improve is an error."""
    if cost not in MEASURES:
        raise ValueError(f"cost is one of {MEASURES}, not {cost!r}")
    carried = next(m for m in MEASURES if m != cost)
    layers = [c for c in seeds.columns if c not in ("dest_id", "node")]
    where = [*layers, "node"]
    order = [cost, carried, "dest_id"]
    edges = materialize(edges.select("mode", "from_node", F.col("to_node").alias("node"), F.col(cost).alias("_c"), F.col(carried).alias("_d")))
    n_nodes = edges.agg(F.approx_count_distinct(F.struct("mode", "node"))).first()[0]
    start = seeds.where(F.col("node").isNotNull()).select(*where, "dest_id").distinct()
    start = start.withColumns({cost: F.lit(0.0), carried: F.lit(0.0), "_new": F.lit(1)})
    state = materialize(top_k_per_group(start, where, order, k))
    rounds = 0
    while True:
        moved = state.where("_new = 1")
        n_moved = moved.count()
        if not n_moved:
            return state.drop("_new")
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"labels still improve after {max_rounds} rounds")
        steps = moved.join(edges, ["mode", "node"])
        if n_moved > 2 * n_nodes:
            # Most labels come too late at a node that has k already: its streets
            # know its worst label of each layer before they meet the others' labels.
            full = state.groupBy(*where).agg(F.count(F.lit(1)).alias("_n"), F.max(cost).alias("_worst")).where(F.col("_n") >= k)
            worst = full.groupBy("mode", F.col("node").alias("from_node")).agg(F.map_from_entries(F.collect_list(
                F.struct(F.struct(*layers), "_worst"))).alias("_worst"))
            known = edges.join(worst, ["mode", "from_node"], "left")
            late = F.col("_c") + F.col(cost) > F.col("_worst")[F.struct(*layers)]
            steps = moved.join(known, ["mode", "node"]).where(~F.coalesce(late, F.lit(False)))
        steps = steps.select(
            *layers, F.col("from_node").alias("node"), "dest_id",
            (F.col("_c") + F.col(cost)).alias(cost), (F.col("_d") + F.col(carried)).alias(carried), F.lit(1).alias("_new"))
        # of equal ways the one that is known already stays
        best = state.withColumn("_new", F.lit(0)).unionByName(steps).groupBy(*where, "dest_id").agg(
            F.min(F.struct(cost, carried, "_new")).alias("_b")).select(*where, "dest_id", "_b.*")
        state = materialize(top_k_per_group(best, where, order, k))
        rounds += 1


def rows_at(rows: DataFrame, heads: DataFrame, at: Sequence[str]) -> DataFrame:
    """``rows`` joined with ``heads`` (one for each ``at``, few enough to be broadcast
    as a rule). All streets pass here every round: they are looked up by one number,
    which takes a fraction of the time that several columns with text in them take.
    That the columns are equal as well is written so that it adds no key to the join."""
    side = heads.withColumnsRenamed({c: f"{c}_at" for c in at}).withColumn("_h_at", F.xxhash64(*[f"{c}_at" for c in at]))
    same = F.col("_h") == F.col("_h_at")
    for c in at:
        same = same & (F.col(c) <= F.col(f"{c}_at")) & (F.col(c) >= F.col(f"{c}_at"))
    return rows.withColumn("_h", F.xxhash64(*at)).join(checked_broadcast(side), same).drop("_h", "_h_at", *[f"{c}_at" for c in at])


def nearest_nodes(ways: DataFrame, begin: DataFrame, most: int) -> DataFrame:
    """``side, mode, start, node, _c, _d, _radius``: the ``most`` nearest nodes of
    every start (by ``_c``, then ``_d``, then the node) over ``ways`` (``side, mode,
    node, to, _wc, _wd``). ``begin``: nodes known to begin with (``side, mode, start,
    node, _c, _d``), each start itself at least. ``_radius`` is the farthest one's
    ``_c``: every nearer node is among them, with its cheapest way; NULL if the start
    leads to fewer nodes. A node on the way to a near node is nearer, and of a node's
    own streets only the ``most`` cheapest can lead to such, so nothing is lost and a
    node with very many streets makes no more rows than that. Streets that lead out of
    every radius are left out before they meet a node."""
    key, at = ["side", "mode", "start"], ["side", "mode", "node"]
    whole = Window.partitionBy(*key)
    room = F.coalesce(F.col("_radius") - F.col("_c") + F.col("_radius") * F.lit(1e-9), F.lit(float("inf")))  # slack for rounding
    state = materialize(begin.select(*key, "node", "_c", "_d", F.lit(None).cast("double").alias("_radius"), F.lit(1).alias("_new")))
    while True:
        moved = state.where("_new = 1")
        largest = moved.agg(F.max(room)).first()[0]
        if largest is None:
            return state.drop("_new")
        heads = moved.groupBy(*at).agg(F.max(room).alias("_room"))
        out = rows_at(ways.where((F.col("_wc") <= F.lit(largest)) & (F.col("to") != F.col("node"))), heads, at).where("_wc <= _room").groupBy(*at, "to").agg(F.min(F.struct("_wc", "_wd")).alias("_w")).select(*at, "to", "_w.*")
        steps = moved.join(top_k_per_group(out, at, ["_wc", "_wd", "to"], most), at).where("_radius is null or _c + _wc <= _radius")
        steps = steps.select(*key, F.col("to").alias("node"), (F.col("_c") + F.col("_wc")).alias("_c"),
                             (F.col("_d") + F.col("_wd")).alias("_d"), F.lit(1).alias("_new"))
        # of equal ways the one that is known already stays
        best = state.drop("_radius").withColumn("_new", F.lit(0)).unionByName(steps).repartition(*key).groupBy(*key, "node").agg(
            F.min(F.struct("_c", "_d", "_new")).alias("_b")).select(*key, "node", "_b.*")
        state = materialize(top_k_per_group(best, key, ["_c", "_d", "node"], most).withColumn(
            "_radius", F.when(F.count(F.lit(1)).over(whole) >= most, F.max("_c").over(whole))))


def labels_at(edges: DataFrame, seeds: DataFrame, wanted: DataFrame, n_nodes: int, k: int = 5, cost: str = "time") -> DataFrame:
    """:func:`network_labels` of the ``wanted`` nodes alone (``*layers, node``), in a
    network of ``n_nodes`` (nodes of all modes together).

    Searched from both ends: the nearest nodes of each wanted node, and backwards
    those of each destination's node. Where every node nearer than ``r`` is known
    around the one and nearer than ``s`` around all of the others, every way shorter
    than ``r + s`` is a way out, one street, and a way in that are known; a wanted
    node is done when its ``k``-th label is cheaper than that, or when it leads no
    farther. The rest takes more nodes around. When these would be more rows than the
    labels of all nodes, those are computed instead: a search from every node of a
    network, or one from which hardly anything is reached, is no dearer than before."""
    carried = next(m for m in MEASURES if m != cost)
    layers = [c for c in seeds.columns if c not in ("dest_id", "node")]
    where, order = [*layers, "node"], [cost, carried, "dest_id"]
    columns = [*where, "dest_id", *MEASURES]
    zero = {cost: F.lit(0.0), carried: F.lit(0.0)}
    first = materialize(top_k_per_group(seeds.where(F.col("node").isNotNull()).select(*where, "dest_id").distinct(), where, "dest_id", k).withColumns(zero))
    left = materialize(wanted.select(*where).distinct())
    streets = edges.select("mode", "from_node", "to_node", F.col(cost).alias("_wc"), F.col(carried).alias("_wd"))
    ways = streets.select(F.lit("o").alias("side"), "mode", F.col("from_node").alias("node"), F.col("to_node").alias("to"), "_wc", "_wd").union(
        streets.select(F.lit("d").alias("side"), "mode", F.col("to_node").alias("node"), F.col("from_node").alias("to"), "_wc", "_wd"))

    def done(found: DataFrame, reach: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The labels that are settled, as ``reach`` (``mode, node, _reach``; NULL:
        no end) says, and the wanted nodes that are left."""
        worst = found.groupBy(*where).agg(F.count(F.lit(1)).alias("_n"), F.max(cost).alias("_worst"))
        settled = F.col("_reach").isNull() | ((F.col("_n") >= k) & (F.col("_worst") < F.col("_reach") * (1 - 1e-9)))  # slack for rounding
        seen = materialize(left.join(reach, ["mode", "node"], "left").join(worst, where, "left").select(
            *where, F.coalesce(settled, F.lit(False)).alias("_done")))
        return found.join(seen.where("_done"), where, "left_semi").select(*columns), seen.where("not _done").select(*where)

    # what lies at the node itself, where any street costs more than nothing
    least = materialize(streets.groupBy("mode").agg(F.min("_wc").alias("_reach")))
    out, left = done(first.join(left, where, "left_semi"), left.select("mode", "node").distinct().join(least, "mode"))
    begin, most = None, 0
    while not left.isEmpty():
        starts = left.select(F.lit("o").alias("side"), "mode", F.col("node").alias("start")).union(
            first.join(left.select(*layers).distinct(), layers, "left_semi").select(F.lit("d"), "mode", "node")).distinct()
        own = starts.select("*", F.col("start").alias("node"), F.lit(0.0).alias("_c"), F.lit(0.0).alias("_d"))
        n_starts, n_back = starts.agg(F.count(F.lit(1)), F.count_if(F.col("side") == "d")).first()
        most = most or max(16, math.ceil(math.sqrt(MEET * k * n_nodes / max(n_back, 1))))
        if n_starts * most > k * n_nodes:
            rest = network_labels(edges, seeds, k, cost).join(left, where, "left_semi")
            return out.unionByName(rest.select(*columns))
        balls = nearest_nodes(ways, own if begin is None else begin.join(starts, ["side", "mode", "start"], "left_semi"), most)
        away, back = balls.where("side = 'o'"), balls.where("side = 'd'")
        known = back.select("mode", F.col("start").alias("_at"), "node", "_c", "_d").join(
            first.join(left.select(*layers).distinct(), layers, "left_semi").withColumnRenamed("node", "_at").drop(*MEASURES), ["mode", "_at"]).select(
            *where, "dest_id", F.col("_c").alias(cost), F.col("_d").alias(carried))
        known = materialize(top_k_per_group(best_ways(known, where, order), where, order, k))
        heads = away.select("mode", "node").distinct()
        bridge = rows_at(streets, heads.withColumnRenamed("node", "from_node"), ["mode", "from_node"]).join(
            known.withColumnRenamed("node", "to_node"), ["mode", "to_node"]).select(
            *layers, F.col("from_node").alias("node"), "dest_id", (F.col("_wc") + F.col(cost)).alias(cost), (F.col("_wd") + F.col(carried)).alias(carried))
        bridge = top_k_per_group(best_ways(bridge.unionByName(known.join(checked_broadcast(heads), ["mode", "node"], "left_semi")), where, order), where, order, k)
        found = away.select("mode", "start", "node", "_c", "_d").join(bridge, ["mode", "node"]).select(
            *layers, F.col("start").alias("node"), "dest_id", (F.col("_c") + F.col(cost)).alias(cost), (F.col("_d") + F.col(carried)).alias(carried))
        found = materialize(top_k_per_group(best_ways(found.join(left, where, "left_semi"), where, order), where, order, k))
        # no end on one of the sides (no destination at all is none either): all ways are known
        behind = back.groupBy("mode").agg(F.min("_radius").alias("_behind"))
        reach = away.groupBy("mode", F.col("start").alias("node")).agg(F.max("_radius").alias("_ahead")).join(behind, "mode", "left").select(
            "mode", "node", (F.col("_ahead") + F.col("_behind")).alias("_reach"))
        more, left = done(found, reach)
        out, begin, most = out.unionByName(more), balls, most * WIDER
    return out


def best_ways(rows: DataFrame, where: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The cheapest row of each destination of a node."""
    measures = [c for c in order if c != "dest_id"]
    return rows.groupBy(*where, "dest_id").agg(F.min(F.struct(*measures)).alias("_b")).select(*where, "dest_id", "_b.*")


def od_network(
    edges: DataFrame,
    nodes: DataFrame,
    origins: DataFrame,
    dests: DataFrame,
    k: int = 5,
    cost: str = "time",
    min_reachability: int = 500,
    modes: Sequence[str] | None = None,
    populations: Mapping[str, Sequence[str]] | None = None,
    **kw,
) -> DataFrame:
    """OD table over the network, restricted to each origin's ``k`` cheapest
    destinations by ``cost``: ``block_id, dest_id, mode, distance, time`` and,
    with ``populations`` (name -> flags that a destination must have),
    ``population``: each keeps the ``k`` cheapest that serve it.

    ``nodes``: ``node, lon, lat``; ``origins``: ``block_id, lon, lat``;
    ``dests``: ``dest_id, lon, lat`` and the flags. The way from a place to its
    node costs nothing. ``kw`` goes to the search of the nearest node."""
    net, met = network_parts(edges, min_reachability)
    if modes is None:
        modes = sorted(r[0] for r in met.select("mode").distinct().collect())  # a handful of travel modes
    id_o, id_d = origins.schema["block_id"].dataType, dests.schema["dest_id"].dataType
    tags = {"all": ()} if populations is None else dict(populations)
    places = origins.select(F.struct(F.lit("o").alias("kind"), F.col("block_id").cast("string").alias("id")).alias("place"), "lon", "lat").union(
        dests.select(F.struct(F.lit("d").alias("kind"), F.col("dest_id").cast("string").alias("id")).alias("place"), "lon", "lat"))
    empty = edges.sparkSession.createDataFrame([], "place struct<kind string, id string>, mode string").withColumn(
        "node", F.lit(None).cast(nodes.schema["node"].dataType))
    tied = snap(places, met, nodes, modes, **kw) if modes else empty
    tied = materialize(tied.select("place.kind", "place.id", "mode", "node"))
    at_dest = tied.where("kind = 'd'").select(F.col("id").cast(id_d).alias("dest_id"), "mode", "node")
    seeds = None
    for name, flags in tags.items():
        part = at_dest.join(destination_subset(dests, flags).select("dest_id").distinct(), "dest_id", "left_semi").withColumn(
            "population", F.lit(name))
        seeds = part if seeds is None else seeds.unionByName(part)
    at_origin = tied.where("kind = 'o'").select(F.col("id").cast(id_o).alias("block_id"), "mode", "node")
    wanted = at_origin.select("mode", "node").distinct().select("mode", F.explode(F.array(*map(F.lit, tags))).alias("population"), "node")
    labels = materialize(labels_at(net, seeds.select("mode", "population", "dest_id", "node"), wanted, met.count(), k, cost))
    size = estimated_bytes(labels)
    if size is not None and size <= DEFAULT_BROADCAST_BYTES:
        # dealt by origin before there is a row per destination: what ranks an origin's rows needs no other exchange
        n_rows = at_origin.count() * len(tags) * k
        at_origin = at_origin.repartition(max(edges.sparkSession.sparkContext.defaultParallelism, -(-n_rows // ROWS_PER_TASK)), "block_id")
        labels = F.broadcast(labels)
    out = at_origin.join(labels, ["mode", "node"]).select("block_id", "dest_id", "mode", *MEASURES, "population")
    return out if populations is not None else out.drop("population")
