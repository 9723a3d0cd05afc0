"""Origin-destination tables by population.

The analysis routes every origin to two destination sets (all destinations in
scope, and those that also serve the sub-population) and keeps one OD table
per set. Here the OD table is computed or read once; each row is tagged with
the populations its destination serves, so one pass over the OD feeds every
population (the sub-population table is the semi join of the full one on the
sub-population's destinations).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..session import checked_broadcast, materialize

DEFAULT_POPULATIONS: dict[str, tuple[str, ...]] = {"all": ("in_scope",), "sub": ("in_scope", "sub")}


def destination_subset(dests: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Destinations whose boolean ``flags`` are all true (a NULL flag drops the
    destination)."""
    cond = F.lit(True)
    for f in flags:
        cond = cond & F.col(f)
    return dests.where(cond)


def od_for_destinations(od: DataFrame, dests: DataFrame, flags: Sequence[str]) -> DataFrame:
    """The OD rows whose destination has every flag: a left semi join."""
    keep = destination_subset(dests, flags).select("dest_id")
    return od.join(checked_broadcast(keep), "dest_id", "left_semi")


def od_by_population(
    od: DataFrame,
    dests: DataFrame,
    populations: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """``od`` rows with a ``population`` column, one row per population the
    destination serves. ``populations`` maps a name to the destination flags
    that must all hold. Destinations outside every population are dropped.
    """
    populations = dict(populations or DEFAULT_POPULATIONS)
    tags = []
    for name, flags in populations.items():
        cond = F.lit(True)
        for f in flags:
            cond = cond & F.coalesce(F.col(f), F.lit(False))
        tags.append(F.when(cond, F.lit(name)))
    # One row per (destination, population) it serves: the fan-out happens
    # on the destination table, so the OD rows meet it in a plain equi-join
    # (code-generated, no per-row array functions).
    tagged = dests.select("dest_id", F.explode(F.array(*tags)).alias("population")).where(
        F.col("population").isNotNull())
    return od.join(checked_broadcast(tagged), "dest_id").select(*od.columns, "population")


# Straight-line proxy per travel mode -- detour factor (road
# distance / straight-line distance) and speed in km/h.
STRAIGHT_LINE_MODES: dict[str, tuple[float, float]] = {"auto": (1.3, 40.0), "pedestrian": (1.2, 5.0)}


# Destinations of a node of the density pyramid that is not divided further, for
# every one that is asked for; children of a node on each side.
LEAF = 4
SPLIT = 4

# Origins whose candidates one task holds and sorts. Fewer save next to nothing: each
# step down has its own sort, and a sort takes a memory page at least.
ORIGINS_PER_TASK = 8192


def density_pyramid(dests: DataFrame, ext: Row, k: int, cell_m: float = 1.0) -> tuple[DataFrame, DataFrame, list, int]:
    """Square nodes over ``dests`` (``dest_id, dx, dy`` on a plane, from ``a`` to
    ``b`` and from ``c`` to ``d`` of ``ext``), each ``SPLIT``
    times as wide as the next smaller ones, as far down as they hold more than
    ``LEAF * k`` destinations (or to ``cell_m``): a dense town gets small nodes,
    empty land large ones.

    Returns the steps down (``level, cx, cy`` of a node and ``n``, the bounding
    box and ``to_level, to_cx, to_cy`` of each node below it; a leaf leads to
    itself), the destinations with their leaf, the top nodes (four at most) and
    the number of steps from the top to the deepest leaf."""
    widest = max(ext["b"] - ext["a"], ext["d"] - ext["c"], cell_m)
    top = max(1, math.ceil(math.log(widest / cell_m, SPLIT) + 1e-9))

    def at(level: Column) -> list[Column]:
        side = F.pow(F.lit(float(SPLIT)), level) * F.lit(float(cell_m))
        return [F.floor(F.col("dx") / side).alias("cx"), F.floor(F.col("dy") / side).alias("cy")]

    level = F.col("level")
    placed = dests.select("*", F.explode(F.sequence(F.lit(0), F.lit(top))).alias("level")).select("dest_id", "dx", "dy", "level", *at(level))
    key = ["level", "cx", "cy"]
    nodes = materialize(placed.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.min("dx").alias("x0"), F.max("dx").alias("x1"), F.min("dy").alias("y0"), F.max("dy").alias("y1")))
    inner = (F.col("n") > LEAF * k) & (F.col("level") > 0)
    up = [(F.col("level") + 1).alias("level"), F.floor(F.col("cx") / SPLIT).alias("cx"), F.floor(F.col("cy") / SPLIT).alias("cy")]
    divided = nodes.where(inner).select(*key)
    below = nodes.select(*up, "n", "x0", "x1", "y0", "y1", *[F.col(c).alias(f"to_{c}") for c in key]).join(divided, key, "left_semi")
    roots = nodes.where(level == top)
    leaves = below.where(~((F.col("n") > LEAF * k) & (F.col("to_level") > 0))).select(
        *[F.col(f"to_{c}").alias(c) for c in key], "n", "x0", "x1", "y0", "y1").unionByName(roots.where(~inner).select(*key, "n", "x0", "x1", "y0", "y1"))
    steps = materialize(below.unionByName(leaves.withColumns({f"to_{c}": F.col(c) for c in key})))
    own_leaf = materialize(placed.join(steps.where("to_level = level").select(*key), key, "left_semi"))
    seen = steps.agg(F.min("to_level").alias("deepest"), F.collect_set(F.when(level == top, F.struct(*key))).alias("roots")).first()
    return steps, own_leaf, seen["roots"], top - seen["deepest"]


def nearest_destinations(
    origins: DataFrame,
    dests: DataFrame,
    k: int = 5,
    cell_m: float | None = None,
    plane_origin: tuple[float, float] | None = None,
) -> DataFrame:
    """The ``k`` nearest destinations of every origin by straight-line
    distance: block_id, dest_id, dist_m. Ties are broken by ``dest_id``.

    Exact, without a cross join, by a walk down a density pyramid
    (:func:`density_pyramid`). An origin holds the nodes that may contain one of
    its ``k`` nearest: the distance within which whole nodes hold ``k``
    destinations bounds the answer, and nodes that begin beyond it are out. Each
    step replaces the nodes by those below them; at the end only the
    destinations of a few small leaves are measured. How many that are depends on
    ``k``, not on the densities around: an origin on empty land beside a town
    meets the town's small nodes and drops all but the nearest. The nodes meet
    the origins in an equi-join (broadcast while their stored size is small), so
    the origins are shuffled once; all steps are one plan. ``cell_m`` is the
    side of the smallest nodes (1 m)."""
    from .nearest import top_k_per_group

    pairs = nearest_candidates(origins, dests, k, cell_m, plane_origin)
    return top_k_per_group(pairs, ["block_id"], ["dist_m", "dest_id"], k)


def nearest_candidates(
    origins: DataFrame,
    dests: DataFrame,
    k: int = 5,
    cell_m: float | None = None,
    plane_origin: tuple[float, float] | None = None,
) -> DataFrame:
    """block_id, dest_id, dist_m: the destinations that
    :func:`nearest_destinations` measures for each origin, the ``k`` nearest
    among them."""
    from ..functions.geo import to_plane, valid_lonlat
    from .nearest import top_k_per_group

    spark = origins.sparkSession
    valid = valid_lonlat(F.col("lon"), F.col("lat"))
    o = origins.select("block_id", "lon", "lat").where(valid)
    d = dests.select("dest_id", "lon", "lat").where(valid)
    # Of destinations at one spot at most k can be among the k nearest (ties
    # go by dest_id), so a crowded address cannot outgrow a node.
    d = top_k_per_group(d, ["lon", "lat"], ["dest_id"], k)
    if plane_origin is None:
        st = d.agg(F.min("lon").alias("x0"), F.max("lon").alias("x1"), F.min("lat").alias("y0"), F.max("lat").alias("y1")).first()
        plane_origin = (0.0, 0.0) if st["x0"] is None else ((st["x0"] + st["x1"]) / 2.0, (st["y0"] + st["y1"]) / 2.0)
    dx, dy = to_plane(F.col("lon"), F.col("lat"), plane_origin)
    dm = materialize(d.select("dest_id", dx.alias("dx"), dy.alias("dy")))
    ext = dm.agg(F.min("dx").alias("a"), F.max("dx").alias("b"), F.min("dy").alias("c"), F.max("dy").alias("d")).first()
    if ext["a"] is None:
        return spark.range(0).select(
            F.lit(None).cast(origins.schema["block_id"].dataType).alias("block_id"),
            F.lit(None).cast(dests.schema["dest_id"].dataType).alias("dest_id"), F.lit(None).cast("double").alias("dist_m"))
    steps, own_leaf, roots, depth = density_pyramid(dm, ext, k, float(cell_m or 1.0))
    key = ["level", "cx", "cy"]
    first = F.array(*[F.struct(*[F.lit(r[c]).cast("int" if c == "level" else "long").alias(c) for c in key]) for r in roots])
    # by number, not left to the size of what is shuffled: an origin is one row
    # here and as many as it has candidates at the end
    tasks = -(-o.count() // ORIGINS_PER_TASK) or 1
    held = o.select("block_id", dx.alias("ox"), dy.alias("oy")).repartition(tasks, "block_id").select("*", F.inline(first))
    side = checked_broadcast(steps)
    ox, oy = F.col("ox"), F.col("oy")

    def gap(lo: str, hi: str, at: Column) -> Column:
        return F.greatest(F.col(lo) - at, at - F.col(hi), F.lit(0.0))

    def reach(lo: str, hi: str, at: Column) -> Column:
        return F.greatest(F.abs(F.col(lo) - at), F.abs(F.col(hi) - at))

    def length(x: Column, y: Column) -> Column:
        return F.sqrt(x * x + y * y)

    whole = Window.partitionBy("block_id")
    rising = whole.orderBy("_hi").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for _ in range(max(depth, 1)):
        met = held.join(side, key).select(
            "block_id", "ox", "oy", "n", *[F.col(f"to_{c}").alias(c) for c in key],
            length(gap("x0", "x1", ox), gap("y0", "y1", oy)).alias("_lo"), length(reach("x0", "x1", ox), reach("y0", "y1", oy)).alias("_hi"))
        met = met.withColumn("_sum", F.sum("n").over(rising))
        met = met.withColumn("_bound", F.min(F.when(F.col("_sum") >= k, F.col("_hi"))).over(whole))
        # slack for rounding; no bound: all destinations together are fewer than k
        held = met.where(F.col("_bound").isNull() | (F.col("_lo") <= F.col("_bound") * (1 + 1e-9) + 1e-6)).select("block_id", "ox", "oy", *key)
    return held.join(checked_broadcast(own_leaf), key).select(
        "block_id", "dest_id", length(F.col("dx") - ox, F.col("dy") - oy).alias("dist_m"))


def od_straight_line(
    origins: DataFrame,
    dests: DataFrame,
    k: int = 5,
    modes: dict[str, tuple[float, float]] | None = None,
    **kw,
) -> DataFrame:
    """Straight-line proxy of an OD table, restricted to each origin's ``k``
    nearest destinations (exact for nearest-k means with the same or a
    smaller k): block_id, dest_id, mode, distance (km, times the mode's detour
    factor), time (s, at the mode's speed). Road routing is not built; this is
    a proxy and only a proxy."""
    modes = dict(modes or STRAIGHT_LINE_MODES)
    near = nearest_destinations(origins, dests, k=k, **kw)
    rows = [F.struct(F.lit(name).alias("mode"), F.lit(float(f)).alias("_f"), F.lit(float(v)).alias("_v"))
            for name, (f, v) in modes.items()]
    x = near.select("block_id", "dest_id", "dist_m", F.inline(F.array(*rows)))
    dist_km = F.col("dist_m") / F.lit(1000.0) * F.col("_f")
    return x.select("block_id", "dest_id", "mode", dist_km.alias("distance"),
                    (dist_km / F.col("_v") * F.lit(3600.0)).alias("time"))


def od_straight_line_by_population(
    origins: DataFrame,
    dests: DataFrame,
    k: int = 5,
    populations: Mapping[str, Sequence[str]] | None = None,
    modes: dict[str, tuple[float, float]] | None = None,
    **kw,
) -> DataFrame:
    """:func:`od_straight_line` for every population on its own, with a
    ``population`` column: each keeps the ``k`` nearest destinations that serve
    it. (The ``k`` nearest of all destinations need not hold any that serves a
    sub-population, so one truncated table cannot stand for both.)
    ``dests``: dest_id, lon, lat and the flags."""
    parts = [
        od_straight_line(origins, destination_subset(dests, flags), k=k, modes=modes, **kw).withColumn("population", F.lit(name))
        for name, flags in dict(populations or DEFAULT_POPULATIONS).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
