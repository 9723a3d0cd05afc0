"""Geometry as column expressions.

Points are ``lon``/``lat`` doubles (WGS84); a zone outline is
``rings: array<array<struct<x:double,y:double>>>`` (lon/lat), the first ring
the outline and further rings holes, each ring closed or not. Metric work
happens on a local metre plane around an origin (an equirectangular
projection): ``x = R cos(lat0) dlon``, ``y = R dlat``. Over a city this is
accurate to well under 1 %, enough for tolerances of tens of metres; the national
grid's projection is in :mod:`.projection`.

Point-in-zone tests are array higher-order functions over edges of all rings:
the parity of the edges crossed on the way to a point of known status (so holes
are outside), and the squared distance to the nearest edge (for a tolerance buffer).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8
DEG = math.pi / 180.0


def plane_scale(lat0: float) -> tuple[float, float]:
    """Metres per degree of longitude and of latitude at latitude ``lat0``."""
    return EARTH_RADIUS_M * math.cos(lat0 * DEG) * DEG, EARTH_RADIUS_M * DEG


def valid_lonlat(lon: Column, lat: Column) -> Column:
    """True where both coordinates are present, finite and in range."""
    return F.coalesce(lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0), F.lit(False))


def to_plane(lon: Column, lat: Column, origin: tuple[float, float]) -> tuple[Column, Column]:
    """(x, y) metres of lon/lat columns on the plane around ``origin``."""
    kx, ky = plane_scale(origin[1])
    return (lon - F.lit(origin[0])) * F.lit(kx), (lat - F.lit(origin[1])) * F.lit(ky)


def close_rings(rings: Column) -> Column:
    """Append the first vertex to every ring that does not end with it."""
    return F.transform(
        rings,
        lambda r: F.when(F.element_at(r, 1) == F.element_at(r, -1), r).otherwise(
            F.concat(r, F.array(F.element_at(r, 1)))
        ),
    )


def rings_bbox(rings: Column) -> Column:
    """struct(min_x, min_y, max_x, max_y) over all vertices."""
    xs = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["x"])))
    ys = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["y"])))
    return F.struct(
        F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"),
        F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"),
    )


def ring_edges(rings_m: Column) -> Column:
    """array<struct<x1,y1,x2,y2>> of every edge of every (closed) ring."""
    per_ring = F.transform(
        rings_m,
        lambda r: F.transform(
            F.sequence(F.lit(0), F.size(r) - 2),
            lambda i: F.struct(
                F.element_at(r, i + 1)["x"].alias("x1"), F.element_at(r, i + 1)["y"].alias("y1"),
                F.element_at(r, i + 2)["x"].alias("x2"), F.element_at(r, i + 2)["y"].alias("y2"),
            ),
        ),
    )
    return F.flatten(per_ring)


def dist2_to_edge(e: Column, px: Column, py: Column) -> Column:
    """Squared distance from (px, py) to edge ``e``."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    len2 = dx * dx + dy * dy
    t = F.when(
        len2 > F.lit(0.0),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - e["x1"]) * dx + (py - e["y1"]) * dy) / len2)),
    ).otherwise(F.lit(0.0))
    ex = e["x1"] + t * dx - px
    ey = e["y1"] + t * dy - py
    return ex * ex + ey * ey


def path_parity(edges: Column, px: Column, py: Column, rx: Column, ry: Column) -> Column:
    """The path (px, py) -> (rx, py) -> (rx, ry) crosses an odd number of
    ``edges`` (half-open rules on both legs)."""

    def crossed(e: Column) -> Column:
        at_x = px_at(e, py)
        at_y = py_at(e, rx)
        level = F.when((e["y1"] > py) != (e["y2"] > py), (px < at_x) != (rx < at_x)).otherwise(F.lit(False))
        upright = F.when((e["x1"] > rx) != (e["x2"] > rx), (py < at_y) != (ry < at_y)).otherwise(F.lit(False))
        return level != upright

    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != crossed(e))


def px_at(e: Column, y: Column) -> Column:
    """Where edge ``e`` (not horizontal) meets the level line ``y``."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]


def py_at(e: Column, x: Column) -> Column:
    """Where edge ``e`` (not upright) meets the upright line ``x``."""
    return (e["y2"] - e["y1"]) * (x - e["x1"]) / (e["x2"] - e["x1"]) + e["y1"]


def signed_area(ring_m: Column) -> Column:
    """Area of a closed ring, positive when it runs counter-clockwise."""
    return F.aggregate(
        F.sequence(F.lit(1), F.size(ring_m) - 1), F.lit(0.0),
        lambda a, i: a + (F.element_at(ring_m, i)["x"] * F.element_at(ring_m, i + 1)["y"]
                          - F.element_at(ring_m, i + 1)["x"] * F.element_at(ring_m, i)["y"]) / F.lit(2.0))


def _without_repeats(ring_m: Column) -> Column:
    """A closed ring without vertices that repeat the one before."""
    return F.filter(ring_m, lambda p, i: (i == 0) | (p != F.element_at(ring_m, F.greatest(i, F.lit(1)))))


def buffer_rings(rings_m: Column, distance: float, arc_steps: int = 16) -> Column:
    """Outlines of the zone widened by ``distance`` metres: one closed curve per
    ring, to be read with :func:`winding_number` (above 0: inside). ``rings_m``
    are closed, the first ring of a part the outline and further ones holes;
    each is turned so that the zone lies on its left.

    Every edge is moved ``distance`` to its right; where the next edge turns
    left, an arc around the corner joins the two (a quarter circle has
    ``arc_steps`` chords, which stay inside the true buffer by at most
    ``distance * (1 - cos(pi / (4 * arc_steps)))``); where it turns right, the
    curve goes by the corner itself, and the loop that this makes does not count.
    A ring lies in as many others as say whether it is an outline or a hole."""
    d, step = F.lit(float(distance)), F.lit(math.pi / 2.0 / arc_steps)

    def edge(ring: Column, i: Column) -> Column:
        """Edge ``i`` (from 0) of an open ring of ``n`` vertices, with its direction."""
        n = F.size(ring)
        p, q = F.element_at(ring, i % n + 1), F.element_at(ring, (i + 1) % n + 1)
        return F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"),
                        F.atan2(q["y"] - p["y"], q["x"] - p["x"]).alias("a"))

    def at(x: Column, y: Column, angle: Column) -> Column:
        return F.struct((x + d * F.cos(angle)).alias("x"), (y + d * F.sin(angle)).alias("y"))

    def piece(ring: Column, i: Column) -> Column:
        """The moved edge ``i`` and the join to the next one."""
        e, nxt = edge(ring, i), edge(ring, i + 1)
        out = e["a"] - F.lit(math.pi / 2.0)  # direction to the right of the edge
        turn = nxt["a"] - e["a"]
        turn = turn - F.lit(2.0 * math.pi) * F.floor((turn + F.lit(math.pi)) / F.lit(2.0 * math.pi))  # -pi up to pi
        turn = F.when(turn <= F.lit(1e-12 - math.pi), F.lit(math.pi)).otherwise(turn)  # a spike: around its tip
        parts = F.greatest(F.ceil(F.abs(turn) / step), F.lit(1)).cast("int")
        arc = F.transform(F.sequence(F.lit(1), parts), lambda k: at(e["x2"], e["y2"], out + turn * k / parts))
        corner = F.array(F.struct(e["x2"].alias("x"), e["y2"].alias("y")), at(e["x2"], e["y2"], out + turn))
        return F.concat(F.array(at(e["x1"], e["y1"], out), at(e["x2"], e["y2"], out)),
                        F.when(turn > 0, arc).otherwise(corner))

    def curve(ring: Column) -> Column:
        n = F.size(ring)
        open_ring = F.slice(ring, 1, n - 1)
        all_ = F.flatten(F.transform(F.sequence(F.lit(0), n - 2), lambda i: piece(open_ring, i)))
        return F.concat(all_, F.array(F.element_at(all_, 1)))

    clean = F.filter(F.transform(rings_m, _without_repeats), lambda r: F.size(r) > 3)
    return F.transform(F.transform(clean, lambda r: turned(clean, r)), curve)


def turned(rings_m: Column, ring: Column) -> Column:
    """``ring`` with the zone of ``rings_m`` on its left: counter-clockwise when
    an even number of the other rings holds it, else clockwise."""
    x, y = inner_point(ring)
    holds = F.aggregate(rings_m, F.lit(0), lambda n, r: n + F.when((r != ring) & (winding_number(r, x, y) != 0), 1).otherwise(0))
    left = signed_area(ring) > 0
    return F.when(left == (holds % 2 == 0), ring).otherwise(F.reverse(ring))


def inner_point(ring: Column) -> tuple[Column, Column]:
    """The middle of a ring's first edge (rings of a zone do not cross)."""
    a, b = F.element_at(ring, 1), F.element_at(ring, 2)
    return (a["x"] + b["x"]) / F.lit(2.0), (a["y"] + b["y"]) / F.lit(2.0)


def winding_number(ring_m: Column, px: Column, py: Column) -> Column:
    """How often a closed ring runs counter-clockwise around (px, py)."""

    def step(n: Column, i: Column) -> Column:
        a, b = F.element_at(ring_m, i), F.element_at(ring_m, i + 1)
        side = (b["x"] - a["x"]) * (py - a["y"]) - (px - a["x"]) * (b["y"] - a["y"])
        up, down = (a["y"] <= py) & (b["y"] > py) & (side > 0), (a["y"] > py) & (b["y"] <= py) & (side < 0)
        return n + F.when(up, 1).when(down, -1).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.size(ring_m) - 1), F.lit(0), step)


def in_buffer(curves: Column, px: Column, py: Column) -> Column:
    """(px, py) lies in the widened zone whose curves :func:`buffer_rings` gave."""
    return F.aggregate(curves, F.lit(0), lambda n, r: n + winding_number(r, px, py)) > 0


def near_any(edges: Column, px: Column, py: Column, tolerance_m: float) -> Column:
    """Some edge of ``edges`` is within ``tolerance_m`` of (px, py)."""
    tol2 = F.lit(float(tolerance_m) ** 2)
    return F.exists(edges, lambda e: dist2_to_edge(e, px, py) <= tol2)
