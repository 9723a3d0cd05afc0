"""Planes in metres as column arithmetic: the local plane of :mod:`.geo` and
the transverse Mercator projection of national grids.

Transverse Mercator goes through the conformal sphere and a series in the third
flattening ``n`` (Krueger's series, to the fourth order): below a micrometre in a
zone of a few degrees, forward and inverse alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import plane_scale

DEG = math.pi / 180.0


@dataclass(frozen=True)
class LocalPlane:
    """The equirectangular plane around ``origin`` (lon, lat)."""

    origin: tuple[float, float]

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        kx, ky = plane_scale(self.origin[1])
        return (lon - F.lit(self.origin[0])) * F.lit(kx), (lat - F.lit(self.origin[1])) * F.lit(ky)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        kx, ky = plane_scale(self.origin[1])
        return x / F.lit(kx) + F.lit(self.origin[0]), y / F.lit(ky) + F.lit(self.origin[1])


def _series(terms: tuple[tuple[float, ...], ...], n: float) -> tuple[float, ...]:
    """Coefficient polynomials in ``n``; the j-th begins with its power j."""
    return tuple(sum(c * n ** (j + i) for i, c in enumerate(row)) for j, row in enumerate(terms, 1))


# Coefficients of the series by rising powers of n (forward,
# inverse, conformal to geographic latitude).
FORWARD = ((1 / 2, -2 / 3, 5 / 16, 41 / 180), (13 / 48, -3 / 5, 557 / 1440), (61 / 240, -103 / 140), (49561 / 161280,))
INVERSE = ((1 / 2, -2 / 3, 37 / 96, -1 / 360), (1 / 48, 1 / 15, -437 / 1440), (17 / 480, -37 / 840), (4397 / 161280,))
LATITUDE = ((2.0, -2 / 3, -2.0, 116 / 45), (7 / 3, -8 / 5, -227 / 45), (56 / 15, -136 / 35), (4279 / 630,))


@dataclass(frozen=True)
class TransverseMercator:
    """A transverse Mercator grid: central meridian, scale on it, false easting
    and northing, origin latitude, and the ellipsoid."""

    lon0: float
    scale: float = 1.0
    east: float = 0.0
    north: float = 0.0
    lat0: float = 0.0
    axis: float = 6378137.0
    inverse_flattening: float = 298.257222101  # GRS 80

    @property
    def third(self) -> float:
        f = 1.0 / self.inverse_flattening
        return f / (2.0 - f)

    @property
    def eccentricity(self) -> float:
        return 2.0 * math.sqrt(self.third) / (1.0 + self.third)

    @property
    def radius(self) -> float:
        """Scaled radius of the rectifying sphere."""
        n = self.third
        return self.scale * self.axis / (1.0 + n) * (1.0 + n * n / 4.0 + n ** 4 / 64.0)

    @property
    def origin_arc(self) -> float:
        """Rectifying latitude of the origin latitude."""
        s = math.sin(self.lat0 * DEG)
        chi = math.atan(math.sinh(math.atanh(s) - self.eccentricity * math.atanh(self.eccentricity * s))) if self.lat0 else 0.0
        return chi + sum(a * math.sin(2 * j * chi) for j, a in enumerate(_series(FORWARD, self.third), 1))

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """(easting, northing) in metres of lon/lat degrees."""
        e = F.lit(self.eccentricity)
        s = F.sin(lat * F.lit(DEG))
        t = F.sinh(F.atanh(s) - e * F.atanh(e * s))  # tangent of the conformal latitude
        d = (lon - F.lit(self.lon0)) * F.lit(DEG)
        xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(F.lit(1.0) + t * t))
        north, east = xi, eta
        for j, a in enumerate(_series(FORWARD, self.third), 1):
            north = north + F.lit(a) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
            east = east + F.lit(a) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
        r = F.lit(self.radius)
        return F.lit(self.east) + r * east, F.lit(self.north) + r * (north - F.lit(self.origin_arc))

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(lon, lat) degrees of easting and northing."""
        r = F.lit(self.radius)
        xi, eta = (y - F.lit(self.north)) / r + F.lit(self.origin_arc), (x - F.lit(self.east)) / r
        p, q = xi, eta
        for j, b in enumerate(_series(INVERSE, self.third), 1):
            p = p - F.lit(b) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
            q = q - F.lit(b) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
        chi = F.asin(F.sin(p) / F.cosh(q))
        lat = chi
        for j, d in enumerate(_series(LATITUDE, self.third), 1):
            lat = lat + F.lit(d) * F.sin(F.lit(2.0 * j) * chi)
        return F.lit(self.lon0) + F.atan2(F.sinh(q), F.cos(p)) / F.lit(DEG), lat / F.lit(DEG)


Plane = LocalPlane | TransverseMercator

# The grid of the analysis (modified transverse Mercator, zone 9).
MTM_ZONE_9 = TransverseMercator(lon0=-76.5, scale=0.9999, east=304800.0)


def map_points(rings: Column, plane: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Rings with every vertex taken through ``plane`` (a ``forward`` or an
    ``inverse``)."""

    def mapped(p: Column) -> Column:
        x, y = plane(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda r: F.transform(r, mapped))
