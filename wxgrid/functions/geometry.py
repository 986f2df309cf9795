"""Geometry as native Column math: projection inverse and point-in-polygon.

Spark ships no containment predicate or reprojection, so both are written
with built-in math and higher-order array functions (JVM side, no UDF).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The region boundaries' projected CRS (EPSG:5179, Korea 2000 /
# Unified CS): GRS80 ellipsoid, transverse Mercator, latitude of origin 38,
# central meridian 127.5, scale 0.9996, false easting 1,000,000, false
# northing 2,000,000.
# ---------------------------------------------------------------------------
GRS80_A = 6378137.0
GRS80_F = 1.0 / 298.257222101
TM_LAT0 = 38.0
TM_LON0 = 127.5
TM_K0 = 0.9996
TM_FE = 1000000.0
TM_FN = 2000000.0


def _series(f: float):
    """Krueger 4th-order coefficients (published series, in n)."""
    n = f / (2 - f)
    A = 1.0 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    beta = [n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96 - n ** 4 / 360,
            n ** 2 / 48 + n ** 3 / 15 - 437 * n ** 4 / 1440,
            17 * n ** 3 / 480 - 37 * n ** 4 / 840,
            4397 * n ** 4 / 161280]
    delta = [2 * n - 2 * n ** 2 / 3 - 2 * n ** 3 + 116 * n ** 4 / 45,
             7 * n ** 2 / 3 - 8 * n ** 3 / 5 - 227 * n ** 4 / 45,
             56 * n ** 3 / 15 - 136 * n ** 4 / 35,
             4279 * n ** 4 / 630]
    return n, A, beta, delta


def rectifying_latitude(lat_deg: float, f: float = GRS80_F) -> float:
    """Rectifying latitude (radians) of a geodetic latitude, series in n."""
    n = f / (2 - f)
    p = math.radians(lat_deg)
    return (p - (3 * n / 2 - 9 * n ** 3 / 16) * math.sin(2 * p)
            + (15 * n ** 2 / 16 - 15 * n ** 4 / 32) * math.sin(4 * p)
            - (35 * n ** 3 / 48) * math.sin(6 * p)
            + (315 * n ** 4 / 512) * math.sin(8 * p))


def tm_to_lonlat(e: Column, n_: Column, a: float = GRS80_A, f: float = GRS80_F,
                 lat0: float = TM_LAT0, lon0: float = TM_LON0, k0: float = TM_K0,
                 fe: float = TM_FE, fn: float = TM_FN) -> tuple[Column, Column]:
    """Inverse transverse Mercator (Krueger series): (easting, northing) ->
    (lon, lat) in degrees.  Apply to polygon vertices, never to grid points."""
    _, A1, beta, delta = _series(f)
    A = a * A1
    xi = (n_ - F.lit(fn)) / F.lit(k0 * A) + F.lit(rectifying_latitude(lat0, f))
    eta = (e - F.lit(fe)) / F.lit(k0 * A)
    xi_p = xi
    eta_p = eta
    for j, b in enumerate(beta, start=1):
        xi_p = xi_p - F.lit(b) * F.sin(F.lit(2 * j) * xi) * F.cosh(F.lit(2 * j) * eta)
        eta_p = eta_p - F.lit(b) * F.cos(F.lit(2 * j) * xi) * F.sinh(F.lit(2 * j) * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    lat = chi
    for j, d in enumerate(delta, start=1):
        lat = lat + F.lit(d) * F.sin(F.lit(2 * j) * chi)
    lon = F.lit(math.radians(lon0)) + F.atan2(F.sinh(eta_p), F.cos(xi_p))
    return F.degrees(lon), F.degrees(lat)


def ring_edges(ring: Column) -> Column:
    """Edges (x1, y1, x2, y2) of one ring, closing it if it is open."""
    n = F.size(ring)
    idx = F.sequence(F.lit(1), n)

    def edge(i):
        p = F.element_at(ring, i)
        q = F.when(i < n, F.element_at(ring, F.least(i + 1, n))).otherwise(F.element_at(ring, 1))
        return F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))

    return F.when(n >= 2, F.transform(idx, edge))


def chain_edges(points: Column) -> Column:
    """Edges (x1, y1, x2, y2) between neighbours of an open chain of points."""
    ends = F.arrays_zip(F.slice(points, F.lit(1), F.size(points) - 1).alias("p"), F.slice(points, F.lit(2), F.size(points) - 1).alias("q"))
    return F.transform(ends, lambda e: F.struct(e["p"]["x"].alias("x1"), e["p"]["y"].alias("y1"), e["q"]["x"].alias("x2"), e["q"]["y"].alias("y2")))


def polygon_edges(rings: Column) -> Column:
    """All edges of all rings (outer shells, holes, parts): even-odd over the
    union gives holes and multi-part polygons for free."""
    return F.flatten(F.transform(rings, ring_edges))


def _on_edge(px: Column, py: Column, e: Column) -> Column:
    x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
    cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    return ((cross == 0) & (px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2))
            & (py >= F.least(y1, y2)) & (py <= F.greatest(y1, y2)))


def _crosses(px: Column, py: Column, e: Column) -> Column:
    x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
    straddles = (y1 > py) != (y2 > py)
    x_at = (x2 - x1) * (py - y1) / (y2 - y1) + x1
    return F.when(straddles & (px < x_at), F.lit(1)).otherwise(F.lit(0))


def strictly_within(px: Column, py: Column, edges: Column, heights: Column | None = None) -> Column:
    """Even-odd ray cast, with boundary points (on any edge) excluded.
    ``heights``: where edges right of the point, not among ``edges``, start or
    end an odd number of times."""
    crossings = F.aggregate(edges, F.lit(0), lambda acc, e: acc + _crosses(px, py, e))
    if heights is not None:
        crossings = crossings + F.size(F.filter(heights, lambda y: y <= py))
    on_boundary = F.exists(edges, lambda e: _on_edge(px, py, e))
    return ((crossings % 2) == 1) & ~on_boundary
