"""One coordinate system for all states: UTM zone to zone and false eastings."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from ..functions import geometry as G
from ..functions.text import col

# States in UTM zone 32; all others lie in zone 33.
ZONE_32 = ["BW", "BY", "HB", "HE", "HH", "NI", "NW", "RP", "SH", "SL", "ST", "TH"]
# GRS80 ellipsoid and UTM parameters.
A, FLAT, K0, EAST = 6378137.0, 1 / 298.257222101, 0.9996, 500000.0

_N = FLAT / (2 - FLAT)
_RECT = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Krüger series to the fourth order in the third flattening
_ALPHA = [_N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3 + 41 / 180 * _N**4, 13 / 48 * _N**2 - 3 / 5 * _N**3 + 557 / 1440 * _N**4,
          61 / 240 * _N**3 - 103 / 140 * _N**4, 49561 / 161280 * _N**4]
_BETA = [_N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3 - 1 / 360 * _N**4, 1 / 48 * _N**2 + 1 / 15 * _N**3 - 437 / 1440 * _N**4,
         17 / 480 * _N**3 - 37 / 840 * _N**4, 4397 / 161280 * _N**4]


def zone_of(gml_id: Column | str) -> Column:
    """UTM zone of an object by the state in its id."""
    return F.when(F.substring(col(gml_id), 3, 2).isin(*ZONE_32), 32).otherwise(33)


def _series(xi: Column, eta: Column, coeff: list[float], sign: int) -> Column:
    """Spherical transverse Mercator coordinates corrected by the series."""
    x, e = xi, eta
    for j, c in enumerate(coeff, 1):
        x = x + F.lit(sign * c) * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j))
        e = e + F.lit(sign * c) * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j))
    return F.struct(x.alias("x"), e.alias("e"))


def rezone(p: Column, source: Column, target: int) -> Column:
    """Vertex from one UTM zone to another.

    Both zones share the ellipsoid, so the way goes over the conformal sphere:
    only the central meridian differs and no geodetic latitude is needed.
    """
    turn = (F.lit(float(target)) - source) * math.radians(6)

    def on_sphere(s):
        xi, eta = s["x"], s["e"]
        chi = F.asin(F.sin(xi) / F.cosh(eta))
        lam = F.atan2(F.sinh(eta), F.cos(xi)) - turn
        return F.struct(chi.alias("c"), lam.alias("l"))

    def to_plane(q):
        t = F.tan(q["c"])
        return F.struct(F.atan2(t, F.cos(q["l"])).alias("x"), F.atanh(F.cos(q["c"]) * F.sin(q["l"])).alias("e"))

    scale = K0 * _RECT
    start = _series(p["y"] / scale, (p["x"] - EAST) / scale, _BETA, -1)
    sphere = G.let(start, on_sphere)
    plane = G.let(sphere, to_plane)
    back = G.let(plane, lambda s: _series(s["x"], s["e"], _ALPHA, 1))
    return G.let(back, lambda s: G.vertex(s["e"] * scale + EAST, s["x"] * scale))


def to_zone(geom: Column | str, gml_id: Column | str, target: int = 33) -> Column:
    """Geometry in the target zone; geometries already there stay as they are."""
    zone = zone_of(gml_id)
    g = col(geom)
    moved = G.map_vertices(g, lambda p: rezone(p, zone.cast("double"), target))
    return F.when(zone == target, g).otherwise(moved)


def shift_easting(geom: Column | str, old: float, new: float = EAST) -> Column:
    """Same projection with another false easting."""
    return G.translate(geom, new - old, 0.0)
