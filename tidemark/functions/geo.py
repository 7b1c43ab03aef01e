"""Geodesy helpers around a point (WGS84): local tangent plane and geodesics of any length below half the globe."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark._util import col_of
from tidemark.functions.stats import let

# WGS84 semi-major axis (m) and flattening.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_E2 = WGS84_F * (2 - WGS84_F)


def meridian_radius(lat_deg) -> Column:
    """Radius of curvature in the meridian, M(lat), metres."""
    s = F.sin(F.radians(col_of(lat_deg)))
    return F.lit(WGS84_A * (1 - WGS84_E2)) / F.pow(F.lit(1.0) - F.lit(WGS84_E2) * s * s, 1.5)


def normal_radius(lat_deg) -> Column:
    """Radius of curvature in the prime vertical, N(lat), metres."""
    s = F.sin(F.radians(col_of(lat_deg)))
    return F.lit(WGS84_A) / F.sqrt(F.lit(1.0) - F.lit(WGS84_E2) * s * s)


def offset_point(lon, lat, east_m, north_m) -> tuple[Column, Column]:
    """Point ``east_m``/``north_m`` metres from (lon, lat) on the local
    tangent plane scaled by the WGS84 radii of curvature."""
    lon, lat = col_of(lon), col_of(lat)
    dlat = F.degrees(col_of(north_m) / meridian_radius(lat))
    dlon = F.degrees(col_of(east_m) / (normal_radius(lat) * F.cos(F.radians(lat))))
    return lon + dlon, lat + dlat


def rotate(x, y, heading_deg) -> tuple[Column, Column]:
    """Along-heading ``x`` and to-the-right ``y`` (metres) -> (east, north)."""
    h = F.radians(col_of(heading_deg))
    east = x * F.sin(h) + y * F.cos(h)
    north = x * F.cos(h) - y * F.sin(h)
    return east, north


# Coefficients of the series in the expansion parameter e of a
# geodesic, per multiple of the arc (C1: arc to distance, C1R: distance to arc),
# as (power of e, coefficient), to the fourth power (below 0.1 mm).
_A1 = ((0, 1.0), (2, 1 / 4), (4, 1 / 64))
_C1 = (((1, -1 / 2), (3, 3 / 16)), ((2, -1 / 16), (4, 1 / 32)), ((3, -1 / 48),), ((4, -5 / 512),))
_C1R = (((1, 1 / 2), (3, -9 / 32)), ((2, 5 / 16), (4, -37 / 96)), ((3, 29 / 96),), ((4, 539 / 1536),))


def _poly(terms, e: Column) -> Column:
    return sum((F.lit(c) * F.pow(e, F.lit(float(k))) for k, c in terms), F.lit(0.0))


def _sines(series, e: Column, arc: Column) -> Column:
    return sum((_poly(terms, e) * F.sin(arc * (2.0 * l)) for l, terms in enumerate(series, 1)), F.lit(0.0))


def destination_point(lon, lat, bearing, metres) -> Column:
    """``struct<lon, lat>``: the point ``metres`` along the geodesic that leaves (lon, lat) at ``bearing`` (degrees from north).

    A fixed number of series terms on the auxiliary sphere, no iteration;
    longitudes are wrapped to (-180, 180]. NULL in any argument gives NULL."""
    lon, lat, bearing, metres = (col_of(c).cast("double") for c in (lon, lat, bearing, metres))
    f = WGS84_F
    semi_minor = WGS84_A * (1 - f)

    def origin(v: Column) -> Column:
        turn = F.radians(v["bearing"])
        reduced = F.atan2((1 - f) * F.sin(F.radians(v["lat"])), F.cos(F.radians(v["lat"])))
        return F.struct(F.sin(reduced).alias("sb"), F.cos(reduced).alias("cb"), F.sin(turn).alias("sa"), F.cos(turn).alias("ca"), v["lon"].alias("lon"), v["metres"].alias("m"))

    def equator(o: Column) -> Column:
        across = o["sa"] * o["cb"]  # sine of the azimuth where the geodesic crosses the equator
        along = 1 - across * across
        k = F.sqrt(1 + along * (WGS84_E2 / (1 - WGS84_E2)))
        return F.struct(o.alias("o"), across.alias("sa0"), along.alias("ca2"), ((k - 1) / (k + 1)).alias("e"), F.atan2(o["sb"], o["ca"] * o["cb"]).alias("arc"))

    def arcs(q: Column) -> Column:
        scale = _poly(_A1, q["e"]) / (1 - q["e"])
        # the distance walked as an arc, added to what lies between the equator and the origin
        far = q["arc"] + _sines(_C1, q["e"], q["arc"]) + q["o"]["m"] / (scale * semi_minor)
        return F.struct(q.alias("q"), far.alias("far"))

    def end(a: Column) -> Column:
        arc = a["far"] + _sines(_C1R, a["q"]["e"], a["far"])
        return F.struct(a["q"].alias("q"), (arc - a["q"]["arc"]).alias("d"), arc.alias("arc"))

    def place(r: Column) -> Column:
        q, o, d = r["q"], r["q"]["o"], r["d"]
        sd, cd = F.sin(d), F.cos(d)
        north = o["sb"] * cd + o["cb"] * sd * o["ca"]
        flat = o["sb"] * sd - o["cb"] * cd * o["ca"]
        lat2 = F.atan2(north, (1 - f) * F.sqrt(q["sa0"] * q["sa0"] + flat * flat))
        sphere = F.atan2(sd * o["sa"], o["cb"] * cd - o["sb"] * sd * o["ca"])
        c = q["ca2"] * (4 + f * (4 - 3 * q["ca2"])) * (f / 16)
        mid = F.cos(q["arc"] + r["arc"])
        less = (1 - c) * f * q["sa0"] * (d + c * sd * (mid + c * cd * (2 * mid * mid - 1)))
        lon2 = o["lon"] + F.degrees(sphere - less)
        lon2 = F.when(lon2 > 180, lon2 - 360).when(lon2 <= -180, lon2 + 360).otherwise(lon2)
        return F.struct(lon2.alias("lon"), F.degrees(lat2).alias("lat"))

    start = F.struct(lon.alias("lon"), lat.alias("lat"), bearing.alias("bearing"), metres.alias("metres"))
    found = start
    for step in (origin, equator, arcs, end, place):
        found = let(found, step)
    return F.when(lon.isNotNull() & lat.isNotNull() & bearing.isNotNull() & metres.isNotNull(), found)


DEG = 180.0 / math.pi
