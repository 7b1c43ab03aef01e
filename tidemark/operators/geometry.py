"""Transect geometry (GEO family): closed-form column expressions, one
narrow projection per row, no Python per row."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import destination_point, offset_point, rotate
from tidemark.functions.text import value_text

# Transect footprint half-length and half-width in metres.
HALF_LENGTH_M = 30.0
HALF_WIDTH_M = 2.0

# Corner order of the closed ring in (along, right) units of the half sizes:
# bottom-left, bottom-right, top-right, top-left, bottom-left again.
_CORNERS = ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))


def rectangle_corners(lon, lat, heading, half_length: float = HALF_LENGTH_M,
                      half_width: float = HALF_WIDTH_M, method: str = "geodesic") -> Column:
    """``array<struct<lon, lat>>`` of the 5-point closed ring of a rectangle
    centred on (lon, lat) whose long side follows ``heading`` (degrees from
    north, clockwise).

    ``method`` ``"geodesic"`` walks to each corner on the ellipsoid, longitudes
    wrapped at 180; ``"tangent"`` adds offsets on the local tangent plane (not wrapped)."""
    if method not in ("geodesic", "tangent"):
        raise ValueError(f"unknown method {method!r}")
    pts = []
    for sx, sy in _CORNERS:
        if method == "geodesic":
            x, y = sx * half_length, sy * half_width
            pts.append(destination_point(lon, lat, F.lit(math.degrees(math.atan2(y, x))) + heading, F.lit(math.hypot(x, y))))
            continue
        east, north = rotate(F.lit(sx * half_length), F.lit(sy * half_width), heading)
        plon, plat = offset_point(lon, lat, east, north)
        pts.append(F.struct(plon.alias("lon"), plat.alias("lat")))
    return F.array(*pts)


def ring_wkt(ring: Column, digits: int = 8) -> Column:
    """WKT ``POLYGON((lon lat, ...))`` of a ring column."""
    fmt = f"%.{digits}f %.{digits}f"
    txt = F.transform(ring, lambda p: F.format_string(fmt, p["lon"], p["lat"]))
    return F.concat(F.lit("POLYGON(("), F.array_join(txt, ", "), F.lit("))"))


def transect_rectangle(df: DataFrame, lon: str = "longitude", lat: str = "latitude",
                       heading: str = "dc_heading", half_length: float = HALF_LENGTH_M,
                       half_width: float = HALF_WIDTH_M, ring_col: str = "ring",
                       wkt_col: str | None = "wkt", method: str = "geodesic") -> DataFrame:
    """GEO-1: add the rectangle ring (and its WKT) for every site row (``method`` as in :func:`rectangle_corners`)."""
    out = df.withColumn(ring_col, rectangle_corners(F.col(lon), F.col(lat), F.col(heading),
                                                    half_length, half_width, method))
    if wkt_col:
        out = out.withColumn(wkt_col, ring_wkt(F.col(ring_col)))
    return out


# Description labels of the placemark fields, in order.
DEFAULT_FIELDS = {
    "Survey Type": "survey_type",
    "Region": "region",
    "Site Name": "site_name",
    "Site Type": "site_type",
    "Zone": "zone",
    "Target Depth (m)": "target_depth_meters",
    "UC Heading": "uc_heading",
    "DC Heading": "dc_heading",
}


def describe_site(df: DataFrame, fields: Mapping[str, str] = DEFAULT_FIELDS,
                  name_col: str = "site_long", keep: Sequence[str] = ()) -> DataFrame:
    """GEO-2: placemark ``Name`` and HTML ``Description`` per site
    (``<strong>Label:</strong> value<br>`` per field; NULL prints ``NA``)."""
    types = dict(df.dtypes)
    parts = []
    for label, col in fields.items():
        parts += [F.lit(f"<strong>{label}:</strong> "),
                  F.coalesce(value_text(col, types[col]), F.lit("NA")), F.lit("<br>")]
    return df.select(*keep, F.col(name_col).cast("string").alias("Name"),
                     F.concat(*parts).alias("Description"))
