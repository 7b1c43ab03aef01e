"""Registered geometry queries (GEO family): one site per supplier, with a
position and heading derived from its keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.geo import WGS84_A, WGS84_E2, WGS84_F, destination_point
from tidemark.operators import geometry as geo
from tidemark.plans.common import register, rn, sql_num_text, table

_SITE_SQL = """SELECT s.s_suppkey, s.s_name, n.n_name,
  -122.0 + s.s_suppkey * 0.001 AS longitude, 36.5 + s.s_nationkey * 0.01 AS latitude,
  CAST((s.s_suppkey * 37) % 360 AS DOUBLE) AS dc_heading, s.s_acctbal
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"""


def _sites(spark, sf):
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        "s_suppkey", "s_name", "n_name",
        (F.lit(-122.0) + F.col("s_suppkey") * F.lit(0.001)).alias("longitude"),
        (F.lit(36.5) + F.col("s_nationkey") * F.lit(0.01)).alias("latitude"),
        ((F.col("s_suppkey") * 37) % 360).cast("double").alias("dc_heading"), "s_acctbal")


def _corner_sql(sx, sy):
    x, y = f"({sx * 30.0})", f"({sy * 2.0})"
    h = "radians(dc_heading)"
    east = f"({x} * sin({h}) + {y} * cos({h}))"
    north = f"({x} * cos({h}) - {y} * sin({h}))"
    s2 = "(sin(radians(latitude)) * sin(radians(latitude)))"
    m = f"({WGS84_A * (1 - WGS84_E2)!r} / pow(1.0 - {WGS84_E2!r} * {s2}, 1.5))"
    nn = f"({WGS84_A!r} / sqrt(1.0 - {WGS84_E2!r} * {s2}))"
    lon = f"(longitude + degrees({east} / ({nn} * cos(radians(latitude)))))"
    lat = f"(latitude + degrees({north} / {m}))"
    return lon, lat


_CORNERS = ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))

GEO1_SQL = f"WITH s AS ({_SITE_SQL})\n" + "\nUNION ALL\n".join(
    f"SELECT s_suppkey, {i + 1} AS corner, round({_corner_sql(sx, sy)[0]}, 8) AS lon, "
    f"round({_corner_sql(sx, sy)[1]}, 8) AS lat FROM s"
    for i, (sx, sy) in enumerate(_CORNERS))


@register("geo1_transect_rectangle", ("GEO-1",), GEO1_SQL)
def geo1_transect_rectangle(spark, sf):
    """60 x 4 m rectangle along each site's heading, closed 5-corner ring."""
    r = geo.transect_rectangle(_sites(spark, sf), wkt_col=None, method="tangent")
    pts = r.select("s_suppkey", F.posexplode("ring").alias("pos", "pt"))
    return pts.select("s_suppkey", (F.col("pos") + 1).alias("corner"),
                      rn(F.col("pt.lon"), 8).alias("lon"), rn(F.col("pt.lat"), 8).alias("lat"))


GEO1W_SQL = f"""SELECT s_suppkey, 'POLYGON((' || string_agg(printf('%.8f %.8f', lon, lat), ', ' ORDER BY corner) || '))' AS wkt
FROM ({GEO1_SQL}) GROUP BY s_suppkey"""


@register("geo1_rectangle_wkt", ("GEO-1",), GEO1W_SQL)
def geo1_rectangle_wkt(spark, sf):
    """The same rectangles as WKT polygons."""
    r = geo.transect_rectangle(_sites(spark, sf), method="tangent")
    return r.select("s_suppkey", "wkt")


# the twin walks the geodesic by repeated corrections of the arc, six times
def _walk_sql(sites: str) -> str:
    b, f = f"{WGS84_A * (1 - WGS84_F)!r}", f"{WGS84_F!r}"
    walk = f"""WITH s AS ({sites}),
o AS (SELECT *, atan((1 - {f}) * tan(radians(latitude))) AS u, radians(bearing) AS al FROM s),
q AS (SELECT *, atan2(tan(u), cos(al)) AS s1, cos(u) * sin(al) AS sa FROM o),
h AS (SELECT *, 1 - sa * sa AS c2, (1 - sa * sa) * {WGS84_E2 / (1 - WGS84_E2)!r} AS uu FROM q),
k AS (SELECT *, 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu))) AS aa, uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu))) AS bb FROM h),
w0 AS (SELECT *, metres / ({b} * aa) AS sg FROM k)"""
    for i in range(1, 7):
        m = "cos(2 * s1 + sg)"
        walk += f""",
w{i} AS (SELECT * REPLACE (metres / ({b} * aa) + bb * sin(sg) * ({m} + bb / 4 * (cos(sg) * (2 * {m} * {m} - 1)
  - bb / 6 * {m} * (4 * sin(sg) * sin(sg) - 3) * (4 * {m} * {m} - 3))) AS sg) FROM w{i - 1})"""
    return walk + f""",
e AS (SELECT *, sin(u) * sin(sg) - cos(u) * cos(sg) * cos(al) AS fl, {f} / 16 * c2 * (4 + {f} * (4 - 3 * c2)) AS c, cos(2 * s1 + sg) AS m FROM w6),
d AS (SELECT *, degrees(atan2(sin(u) * cos(sg) + cos(u) * sin(sg) * cos(al), (1 - {f}) * sqrt(sa * sa + fl * fl))) AS lat2,
  longitude + degrees(atan2(sin(sg) * sin(al), cos(u) * cos(sg) - sin(u) * sin(sg) * cos(al))
    - (1 - c) * {f} * sa * (sg + c * sin(sg) * (m + c * cos(sg) * (2 * m * m - 1)))) AS lon0 FROM e)"""


_RING_SQL = f"""SELECT c.*, degrees(atan2(y, x)) + dc_heading AS bearing, sqrt(x * x + y * y) AS metres
FROM (SELECT s_suppkey, longitude, latitude, dc_heading, corner, [-30.0, 30.0, 30.0, -30.0, -30.0][corner]::DOUBLE AS x, [-2.0, -2.0, 2.0, 2.0, -2.0][corner]::DOUBLE AS y
  FROM ({_SITE_SQL}), (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS corner)) c"""

GEO1G_SQL = _walk_sql(_RING_SQL) + """
SELECT s_suppkey, corner, round(lon0, 8) AS lon, round(lat2, 8) AS lat FROM d"""


@register("geo1_geodesic_rectangle", ("GEO-1",), GEO1G_SQL)
def geo1_geodesic_rectangle(spark, sf):
    """The rectangles with corners on the ellipsoid."""
    r = geo.transect_rectangle(_sites(spark, sf), wkt_col=None)
    pts = r.select("s_suppkey", F.posexplode("ring").alias("pos", "pt"))
    return pts.select("s_suppkey", (F.col("pos") + 1).alias("corner"),
                      rn(F.col("pt.lon"), 8).alias("lon"), rn(F.col("pt.lat"), 8).alias("lat"))


# long walks from both sides of longitude 180
_FAR_SQL = """SELECT c_custkey, (CASE WHEN c_custkey % 2 = 0 THEN 179.9 ELSE -179.9 END)::DOUBLE AS longitude,
  CAST((c_custkey * 13) % 161 - 80 AS DOUBLE) AS latitude, CAST((c_custkey * 37) % 360 AS DOUBLE) AS bearing, 100000.0 + (c_custkey % 50) * 20000.0 AS metres FROM customer"""

GEO1F_SQL = _walk_sql(_FAR_SQL) + """
SELECT c_custkey, round(CASE WHEN lon0 > 180 THEN lon0 - 360 WHEN lon0 <= -180 THEN lon0 + 360 ELSE lon0 END, 7) AS lon, round(lat2, 7) AS lat FROM d"""


@register("geo1_destination_point", ("GEO-1",), GEO1F_SQL)
def geo1_destination_point(spark, sf):
    """Destination points 100 to 1,080 km away, across longitude 180."""
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select("c_custkey", F.when(k % 2 == 0, 179.9).otherwise(-179.9).alias("longitude"),
                                            ((k * 13) % 161 - 80).cast("double").alias("latitude"), ((k * 37) % 360).cast("double").alias("bearing"),
                                            (F.lit(100000.0) + (k % 50) * F.lit(20000.0)).alias("metres"))
    p = destination_point("longitude", "latitude", "bearing", "metres")
    return c.select("c_custkey", p.alias("p")).select("c_custkey", rn("p.lon", 7).alias("lon"), rn("p.lat", 7).alias("lat"))


_FIELDS = {"Survey Type": "survey_type", "Region": "region", "Site Name": "site_name",
           "Site Type": "site_type", "Zone": "zone", "Target Depth (m)": "target_depth_meters",
           "UC Heading": "uc_heading", "DC Heading": "dc_heading"}

GEO2_SQL = f"""WITH s AS ({_SITE_SQL}),
t AS (SELECT s_suppkey, s_name AS site_long, 'Margin' AS survey_type, n_name AS region, s_name AS site_name,
  CASE s_suppkey % 3 WHEN 0 THEN 'BAR' WHEN 1 THEN 'FOR' ELSE 'INCIP' END AS site_type,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Shallow' END AS zone,
  round(s_acctbal / 1000, 2) AS target_depth_meters, (dc_heading + 180) % 360 AS uc_heading, dc_heading FROM s)
SELECT s_suppkey, site_long AS Name, """ + " || ".join(
    f"'<strong>{label}:</strong> ' || coalesce({sql_num_text(col) if col in ('target_depth_meters', 'uc_heading', 'dc_heading') else col}, 'NA') || '<br>'"
    for label, col in _FIELDS.items()) + " AS Description FROM t"


@register("geo2_describe_site", ("GEO-2",), GEO2_SQL)
def geo2_describe_site(spark, sf):
    """Placemark name and HTML description per site."""
    s = _sites(spark, sf)
    k = F.col("s_suppkey")
    t = s.select("s_suppkey", F.col("s_name").alias("site_long"), F.lit("Margin").alias("survey_type"),
                 F.col("n_name").alias("region"), F.col("s_name").alias("site_name"),
                 F.when(k % 3 == 0, "BAR").when(k % 3 == 1, "FOR").otherwise("INCIP").alias("site_type"),
                 F.when(k % 2 == 0, "Shallow").alias("zone"),
                 rn(F.col("s_acctbal") / 1000, 2).alias("target_depth_meters"),
                 ((F.col("dc_heading") + 180) % 360).alias("uc_heading"), "dc_heading")
    return geo.describe_site(t, _FIELDS, keep=["s_suppkey"])
