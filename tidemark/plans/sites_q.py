"""Registered site-table and site-resolution queries (SITE family).

Site sheets are text tables derived from ``supplier`` (one site per supplier),
so they grow with the data; survey data are ``orders`` keyed by customer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import sites as st
from tidemark.plans.common import r6, register, sql_standardize, table
from tidemark.sources.io import union_years

# ----------------------------------------------------------------- SITE-1 --

_MARGIN_SHEET_SQL = """
SELECT 'Margin' AS survey_type, n.n_name AS region,
  'mar' || CAST(s.s_suppkey AS VARCHAR) AS site_name_2024,
  CASE WHEN s.s_suppkey % 10 = 0 THEN NULL ELSE 'Mar' || CAST(s.s_suppkey + 1 AS VARCHAR) END AS site_name_2025,
  CAST(s.s_nationkey % 4 + 1 AS VARCHAR) AS transect,
  CAST((s.s_suppkey * 37) % 360 AS VARCHAR) AS heading_out,
  CAST(36.5 + s.s_nationkey * 0.01 AS VARCHAR) AS target_latitude,
  CAST(-122.0 + s.s_suppkey * 0.001 AS VARCHAR) AS target_longitude,
  CASE WHEN s.s_suppkey % 3 = 0 THEN NULL ELSE CAST(36.5 + s.s_nationkey * 0.01 + 0.0001 AS VARCHAR) END AS actual_latitude,
  CASE WHEN s.s_suppkey % 3 = 0 THEN NULL ELSE CAST(-122.0 + s.s_suppkey * 0.001 + 0.0001 AS VARCHAR) END AS actual_longitude,
  strftime(DATE '2024-06-01' + CAST(s.s_suppkey % 90 AS INTEGER), '%Y-%m-%d') AS date_surveyed,
  CASE WHEN s.s_suppkey % 4 = 0 THEN strftime(DATE '2024-06-01' + CAST(s.s_suppkey % 90 + 30 AS INTEGER), '%Y-%m-%d') END AS resite_date
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
"""


def _margin_sheet(spark, sf):
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    k = F.col("s_suppkey")
    lat = F.lit(36.5) + F.col("s_nationkey") * F.lit(0.01)
    lon = F.lit(-122.0) + k * F.lit(0.001)
    d0 = F.date_add(F.to_date(F.lit("2024-06-01")), (k % 90).cast("int"))
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        F.lit("Margin").alias("survey_type"), F.col("n_name").alias("region"),
        F.concat(F.lit("mar"), k.cast("string")).alias("site_name_2024"),
        F.when(k % 10 == 0, None).otherwise(F.concat(F.lit("Mar"), (k + 1).cast("string"))).alias("site_name_2025"),
        (F.col("s_nationkey") % 4 + 1).cast("string").alias("transect"),
        ((k * 37) % 360).cast("string").alias("heading_out"),
        lat.cast("string").alias("target_latitude"), lon.cast("string").alias("target_longitude"),
        F.when(k % 3 == 0, None).otherwise((lat + F.lit(0.0001)).cast("string")).alias("actual_latitude"),
        F.when(k % 3 == 0, None).otherwise((lon + F.lit(0.0001)).cast("string")).alias("actual_longitude"),
        F.date_format(d0, "yyyy-MM-dd").alias("date_surveyed"),
        F.when(k % 4 == 0, F.date_format(F.date_add(d0, 30), "yyyy-MM-dd")).alias("resite_date"))


SITE1_SQL = f"""
WITH t AS ({_MARGIN_SHEET_SQL})
SELECT survey_type, region, {sql_standardize('site_name_2024')} AS site_name_2024,
  {sql_standardize('site_name_2025')} AS site_name_2025,
  TRY_CAST(transect AS DOUBLE) AS transect, TRY_CAST(heading_out AS DOUBLE) AS heading_out,
  round(coalesce(TRY_CAST(actual_latitude AS DOUBLE), TRY_CAST(target_latitude AS DOUBLE)), 6) AS latitude,
  round(coalesce(TRY_CAST(actual_longitude AS DOUBLE), TRY_CAST(target_longitude AS DOUBLE)), 6) AS longitude,
  CAST(coalesce(try_strptime(resite_date, '%Y-%m-%d'), try_strptime(date_surveyed, '%Y-%m-%d')) AS DATE) AS survey_date,
  CAST(try_strptime(date_surveyed, '%Y-%m-%d') AS DATE) AS date_surveyed_originally
FROM t WHERE site_name_2025 IS NOT NULL
"""


@register("site1_margin_sites", ("SITE-1", "SITE-3", "NRM-7"), SITE1_SQL)
def site1_margin_sites(spark, sf):
    """Margin site table: typed, unnamed sites dropped, names standardised,
    effective survey date and actual-else-target coordinates."""
    m = st.build_margin_sites(_margin_sheet(spark, sf))
    return m.withColumn("latitude", r6("latitude")).withColumn("longitude", r6("longitude"))


# ----------------------------------------------------------------- SITE-2 --

_RECOVERY_SHEET_SQL = """
SELECT 'Recovery' AS survey_type, n.n_name AS region,
  'rec' || CAST(s.s_suppkey % 40 AS VARCHAR) || '_' || CASE s.s_suppkey % 3 WHEN 0 THEN 'BAR' WHEN 1 THEN 'FOR' ELSE 'INCIP' END AS site_name_2025,
  CASE s.s_suppkey % 3 WHEN 0 THEN 'BAR' WHEN 1 THEN 'FOR' ELSE 'INCIP' END AS site_type_2025,
  CASE WHEN s.s_suppkey % 5 = 0 THEN 'NULL' ELSE 'Rec' || CAST(s.s_suppkey % 40 AS VARCHAR) END AS site_name_2024,
  CASE WHEN s.s_suppkey % 5 = 0 THEN 'NULL' ELSE 'BAR' END AS site_type_2024,
  CASE WHEN s.s_suppkey % 2 = 0 THEN 'Shallow' ELSE 'Deep' END AS transect,
  CASE WHEN s.s_suppkey % 7 = 0 THEN 'NULL' ELSE CAST(36.6 + s.s_suppkey * 0.0001 AS VARCHAR) END AS old_latitude,
  CAST(-121.9 - s.s_suppkey * 0.0001 AS VARCHAR) AS old_longitude,
  CAST(36.6 + s.s_suppkey * 0.0002 AS VARCHAR) AS new_latitude,
  CAST(-121.9 - s.s_suppkey * 0.0002 AS VARCHAR) AS new_longitude,
  strftime(DATE '2024-07-01' + CAST(s.s_suppkey % 60 AS INTEGER), '%Y-%m-%d') AS original_date_surveyed_2024,
  strftime(DATE '2025-07-01' + CAST(s.s_suppkey % 60 AS INTEGER), '%-m/%-d/%Y') AS original_date_surveyed_2025,
  CASE WHEN s.s_suppkey % 6 = 0 THEN strftime(DATE '2024-09-01' + CAST(s.s_suppkey % 20 AS INTEGER), '%Y-%m-%d') ELSE 'NULL' END AS resite_date_2024,
  CASE WHEN s.s_suppkey % 8 = 0 THEN strftime(DATE '2025-09-01' + CAST(s.s_suppkey % 20 AS INTEGER), '%-m/%-d/%Y') ELSE 'NULL' END AS resite_date_2025
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
"""


def _recovery_sheet(spark, sf):
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    k = F.col("s_suppkey")
    typ = F.when(k % 3 == 0, "BAR").when(k % 3 == 1, "FOR").otherwise("INCIP")

    def day(base, off):
        return F.date_add(F.to_date(F.lit(base)), off.cast("int"))

    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        F.lit("Recovery").alias("survey_type"), F.col("n_name").alias("region"),
        F.concat(F.lit("rec"), (k % 40).cast("string"), F.lit("_"), typ).alias("site_name_2025"),
        typ.alias("site_type_2025"),
        F.when(k % 5 == 0, "NULL").otherwise(F.concat(F.lit("Rec"), (k % 40).cast("string"))).alias("site_name_2024"),
        F.when(k % 5 == 0, "NULL").otherwise(F.lit("BAR")).alias("site_type_2024"),
        F.when(k % 2 == 0, "Shallow").otherwise("Deep").alias("transect"),
        F.when(k % 7 == 0, "NULL").otherwise((F.lit(36.6) + k * F.lit(0.0001)).cast("string")).alias("old_latitude"),
        (F.lit(-121.9) - k * F.lit(0.0001)).cast("string").alias("old_longitude"),
        (F.lit(36.6) + k * F.lit(0.0002)).cast("string").alias("new_latitude"),
        (F.lit(-121.9) - k * F.lit(0.0002)).cast("string").alias("new_longitude"),
        F.date_format(day("2024-07-01", k % 60), "yyyy-MM-dd").alias("original_date_surveyed_2024"),
        F.date_format(day("2025-07-01", k % 60), "M/d/yyyy").alias("original_date_surveyed_2025"),
        F.when(k % 6 == 0, F.date_format(day("2024-09-01", k % 20), "yyyy-MM-dd")).otherwise("NULL").alias("resite_date_2024"),
        F.when(k % 8 == 0, F.date_format(day("2025-09-01", k % 20), "M/d/yyyy")).otherwise("NULL").alias("resite_date_2025"))


def _nul(x):
    return f"CASE WHEN {x} = 'NULL' THEN NULL ELSE {x} END"


SITE2_SQL = f"""
WITH t AS ({_RECOVERY_SHEET_SQL})
SELECT survey_type, region,
  {sql_standardize(_nul('site_name_2025'))} AS site_name_2025, {_nul('site_type_2025')} AS site_type_2025,
  {sql_standardize(_nul('site_name_2024'))} AS site_name_2024, {_nul('site_type_2024')} AS site_type_2024,
  transect AS zone,
  round(TRY_CAST({_nul('new_latitude')} AS DOUBLE), 6) AS latitude, round(TRY_CAST({_nul('new_longitude')} AS DOUBLE), 6) AS longitude,
  round(TRY_CAST({_nul('old_latitude')} AS DOUBLE), 6) AS latitude_old, round(TRY_CAST({_nul('old_longitude')} AS DOUBLE), 6) AS longitude_old,
  CAST(coalesce(try_strptime({_nul('resite_date_2024')}, '%Y-%m-%d'), try_strptime({_nul('original_date_surveyed_2024')}, '%Y-%m-%d')) AS DATE) AS survey_date_2024,
  CAST(coalesce(try_strptime({_nul('resite_date_2025')}, '%m/%d/%Y'), try_strptime({_nul('original_date_surveyed_2025')}, '%m/%d/%Y')) AS DATE) AS survey_date_2025
FROM t
"""


@register("site2_recovery_sites", ("SITE-2", "SITE-3", "NRM-3", "NRM-5"), SITE2_SQL)
def site2_recovery_sites(spark, sf):
    """Recovery site table: token NULLs, coordinates, official dates per year."""
    r = st.build_recovery_sites(_recovery_sheet(spark, sf))
    return r.withColumns({c: r6(c) for c in ("latitude", "longitude", "latitude_old", "longitude_old")})


# ----------------------------------------------------------------- SITE-4 --

def _site_table(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select((k + F.when(k % 7 == 0, F.lit(100000)).otherwise(F.lit(0))).alias("site_key"),
                    F.col("c_name").alias("official_name"), F.col("c_mktsegment").alias("segment"))


_SITES_SQL = """SELECT c_custkey + CASE WHEN c_custkey % 7 = 0 THEN 100000 ELSE 0 END AS site_key,
  c_name AS official_name, c_mktsegment AS segment FROM customer"""


def _site4_sql(year, drop):
    join = "JOIN" if drop else "LEFT JOIN"
    return f"""WITH s AS ({_SITES_SQL})
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
  s.official_name AS site_official, s.segment AS site_segment
FROM orders o {join} s ON o.o_custkey IS NOT DISTINCT FROM s.site_key
WHERE year(o.o_orderdate) = {year}"""


def _resolve(spark, sf, year, unmatched):
    o = table(spark, sf, "orders")
    return st.resolve_official_site(o, _site_table(spark, sf), on={"o_custkey": "site_key"},
                                    take={"site_official": "official_name", "site_segment": "segment"},
                                    year=year, date_col="o_orderdate", unmatched=unmatched)


@register("site4_resolve_drop", ("SITE-4",), _site4_sql(1996, True))
def site4_resolve_drop(spark, sf):
    """Official site for one survey year; data without a site record dropped."""
    return _resolve(spark, sf, 1996, "drop")


@register("site4_resolve_keep", ("SITE-4",), _site4_sql(1997, False))
def site4_resolve_keep(spark, sf):
    """Official site for another year; unmatched rows kept with NULLs."""
    return _resolve(spark, sf, 1997, "keep")


# ----------------------------------------------------------------- SITE-5 --

SITE5_SQL = """SELECT o_orderkey, o_custkey, o_orderdate FROM orders o
WHERE o_orderdate = (SELECT max(o2.o_orderdate) FROM orders o2 WHERE o2.o_custkey = o.o_custkey)"""


@register("site5_latest", ("SITE-5",), SITE5_SQL)
def site5_latest(spark, sf):
    """All rows of each customer's latest order date (ties kept)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return st.latest_per_group(o, ["o_custkey"], "o_orderdate")


# composite key with NULLs, and only the year's own site records
_RECORD_SQL = """SELECT o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS zone, o_orderdate,
  min(o_orderkey) AS official_id FROM orders WHERE o_custkey % 5 <> 0 GROUP BY 1, 2, 3, 4"""
SITE4C_SQL = f"""WITH s AS (SELECT * FROM ({_RECORD_SQL}) WHERE year(o_orderdate) = 1996),
d AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS zone, o_orderdate FROM orders)
SELECT d.*, s.official_id FROM d LEFT JOIN s ON d.o_custkey IS NOT DISTINCT FROM s.o_custkey AND d.o_orderstatus IS NOT DISTINCT FROM s.o_orderstatus
  AND d.zone IS NOT DISTINCT FROM s.zone AND d.o_orderdate IS NOT DISTINCT FROM s.o_orderdate WHERE year(d.o_orderdate) = 1996"""


@register("site4_composite", ("SITE-4",), SITE4C_SQL)
def site4_composite(spark, sf):
    """Official record by site, type, zone and date (NULL zones match), records of the survey year only."""
    zone = F.when(F.col("o_orderpriority") == "5-LOW", None).otherwise(F.col("o_orderpriority"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", zone.alias("zone"), "o_orderdate")
    keys = ["o_custkey", "o_orderstatus", "zone", "o_orderdate"]
    records = o.where("o_custkey % 5 <> 0").groupBy(*keys).agg(F.min("o_orderkey").alias("official_id"))
    return st.resolve_official_site(o, records, on={k: k for k in keys}, take={"official_id": "official_id"}, year=1996,
                                    date_col="o_orderdate", unmatched="keep", site_year=F.year("o_orderdate"))


# unmatched rows go in even years and stay in odd ones; the latest date is that
# of the official site, or of the sheet's own site where there is none
SITE45_SQL = f"""WITH s AS ({_SITES_SQL}),
u AS (SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, s.official_name AS site_official FROM orders o LEFT JOIN s ON o.o_custkey IS NOT DISTINCT FROM s.site_key
  WHERE s.site_key IS NOT NULL OR year(o.o_orderdate) % 2 = 1)
SELECT o_orderkey, o_custkey, site_official, o_orderdate FROM (
  SELECT *, max(o_orderdate) OVER (PARTITION BY coalesce(site_official, 'sheet ' || o_custkey), year(o_orderdate)) AS latest FROM u)
WHERE o_orderdate = latest"""


@register("site45_resolve_latest", ("SITE-4", "SITE-5", "SRC-4"), SITE45_SQL)
def site45_resolve_latest(spark, sf):
    """Every year: official site (unmatched by the year's rule), latest survey per site or sheet's own site."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    r = st.resolve_official_site(o, _site_table(spark, sf), on={"o_custkey": "site_key"}, take={"site_official": "official_name"}, unmatched="keep")
    r = r.where(F.col("site_official").isNotNull() | (F.year("o_orderdate") % 2 == 1))
    r = r.withColumn("__site", F.coalesce("site_official", F.concat(F.lit("sheet "), F.col("o_custkey")))).withColumn("__y", F.year("o_orderdate"))
    return st.latest_per_group(r, ["__site", "__y"], "o_orderdate").select("o_orderkey", "o_custkey", "site_official", "o_orderdate")
