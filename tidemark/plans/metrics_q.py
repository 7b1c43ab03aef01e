"""Registered metric queries (MET family) on lineitem / orders / supplier.

Survey roles: an order is a sampling unit, ``l_returnflag`` a species,
``l_quantity`` a count, ``l_discount`` an individual size, ``l_linenumber`` a
transect or subsample; NULL gaps are made with CASE expressions written the
same way in Spark and SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import metrics as mt
from tidemark.plans.common import LINE_KEYS, r6, register, table

_LK = ", ".join(LINE_KEYS)
SPECIES = ["A", "N", "R"]


def _r6_all(df, keep):
    return df.select(*[F.col(c) if c in keep else r6(c).alias(c) for c in df.columns])


def _ln():
    return F.col("l_linenumber")


# ----------------------------------------------------------------- MET-1 ---

MET1_SQL = f"""
WITH t AS (SELECT {_LK},
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS cnt,
  CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN 0 ELSE l_linenumber END AS smp
  FROM lineitem)
SELECT {_LK},
  round(CASE WHEN coalesce(smp, 4) = 0 THEN NULL ELSE coalesce(cnt, 0) * (4.0 / coalesce(smp, 4)) END, 6) AS density_m2,
  round(CASE WHEN coalesce(smp, 4) = 0 THEN NULL ELSE cnt * (4.0 / coalesce(smp, 4)) END, 6) AS density_nodefault
FROM t
"""


@register("met1_extrapolate", ("MET-1",), MET1_SQL)
def met1_extrapolate(spark, sf):
    """Subsampled counts scaled to the full unit (with and without defaults)."""
    li = table(spark, sf, "lineitem")
    d = li.select(*LINE_KEYS,
                  F.when(_ln() == 1, None).otherwise(F.col("l_quantity")).alias("cnt"),
                  F.when(_ln() == 2, None).when(_ln() == 3, 0).otherwise(_ln()).alias("smp"))
    d = mt.extrapolate(d, {"density_m2": ("cnt", "smp")}, full=4)
    d = mt.extrapolate(d, {"density_nodefault": ("cnt", "smp")}, full=4, count_default=None)
    return _r6_all(d.select(*LINE_KEYS, "density_m2", "density_nodefault"), LINE_KEYS)


# ----------------------------------------------------------------- MET-2 ---

MET2_SQL = f"""
WITH t AS (SELECT {_LK}, l_quantity,
  CASE WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber = 6 THEN 30 WHEN l_linenumber = 2 THEN 10
       ELSE l_linenumber * 5 - 3 END AS meter FROM lineitem),
u AS (SELECT *, coalesce(CASE WHEN meter < 10 THEN meter WHEN meter >= 10 AND meter <= 20 THEN meter - 10
                              WHEN meter >= 20 AND meter <= 30 THEN 30 - meter ELSE meter END, 10) AS lin FROM t)
SELECT {_LK}, round(l_quantity * CASE WHEN lin = 0 THEN 1 ELSE 10.0 / lin END, 6) AS density_20m2 FROM u
"""


@register("met2_swath_density", ("MET-2",), MET2_SQL)
def met2_swath_density(spark, sf):
    """Subsample length repaired from transect positions, scaled to 20 m2."""
    li = table(spark, sf, "lineitem")
    meter = (F.when(_ln() == 4, None).when(_ln() == 6, 30).when(_ln() == 2, 10).otherwise(_ln() * 5 - 3))
    d = mt.swath_density(li.withColumn("meter", meter), "l_quantity", "meter")
    return _r6_all(d.select(*LINE_KEYS, "density_20m2"), LINE_KEYS)


# ----------------------------------------------------------------- MET-3 ---

COVER_VALUES = ["A", "N", "R", "O", "F", "D"]
_PTS_SQL = """pts AS (
  SELECT l_orderkey, l_returnflag AS cls FROM lineitem
  UNION ALL SELECT l_orderkey, l_linestatus FROM lineitem
  UNION ALL SELECT l_orderkey, CASE WHEN l_discount > 0.05 THEN 'D' END FROM lineitem),
p AS (SELECT * FROM pts WHERE cls IS NOT NULL),
tot AS (SELECT l_orderkey, count(*) AS tot FROM p GROUP BY 1),
c AS (SELECT l_orderkey, cls, count(*) AS n FROM p GROUP BY 1, 2)"""


def _cover_sql(share_expr, suffix=""):
    cols = ", ".join(f"round(coalesce(max(CASE WHEN cls = '{v}' THEN share END), 0), 6) AS cov_{v.lower()}{suffix}"
                     for v in COVER_VALUES)
    return f"""WITH {_PTS_SQL},
s AS (SELECT c.l_orderkey, cls, {share_expr} AS share FROM c JOIN tot USING (l_orderkey))
SELECT l_orderkey, {cols} FROM s GROUP BY l_orderkey"""


def _points(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", F.col("l_returnflag").alias("p1"), F.col("l_linestatus").alias("p2"),
                     F.when(F.col("l_discount") > 0.05, "D").alias("p3"))


@register("met3_percent_cover", ("MET-3",), _cover_sql("n / tot * 100"))
def met3_percent_cover(spark, sf):
    """Point-contact cover per unit over observed points, x100, wide with 0."""
    w = mt.percent_cover(_points(spark, sf), ["l_orderkey"], ["p1", "p2", "p3"], values=COVER_VALUES)
    return _r6_all(w, ["l_orderkey"])


@register("met3_percent_cover_fixed", ("MET-3",), _cover_sql("n / 8 * 100"))
def met3_percent_cover_fixed(spark, sf):
    """Legacy variant: fixed denominator of 8 points."""
    w = mt.percent_cover(_points(spark, sf), ["l_orderkey"], ["p1", "p2", "p3"], denominator=8,
                         values=COVER_VALUES)
    return _r6_all(w, ["l_orderkey"])


# ----------------------------------------------------------------- MET-4 ---

_RW = ["p1", "p2", "p3", "p4"]


def _rw_sql():
    base = f"""WITH t AS (SELECT {_LK}, l_returnflag AS p1, l_linestatus AS p2,
  CASE WHEN l_discount > 0.05 THEN 'F' END AS p3, CASE WHEN l_tax > 0.04 THEN 'R' ELSE 'N' END AS p4 FROM lineitem)"""
    nobs = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _RW)
    anynull = " OR ".join(f"{c} IS NULL" for c in _RW)
    outs = []
    for v in ("F", "R"):
        hits = " + ".join(f"CAST(coalesce({c} = '{v}', false) AS INTEGER)" for c in _RW)
        share = f"CASE WHEN ({nobs}) = 0 THEN NULL ELSE ({hits}) / ({nobs}) END"
        outs.append(f"round(CASE WHEN {anynull} THEN NULL ELSE {share} END, 6) AS sub_{v.lower()}")
        outs.append(f"round({share}, 6) AS rel_{v.lower()}")
    return f"{base}\nSELECT {_LK}, {', '.join(outs)} FROM t"


@register("met4_rowwise_share", ("MET-4",), _rw_sql())
def met4_rowwise_share(spark, sf):
    """Row-wise category shares; NULL points poison (substrate) or are skipped (relief)."""
    li = table(spark, sf, "lineitem")
    d = li.select(*LINE_KEYS, F.col("l_returnflag").alias("p1"), F.col("l_linestatus").alias("p2"),
                  F.when(F.col("l_discount") > 0.05, "F").alias("p3"),
                  F.when(F.col("l_tax") > 0.04, "R").otherwise("N").alias("p4"))
    d = mt.rowwise_share(d, _RW, {"sub_f": "F", "sub_r": "R"}, na_rm=False)
    d = mt.rowwise_share(d, _RW, {"rel_f": "F", "rel_r": "R"}, na_rm=True)
    return _r6_all(d.select(*LINE_KEYS, "sub_f", "rel_f", "sub_r", "rel_r"), LINE_KEYS)


# ----------------------------------------------------------------- MET-5 ---

MET5_SQL = """
SELECT l_orderkey, count(*) AS n_individuals
FROM lineitem, unnest(range(CAST(l_quantity AS BIGINT))) AS u(i)
GROUP BY l_orderkey
"""


@register("met5_uncount", ("MET-5",), MET5_SQL)
def met5_uncount(spark, sf):
    """Counted rows expanded to individuals, then counted per unit."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    return mt.uncount(li, "l_quantity").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_individuals"))


# ----------------------------------------------------------------- MET-6 ---

# every individual is a row: the mean and sample sd by definition
_SIZE_CTE = """sz_l AS (SELECT l_orderkey, l_returnflag AS sp, avg(x) AS mean, stddev_samp(x) AS sd
  FROM (SELECT l_orderkey, l_returnflag, round(l_discount * 100) AS x
        FROM lineitem, unnest(range(CAST(l_quantity AS BIGINT))) AS u(i) WHERE l_discount IS NOT NULL) GROUP BY 1, 2),
sz AS (SELECT l_orderkey, """ + ", ".join(
    f"max(CASE WHEN sp = '{v}' THEN mean END) AS sz_mean_{v.lower()}, max(CASE WHEN sp = '{v}' THEN sd END) AS sz_sd_{v.lower()}"
    for v in SPECIES) + " FROM sz_l GROUP BY l_orderkey)"

_SZ_COLS = [f"sz_{s}_{v.lower()}" for v in SPECIES for s in ("mean", "sd")]

MET6_SQL = f"WITH {_SIZE_CTE}\nSELECT l_orderkey, " + ", ".join(f"round({c}, 6) AS {c}" for c in _SZ_COLS) + " FROM sz"


def _size(spark, sf):
    # sizes in whole units (discount points), as survey sizes are whole cm
    li = table(spark, sf, "lineitem").withColumn("size_cm", F.round(F.col("l_discount") * 100))
    return mt.size_stats(li, ["l_orderkey"], "l_returnflag", "size_cm", "l_quantity", values=SPECIES)


@register("met6_size_stats", ("MET-6",), MET6_SQL)
def met6_size_stats(spark, sf):
    """Count-weighted size mean and sd per unit and species, wide."""
    return _r6_all(_size(spark, sf), ["l_orderkey"])


# ----------------------------------------------------------------- MET-7 ---

_PLANT_CTE = """pl AS (SELECT l_orderkey, count(*) AS n_plants, avg(l_quantity) AS mean_value,
  stddev_samp(l_quantity) AS sd_value FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_orderkey)"""

MET7_SQL = f"WITH {_PLANT_CTE}\nSELECT l_orderkey, n_plants, round(mean_value, 6) AS mean_value, round(sd_value, 6) AS sd_value FROM pl"


def _plants(spark, sf):
    li = table(spark, sf, "lineitem")
    return mt.plant_stats(li, ["l_orderkey"], "l_quantity", where=F.col("l_returnflag") == "N")


@register("met7_plant_stats", ("MET-7",), MET7_SQL)
def met7_plant_stats(spark, sf):
    """Plant count, mean and sd of stipes for one species per unit."""
    return _r6_all(_plants(spark, sf), ["l_orderkey", "n_plants"])


# ----------------------------------------------------------------- MET-8 ---

MET8_SQL = """
WITH g AS (SELECT s_suppkey, s_name, CAST(t.transect AS INTEGER) AS transect
           FROM supplier CROSS JOIN (SELECT unnest(range(1, max(l_linenumber) + 1)) AS transect FROM lineitem) AS t),
m AS (SELECT l_suppkey AS s_suppkey, l_linenumber AS transect, count(*) AS n_lines, sum(l_quantity) AS qty
      FROM lineitem GROUP BY 1, 2)
SELECT g.s_suppkey, g.s_name, g.transect, coalesce(m.n_lines, 0) AS n_lines, round(coalesce(m.qty, 0), 6) AS qty
FROM g LEFT JOIN m ON g.s_suppkey = m.s_suppkey AND g.transect = m.transect
"""


def _supplier_metrics(spark, sf):
    li = table(spark, sf, "lineitem")
    return (li.groupBy(F.col("l_suppkey").alias("s_suppkey"), F.col("l_linenumber").alias("transect"))
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty")))


@register("met8_true_zero_grid", ("MET-8",), MET8_SQL)
def met8_true_zero_grid(spark, sf):
    """Every supplier x transect (all that occur) with its line metrics, absent -> 0."""
    units = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    g = mt.true_zero_grid(units, None, _supplier_metrics(spark, sf), ["s_suppkey"], ["n_lines", "qty"])
    return _r6_all(g, ["s_suppkey", "s_name", "transect", "n_lines"])


# ----------------------------------------------------------------- MET-9 ---

_DENS_CTE = "dn AS (SELECT l_orderkey, " + ", ".join(
    f"coalesce(sum(CASE WHEN l_returnflag = '{v}' THEN l_extendedprice END), 0) AS density_{v.lower()}"
    for v in SPECIES) + " FROM lineitem GROUP BY l_orderkey)"

MET9_SQL = f"WITH {_DENS_CTE}\nSELECT l_orderkey, " + ", ".join(
    f"round(density_{v.lower()}, 6) AS density_{v.lower()}" for v in SPECIES) + " FROM dn"


def _density(spark, sf):
    li = table(spark, sf, "lineitem")
    return mt.pivot_density(li, ["l_orderkey"], "l_returnflag", "l_extendedprice", values=SPECIES)


@register("met9_pivot_density", ("MET-9",), MET9_SQL)
def met9_pivot_density(spark, sf):
    """Long densities to one column per species, summed, 0 where absent."""
    return _r6_all(_density(spark, sf), ["l_orderkey"])


# ---------------------------------------------------------------- MET-10 ---

_CLAMP_INNER = f"""SELECT {_LK},
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_discount * 100 END AS part,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE l_tax * 100 END AS whole FROM lineitem"""

MET10_SQL = f"""WITH t AS ({_CLAMP_INNER})
SELECT {_LK}, round(CASE WHEN part > whole THEN whole ELSE part END, 6) AS part, round(whole, 6) AS whole FROM t"""


def _clamped(spark, sf):
    li = table(spark, sf, "lineitem")
    d = li.select(*LINE_KEYS, F.when(_ln() == 1, None).otherwise(F.col("l_discount") * 100).alias("part"),
                  F.when(_ln() == 2, None).otherwise(F.col("l_tax") * 100).alias("whole"))
    return mt.clamp(d, "part", "whole")


@register("met10_clamp", ("MET-10",), MET10_SQL)
def met10_clamp(spark, sf):
    """Concealed capped at total; a NULL on either side leaves the value."""
    return _r6_all(_clamped(spark, sf), LINE_KEYS)


# ---------------------------------------------------------------- MET-11 ---

MET11_SQL = f"""WITH t AS (SELECT {_LK}, CASE WHEN l_quantity = 50 THEN 5 ELSE l_quantity END AS relief,
  l_linenumber AS risk FROM lineitem)
SELECT {_LK}, round(relief * 10, 6) AS relief_cm, round(risk * 5 + 141.4, 6) AS risk_cm,
  round((risk * 5 + 141.4) - 141.4, 6) AS risk_index FROM t"""


@register("met11_relief_risk", ("MET-11", "NRM-10"), MET11_SQL)
def met11_relief_risk(spark, sf):
    """Relief and risk measures after a point correction of relief."""
    li = table(spark, sf, "lineitem").select(*LINE_KEYS, F.col("l_quantity").alias("relief"),
                                             F.col("l_linenumber").alias("risk"))
    from tidemark.operators.normalize import patch_values
    d = mt.relief_risk(patch_values(li, "relief", F.col("relief") == 50, 5.0))
    return _r6_all(d.select(*LINE_KEYS, "relief_cm", "risk_cm", "risk_index"), LINE_KEYS)


# ---------------------------------------------------------------- MET-12 ---

MET12_SQL = f"""SELECT {_LK}, round(((l_discount + 0.000001) / l_tax) * 100, 6) AS gonad_index FROM lineitem
WHERE l_tax <> 0 AND ((l_discount + 0.000001) / l_tax) * 100 < 40"""


@register("met12_gonad_index", ("MET-12",), MET12_SQL)
def met12_gonad_index(spark, sf):
    """(gonad + 1e-6) / mass x 100, implausible (>= 40) and undefined dropped."""
    li = table(spark, sf, "lineitem")
    d = mt.gonad_index(li, "l_discount", "l_tax")
    return _r6_all(d.select(*LINE_KEYS, "gonad_index"), LINE_KEYS)


# ---------------------------------------------------------------- MET-13 ---

MET13_SQL = f"""WITH t AS (SELECT {_LK}, l_quantity,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS disc,
  CASE WHEN l_linenumber IN (4, 5) THEN NULL ELSE l_tax END AS tax,
  CASE WHEN l_linenumber IN (5, 6) THEN NULL ELSE l_extendedprice END AS price FROM lineitem)
SELECT {_LK} FROM t
WHERE (l_quantity < 45 OR l_quantity IS NULL) AND (disc < 0.09 OR disc IS NULL)
  AND NOT (tax IS NULL AND price IS NULL)"""


@register("met13_drop_outliers", ("MET-13",), MET13_SQL)
def met13_drop_outliers(spark, sf):
    """Outliers beyond limits dropped (NULL kept); all-NULL measure rows dropped."""
    li = table(spark, sf, "lineitem")
    d = li.select(*LINE_KEYS, "l_quantity",
                  F.when(_ln() == 3, None).otherwise(F.col("l_discount")).alias("disc"),
                  F.when(_ln().isin(4, 5), None).otherwise(F.col("l_tax")).alias("tax"),
                  F.when(_ln().isin(5, 6), None).otherwise(F.col("l_extendedprice")).alias("price"))
    d = mt.drop_outliers(d, {"l_quantity": 45, "disc": 0.09}, ["tax", "price"])
    return d.select(*LINE_KEYS)


# ---------------------------------------------------------------- MET-14 ---

MET14_SQL = """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderkey AS DOUBLE)
       ELSE CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DOUBLE) END AS sample_number
FROM orders"""


@register("met14_renumber", ("MET-14",), MET14_SQL)
def met14_renumber(spark, sf):
    """Renumber within customer by date, except one class keeps its own id."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    d = mt.renumber(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "P",
                    "o_orderkey", out="sample_number")
    return d.select("o_orderkey", "o_custkey", "sample_number")


# ---------------------------------------------------------------- MET-15 ---

_SUM_CTE = """gs AS (SELECT l_orderkey, count(*) AS n_lines, avg(l_quantity) AS mean_quantity,
  avg(l_discount) AS mean_discount, stddev_samp(l_quantity) AS sd_quantity,
  avg(CAST(l_returnflag = 'R' AS DOUBLE)) AS prop_r, avg(CAST(l_linestatus = 'F' AS DOUBLE)) AS prop_f
  FROM lineitem GROUP BY l_orderkey)"""

MET15_SQL = f"""WITH {_SUM_CTE}
SELECT l_orderkey, n_lines, round(mean_quantity, 6) AS mean_quantity, round(mean_discount, 6) AS mean_discount,
  round(sd_quantity, 6) AS sd_quantity, round(prop_r, 6) AS prop_r, round(prop_f, 6) AS prop_f FROM gs"""


def _summary(spark, sf):
    li = table(spark, sf, "lineitem")
    return mt.group_summary(li, ["l_orderkey"], "n_lines",
                            means={"mean_quantity": "l_quantity", "mean_discount": "l_discount"},
                            sds={"sd_quantity": "l_quantity"},
                            props={"prop_r": F.col("l_returnflag") == "R", "prop_f": F.col("l_linestatus") == "F"})


@register("met15_group_summary", ("MET-15",), MET15_SQL)
def met15_group_summary(spark, sf):
    """Per-unit n, means, sd and class proportions (dissection summary shape)."""
    return _r6_all(_summary(spark, sf), ["l_orderkey", "n_lines"])


# ---------------------------------------------------------------- MET-16 ---

_URCH_CTE = f"""ur AS (SELECT l_orderkey, avg(part) AS den_part, avg(whole) AS den_whole FROM (
  SELECT l_orderkey, CASE WHEN part > whole THEN whole ELSE part END AS part, whole FROM ({_CLAMP_INNER}) x) y
  GROUP BY l_orderkey)"""

_MARGIN_COLS = (["n_plants", "mean_value", "sd_value"] + [f"density_{v.lower()}" for v in SPECIES]
                + ["den_part", "den_whole"] + _SZ_COLS)

# the base is the cover table; official records follow the rule of their year
# (1996: customer, date and status; 1997: customer and status), and the
# dissection summary is one row for each customer and date
_RULES = {1996: ["o_custkey", "o_orderdate", "o_orderstatus"], 1997: ["o_custkey", "o_orderstatus"]}
_COVER_COLS = [f"cov_{v.lower()}" for v in COVER_VALUES]
_RECORDS_SQL = """rec AS (SELECT o_custkey, o_orderdate, o_orderstatus, year(o_orderdate) AS yr, o_orderkey AS site_id, o_orderpriority AS site_name
  FROM orders WHERE o_custkey % 3 <> 0)"""

MET16_SQL = f"""WITH {_PTS_SQL},
cv_s AS (SELECT c.l_orderkey, cls, n / tot * 100 AS share FROM c JOIN tot USING (l_orderkey)),
cv AS (SELECT l_orderkey, {", ".join(f"coalesce(max(CASE WHEN cls = '{v}' THEN share END), 0) AS cov_{v.lower()}" for v in COVER_VALUES)}
  FROM cv_s GROUP BY l_orderkey),
{_PLANT_CTE}, {_DENS_CTE}, {_URCH_CTE}, {_SIZE_CTE}, {_RECORDS_SQL},
r96 AS (SELECT o_custkey, o_orderdate, o_orderstatus, min(site_id) AS site_id FROM rec WHERE yr = 1996 GROUP BY 1, 2, 3),
r97 AS (SELECT o_custkey, o_orderstatus, min(site_id) AS site_id FROM rec WHERE yr = 1997 GROUP BY 1, 2),
ds AS (SELECT o_custkey, o_orderdate, count(*) AS n_dissected, avg(o_totalprice) AS mean_total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, {", ".join(f"round(cv.{c}, 6) AS {c}" for c in _COVER_COLS)},
  coalesce(pl.n_plants, 0) AS n_plants, round(coalesce(pl.mean_value, 0), 6) AS mean_value,
  round(coalesce(pl.sd_value, 0), 6) AS sd_value,
  {", ".join(f"round(coalesce(dn.density_{v.lower()}, 0), 6) AS density_{v.lower()}" for v in SPECIES)},
  round(ur.den_part, 6) AS den_part, round(ur.den_whole, 6) AS den_whole,
  {", ".join(f"round(sz.{c}, 6) AS {c}" for c in _SZ_COLS)},
  CASE WHEN year(o.o_orderdate) = 1996 THEN r96.site_id WHEN year(o.o_orderdate) = 1997 THEN r97.site_id END AS site_id,
  (SELECT min(site_name) FROM rec WHERE rec.site_id = CASE WHEN year(o.o_orderdate) = 1996 THEN r96.site_id WHEN year(o.o_orderdate) = 1997 THEN r97.site_id END) AS site_name,
  ds.n_dissected, round(ds.mean_total, 6) AS mean_total
FROM cv JOIN orders o ON o.o_orderkey = cv.l_orderkey
LEFT JOIN pl ON o.o_orderkey = pl.l_orderkey
LEFT JOIN dn ON o.o_orderkey = dn.l_orderkey
LEFT JOIN ur ON o.o_orderkey = ur.l_orderkey
LEFT JOIN sz ON o.o_orderkey = sz.l_orderkey
LEFT JOIN r96 ON o.o_custkey = r96.o_custkey AND o.o_orderdate = r96.o_orderdate AND o.o_orderstatus = r96.o_orderstatus
LEFT JOIN r97 ON o.o_custkey = r97.o_custkey AND o.o_orderstatus = r97.o_orderstatus
LEFT JOIN ds ON o.o_custkey = ds.o_custkey AND o.o_orderdate = ds.o_orderdate"""


def _by_order(df):
    return df.withColumnRenamed("l_orderkey", "o_orderkey")


@register("met16_assemble_margin", ("MET-16",), MET16_SQL)
def met16_assemble_margin(spark, sf):
    """Cover base + plants + densities + clamped urchins + sizes, official records by year, dissection summary."""
    o = table(spark, sf, "orders")
    cover = _by_order(mt.percent_cover(_points(spark, sf), ["l_orderkey"], ["p1", "p2", "p3"], values=COVER_VALUES))
    head = o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", F.year("o_orderdate").alias("yr"))
    base = cover.join(head, "o_orderkey")
    urch = _clamped(spark, sf).groupBy("l_orderkey").agg(F.avg("part").alias("den_part"),
                                                         F.avg("whole").alias("den_whole"))
    dens = _density(spark, sf)
    records = o.where("o_custkey % 3 <> 0").select("o_custkey", "o_orderdate", "o_orderstatus", F.year("o_orderdate").alias("yr"),
                                                   F.col("o_orderkey").alias("site_id"), F.col("o_orderpriority").alias("site_name"))
    dissected = mt.group_summary(o.where("o_orderstatus = 'F'"), ["o_custkey", "o_orderdate"], "n_dissected", means={"mean_total": "o_totalprice"})
    out = mt.assemble_margin(base, _by_order(_plants(spark, sf)), _by_order(dens), _by_order(urch),
                             _by_order(_size(spark, sf)), ["o_orderkey"],
                             macro_fill=["n_plants", "mean_value", "sd_value"],
                             algae_fill=[c for c in dens.columns if c != "l_orderkey"], null_keys=False,
                             sites=(records, "yr", _RULES, ["site_id", "site_name"]), dissection=(dissected, ["o_custkey", "o_orderdate"]))
    keep = ["o_orderkey", "o_custkey", "o_orderdate", "n_plants", "site_id", "site_name", "n_dissected"]
    return _r6_all(out.select("o_orderkey", "o_custkey", "o_orderdate", *_COVER_COLS, *_MARGIN_COLS, "site_id", "site_name", "n_dissected", "mean_total"), keep)


# ---------------------------------------------------------------- MET-17 ---

MET17_SQL = """
WITH g AS (SELECT s_suppkey, CAST(t.transect AS INTEGER) AS transect
           FROM supplier CROSS JOIN (SELECT unnest(range(1, max(l_linenumber) + 1)) AS transect FROM lineitem) AS t),
d AS (SELECT l_suppkey AS s_suppkey, l_linenumber AS transect, """ + ", ".join(
    f"sum(CASE WHEN l_returnflag = '{v}' THEN l_quantity END) AS density_{v.lower()}" for v in SPECIES) + """
      FROM lineitem GROUP BY 1, 2)
SELECT g.s_suppkey, g.transect, """ + ", ".join(
    f"round(coalesce(d.density_{v.lower()}, 0), 6) AS density_{v.lower()}" for v in SPECIES) + """
FROM g LEFT JOIN d ON g.s_suppkey = d.s_suppkey AND g.transect = d.transect
"""


@register("met17_assemble_swath", ("MET-17", "MET-8", "MET-9"), MET17_SQL)
def met17_assemble_swath(spark, sf):
    """Zero grid of supplier transects joined with per-species densities."""
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"),
                                             F.col("l_linenumber").alias("transect"), "l_returnflag", "l_quantity")
    dens = mt.pivot_density(li, ["s_suppkey", "transect"], "l_returnflag", "l_quantity", values=SPECIES)
    grid = mt.true_zero_grid(table(spark, sf, "supplier").select("s_suppkey"), None, li.select("s_suppkey", "transect").distinct(),
                             ["s_suppkey"], [])
    out = mt.assemble_swath(grid, dens, ["s_suppkey", "transect"], [f"density_{v.lower()}" for v in SPECIES], null_keys=False)
    return _r6_all(out, ["s_suppkey", "transect"])


# ---------------------------------------------------------------- MET-18 ---

MET18_SQL = f"""WITH {_PLANT_CTE}, {_DENS_CTE}, {_SIZE_CTE}
SELECT o.o_orderkey, pl.n_plants, round(pl.mean_value, 6) AS mean_value, round(pl.sd_value, 6) AS sd_value,
  {", ".join(f"round(dn.density_{v.lower()}, 6) AS density_{v.lower()}" for v in SPECIES)},
  {", ".join(f"round(sz.{c}, 6) AS {c}" for c in _SZ_COLS)}
FROM orders o
LEFT JOIN pl ON o.o_orderkey = pl.l_orderkey
LEFT JOIN dn ON o.o_orderkey = dn.l_orderkey
LEFT JOIN sz ON o.o_orderkey = sz.l_orderkey"""


@register("met18_assemble_recovery", ("MET-18",), MET18_SQL)
def met18_assemble_recovery(spark, sf):
    """Legacy combined table: plain left joins, no zero filling."""
    base = table(spark, sf, "orders").select("o_orderkey")
    out = mt.assemble_recovery(base, [_by_order(_plants(spark, sf)), _by_order(_density(spark, sf)),
                                      _by_order(_size(spark, sf))], ["o_orderkey"], null_keys=False)
    return _r6_all(out, ["o_orderkey", "n_plants"])


# ---------------------------------------------------------------- MET-19 ---

_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

MET19_SQL = "SELECT l_returnflag, l_linestatus, " + ", ".join(
    f"round(avg({c}), 6) AS {c}" for c in _NUMS) + " FROM lineitem GROUP BY 1, 2"


@register("met19_mean_all", ("MET-19",), MET19_SQL)
def met19_mean_all(spark, sf):
    """Mean of every numeric column per group."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", *_NUMS)
    return _r6_all(mt.mean_all(li, ["l_returnflag", "l_linestatus"]), ["l_returnflag", "l_linestatus"])


MET19P_SQL = "SELECT l_returnflag, " + ", ".join(
    f"round(avg(CASE WHEN l_linestatus = '{s}' THEN {c} END), 6) AS {c}_{s.lower()}"
    for c in ("l_quantity", "l_discount") for s in ("O", "F")) + " FROM lineitem GROUP BY 1"


@register("met19_mean_pivot", ("MET-19",), MET19P_SQL)
def met19_mean_pivot(spark, sf):
    """Means by one key, pivoted on another with two measures."""
    li = table(spark, sf, "lineitem")
    w = mt.mean_all(li, ["l_returnflag"], ["l_quantity", "l_discount"], pivot="l_linestatus",
                    pivot_values=["O", "F"])
    return _r6_all(w, ["l_returnflag"])
