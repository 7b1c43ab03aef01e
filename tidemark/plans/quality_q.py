"""Registered quality-check queries (QC family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as qc
from tidemark.plans.common import LINE_KEYS, LINEITEM_QC_SQL, lineitem_entry_qc, r6, register, table

_LK = ", ".join(LINE_KEYS)
_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

QC1_SQL = """SELECT user_id, count(DISTINCT event_type) AS n_event_type, count(DISTINCT CAST(ts AS DATE)) AS n_day
FROM events GROUP BY user_id"""


@register("qc1_coverage", ("QC-1",), QC1_SQL)
def qc1_coverage(spark, sf):
    """Distinct event types and days per user."""
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts")).withColumnRenamed("event_type", "event_type")
    return qc.coverage(e, ["user_id"], ["event_type", "day"])


_QC2_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]

QC2_SQL = f"WITH t AS ({LINEITEM_QC_SQL})\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, count(*) - count({c}) AS num_missing FROM t" for c in _QC2_COLS)


@register("qc2_missing_summary", ("QC-2",), QC2_SQL)
def qc2_missing_summary(spark, sf):
    """NULL count per column of an entry, long form."""
    li = table(spark, sf, "lineitem")
    return qc.missing_summary(lineitem_entry_qc(li).select(*_QC2_COLS))


QC3_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, count(CASE WHEN {c} = 0 THEN 1 END) AS num_zeros FROM lineitem" for c in _NUMS)


@register("qc3_zero_summary", ("QC-3",), QC3_SQL)
def qc3_zero_summary(spark, sf):
    """Zero count per numeric column, long form."""
    return qc.zero_summary(table(spark, sf, "lineitem").select(*_NUMS))


QC3N_SQL = f"WITH t AS ({LINEITEM_QC_SQL})\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS variable, CASE WHEN count(*) > count({c}) THEN NULL "
    f"ELSE count(CASE WHEN {c} = 0 THEN 1 END) END AS num_zeros FROM t" for c in _NUMS)


@register("qc3_zero_summary_na", ("QC-3",), QC3N_SQL)
def qc3_zero_summary_na(spark, sf):
    """Same where any NULL makes the column total NULL (R's sum(x == 0))."""
    li = lineitem_entry_qc(table(spark, sf, "lineitem"))
    return qc.zero_summary(li.select(*_NUMS), na_rm=False)


QC4_SQL = f"""SELECT {_LK}, l_discount > l_tax AS concealed_gt_total, l_quantity > 49 AS over_limit
FROM lineitem WHERE l_discount > l_tax OR l_quantity > 49"""


def _rules():
    return {"concealed_gt_total": F.col("l_discount") > F.col("l_tax"),
            "over_limit": F.col("l_quantity") > 49}


@register("qc4_violations", ("QC-4",), QC4_SQL)
def qc4_violations(spark, sf):
    """Rows breaking any rule, one flag per rule."""
    li = table(spark, sf, "lineitem").select(*LINE_KEYS, "l_discount", "l_tax", "l_quantity")
    return qc.violations(li, _rules()).select(*LINE_KEYS, "concealed_gt_total", "over_limit")


QC4A_SQL = """SELECT bool_or(l_discount > l_tax) AS concealed_gt_total, bool_or(l_quantity > 49) AS over_limit
FROM lineitem"""


@register("qc4_any", ("QC-4",), QC4A_SQL)
def qc4_any(spark, sf):
    """Whether each rule is ever broken (one row)."""
    return qc.violations(table(spark, sf, "lineitem"), _rules(), mode="any")


QC6_SQL = """WITH p AS (SELECT l_orderkey, avg(l_quantity) AS mean_value FROM lineitem
  WHERE l_returnflag = 'N' GROUP BY l_orderkey),
j AS (SELECT o.o_orderkey, p.mean_value FROM orders o LEFT JOIN p ON o.o_orderkey = p.l_orderkey)
SELECT count(*) AS total, count(mean_value) AS matched, round(count(mean_value) / count(*), 6) AS share FROM j"""


@register("qc6_join_coverage", ("QC-6",), QC6_SQL)
def qc6_join_coverage(spark, sf):
    """Share of units that found a match in a joined summary."""
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "N")
    p = li.groupBy("l_orderkey").agg(F.avg("l_quantity").alias("mean_value"))
    o = table(spark, sf, "orders").select("o_orderkey")
    j = o.join(p, o["o_orderkey"] == p["l_orderkey"], "left")
    return qc.join_coverage(j, "mean_value").withColumn("share", r6("share"))


QC7_SQL = "SELECT DISTINCT event_type FROM events"


@register("qc7_domain", ("QC-7",), QC7_SQL)
def qc7_domain(spark, sf):
    """Distinct values of a column."""
    return qc.domain(table(spark, sf, "events"), "event_type")


QC8_SQL = """WITH t AS (SELECT event_type, value,
  CASE WHEN value < 0 THEN 0 WHEN value > 500 THEN 26 WHEN value = 500 THEN 25 ELSE CAST(floor((value - 0) * 25 / 500) + 1 AS BIGINT) END AS bin
  FROM events WHERE value IS NOT NULL)
SELECT event_type, bin, count(*) AS n, CASE WHEN bin > 0 THEN round(0 + (bin - 1) * 20.0, 6) END AS bin_lo,
  CASE WHEN bin <= 25 THEN round(0 + bin * 20.0, 6) END AS bin_hi
FROM t GROUP BY event_type, bin"""


@register("qc8_histogram", ("QC-8",), QC8_SQL)
def qc8_histogram(spark, sf):
    """Equal-width histogram counts per group, with bins below and above the range."""
    h = qc.histogram(table(spark, sf, "events"), "value", 0.0, 500.0, 25, keys=["event_type"])
    return h.withColumn("bin_lo", r6("bin_lo")).withColumn("bin_hi", r6("bin_hi"))


QC9_SQL = """WITH q AS (SELECT event_type, count(value) AS n, quantile_cont(value, 0.25) AS q1,
    quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events
    WHERE value IS NOT NULL GROUP BY event_type),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lof, q3 + 1.5 * (q3 - q1) AS hif FROM q)
SELECT f.event_type, f.n, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
  round(min(CASE WHEN e.value >= lof AND e.value <= hif THEN e.value END), 6) AS whisker_lo,
  round(max(CASE WHEN e.value >= lof AND e.value <= hif THEN e.value END), 6) AS whisker_hi,
  count(CASE WHEN NOT (e.value >= lof AND e.value <= hif) THEN 1 END) AS n_outliers
FROM f JOIN events e ON e.event_type = f.event_type AND e.value IS NOT NULL
GROUP BY f.event_type, f.n, f.q1, f.median, f.q3"""


@register("qc9_box_stats", ("QC-9",), QC9_SQL)
def qc9_box_stats(spark, sf):
    """Exact quartiles, whisker ends and outlier counts per group."""
    b = qc.box_stats(table(spark, sf, "events"), ["event_type"], "value")
    return b.withColumns({c: r6(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")})
