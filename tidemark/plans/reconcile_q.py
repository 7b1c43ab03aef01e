"""Registered reconciliation queries (REC, NRM-17, SNK/SRC check shapes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import reconcile as rc
from tidemark.plans.common import (LINE_KEYS, LINEITEM_QC_SQL, ORDERS_QC_SQL, lineitem_entry_qc,
                                   orders_entry_qc, register, sql_num_text, table)

_NS = " IS NOT DISTINCT FROM "


def _ns_on(keys, a="r", b="q"):
    return " AND ".join(f"{a}.{k}{_NS}{b}.{k}" for k in keys)


# ---------------------------------------------------------------- REC-3 ----

def _diff_sql(col, numeric=True, a="r", b="q", policy="ignore"):
    ta = sql_num_text(f"{a}.{col}") if numeric else f"{a}.{col}"
    tb = sql_num_text(f"{b}.{col}") if numeric else f"{b}.{col}"
    if policy == "ignore":
        return f"CASE WHEN {a}.{col} <> {b}.{col} THEN {ta} || ' ≠ ' || {tb} END"
    return (f"CASE WHEN {a}.{col} IS DISTINCT FROM {b}.{col} THEN "
            f"coalesce({ta}, 'NA') || ' ≠ ' || coalesce({tb}, 'NA') END")


REC3_SQL = f"""
WITH qc AS ({LINEITEM_QC_SQL}),
d AS (
  SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, r.l_shipdate,
         {_diff_sql('l_quantity')} AS l_quantity_diff,
         {_diff_sql('l_extendedprice')} AS l_extendedprice_diff,
         {_diff_sql('l_returnflag', numeric=False)} AS l_returnflag_diff
  FROM lineitem r JOIN qc q ON {_ns_on(LINE_KEYS)}
)
SELECT *, '' AS resolved FROM d
WHERE l_quantity_diff IS NOT NULL OR l_extendedprice_diff IS NOT NULL OR l_returnflag_diff IS NOT NULL
"""


@register("rec3_cell_diff", ("REC-3", "SRC-1", "NRM-4"), REC3_SQL)
def rec3_cell_diff(spark, sf):
    """Which cells differ between two entries of lineitem (flagship)."""
    li = table(spark, sf, "lineitem")
    return rc.cell_diff(li, lineitem_entry_qc(li), LINE_KEYS,
                        ["l_quantity", "l_extendedprice", "l_returnflag"],
                        on_duplicates="allow")


# ---------------------------------------------------------------- REC-1 ----

ORD_KEYS = ["o_orderkey", "o_custkey", "o_orderdate"]
_K = ", ".join(ORD_KEYS)

REC1_SQL = f"""
WITH qc AS ({ORDERS_QC_SQL}),
l AS (SELECT DISTINCT {_K} FROM orders),
q AS (SELECT DISTINCT {_K} FROM qc)
SELECT {_K}, 'right' AS missing_in FROM l
WHERE NOT EXISTS (SELECT 1 FROM q WHERE {_ns_on(ORD_KEYS, 'q', 'l')})
UNION ALL
SELECT {_K}, 'left' AS missing_in FROM q
WHERE NOT EXISTS (SELECT 1 FROM l WHERE {_ns_on(ORD_KEYS, 'l', 'q')})
"""


@register("rec1_missing_keys", ("REC-1",), REC1_SQL)
def rec1_missing_keys(spark, sf):
    """Keys entered on one side only, both directions (NULL keys match)."""
    o = table(spark, sf, "orders")
    return rc.missing_keys(o, orders_entry_qc(o), ORD_KEYS)


# --------------------------------------------------- REC-3 flag + year -----

REC3_ORDERS_SQL = f"""
WITH qc AS ({ORDERS_QC_SQL}),
d AS (
  SELECT r.o_orderkey, r.o_orderdate,
         {_diff_sql('o_custkey', policy='flag')} AS o_custkey_diff,
         {_diff_sql('o_totalprice', policy='flag')} AS o_totalprice_diff,
         {_diff_sql('o_orderpriority', numeric=False, policy='flag')} AS o_orderpriority_diff
  FROM orders r JOIN qc q ON {_ns_on(['o_orderkey', 'o_orderdate'])})
SELECT *, '' AS resolved FROM d
WHERE (o_custkey_diff IS NOT NULL OR o_totalprice_diff IS NOT NULL OR o_orderpriority_diff IS NOT NULL)
  AND year(o_orderdate) = 1996
"""


@register("rec3_cell_diff_flag_year", ("REC-3",), REC3_ORDERS_SQL)
def rec3_cell_diff_flag_year(spark, sf):
    """Cell diff where a value against a blank is flagged, one survey year."""
    o = table(spark, sf, "orders")
    return rc.cell_diff(o, orders_entry_qc(o), ["o_orderkey", "o_orderdate"],
                        ["o_custkey", "o_totalprice", "o_orderpriority"], null_policy="flag",
                        year=1996, date_col="o_orderdate")


# ---------------------------------------------------------------- REC-4 ----

REC4_SQL = f"""
WITH qc AS ({ORDERS_QC_SQL}),
d AS (
  SELECT coalesce(r.o_orderkey, q.o_orderkey) AS o_orderkey,
         coalesce(r.o_orderstatus, q.o_orderstatus) AS o_orderstatus,
         {_diff_sql('o_totalprice', policy='flag')} AS o_totalprice_diff,
         {_diff_sql('o_orderpriority', numeric=False, policy='flag')} AS o_orderpriority_diff
  FROM orders r FULL OUTER JOIN qc q ON {_ns_on(['o_orderkey', 'o_orderstatus'])})
SELECT *, '' AS resolved FROM d
WHERE o_orderstatus <> 'P' AND (o_totalprice_diff IS NOT NULL OR o_orderpriority_diff IS NOT NULL)
"""


@register("rec4_full_diff", ("REC-4",), REC4_SQL)
def rec4_full_diff(spark, sf):
    """Full-outer cell diff: keys on one side only surface as ``NA ≠ x``."""
    o = table(spark, sf, "orders")
    return rc.cell_diff(o, orders_entry_qc(o), ["o_orderkey", "o_orderstatus"],
                        ["o_totalprice", "o_orderpriority"], null_policy="flag", how="full",
                        where=F.col("o_orderstatus") != "P")


# ---------------------------------------------------------------- REC-5 ----

REC5_SQL = f"""
WITH qc AS ({LINEITEM_QC_SQL}),
a AS (SELECT l_orderkey, l_linestatus, count(*) AS n_lines, coalesce(sum(l_extendedprice), 0) AS total_price
      FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2),
b AS (SELECT l_orderkey, l_linestatus, count(*) AS n_lines, coalesce(sum(l_extendedprice), 0) AS total_price
      FROM qc WHERE l_returnflag = 'N' GROUP BY 1, 2),
d AS (SELECT r.l_orderkey, r.l_linestatus,
             {_diff_sql('n_lines', policy='flag')} AS n_lines_diff,
             {_diff_sql('total_price', policy='flag')} AS total_price_diff
      FROM a r JOIN b q ON {_ns_on(['l_orderkey', 'l_linestatus'])})
SELECT *, '' AS resolved FROM d WHERE n_lines_diff IS NOT NULL OR total_price_diff IS NOT NULL
"""


@register("rec5_total_diff", ("REC-5",), REC5_SQL)
def rec5_total_diff(spark, sf):
    """Group totals (row count, sum) compared between entries."""
    li = table(spark, sf, "lineitem")
    return rc.total_diff(li, lineitem_entry_qc(li), ["l_orderkey", "l_linestatus"],
                         {"n_lines": ("count", None), "total_price": ("sum", "l_extendedprice")},
                         where=F.col("l_returnflag") == "N")


# ---------------------------------------------------------------- REC-6 ----

_MS_COLS = ("l_quantity", "l_extendedprice", "l_linenumber")


def _ms_sql(recycle: bool) -> str:
    def lst(side, c):
        return f"coalesce(list_sort(list(CAST({c} AS DOUBLE)) FILTER (WHERE {c} IS NOT NULL)), [])"

    def txt(c):
        return f"array_to_string(list_transform({c}, lambda v: {sql_num_text('v')}), ', ')"

    sel_a = ", ".join(f"{lst('a', c)} AS {c}" for c in _MS_COLS)
    parts = []
    for c in _MS_COLS:
        a, b = f"r.{c}", f"q.{c}"
        if recycle:
            same = (f"(len({a}) = 0 OR len({b}) = 0 OR list_aggregate(list_transform(range(greatest(len({a}), len({b}))), "
                    f"lambda i: {a}[i % greatest(len({a}), 1) + 1] = {b}[i % greatest(len({b}), 1) + 1]), 'bool_and'))")
        else:
            same = f"({a} = {b})"
        parts.append(f"CASE WHEN NOT {same} THEN 'Raw: ' || {txt(a)} || ' ≠ QC: ' || {txt(b)} END AS {c}_diff")
    return f"""
WITH qc AS ({LINEITEM_QC_SQL}),
a AS (SELECT l_orderkey, {sel_a} FROM lineitem GROUP BY l_orderkey),
b AS (SELECT l_orderkey, {sel_a} FROM qc GROUP BY l_orderkey),
d AS (SELECT r.l_orderkey, {", ".join(parts)} FROM a r JOIN b q ON r.l_orderkey IS NOT DISTINCT FROM q.l_orderkey)
SELECT * FROM d WHERE {" OR ".join(f"{c}_diff IS NOT NULL" for c in _MS_COLS)}
"""


@register("rec6_multiset_diff", ("REC-6",), _ms_sql(False))
def rec6_multiset_diff(spark, sf):
    """Per order, sorted multisets of three columns compared (strict)."""
    li = table(spark, sf, "lineitem")
    return rc.multiset_diff(li, lineitem_entry_qc(li), ["l_orderkey"], list(_MS_COLS))


@register("rec6_multiset_recycle", ("REC-6",), _ms_sql(True))
def rec6_multiset_recycle(spark, sf):
    """Same with R-style recycling of the shorter list."""
    li = table(spark, sf, "lineitem")
    return rc.multiset_diff(li, lineitem_entry_qc(li), ["l_orderkey"], list(_MS_COLS),
                            length_policy="recycle")


# big integers beyond 2^53, a text column, and an int against a double column
MSC_SQL = f"""WITH qc AS ({LINEITEM_QC_SQL}),
a AS (SELECT l_orderkey, 'big' AS c, CAST(9007199254740992 + l_linenumber AS VARCHAR) AS v FROM lineitem
  UNION ALL SELECT l_orderkey, 'flag', l_returnflag FROM lineitem UNION ALL SELECT l_orderkey, 'line', CAST(l_linenumber AS VARCHAR) FROM lineitem),
b AS (SELECT l_orderkey, 'big' AS c, CAST(9007199254740992 + l_linenumber + CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS v FROM qc
  UNION ALL SELECT l_orderkey, 'flag', l_returnflag FROM qc UNION ALL SELECT l_orderkey, 'line', CAST(l_linenumber AS VARCHAR) FROM qc),
ca AS (SELECT l_orderkey, c, v, count(*) AS n FROM a WHERE v IS NOT NULL GROUP BY 1, 2, 3), cb AS (SELECT l_orderkey, c, v, count(*) AS n FROM b WHERE v IS NOT NULL GROUP BY 1, 2, 3)
SELECT coalesce(ca.l_orderkey, cb.l_orderkey) AS l_orderkey, coalesce(ca.c, cb.c) AS "column", coalesce(ca.v, cb.v) AS value,
  coalesce(ca.n, 0) AS n_raw, coalesce(cb.n, 0) AS n_qc
FROM ca FULL JOIN cb ON ca.l_orderkey = cb.l_orderkey AND ca.c = cb.c AND ca.v = cb.v WHERE coalesce(ca.n, 0) <> coalesce(cb.n, 0)"""


@register("rec6_multiset_changes", ("REC-6",), MSC_SQL)
def rec6_multiset_changes(spark, sf):
    """Changed value counts as rows: exact big integers, a text column, an integer against a double column."""
    li = table(spark, sf, "lineitem")
    q = lineitem_entry_qc(li)
    big = F.lit(9007199254740992) + F.col("l_linenumber")
    a = li.select("l_orderkey", big.alias("big"), F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("line"))
    b = q.select("l_orderkey", (big + F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(0)).alias("big"), F.col("l_returnflag").alias("flag"),
                 F.col("l_linenumber").cast("double").alias("line"))
    return rc.multiset_changes(a, b, ["l_orderkey"], ["big", "flag", "line"])
