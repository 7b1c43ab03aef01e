"""Query registry shared by the plan modules.

Each registered query is a Spark callable ``(spark, sf_dir) -> DataFrame``
over the driver tables plus, where SQL can express it, the equivalent SQL
text for the DuckDB oracle (tables are pre-registered as views there).
Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: tuple[str, ...]
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, operators: tuple[str, ...] | str, sql: str | None = None, note: str = ""):
    ops = (operators,) if isinstance(operators, str) else tuple(operators)

    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql_r6_rewrite(sql) if sql else None, ops, note)
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------ SQL helpers --

def sql_num_text(x: str) -> str:
    """SQL twin of :func:`tidemark.functions.text.num_text`."""
    return (f"CASE WHEN ({x}) IS NULL THEN NULL "
            f"WHEN CAST({x} AS DOUBLE) = floor(CAST({x} AS DOUBLE)) AND abs(CAST({x} AS DOUBLE)) < 1e15 "
            f"THEN CAST(CAST(CAST({x} AS DOUBLE) AS BIGINT) AS VARCHAR) "
            f"ELSE regexp_replace(CAST(CAST({x} AS DOUBLE) AS VARCHAR), '\\.0$', '') END")


def rn(c, digits: int) -> Column:
    """Round to ``digits`` decimals the same way in Spark and DuckDB."""
    c = c if isinstance(c, Column) else F.col(c)
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def r6(c) -> Column:
    """Round a double to 6 decimals for cross-engine comparison.

    ``round(x * 1e6) / 1e6`` rounds the same binary value the same way in
    Spark and DuckDB (``round(x, 6)`` does not: Spark rounds the decimal text,
    DuckDB the binary value, so ties can differ).  ``+ 0.0`` clears -0."""
    c = c if isinstance(c, Column) else F.col(c)
    return F.round(c * F.lit(1e6)) / F.lit(1e6) + F.lit(0.0)


def sql_r6_rewrite(sql: str) -> str:
    """Rewrite every ``round(<expr>, 6)`` in oracle SQL into the same
    ``round(<expr> * 1e6) / 1e6 + 0.0`` form used by :func:`r6`."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        # find the matching close paren and the last top-level comma
        depth, k, comma = 0, j + len(key), None
        while k < len(sql):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            elif ch == "'":
                k = sql.index("'", k + 1)
            k += 1
        inner = sql[j + len(key):k]
        digits = sql[comma + 1:k].strip() if comma is not None else ""
        if digits.isdigit():
            expr = sql_r6_rewrite(sql[j + len(key):comma])
            out.append(sql[i:j] + f"(round(({expr}) * 1e{digits}) / 1e{digits} + 0.0)")
        else:
            out.append(sql[i:j] + key + sql_r6_rewrite(inner) + ")")
        i = k + 1


# ---------------------------------------------- edited "second entry" ------
# A second entry of a table is the same table with deterministic edits
# (changed values, blanks, mis-keyed rows); the same edits are written in
# Spark and in SQL so both engines see identical inputs.  Nothing is filtered.

def lineitem_entry_qc(li: DataFrame) -> DataFrame:
    k = F.col("l_orderkey")
    return li.withColumns({
        "l_quantity": F.col("l_quantity") + F.when(k % 17 == 0, F.lit(1.0)).otherwise(F.lit(0.0)),
        "l_returnflag": F.when(k % 19 == 0, F.lower("l_returnflag")).otherwise(F.col("l_returnflag")),
        "l_extendedprice": F.when(k % 29 == 0, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")),
        "l_linenumber": F.col("l_linenumber") + F.when(k % 23 == 0, F.lit(100)).otherwise(F.lit(0)),
    })


LINEITEM_QC_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey,
       l_linenumber + CASE WHEN l_orderkey % 23 = 0 THEN 100 ELSE 0 END AS l_linenumber,
       l_quantity + CASE WHEN l_orderkey % 17 = 0 THEN 1.0 ELSE 0.0 END AS l_quantity,
       CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
       l_discount, l_tax,
       CASE WHEN l_orderkey % 19 = 0 THEN lower(l_returnflag) ELSE l_returnflag END AS l_returnflag,
       l_linestatus, l_shipdate
FROM lineitem
"""

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def orders_entry_qc(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return o.withColumns({
        "o_totalprice": F.col("o_totalprice") + F.when(k % 11 == 0, F.lit(10.0)).otherwise(F.lit(0.0)),
        "o_orderpriority": F.when(k % 13 == 0, F.lit("5-LOW")).otherwise(F.col("o_orderpriority")),
        "o_custkey": F.when(k % 31 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")),
        "o_orderkey": k + F.when(k % 37 == 0, F.lit(1_000_000_000)).otherwise(F.lit(0)),
    })


ORDERS_QC_SQL = """
SELECT o_orderkey + CASE WHEN o_orderkey % 37 = 0 THEN 1000000000 ELSE 0 END AS o_orderkey,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       o_orderstatus,
       o_totalprice + CASE WHEN o_orderkey % 11 = 0 THEN 10.0 ELSE 0.0 END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderkey % 13 = 0 THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""


def sql_standardize(x: str, width: int = 2) -> str:
    """SQL twin of :func:`tidemark.functions.text.standardize_code`."""
    pat = "'([A-Za-z]+)([0-9]+)'"
    m = f"regexp_extract({x}, {pat}, 0)"
    g1 = f"regexp_extract({x}, {pat}, 1)"
    g2 = f"regexp_extract({x}, {pat}, 2)"
    pos = f"instr({x}, {m})"
    return (f"CASE WHEN {m} = '' THEN {x} ELSE "
            f"substr({x}, 1, {pos} - 1) || upper({g1}) || '_' || "
            f"CASE WHEN length({g2}) < {width} THEN lpad({g2}, {width}, '0') ELSE {g2} END || "
            f"substr({x}, {pos} + length({m})) END")


def sql_parse_number(x: str) -> str:
    hit = f"regexp_extract(replace(CAST({x} AS VARCHAR), ',', ''), '-?[0-9]*\\.?[0-9]+', 0)"
    return f"CASE WHEN {hit} = '' THEN NULL ELSE TRY_CAST({hit} AS DOUBLE) END"


def sql_sentence(x: str) -> str:
    return f"upper(substr({x}, 1, 1)) || lower(substr({x}, 2))"
