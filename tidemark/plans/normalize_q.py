"""Registered normalisation queries (NRM, SRC-3, SRC-4, QC-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators import normalize as nm
from tidemark.operators import quality as qc
from tidemark.operators.reconcile import duplicate_keys
from tidemark.plans.common import (r6, register, sql_parse_number, sql_sentence,
                                   sql_standardize, table)
from tidemark.sources import io

# ----------------------------------------------------------- NRM-7 / 8 -----

NRM_CODES_SQL = f"""
SELECT p_partkey,
       {sql_standardize("regexp_replace(p_brand, '#', '', 'g')")} AS brand_code,
       {sql_standardize("regexp_replace(p_name, ' ', '', 'g') || CAST(p_size AS VARCHAR)")} AS name_code,
       regexp_replace(regexp_replace(p_type, 'A', 'a'), '^([A-Za-z]{{3}})([A-Za-z]+)$', '\\1_\\2') AS type_code
FROM part
"""


@register("nrm_codes", ("NRM-7", "NRM-8"), NRM_CODES_SQL)
def nrm_codes(spark, sf):
    """Standard site-style codes: ordered rewrites then first-match
    ``LETTERS_0N`` standardisation."""
    p = table(spark, sf, "part")
    name = F.concat(tx.rewrite_code(F.col("p_name"), [(" ", "")]), F.col("p_size").cast("string"))
    return p.select(
        "p_partkey",
        tx.standardize_code(tx.rewrite_code(F.col("p_brand"), [("#", "")])).alias("brand_code"),
        tx.standardize_code(name).alias("name_code"),
        tx.rewrite_code(F.col("p_type"), [("A", "a", "first"),
                                          ("^([A-Za-z]{3})([A-Za-z]+)$", "$1_$2", "first")]).alias("type_code"))


# --------------------------------------------------- NRM-3 / 4 / 6 / 13 ----

NRM_TEXT_SQL = f"""
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', 'NULL') THEN NULL ELSE o_orderpriority END AS priority_clean,
       {sql_parse_number('o_orderpriority')} AS priority_num,
       TRY_CAST(o_orderstatus AS DOUBLE) AS status_num,
       TRY_CAST(CAST(o_custkey AS VARCHAR) AS INTEGER) AS custkey_int,
       {sql_sentence("regexp_extract(trim(regexp_replace(o_orderpriority, '^[0-9]+-', '')), '^(\\S*)', 1)")} AS priority_word
FROM orders
"""


@register("nrm_text", ("NRM-3", "NRM-4", "NRM-6", "NRM-13"), NRM_TEXT_SQL)
def nrm_text(spark, sf):
    """Token NULLs, ANSI-safe casts, first number in text, text clean-up."""
    o = table(spark, sf, "orders")
    d = o.select("o_orderkey", "o_orderpriority", "o_orderstatus",
                 F.col("o_custkey").cast("string").alias("custkey_txt"),
                 F.col("o_orderpriority").alias("priority_clean"),
                 F.col("o_orderpriority").alias("priority_num"),
                 F.col("o_orderstatus").alias("status_num"),
                 F.col("o_orderpriority").alias("priority_word"))
    d = nm.null_tokens(d, ["4-NOT SPECIFIED", "NULL"], ["priority_clean"])
    d = nm.parse_numbers(d, ["priority_num"])
    d = nm.cast_columns(d, {"status_num": "double", "custkey_txt": "int"})
    d = nm.clean_columns(d, ["priority_word"], [("remove", "^[0-9]+-"), "trim", "first_word", "sentence"])
    return d.select("o_orderkey", "priority_clean", "priority_num", "status_num",
                    F.col("custkey_txt").alias("custkey_int"), "priority_word")


# ------------------------------------------------------ NRM-5 / 11 / 12 ----

NRM_PARSE_SQL = """
WITH t AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority,
         CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
              WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y/%-m/%-d')
              ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS date_txt
  FROM orders)
SELECT o_orderkey, date_txt,
       CAST(coalesce(try_strptime(date_txt, '%Y-%m-%d'), try_strptime(date_txt, '%Y/%m/%d'),
                     try_strptime(date_txt, '%m/%d/%Y')) AS DATE) AS parsed_date,
       string_split(o_orderpriority, '-')[1] AS priority_code,
       string_split(o_orderpriority, '-')[2] AS priority_name,
       string_split(o_orderpriority, '-')[3] AS priority_extra,
       CASE WHEN starts_with(o_orderstatus, 'F') THEN 'Final'
            WHEN starts_with(o_orderstatus, 'O') THEN 'Open' ELSE 'Other' END AS status_class,
       CASE WHEN contains(o_orderpriority, 'URGENT') THEN 'Rush'
            WHEN regexp_matches(o_orderpriority, '^[23]') THEN 'Soon'
            WHEN o_orderpriority IN ('5-LOW') THEN 'Low' ELSE 'Normal' END AS priority_class
FROM t
"""


@register("nrm_parse", ("NRM-5", "NRM-11", "NRM-12"), NRM_PARSE_SQL)
def nrm_parse(spark, sf):
    """Dates in mixed layouts, codes split into parts, derived classes."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    txt = (F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
           .when(k % 3 == 0, F.date_format("o_orderdate", "yyyy/M/d"))
           .otherwise(F.date_format("o_orderdate", "M/d/yyyy")))
    d = o.withColumn("date_txt", txt).withColumn("parsed_date", tx.parse_date("date_txt"))
    d = nm.split_code(d, "o_orderpriority", ["priority_code", "priority_name", "priority_extra"], "-")
    d = nm.with_class(d, "status_class", "o_orderstatus",
                      [("startswith", "F", "Final"), ("startswith", "O", "Open")], "Other")
    d = nm.with_class(d, "priority_class", "o_orderpriority",
                      [("contains", "URGENT", "Rush"), ("rlike", "^[23]", "Soon"),
                       ("isin", ["5-LOW"], "Low")], "Normal")
    return d.select("o_orderkey", "date_txt", "parsed_date", "priority_code", "priority_name",
                    "priority_extra", "status_class", "priority_class")


# --------------------------------------------------------- NRM-9 / 10 ------

# An example correction dictionary (exact value -> replacement).
TYPE_CORRECTIONS = {"ECONOMY": "ECON", "PROMO": "PROMOTION", "SMALL": "SM"}
EVENT_CORRECTIONS = {"view": "page_view", "signup": "sign_up"}

NRM_CORRECT_SQL = """
SELECT p_partkey,
       coalesce(CASE p_type WHEN 'ECONOMY' THEN 'ECON' WHEN 'PROMO' THEN 'PROMOTION'
                            WHEN 'SMALL' THEN 'SM' END, p_type) AS p_type,
       CASE WHEN p_size = 50 THEN 5 ELSE p_size END AS p_size,
       CASE WHEN p_type = 'LARGE' AND p_size > 40 THEN 'LARGE_XL' ELSE p_type END AS size_class
FROM part
"""


@register("nrm_correct", ("NRM-9", "NRM-10"), NRM_CORRECT_SQL)
def nrm_correct(spark, sf):
    """Exact-value correction dictionary and conditional point fixes."""
    p = table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    d = p.withColumn("size_class", F.col("p_type"))
    d = nm.patch_values(d, "size_class", (F.col("p_type") == "LARGE") & (F.col("p_size") > 40), "LARGE_XL")
    d = nm.apply_corrections(d, "p_type", TYPE_CORRECTIONS)
    d = nm.patch_values(d, "p_size", F.col("p_size") == 50, 5)
    return d.select("p_partkey", "p_type", "p_size", "size_class")


NRM_CORRECT_JOIN_SQL = """
WITH r(from_value, to_value) AS (VALUES ('view', 'page_view'), ('signup', 'sign_up'))
SELECT e.event_id, coalesce(r.to_value, e.event_type) AS event_type
FROM events e LEFT JOIN r ON e.event_type = r.from_value
"""


@register("nrm_correct_table", ("NRM-9",), NRM_CORRECT_JOIN_SQL)
def nrm_correct_table(spark, sf):
    """Corrections given as a table: size-checked broadcast left join."""
    e = table(spark, sf, "events").select("event_id", "event_type")
    rules = nm.corrections_frame(spark, EVENT_CORRECTIONS)
    return nm.apply_corrections(e, "event_type", rules)


# -------------------------------------------------------- NRM-14 / 15 ------

NRM_UNITS_SQL = """
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
         CASE WHEN l_linenumber = 7 THEN '80-85M'
              WHEN l_linenumber = 6 THEN '05-10M'
              WHEN l_linenumber = 5 THEN CAST(CAST(floor((l_quantity - 1) / 10) * 10 AS INTEGER) AS VARCHAR) || '-'
                   || CAST(CAST(floor((l_quantity - 1) / 10) * 10 + 10 AS INTEGER) AS VARCHAR) || 'M'
              ELSE CAST(CAST(floor((l_quantity - 1) / 5) * 5 AS INTEGER) AS VARCHAR) || '-'
                   || CAST(CAST(floor((l_quantity - 1) / 5) * 5 + 5 AS INTEGER) AS VARCHAR) || 'M' END AS segment,
         CASE l_returnflag WHEN 'A' THEN 'Feet' WHEN 'N' THEN 'Meters' END AS depth_units
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, segment,
       CASE WHEN regexp_full_match(segment, '(0|[1-9][0-9]*)-([1-9][0-9]*)M')
                 AND CAST(regexp_extract(segment, '^(0|[1-9][0-9]*)-', 1) AS INTEGER) =
                     CAST(regexp_extract(segment, '-([1-9][0-9]*)M$', 1) AS INTEGER) - 5
                 AND CAST(regexp_extract(segment, '-([1-9][0-9]*)M$', 1) AS INTEGER) % 5 = 0
                 AND CAST(regexp_extract(segment, '-([1-9][0-9]*)M$', 1) AS INTEGER) <= 80
            THEN CAST(regexp_extract(segment, '-([1-9][0-9]*)M$', 1) AS DOUBLE) END AS segment_m,
       depth_units,
       round(CASE WHEN depth_units IS NULL THEN NULL WHEN depth_units = 'Feet' THEN l_quantity * 0.3048
                  ELSE l_quantity END, 6) AS depth_m
FROM t
"""


@register("nrm_units", ("NRM-14", "NRM-15"), NRM_UNITS_SQL)
def nrm_units(spark, sf):
    """Segment labels to metre bounds and depths to metres."""
    li = table(spark, sf, "lineitem")
    q = F.col("l_quantity")

    def label(step):
        lo = (F.floor((q - 1) / step) * step).cast("int")
        return F.concat(lo.cast("string"), F.lit("-"), (lo + step).cast("string"), F.lit("M"))

    seg = (F.when(F.col("l_linenumber") == 7, F.lit("80-85M"))
           .when(F.col("l_linenumber") == 6, F.lit("05-10M"))
           .when(F.col("l_linenumber") == 5, label(10)).otherwise(label(5)))
    unit = F.when(F.col("l_returnflag") == "A", "Feet").when(F.col("l_returnflag") == "N", "Meters")
    d = li.withColumn("segment", seg).withColumn("depth_units", unit)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "segment",
                    tx.segment_upper(F.col("segment")).alias("segment_m"), "depth_units",
                    r6(tx.to_meters(F.col("l_quantity"), F.col("depth_units"))).alias("depth_m"))


# -------------------------------------------------------- NRM-16 / 17 ------

NRM_FLATTEN_SQL = """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word,
       array_to_string(string_split(p_name, ' '), ',') AS joined
FROM part
"""


@register("nrm_flatten", ("NRM-16",), NRM_FLATTEN_SQL)
def nrm_flatten(spark, sf):
    """List cells to their first element or to joined text."""
    p = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("first_word"),
                                        F.split("p_name", " ").alias("joined"))
    p = nm.flatten_arrays(p, ["first_word"], "first")
    return nm.flatten_arrays(p, ["joined"], "join", ",")


NRM_DEDUPE_SQL = "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem"


@register("nrm_dedupe", ("NRM-17",), NRM_DEDUPE_SQL)
def nrm_dedupe(spark, sf):
    """Exact duplicate rows dropped."""
    return nm.dedupe(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


REC2_SQL = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""


@register("rec2_duplicate_keys", ("REC-2",), REC2_SQL)
def rec2_duplicate_keys(spark, sf):
    """Keys occurring more than once (summary)."""
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


REC2_ROWS_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, d.n
FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
                      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d
  ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber
"""


@register("rec2_duplicate_rows", ("REC-2",), REC2_ROWS_SQL)
def rec2_duplicate_rows(spark, sf):
    """Full rows of duplicated keys."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return duplicate_keys(li, ["l_orderkey", "l_linenumber"], rows=True)


# ------------------------------------------------------- SRC-3 / SRC-4 -----

_TXT_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "o_flag", "o_code", "o_suffixed", "o_when")


def _sql_infer(c):
    x = f"nullif(nullif(nullif(trim({c}), ''), 'NA'), 'NULL')"
    number = "[-+]?(0|[1-9][0-9]*)?([.][0-9]*)?([eE][-+]?[0-9]+)?"
    return f"""SELECT '{c}' AS variable,
  CASE WHEN count({x}) = 0 THEN 'string'
       WHEN count(CASE WHEN upper({x}) IN ('TRUE', 'FALSE') THEN 1 END) = count({x}) THEN 'boolean'
       WHEN count(CASE WHEN regexp_full_match({x}, '-?(0|[1-9][0-9]*)') THEN TRY_CAST({x} AS BIGINT) END) = count({x}) THEN 'bigint'
       WHEN count(CASE WHEN regexp_full_match({x}, '{number}') THEN TRY_CAST({x} AS DOUBLE) END) = count({x}) THEN 'double'
       WHEN count(try_strptime({x}, '%Y-%m-%d')) = count({x}) THEN 'date'
       WHEN count(try_strptime({x}, '%Y-%m-%d %H:%M:%S')) = count({x}) THEN 'timestamp'
       ELSE 'string' END AS inferred_type
FROM t"""


SRC3_SQL = ("""WITH t AS (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN 'NA' ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'false' END AS o_flag,
  lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS o_code, CAST(o_custkey AS VARCHAR) || 'd' AS o_suffixed,
  strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00' AS o_when FROM orders)
""" + "\nUNION ALL\n".join(_sql_infer(c) for c in _TXT_COLS))


@register("src3_infer_types", ("SRC-3",), SRC3_SQL)
def src3_infer_types(spark, sf):
    """Types of an all-text copy of orders, decided by one aggregate (missing tokens, padded codes, suffixes, times)."""
    o = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.col("o_custkey").cast("string")
    t = o.select(*[F.col(c).cast("string").alias(c) for c in _TXT_COLS[:3]],
                 F.when(F.col("o_orderkey") % 7 == 0, "NA").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
                 day.alias("o_orderdate"), "o_orderpriority",
                 F.when(F.col("o_orderkey") % 2 == 0, "TRUE").otherwise("false").alias("o_flag"),
                 F.lpad(key, 9, "0").alias("o_code"), F.concat(key, F.lit("d")).alias("o_suffixed"), F.concat(day, F.lit(" 12:30:00")).alias("o_when"))
    plan = io.infer_type_plan(t)
    return t.sparkSession.createDataFrame(list(plan.items()), "variable string, inferred_type string")


SRC4_SQL = """
SELECT CAST(CASE WHEN o_orderkey % 101 <> 0 THEN year(o_orderdate) END AS INTEGER) AS survey_year, count(*) AS n FROM orders GROUP BY 1
"""


def _orders_by_year(spark, sf):
    """Orders and their yearly 'sheets' (a filter for each year that occurs; undated rows are a sheet of their own)."""
    o = table(spark, sf, "orders").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 101 != 0, F.col("o_orderdate")))
    o = o.withColumn("survey_year", F.year("o_orderdate"))
    years = [r[0] for r in o.select("survey_year").distinct().collect()]
    return o, [o.where(F.col("survey_year").eqNullSafe(F.lit(y).cast("int"))) for y in years]


@register("src4_union_years", ("SRC-4",), SRC4_SQL)
def src4_union_years(spark, sf):
    """Yearly tables stacked by name, counted by year."""
    _, parts = _orders_by_year(spark, sf)
    return io.union_years(parts).groupBy("survey_year").agg(F.count(F.lit(1)).alias("n"))


QC5_SQL = """
SELECT count(*) AS n_before, count(*) AS n_after, true AS ok FROM orders
"""


@register("qc5_row_invariant", ("QC-5",), QC5_SQL)
def qc5_row_invariant(spark, sf):
    """Row count before and after splitting by year and restacking."""
    o, parts = _orders_by_year(spark, sf)
    return qc.row_invariant(o, io.union_years(parts), "equal")



# --------------------------------------- SRC-1/2, SNK-1/2, NRM-1/2 ---------

SRC12_SQL = """SELECT c_custkey AS cust_key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation_key,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS acct_bal, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, c_mktsegment AS mkt_segment
FROM customer WHERE c_custkey <> (SELECT min(c_custkey) FROM customer)"""


@register("src12_csv_roundtrip", ("SRC-1", "SRC-2", "SNK-1", "SNK-2", "NRM-1", "NRM-2", "SRC-3"), SRC12_SQL)
def src12_csv_roundtrip(spark, sf):
    """Sheet-style CSV written with messy headers, read back as text, names
    cleaned, types inferred, the leading example row dropped, saved as a
    table and read again.  Files go to the session's checkpoint folder."""
    import uuid

    from tidemark.session import ensure_checkpoint_dir

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-roundtrip-{uuid.uuid4().hex}"
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Name"),
        F.col("c_nationkey").alias("NationKey"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("Acct  Bal"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("Code"),
        F.col("c_mktsegment").alias("Mkt-Segment"))
    io.write_csv(c, f"{base}/sheet")
    t = io.infer_types(io.read_text_table(spark, f"{base}/sheet"))
    t = nm.drop_leading(t, "cust_key")
    io.write_tables({"customers": t}, f"{base}/tables")
    return io.read_table(spark, f"{base}/tables/customers")


# Several sheets (a folder a year, one file each), in file order, the example row of each dropped, saved as one set.
SRC2_SQL = """SELECT o_orderkey, CAST(yr AS VARCHAR) AS sheet_year, o_orderstatus, place FROM (
  SELECT o_orderkey, year(o_orderdate) AS yr, o_orderstatus,
    CAST(row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey DESC) - 1 AS BIGINT) AS place FROM orders WHERE o_orderdate IS NOT NULL)
WHERE place >= 1"""


@register("src2_sheets_in_order", ("SRC-2", "NRM-2", "SRC-4", "SNK-2"), SRC2_SQL)
def src2_sheets_in_order(spark, sf):
    """Yearly CSV sheets read in file order over several files and splits, published and read as one set."""
    import uuid

    from tidemark.session import _scratch_folder

    base = f"{_scratch_folder(spark)}/sheets-{uuid.uuid4().hex}"
    o = table(spark, sf, "orders").where("o_orderdate is not null").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("yr"))
    o.repartition("yr").sortWithinPartitions("yr", F.desc("o_orderkey")).write.partitionBy("yr").option("header", True).csv(f"{base}/csv")
    t = io.read_sheets(spark, f"{base}/csv", row="place").where("place >= 1")
    t = t.select(F.col("o_orderkey").cast("bigint"), F.regexp_extract("sheet", "yr=([0-9]+)", 1).alias("sheet_year"), "o_orderstatus", "place")
    io.publish_tables({"orders": t, "years": t.groupBy("sheet_year").count()}, f"{base}/tables")
    return io.published_tables(spark, f"{base}/tables")["orders"]
