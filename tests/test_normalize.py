"""Column-level normalisation fixtures (FIXTURES.md §3, rows 1-6, 26)."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators import normalize as nm


def _col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_standardize_code(spark):
    got = _col(spark, ["mar6", "REC12_FOR", "a1b22", "MAR123", "abc", None, "MAR-6b7"], tx.standardize_code)
    assert got == ["MAR_06", "REC_12_FOR", "A_01b22", "MAR_123", "abc", None, "MAR-6B_07"]


def test_parse_date(spark):
    got = _col(spark, ["2024-08-20", "2024/8/2", "8/20/2024", "bad"], tx.parse_date)
    assert got == [dt.date(2024, 8, 20), dt.date(2024, 8, 2), dt.date(2024, 8, 20), None]


def test_parse_number(spark):
    assert _col(spark, ["12 m", "1,200", "-3.5ft", "n/a"], tx.parse_number) == [12.0, 1200.0, -3.5, None]


def test_segment_upper(spark):
    assert _col(spark, ["0-5M", "75-80M", "80-85M", "5-15M", None, "05-10M"], tx.segment_upper) == \
        [5.0, 80.0, None, None, None, None]


def test_to_meters(spark):
    df = spark.createDataFrame([(10.0, "Feet"), (10.0, "Meters"), (10.0, None)], "v double, u string")
    got = [r[0] for r in df.select(tx.to_meters(F.col("v"), F.col("u"))).collect()]
    assert abs(got[0] - 3.048) < 1e-12 and got[1:] == [10.0, None]


def test_split_code(spark):
    df = spark.createDataFrame([("REC01_BAR",), ("MAR06",), ("A_B_C",)], "c string")
    got = [tuple(r) for r in nm.split_code(df, "c", ["a", "b"]).select("a", "b").collect()]
    assert got == [("REC01", "BAR"), ("MAR06", None), ("A", "B")]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("D",), ("1",), (None,)], "t string")
    assert sorted(nm.keep_not_in(df, "t", ["D"]).collect(), key=str) == sorted([("1",), (None,)], key=str)


def test_num_text(spark):
    assert _col(spark, [7.0, 2.5, None, 100.0], tx.num_text, "double") == ["7", "2.5", None, "100"]


def test_replace_first_and_rewrite(spark):
    got = _col(spark, ["REC1 REC2"], lambda c: tx.rewrite_code(c, [(r"REC(\d+)", "REC_$1", "first")]))
    assert got == ["REC_1 REC2"]


def test_clean_names():
    assert nm.clean_names_list(["Site Name", "", "subsample meter", "subsample meter", "DepthUnits"]) == \
        ["site_name", "x2", "subsample_meter_3", "subsample_meter_4", "depth_units"]


def test_clean_text(spark):
    got = _col(spark, ["12R", "Macrocystis (giant) kelp", "  007"], lambda c: tx.clean_text(c, ["strip_side"]))
    assert got[0] == "12"
    assert _col(spark, ["Macrocystis (giant) kelp"], lambda c: tx.clean_text(c, ["strip_parens"])) == ["Macrocystis kelp"]
    assert _col(spark, ["007"], lambda c: tx.clean_text(c, ["strip_leading_zeros"])) == ["7"]
    assert _col(spark, ["cov_crustose_coralline"], lambda c: tx.clean_text(c, ["label"])) == ["Crustose coralline"]


def test_corrections_map_and_table(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    m = nm.apply_corrections(df, "c", {"a": "A"})
    assert [r[0] for r in m.collect()] == ["A", "b", None]
    t = nm.apply_corrections(df, "c", nm.corrections_frame(spark, {"b": "B"}))
    assert sorted([r[0] for r in t.collect()], key=str) == sorted(["a", "B", None], key=str)


def test_drop_leading(spark):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(5)], "row_order int, v string")
    assert sorted(r.row_order for r in nm.drop_leading(df, "row_order").collect()) == [1, 2, 3, 4]


def test_drop_leading_ties_and_nulls(spark):
    from tidemark.operators import normalize as nm

    df = spark.createDataFrame([(None, "example"), (1, "a"), (1, "b"), (1, "b"), (2, "c")], "o int, v string")
    left = sorted((str(r.o), r.v) for r in nm.drop_leading(df, "o").collect())
    assert left == [("1", "a"), ("1", "b"), ("1", "b"), ("2", "c")]
    left = sorted((str(r.o), r.v) for r in nm.drop_leading(df, "o", n=3).collect())
    assert left == [("1", "b"), ("2", "c")]


def test_inferred_types_of_codes_and_missing_tokens(spark):
    from tidemark.sources import io

    df = spark.createDataFrame([("007", "1d", "1.5", "NA", "2024-01-02 03:04:05"), ("010", "2f", "NA", "NULL", "2024-01-02 03:04:06")], "a string, b string, c string, d string, e string")
    assert io.infer_type_plan(df) == {"a": "string", "b": "string", "c": "double", "d": "string", "e": "timestamp"}
    assert io.infer_types(df).first()["a"] == "007" and io.infer_types(df).first()["d"] is None
