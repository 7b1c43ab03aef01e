"""Metric fixtures (FIXTURES.md §3, rows 16-28)."""

import math

from pyspark.sql import functions as F

from tidemark.operators import metrics as mt
from tidemark.operators import sites as st
from tidemark.operators.ranking import row_number_by


def test_extrapolate(spark):
    df = spark.createDataFrame([(3.0, 2.0), (None, 2.0), (3.0, None), (3.0, 0.0)], "c double, s double")
    got = [r["d"] for r in mt.extrapolate(df, {"d": ("c", "s")}, full=4).collect()]
    assert got == [6.0, 0.0, 3.0, None]


def test_swath_density(spark):
    df = spark.createDataFrame([(6.0, m) for m in (3.0, 15.0, 25.0, None, 10.0, 20.0, 30.0)], "c double, m double")
    got = [r["density_20m2"] for r in mt.swath_density(df, "c", "m").collect()]
    assert got == [20.0, 12.0, 12.0, 6.0, 6.0, 6.0, 6.0]


def test_percent_cover(spark):
    df = spark.createDataFrame([(1, "A", "A", "B", None)], "u int, p1 string, p2 string, p3 string, p4 string")
    r = mt.percent_cover(df, ["u"], ["p1", "p2", "p3", "p4"], values=["A", "B"]).first()
    assert abs(r["cov_a"] - 200 / 3) < 1e-9 and abs(r["cov_b"] - 100 / 3) < 1e-9
    r8 = mt.percent_cover(df, ["u"], ["p1", "p2", "p3", "p4"], denominator=8, values=["A", "B"]).first()
    assert (r8["cov_a"], r8["cov_b"]) == (25.0, 12.5)


def test_cover_sums_to_scale(spark):
    df = spark.createDataFrame([(1, "A", "B", "C"), (2, "A", None, "A")], "u int, p1 string, p2 string, p3 string")
    w = mt.percent_cover(df, ["u"], ["p1", "p2", "p3"], values=["A", "B", "C"])
    for r in w.collect():
        assert abs(r["cov_a"] + r["cov_b"] + r["cov_c"] - 100) < 1e-9


def test_rowwise_share(spark):
    df = spark.createDataFrame([("Sand", "Sand", None, "Boulder", "Sand")], "a string, b string, c string, d string, e string")
    cols = ["a", "b", "c", "d", "e"]
    assert mt.rowwise_share(df, cols, {"s": "Sand"}, na_rm=False).first()["s"] is None
    assert mt.rowwise_share(df, cols, {"s": "Sand"}, na_rm=True).first()["s"] == 0.75


def test_uncount(spark):
    df = spark.createDataFrame([(2,), (0,), (1,)], "n int")
    assert mt.uncount(df, "n", drop=False).count() == 3


def test_size_stats(spark):
    df = spark.createDataFrame([(1, "p", 2.0, 3.0), (1, "p", 5.0, 1.0), (1, "p", None, 4.0), (2, "p", 4.0, 1.0)],
                               "g int, sp string, size double, n double")
    long = {r["g"]: r for r in mt.size_stats(df, ["g"], "sp", "size", "n", wide=False).collect()}
    assert long[1]["n"] == 4 and long[1]["mean"] == 2.75 and abs(long[1]["sd"] - 1.5) < 1e-12
    assert long[2]["mean"] == 4.0 and long[2]["sd"] is None
    wide = mt.size_stats(df, ["g"], "sp", "size", "n", values=["p"]).where("g = 1").first()
    assert wide["sz_mean_p"] == 2.75


def test_size_stats_matches_expansion(spark):
    df = spark.createDataFrame([(1, "p", float(s), float(c)) for s, c in [(2, 3), (5, 1), (7, 2), (3, 4)]],
                               "g int, sp string, size double, n double")
    r = mt.size_stats(df, ["g"], "sp", "size", "n", wide=False).first()
    e = mt.uncount(df, "n", drop=False).agg(F.avg("size"), F.stddev_samp("size")).first()
    assert abs(r["mean"] - e[0]) < 1e-12 and abs(r["sd"] - e[1]) < 1e-12


def test_true_zero_grid(spark):
    units = spark.createDataFrame([("S1",)], "site string")
    metrics = spark.createDataFrame([("S1", 2, 5.0)], "site string, transect int, n double")
    g = mt.true_zero_grid(units, 4, metrics, ["site"], ["n"]).orderBy("transect").collect()
    assert [r["n"] for r in g] == [0.0, 5.0, 0.0, 0.0]


def test_clamp(spark):
    df = spark.createDataFrame([(5.0, 3.0), (2.0, 3.0), (5.0, None), (None, 3.0)], "p double, w double")
    assert [r["p"] for r in mt.clamp(df, "p", "w").collect()] == [3.0, 2.0, 5.0, None]


def test_gonad_index(spark):
    df = spark.createDataFrame([(1.0, 10.0), (5.0, 10.0), (None, 10.0)], "g double, m double")
    got = [r["gonad_index"] for r in mt.gonad_index(df, "g", "m").collect()]
    assert len(got) == 1 and abs(got[0] - 10.00001) < 1e-9


def test_latest_per_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", None)], "k string, d int")
    assert st.latest_per_group(df, ["k"], "d").count() == 2


def test_renumber(spark):
    df = spark.createDataFrame([("g", 1, "M", 77.0), ("g", 2, "R", 9.0), ("g", 3, "R", 9.0)],
                               "k string, o int, t string, s double")
    got = sorted((r["o"], r["s"]) for r in mt.renumber(df, ["k"], ["o"], F.col("t") == "M", "s").collect())
    assert got == [(1, 77.0), (2, 2.0), (3, 3.0)]


def test_row_number_by_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 5000).alias("o"))
    hot = df.withColumn("k", F.when(F.col("o") < 3000, F.lit(0)).otherwise(F.col("k")))  # one hot group
    got = row_number_by(hot, ["k"], ["o"], "rn", num_ranges=16)
    exp = hot.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_relief_risk(spark):
    df = spark.createDataFrame([(3.0, 2.0)], "relief double, risk double")
    r = mt.relief_risk(df).first()
    assert r["relief_cm"] == 30 and math.isclose(r["risk_cm"], 151.4) and math.isclose(r["risk_index"], 10.0)


def test_unlisted_and_null_classes_are_not_dropped(spark):
    import pytest
    from tidemark.operators import metrics as mt

    df = spark.createDataFrame([(1, "X", 2.0), (1, "Z", 3.0), (1, None, 5.0), (2, "null", 7.0)], "u int, sp string, v double")
    wide = {r["u"]: r.asDict() for r in mt.pivot_density(df, ["u"], "sp", "v").collect()}
    assert wide[1] == {"u": 1, "density_x": 2.0, "density_z": 3.0, "density_null": 0.0, "density_na": 5.0}
    assert wide[2]["density_null"] == 7.0
    with pytest.raises(Exception, match="class is not listed"):
        mt.pivot_density(df, ["u"], "sp", "v", values=["X", "null", None]).collect()
    assert mt.pivot_density(df, ["u"], "sp", "v", values=["X"], unlisted="drop").count() == 2
    two = spark.createDataFrame([(1, "a b", 1.0), (1, "a_b", 2.0)], "u int, sp string, v double")
    with pytest.raises(ValueError, match="same column name"):
        mt.pivot_density(two, ["u"], "sp", "v")
    grid = spark.createDataFrame([(1,)], "u int")
    lines = spark.createDataFrame([(1, 5, 2.0)], "u int, transect int, v double")
    assert mt.true_zero_grid(grid, None, lines, ["u"], ["v"]).count() == 5
    with pytest.raises(ValueError, match="grid is 1..4"):
        mt.true_zero_grid(grid, 4, lines, ["u"], ["v"])


def test_join_by_year_reads_its_input_once(spark):
    from tidemark.operators import metrics as mt

    df = spark.createDataFrame(
        [(1, 2023, "a", "x"), (2, 2024, "a", "x"), (3, 2024, "a", None), (4, 2025, "a", "zz"), (5, 2025, None, "x"), (6, 2026, "a", "x"), (7, None, "a", "x"), (8, 2024, "b", "x")],
        "id int, yr int, site string, zone string")
    sites = spark.createDataFrame(
        [(2024, "a", "x", 10), (2024, "a", None, 11), (2024, "a", "x", 9), (2025, "a", "y", 12), (2025, None, "q", 13), (2026, "a", "x", 14), (2023, "a", "x", 15)],
        "yr long, site string, zone string, rec int")
    rules = {2023: ["site", "zone"], 2024: ["site", "zone"], 2025: ["site"]}
    out = mt.join_by_year(df, sites, "yr", rules, ["rec"])
    assert {r.id: r.rec for r in out.collect()} == {1: 15, 2: 9, 3: 11, 4: 12, 5: 13, 6: None, 7: None, 8: None}
    assert out.columns == ["id", "yr", "site", "zone", "rec"]
    assert {r.rec for r in mt.join_by_year(df, sites, "yr", {}, ["rec"]).collect()} == {None}
    plan = mt.join_by_year(spark.range(10).selectExpr("id", "id yr", "'a' site", "'b' zone"), sites, "yr", {y: ["site"] for y in range(2000, 2012)}, ["rec"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 10") == 1


def test_resolve_by_year_agrees_with_one_year_at_a_time(spark):
    from pyspark.sql import functions as F

    from tidemark.operators import sites as st

    d = spark.createDataFrame([(i, f"2024-0{1 + i % 3}-01" if i % 2 else f"2025-0{1 + i % 3}-01", "s%d" % (i % 4) if i % 5 else None, i % 3) for i in range(40)], "id int, day string, site string, zone int").withColumn("day", F.col("day").cast("date"))
    s = spark.createDataFrame([(y, f"s{k}" if k else None, float(z), f"o{y}{k}{z}") for y in (2024, 2025) for k in range(4) for z in range(2)] * 2, "year int, name string, z double, official string")
    rules = {2024: {"site": "name", "zone": "z"}, 2025: {"site": "name"}}
    for how in ("drop", "keep"):
        parts = [st.resolve_official_site(d, s, on, {"site": "official"}, year=y, date_col="day", unmatched=how, site_year=F.col("year")) for y, on in rules.items()]
        got = st.resolve_by_year(d, s, "day", rules, {"site": "official"}, "year", how)
        assert got.columns == parts[0].columns
        assert sorted(map(str, got.collect())) == sorted(map(str, parts[0].unionByName(parts[1]).collect()))
