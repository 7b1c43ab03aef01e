"""Tail of the F distribution against closed forms and tabulated values."""

import math

from pyspark.sql import functions as F

from tidemark.functions import stats


def test_log_gamma(spark):
    xs = [1e-6, 0.1, 0.5, 1.0, 1.5, 2.0, 3.3, 10.0, 171.5, 1e5]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", stats.log_gamma("x").alias("g")).collect()
    assert all(abs(r.g - math.lgamma(r.x)) <= 1e-12 * max(1, abs(math.lgamma(r.x))) for r in got)


def test_f_tail(spark):
    rows = []
    for f in (1e-9, 0.01, 0.5, 1.0, 2.5, 7.0, 60.0, 5000.0):
        for d in (1, 2, 3, 10, 77, 1000):
            rows += [(f, 2, d, (1 + 2 * f / d) ** (-d / 2)), (f, d, 2, 1 - (d * f / (d * f + 2)) ** (d / 2))]
        rows.append((f, 1, 1, 1 - 2 / math.pi * math.atan(math.sqrt(f))))
    # critical values as published to four places or more
    rows += [(4.964603, 1, 10, 0.05), (3.325835, 5, 10, 0.05), (5.636326, 5, 10, 0.01), (1.0, 40, 40, 0.5), (1.0, 5000, 5000, 0.5)]
    df = spark.createDataFrame(rows, "f double, a int, b int, want double")
    plan = df.select(stats.f_tail("f", "a", "b"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    for r in df.withColumn("p", stats.f_tail("f", "a", "b")).collect():
        loose = 1e-9 if (r.f, r.a, r.b) in {(x[0], x[1], x[2]) for x in rows[:-5]} or r.want == 0.5 else 2e-6
        assert abs(r.p - r.want) < loose, r
    odd = spark.createDataFrame([(None, 1, 2), (1.0, 0, 5), (0.0, 3, 4), (float("inf"), 3, 4)], "f double, a int, b int")
    assert [r.p for r in odd.select(stats.f_tail("f", "a", "b").alias("p")).collect()] == [None, None, 1.0, 0.0]
