"""One key holding a third of all rows: results must not change and no
operator may need the hot group in one task (checked here for correctness;
the balanced plans are in operators/ranking.py and PLANS.md)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import metrics as mt
from tidemark.operators import quality as qc
from tidemark.operators import reconcile as rc
from tidemark.operators import sites as st


def _hot(spark, n=9000):
    # key 0 holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("k"),
        F.col("id"), ((F.col("id") * 7919) % 101).cast("double").alias("v"),
        (F.col("id") % 17).cast("int").alias("d"))


def test_hot_key_multiset_and_cell_diff(spark):
    raw = _hot(spark)
    qc_ = raw.withColumn("v", F.when(F.col("id") == 3, F.col("v") + 1).otherwise(F.col("v")))
    ms = rc.multiset_diff(raw, qc_, ["k"], ["v"], render="counts").collect()
    assert [r["k"] for r in ms] == [0]
    cd = rc.cell_diff(raw, qc_, ["k", "id"], ["v"]).collect()
    assert len(cd) == 1 and cd[0]["id"] == 3


def test_hot_key_quantiles_and_latest(spark):
    df = _hot(spark)
    q = {r["k"]: r for r in qc.exact_quantiles(df, ["k"], "v", {"med": 0.5}).collect()}
    exp = {r["k"]: r["med"] for r in df.groupBy("k").agg(F.percentile("v", 0.5).alias("med")).collect()}
    assert all(abs(q[k]["med"] - exp[k]) < 1e-12 for k in exp)
    latest = st.latest_per_group(df, ["k"], "d")
    w = Window.partitionBy("k")
    exp_latest = df.withColumn("m", F.max("d").over(w)).where(F.col("d") == F.col("m")).count()
    assert latest.count() == exp_latest


def test_hot_key_size_stats(spark):
    df = _hot(spark).withColumn("sp", F.lit("p")).withColumn("n", (F.col("id") % 3 + 1).cast("double"))
    got = {r["k"]: r for r in mt.size_stats(df, ["k"], "sp", "v", "n", wide=False).collect()}
    e = mt.uncount(df, "n", drop=False).groupBy("k").agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s"))
    for r in e.collect():
        assert abs(got[r["k"]]["mean"] - r["m"]) < 1e-9 and abs(got[r["k"]]["sd"] - r["s"]) < 1e-9


def test_quantiles_of_mostly_equal_values(spark):
    """80% of a group on one value: it is one counted row, whatever the group's size."""
    from tidemark.operators import quality as qc

    df = spark.range(20_000).selectExpr("id % 2 as g", "case when id % 10 < 8 then 0D else id * 1D end as v")
    ranks = qc.value_ranks(df, ["g"], "v")
    assert ranks.agg({"w": "max"}).first()[0] >= 8_000 and ranks.count() <= 4_002
    sizes = [r["count"] for r in ranks.groupBy("g", "x").count().collect()]
    assert max(sizes) == 1
    got = {r["g"]: (r["n"], r["q1"], r["median"], r["q3"]) for r in qc.box_stats(df, ["g"], "v").collect()}
    assert got == {0: (10_000, 0.0, 0.0, 0.0), 1: (10_000, 0.0, 0.0, 0.0)}


def test_hot_key_multisets_without_lists(spark):
    raw = _hot(spark)
    more = raw.unionByName(raw.where("k = 0 and id < 3"))  # the hot group has one value more
    for policy, hot in (("strict", [0]), ("recycle", [0])):
        got = rc.multiset_diff(raw, more, ["k"], ["v", "d"], length_policy=policy, render=None).collect()
        assert [(r["k"], r["v_diff"], r["d_diff"]) for r in got] == [(k, True, True) for k in hot]
    # one value in the whole hot group: the lengths differ, every repeated value is the same
    one = raw.withColumn("v", F.lit(5.0))
    assert rc.multiset_diff(one, one.unionByName(one.where("k = 0 and id < 3")), ["k"], ["v"], length_policy="recycle", render=None).collect() == []
    plan = rc.multiset_diff(raw, more, ["k"], ["v"], length_policy="recycle", render=None)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan and plan.count("Exchange hashpartitioning") == 1


def _type7(values, p):
    import math

    v = sorted(values, key=lambda x: (x != x, x))
    h = (len(v) - 1) * p
    lo, hi = v[math.floor(h)], v[math.ceil(h)]
    return lo if lo == hi or (lo != lo and hi != hi) else lo + (hi - lo) * (h - math.floor(h))


def test_rank_selection_against_sorting(spark):
    import random

    rnd = random.Random(13)
    inf, nan = float("inf"), float("nan")
    groups = {
        "same": [4.0] * 50, "one": [1.5], "ints": [float(rnd.randrange(9)) for _ in range(400)], "normal": [rnd.gauss(0, 1) for _ in range(501)],
        "scales": [rnd.choice([-1, 1]) * 10.0 ** rnd.randrange(-300, 300) for _ in range(300)], "tiny": [5e-324 * i for i in range(7)],
        "huge": [1.7e308, -1.7e308, 3.0, 3.0, 1e-9], "odd": [inf, -inf, -inf, nan, 1.0, 2.0, 2.0, nan, inf, inf], "only": [inf, inf, nan], "zero": [0.0, -0.0, 0.0],
        None: [1.0, 2.0, 4.0, None],
    }
    df = spark.createDataFrame([(k, x) for k, v in groups.items() for x in v] + [("none", None)], "g string, v double").repartition(5)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    for bins in (qc.SELECT_BINS, 16):
        got = {r["g"]: r for r in qc.exact_quantiles(df, ["g"], "v", probs).collect()} if bins == qc.SELECT_BINS else None
        ranks = {"lo": F.lit(1), "mid": F.floor((F.col("n") + 1) / 2), "hi": F.col("n")}
        picked = {r["g"]: r for r in qc.select_ranks(df.where("g in ('ints', 'odd', 'normal') or g is null"), ["g"], "v", ranks, bins).collect()}
        for k in ("ints", "odd", "normal", None):
            v = sorted((x for x in groups[k] if x is not None), key=lambda x: (x != x, x))
            assert [str(picked[k][c]) for c in ("lo", "mid", "hi")] == [str(v[0]), str(v[(len(v) + 1) // 2 - 1]), str(v[-1])], (bins, k)
        if got:
            assert got.keys() == groups.keys()
            for k, v in groups.items():
                v = [x for x in v if x is not None]
                for name, p in probs.items():
                    want = _type7(v, p)
                    assert str(got[k][name] + 0.0) == str(want + 0.0) or abs(got[k][name] - want) <= 1e-12 * abs(want), (k, name)
    whole = qc.exact_quantiles(df.where("g = 'ints'"), [], "v", {"m": 0.5}).collect()
    assert [r["m"] for r in whole] == [_type7(groups["ints"], 0.5)]
    assert qc.box_stats(df.where("false"), ["g"], "v").collect() == []


def test_quartiles_need_no_sort_of_the_values(spark):
    import re

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = qc.box_stats(_hot(spark), ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange (?:hash|range)partitioning", plan)) <= 4 and "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan


def test_rows_without_a_rule_are_dealt_over_all_tasks(spark):
    """Nine tenths of the rows are of years without a rule: no task of the join gets them all."""
    df = spark.range(8000).selectExpr("id", "cast(if(id % 10 = 0, 2024, 1990 + id % 3) as int) as yr", "id % 7 as site", "make_date(cast(if(id % 10 = 0, 2024, 1990) as int), 1, 1) as day")
    sites = spark.range(7).selectExpr("2024 as yr", "id as site", "id * 10 as rec")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for out in (mt.join_by_year(df, sites, "yr", {2024: ["site"]}, ["rec"]), mt.join_by_year(df, sites, "yr", {}, ["rec"]),
                    st.resolve_by_year(df, sites, "day", {2024: {"site": "site"}}, {"rec": "rec"}, "yr", "keep")):
            rows = out.withColumn("p", F.spark_partition_id()).collect()
            sizes = {}
            for r in rows:
                sizes[r["p"]] = sizes.get(r["p"], 0) + 1
            assert len(rows) == 8000 and max(sizes.values()) < 3000
            if any(r["rec"] is not None for r in rows):
                assert all(r["rec"] == (r["site"] * 10 if r["id"] % 10 == 0 else None) for r in rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
