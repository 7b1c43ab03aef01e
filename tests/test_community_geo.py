"""Quality, community and geometry fixtures (FIXTURES.md §3, rows 29-35)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.geo import destination_point
from tidemark.operators import community as cm
from tidemark.operators import geometry as geo
from tidemark.operators import quality as qc


def test_zero_summary(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (None,)], "x double")
    assert qc.zero_summary(df).first()["num_zeros"] == 2
    assert qc.zero_summary(df, na_rm=False).first()["num_zeros"] is None


def test_box_stats_quantiles(spark):
    df = spark.createDataFrame([("a", float(x)) for x in [1, 2, 3, 4, 100]], "g string, v double")
    r = qc.box_stats(df, ["g"], "v").first()
    assert (r["q1"], r["median"], r["q3"]) == (2.0, 3.0, 4.0)
    assert r["whisker_hi"] == 4.0 and r["n_outliers"] == 1


def test_distances(spark):
    df = spark.createDataFrame([("g", 1.0, 0.0), ("g", 0.0, 1.0)], "grp string, a double, b double")
    e = [r["distance"] for r in cm.distance_to_centroid(df, "grp", ["a", "b"]).collect()]
    assert all(math.isclose(x, math.sqrt(0.5)) for x in e)
    from tidemark.functions.vector import bray_curtis, euclidean
    v = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0])], "x array<double>, y array<double>")
    r = v.select(euclidean("x", "y").alias("e"), bray_curtis("x", "y").alias("b")).first()
    assert math.isclose(r["e"], math.sqrt(2)) and r["b"] == 1.0


def test_permanova_statistics(spark):
    df = spark.createDataFrame([(1, "A", 0.0), (2, "A", 2.0), (3, "B", 10.0), (4, "B", 12.0)], "id int, g string, x double")
    r = cm.permanova(df, "g", ["x"], permutations=0).first()
    assert math.isclose(r["ss_total"], 104) and math.isclose(r["ss_within"], 4)
    assert math.isclose(r["f"], 50) and math.isclose(r["r2"], 100 / 104)


def test_permanova_matches_pair_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 3)) + np.repeat(np.arange(3), 10)[:, None]
    g = np.repeat(["a", "b", "c"], 10)
    df = spark.createDataFrame([(i, str(g[i]), *map(float, x[i])) for i in range(30)], "id int, g string, x0 double, x1 double, x2 double")
    r = cm.permanova(df, "g", ["x0", "x1", "x2"], permutations=0).first()
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    sst = d2[np.triu_indices(30, 1)].sum() / 30
    ssw = sum(d2[np.ix_(g == k, g == k)][np.triu_indices(10, 1)].sum() / 10 for k in "abc")
    assert math.isclose(r["ss_total"], sst, rel_tol=1e-9) and math.isclose(r["ss_within"], ssw, rel_tol=1e-9)


def test_permutation_p_bounds(spark):
    df = spark.createDataFrame([(i, "A" if i < 6 else "B", float(i) + (10 if i >= 6 else 0)) for i in range(12)],
                               "id int, g string, x double")
    r = cm.permanova(df, "g", ["x"], permutations=99, id_col="id").first()
    assert 1 / 100 <= r["p_value"] <= 0.05


def test_permuted_positions_are_bijections():
    for n in (1, 2, 7, 100, 1013):
        seen = set()
        for perm in range(1, 6):
            at = cm.permuted_position(np.arange(n), n, perm, seed=3)
            assert sorted(at.tolist()) == list(range(n))
            seen.add(tuple(at.tolist()))
        assert n < 7 or len(seen) == 5


def test_permutation_p_follows_the_null(spark):
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, "abc"[i % 3], float(rng.normal()), float(rng.normal())) for i in range(60)], "id int, g string, x double, y double")
    r = cm.permanova(df, "g", ["x", "y"], permutations=199, id_col="id").first()
    x = np.array([[q.x, q.y] for q in df.orderBy("id").collect()])
    x = x - x.mean(0)
    fs = []
    for perm in range(199):
        label = rng.permutation(np.repeat([0, 1, 2], 20))
        b = sum((x[label == k].sum(0) ** 2).sum() / 20 for k in range(3))
        fs.append((b / 2) / (((x**2).sum() - b) / 57))
    assert abs(r["p_value"] - (1 + sum(f >= r["f"] for f in fs)) / 200) < 0.12


def test_offsets_do_not_change_discriminant_and_ordination(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 4)) + np.arange(90)[:, None] % 3
    for shift in (0.0, 1e8):
        df = spark.createDataFrame([(i, "abc"[i % 3], *map(float, x[i] + shift)) for i in range(90)], "id int, g string, a double, b double, c double, d double")
        _, load, info = cm.discriminant(df, "g", ["a", "b", "c", "d"], keep=["id"])
        _, ratio = cm.ordinate(df, ["a", "b", "c", "d"], k=4)
        disp = cm.dispersion(df, "g", ["a", "b", "c", "d"]).first()["f"]
        if not shift:
            first = info["proportion_of_trace"], ratio, disp
            cov = np.linalg.eigvalsh(np.cov(x.T))[::-1]
            assert np.allclose(ratio, cov / cov.sum(), atol=1e-9)
    assert np.allclose(info["proportion_of_trace"], first[0], atol=1e-5)
    assert np.allclose(ratio, first[1], atol=1e-5) and math.isclose(disp, first[2], rel_tol=1e-4)


def test_spatial_median(spark):
    pts = [(0.0, 0.0), (4.0, 0.0), (0.0, 4.0), (1.0, 1.0), (30.0, 1.0)]
    df = spark.createDataFrame([("a", *p) for p in pts] + [("b", 1.0, 1.0), ("b", 3.0, 1.0), ("b", 2.0, 9.0)], "g string, x double, y double")
    m = {r["g"]: (r["x"], r["y"]) for r in cm.spatial_medians(df, "g", ["x", "y"], iterations=400).collect()}
    z = np.array(pts)
    grid = min((np.hypot(*(z - [u, v]).T).sum(), u, v) for u in np.linspace(0, 4, 161) for v in np.linspace(0, 4, 161))
    assert np.hypot(*(z - np.array(m["a"])).T).sum() <= grid[0] + 1e-3
    d = cm.dispersion(df, "g", ["x", "y"], centre="median").collect()
    assert {r["g"]: r["n"] for r in d} == {"a": 5, "b": 3}


def test_residuals(spark):
    df = spark.createDataFrame([(float(x), 5 + 2 * math.exp(0.03 * x) + (x % 3 - 1) * 0.1) for x in range(1, 61)] + [(None, 1.0)], "x double, y double")
    res = cm.exponential_residuals(df, "x", "y", cm.fit_exponential(df, "x", "y")).collect()
    assert len(res) == 61 and sum(r["residual"] is None for r in res) == 1
    assert all(abs(r["fitted"] + r["residual"] - r["y"]) < 1e-9 and abs(r["residual"]) < 0.3 for r in res if r["residual"] is not None)


def test_bonferroni(spark):
    df = spark.createDataFrame([(0.02,), (0.4,), (0.5,)], "p_value double")
    assert sorted(r["p_adjusted"] for r in cm.bonferroni(df).collect()) == [0.06, 1.0, 1.0]


def test_simper_profile(spark):
    df = spark.createDataFrame([("A", 1.0, 0.0), ("B", 0.0, 1.0)], "g string, v1 double, v2 double")
    rows = cm.simper_profile(df, "g", ["v1", "v2"]).orderBy("cumulative").collect()
    assert [r["contribution"] for r in rows] == [0.5, 0.5] and [r["cumulative"] for r in rows] == [0.5, 1.0]


def test_fit_exponential(spark):
    df = spark.createDataFrame([(float(x), 5 + 2 * math.exp(0.03 * x)) for x in range(1, 51)], "x double, y double")
    r = cm.fit_exponential(df, "x", "y").first()
    assert abs(r["a"] - 5) < 1e-4 and abs(r["b"] - 2) < 1e-4 and abs(r["c"] - 0.03) < 1e-6 and r["r2"] > 0.999999


@pytest.mark.parametrize(("a", "b", "c", "shift"), [(5, 2, 0.03, 0), (-20, 10, 0.03, 0), (100, -80, -0.2, 0), (3, 1e-6, 0.5, 0), (5, 2, 0.03, -1000), (1, 4, -3.0, 0)])
def test_fit_exponential_needs_no_start(spark, a, b, c, shift):
    """The same optimum from any start, against Gauss-Newton on the driver from the true curve."""
    rng = np.random.default_rng(5)
    x = np.repeat(np.arange(1.0, 41.0), 3)
    y = a + b * np.exp(c * x) + rng.normal(size=len(x)) * 0.02 * np.ptp(b * np.exp(c * x))
    want = np.array([a, b, c], float)
    for _ in range(60):
        e = np.exp(want[2] * x)
        want = want + np.linalg.lstsq(np.stack([np.ones_like(x), e, want[1] * x * e], 1), y - want[0] - want[1] * e, rcond=None)[0]
    df = spark.createDataFrame([(float(u + shift), float(v)) for u, v in zip(x, y)] + [(None, 1.0), (2.0, float("nan"))], "x double, y double")
    for start in (None, (-20.0, 10.0, 0.03), (0.0, -1.0, -0.9)):
        r = cm.fit_exponential(df, "x", "y", start).first()
        assert r["converged"] and r["n_points"] == len(x)
        assert np.allclose([r["a"], r["b"] * math.exp(r["c"] * shift), r["c"]], want, rtol=1e-7), (r, want)
        assert math.isclose(r["rss"], float(((y - want[0] - want[1] * np.exp(want[2] * x)) ** 2).sum()), rel_tol=1e-9)
        if shift:
            break


def test_fit_exponential_without_a_curve(spark):
    line = cm.fit_exponential(spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(30)], "x double, y double"), "x", "y").first()
    assert not line["converged"] and abs(line["r2"] - 1) < 1e-9
    for rows in ([], [(1.0, 2.0)], [(1.0, 1.0), (1.0, 2.0), (1.0, 4.0)], [(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)]):
        r = cm.fit_exponential(spark.createDataFrame(rows, "x double, y double"), "x", "y").first()
        assert (r["a"], r["b"], r["c"], r["converged"], r["n_points"]) == (None, None, None, False, len(rows))


def test_discriminant_and_ordination(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "abc"[i % 3], *map(float, rng.normal(size=3) + (i % 3))) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, g string, a double, b double, c double")
    scores, load, info = cm.discriminant(df, "g", ["a", "b", "c"], keep=["id"])
    assert scores.count() == 60 and load.count() == 3 and abs(sum(info["proportion_of_trace"]) - 1) < 1e-9
    # within-group covariance of the scores is the identity (sphered)
    pdf = scores.toPandas()
    w = sum(np.cov(pdf[pdf.g == k][["LD1", "LD2"]].T.values) * (len(pdf[pdf.g == k]) - 1) for k in "abc") / 57
    assert np.allclose(w, np.eye(2), atol=1e-8)
    pcs, ratio = cm.ordinate(df, ["a", "b", "c"], k=2, keep=["id"])
    assert pcs.count() == 60 and ratio[0] >= ratio[1]
    assert abs(pcs.agg(F.avg("PC1")).first()[0]) < 1e-9


def test_vector_fit(spark):
    rows = [(i, float(i), float((i * 7) % 11), 2.0 * i + 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, x double, y double, v double")
    r = cm.vector_fit(df, ["x", "y"], ["v"], permutations=19, id_col="id").first()
    assert math.isclose(r["r2"], 1.0) and math.isclose(r["dir_x"], 1.0, abs_tol=1e-9) and r["p_value"] == 0.05


def test_transect_rectangle(spark):
    df = spark.createDataFrame([(0.0, 0.0, 90.0)], "longitude double, latitude double, dc_heading double")
    ring = geo.transect_rectangle(df).first()["ring"]
    assert len(ring) == 5 and ring[0] == ring[4]
    # heading 90: long side east-west (+-30 m), short side north-south (+-2 m)
    m_per_deg_lat = 110574.0
    m_per_deg_lon = 111320.0
    xs = sorted({round(p["lon"] * m_per_deg_lon, 1) for p in ring})
    ys = sorted({round(p["lat"] * m_per_deg_lat, 1) for p in ring})
    assert xs == [-30.0, 30.0] and ys == [-2.0, 2.0]


def _walked(lon, lat, bearing, metres, steps=400):
    """Destination by integrating the geodesic's equations (fourth-order Runge-Kutta)."""
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)

    def slope(v):
        w = 1 - e2 * math.sin(v[1]) ** 2
        n = a / math.sqrt(w)
        return np.array([math.sin(v[2]) / (n * math.cos(v[1])), math.cos(v[2]) * w / (n * (1 - e2)), math.sin(v[2]) * math.tan(v[1]) / n])

    v, h = np.radians([lon, lat, bearing]), metres / steps
    for _ in range(steps):
        k1 = slope(v)
        k2 = slope(v + h / 2 * k1)
        k3 = slope(v + h / 2 * k2)
        k4 = slope(v + h * k3)
        v = v + h / 6 * (k1 + 2 * k2 + 2 * k3 + k4)
    lon2, lat2 = np.degrees(v[:2])
    return (lon2 + 180) % 360 - 180, lat2


def test_destination_point(spark):
    # published: an example of the direct problem over 10,000 km, and a baseline of two survey marks (bearing to 0.01 seconds)
    dms = lambda d, m, s: d + m / 60 + s / 3600
    known = [(0.0, 40.0, 30.0, 1e7, 137.84490004377, 41.79331020506, 1e-3),
             (dms(144, 25, 29.52440), -dms(37, 57, 3.72030), dms(306, 52, 5.37), 54972.271, dms(143, 55, 35.38390), -dms(37, 39, 10.15610), 2e-3)]
    for lon in (179.9999, -179.99, 180.0, -122.0, 0.0):
        for lat in (0.0, 36.6, -75.0):
            for bearing in (0.0, 37.0, 90.0, 271.5, 180.0):
                for metres in (0.0, 30.0, 1e5):
                    known.append((lon, lat, bearing, metres, *_walked(lon, lat, bearing, metres), 1e-3))
    df = spark.createDataFrame([(i, *map(float, k[:4])) for i, k in enumerate(known)] + [(-1, None, 1.0, 1.0, 1.0)], "i int, lon double, lat double, b double, m double")
    got = {r["i"]: r["p"] for r in df.select("i", destination_point("lon", "lat", "b", "m").alias("p")).collect()}
    assert got[-1] is None
    for i, k in enumerate(known):
        lon, lat = got[i]
        assert -180 < lon <= 180
        off = math.hypot(((lon - k[4] + 180) % 360 - 180) * math.cos(math.radians(lat)), lat - k[5]) * 111_320
        assert off < k[6], (k, lon, lat, off)


def test_rectangle_across_longitude_180(spark):
    df = spark.createDataFrame([(180.0, 10.0, 90.0)], "longitude double, latitude double, dc_heading double")
    ring = geo.transect_rectangle(df).first()["ring"]
    assert [p["lon"] > 0 for p in ring] == [True, False, False, True, True]
    assert all(abs(abs(p["lon"]) - 180) < 1e-3 for p in ring)


def _scaled(x, k):
    """Exact classical scaling of all pairs."""
    n = len(x)
    d = np.array([[np.abs(u - v).sum() / max((u + v).sum(), 1e-300) for v in x] for u in x])
    c = np.eye(n) - 1 / n
    w, v = np.linalg.eigh(-c @ d**2 @ c / 2)
    return v[:, ::-1][:, :k] * np.sqrt(w[::-1][:k]), w[::-1], d


def _rotated_error(a, b):
    """Share of b's squares left after a is rotated, reflected and shifted onto it."""
    a, b = a - a.mean(0), b - b.mean(0)
    u, _, v = np.linalg.svd(a.T @ b)
    return float(((a @ u @ v - b) ** 2).sum() / (b**2).sum())


def test_landmark_ordination(spark):
    rng = np.random.default_rng(8)
    x = rng.poisson(np.exp(rng.normal(size=(500, 1)) * 0.3) * rng.gamma(2.0, 4.0, size=(4, 6))[rng.integers(0, 4, 500)]).astype(float)
    x[7], x[8], x[9] = 0, 0, x[10]  # empty profiles and a repeated one
    want, evals, d = _scaled(x, 2)
    df = spark.createDataFrame([(i, "k", *map(float, r)) for i, r in enumerate(x)] + [(500, "null", None, *[1.0] * 5)], "id long, __off string, " + ", ".join(f"v{j} double" for j in range(6)))
    cols = [f"v{j}" for j in range(6)]
    for landmarks, error in ((500, 1e-12), (120, 0.02)):
        scores, info = cm.landmark_ordination(df.repartition(7), "id", cols, landmarks=landmarks)
        got = scores.orderBy("id").collect()
        at = np.array([(r["MDS1"], r["MDS2"]) for r in got])
        assert info["landmarks"] == landmarks and [r["id"] for r in got] == list(range(500))
        assert _rotated_error(at, want) < error
        assert np.allclose(at[7], at[8]) and np.allclose(at[9], at[10])
    e = np.sqrt(((want[:, None] - want[None]) ** 2).sum(2))
    scores, info = cm.landmark_ordination(df, "id", cols)
    assert np.allclose(info["eigenvalues"], evals, atol=1e-8) and abs(info["stress"] - math.sqrt(((d - e) ** 2).sum() / (d**2).sum())) < 1e-9
    euclid, _ = cm.landmark_ordination(df, "id", cols, k=6, metric="euclidean", landmarks=60)
    at = np.array([[r[f"MDS{j + 1}"] for j in range(6)] for r in euclid.orderBy("id").collect()])
    assert _rotated_error(at, x) < 1e-9 and euclid.agg(F.max("misfit")).first()[0] < 1e-6


def test_landmark_ordination_edges(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 3.0), (None, 2.0, 3.0)], "id int, a double, b double")
    scores, info = cm.landmark_ordination(df, "id", ["a", "b"])
    assert [(r["MDS1"], r["MDS2"]) for r in scores.collect()] == [(0.0, 0.0)] * 3 and info["stress"] is None
    scores, info = cm.landmark_ordination(df.where("false"), "id", ["a", "b"])
    assert scores.count() == 0 and info == {"eigenvalues": [], "landmarks": 0, "stress": None}
    with pytest.raises(Exception, match="at least 0"):
        cm.landmark_ordination(spark.createDataFrame([(1, -2.0)], "id int, a double"), "id", ["a"])
    with pytest.raises(ValueError, match="MDS2"):
        cm.landmark_ordination(df.withColumnRenamed("a", "MDS2"), "id", ["b"], keep=["MDS2"])
    with pytest.raises(ValueError, match="unknown metric"):
        cm.landmark_ordination(df, "id", ["a"], metric="x")


def test_describe_site(spark):
    df = spark.createDataFrame([("Long", "Margin", 10.0)], "site_long string, survey_type string, target_depth_meters double")
    r = geo.describe_site(df, {"Survey Type": "survey_type", "Target Depth (m)": "target_depth_meters"}).first()
    assert r["Name"] == "Long"
    assert r["Description"] == "<strong>Survey Type:</strong> Margin<br><strong>Target Depth (m):</strong> 10<br>"


@pytest.mark.parametrize("kind", ["'refund'", "cast(null as string)"])
def test_unlisted_event_type_fails_the_count_queries(spark, tmp_path, kind):
    from tidemark.plans import queries

    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.withColumn("event_type", F.expr(f"if(event_id = 5, {kind}, event_type)")).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("com2_bray_curtis", "com5_simper", "com9_group_shape_counts"):
        with pytest.raises(Exception, match="event type is not listed"):
            queries()[name](spark, str(tmp_path)).collect()


def test_vector_fit_by_strata_agrees_with_free_permutation(spark):
    import random

    from tidemark.operators import community as cm

    rnd = random.Random(21)
    rows = []
    for i in range(600):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, a, b, 0.10 * a + rnd.gauss(0, 1), rnd.gauss(0, 1), a + b))
    df = spark.createDataFrame(rows, "id long, a double, b double, weak double, none double, strong double")
    free = {r["variable"]: r for r in cm.vector_fit(df, ["a", "b"], ["weak", "none", "strong"], 499, id_col="id").collect()}
    cut = {r["variable"]: r for r in cm.vector_fit(df, ["a", "b"], ["weak", "none", "strong"], 499, id_col="id", stratum_rows=100).collect()}
    for v in free:
        assert abs(free[v]["r2"] - cut[v]["r2"]) < 1e-12
        assert abs(free[v]["p_value"] - cut[v]["p_value"]) < 0.08, v
    assert cut["strong"]["p_value"] == free["strong"]["p_value"] == 1 / 500


def test_pair_sums_need_no_more_memory_for_more_rows():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tidemark.operators import community as cm

    def batches(n):
        for at in range(0, n, 1000):
            ids = np.arange(at, at + 1000)
            x = np.random.default_rng(at).standard_normal((1000, 32))
            yield pa.RecordBatch.from_pydict({"__rank": pa.array(ids // 2), "__x": pa.array(list(x), pa.list_(pa.float64())), "__g": pa.array((ids % 2).astype(np.int32))})

    def peak(n):
        tracemalloc.start()
        out = pa.Table.from_batches(cm._pair_sums(batches(n), np.array([n // 2, n // 2]), 32, 199, 5))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most

    out, small = peak(6_000)
    x = np.concatenate([cm._matrix(pa.Table.from_batches([b])) for b in batches(6_000)])
    ids = np.arange(6_000)
    at = np.where(ids % 2 == 0, ids // 2, ids // 2 + 3_000)
    for perm in (1, 64, 199):
        want = x[cm.permuted_position(at, 6_000, perm, 5 + 1) < 3_000].sum(0)
        assert np.allclose(out.column("s")[perm - 1].as_py(), want)
    assert small < 40 << 20 and peak(60_000)[1] < 1.5 * small
