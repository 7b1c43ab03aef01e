"""HNSW search against brute force."""

import numpy as np

from tidemark.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>"


def _brute(rows, queries, k):
    good = {}
    for i, v in rows:
        if i is None or not v or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            continue
        good.setdefault(i, np.array(v, np.float32).astype(float))
    out = {}
    for q in queries:
        if q in good:
            near = sorted((-float(good[q] @ x), i) for i, x in good.items() if i != q and len(x) == len(good[q]))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def _got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def test_recall_on_random_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24)) * rng.uniform(0.2, 2, size=(3000, 1))  # lengths differ
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = _got(hnsw.nearest(df.where("vec_id % 20 = 0"), df, k=20, min_shards=3))
    want = _brute(rows, range(0, 3000, 20), 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9


def test_copies_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(200)] + [(i, rng.normal(size=3).tolist()) for i in range(200, 300)]
    rows += [(300, None), (301, []), (302, [0.0, 0.0, 0.0]), (303, [1.0, None, 2.0]), (304, [float("nan"), 1.0, 1.0]), (305, [float("inf"), 1.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (20, [1.0, 0.0, 0.5]), (310, [1.0, 2.0]), (320, [2.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "0 as shard", "'x' as ids", "1 as score")
    queries = [0, 20, 200, 280, 300, 302, 320]
    got = _got(hnsw.nearest(df.where(f"vec_id in ({','.join(map(str, queries))})"), df, k=7, min_shards=2))
    want = _brute(rows, queries, 7)
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in near]
        assert np.allclose([s for _, s in got[q]], [s for _, s in near], rtol=1e-12)


def test_few_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], SCHEMA)
    assert _got(hnsw.nearest(df, df, k=20)) == {1: [(2, 0.5)], 2: [(1, 0.5)]}
    empty = df.where("false")
    assert hnsw.nearest(empty, df).count() == 0
    assert hnsw.nearest(df, empty).count() == 0
    assert hnsw.nearest(empty, empty).count() == 0


def test_layers_are_flat_prefix_arrays():
    x = np.random.default_rng(1).normal(size=(700, 8))
    g = hnsw.build(x, links=8, width=32)
    assert g.counts[0] == 700 and all(a > b for a, b in zip(g.counts, g.counts[1:]))
    assert [layer.shape for layer in g.layers] == [(700, 16), *((n, 8) for n in g.counts[1:])]
    assert all((layer < n).all() for layer, n in zip(g.layers, g.counts))


def test_recall_of_a_full_shard(spark):
    """One shard as full as the code allows, isotropic and clustered vectors."""
    import inspect

    full = inspect.signature(hnsw.nearest).parameters["shard_rows"].default
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 64))
    for name, x in (("isotropic", rng.normal(size=(full, 64))), ("clustered", centres[rng.integers(0, 40, full)] + 0.3 * rng.normal(size=(full, 64)))):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
        got = _got(hnsw.nearest(df.where("vec_id % 20 = 0"), df, k=20, min_shards=1))
        x = x.astype(np.float32).astype(float)
        hits = total = 0
        for q in range(0, full, 20):
            s = x @ x[q]
            s[q] = -np.inf
            want = set(np.argsort(-s)[:20].tolist())
            hits += len(want & {i for i, _ in got[q]})
            total += 20
        print(name, hits / total)
        assert hits / total >= 0.9, name


def test_query_files_hold_every_query_once_and_are_discarded(spark):
    from tidemark.llm import common, fsio

    rows = [(i, [float(i), 1.0]) for i in range(1, 90)] + [(i, [1.0, float(i), 2.0]) for i in range(100, 120)]
    queries = hnsw.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    files = hnsw.write_queries(queries, block=16).collect()
    assert len(files) > 7 and {f.dims for f in files} == {2, 3}
    seen = {}
    for f in files:
        with fsio.reading(f.uri) as stream:
            raw = stream.read()
        x = np.frombuffer(raw, "<f8", f.n * f.dims, 8 * f.n).reshape(f.n, f.dims)
        for i, v in zip(np.frombuffer(raw, "<i8", f.n).tolist(), x.tolist(), strict=True):
            assert i not in seen
            seen[i] = v
    assert seen == dict(rows)
    index = hnsw.build_index(queries, 5, 3)
    found = hnsw.search_index(index, hnsw.write_queries(queries, block=16), 5, 3).collect()
    assert len({(r.query_id, r.vec_id) for r in found}) == len(found)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(common.run_dir(spark))
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert store.exists(path)
    common.discard(spark)
    assert not store.exists(path)
    want = _brute(rows, [1, 110], 20)
    got = _got(hnsw.nearest(spark.createDataFrame(rows, SCHEMA).where("vec_id in (1, 110)"), spark.createDataFrame(rows, SCHEMA), k=20))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
