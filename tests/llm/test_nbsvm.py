"""Quality classifier."""

import numpy as np

from tidemark.llm import nbsvm

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def _data(n=400, seed=1):
    rng = np.random.default_rng(seed)
    good, bad = "river stone quiet garden morning letter".split(), "WIN!! CASH### $$$ FREE!! CLICK&&&".split()
    docs, labels = [], []
    for i in range(n):
        q = int(rng.random() < 0.75)
        words = [str(rng.choice(good if rng.random() < (0.9 if q else 0.35) else bad)) for _ in range(rng.integers(5, 120))]
        docs.append((i, " ".join(words), "en"))
        labels.append((i, q, 0))
    return docs, labels


def test_indicators_are_distinct_and_whole():
    text = "abcd" * 50_000 + "tail end"
    one = nbsvm.indicators(text)
    assert len(set(one.tolist())) == len(one)
    assert set(nbsvm.indicators(text, piece=1000).tolist()) == set(one.tolist())
    assert len(nbsvm.indicators(None)) == len(nbsvm.indicators("")) == 0
    assert (0 <= one).all() and (one < nbsvm.FEATURES).all()


def test_held_out_quality(spark):
    docs, labels = _data()
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = {r.doc_id: r for r in nbsvm.score_quality(d, lab).collect()}
    held = [(got[i], q) for i, q, _ in labels if got[i].held_out]
    pos, neg = [r.score for r, q in held if q], [r.score for r, q in held if not q]
    assert len(held) > 50
    assert np.mean(np.array(pos)[:, None] > np.array(neg)[None]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    # labels of held-out documents are not read
    flipped = lab.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end as quality")
    assert {r.doc_id: r.score for r in nbsvm.score_quality(d, flipped).collect()} == {k: r.score for k, r in got.items()}


def test_odd_rows(spark):
    docs, labels = _data(120)
    docs += [(500, None, None), (501, "", "en"), (502, "x " * 200_000, "en"), (None, "river stone", "en"), (3, "river", "de")]
    labels += [(500, 1, 0), (501, None, 0), (1, 5, 0), (None, 1, 1), (9999, 0, 0), (2, 1, 0)]
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "7 as y", "8 as key", "9 as score", "1 as quality")
    got = nbsvm.score_quality(d, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(docs) and all(r.score is not None for r in got)
    scores = {str(r.doc_id): r.score for r in got}
    assert scores["500"] == scores["501"]


def test_no_labels_one_class_no_rows(spark):
    d = spark.createDataFrame([(1, "a", None), (4, "b c", None)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in nbsvm.score_quality(d, none).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(i, 1, 0) for i in range(10)], LABELS)
    assert all(r.score > 0.5 for r in nbsvm.score_quality(d, one).collect())
    assert nbsvm.score_quality(d.where("false"), one).count() == 0


def test_descent_reaches_the_optimum_of_a_separable_set():
    rows = [np.array([1, 2]), np.array([1, 3]), np.array([4, 5]), np.array([4, 6])]
    w, b = nbsvm.descend(rows, np.array([1, 1, 0, 0]), np.ones(nbsvm.FEATURES), cost=100.0, rounds=500, tolerance=1e-6)
    margins = [w[f].sum() / np.sqrt(2) + b for f in rows]
    assert np.allclose(margins, [1, 1, -1, -1], atol=0.01)


def test_descent_against_a_dense_solver():
    """The same hinge-loss problem on dense matrices, by accelerated projected gradient steps on its dual."""
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 60, rng.integers(3, 20))) for _ in range(200)]
    y = (np.array([(r < 25).mean() for r in rows]) + rng.normal(0, 0.25, 200) > 0.4).astype(int)  # not separable
    ratio = np.zeros(nbsvm.FEATURES)
    ratio[:60] = rng.normal(0, 1, 60)
    weights, bias = nbsvm.descend(rows, y, ratio, rounds=400, tolerance=1e-5)
    x = np.zeros((200, 61))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / np.sqrt(len(r))
    x[:, 60] = 1  # the bias
    s, top = np.where(y > 0, 1.0, -1.0), np.array([200 / (2 * (y == v).sum()) for v in y])

    def primal(w):
        return 0.5 * w @ w + (top * np.maximum(0, 1 - s * (x @ w))).sum()

    q = (x * s[:, None]) @ (x * s[:, None]).T
    alpha = ahead = np.zeros(200)
    step, t = 1 / np.linalg.eigvalsh(q)[-1], 1.0
    for _ in range(20_000):
        new = np.clip(ahead - step * (q @ ahead - 1), 0, top)
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, alpha = new + (old - 1) / t * (new - alpha), new
    best = primal(x.T @ (alpha * s))
    own = np.concatenate((weights[:60] / ratio[:60], [bias]))
    assert primal(own) <= best * 1.005 and np.abs(own - x.T @ (alpha * s)).max() < 0.05


def test_sample_is_cut_by_hash_before_texts_move(spark):
    docs, labels = _data(900)
    rows = spark.createDataFrame([(i, t, q) for (i, t, _), (_, q, _) in zip(docs, labels, strict=True)], "key long, text string, y int")
    asked = []
    limit = type(rows).limit
    try:
        type(rows).limit = lambda self, n: (asked.append(self.count()), limit(self, n))[1]
        nbsvm.train(rows, sample_rows=200)
    finally:
        type(rows).limit = limit
    assert 200 <= asked[0] <= 260  # of 900
