"""Quality classifier: naive Bayes support vectors.

Binary n-gram indicators (hashed byte 4-grams of the whole text) are scaled by
the classes' log-count ratios, taken over all labelled training rows, and
length-normalised. A linear hinge-loss model is fitted on them by dual
coordinate descent over a bounded sample; a logistic curve over the margins of
rows set aside turns margins into scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import held_out, written

BITS = 18
FEATURES = 1 << BITS
#: The hinge-loss fit reads at most this many labelled rows (class counts read all of them).
SAMPLE_ROWS = 6000
_LAST = np.full(FEATURES, -1, np.int64)


def indicators(text: str | None, piece: int = 1 << 20) -> np.ndarray:
    """Distinct hashed 4-grams of the text's bytes (with a blank before and after it)."""
    data = b" " + (text or "").encode("utf-8", "surrogatepass") + b" "
    found = []
    for at in range(0, max(1, len(data) - 3), piece):
        w = np.frombuffer(data[at : at + piece + 3], np.uint8).astype(np.uint32)
        if len(w) < 4:
            break
        code = w[:-3] | w[1:-2] << np.uint32(8) | w[2:-1] << np.uint32(16) | w[3:] << np.uint32(24)
        h = (code * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)).astype(np.int64)
        order = np.arange(len(h))
        _LAST[h] = order  # the last place of each feature stands for it
        found.append(h[_LAST[h] == order])
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, feats: np.ndarray) -> float:
        return float(self.weights[feats].sum() / np.sqrt(max(1, len(feats))) + self.bias)

    def score(self, text: str | None) -> float:
        z = self.slope * self.margin(indicators(text)) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def class_counts(rows: DataFrame) -> DataFrame:
    """(feature, pos, neg): documents of each class that hold the feature, over all rows (text, y)."""

    def count(batches):
        both = np.zeros((2, FEATURES), np.int64)
        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("y").to_pylist(), strict=True):
                both[y, indicators(text.as_py())] += 1
        some = np.flatnonzero(both.any(0))
        yield pa.RecordBatch.from_pydict({"feature": pa.array(some), "pos": pa.array(both[1, some]), "neg": pa.array(both[0, some])})

    return rows.mapInArrow(count, "feature long, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = 1.0, rounds: int = 30, tolerance: float = 0.01) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L2-regularised hinge loss over scaled, normalised indicators; the bias is a constant feature."""
    sign = np.where(y > 0, 1.0, -1.0)
    share = {1: max(1, (y > 0).sum()), 0: max(1, (y <= 0).sum())}
    top = np.array([cost * len(y) / (2 * share[int(v > 0)]) for v in y])
    values = [ratio[f] / np.sqrt(max(1, len(f))) for f in rows]
    square = np.array([v @ v + 1.0 for v in values])
    w, bias, alpha = np.zeros(FEATURES), 0.0, np.zeros(len(y))
    draw = np.random.default_rng(7)
    for _ in range(rounds):
        worst = 0.0
        for i in draw.permutation(len(y)):
            f, v, s = rows[i], values[i], sign[i]
            g = s * (w[f] @ v + bias) - 1.0
            step = min(max(alpha[i] - g / square[i], 0.0), top[i]) - alpha[i]
            if step:
                alpha[i] += step
                w[f] += step * s * v
                bias += step * s
                worst = max(worst, abs(step) / top[i])
        if worst < tolerance:
            break
    return w * ratio, bias


def logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y = 1), by Newton steps with the targets pulled in from 0 and 1."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (t - p) - 1e-6 * theta)
        size = np.abs(step).max()
        theta = theta + step * min(1.0, 5 / max(size, 1e-12))
        if size < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, smoothing: float = 1.0) -> Model:
    """Fit on rows (key, text, y in {0, 1}).

    Log-count ratios use every row. The hinge-loss fit uses the rows with the
    smallest key hashes, ``sample_rows`` at most, and runs in one task; rows
    above a hash that about a tenth more than that lie under are left out
    before texts are sent to it, so its input does not grow with the table.
    The driver receives arrays of fixed size. Without rows every score is 0.5;
    with one class it is that class's smoothed share. ``rows`` is read three
    times: a written table of keys, texts and classes.
    """
    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return Model(np.zeros(FEATURES), 0.0, 0.0, float(np.log((n1 + 1) / (n0 + 1))))
    counts = class_counts(rows).toPandas()
    pos, neg = np.full(FEATURES, smoothing), np.full(FEATURES, smoothing)
    pos[counts["feature"]] += counts["pos"]
    neg[counts["feature"]] += counts["neg"]
    ratio = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    held = rows.sparkSession.sparkContext.broadcast(ratio)

    def fit(batches):
        feats, ys = [], []
        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("y").to_pylist(), strict=True):
                feats.append(indicators(text.as_py()).astype(np.int32))
                ys.append(y)
        y = np.array(ys)
        aside = np.arange(len(y)) % 4 == 3  # rows in order of their hash
        w, bias = descend([f for f, a in zip(feats, aside, strict=True) if not a], y[~aside], held.value)
        model = Model(w, bias, 1.0, 0.0)
        use = aside if len(set(y[aside].tolist())) == 2 else ~aside
        slope, offset = logistic(np.array([model.margin(f) for f, a in zip(feats, use, strict=True) if a]), y[use])
        yield pa.RecordBatch.from_pydict({"weights": [w.astype("<f8").tobytes()], "bias": [bias], "slope": [slope], "offset": [offset]})

    share = min(1.0, 1.1 * sample_rows / (n1 + n0))
    low = F.xxhash64("key") <= F.lit(int(share * (1 << 64)) - (1 << 63) if share < 1 else (1 << 63) - 1)
    sample = rows.where(low).orderBy(F.xxhash64("key"), "key").limit(sample_rows).coalesce(1)
    got = sample.select("text", "y").mapInArrow(fit, "weights binary, bias double, slope double, offset double").first()
    return Model(np.frombuffer(got.weights, "<f8").copy(), got.bias, got.slope, got.offset)


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """Score column of a text column."""
    held = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def tell(texts: pd.Series) -> pd.Series:
        return pd.Series([held.value.score(t) for t in texts], dtype=float)

    return tell(text)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.7) -> DataFrame:
    """Train on the labelled documents outside the held-out fold, score every document.

    Returns (id_col, held_out, score, predicted). Null texts score as empty
    ones. Labels that are null, or not 0 or 1, and labels without a document
    are left out; a document labelled more than once counts with each label
    row, repeated documents each. Rows with a null id have no label.
    Without labels all scores are 0.5. An empty table gives an empty result.
    Other columns are ignored.
    """
    marked = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("y"))
    # texts meet the labels once, unsorted, and only labelled ones are written
    rows = docs.where(~held_out(id_col)).select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(marked.hint("shuffle_hash"), "key")
    model = train(written(rows, "quality-rows"))
    told = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score(docs.sparkSession, model, F.col(text_col)).alias("score"))
    return told.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
