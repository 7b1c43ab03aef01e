"""Language identification with language-bitmask n-gram filters.

The n-grams that are frequent in a language (at least ``min_share`` of its
training n-grams, so at most ``1 / min_share`` of them whatever the corpus
size) are put into one bit-sliced Bloom filter: every slot holds a bitmask
with one bit for each language. AND-ing the slots that an n-gram hashes to
returns all languages that contain it at once. Per-language popcounts over a
text's n-grams, corrected for each language's false-positive rate, decide.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import held_out, own_names, text_batches

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: byte -> lower-case letter byte, 32 for anything that is not a letter (bytes of multi-byte characters count as letters)
_CLASS = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], dtype=np.uint8)
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _grams(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """4-byte n-grams of the texts as uint32, with the index of the text of each; a text's do not depend on its neighbours."""
    gap = b"    "
    buf = _CLASS[np.frombuffer(gap + gap.join(run) + gap, dtype=np.uint8)]
    # each text owns the gap before it, where its first n-gram begins, and starts no n-gram in the one after it
    owner = np.repeat(np.arange(len(run), dtype=np.int32), np.fromiter((len(b) + 4 for b in run), np.int64, len(run)))
    w = buf[: len(owner) + 3].astype(np.uint32)
    code = w[:-3] | w[1:-2] << np.uint32(8) | w[2:-1] << np.uint32(16) | w[3:] << np.uint32(24)
    keep = (w[1:-2] != 32) & (w[2:-1] != 32)  # both middle bytes are letters: no n-gram spans a gap
    return code[keep], owner[keep]


@dataclass
class LanguageFilters:
    """Fixed-size model: ``slots`` (words x table size) bitmasks, the languages and their false-positive rates."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    hashes: int

    @staticmethod
    def build(languages: list[str], grams: dict[str, np.ndarray], hashes: int = 3, per_gram: int = 16) -> LanguageFilters:
        most = max([len(g) for g in grams.values()], default=1)
        size = 1 << max(10, int(np.ceil(np.log2(max(1, most) * per_gram))))
        words = max(1, -(-len(languages) // 64))
        slots = np.zeros((words, size), np.uint64)
        for i, lang in enumerate(languages):
            for probe in _probes(grams[lang], hashes, size):
                slots[i // 64, probe] |= np.uint64(1) << np.uint64(i % 64)
        fill = np.array([np.count_nonzero(slots[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / size for i in range(len(languages))])
        if len(languages) <= 8:
            slots = slots.astype(np.uint8)
        return LanguageFilters(languages, slots, fill**hashes, hashes)

    def containing(self, grams: np.ndarray) -> np.ndarray:
        """Bitmask words (words x n) of the languages that contain each n-gram."""
        return reduce(np.bitwise_and, (self.slots[:, p] for p in _probes(grams, self.hashes, self.slots.shape[1])))

    def predict(self, texts) -> tuple[list[str], list[float]]:
        """Language and score (share of the text's n-grams found in it, corrected) of each text."""
        labels, scores = [], []
        count = len(self.languages)
        for _, run in text_batches(texts, 1 << 18):
            grams, owner = _grams(run)
            total = np.bincount(owner, minlength=len(run)).astype(float)
            hits = np.zeros((len(run), count))
            if count and len(grams):
                mask = self.containing(grams)
                for i in range(count):
                    has = mask[i // 64] >> mask.dtype.type(i % 64) & mask.dtype.type(1)
                    hits[:, i] = np.bincount(owner, weights=has, minlength=len(run))
            real = np.clip((hits - total[:, None] * self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, total[:, None])
            for j, b in enumerate(run):
                if not count or not _LETTER.search(b.decode("utf-8", "surrogatepass")):
                    labels.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    best = int(np.argmax(real[j]))  # ties go to the first language in name order
                    labels.append(self.languages[best])
                    scores.append(float(real[j, best] / total[j]) if total[j] else 0.0)
        return labels, scores


def _probes(grams: np.ndarray, hashes: int, size: int):
    g = grams.astype(np.uint64)
    shift = np.uint64(64 - int(size).bit_length() + 1)
    for k in range(hashes):
        yield ((g + np.uint64(k + 1)) * np.uint64(_MIX[k % len(_MIX)]) >> shift).astype(np.int64)


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) over all rows, combined within batches, then by Spark."""

    def count(batches):
        for batch in batches:
            frame = batch.to_pandas()
            for lang, part in frame.groupby("lang", sort=False):
                for _, run in text_batches(part["text"], 1 << 20):
                    gram, n = np.unique(_grams(run)[0], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(gram), pa.string()), "gram": pa.array(gram.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_share: float = 2e-5) -> LanguageFilters:
    """Fit the filters on every row with a language and a text.

    The driver receives at most ``1 / min_share`` n-grams of each language.
    Without such rows the model has no language and answers ``und``.
    """
    counts = gram_counts(docs, text_col, lang_col).cache()
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counts.join(total, "lang").where(F.col("n") >= F.col("total") * min_share)
    packed = kept.select("lang", "gram").toPandas()
    languages = sorted(r.lang for r in total.select("lang").collect())
    counts.unpersist()
    return LanguageFilters.build(languages, {lang: packed.loc[packed["lang"] == lang, "gram"].to_numpy(np.uint32) for lang in languages})


def predict(spark: SparkSession, model: LanguageFilters, text: Column) -> Column:
    """Struct column (lang_pred string, score double) of a text column; the model's size is fixed, see ``build``."""
    held = spark.sparkContext.broadcast(model)

    @pandas_udf("lang_pred string, score double")
    def tell(texts: pd.Series) -> pd.DataFrame:
        labels, scores = held.value.predict(texts)
        return pd.DataFrame({"lang_pred": pd.Series(labels, dtype=object), "score": pd.Series(scores, dtype=float)})

    return tell(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the rows outside the held-out fold, predict every row.

    Returns (id_col, held_out, lang_pred, score). Null texts and texts without
    a letter are ``und`` with score 0; so is everything if no row has a
    language. Rows with a null id are training rows (``held_out`` false).
    Repeated rows are predicted alike. Other columns are ignored.
    """
    model = train(docs.where(~held_out(id_col)), text_col, lang_col)
    told = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), predict(docs.sparkSession, model, F.col(text_col)).alias("p"))
    return told.select(id_col, "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = 0.3) -> DataFrame:
    """Rows whose language is identified (not ``und``) with at least ``min_score``; all columns stay."""
    model = train(docs.where(~held_out(id_col)), text_col, lang_col)
    [name] = own_names(docs, "__told")
    told = docs.withColumn(name, predict(docs.sparkSession, model, F.col(text_col)))
    return told.where((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= min_score)).drop(name)
