"""Ranked lexical search of all documents for a set of items, with shared work among the items.

Term sets that several items hold in common are mined: items list their terms
with the most shared first, and neighbours that occur together in two items or
more become one node, round after round. A node is the sum of two nodes, a leaf
the weighted occurrences of one term, so a block of documents fills each
accumulator once, whatever the number of items above it, and an item adds up
the few nodes that are left of it.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import word_lists, written

#: Terms of items (with repeats among items) that one pass over the documents serves; more items take more passes.
BLOCK_TERMS = 200_000
#: Accumulator cells held at once in a task.
_CELLS = 1 << 22

#: A-Z become a-z, other ASCII that is neither letter nor digit parts terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def term_counts(text: str | None) -> Counter[bytes]:
    """Occurrences of each term (UTF-8) of a text; null has none."""
    out: Counter[bytes] = Counter()
    for words in word_lists((text or "").encode("utf-8").translate(_FOLD)):
        out.update(words)
    return out


# ------------------------------------------------------------- the sharing DAG


@dataclass
class Sharing:
    """Nodes 0 .. leaves-1 are terms; node leaves+i is the sum of ``left[i]`` and ``right[i]``, both lower numbers of
    earlier levels (``levels``: first inner node of each). Item j is the sum of ``parts[starts[j]:starts[j + 1]]``."""

    leaves: int
    left: np.ndarray
    right: np.ndarray
    levels: list[int]
    parts: np.ndarray
    starts: np.ndarray

    def accumulate(self, leaf: np.ndarray) -> np.ndarray:
        """Scores (items x documents) from leaf accumulators (terms x documents)."""
        inner = len(self.left)
        acc = np.empty((self.leaves + inner, leaf.shape[1]), np.int64)
        acc[: self.leaves] = leaf
        for a, b in zip(self.levels, [*self.levels[1:], inner]):
            acc[self.leaves + a : self.leaves + b] = acc[self.left[a:b]] + acc[self.right[a:b]]
        out = np.zeros((len(self.starts) - 1, leaf.shape[1]), np.int64)
        some = np.flatnonzero(np.diff(self.starts))
        step = max(1, _CELLS // max(1, leaf.shape[1]))
        for a, b in _runs(np.diff(self.starts)[some], step):
            own = some[a:b]
            first, last = self.starts[own[0]], self.starts[own[-1] + 1]
            out[own] = np.add.reduceat(acc[self.parts[first:last]], self.starts[own] - first, axis=0)
        return out


def _runs(sizes: np.ndarray, limit: int):
    """(first, last) of runs whose sizes add up to the limit at most; one larger size stands alone."""
    a, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > a and total + n > limit:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def share(items: list[list[int]], leaves: int) -> Sharing:
    """Mine node pairs that two items or more hold, most frequent first, until none is left."""
    sets = [np.unique(np.array(x, np.int64)) for x in items]
    left: list[int] = []
    right: list[int] = []
    levels: list[int] = []
    draw = np.random.default_rng(11).integers(1, 1 << 62, len(items))
    while True:
        size = leaves + len(left)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        held = np.bincount(flat, minlength=size)
        same = np.zeros(size, np.int64)  # equal for nodes that the same items hold
        np.bitwise_xor.at(same, flat, draw[owner])
        order = np.lexsort((flat, same[flat], -held[flat], owner))
        flat, owner = flat[order], owner[order]
        inside = owner[1:] == owner[:-1]
        pair = np.stack([flat[:-1][inside], flat[1:][inside]], 1)
        found, of, count = np.unique(pair, axis=0, return_inverse=True, return_counts=True) if len(pair) else (pair, np.zeros(0, int), np.zeros(0, int))
        if not (count >= 2).any():
            break
        # a node takes part in one pair a round, the more frequent pair first
        taken, chosen = np.zeros(size, bool), np.full(len(found), -1, np.int64)
        levels.append(len(left))
        for p in np.argsort(-count, kind="stable").tolist():
            a, b = found[p].tolist()
            if count[p] >= 2 and not taken[a] and not taken[b]:
                taken[a] = taken[b] = True
                chosen[p] = leaves + len(left)
                left.append(a)
                right.append(b)
        new = np.full(len(flat), -1, np.int64)
        where = np.flatnonzero(inside)
        hit = chosen[of.ravel()]
        new[where[hit >= 0]] = hit[hit >= 0]
        drop = np.zeros(len(flat), bool)
        drop[where[hit >= 0] + 1] = True
        flat = np.where(new >= 0, new, flat)[~drop]
        owner = owner[~drop]
        sets = np.split(flat, np.searchsorted(owner, np.arange(1, len(sets))))
    return Sharing(leaves, np.array(left, np.int64), np.array(right, np.int64), levels, flat, np.searchsorted(owner, np.arange(len(sets) + 1)))


# ------------------------------------------------------------- tasks


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts) of every document with a term: its terms that items use (numbers, packed) and their occurrences."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches):
        words = held.value
        for batch in batches:
            ids, ns, terms, counts = [], [], [], []
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                found = term_counts(text.as_py())
                if found:
                    own = sorted((words[w], found[w]) for w in found.keys() & words.keys())
                    ids.append(i)
                    ns.append(found.total())
                    terms.append(np.array([t for t, _ in own], "<i4").tobytes())
                    counts.append(np.array([c for _, c in own], "<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], ["id", "n", "terms", "counts"])

    return docs.mapInArrow(read, "id long, n long, terms binary, counts binary")


def document_frequencies(posted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term: counted in every task, summed by term; the driver receives one number a term."""

    def count(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            for packed in batch.column("terms"):
                df[np.frombuffer(packed.as_py(), "<i4")] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some), "df": pa.array(df[some])})

    out = np.zeros(size, np.int64)
    got = posted.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    out[got["term"]] = got["df"]
    return out


def best(score: np.ndarray, ids: np.ndarray, k: int, held: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, score, id) of the k best of each item so far: higher scores, then smaller ids."""
    least = np.ones(len(score), np.int64)
    if held is not None:
        n = np.bincount(held[0], minlength=len(score))
        full = n >= k
        low = np.full(len(score), np.iinfo(np.int64).max)
        np.minimum.at(low, held[0], held[1])
        least[full] = low[full]
    item, doc = np.nonzero(score >= least[:, None])
    new = (item, score[item, doc], ids[doc])
    item, value, doc = (np.concatenate(x) for x in zip(held, new, strict=True)) if held is not None else new
    order = np.lexsort((doc, -value, item))
    item, value, doc = item[order], value[order], doc[order]
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return item[place < k], value[place < k], doc[place < k]


def scored(posted: DataFrame, names: list, plan: Sharing, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(query, item_id, doc_id, score): the k best documents of each item in every task."""
    held = posted.sparkSession.sparkContext.broadcast((names, plan, weights))
    none = np.iinfo(np.int64).max  # a null id comes after all others

    def run(batches):
        names, plan, weights = held.value
        step = max(1, _CELLS // (plan.leaves + len(plan.left) + 1))
        top = None
        for batch in batches:
            ids = np.array([none if i is None else i for i in batch.column("id").to_pylist()], np.int64)
            m = np.array([50 + 50 * n * n_docs // n_terms for n in batch.column("n").to_pylist()], np.int64)
            terms, counts = batch.column("terms").to_pylist(), batch.column("counts").to_pylist()
            for a in range(0, len(ids), step):
                part = slice(a, a + step)
                term = [np.frombuffer(x, "<i4") for x in terms[part]]
                doc = np.repeat(np.arange(len(term)), [len(x) for x in term])
                term = np.concatenate(term)
                tf = np.frombuffer(b"".join(counts[part]), "<i8")
                leaf = np.zeros((plan.leaves, len(ids[part])), np.int64)
                leaf[term, doc] = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[part][doc]))
                top = best(plan.accumulate(leaf), ids[part], k, top)
        if top is not None:
            item, value, doc = top
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array([names[i] for i in item.tolist()], pa.int64()), pa.array(doc, mask=doc == none), pa.array(value)], ["query", "item_id", "doc_id", "score"])

    return posted.mapInArrow(run, "query long, item_id long, doc_id long, score long")


# ------------------------------------------------------------- the search


def _item_terms(items: DataFrame) -> DataFrame:
    """(id, terms): the distinct terms of every item that has some."""

    def read(batches):
        for batch in batches:
            got = [(i, sorted(term_counts(t.as_py()))) for i, t in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True)]
            got = [(i, t) for i, t in got if t]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in got], pa.int64()), pa.array([t for _, t in got], pa.list_(pa.binary()))], ["id", "terms"])

    return items.mapInArrow(read, "id long, terms array<binary>")


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The k best documents of each item: (item_id, rank, doc_id, score).

    Ids are integers. Documents and items without a term take no part; a null
    text has none. Equal rows of ``items`` count once, rows with one id and
    different texts are ranked by themselves under that id. Every row of
    ``docs`` is a document, repeated ones too; a null id comes after all others
    of equal score. Texts of any length are read whole, other columns are
    ignored, empty tables give no rows. Items go in blocks by the hash of their
    id, so that a block holds about ``block_terms`` terms; each block reads the
    documents' text once and its postings, written to the shared folder, twice.
    """
    spark = docs.sparkSession
    out_schema = "item_id long, rank int, doc_id long, score long"
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    wanted = written(_item_terms(items.select(F.col(item_col).cast("long").alias("id"), F.col(item_text).alias("text")).distinct()), "lexical-items")
    total = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_terms))
    found = None
    for block in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).orderBy("id").collect()
        if not own:
            continue
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in own for t in r["terms"]}))}
        plan = share([[vocabulary[bytes(t)] for t in r["terms"]] for r in own], len(vocabulary))
        posted = written(postings(texts, vocabulary), "lexical-postings")
        n_docs, n_terms = posted.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        df = document_frequencies(posted, len(vocabulary)).tolist()
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df], np.int64)
        part = scored(posted, [r["id"] for r in own], plan, weights, n_docs, n_terms, k).withColumn("block", F.lit(block))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], out_schema)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # two levels, so that an item's candidates of all tasks do not meet in one
    some = Window.partitionBy("block", "query", "salt").orderBy(*order)
    last = Window.partitionBy("block", "query").orderBy(*order)
    few = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(16))).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    ranked = few.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


#: DuckDB twin of ``search`` over the given tables.
SQL = r"""
WITH tok AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY 1),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, s),
item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM n, s),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM item JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""
