"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by size (number of distinct word shingles, powers
of two). Each item is sketched by its smallest shingle hashes, as many as its
partition needs: a document that contains at least ``threshold`` of an item
with n shingles misses at most ``floor((1 - threshold) * n)`` of them, so of
one more MinHash values than that for the partition's largest n at least one is in the
document. Documents that hold a sketch value are candidates; exact shingle
containment decides. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, own_names

#: A sketch table of at most this many rows (of 20 bytes) is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(w: Column, size: int) -> Column:
    """Space-joined runs of ``size`` words, repeats included; the whole sequence where there are fewer words."""
    many = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.concat_ws(" ", F.slice(w, i, size)))
    return F.when(F.size(w) >= size, many).when(F.size(w) > 0, F.array(F.concat_ws(" ", w))).otherwise(F.array().cast("array<string>"))


def _worded(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, w): the id, a hash of the text and its words (null for a null text)."""
    return rows.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), words(F.col(text_col)).alias("w"))


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(h, item, n): the MinHash values of each item; ``items`` has (item, s = distinct shingles, n)."""
    part = F.floor(F.log2(F.col("n"))).cast("int")
    most = F.pow(F.lit(2), part + 1) - 1  # largest size of the partition
    keep = F.floor((1 - F.lit(threshold)) * most + F.lit(1e-9)).cast("int") + 1
    hashes = F.array_sort(F.array_distinct(F.transform("s", lambda x: F.xxhash64(x))))
    return items.select("item", "n", F.explode(F.slice(hashes, F.lit(1), keep)).alias("h"))


def contained_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", size: int = 5, threshold: float = 0.8,
) -> DataFrame:
    """Pairs of a document and an item of which it contains at least ``threshold``.

    Returns (doc, th, item, shared, n, containment): the document's id and
    text hash, the item's id, the number of the item's distinct shingles that
    the document holds, their total and the ratio. Null texts and texts
    without words take no part; texts of fewer than ``size`` words are one
    shingle, which only an equal sequence contains. Null ids are carried.
    Repeated rows (equal id and text) give one pair; of item rows that share an
    id each text is compared. Empty tables give an empty result; other columns
    are ignored. A common item is a hot key of neither join: candidates are
    aggregated by (document, item) with partial sums.
    """
    items = _worded(benchmark, item_col, item_text_col).where(F.size("w") > 0).select(F.col("id").alias("item_id"), F.col("th").alias("item_th"), F.array_distinct(shingles(F.col("w"), size)).alias("s"))
    items = checkpoint(items.dropDuplicates(["item_id", "item_th"]).withColumn("n", F.size("s")).withColumn("item", F.struct("item_id", "item_th")))
    sketch = sketches(items, threshold)
    docs_w = _worded(docs, id_col, text_col)
    held = docs_w.select("id", "th", F.greatest(F.size("w") - (size - 1), F.lit(1)).alias("m"), F.explode(F.transform(shingles(F.col("w"), size), lambda s: F.xxhash64(s))).alias("h"))
    if sketch.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        sketch = F.broadcast(sketch)
    # a document of m shingles cannot contain a share of an item with more than m / threshold
    near = held.join(sketch, "h").where(F.col("m") >= threshold * F.col("n") - 1e-9)
    candidates = near.select(F.col("id").alias("c_id"), F.col("th").alias("c_th"), "item").distinct()
    # documents meet their candidates as plain text; shingles are made after the shuffle, for candidates only
    text = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    found = candidates.join(text, F.col("c_id").eqNullSafe(F.col("id")) & (F.col("c_th") == F.col("th"))).join(items.select("item", "s", "n"), "item")
    cut = found.withColumn("w", words(F.col("text"))).select("id", "th", "item", "s", "n", shingles(F.col("w"), size).alias("ds"))
    # the checkpoint keeps the threshold from being pushed below the words, where they would be split again for every shingle
    pairs = checkpoint(cut.select(F.col("id").alias("doc"), "th", "item", F.size(F.array_intersect("s", "ds")).alias("shared"), "n"))
    return pairs.withColumn("containment", F.col("shared") / F.col("n")).where(F.col("containment") >= threshold)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", **kw) -> DataFrame:
    """(id_col, item_col, shared, n_shingles, containment), one row per pair of ids (the highest containment)."""
    pairs = contained_items(docs, benchmark, id_col=id_col, item_col=item_col, **kw)
    best = pairs.groupBy(F.col("doc").alias(id_col), F.col("item.item_id").alias(item_col)).agg(F.max(F.struct("containment", "shared", "n")).alias("k"))
    return best.select(id_col, item_col, F.col("k.shared").cast("long").alias("shared"), F.col("k.n").cast("long").alias("n_shingles"), F.col("k.containment").alias("containment"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Documents that contain no item; all columns stay."""
    doc, th = own_names(docs, "__doc", "__th")
    hit = contained_items(docs, benchmark, id_col=id_col, text_col=text_col, **kw).select(F.col("doc").alias(doc), F.col("th").alias(th)).distinct()
    return docs.join(hit, docs[id_col].eqNullSafe(hit[doc]) & (F.xxhash64(docs[text_col]) == hit[th]), "left_anti")


SQL = r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
d AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM dw),
i AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM iw),
n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY 1),
m AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN i USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, shared, n_shingles, shared / n_shingles::DOUBLE AS containment
FROM m JOIN n USING (item_id) WHERE shared / n_shingles::DOUBLE >= 0.8
"""
