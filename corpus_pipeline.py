"""A corpus pipeline over ``documents``: language ID, near-duplicates, repeated strings, benchmark items, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), reads
all that the stage before kept, and returns a DataFrame. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_segtree, decontam, langid, simhash, suffix_dedup
from tidemark.llm.common import ready, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is identified (not ``und``, and enough of the n-grams are of that language)."""
    ready(spark)
    return langid.keep_identified(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each SimHash component (three-word shingles, two bits)."""
    ready(spark)
    return simhash.keep_one(docs, words=3, max_bits=2)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove bytes of 200-byte strings that occur more than once; ``n_chars`` follows the text."""
    ready(spark)
    out = suffix_dedup.remove_repeats(docs, length=200)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain at least 0.8 of a benchmark item's five-word shingles."""
    ready(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document (packed little-endian unsigned 32-bit) with the digests of ids and decoded bytes."""
    ready(spark)
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = docs.select("doc_id", "lang", "source", bpe_segtree.encode(F.col("text"), path, pattern).alias("ids"))
    return coded.withColumn("d", bpe_segtree.digests(F.col("ids"), path, pattern)).select("doc_id", "lang", "source", "d.*", "ids")


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", repeated_strings),
    ("decontamination", benchmark_items),
    ("byte_bpe", tokens),
]

#: Hashes of word shingles, learned language filters and BPE merges have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
