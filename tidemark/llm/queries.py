"""Registered queries of the training-data operators over the given tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arcwarc, bpe_segtree, decontam, filter_audit, hnsw, langid, lexical, license, nbsvm, piece_encode, repair, simhash, suffix_dedup
from .common import ready, table


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arcwarc.round_trip(table(spark, sf_dir, "pages")).drop("target_uri")


OP1_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS lowest FROM p GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> lowest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> lowest THEN lowest END AS refers_to
FROM p JOIN f USING (payload_digest)
"""


def op2_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors, k=20)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe_segtree.encode_documents(table(spark, sf_dir, "documents"), path, pattern)
    return coded.select("doc_id", bpe_segtree.digests(F.col("ids"), path, pattern).alias("d")).select("doc_id", "d.*")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = repair.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return repair.read_documents(shards)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"), length=200)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_licenses(table(spark, sf_dir, "documents"), near=False)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=2)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encode.document_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def _ready(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ready(spark), sf_dir)

    return run


QUERIES = {f.__name__: _ready(f) for f in (
    op1_arc_to_warc, op2_hnsw_neighbours, op3_language_id, op4_byte_bpe, op5_quality,
    op6_repair_tokens, op7_suffix_dedup, op8_decontaminate, op9_license_scan, op10_simhash,
    op11_filter_audit, op12_pieces, op13_lexical_search,
)}
SQL = {"op1_arc_to_warc": OP1_SQL, "op8_decontaminate": decontam.SQL, "op11_filter_audit": filter_audit.SQL, "op13_lexical_search": lexical.SQL}
