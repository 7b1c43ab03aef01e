"""The registered operator queries at sf0.001, against DuckDB where they have SQL."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF
from tidemark.llm.queries import QUERIES, SQL

COLUMNS = {
    "op1_arc_to_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op2_hnsw_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op3_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_quality": ["doc_id", "held_out", "score", "predicted"],
    "op6_repair_tokens": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_simhash": ["doc_id", "fingerprint", "component_id"],
    "op11_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
    "op12_pieces": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_spans", "span_bytes"],
    "op13_lexical_search": ["item_id", "rank", "doc_id", "score"],
}


def test_all_are_registered():
    assert QUERIES.keys() <= E.queries().keys() and "pipeline" in E.queries()
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == COLUMNS.get(name, df.columns)
    got = sorted(map(str, (tuple(r) for r in df.collect())))
    if name in SQL:
        con = duckdb.connect()
        for t in ("documents", "pages", "benchmark", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        cols = ", ".join(f'"{c}"' for c in df.columns)
        assert got == sorted(map(str, con.execute(f"SELECT {cols} FROM ({SQL[name]})").fetchall()))
    elif name not in ("op2_hnsw_neighbours", "op9_license_scan"):
        assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
