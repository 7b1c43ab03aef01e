"""The stages on a small table, each against its operator's brute force."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from conftest import SF
from tidemark.llm import bpe_segtree, simhash


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF).cache()
        assert out.columns == docs.columns and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType, name
        counts.append(out.count())
        now = out
    assert counts[1] <= counts[0] and counts[2] < counts[1] and counts[3] == counts[2] and counts[4] < counts[3]
    prints = {simhash.fingerprint_of(r.text) for r in docs.collect()}
    assert counts[2] <= len(prints)
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    last = {r.doc_id: r for r in now.collect()}
    assert rows.keys() == last.keys()
    assert all(last[i].n_chars == len(last[i].text) for i in last)
    ranks = bpe_segtree.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, r in rows.items():
        ids = library.encode_ordinary(last[i].text)
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(last[i].text.encode()).hexdigest()


def test_odd_rows_pass(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    rows = [(1, None, None, None, None, 1), (2, "", "en", "s", 0, 2), (None, "the quick brown fox and the dog", "en", "s", 31, 3), (3, "the quick brown fox and the dog runs", "en", None, 36, 4)]
    docs = spark.createDataFrame(rows, schema)
    for table in (docs, docs.where("false")):
        now = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, now, SF).count() == (2 if table is docs else 0)


def test_clashing_names_repeated_rows_and_a_long_text_pass(spark):
    long = " ".join(f"w{i} the fox" for i in range(60_000))
    twice = "an old brown dog slept near the warm fire all night long"
    made = ["__told", "__doc", "__th", "__part", "__n", "row", "spans", "doc", "th", "part", "k", "item", "id"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in made)
    plain = "a plain tale of ships and of the sea"
    # the long text is a language of its own: by share of n-grams it would leave the others of its language unknown
    rows = [(i, text, "xx" if text == long else "en", "s", len(text), *range(len(made))) for i, text in [(1, twice), (1, twice), (2, twice), (3, long), (None, twice), (4, plain), (4, plain)]]
    now = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == spark.createDataFrame([], schema).columns, name
    kept = now.collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 4]
    assert all(tuple(r[c] for c in made) == tuple(range(len(made))) for r in kept)
    assert {r.doc_id: r.n_tokens > 0 for r in corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()} == {1: True, 3: True, 4: True}
