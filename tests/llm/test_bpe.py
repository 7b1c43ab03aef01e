"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import bpe_segtree

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    return bpe_segtree.ByteBPE(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def _ids(bpe, text):
    return np.frombuffer(bpe.encode_packed(text), "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("abest '\n\t 12é漢\x1c\x85")), max_size=80))
def test_same_ids_as_the_library(bpe, library, text):
    assert _ids(bpe, text) == library.encode_ordinary(text)
    assert bpe.decode_packed(bpe.encode_packed(text)) == text.encode()
    assert bpe.split(text) == bpe.pattern.findall(text)


def test_long_pieces_and_runs(bpe, library):
    rnd = random.Random(4)
    for text in ["a" * 5000, "".join(rnd.choice("abcdeé") for _ in range(4000)), " " * 300 + "x", "\n" * 70, "ab" * 31 + " " + "z" * 64 + " " + "q" * 65]:
        assert _ids(bpe, text) == library.encode_ordinary(text)


def test_tree_and_rows_of_trees_agree(bpe):
    rnd = random.Random(9)
    pieces = ["".join(rnd.choice("aeinorst lé") for _ in range(rnd.randint(1, 40))).encode()[:40] for _ in range(400)]
    alone = [np.array(bpe_segtree.merge_piece(p, bpe.ranks), "<u4").tobytes() for p in pieces]
    many = bpe_segtree.merge_pieces(pieces, 64, bpe.table, bpe.byte_ids)
    whole = [bpe.ranks.get(p) for p in pieces]
    assert [a for a, w in zip(alone, whole) if w is None] == [b for b, w in zip(many, whole) if w is None]


def test_small_memory_gives_the_same(library):
    small = bpe_segtree.ByteBPE(PATH, public_tokenizers.PATTERN, memory=5)
    texts = ["some words that are not held", None, "", "some other words", "words 12 some"] * 3
    got = [np.frombuffer(p, "<u4").tolist() for p in small.encode_many(texts, run_chars=30)]
    assert got == [library.encode_ordinary(t or "") for t in texts]


def test_documents(spark, library):
    rows = [(1, "Ça va? it's"), (2, None), (3, ""), (3, ""), (None, "x " * 3000), (4, "<|endoftext|>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_tokens")
    coded = bpe_segtree.encode_documents(df, PATH, public_tokenizers.PATTERN)
    got = coded.select("doc_id", "ids", bpe_segtree.digests(F.col("ids"), PATH, public_tokenizers.PATTERN).alias("d"), bpe_segtree.decode(F.col("ids"), PATH, public_tokenizers.PATTERN).alias("back")).collect()
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        raw = np.array(ids, "<u4").tobytes()
        want.append((str(i), raw, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), (t or "").encode()))
    assert sorted((str(r.doc_id), bytes(r.ids), *r.d, bytes(r.back)) for r in got) == sorted(want)
    assert bpe_segtree.encode_documents(df.where("false"), PATH, public_tokenizers.PATTERN).count() == 0
