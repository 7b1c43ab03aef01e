"""Re-Pair shards: exact round trips."""

import io
import zlib

import numpy as np
import public_tokenizers
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import repair
from tidemark.llm.bpe_segtree import PLAIN_PATTERN, _char_classes, cuts_plain

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=300), st.integers(1, 3), st.data())
def test_grammar_round_trip(ids, repeat, data):
    x = np.array(ids * repeat, np.uint32)
    seq, rules, length = repair.compress(x, 4, min_count=2, fall=2)
    assert repair.expand(seq, rules, 4).tolist() == x.tolist()
    assert [len(repair.expand(np.array([4 + k], np.uint32), rules, 4)) for k in range(len(rules))] == length.tolist()
    out = io.BytesIO()
    repair.dump(out, [1], [len(x)], x)
    shard = repair.Shard(io.BytesIO(out.getvalue()))
    a = data.draw(st.integers(0, len(x)))
    b = data.draw(st.integers(a, len(x)))
    assert shard.ids(a, b).tolist() == x[a:b].tolist()


def test_repeats_shrink():
    x = np.tile(np.arange(50, dtype=np.uint32), 400)
    seq, rules, _ = repair.compress(x, 50)
    assert len(seq) + 2 * len(rules) < len(x) / 20


def test_no_frequent_pair_is_left():
    rnd = np.random.default_rng(2)
    x = np.arange(100, 8100, dtype=np.uint32)  # symbols that occur once around a few repeated phrases
    for phrase in range(6):
        for at in rnd.choice(len(x), 12, replace=False):
            x = np.insert(x, at, np.arange(phrase * 8, phrase * 8 + 8))
    seq, rules, _ = repair.compress(x, 8100)
    assert repair.expand(seq, rules, 8100).tolist() == x.tolist()
    _, count = np.unique(np.stack([seq[:-1], seq[1:]]), axis=1, return_counts=True)
    assert count.max() < 8


def test_shards_match_the_library(spark):
    tok = Tokenizer.from_file(PATH)
    rows = [(i, f"text number {i}, don't mind " + "la " * (i % 7)) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x y\n" * 4000), (103, "a <|endoftext|> b"), (60, "twice"), (60, "twice"), (-5, "Grüße 漢字 \x1c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as part", "2 as start", "'u' as uri")
    manifest = repair.write_shards(df, PATH, end_id=2, shard_ids=500)
    assert manifest.count() >= 3
    got = [tuple(r) for r in repair.read_documents(manifest).orderBy("start").collect()]
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, "b"), (3, "c"), (None, "a")], "doc_id long, text string")
    got = repair.read_documents(repair.write_shards(df, PATH, end_id=2)).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(None, 0, 2), (None, 2, 2), (3, 4, 2)]
    empty = repair.write_shards(df.where("false"), PATH, end_id=2)
    assert empty.count() == 0 and repair.read_documents(empty).count() == 0


def test_encoder_is_loaded_once_in_a_worker():
    assert repair.encoder(PATH) is repair.encoder(PATH)


def test_ranges_of_long_expansions():
    x = np.concatenate((np.tile(np.arange(90, dtype=np.uint32), 300), np.arange(200, 260, dtype=np.uint32), np.full(5000, 7, np.uint32)))
    out = io.BytesIO()
    repair.dump(out, [1], [len(x)], x)
    shard = repair.Shard(io.BytesIO(out.getvalue()))
    assert shard.length.max() > shard.SHORT and len(shard.table) < shard.first + shard.SHORT * len(shard.rules) + 1
    for a, b in ((0, len(x)), (3, 4), (89, 12_345), (26_990, 27_080), (len(x) - 1, len(x)), (5, 5)):
        assert shard.ids(a, b).tolist() == x[a:b].tolist()


def _words(count):
    rnd = np.random.default_rng(5)
    return ["".join(chr(97 + c) for c in rnd.integers(0, 26, rnd.integers(2, 40))) for _ in range(count)]


def test_rounds_sort_only_places_that_may_be_frequent(monkeypatch):
    rnd = np.random.default_rng(3)
    phrases = rnd.integers(0, 5000, (300, 12))
    x = np.concatenate([phrases[i] if i < 300 else rnd.integers(0, 5000, 12) for i in rnd.integers(0, 600, 5000)]).astype(np.uint32)
    sorted_, plain = [], np.sort
    monkeypatch.setattr(repair.np, "sort", lambda a, *k, **kw: sorted_.append(len(a)) or plain(a, *k, **kw))
    seq, rules, _ = repair.compress(x, 5000)
    assert repair.expand(seq, rules, 5000).tolist() == x.tolist()
    assert len(sorted_) > 6 and sum(sorted_) < 3 * len(x)


def test_symbols_beyond_sixteen_bits():
    x = np.tile(np.arange(65_500, 65_560, dtype=np.uint32), 40)
    for first in (65_560, 65_530):  # rules cross the limit, ids do
        y = x if first > 65_559 else x - 30
        seq, rules, _ = repair.compress(y, first)
        assert repair.expand(seq, rules, first).tolist() == y.tolist() and len(seq) < 100


PARTS = ["'", "'s", "'re", "'ll", "'ve", "'d", "s", "l", " ", "  ", "\n", "a", "漢字", "1", "!", "\t", "é", "rex", "😀", "\x1c", " Heinges", "x" * 30, "b c", "<|endoftext|>"]
TEXTS = st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_cuts_match_the_pattern(texts):
    joined = "".join(texts)
    cut = cuts_plain(np.frombuffer(joined.encode("utf-32-le"), np.uint32), _classes, np.cumsum([len(t) for t in texts])).tolist()
    assert [joined[a:b] for a, b in zip(cut, [*cut, len(joined)][1:], strict=True)] == [p for t in texts for p in regex.findall(PLAIN_PATTERN, t)]


_classes = _char_classes()


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_encoder_matches_the_library(texts):
    enc = repair.encoder(PATH)
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for run_chars in (1, 7, 1 << 20):  # long texts are encoded in parts
        assert [x.tolist() for x in enc.encode(texts, run_chars)] == want


def test_encoder_forgets_and_learns_again():
    enc = repair.LibraryEncoder(PATH, memory=50)
    words = _words(400)
    for a in range(0, 400, 40):
        texts = [" ".join(words[a : a + 20]), "\n".join(words[a : a + 40]), "", words[a]]
        assert [x.tolist() for x in enc.encode(texts)] == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert enc.held.rows <= 120


def test_new_pre_tokens_go_to_the_library_together(monkeypatch):
    enc = repair.LibraryEncoder(PATH)
    words = _words(5000)
    asked, library = [], enc._library
    monkeypatch.setattr(enc, "_library", lambda texts: asked.extend(texts) or library(texts))
    got = enc.encode([" ".join(words), " ".join(words[::-1])])
    assert len(asked) < 50 and sum(map(len, asked)) < 1.2 * len(" ".join(words))
    assert got[0].tolist() == enc.tokenizer.encode(" ".join(words), add_special_tokens=False).ids


def test_files_share_reading_tasks(spark):
    df = spark.range(400).selectExpr("id as doc_id", "repeat(concat('word ', id), 5) as text")
    manifest = repair.write_shards(df, PATH, end_id=2, shard_ids=100)
    files = manifest.count()
    assert files > 20 and repair.read_documents(manifest).rdd.getNumPartitions() <= files // 2
