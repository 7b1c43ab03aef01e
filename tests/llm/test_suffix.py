"""Deep-shallow sorting and repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import suffix_dedup


def _lcp(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(max_size=40).map(lambda b: bytes(x % 2 for x in b))), max_size=40), st.sampled_from([8, 16]))
def test_deep_shallow_sorts_with_common_prefixes(rows, shallow):
    strings, group = [s for _, s in rows], np.array([g for g, _ in rows], np.int64)
    order, shared = suffix_dedup.deep_shallow(strings, group, shallow)
    got = [(int(group[i]), strings[i]) for i in order]
    assert got == sorted(rows)
    assert sorted(order.tolist()) == list(range(len(rows)))
    for k, n in enumerate(shared.tolist()):
        new = k == 0 or got[k][0] != got[k - 1][0]
        assert n == (-1 if new else _lcp(got[k][1], got[k - 1][1]))


def test_settled_strings_leave_the_sort(monkeypatch):
    strings = [bytes([i]) * 32 for i in range(100)] + [b"same first digit " + bytes([i]) * 15 for i in range(10)]
    sizes, sort = [], np.lexsort
    monkeypatch.setattr(suffix_dedup.np, "lexsort", lambda keys: (sizes.append((len(keys), len(keys[0]))), sort(keys))[1])
    order, _ = suffix_dedup.deep_shallow(strings, np.zeros(110, np.int64))
    assert [strings[i] for i in order] == sorted(strings)
    assert sizes == [(2, 110), (2, 10), (2, 10)]


def _brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def _texts(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 9)))
    shared = [" ".join(word() for _ in range(rnd.randint(4, 30))) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rnd.randint(0, 25)))]
        for _ in range(rnd.randint(0, 2)):
            parts += [rnd.choice(shared)[rnd.randint(0, 10) :], " ".join(word() for _ in range(rnd.randint(0, 10)))]
        texts.append(" ".join(parts))
    texts += [texts[3], texts[3], texts[5][:-1] + "!", "ab" * 200, "z" * 150, "ab" * 30, "", None, "short"]
    return texts


@pytest.mark.parametrize(("seed", "length", "gram", "hot"), [(1, 20, 8, 100_000), (2, 33, 11, 100_000), (3, 20, 8, 2), (4, 64, 64, 100_000), (5, 16, 5, 30)])
def test_removals_match_brute_force(spark, seed, length, gram, hot):
    texts = _texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_digests(df, length, gram=gram, hot=hot).collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts, length)


def test_repeated_rows_null_ids_and_extra_columns(spark):
    a, b = "once upon a time there was " * 3, "something else altogether, really"
    rows = [(1, a), (1, a), (None, b), (2, "x" + b), (None, None), (7, b[:10])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as spans", "2 as doc", "3 as th", "4 as id")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.removal_digests(df, 20, gram=8).collect())
    want = sorted((str(i), *x[:3]) for (i, _), x in zip(rows, _brute([t for _, t in rows], 20)))
    assert got == want
    kept = suffix_dedup.remove_repeats(df, 20, gram=8)
    assert kept.columns == df.columns and kept.count() == 6
    assert {r.text for r in kept.collect()} == {"", "x", None, b[:10]}
    assert suffix_dedup.removal_digests(df.where("false"), 20).count() == 0


def test_a_common_passage_is_not_sorted_as_one_group(spark, monkeypatch):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    passage = " ".join(word() for _ in range(20))
    texts = [" ".join([*(word() for _ in range(6)), *([passage] if i % 3 == 0 else []), *(word() for _ in range(6))]) for i in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    sorted_ = []
    sort = type(df).sortWithinPartitions
    monkeypatch.setattr(type(df), "sortWithinPartitions", lambda self, *a, **b: (sorted_.append(self), sort(self, *a, **b))[1])
    hot = 50
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_digests(df, 30, gram=10, hot=hot).collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts, 30)
    # occurrences that meet under one key of the sort
    most = [f.selectExpr("key", "aggregate(members, 0L, (n, m) -> n + octet_length(m.starts) div 8) as n").groupBy("key").agg({"n": "sum"}).agg({"sum(n)": "max"}).first()[0] for f in sorted_]
    assert sorted_ and all((m or 0) <= hot for m in most)


def test_long_text_in_pieces():
    rnd = random.Random(8)
    data = bytes(rnd.choice(b"abcd ") for _ in range(9000))
    whole = suffix_dedup.anchors(data, 50, 16)
    cut = suffix_dedup.anchors(data, 50, 16, piece=700)
    # pieces may part an anchor's windows, but each window keeps its anchor
    spread = lambda x: [p for _, p, a, b in zip(*(c.tolist() for c in x)) for _ in range(a, b + 1)]
    assert spread(whole) == spread(cut)


def test_many_equal_rows_tell_their_spans_once(spark, monkeypatch):
    rnd = random.Random(12)
    text = " ".join("".join(rnd.choice("abcdef") for _ in range(5)) for _ in range(60))
    rows = [(None, text)] * 150 + [(4, text)] * 50 + [(5, "other " + text[:40])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spans = suffix_dedup.repeated_spans(suffix_dedup._keyed(df, "doc_id", "text"), "text", 30, gram=10).collect()
    assert max(len(r.spans) for r in spans) <= len(text)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffix_dedup.removal_digests(df, 30, gram=10).collect())
    assert got == sorted((str(i), *x[:2]) for (i, _), x in zip(rows, _brute([t for _, t in rows], 30), strict=True))
