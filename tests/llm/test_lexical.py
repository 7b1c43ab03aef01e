"""Ranked lexical search: the sharing DAG against plain sums, the search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import lexical
from tidemark.llm.common import ready

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("abAB ñÑ-_09\x1c\x85")), max_size=60))
def test_terms(text):
    assert {k.decode(): v for k, v in lexical.term_counts(text).items()} == Counter(TERM.findall(text.translate(_LOWER)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), max_size=15).map(sorted), max_size=9))
def test_shared_nodes_give_the_plain_sums(items):
    plan = lexical.share(items, 15)
    leaf = np.random.default_rng(1).integers(0, 1000, (15, 6))
    assert plan.accumulate(leaf).tolist() == [leaf[x].sum(0).tolist() for x in items]


def test_common_sets_are_added_up_once():
    common = list(range(40))
    plan = lexical.share([[*common, 50 + i] for i in range(30)], 100)
    # 39 sums for the common terms; an item is that node and its own term
    assert len(plan.left) == 39 and set(np.diff(plan.starts).tolist()) == {2}


def _brute(docs, items, k):
    counts = [(i, Counter(TERM.findall((t or "").translate(_LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        terms = set(TERM.findall(text.translate(_LOWER)))
        found = []
        for i, c in counts:
            m = 100 - 50 + (50 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                found.append((-score, math.inf if i is None else i, i))
        out += [(item, r + 1, x[2], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:2])[:k])]
    return sorted(out, key=str)


def _frames(spark, docs, items):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, id string, n int")
    return d, spark.createDataFrame([(*r, 7) for r in items], "item_id long, text string, score int")


def _run(spark, docs, items, k=5, **more):
    got = lexical.search(*_frames(spark, docs, items), k=k, **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def _data(seed=4):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["The", "the", "Ñu", "ñu", "x-y"]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    docs = [(i, text(rnd.choice([1, 5, 60]))) for i in range(90)]
    docs += [(1000 + i, "the the w1 w2") for i in range(60)]  # copies tie
    docs += docs[:10] + [(None, "w1 w3"), (None, None), (500, ""), (501, "-- ?"), (502, "w5 " * 50_000 + "w6")]
    items = [(i, text(rnd.choice([1, 4, 12]))) for i in range(25)]
    items += items[:3] + [(1, "w1 w9"), (None, "w2"), (60, None), (61, ""), (62, "absent")]
    return docs, items


def test_search_against_brute_force(spark):
    ready(spark)
    docs, items = _data()
    want = _brute(docs, items, 5)
    assert _run(spark, docs, items) == want
    assert _run(spark, docs, items, block_terms=20) == want  # many blocks


def test_small_blocks_of_documents_keep_the_best(spark, monkeypatch):
    docs, items = _data(9)
    frame, wanted = _frames(spark, docs, items)
    score = np.random.default_rng(2).integers(0, 4, (7, 200))
    held = None
    for a in range(0, 200, 11):
        held = lexical.best(score[:, a : a + 11], np.arange(a, min(a + 11, 200)), 6, held)
    want = [(i, int(s), d) for i in range(7) for s, d in sorted(((s, d) for d, s in enumerate(score[i]) if s > 0), key=lambda x: (-x[0], x[1]))[:6]]
    assert list(zip(*(x.tolist() for x in held), strict=True)) == want


def test_empty_tables(spark):
    ready(spark)
    assert _run(spark, [], [(1, "a")]) == [] and _run(spark, [(1, "a")], []) == [] and _run(spark, [(1, "b")], [(1, "a")]) == []
