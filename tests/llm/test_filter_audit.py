"""Filter interaction audit: list merges against sets, the whole audit against brute force."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import filter_audit as fa
from tidemark.llm.common import ready

_lists = st.lists(st.lists(st.integers(0, 6000), max_size=300).map(lambda x: np.unique(np.array(x, np.int64))), max_size=5)


@settings(max_examples=200, deadline=None)
@given(_lists)
def test_merge_is_the_union(lists):
    assert fa.merged(lists).tolist() == sorted(set().union(*[x.tolist() for x in lists]))


@settings(max_examples=200, deadline=None)
@given(_lists.filter(lambda x: len(x) > 1))
def test_difference(lists):
    a, b = lists[:2]
    assert a[fa.without(a, b)].tolist() == sorted(set(a.tolist()) - set(b.tolist()))


def test_long_runs_and_dense_lists():
    a, b, c = np.arange(0, 50_000), np.arange(20_000, 90_000, 3), np.arange(200_000, 260_000)
    assert fa.merged([a, b, c]).tolist() == sorted(set(a.tolist()) | set(b.tolist()) | set(c.tolist()))
    assert a[fa.without(a, b)].tolist() == sorted(set(a.tolist()) - set(b.tolist()))
    assert c[fa.without(c, a)].tolist() == c.tolist()
    assert [fa.gallop(b, x, 5) for x in (0, 20_014, 20_015, 89_999, 10**9)] == [5, 5, 5, len(b) - 1, len(b)]


def _brute(docs, labels):
    seen = {}
    for i, t, _ in docs:
        if i is not None:
            seen[t or ""] = min(i, seen.get(t or "", i))
    rows = []
    for i, t, part in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and seen[t] < i,
        }
        own = [x for x in labels if i is not None and x[0] == i]
        rows.append((part or "", fails, any(q == 1 for _, q, _ in own), any(x == 1 for _, _, x in own)))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        got = {}
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                hit = [r for r in left if r[1][f]]
                failing = sum(r[1][f] for r in mine)
                left = [r for r in left if not r[1][f]]
                shapley[f] += len(hit)
                only = sum(r[1][f] and sum(r[1].values()) == 1 for r in mine)
                got["".join(order), k + 1] = [f, len(left), len(hit), failing - len(hit), only, sum(r[2] for r in hit), sum(r[3] for r in hit)]
        out |= {(part, o, k): tuple([*v[1:], shapley[v[0]]]) for (o, k), v in got.items()}
    return out


def _frames(spark, docs, labels):
    d = spark.createDataFrame([(i, t, p, "x", True) for i, t, p in docs], "doc_id long, text string, source string, digest string, again boolean")
    return d, spark.createDataFrame([(*x, "y") for x in labels], "doc_id long, quality int, toxic int, id string")


def _check(spark, docs, labels):
    got = fa.audit(*_frames(spark, docs, labels)).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in got} == _brute(docs, labels)
    assert len(got) == 600 * len({p or "" for _, _, p in docs})


def test_audit_against_brute_force(spark):
    ready(spark)
    rnd = random.Random(3)
    words = ["a", "b", "Cd", "e#", "ñ", "f\x0bg", "h i", "$"]
    texts = ["", None, "x " * 80, "A" * 30] + [" ".join(rnd.choice(words) + (str(rnd.randrange(99)) if rnd.random() < 0.6 else "") for _ in range(rnd.choice([3, 49, 50, 51, 120]))) for _ in range(40)]
    docs = [(rnd.choice([None, *range(60)]), rnd.choice(texts), rnd.choice(["s", "s", "s", "t", "", None])) for _ in range(200)]
    docs += docs[:20]  # repeated rows
    docs.append((1000, " ".join(f"w{i}" for i in range(60_000)), "long"))
    labels = [(rnd.choice([None, *range(70)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(120)]
    _check(spark, docs, labels)


def test_hot_part_is_cut_into_ranges(spark, monkeypatch):
    ready(spark)
    docs = [(i, "same text # A", "hot") for i in range(300)] + [(i, f"word {i}", "p") for i in range(300, 310)]
    d, lab = _frames(spark, docs, [(5, 1, 1)])
    bits = d.selectExpr("source AS part", "doc_id AS id", "doc_id % 32 AS mask", "0L AS good", "0L AS toxic")
    whole = sorted(map(tuple, fa.sizes(bits, 5).collect()))
    assert whole == sorted(map(tuple, fa.sizes(bits, 5, range_ids=7).collect()))
    _check(spark, docs, [(5, 1, 1)])


def test_empty_tables(spark):
    ready(spark)
    d, lab = _frames(spark, [], [])
    assert fa.audit(d, lab).collect() == []
    _check(spark, [(1, "x", "p")], [])


@pytest.mark.parametrize("size", [1, 10, 1000])
def test_words_of_long_texts_are_cut_at_white_space(size):
    from tidemark.llm.common import word_lists

    data = b"ab  c\tdef\n" * 37 + b"g" * 50
    assert [w for part in word_lists(data, size) for w in part] == data.split()
