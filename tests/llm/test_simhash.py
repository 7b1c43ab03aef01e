"""SimHash groups against brute force."""

import random

import numpy as np
import pytest

from tidemark.llm import graph, simhash


def _labels(prints, ids, bits=2):
    u = sorted(set(prints))
    up = list(range(len(u)))

    def find(a):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    for i in range(len(u)):
        for j in range(i):
            if (u[i] ^ u[j]).bit_count() <= bits:
                up[find(i)] = find(j)
    root = {p: find(i) for i, p in enumerate(u)}
    low = {}
    for p, d in zip(prints, ids):
        low[root[p]] = min(low.get(root[p], d), d)
    return [low[root[p]] for p in prints]


def test_documents_match_brute_force(spark):
    rnd = random.Random(6)
    texts = []
    for _ in range(60):
        w = ["".join(rnd.choice("abcdeÉZ") for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(1, 300))]
        texts.append(" ".join(w))
        for _ in range(rnd.randint(0, 4)):
            w = list(w)
            w[rnd.randrange(len(w))] = "new"
            texts.append("\t".join(w).upper() if rnd.random() < 0.3 else "  ".join(w))
    texts += [None, "", " \n", "one", "one two", "a b c", texts[0], texts[0], "x " * 150_000]
    rows = list(enumerate(texts))
    prints = [simhash.fingerprint_of(t) for t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as part", "3 as node").repartition(4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    want = _labels(prints, range(len(rows)))
    assert [got[i] for i in range(len(rows))] == [(f"{p:016x}", c) for p, c in zip(prints, want)]
    assert prints[-9:-6] == [0, 0, 0]
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


def test_fingerprint_bits_by_definition():
    import xxhash

    text = "The  quick brown\tfox JUMPS é"
    w = ["the", "quick", "brown", "fox", "jumps", "é"]
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(4)]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > 4)
    assert simhash.fingerprint_of(text) == want


@pytest.mark.parametrize(("bits", "hot"), [(2, 256), (2, 3), (3, 4), (1, 2), (4, 2), (0, 1)])
def test_links_match_brute_force(spark, bits, hot):
    rnd = random.Random(bits * 10 + hot)
    prints = set()
    for _ in range(12):
        p = rnd.getrandbits(64)
        prints.add(p)
        for _ in range(14):
            prints.add(p ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))))
    u = sorted(prints)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    want = {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(u) for b in u[:i] if (a ^ b).bit_count() <= bits}
    df = spark.createDataFrame([(signed(p),) for p in u], "fp long")
    got = [(r.a, r.b) for r in simhash.link_fingerprints(df, bits, hot).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_repeated_and_null_ids(spark):
    a, b = "some words of a first text here", "quite another line of things to say now"
    rows = [(4, a), (4, a), (2, a), (None, a), (None, b), (None, b), (9, "third thing all alone in here"), (9, "and a fourth one under an id of old")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(df).collect())
    assert got == sorted([("4", "2"), ("4", "2"), ("2", "2"), ("None", "2"), ("None", "None"), ("None", "None"), ("9", "9"), ("9", "9")])
    assert sorted((str(r.doc_id), r.text) for r in simhash.keep_one(df).collect()) == sorted([("2", a), ("None", b), ("9", rows[6][1]), ("9", rows[7][1])])
    assert simhash.near_duplicates(df.where("false")).count() == 0
    assert simhash.keep_one(df.where("false")).count() == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(120)] + [(5000, 5000), (7, 9), (7, 9)]
    up = {}

    def find(a):
        up.setdefault(a, a)
        while up[a] != a:
            a = up[a]
        return a

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {a: find(a) for a in up}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
