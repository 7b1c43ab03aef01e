"""Containment search against brute force."""

import random
import re

from tidemark.llm import decontam


def _words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def _shingles(t, n=5):
    w = _words(t)
    return {" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def _brute(docs, items, threshold=0.8):
    out = {}
    for d, t in docs:
        have = _shingles(t)
        for i, u in items:
            want = _shingles(u)
            if want and len(want & have) / len(want) >= threshold:
                key = (str(d), str(i))
                out[key] = max(out.get(key, (0.0, 0, 0)), (len(want & have) / len(want), len(want & have), len(want)))
    return out


def _data(seed):
    rnd = random.Random(seed)
    text = lambda n: " ".join("".join(rnd.choice("abcdé") for _ in range(rnd.randint(2, 5))) for _ in range(n))
    items = [(i, text(rnd.randint(1, 60))) for i in range(25)] + [(30, None), (31, "!!"), (3, text(12)), (4, "same item"), (4, "same item")]
    docs = []
    for d in range(60):
        parts = [text(rnd.randint(0, 120))]
        for _ in range(rnd.randint(0, 2)):
            w = (rnd.choice(items)[1] or "").split()
            for _ in range(rnd.randint(0, 3)):
                if w:
                    w[rnd.randrange(len(w))] = "changed"
            parts += [" ".join(w).upper(), text(rnd.randint(0, 30))]
        docs.append((d, "\n".join(parts)))
    docs += [(100, None), (101, ""), (102, items[0][1]), (102, items[1][1]), (102, items[1][1]), (None, items[5][1]), (103, "same, item"), (104, text(20_000) + " " + items[7][1])]
    return docs, items


def test_pairs_match_brute_force(spark):
    for seed in (1, 2):
        docs, items = _data(seed)
        d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as h", "2 as item", "3 as w", "4 as n")
        b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "5 as id", "6 as s")
        got = {(str(r.doc_id), str(r.item_id)): (r.containment, r.shared, r.n_shingles) for r in decontam.contaminated(d, b).collect()}
        want = _brute(docs, items)
        assert got == want and len(want) > 10
        kept = decontam.drop_contaminated(d, b)
        assert kept.columns == d.columns
        hit = {(str(i), t) for i, t in docs if _brute([(i, t)], items)}
        assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted((str(i), str(t)) for i, t in docs if (str(i), t) not in hit)


def test_hot_item_and_shuffled_join(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    item = "one two three four five six seven eight nine ten"
    docs = [(i, f"{i} lead {item} tail {i}" if i % 3 == 0 else f"nothing of it {i}") for i in range(300)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r.doc_id for r in decontam.contaminated(d, b).collect()} == set(range(0, 300, 3))


def test_empty_tables_and_native_plan(spark):
    docs, items = _data(3)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontam.contaminated(d.where("false"), b).count() == 0
    assert decontam.contaminated(d, b.where("false")).count() == 0
    plans = []
    plain = decontam.checkpoint
    decontam.checkpoint = lambda df: plans.append(df) or plain(df)
    try:
        plans.append(decontam.contaminated(d, b))
    finally:
        decontam.checkpoint = plain
    assert len(plans) == 3
    assert not any(re.search("Python|Pandas|Arrow|CartesianProduct", p._jdf.queryExecution().toString()) for p in plans)
