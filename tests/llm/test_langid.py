"""Language filters."""

import numpy as np

from tidemark.llm import langid
from tidemark.llm.common import held_out

SCHEMA = "doc_id long, text string, lang string"
VOC = {
    "aa": "bako timu relo sani dopa luke".split(), "bb": "ströng füße über käse mäus".split(),
    "cc": "xyl qwor zzan vrik gluth".split(),
}


def _rows(n=240, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        lang = sorted(VOC)[i % 3]
        rows.append((i, " ".join(rng.choice(VOC[lang], size=rng.integers(3, 40))), lang))
    return rows


def test_filters_hold_every_gram_and_few_others():
    rng = np.random.default_rng(0)
    grams = {k: np.unique(rng.integers(0, 1 << 32, 3000, dtype=np.uint32)) for k in ("a", "b", "c")}
    m = langid.LanguageFilters.build(["a", "b", "c"], grams)
    for bit, k in enumerate("abc"):
        assert (m.containing(grams[k])[0] >> np.uint8(bit) & np.uint8(1)).all()
    other = rng.integers(0, 1 << 32, 50_000, dtype=np.uint32)
    for bit in range(3):
        rate = (m.containing(other)[0] >> np.uint8(bit) & np.uint8(1)).mean()
        assert abs(rate - m.false_rate[bit]) < 0.003


def test_more_than_64_languages():
    grams = {f"l{i:03}": np.arange(i * 50, i * 50 + 50, dtype=np.uint32) for i in range(70)}
    m = langid.LanguageFilters.build(sorted(grams), grams)
    assert m.slots.shape[0] == 2
    mask = m.containing(grams["l069"])
    assert (mask[1] >> np.uint64(5) & np.uint64(1)).all()


def test_held_out_accuracy_and_odd_texts(spark):
    rows = _rows() + [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !!", "bb"), (903, "日本語", "cc"), (904, "bako timu relo sani", None), (None, "bako timu", "aa"), (905, "x", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "'q' as lang_pred", "2 as gram")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 for r in got.values())
    held = [(r, lang) for i, _, lang in _rows() if (r := got[i]).held_out]
    assert len(held) > 30 and all(r.lang_pred == lang for r, lang in held)
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert got[903].lang_pred in VOC and got[905].lang_pred in VOC
    assert got[904].lang_pred == "aa" and not got[None].held_out
    ids = {r.doc_id for r in langid.keep_identified(df).collect()}
    assert {i for i, *_ in _rows()} <= ids and not ids & {900, 901, 902}
    assert langid.keep_identified(df).columns == df.columns


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    fake = df.selectExpr("doc_id", "text", "lang").withColumn("lang", __import__("pyspark.sql.functions", fromlist=["when"]).expr("case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 'zz' else lang end"))
    assert sorted(langid.identify(df).collect()) == sorted(langid.identify(fake).collect())
    assert df.where(held_out("doc_id")).count() > 0


def test_no_language_and_no_rows(spark):
    df = spark.createDataFrame([(1, "bako", None)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in langid.identify(df).collect()] == [("und", 0.0)]
    assert langid.identify(df.where("false")).count() == 0


def test_grams_do_not_depend_on_neighbours():
    texts = [b"Reorea. Nd. 11", b"", b"x", b"ab cd", "ströng füße".encode(), b"tail "]
    codes, owner = langid._grams(texts)
    for i, t in enumerate(texts):
        assert codes[owner == i].tolist() == langid._grams([t])[0].tolist()
    assert [(owner == i).sum() for i in range(4)] == [6, 0, 0, 2]  # one for each pair of neighbouring letters


def test_against_exact_gram_sets(spark):
    """Corrected popcounts of the filters against sets of n-grams, on whole texts of the given table."""
    from collections import Counter

    from conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang", held_out("doc_id").alias("out")).collect()
    counts: dict[str, Counter] = {}
    for r in rows:
        if not r.out and r.lang is not None and r.text is not None:
            counts.setdefault(r.lang, Counter()).update(langid._grams([r.text.encode()])[0].tolist())
    sets = {k: {g for g, n in c.items() if n >= 2e-5 * sum(c.values())} for k, c in counts.items()}
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    clear = 0
    for r in rows:
        grams = langid._grams([(r.text or "").encode()])[0].tolist()
        if not grams:
            continue
        share = sorted(((sum(g in s for g in grams) / len(grams), k) for k, s in sets.items()), reverse=True)
        assert abs(got[r.doc_id].score - share[0][0]) < 0.05
        if len(share) < 2 or share[0][0] - share[1][0] > 0.05:
            clear += 1
            assert got[r.doc_id].lang_pred == share[0][1]
    assert clear > len(rows) / 2
