"""SimHash near-duplicates with deletion-variant signatures.

A fingerprint is cut into ``max_bits // 2 + 1`` segments: of two fingerprints
that differ in at most ``max_bits`` bits, at least one segment differs in at
most one bit. Each segment is indexed under its one-wildcard variants (the
segment with one bit position masked out, once for each position), so that one
bit of difference is found by equality of a variant alone. Equal variants are
joined and the full distance is verified.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import checkpoint, own_names
from .graph import connected_components

BITS = 64


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """64-bit SimHash of one text (unsigned); 0 for a null text or one without words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    joined = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    votes, n = np.zeros(BITS, np.int64), len(joined)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        h = np.array([xxhash.xxh64_intdigest(s, 42) for s in joined[at : at + (1 << 16)]], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * votes > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprint(text: Column | str, words: int = 3) -> Column:
    """Column of 64-bit fingerprints as signed long."""

    @pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, words) for t in texts], dtype=np.uint64).view(np.int64))

    return fp(text)


def _segments(positions: list[int], count: int) -> list[list[int]]:
    cut = [round(i * len(positions) / count) for i in range(count + 1)]
    return [positions[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def _mask(bits) -> int:
    m = functools.reduce(lambda x, p: x | (1 << p), bits, 0)
    return m - (1 << BITS) if m >> (BITS - 1) else m


def _variants(fps: DataFrame, key: list[str], positions: list[int], max_bits: int, level: int) -> DataFrame:
    """Explode each fingerprint into its one-wildcard variants of every segment of ``positions``."""
    sigs = []
    for s, seg in enumerate(_segments(positions, max_bits // 2 + 1)):
        for j, gone in enumerate(seg):
            kept = _mask([p for p in seg if p != gone])
            sigs.append(F.struct(F.lit(s * BITS + j).cast("short").alias("slot"), F.col("fp").bitwiseAND(F.lit(kept)).alias("part")))
    out = fps.select("fp", *key, F.explode(F.array(*sigs)).alias("v"))
    return out.select("fp", *key, F.col("v.slot").alias(f"slot{level}"), F.col("v.part").alias(f"part{level}"))


def link_fingerprints(fps: DataFrame, max_bits: int = 2, hot_group: int = 256) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most ``max_bits`` bits apart.

    ``fps``: one column ``fp`` of distinct longs. Variants held by one
    fingerprint only are dropped by a count before the join. A variant held by
    more than ``hot_group`` fingerprints is not joined as it is: its rows get
    a second signature of the same kind over the bits that the first leaves
    open (and a third, while enough bits are left), so that the rows of a
    large group of near copies meet in small subgroups and no pair is lost.
    """
    none, found = [], None
    level, key, rows = 0, none, fps
    open_bits = [list(range(BITS))]
    while True:
        spread = None
        if level == 0:
            spread = _variants(rows, key, open_bits[0], max_bits, 0)
        else:
            # what the earlier variant leaves open depends on its slot: refine each case by its own segments
            parts = [
                _variants(rows.where(cond), key, pos, max_bits, level)
                for cond, pos in open_bits
            ]
            spread = functools.reduce(DataFrame.unionByName, parts)
        key = [*key, f"slot{level}", f"part{level}"]
        size = spread.groupBy(*key).agg(F.count("*").alias("held")).where("held > 1")
        size = checkpoint(size)
        last = level == 2 or max_bits < 2  # with one segment a variant holds two fingerprints at most
        small = size if last else size.where(F.col("held") <= hot_group)
        met = spread.join(small.drop("held"), key)
        left = met.select(*key, F.col("fp").alias("a"))
        right = met.select(*key, F.col("fp").alias("b"))
        pairs = left.join(right, key).where(F.col("a") < F.col("b")).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        pairs = pairs.select("a", "b")
        found = pairs if found is None else found.union(pairs)
        if last or size.where(F.col("held") > hot_group).limit(1).count() == 0:
            return found.distinct()
        rows = spread.join(size.where(F.col("held") > hot_group).drop("held"), key)
        level += 1
        # halves of the word: the segment that the first variant fixed is closed but for its wildcard bit
        segs = _segments(list(range(BITS)), max_bits // 2 + 1)
        cases = []
        for s, seg in enumerate(segs):
            rest = [p for p in range(BITS) if p not in seg]
            if level == 1:
                cases.append((F.floor(F.col("slot0") / BITS) == s, rest))
            else:
                subs = _segments(rest, max_bits // 2 + 1)
                for t, sub in enumerate(subs):
                    deeper = [p for p in rest if p not in sub]
                    cases.append(((F.floor(F.col("slot0") / BITS) == s) & (F.floor(F.col("slot1") / BITS) == t), deeper))
        open_bits = cases


def _labelled(docs: DataFrame, id_col: str, text_col: str, words: int, max_bits: int) -> DataFrame:
    """One row per document: (doc, th = hash of the text, fp, part = a node of the component, component_id)."""
    text = F.col(text_col)
    prints = checkpoint(docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("th"), fingerprint(text, words).alias("fp")))
    nodes = checkpoint(prints.groupBy("fp").agg(F.min("doc").alias("low")))
    parts = connected_components(link_fingerprints(nodes.select("fp"), max_bits))
    named = nodes.join(parts, nodes.fp == parts.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("part"))
    low = named.groupBy("part").agg(F.min("low").alias("component_id"))
    return prints.join(named.join(low, "part").select("fp", "part", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2) -> DataFrame:
    """Fingerprint and component of every document.

    Returns (id_col, fingerprint, component_id): 16 lower-case hex digits and
    the smallest id reachable over links, a document's own included. Null and
    empty texts have fingerprint zero and link like any other; rows with equal
    fingerprints are one node, so thousands of copies cost one row. Repeated
    ids give one output row per input row; a null id is carried through and
    is a component id only if all ids of the component are null. An empty
    table gives an empty result. Other columns are ignored.
    """
    return _labelled(docs, id_col, text_col, words, max_bits).select(
        F.col("doc").alias(id_col),
        F.lower(F.lpad(F.hex(F.col("fp")), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2) -> DataFrame:
    """The document that stays of each component, with all its columns.

    It is the row with the smallest id (null ids last; an id that repeats: the
    smallest text hash, and one of wholly equal rows).
    """
    rows = _labelled(docs, id_col, text_col, words, max_bits).groupBy("part", "doc", "th").agg(F.count("*").alias("n"))
    best = rows.groupBy("part").agg(F.min(F.struct(F.col("doc").isNull().alias("no"), "doc", "th", "n")).alias("k"))
    names = own_names(docs, "__doc", "__th", "__part", "__n")
    doc, th, part, n = names
    chosen = checkpoint(best.select(F.col("k.doc").alias(doc), F.col("k.th").alias(th), F.col("part").alias(part), F.col("k.n").alias(n)))
    # the small side is hashed: whole documents are dealt, but not sorted
    hit = docs.join(chosen.hint("shuffle_hash"), docs[id_col].eqNullSafe(chosen[doc]) & (F.xxhash64(docs[text_col]) == chosen[th]))
    if chosen.where(chosen[n] > 1).limit(1).count():
        hit = hit.dropDuplicates([part])
    return hit.drop(*names)
