"""Repeated byte strings across documents, found by deep-shallow suffix sorting.

Every window of ``length`` bytes has an anchor: the place of the smallest hash
among the ``gram``-byte strings in it (the leftmost of equal ones). Equal
windows have the same anchor string at the same place, so

1. anchor strings that occur once in the corpus are dropped by a count of
   their hashes (nothing that repeats is lost);
2. the windows of each other anchor are cut out as one slice of the text, and
   slices are dealt by their anchor string;
3. in each group two suffix arrays are built, over the suffixes that start at
   the anchors and over the reversed prefixes that end there. Deep-shallow
   sorting orders them: a most-significant-digit sort on eight-byte digits, in
   place of multikey quicksort, down to a shallow depth, then blind tries order the groups that still agree. Runs of
   large common prefixes in the two arrays name the classes of equal right and
   equal left contexts; a window repeats if its pair of classes does.

Equal slices of a task are collapsed to one row before they are dealt. Anchor
strings with more than ``hot`` occurrences are not dealt as groups at all. Their
occurrences stay rows (slice digest, document, start); distinct slices are
counted, their windows are counted by 160-bit digests of their bytes (equal
digests are equal windows), and what repeats is joined back to the occurrences.
These are partial counts and equi-joins with a side that holds each key once,
which stream and can be split, so no task holds the members of a digest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import text_batches, written

_P = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xD6E8FEB86659FD93)
SHALLOW = 32


# ---- deep-shallow sorting -------------------------------------------------


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n if not x else n - 1 - (x.bit_length() - 1) // 8


class BlindTrie:
    """Sorted order and common prefixes of strings that share a first part.

    A node holds the depth at which its strings first differ and a child for
    each byte there (-1: the string ends). An insertion goes down blindly,
    looking only at branching bytes, compares with one leaf it ends at, and
    then splits the path at the depth of the true difference.
    """

    __slots__ = ("root", "strings")

    def __init__(self):
        self.root = None
        self.strings: list[bytes] = []

    def add(self, s: bytes, member: int) -> None:
        if self.root is None:
            self.root = [-1, s, [member]]
            return
        node = self.root
        while node[0] >= 0:  # blind descent to some leaf
            depth, kids = node[0], node[1]
            step = s[depth] if depth < len(s) else -1
            node = kids.get(step) or next(iter(kids.values()))
        other = node[1]
        if other == s:
            node[2].append(member)
            return
        depth = _common(s, other)
        up, at, node = None, None, self.root
        while node[0] >= 0 and node[0] < depth:
            up, at = node, s[node[0]]
            node = node[1][at]
        mine = s[depth] if depth < len(s) else -1
        leaf = [-1, s, [member]]
        if node[0] == depth:
            node[1][mine] = leaf
            return
        theirs = other[depth] if depth < len(other) else -1
        split = [depth, {mine: leaf, theirs: node}]
        if up is None:
            self.root = split
        else:
            up[1][at] = split

    def walk(self):
        """(members, depth shared with the string before) in sorted order; the first shares -1."""
        stack = [(self.root, -1)] if self.root else []
        while stack:
            node, shared = stack.pop()
            if node[0] < 0:
                yield node[2], shared
                continue
            kids = sorted(node[1].items())
            for i in range(len(kids) - 1, -1, -1):
                stack.append((kids[i][1], shared if i == 0 else node[0]))


def deep_shallow(strings: list[bytes], group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sort strings within groups: (order, common prefix with the one before in the same group, else -1).

    ``group`` is the group number of each string. Shallow part: a sort
    by one digit of eight bytes after the other, on all groups at once, each
    digit only for the strings that still tie; a string alone in its group is
    done. Deep part: the strings
    that agree in ``shallow`` bytes go into a blind trie.
    """
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = np.frombuffer(b"".join(s[:shallow].ljust(shallow, b"\0") for s in strings), np.uint8).reshape(n, shallow)
    digits = head.view(">u8").astype(np.uint64)
    size = np.fromiter((min(len(s), shallow) for s in strings), np.int64, n)
    # digit by digit, most significant first, within the groups that still tie; the length tells a zero byte from the end of a string
    order = np.argsort(group, kind="stable")
    cls = group[order]
    for digit in (*digits.T, size.astype(np.uint64)):
        edge = np.concatenate(([True], cls[1:] != cls[:-1]))
        tied = np.flatnonzero(~(edge & np.append(edge[1:], True)))  # strings alone in their group are settled
        if not len(tied):
            break
        mine, now = digit[order[tied]], cls[tied]
        by = np.lexsort((mine, now))
        order[tied], mine = order[tied][by], mine[by]
        # tied groups lie one after another; a new digit in them begins a new group
        new = np.zeros(n, bool)
        new[tied[1:]] = mine[1:] != mine[:-1]
        cls = np.cumsum(edge | new)
    head, size, g = head[order], size[order], group[order]
    shared = np.full(n, -1, np.int64)
    unlike = head[1:] != head[:-1]
    first = np.where(unlike.any(1), unlike.argmax(1), shallow)
    shared[1:] = np.where(g[1:] == g[:-1], np.minimum(first, np.minimum(size[1:], size[:-1])), -1)
    equal = shared >= shallow
    starts = np.flatnonzero(~equal & np.append(equal[1:], False))
    ends = np.flatnonzero(equal & np.append(~equal[1:], True)) + 1
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        trie = BlindTrie()
        for i in order[a:b].tolist():
            trie.add(strings[i], i)
        at = a
        for members, deep in trie.walk():
            for m in members:
                order[at] = m
                if at > a:
                    shared[at] = deep if m == members[0] else len(strings[m])
                at += 1
    return order, shared


# ---- anchors ---------------------------------------------------------------


def _rolling(a: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all k-byte strings, from strings of doubled length."""
    out, have, cur, w, p = None, 0, a, 1, _P
    while True:
        if k & w:
            if out is None:
                out, have = cur, w
            else:
                n = len(a) - have - w + 1
                out = out[:n] * p + cur[have : have + n]
                have += w
        if w * 2 > k:
            break
        cur = cur[: len(cur) - w] * p + cur[w:]
        with np.errstate(over="ignore"):
            p = p * p
        w *= 2
    out = out * _M
    return out ^ (out >> np.uint64(32))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    cur, s = x, 1
    while s * 2 <= w:
        cur = np.minimum(cur[:-s], cur[s:])
        s *= 2
    n = len(x) - w + 1
    return np.minimum(cur[:n], cur[w - s : w - s + n])


def anchors(data: bytes, length: int, gram: int, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of each anchor of one run of bytes, in order."""
    out = []
    low = np.uint64((1 << 22) - 1)
    for at in range(0, max(0, len(data) - length + 1), piece):
        part = np.frombuffer(data[at : at + piece + length - 1], np.uint8).astype(np.uint64) + np.uint64(1)
        h = _rolling(part, gram)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        place = (_sliding_min(key, length - gram + 1) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place)) - 1
        out.append((h[place[first]], place[first] + at, first + at, last + at))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _run_anchors(run: list[bytes], length: int, gram: int):
    """Anchors of several documents at once: (document number, hash, place, first, last), windows across documents left out."""
    if len(run) == 1:
        h, p, a, b = anchors(run[0], length, gram)
        return np.zeros(len(h), np.int64), h, p, a, b
    sizes = np.fromiter(map(len, run), np.int64, len(run))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    h, p, a, b = anchors(b"".join(run), length, gram)
    doc = np.searchsorted(ends, p, side="right")
    # a window belongs to its anchor's document only if it lies inside it
    a, b = np.maximum(a, begins[doc]), np.minimum(b, ends[doc] - length)
    ok = a <= b
    doc, h, p, a, b = doc[ok], h[ok], p[ok], a[ok], b[ok]
    return doc, h, p - begins[doc], a - begins[doc], b - begins[doc]


# ---- the classes of one partition ------------------------------------------


def resolve(key: np.ndarray, many: np.ndarray, slices: list[bytes], place: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last repeated window of each slice (counted from its start; -1: none).

    ``key``: the group of each slice; ``many``: whether the slice itself occurs
    more than once; ``place``: the anchor in the slice; ``windows``: how many
    window starts the slice has (0, 1, ...).
    """
    n = len(slices)
    lo, hi = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    lo[many], hi[many] = 0, windows[many] - 1
    # slices alone in their group are settled
    _, inverse, size = np.unique(key, return_inverse=True, return_counts=True)
    rows = np.flatnonzero(size[inverse] > 1)
    if not len(rows):
        return lo, hi
    group, at, win = inverse[rows], place[rows], windows[rows]
    right = [slices[i][p : p + length] for i, p in zip(rows.tolist(), at.tolist(), strict=True)]
    left = [slices[i][max(0, p - length) : p][::-1] for i, p in zip(rows.tolist(), at.tolist(), strict=True)]
    r_order, r_shared = deep_shallow(right, group)
    l_order, l_shared = deep_shallow(left, group)
    r_class, l_class = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    open_ = ~many[rows]
    lo2, hi2 = lo[rows], hi[rows]
    for back in range(0, int(at.max()) + 1):
        # the windows that start ``back`` bytes before the anchor
        start = at - back
        has = (start >= 0) & (start < win)
        if not (has & open_).any():
            continue
        r_class[r_order] = np.cumsum(r_shared < length - back)
        l_class[l_order] = np.cumsum(l_shared < back)
        pair = (r_class * (len(rows) + 1) + l_class)[has]
        _, where, count = np.unique(pair, return_inverse=True, return_counts=True)
        hit = np.flatnonzero(has)[count[where] > 1]
        s = start[hit]
        lo2[hit] = np.where(lo2[hit] < 0, s, np.minimum(lo2[hit], s))
        hi2[hit] = np.maximum(hi2[hit], s)
    lo[rows], hi[rows] = lo2, hi2
    return lo, hi


def covered(lo: np.ndarray, hi: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of the union of [lo, hi + length) (window starts in bytes of one document)."""
    out: list[list[int]] = []
    for a, b in sorted(zip(lo.tolist(), (hi + length).tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


PIECE = "key long, slice binary, place int, windows int, members array<struct<k:long,th:long,starts:binary>>, many boolean"
OCCURRENCE = "sid binary, slice binary, k long, th long, start long"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k, th, row): a key of the document (its id, a hash of the text where that is null), the text's hash, all its columns.

    Both joins with documents start from this frame and the same key, so that Spark shuffles the texts once and reuses the exchange.
    """
    th = F.xxhash64(text_col)
    return docs.select(F.coalesce(F.col(id_col).cast("long"), th).alias("k"), th.alias("th"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))


def _wanted(batches, text_col: str, length: int, gram: int):
    """(k, th, text, hash, place, first window, last window) of every anchor whose hash is in its document's ``wanted`` list."""
    for batch in batches:
        ids, ths = batch.column("k").to_pylist(), batch.column("th").to_pylist()
        lists = batch.column("wanted")
        for first, run in text_batches(batch.column("row").field(text_col).to_pylist()):
            doc, h, p, a, b = _run_anchors(run, length, gram)
            part = lists.slice(first, len(run))
            fh = part.flatten().to_numpy()
            owner = np.repeat(np.arange(len(run)), np.diff(part.offsets.to_numpy()))
            # both sides as (document, hash) codes
            _, code = np.unique(np.concatenate((fh, h.view(np.int64))), return_inverse=True)
            fc = np.sort(code[: len(fh)] * len(run) + owner)
            hc = code[len(fh) :] * len(run) + doc
            keep = fc[np.minimum(np.searchsorted(fc, hc), len(fc) - 1)] == hc if len(fc) else np.zeros(len(h), bool)
            for d, g, q, s, e in zip(doc[keep].tolist(), h[keep].view(np.int64).tolist(), p[keep].tolist(), a[keep].tolist(), b[keep].tolist(), strict=True):
                yield ids[first + d], ths[first + d], run[d], g, q, s, e


def _hot_spans(cut_from: DataFrame, text_col: str, length: int, gram: int) -> DataFrame:
    """(k, th, a, b) of the repeated windows of anchors with any number of occurrences."""

    def occurrences(batches):
        seen: set[bytes] = set()
        rows, size = [], 0
        make = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _OCCURRENCE.types, strict=True)], schema=_OCCURRENCE)
        for k, th, text, _, _, s, e in _wanted(batches, text_col, length, gram):
            piece = text[s : e + length]
            sid = hashlib.blake2b(piece, digest_size=20).digest()
            new = sid not in seen  # a task writes the bytes of a slice once
            if new:
                if len(seen) >= 100_000:
                    seen.clear()
                seen.add(sid)
                size += len(piece)
            rows.append((sid, piece if new else None, k, th, s))
            size += 200
            if size > 8 << 20:
                yield make()
                rows, size = [], 0
        if rows:
            yield make()

    def windows(batches):
        for batch in batches:
            out = {"digest": [], "sid": [], "at": [], "n": []}
            for sid, piece, n in zip(*(batch.column(c).to_pylist() for c in ("sid", "slice", "n")), strict=True):
                for at in range(len(piece) - length + 1):
                    out["digest"].append(hashlib.blake2b(piece[at : at + length], digest_size=20).digest())
                    out["sid"].append(sid)
                    out["at"].append(at)
                    out["n"].append(n)
            yield pa.RecordBatch.from_pydict(out, schema=_WINDOW)

    # tables between the steps: the counted sides are written, so that both sides of a join are plain exchanges, which may be split
    members = written(cut_from.mapInArrow(occurrences, OCCURRENCE), "hot-occurrences")
    slices = members.groupBy("sid").agg(F.count(F.lit(1)).alias("n"), F.max("slice").alias("slice"))
    each = written(slices.mapInArrow(windows, "digest binary, sid binary, at int, n long"), "hot-windows")
    again = written(each.groupBy("digest").agg(F.sum("n").alias("total")).where("total > 1").select("digest"), "hot-repeated")
    # the windows of a slice share its anchor: from the first repeated to the last one all bytes are covered
    ends = written(each.join(again, "digest").groupBy("sid").agg(F.min("at").alias("lo"), F.max("at").alias("hi")), "hot-ends")
    return members.select("sid", "k", "th", "start").join(ends, "sid").select("k", "th", (F.col("start") + F.col("lo")).alias("a"), (F.col("start") + F.col("hi") + length).alias("b"))


def repeated_spans(keyed: DataFrame, text_col: str = "text", length: int = 200, gram: int = 64, hot: int = 100_000) -> DataFrame:
    """(k, th, spans array<struct<a,b>>): byte runs [a, b) of each document whose union is to be removed.

    ``keyed`` is the result of ``_keyed``: rows of equal key and text share one
    result. ``hot``: windows of anchor strings that occur more often are counted
    by digest, not sorted in groups.
    """
    texts = keyed.select("k", F.col(f"row.{text_col}").alias("text")).where(F.octet_length("text") >= length)

    def hashes(batches):
        for batch in batches:
            ids = batch.column("k")
            for first, run in text_batches(batch.column("text").to_pylist()):
                doc, h, *_ = _run_anchors(run, length, gram)
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, bool)
                n = np.diff(np.append(np.flatnonzero(new), len(h)))
                at = pa.array(doc[new] + first)
                yield pa.RecordBatch.from_arrays([ids.take(at), pa.array(h[new].view(np.int64)), pa.array(n, pa.int32())], ["k", "h", "n"])

    found = written(texts.mapInArrow(hashes, "k long, h long, n int"), "anchors")
    again = written(found.groupBy("h").agg(F.sum("n").alias("total")).where("total > 1").select("h", (F.col("total") > hot).alias("hot")), "repeated")

    def cut_from(which: DataFrame) -> DataFrame:
        # a key that several texts share gets the strings of all of them: more than needed, never less
        wanted = found.join(which.select("h"), "h").groupBy("k").agg(F.collect_set("h").alias("wanted"))
        return keyed.join(wanted, "k").select("k", "th", "row", "wanted")

    def cut(batches):
        held: dict[tuple, dict[tuple, list[int]]] = {}
        size = 0

        def flush():
            cols = {c: [] for c in ("key", "slice", "place", "windows", "members", "many")}
            for (g, piece, q, count), who in held.items():
                cols["key"].append(g)
                cols["slice"].append(piece)
                cols["place"].append(q)
                cols["windows"].append(count)
                cols["members"].append([{"k": k, "th": t, "starts": np.array(st, "<i8").tobytes()} for (k, t), st in who.items()])
                cols["many"].append(sum(map(len, who.values())) > 1)
            return pa.RecordBatch.from_pydict(cols, schema=_PIECE)

        for k, th, text, g, q, s, e in _wanted(batches, text_col, length, gram):
            held.setdefault((g, text[s : e + length], q - s, e - s + 1), {}).setdefault((k, th), []).append(s)
            size += e - s + length + 100
            if size > 24 << 20:  # equal slices of the task so far are one row
                yield flush()
                held.clear()
                size = 0
        if held:
            yield flush()

    pieces = cut_from(again.where("not hot")).mapInArrow(cut, PIECE)
    # no key holds more than ``hot`` occurrences
    dealt = pieces.repartition("key").sortWithinPartitions("key")

    def settle(batches):
        rows_: list[dict] = []
        size = 0

        def flush(held: list[dict]):
            # equal slices of a group meet here from several tasks
            index: dict[tuple, int] = {}
            uniq: list[dict] = []
            for r in held:
                k = (r["key"], r["slice"], r["place"])
                if k in index:
                    u = uniq[index[k]]
                    u["many"] = True
                    u["members"] += r["members"]
                else:
                    index[k] = len(uniq)
                    uniq.append(r)
            lo, hi = resolve(
                np.array([u["key"] for u in uniq], np.int64), np.array([u["many"] for u in uniq], bool), [u["slice"] for u in uniq],
                np.array([u["place"] for u in uniq], np.int64), np.array([u["windows"] for u in uniq], np.int64), length,
            )
            out = {"k": [], "th": [], "a": [], "b": []}
            for u, x, y in zip(uniq, lo.tolist(), hi.tolist(), strict=True):
                if x < 0:
                    continue
                # rows of equal key and text have the same spans: one of them tells all
                for k, th, starts in {(m["k"], m["th"], m["starts"]) for m in u["members"]}:
                    st = np.frombuffer(starts, "<i8")
                    out["k"] += [k] * len(st)
                    out["th"] += [th] * len(st)
                    out["a"] += (st + x).tolist()
                    out["b"] += (st + y + length).tolist()
            return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

        for batch in batches:
            for r in batch.to_pylist():
                if size > 16 << 20 and rows_ and rows_[-1]["key"] != r["key"]:
                    yield flush(rows_)
                    rows_, size = [], 0
                rows_.append(r)
                size += len(r["slice"]) + 200 + sum(200 + len(m["starts"]) for m in r["members"])
        if rows_:
            yield flush(rows_)

    hits = dealt.mapInArrow(settle, "k long, th long, a long, b long")
    if not again.where("hot").isEmpty():
        hits = hits.unionByName(_hot_spans(cut_from(again.where("hot")), text_col, length, gram))
    # runs of one document are merged by the union of its spans
    return hits.groupBy("k", "th").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


_PIECE = pa.schema([
    ("key", pa.int64()), ("slice", pa.binary()), ("place", pa.int32()), ("windows", pa.int32()),
    ("members", pa.list_(pa.struct([("k", pa.int64()), ("th", pa.int64()), ("starts", pa.binary())]))), ("many", pa.bool_()),
])
_OCCURRENCE = pa.schema([("sid", pa.binary()), ("slice", pa.binary()), ("k", pa.int64()), ("th", pa.int64()), ("start", pa.int64())])
_WINDOW = pa.schema([("digest", pa.binary()), ("sid", pa.binary()), ("at", pa.int32()), ("n", pa.int64())])


def _with_spans(docs: DataFrame, length: int, id_col: str, text_col: str, **kw) -> DataFrame:
    """(row, spans): every row as a struct with the spans of its text, null if it has none."""
    keyed = _keyed(docs, id_col, text_col)
    spans = repeated_spans(keyed, text_col, length, **kw).select("k", F.col("th").alias("s_th"), "spans")
    # the text hash is compared as a residual condition: the join is on the key alone, as the one above
    left, right = keyed.alias("d"), spans.alias("s")
    return left.join(right, (F.col("d.k") == F.col("s.k")) & (F.col("d.th").bitwiseXOR(F.col("s.s_th")) == 0), "left").select("d.row", "s.spans")


def _runs(spans, length: int) -> list[tuple[int, int]]:
    if spans is None or not len(spans):
        return []
    lo = np.array([s["a"] for s in spans], np.int64)
    return covered(lo, np.array([s["b"] for s in spans], np.int64) - length, length)


def _kept(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in runs:
        parts.append(data[at:a])
        at = b
    parts.append(data[at:])
    return b"".join(parts)


def removal_digests(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Per document what is removed: (id_col, n_bytes, n_removed, n_spans, kept_sha256).

    Bytes covered by a ``length``-byte string that also starts anywhere else
    are removed, judged on the input. Null texts are empty; texts shorter than
    ``length`` lose nothing. Rows that repeat (equal id and text) are copies of
    each other like any other texts. Null ids are carried. An empty table gives
    an empty result. Other columns are ignored.
    """
    rows = _with_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), length, "id", "text", **kw)

    def digest(batches):
        for batch in batches:
            row = batch.column("row")
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for t, spans in zip(row.field("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = (t or "").encode("utf-8", "surrogatepass")
                runs = _runs(spans, length)
                kept = _kept(data, runs)
                for k, v in zip(out, (len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict({"id": row.field("id"), **{k: pa.array(v, pa.string() if k == "kept_sha256" else pa.int64()) for k, v in out.items()}})

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    out = rows.mapInArrow(digest, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The documents with repeated bytes removed from their texts; all columns and rows stay.

    Characters that lose some of their bytes are dropped whole. Null texts stay null.
    """
    rows = _with_spans(docs, length, id_col, text_col, **kw)

    @pandas_udf("string")
    def strip(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [t if t is None or s is None else _kept(t.encode("utf-8", "surrogatepass"), _runs(s, length)).decode("utf-8", "ignore") for t, s in zip(texts, spans, strict=True)],
            dtype=object,
        )

    cut = F.when(F.col("spans").isNull(), F.col(f"row.{text_col}")).otherwise(strip(F.col(f"row.{text_col}"), F.col("spans")))
    return rows.select(*[cut.alias(c) if c == text_col else F.col(f"row.{c}").alias(c) for c in docs.columns])
