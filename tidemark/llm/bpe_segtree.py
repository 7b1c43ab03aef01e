"""Byte-level BPE with a segment tree over byte positions.

A piece of n bytes is a row of n live positions. Leaf i of the tree holds the
rank of the pair that starts at position i and the next live position (or
infinity); inner nodes hold the leftmost minimum of their children. A merge
takes the root's position, joins its right neighbour to it (a linked list of
live positions) and updates at most three leaves, each in O(log n). Short pieces share one array of such trees, a
row each, so that a step is a handful of NumPy operations for all of them.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

_NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    width = 1 << max(1, (n - 1).bit_length())
    tree = [_NONE] * (2 * width)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))

    def pair(i: int) -> int:
        j = nxt[i]
        return ranks.get(piece[i : nxt[j]], _NONE) if j < n else _NONE

    for i in range(n - 1):
        tree[width + i] = pair(i)
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b

    def put(i: int, value: int) -> None:
        k = width + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            low = a if a <= b else b
            if tree[k] == low:
                return
            tree[k] = low
            k >>= 1

    while (least := tree[1]) != _NONE:
        k = 1
        while k < width:  # leftmost leaf with the minimum
            k = 2 * k if tree[2 * k] == least else 2 * k + 1
        i = k - width
        j = nxt[i]
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        put(j, _NONE)
        put(i, pair(i))
        if prv[i] >= 0:
            put(prv[i], pair(prv[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : nxt[i]]])
        i = nxt[i]
    return out


class PairTable:
    """Rank of every pair of tokens whose joined bytes are a token; open addressing in NumPy arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        ]
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.last = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, _NONE, np.int64)
        if pairs:
            key, rank = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))
            at = self._home(key)
            while len(key):
                free = self.keys[at] == -1
                self.keys[at[free]] = key[free]  # of several for one slot the last stays
                own = self.keys[at] == key
                self.ranks[at[own]] = rank[own]
                key, rank, at = key[~own], rank[~own], (at[~own] + 1) & self.last

    def _home(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = self._home(key)
        out = np.full(len(key), _NONE, np.int64)
        open_ = np.arange(len(key))
        while len(open_):
            held = self.keys[at]
            hit = held == key[open_]
            out[open_[hit]] = self.ranks[at[hit]]
            on = ~hit & (held != -1)
            open_, at = open_[on], (at[on] + 1) & self.last
        return out


def merge_pieces(pieces: list[bytes], width: int, table: PairTable, byte_ids: np.ndarray) -> list[bytes]:
    """Packed ids of many pieces of 1 to ``width`` bytes (a power of two, 2 at least).

    One segment tree for each piece, as rows of one array; a leaf holds
    ``rank * width + position``, so the root names the leftmost minimum. Every
    step merges once in each unfinished piece.
    """
    count = len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, count)
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(count, width)
    ids = byte_ids[raw]
    col = np.arange(width)
    live = col < sizes[:, None]
    nxt = np.tile(col + 1, (count, 1))
    prv = np.tile(col - 1, (count, 1))
    tree = np.full((count, 2 * width), _NONE, np.int64)
    at, to = np.nonzero(live[:, 1:])
    rank = table(ids[at, to], ids[at, to + 1])
    tree[at, width + to] = np.where(rank == _NONE, _NONE, rank * width + to)
    for k in range(width - 1, 0, -1):
        np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])

    def put(row: np.ndarray, pos: np.ndarray, value: np.ndarray) -> None:
        k = width + pos
        tree[row, k] = value
        while width > 1 and k[0] > 1:
            value = np.minimum(tree[row, k], tree[row, k ^ 1])
            k = k >> 1
            tree[row, k] = value

    def pair(row: np.ndarray, pos: np.ndarray) -> np.ndarray:
        j = nxt[row, pos]
        out = np.full(len(row), _NONE, np.int64)
        inside = j < sizes[row]
        r, p = row[inside], pos[inside]
        rank = table(ids[r, p], ids[r, j[inside]])
        out[inside] = np.where(rank == _NONE, _NONE, rank * width + p)
        return out

    row = np.flatnonzero(tree[:, 1] != _NONE)
    while len(row):
        least = tree[row, 1]
        i = least % width
        j = nxt[row, i]
        after = nxt[row, j]
        ids[row, i] = least // width
        nxt[row, i] = after
        inner = after < width
        prv[row[inner], after[inner]] = i[inner]
        live[row, j] = False
        put(row, j, np.full(len(row), _NONE, np.int64))
        put(row, i, pair(row, i))
        before = prv[row, i]
        back = before >= 0
        if back.any():
            put(row[back], before[back], pair(row[back], before[back]))
        row = row[tree[row, 1] != _NONE]
    packed = ids[live].astype("<u4").tobytes()
    ends = 4 * np.cumsum(live.sum(1))
    return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


#: Fixed value: the split pattern for which ``split_plain`` is written.
PLAIN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def _char_classes() -> np.ndarray:
    out = np.full(0x110000, _OTHER, np.uint8)
    chars = [chr(c) for c in range(0x110000)]
    text = "".join(chars)
    for kind, pattern in ((_SPACE, r"\s"), (_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}")):
        found = regex.findall(pattern, text)
        out[np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), np.uint32)] = kind
    return out


def split_plain(text: str, classes: np.ndarray) -> list[str]:
    """The matches of ``PLAIN_PATTERN`` in a text without apostrophes, from the runs of character classes."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = classes[code]
    start = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1))
    end = np.concatenate((start[1:], [len(code)]))
    space = kind[start] == _SPACE
    follows = end < len(code)
    blank = code[end - 1] == 32
    long = end - start > 1
    # the last white space before a run: a blank joins the run, anything else is a piece of its own
    lead = np.zeros(len(start), bool)
    lead[1:] = (space & blank)[:-1]
    cuts = [(start - lead)[~space], start[space & (long | ~blank | ~follows)], (end - 1)[space & follows & long & ~blank]]
    cut = np.sort(np.concatenate(cuts)).tolist()
    return [text[a:b] for a, b in zip(cut, [*cut[1:], len(text)], strict=True)]


def cuts_plain(code: np.ndarray, classes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Starts of the matches of ``PLAIN_PATTERN`` in texts that lie one behind the other, from the runs of character classes.

    ``code`` holds the code points, ``ends`` the end of each text; apostrophes may occur.
    """
    if not len(code):
        return np.zeros(0, np.int64)
    kind = classes[code]
    change = np.ones(len(code) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[ends] = True
    start = np.flatnonzero(change)
    start, end = start[:-1], start[1:]
    last = np.zeros(len(code) + 1, bool)
    last[ends] = True
    space = kind[start] == _SPACE
    follows = ~last[end]
    blank = code[end - 1] == 32
    long = end - start > 1
    # the last white space before a run: a blank joins the run, anything else is a piece of its own
    lead = np.zeros(len(start), bool)
    lead[1:] = (space & blank & follows)[:-1]
    begin = start - lead
    # a contraction: an apostrophe alone, without a blank, takes the first letters of the run behind it
    mark = np.flatnonzero((code[start] == 39) & ~long & ~lead & follows)
    run, whole = mark + 1, np.zeros(len(start), bool)
    if len(run):
        here, room = start[run], end[run] - start[run]
        one, two = code[here], code[np.minimum(here + 1, len(code) - 1)]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("l")) & (two == ord("l"))) | (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e")))
        taken = np.where(single, 1, np.where(double & (room > 1), 2, 0))
        begin[run] += taken
        whole[run] = (taken > 0) & (taken == room)
    cuts = [begin[~space & ~whole], start[space & (long | ~blank | ~follows)], (end - 1)[space & follows & long & ~blank]]
    return np.sort(np.concatenate(cuts))


class ByteBPE:
    """Encoder and decoder of one rank file and split pattern.

    Packed ids of pieces seen are kept, at most ``memory`` of them; pieces not
    held are merged together, short ones as rows of one tree array, each of
    the long ones with a tree of its own.
    """

    def __init__(self, ranks_path: str, pattern: str, memory: int = 300_000):
        self.ranks = load_ranks(ranks_path)
        self.pattern = regex.compile(pattern)
        self.classes = _char_classes() if pattern == PLAIN_PATTERN else None
        self.table = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.memory = memory
        self.held: dict[str, bytes] = {}
        size = max(self.ranks.values(), default=-1) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token

    def split(self, text: str) -> list[str]:
        if self.classes is None or "'" in text or not text:
            return self.pattern.findall(text)
        return split_plain(text, self.classes)

    def _learn(self, new: set[str]) -> None:
        if len(self.held) + len(new) > self.memory:
            self.held.clear()
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in new:
            b = piece.encode("utf-8")
            if (rank := self.ranks.get(b)) is not None:
                self.held[piece] = rank.to_bytes(4, "little")
            elif len(b) > 64:
                self.held[piece] = np.array(merge_piece(b, self.ranks), dtype="<u4").tobytes()
            else:
                by_width.setdefault(1 << max(1, (len(b) - 1).bit_length()), []).append((piece, b))
        for width, rows in by_width.items():
            step = max(1, (1 << 17) // width)
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                self.held.update(zip([p for p, _ in part], merge_pieces([b for _, b in part], width, self.table, self.byte_ids), strict=True))

    def encode_many(self, texts, run_chars: int = 1 << 20):
        """Yield the packed ids of each text (null: empty): little-endian unsigned 32-bit integers."""
        run: list[list[str]] = []
        size = 0

        def flush():
            held = self.held
            new = {p for pieces in run for p in pieces if p not in held}
            if new:
                if len(held) + len(new) > self.memory:
                    held.clear()
                    new = {p for pieces in run for p in pieces}
                self._learn(new)
            for pieces in run:
                yield b"".join([held[p] for p in pieces])

        for t in texts:
            run.append(self.split(t) if t else [])
            size += len(t or "")
            if size >= run_chars:
                yield from flush()
                run, size = [], 0
        yield from flush()

    def encode_packed(self, text: str | None) -> bytes:
        """Packed ids of one text, each match of the pattern encoded by itself."""
        return next(self.encode_many([text]))

    def decode_packed(self, packed: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(packed, dtype="<u4").tolist()])


_LOADED: dict[tuple[str, str], ByteBPE] = {}


def codec(ranks_path: str, pattern: str) -> ByteBPE:
    """One codec per Python worker and rank file."""
    key = (ranks_path, pattern)
    if key not in _LOADED:
        _LOADED[key] = ByteBPE(ranks_path, pattern)
    return _LOADED[key]


def encode(text: Column, ranks_path: str, pattern: str) -> Column:
    """Binary column: the packed ids of each text (null: empty)."""

    @pandas_udf("binary")
    def enc(texts: pd.Series) -> pd.Series:
        bpe = codec(ranks_path, pattern)
        return pd.Series(list(bpe.encode_many(texts)), dtype=object)

    return enc(text)


def decode(ids: Column, ranks_path: str, pattern: str) -> Column:
    """Binary column: the bytes that packed ids stand for (null: empty)."""

    @pandas_udf("binary")
    def dec(packed: pd.Series) -> pd.Series:
        bpe = codec(ranks_path, pattern)
        return pd.Series([bpe.decode_packed(p or b"") for p in packed], dtype=object)

    return dec(ids)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids binary) of every document.

    One output row per input row, repeated rows and null ids included; null
    and empty texts have no ids. Other columns are ignored.
    """
    return docs.select(F.col(id_col), encode(F.col(text_col), ranks_path, pattern).alias("ids"))


def digests(ids: Column, ranks_path: str, pattern: str) -> Column:
    """Struct (n_tokens, ids_sha256, decoded_sha256) of packed ids, decoding them."""

    @pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def told(packed: pd.Series) -> pd.DataFrame:
        bpe = codec(ranks_path, pattern)
        rows = [(len(p) // 4, hashlib.sha256(p).hexdigest(), hashlib.sha256(bpe.decode_packed(p)).hexdigest()) for p in packed]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return told(ids)
