"""Token-id shards compressed with a Re-Pair grammar.

Every shard holds the ids of consecutive documents. Frequent pairs of
adjacent symbols are replaced by new symbols (nonterminals), most frequent
first, until no pair is frequent; each round replaces all pairs above a
falling frequency threshold. A file stores the rules, the expansion length of
each nonterminal, the remaining sequence and the documents' offsets; prefix
sums of expansion lengths locate any range of ids without decoding the rest.

File layout, little-endian: 8 bytes ``TMRPAIR1``, u32 header length, JSON
header (dtype of symbols, counts, first nonterminal), then rules (count x 2
symbols), expansion lengths (u32), sequence symbols, document offsets
(documents + 1, u64), document ids (i64, with a null flag byte each).
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fsio
from .bpe_segtree import _SPACE as SPACE
from .bpe_segtree import _char_classes, cuts_plain
from .common import run_dir, spread, written

MAGIC = b"TMRPAIR1"


class Answers:
    """Ids of pre-tokens, found for many at once.

    The bytes of a pre-token, padded to three words, and its length make a key
    of four words; keys stand in rows, found by open addressing, beside the
    place of their ids in a pool. Longer pre-tokens have a dict.
    """

    WORDS = 3

    def __init__(self, most: int):
        bits = max(8, (2 * most).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        self.rows, self.used = 0, 0
        self.keys = np.zeros((1024, self.WORDS + 1), np.uint64)
        self.begin, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool = np.zeros(4096, np.uint32)
        self.long: dict[bytes, int] = {}

    def _keys(self, data: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        raw = np.frombuffer(data + bytes(8 * self.WORDS), np.uint8)
        words = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        mask = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
        out = np.zeros((len(at), self.WORDS + 1), np.uint64)
        for k in range(self.WORDS):
            if not k:
                out[:, 0] = words[at] & mask[np.minimum(size, 8)]
            else:
                more = np.flatnonzero(size > 8 * k)
                out[more, k] = words[at[more] + 8 * k] & mask[np.minimum(size[more] - 8 * k, 8)]
        out[:, self.WORDS] = size
        return out

    def _home(self, keys: np.ndarray) -> np.ndarray:
        h = keys[:, 0].copy()
        for k in range(1, self.WORDS + 1):
            h = (h ^ h >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + keys[:, k]
        h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return (h >> self.shift).astype(np.int64)

    def find(self, data: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The row of each pre-token ``data[at : at + size]``; -1: not held."""
        out = np.full(len(at), -1, np.int64)
        for i in np.flatnonzero(size > 8 * self.WORDS).tolist():
            out[i] = self.long.get(data[at[i] : at[i] + size[i]], -1)
        rest = np.flatnonzero(size <= 8 * self.WORDS)
        keys = self._keys(data, at[rest], size[rest])
        slot = self._home(keys)
        while len(rest):
            row = self.slots[slot]
            held = self.keys.take(row, axis=0, mode="wrap")
            hit = row >= 0
            for k in range(self.WORDS + 1):
                hit &= held[:, k] == keys[:, k]
            out[rest[hit]] = row[hit]
            on = np.flatnonzero((row >= 0) & ~hit)
            rest, keys, slot = rest[on], keys[on], (slot[on] + 1) & self.last
        return out

    def add(self, names: list[bytes], ids: np.ndarray, count: np.ndarray) -> None:
        """Hold the ids of different pre-tokens not held yet: ``count`` of ``ids`` each, one after the other."""
        end, used = self.rows + len(names), self.used + len(ids)
        size = np.fromiter(map(len, names), np.int64, len(names))
        grown = lambda x, n: x if n <= len(x) else np.concatenate((x, np.zeros((max(n, 2 * len(x)) - len(x), *x.shape[1:]), x.dtype)))
        self.keys, self.begin, self.count = (grown(x, end) for x in (self.keys, self.begin, self.count))
        self.pool = grown(self.pool, used)
        row = np.arange(self.rows, end)
        self.pool[self.used : used] = ids
        self.count[row] = count
        self.begin[row] = self.used + np.cumsum(count) - count
        short = size <= 8 * self.WORDS
        self.long.update((names[i], self.rows + i) for i in np.flatnonzero(~short).tolist())
        keys = self._keys(b"".join(names), (np.cumsum(size) - size)[short], size[short])
        row = row[short]
        self.keys[row] = keys
        slot = self._home(keys)
        while len(row):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = row[free]  # of several for one slot the last stays
            on = self.slots[slot] != row
            row, slot = row[on], (slot[on] + 1) & self.last
        self.rows, self.used = end, used

    def ids(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows, one after the other, and how many each row has."""
        count = self.count[row]
        at = np.repeat(self.begin[row] - (np.cumsum(count) - count), count)
        at += np.arange(len(at))
        return self.pool[at], count


#: Fixed value: a pre-token of ``PLAIN_PATTERN`` always starts at the blank.
_BLANK = re.compile("[!-~](?= [!-~])")


def _parts(text: str, size: int):
    """A text in parts of about ``size`` characters, cut where a pre-token starts (nowhere, if there is no such place)."""
    at = 0
    while len(text) - at > size and (found := _BLANK.search(text, at + size)):
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


def _runs(texts: list[str], size: int):
    """The parts of texts as (number of the text, part), in lists of about ``size`` characters."""
    run, chars = [], 0
    for i, text in enumerate(texts):
        for part in _parts(text, size):
            run.append((i, part))
            chars += len(part)
            if chars >= size:
                yield run
                run, chars = [], 0
    if run:
        yield run


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library, without special tokens added.

    For a byte-level BPE file without normalizer the library encodes each
    pre-token by itself, so its answers for pre-tokens are kept (at most
    ``memory``, and ``pool`` ids) and joined; texts that hold an added token's
    string, and files of other kinds, go to the library whole.
    """

    def __init__(self, path: str, memory: int = 1_200_000, pool: int = 1 << 24):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, "rb") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout")
        )
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.memory, self.pool = memory, pool
        if self.by_piece:
            self.held = Answers(memory)
            self.classes = _char_classes()
            vocab = self.tokenizer.get_vocab()
            self.width = np.zeros(max(vocab.values(), default=-1) + 1, np.int64)  # bytes of a token: its string has a character for each
            for token, i in vocab.items():
                self.width[i] = len(token)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ask(self, names: list[bytes], between: str | None, step: int = 256) -> None:
        """Learn the library's ids of pre-tokens, ``step`` to a text with ``between`` after each (None: one by one).

        Tokens do not cross pre-tokens, so their widths tell where each ends; where that fails it is one by one.
        """
        if not names:
            return
        if between is not None:
            mark = between.encode()
            texts = [b"".join([n + mark for n in names[a : a + step]]).decode() for a in range(0, len(names), step)]
            ids = np.concatenate(self._library(texts))
            size = np.fromiter(map(len, names), np.int64, len(names))
            ends = np.cumsum(np.stack((size, np.full(len(size), len(mark))), 1).ravel()) if mark else np.cumsum(size)
            reach = np.cumsum(self.width[ids])
            last = np.searchsorted(reach, ends)
            if not any(a in t for a in self.added for t in texts) and len(reach) and reach[-1] == ends[-1] and (reach[last] == ends).all():
                count = np.diff(last, prepend=-1)
                if mark:
                    ids = ids[np.repeat(np.arange(len(count)) % 2 == 0, count)]
                    count = count[::2]
                return self.held.add(names, ids, count)
        parts = self._library([n.decode() for n in names])
        self.held.add(names, np.concatenate(parts), np.array([len(x) for x in parts]))

    def _pieces(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without added tokens."""
        joined = "".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        data = joined.encode()
        ends = np.cumsum([len(t) for t in texts])
        cut = cuts_plain(code, self.classes, ends)
        at = cut
        if len(data) > len(code):
            wide = np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), dtype=np.int64)
            at = np.concatenate(([0], wide))[cut]
        size = np.diff(at, append=len(data))
        row = self.held.find(data, at, size)
        new = np.flatnonzero(row < 0)
        if len(new):
            names = lambda i: list({data[a:b] for a, b in zip(at[i].tolist(), (at[i] + size[i]).tolist(), strict=True)})
            if self.held.rows + len(new) > self.memory or self.held.used > self.pool:
                new = np.arange(len(at))
                self.held = Answers(max(self.memory, len(new)))
            # a blank and a run follow each other in a text as they are, other runs with line feeds between
            space = self.classes[code[cut[new]]] == SPACE
            blank = space & (code[cut[new]] == 32) & (size[new] > 1)
            blank[blank] = self.classes[code[cut[new[blank]] + 1]] != SPACE
            self._ask(names(new[blank]), "")
            self._ask(names(new[~space]), "\n")
            self._ask(names(new[space & ~blank]), None)
            row[new] = self.held.find(data, at[new], size[new])
        ids, count = self.held.ids(row)
        upto = np.concatenate(([0], np.cumsum(count)))[np.searchsorted(cut, ends)]
        return np.split(ids, upto[:-1])

    def encode(self, texts: list[str], run_chars: int = 1 << 20) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if not self.by_piece or any(a in t for a in self.added)]
        for i, ids in zip(whole, self._library([texts[i] for i in whole]), strict=True):
            out[i] = ids
        rest = [i for i, x in enumerate(out) if x is None]
        got: dict[int, list[np.ndarray]] = {i: [] for i in rest}
        for run in _runs([texts[i] for i in rest], run_chars):
            for (k, _), ids in zip(run, self._pieces([part for _, part in run]), strict=True):
                got[rest[k]].append(ids)
        for i, parts in got.items():
            out[i] = parts[0] if len(parts) == 1 else np.concatenate(parts)
        return out


_LOADED: dict[str, LibraryEncoder] = {}


def encoder(path: str) -> LibraryEncoder:
    """The encoder of a vocabulary file, loaded once in a Python worker; its answers serve all tasks of the worker."""
    if path not in _LOADED:
        _LOADED[path] = LibraryEncoder(path)
    return _LOADED[path]


def compress(ids: np.ndarray, first: int, min_count: int = 8, fall: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair: (sequence, rules as n x 2, expansion lengths); nonterminal ``first + k`` stands for rule k.

    The symbols left are a linked list. A pair of old symbols is never formed
    anew, so one that is too rare once stays so: a round counts only places
    that were frequent before or that the last rounds changed.
    """
    seq = ids.astype(np.uint32)
    size = len(seq)
    nxt, prv = np.arange(1, size + 1), np.arange(-1, size)
    open_ = np.ones(size + 1, bool)  # places whose pair may be frequent; the slot behind the last is for no place
    gone = np.zeros(size, bool)
    rules: list[np.ndarray] = []
    made = 0
    threshold = None
    while size:
        open_[prv[size]] = open_[size] = False
        at = np.flatnonzero(open_)
        if not len(at):
            break
        # both symbols of a pair in one number, of 32 bits as long as they fit
        word, half, odd = (np.uint32, 16, 0x9E3779B1) if first + made <= 1 << 16 else (np.uint64, 32, 0x9E3779B97F4A7C15)
        slot = lambda k, bits: (k * word(odd) >> word(2 * half - bits)).astype(np.int64)  # noqa: B023, E731
        key = (seq[at] if made else seq[:-1]).astype(word)
        key <<= word(half)
        key |= seq[nxt[at]] if made else seq[1:]
        order = np.sort(key)
        edge = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1])))
        count = np.diff(np.append(edge, len(order)))
        most = int(count.max())
        threshold = max(min_count, min(most, threshold or most) // fall)
        if most < min_count:
            break
        if 4 * count[count >= min_count].sum() < 3 * len(at):  # places of rare pairs drop out, but for those that share a slot
            bits = max(8, len(at).bit_length())
            home = slot(key, bits)
            enough = (np.bincount(home, minlength=1 << bits) >= min_count)[home]
            open_[at[~enough]] = False
            at, key = at[enough], key[enough]
        often = np.flatnonzero(count >= threshold)
        often = often[np.argsort(-count[often], kind="stable")]
        pairs = order[edge[often]]
        # table of the chosen pairs; of two that meet in a slot the more frequent stays, the other waits for a later round
        bits = max(8, int(len(pairs) * 8).bit_length())
        own = np.full(1 << bits, -1, np.int64)
        own[slot(pairs, bits)[::-1]] = np.arange(len(pairs))[::-1]
        rank = own[slot(key, bits)]
        held = np.flatnonzero((rank >= 0) & (pairs[rank] == key))
        at, rank = at[held], rank[held]
        # of overlapping occurrences the more frequent pair wins; in a run of one pair every other one
        beside = nxt[at[:-1]] == at[1:]
        left = np.concatenate(([len(pairs)], np.where(beside, rank[:-1], len(pairs))))
        right = np.concatenate((np.where(beside, rank[1:], len(pairs)), [len(pairs)]))
        same, final = left == rank, right != rank
        here = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(same, 0, here))
        take = ((here - begin) % 2 == 0) & ((begin < here) | (rank < left)) & (~final | (rank < right))
        used = np.bincount(rank[take], minlength=len(pairs))
        take &= used[rank] >= 2
        chosen = np.flatnonzero(used >= 2)
        if not len(chosen):
            if threshold <= min_count:
                break
            continue
        name = np.full(len(pairs), 0, np.uint32)
        name[chosen] = first + made + np.arange(len(chosen), dtype=np.uint32)
        rules.append(np.stack([pairs[chosen] >> word(half), pairs[chosen] & word((1 << half) - 1)], 1).astype(np.uint32))
        made += len(chosen)
        hit = at[take]
        drop = nxt[hit]
        seq[hit] = name[rank[take]]
        gone[drop] = True
        nxt[hit] = nxt[drop]
        prv[nxt[hit]] = hit
        open_[drop] = False
        open_[hit] = open_[prv[hit]] = True
    seq = seq[~gone]
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    length = np.ones(first + made, np.uint32)
    start = 0
    for part in rules:  # a rule uses symbols of earlier rounds only
        length[first + start : first + start + len(part)] = length[part[:, 0]] + length[part[:, 1]]
        start += len(part)
    return seq, table, length[first:]


def expand(seq: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    while len(seq) and (big := seq >= first).any():
        seq = expand_once(seq, big, rules, first)
    return seq


def expand_once(seq: np.ndarray, big: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The sequence with the marked nonterminals replaced by their rules' two symbols."""
    at = np.arange(len(seq)) + np.concatenate(([0], np.cumsum(big)[:-1]))
    out = np.empty(len(seq) + int(big.sum()), np.uint32)
    out[at[~big]] = seq[~big]
    out[at[big]], out[at[big] + 1] = rules[seq[big] - first].T
    return out


def dump(out, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> None:
    """Write one shard file."""
    first = int(ids.max()) + 1 if len(ids) else 1
    seq, rules, length = compress(ids, first)
    kind = "<u2" if first + len(rules) <= 1 << 16 else "<u4"
    head = json.dumps({"symbols": kind, "first": first, "rules": len(rules), "sequence": len(seq), "documents": len(doc_ids)}).encode()
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype("<u8")
    out.write(MAGIC + struct.pack("<I", len(head)) + head)
    for part in (rules.astype(kind), length.astype("<u4"), seq.astype(kind), offsets, np.array([d or 0 for d in doc_ids], "<i8"), np.array([d is None for d in doc_ids], np.uint8)):
        out.write(np.ascontiguousarray(part).tobytes())


class Shard:
    """Random access to one shard file.

    Expansions of up to ``SHORT`` ids are written out once, so that most
    symbols are copied instead of being rewritten rule by rule."""

    SHORT = 64

    def __init__(self, file):
        if file.read(8) != MAGIC:
            raise ValueError("not a token shard")
        head = json.loads(file.read(struct.unpack("<I", file.read(4))[0]))
        take = lambda kind, n: np.frombuffer(file.read(np.dtype(kind).itemsize * n), dtype=kind)
        kind, n = head["symbols"], head["documents"]
        self.first = head["first"]
        self.rules = take(kind, 2 * head["rules"]).reshape(-1, 2).astype(np.uint32)
        self.length = np.concatenate((np.ones(self.first, np.uint32), take("<u4", head["rules"])))
        self.seq = take(kind, head["sequence"])
        self.offsets = take("<u8", n + 1).astype(np.int64)
        ids, null = take("<i8", n), take("u1", n)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null, strict=True)]
        self.ends = np.cumsum(self.length[self.seq], dtype=np.int64)
        short = np.flatnonzero(self.length[self.first :] <= self.SHORT) + self.first  # a short rule holds short rules only
        self.table = np.concatenate((np.arange(self.first, dtype=np.uint32), expand(short.astype(np.uint32), self.rules, self.first)))
        self.begin = np.arange(len(self.length))
        self.begin[short] = self.first + np.cumsum(self.length[short], dtype=np.int64) - self.length[short]

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` (inclusive) to ``end`` (exclusive) of the shard."""
        if start >= end:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self.ends, [start, end - 1], side="right")
        skip = start - (int(self.ends[a - 1]) if a else 0)
        seq = self.seq[a : b + 1].astype(np.uint32)
        while (long := self.length[seq] > self.SHORT).any():
            seq = expand_once(seq, long, self.rules, self.first)
        size = self.length[seq].astype(np.int64)
        at = np.repeat(self.begin[seq] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.table[at[skip : skip + end - start]]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.offsets[k]), int(self.offsets[k + 1]))


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = 1 << 20) -> DataFrame:
    """Tokenise and write shard files in ascending id order; returns their manifest.

    Rows are dealt by range of the id (nulls first, equal ids by hash and text), so
    that each task writes a run of the global order as files of about
    ``shard_ids`` ids (a longer document is not cut). Manifest: part, shard,
    uri, documents, n_ids. Null and empty texts hold the end id only. Other
    columns are ignored; an empty table writes no file.
    """
    folder = f"{run_dir(docs.sparkSession)}/token-shards"
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # range bounds come from a sample of the keys on the driver: the text stands there as its hash
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("doc", "h").sortWithinPartitions("doc", "h", "text").drop("h").withColumn("part", F.spark_partition_id())

    def write(batches):
        enc = encoder(tokenizer_path)
        names, sizes, held, total, shard, part = [], [], [], 0, 0, 0
        end = np.array([end_id], np.uint32)

        def flush():
            with fsio.create(folder, f"part-{part:06d}-{shard:06d}", ".rpair") as (uri, out):
                dump(out, names, sizes, np.concatenate(held))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "uri": [uri], "documents": pa.array([len(names)], pa.int64()), "n_ids": pa.array([total], pa.int64())})

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256).to_pydict()
                for doc, part, ids in zip(piece["doc"], piece["part"], enc.encode(piece["text"]), strict=True):
                    names.append(doc)
                    sizes.append(len(ids) + 1)
                    held += (ids, end)
                    total += len(ids) + 1
                    if total >= shard_ids:
                        yield flush()
                        names, sizes, held, total, shard = [], [], [], 0, shard + 1
        if names:
            yield flush()

    return written(rows.mapInArrow(write, "part int, shard int, uri string, documents long, n_ids long"), "token-manifest")


def starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the ids before each shard.

    The driver adds up one number for each task that wrote; shards are summed within their task's group.
    """
    from pyspark.sql import Window

    sums = {r.part: r.n for r in manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, run = [], 0
    for part in sorted(sums):
        before.append((part, run))
        run += sums[part]
    base = manifest.sparkSession.createDataFrame(before, "part int, base long")
    w = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.join(base, "part").withColumn("start", F.col("base") + F.coalesce(F.sum("n_ids").over(w), F.lit(0))).drop("base")


def read_documents(manifest: DataFrame, group: int = 32) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files ``group`` documents at a time."""
    # a file is read in less time than a task takes to start
    rows = spread(starts(manifest).select("uri", "start"), "uri", rows=-(-manifest.count() // 8))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with fsio.reading(row["uri"]) as file:
                    shard = Shard(file)
                off, count = shard.offsets, len(shard.doc_ids)
                sums = []
                for a in range(0, count, group):
                    b = min(count, a + group)
                    ids = shard.ids(int(off[a]), int(off[b])).astype("<u4")
                    sums += [zlib.crc32(ids[int(off[k] - off[a]) : int(off[k + 1] - off[a])].tobytes()) for k in range(a, b)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(shard.doc_ids, pa.int64()),
                    "start": pa.array(row["start"] + off[:-1]),
                    "n_tokens": pa.array(np.diff(off)),
                    "ids_crc32": pa.array(sums, pa.int64()),
                })

    return rows.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
