"""SentencePiece encoding and decoding that keeps the source offsets.

The model file gives the pieces, the normaliser's settings and its compiled
character map (a double-array trie over UTF-8 bytes with the replacements in a
block of strings). Normalisation replaces the longest prefix that the trie
holds, and records for each byte written the source byte it came from. Pieces
are merged inside segments of the normalised text that no piece can cross;
their lengths, added up and looked up in that alignment, give each piece's span
of source bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Fixed values of the file format: the white space symbol and the piece types.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_SPACE = SPACE.encode()
_BPE = 2
_NONE = np.iinfo(np.int64).max


# ------------------------------------------------------------- the model file


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes):
    """(field number, value) pairs of a serialised message; nested messages and strings are bytes."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _number(data, at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = _number(data, at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind} in a model file")
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    kind: int = 1
    byte_fallback: bool = False
    suffix_space: bool = False
    unk_surface: str = " ⁇ "
    char_map: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def read_model(data: bytes) -> Model:
    """Pieces, trainer and normaliser settings of a serialised model."""
    out = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            out.pieces.append(piece.get(1, b"").decode())
            out.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            out.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
            out.kind = trainer.get(3, 1)
            out.suffix_space = bool(trainer.get(24, 0))
            out.byte_fallback = bool(trainer.get(35, 0))
            out.unk_surface = trainer.get(44, out.unk_surface.encode()).decode()
        elif number == 3:
            rules = dict(_fields(value))
            out.char_map = rules.get(2, b"")
            out.dummy_prefix, out.squeeze, out.escape = (bool(rules.get(n, 1)) for n in (3, 4, 5))
    return out


# ------------------------------------------------------------- normalisation


class CharMap:
    """A compiled character map: 4 bytes of trie size, the trie's 32-bit units, the replacements (each ended by a zero)."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units: list[int] = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]
        self.first = np.zeros(256, bool)  # bytes that begin a key
        for byte in range(256):
            if self.units and self._step(0, byte) is not None:
                self.first[byte] = True

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _step(self, node: int, byte: int) -> int | None:
        to = node ^ self._offset(self.units[node]) ^ byte
        return to if to < len(self.units) and self.units[to] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, source bytes) of the longest key that begins at ``at``."""
        found, node = None, 0
        for end in range(at, len(data)):
            node = self._step(node, data[end])
            if node is None:
                break
            unit = self.units[node]
            if unit >> 8 & 1:
                found = (self.units[node ^ self._offset(unit)] & 0x7FFFFFFF, end + 1 - at)
        if found is None:
            return None
        return self.texts[found[0] : self.texts.index(b"\0", found[0])], found[1]


class Normaliser:
    def __init__(self, model: Model):
        self.map = CharMap(model.char_map)
        self.mapped = bool(self.map.first.any())
        self.dummy, self.squeeze, self.escape = model.dummy_prefix, model.squeeze, model.escape
        self.space = _SPACE if model.escape else b" "

    def _chunks(self, data: bytes):
        """(bytes written, source place of each, whole) left to right; a whole chunk is one replacement, others are copied bytes."""
        raw = np.frombuffer(data, np.uint8)
        done = 0
        for at in np.flatnonzero(self.map.first[raw] & (raw & 0xC0 != 0x80)).tolist() if self.mapped else ():
            if at < done:
                continue
            hit = self.map.longest(data, at)
            if hit is None:
                continue
            if at > done:
                yield raw[done:at], np.arange(done, at), False
            done = at + hit[1]
            yield np.frombuffer(hit[0], np.uint8), np.full(len(hit[0]), at), True
        if done < len(raw):
            yield raw[done:], np.arange(done, len(raw)), False

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and the source byte of each with one more entry for the end."""
        data = text.encode("utf-8")
        out, place = [], []
        was_space, start, end = self.squeeze, 0, len(data)
        for chunk, at, whole in self._chunks(data):
            if self.squeeze:
                blank = chunk == 32
                if whole:
                    keep = np.cumsum(~blank) > 0 if was_space else np.ones(len(chunk), bool)
                else:
                    keep = ~(blank & np.concatenate(([was_space], blank[:-1])))
                if not out and not whole and not keep.any():
                    continue
                chunk, at = chunk[keep], at[keep]
                if len(chunk):
                    was_space = bool(chunk[-1] == 32)
            out.append(chunk)
            place.append(at)
        raw = np.concatenate(out) if out else np.zeros(0, np.uint8)
        at = np.concatenate(place).astype(np.int64) if place else np.zeros(0, np.int64)
        if not out:
            return b"", np.array([end])
        if self.squeeze:
            start = self._heading(data)
        if self.dummy:
            raw, at = np.concatenate((np.array([32], np.uint8), raw)), np.concatenate(([start], at))
        if self.escape:
            widths = np.where(raw == 32, 3, 1)
            written = raw.tobytes().replace(b" ", _SPACE)
            at = np.repeat(at, widths)
        else:
            written = raw.tobytes()
        if self.squeeze:
            size = len(written)
            while written.endswith(self.space, 0, size):
                size -= len(self.space)
                end = int(at[size])
            written, at = written[:size], at[:size]
        return written, np.concatenate((at, [end]))

    def _heading(self, data: bytes) -> int:
        """Source bytes before the first one that is not just white space."""
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at) if self.mapped else None
            text, size = hit if hit else (data[at : at + 1], 1)
            if text != b" ":
                break
            at += size
        return at


# ------------------------------------------------------------- merges


class Merges:
    """Which two neighbours join to which piece, and how early: open addressing over (left, right) symbol numbers.

    Symbols are the pieces, and the characters inside pieces that are none
    themselves (numbered after the pieces). A better score gives a lower rank;
    equal scores share one, so the leftmost of them goes first.
    """

    def __init__(self, model: Model):
        plain = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == NORMAL}
        self.symbols = dict(plain)
        for piece in plain:
            for char in piece:
                self.symbols.setdefault(char, len(model.pieces) + len(self.symbols))
        levels = {s: r for r, s in enumerate(sorted({model.scores[i] for i in plain.values()}, reverse=True))}
        self.rank = np.full(max(self.symbols.values(), default=0) + 1, _NONE >> 32, np.int64)
        for i in plain.values():
            self.rank[i] = levels[model.scores[i]]
        self.pairs: dict[tuple[int, int], int] = {}
        for piece, i in plain.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = i
        bits = max(4, (4 * len(self.pairs)).bit_length())
        self.last, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.joined = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        for (left, right), i in self.pairs.items():
            key = left << 32 | right
            at = int(self._home(np.array([key]))[0])
            while self.keys[at] != -1:
                at = (at + 1) & self.last
            self.keys[at], self.joined[at] = key, i

    def _home(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of each pair, -1 where there is none."""
        out = np.full(left.shape, -1, np.int64).ravel()
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left.ravel()[todo] << 32) | right.ravel()[todo]
        at = self._home(key)
        while len(todo):
            held = self.keys[at]
            hit = held == key
            out[todo[hit]] = self.joined[at[hit]]
            on = ~hit & (held != -1)
            todo, key, at = todo[on], key[on], (at[on] + 1) & self.last
        return out.reshape(left.shape)

    def one(self, chars: list[int]) -> list[int]:
        """The symbols left of one long segment: a queue of pairs by rank, then place."""
        n = len(chars)
        symbol, nxt, prv = list(chars), list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = nxt[i] if i >= 0 else n
            if j < n and (to := self.pairs.get((symbol[i], symbol[j]))) is not None:
                heapq.heappush(queue, (int(self.rank[to]), i, symbol[i], symbol[j], to))

        for i in range(n - 1):
            offer(i)
        gone = [False] * n
        while queue:
            _, i, left, right, to = heapq.heappop(queue)
            if gone[i] or symbol[i] != left or nxt[i] >= n or symbol[nxt[i]] != right:
                continue
            j = nxt[i]
            gone[j], symbol[i], nxt[i] = True, to, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            offer(prv[i])
            offer(i)
        return [symbol[i] for i in range(n) if not gone[i]]

    def many(self, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for many short segments, rows of symbols padded with -1: (symbols, how many a row)."""
        out, left = rows.copy(), sizes.copy()
        live, width = np.arange(len(rows)), rows.shape[1]
        if width < 2:
            return out, left
        now, to = out, self.join(out[:, :-1], out[:, 1:])
        while True:
            rank = np.where(to >= 0, self.rank[to], _NONE)
            at = rank.argmin(1)
            every = np.arange(len(live))
            go = rank[every, at] != _NONE
            if not go.all():
                out[live[~go], : now.shape[1]] = now[~go]
                live, at, to, now, every = live[go], at[go], to[go], now[go], np.arange(int(go.sum()))
            if not len(live):
                return out, left
            new = to[every, at]
            # the symbols after the pair move up one place
            moved = np.where(np.arange(width - 1) > at[:, None], now[:, 1:], now[:, :-1])
            moved[every, at] = new
            now = np.concatenate((moved, np.full((len(live), 1), -1)), 1)
            left[live] -= 1
            to = np.concatenate((np.where(np.arange(width - 2) > at[:, None], to[:, 1:], to[:, :-1]), np.full((len(live), 1), -1)), 1)
            to[every, at] = self.join(new, now[every, np.minimum(at + 1, width - 1)])
            back = np.flatnonzero(at)
            to[back, at[back] - 1] = self.join(now[back, at[back] - 1], new[back])


# ------------------------------------------------------------- the codec


class PieceCodec:
    """Encoder and decoder of one BPE model.

    Segments seen are kept with their packed ids, ``memory`` of them at most; the others of a run of texts are merged together.
    Models with user-defined or unused pieces, with white space as a suffix
    and those that are not BPE are refused.
    """

    def __init__(self, data: bytes, memory: int = 500_000):
        model = read_model(data)
        if model.kind != _BPE or model.suffix_space or {USER_DEFINED, UNUSED} & set(model.kinds):
            raise ValueError("only BPE models without user-defined or unused pieces, white space in front, are read")
        self.model, self.normalise, self.merges = model, Normaliser(model), Merges(model)
        self.unk = model.kinds.index(UNKNOWN)
        self.begin, self.end = (model.pieces.index(p) if p in model.pieces else None for p in ("<s>", "</s>"))
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == BYTE}
        crossed = any(SPACE in p.lstrip(SPACE) for p, k in zip(model.pieces, model.kinds, strict=True) if k == NORMAL)
        #: No piece goes on after a non-blank with a blank, so text falls into blanks with what follows them.
        self.segment = re.compile("(?s).+" if crossed or not model.escape else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.memory, self.held = memory, {}
        self.plain = not self.normalise.mapped and not model.squeeze and model.escape
        self.silent = np.array(model.kinds) == CONTROL
        self.sizes = np.array([len(p.encode()) if k == NORMAL else 0 for p, k in zip(model.pieces, model.kinds, strict=True)], np.int64)
        self.byte_of = np.full(len(model.pieces), -1, np.int64)
        for byte, i in self.byte_ids.items():
            self.byte_of[i] = byte
        self.surface = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else model.unk_surface.encode() if k == UNKNOWN else p.replace(SPACE, " ").encode()
            for p, k in zip(model.pieces, model.kinds, strict=True)
        ]

    # -- segments

    def _pack(self, chars: str, symbols: list[int]) -> bytes:
        """Packed ids; characters that are no piece become bytes or the unknown id."""
        ids, at = [], 0
        for symbol in symbols:
            if 0 <= symbol < len(self.model.pieces):
                ids.append(symbol)
                at += len(self.model.pieces[symbol])
                continue
            ids += [self.byte_ids[b] for b in chars[at].encode()] if self.model.byte_fallback else [self.unk]
            at += 1
        return np.array(ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        number, pieces = self.merges.symbols.get, len(self.model.pieces)
        by_width: dict[int, list[str]] = {}
        for seg in new:
            if len(seg) > 32:
                self.held[seg] = self._pack(seg, self.merges.one([number(c, -1) for c in seg]))
            else:
                by_width.setdefault((len(seg) + 1) // 2 * 2, []).append(seg)
        for width, segs in by_width.items():
            for k in range(0, len(segs), 40_000):
                part = segs[k : k + 40_000]
                sizes = np.fromiter(map(len, part), np.int64, len(part))
                code = np.frombuffer("".join(s.ljust(width, "\0") for s in part).encode("utf-32-le"), "<u4").reshape(len(part), width)
                seen, where = np.unique(code, return_inverse=True)
                rows = np.array([number(chr(c), -1) for c in seen.tolist()], np.int64)[where].reshape(code.shape)
                rows[np.arange(width) >= sizes[:, None]] = -1
                symbols, n = self.merges.many(rows, sizes)
                inside = np.arange(width) < n[:, None]
                known = ~(inside & ((symbols < 0) | (symbols >= pieces))).any(1)
                packed = symbols[inside & known[:, None]].astype("<u4").tobytes()
                stop = (4 * np.cumsum(np.where(known, n, 0))).tolist()
                self.held.update(zip(part, [packed[a:b] for a, b in zip([0, *stop[:-1]], stop, strict=True)], strict=True))
                for r in np.flatnonzero(~known).tolist():
                    self.held[part[r]] = self._pack(part[r], symbols[r, : n[r]].tolist())

    # -- texts

    def encode_many(self, texts, spans: bool = True, run_chars: int = 1 << 20):
        """Yield (packed ids, packed span starts, packed span ends) of each text, with begin and end ids (null: empty text)."""
        run, size = [], 0
        for t in texts:
            text = t or ""
            run.append(text)
            size += len(text)
            if size >= run_chars:
                yield from self._flush(run, spans)
                run, size = [], 0
        yield from self._flush(run, spans)

    def _flush(self, run: list[str], spans: bool):
        cut = []
        for text in run:
            if not text:
                cut.append((text, None, []))
            elif self.plain:
                written = (SPACE if self.model.dummy_prefix else "") + text.replace(" ", SPACE)
                cut.append((text, None, self.segment.findall(written)))
            else:
                written, at = self.normalise(text)
                cut.append((text, at, self.segment.findall(written.decode())))
        held = self.held
        new = {s for _, _, segs in cut for s in segs if s not in held}
        if len(held) + len(new) > self.memory:
            held.clear()
            new = {s for _, _, segs in cut for s in segs}
        self._learn(list(new))
        for text, at, segs in cut:
            ids = np.frombuffer(b"".join([held[s] for s in segs]), "<u4")
            lens = self._lengths(ids, segs) if spans or not self.model.byte_fallback else None
            if not self.model.byte_fallback and (ids == self.unk).any():
                ids, lens = self._one_unknown(ids, lens)
            starts = ends = b""
            if spans:
                if at is None:
                    at = self._plain_places(text)
                place = at[np.concatenate(([0], np.cumsum(lens, dtype=np.int64)))].astype("<u4")
                begin_span = b"" if self.begin is None else self._one(0)
                end_span = b"" if self.end is None else self._one(int(at[-1]))
                starts = begin_span + place[:-1].tobytes() + end_span
                ends = begin_span + place[1:].tobytes() + end_span
            yield self._one(self.begin) + ids.tobytes() + self._one(self.end), starts, ends

    def _lengths(self, ids: np.ndarray, segs: list[str]) -> np.ndarray:
        """Normalised bytes of each piece; of the byte pieces of a character the last has them all."""
        if not self.model.byte_fallback and (ids == self.unk).any():  # not told by the id: walk the characters
            lens = []
            for seg in segs:
                at = 0
                for i in np.frombuffer(self.held[seg], "<u4").tolist():
                    count = 1 if i == self.unk else len(self.model.pieces[i])
                    lens.append(len(seg[at : at + count].encode()))
                    at += count
            return np.array(lens, np.int64)
        lens = self.sizes[ids]
        if self.byte_ids:
            byte = self.byte_of[ids]
            lead = np.flatnonzero((byte >= 0) & (byte & 0xC0 != 0x80))
            if len(lead):
                head = byte[lead]
                size = np.where(head < 0x80, 1, np.where(head < 0xE0, 2, np.where(head < 0xF0, 3, 4)))
                lens[lead + size - 1] = size
        return lens

    @staticmethod
    def _one(i: int | None) -> bytes:
        return b"" if i is None else struct.pack("<I", i)

    def _one_unknown(self, ids: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A run of unknown pieces is one unknown piece."""
        first = np.concatenate(([True], ~((ids[1:] == self.unk) & (ids[:-1] == self.unk))))
        return ids[first], np.add.reduceat(lens, np.flatnonzero(first))

    def _plain_places(self, text: str) -> np.ndarray:
        """Alignment where the character map is empty: every byte stands for itself, a blank is written as three."""
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        at = np.repeat(np.arange(len(raw)), np.where(raw == 32, 3, 1))
        return np.concatenate(([0, 0, 0] if self.model.dummy_prefix and len(raw) else [], at, [len(raw)])).astype(np.int64)

    def decode_packed(self, packed: bytes) -> bytes:
        """UTF-8 text of packed ids; control ids are silent, bytes that form no character become U+FFFD each."""
        codes = np.frombuffer(packed, "<u4")
        apart = self.silent[codes[1:-1]].any()  # a control id between bytes ends their run
        ids = codes.tolist()
        if self.model.dummy_prefix or self.model.squeeze:
            ids, first = self._without_lead(ids)
        else:
            first = b""
        if not apart:
            joined = first + b"".join([self.surface[i] for i in ids])
            if _is_text(joined):
                return joined
        return first + self._mend(ids)

    def _without_lead(self, ids: list[int]) -> tuple[list[int], bytes]:
        """The first piece that shows anything loses its leading blank (all of them where white space is squeezed)."""
        for k, i in enumerate(ids):
            kind = self.model.kinds[i]
            if kind == CONTROL:
                continue
            if kind != NORMAL or not self.model.pieces[i].startswith(SPACE):
                return ids, b""
            rest = self.model.pieces[i][1:]
            if not self.model.squeeze or rest:
                return ids[k + 1 :], rest.replace(SPACE, " ").encode()
        return [], b""

    def _mend(self, ids: list[int]) -> bytes:
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.model.kinds[i] == BYTE:
                run += self.surface[i]
                continue
            while run:
                size = next((n for n in (1, 2, 3, 4) if _is_char(run[:n])), 0)
                out.append(run[:size] if size else "�".encode())
                run = run[max(size, 1) :]
            if i is not None:
                out.append(self.surface[i])
        return b"".join(out)


def _is_text(raw: bytes) -> bool:
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def _is_char(raw: bytes) -> bool:
    return _is_text(raw) and len(raw.decode("utf-8")) == 1


_LOADED: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One codec per Python worker and model file."""
    if path not in _LOADED:
        with open(path, "rb") as file:
            _LOADED[path] = PieceCodec(file.read())
    return _LOADED[path]


# ------------------------------------------------------------- on tables


def encode(text: Column, path: str) -> Column:
    """Struct (ids, starts, ends) of each text: packed little-endian 32-bit ids with begin and end ids, and the span of
    source bytes [start, end) of each. Of the byte pieces of one character the last holds its span. Null: empty text."""

    @pandas_udf("ids binary, starts binary, ends binary")
    def enc(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(list(codec(path).encode_many(texts)), columns=["ids", "starts", "ends"])

    return enc(text)


def decode(ids: Column, path: str) -> Column:
    """Text of packed ids (null: empty)."""

    @pandas_udf("string")
    def dec(packed: pd.Series) -> pd.Series:
        c = codec(path)
        return pd.Series([c.decode_packed(p or b"").decode() for p in packed], dtype=object)

    return dec(ids)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids, starts, ends) of every document.

    One output row per input row, repeated rows and null ids included. Null
    and empty texts have the begin and end ids alone. Texts of any length are
    encoded whole; other columns are ignored; an empty table gives none.
    """
    return docs.select(F.col(id_col), encode(F.col(text_col), path).alias("__e")).select(id_col, "__e.*")


def document_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256, n_spans, span_bytes): ids encoded and decoded again.

    ``n_spans`` pieces have a span that is not empty, ``span_bytes`` is the
    length of all spans: that of the text if they tile it. Edge cases as in
    ``encode_documents``.
    """

    @pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, n_spans long, span_bytes long")
    def told(texts: pd.Series) -> pd.DataFrame:
        c = codec(path)
        rows = []
        for ids, starts, ends in c.encode_many(texts):
            size = np.frombuffer(ends, "<u4").astype(np.int64) - np.frombuffer(starts, "<u4")
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode_packed(ids)).hexdigest(), int((size > 0).sum()), int(size.sum())))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "n_spans", "span_bytes"])

    return docs.select(F.col(id_col), told(F.col(text_col)).alias("__d")).select(id_col, "__d.*")
