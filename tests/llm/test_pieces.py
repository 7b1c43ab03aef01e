"""SentencePiece codec against the library: ids, decoded text, spans, normalisation through character maps."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import piece_encode as pe
from tidemark.llm.common import ready

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return pe.codec(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def _spans(starts, ends):
    return list(zip(np.frombuffer(starts, "<u4").tolist(), np.frombuffer(ends, "<u4").tolist(), strict=True))


def _same(codec, library, texts):
    for text, (ids, starts, ends) in zip(texts, codec.encode_many(texts), strict=True):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert codec.decode_packed(ids).decode() == library.decode(want)
        size = len(text.encode())
        assert _spans(starts, ends) == [(0, 0), *[(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces], (size, size)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("abest ▁\n\t 12é漢\x00")), max_size=80))
def test_same_as_the_library(codec, library, text):
    _same(codec, library, [text])


def test_long_and_odd_texts(codec, library):
    texts = ["", " ", "  ", "▁", "▁▁a", " a ", "<s></s><unk><0x0A>", "a" * 5000, "ab " * 5000, "漢" * 300, "\x00", "the" * 40 + " " * 90]
    _same(codec, library, texts)


def test_small_memory_gives_the_same(library):
    with open(PATH, "rb") as file:
        small = pe.PieceCodec(file.read(), memory=3)
    _same(small, library, ["one two three four five", "two two", "six seven eight nine ten", ""])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([0, 1, 2, 131, 198, 255, 28705, 259]), st.integers(0, 31999)), max_size=12))
def test_any_ids_decode_as_in_the_library(codec, library, ids):
    assert codec.decode_packed(np.array(ids, "<u4").tobytes()).decode() == library.decode(ids)


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("dummy", [False, True])
@pytest.mark.parametrize("squeeze", [False, True])
def test_character_maps(rule, dummy, squeeze):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, remove_extra_whitespaces=squeeze, escape_whitespaces=True)
    own = pe.Normaliser(pe.read_model(library.serialized_model_proto()))
    rnd = random.Random(5)
    alphabet = ["a", "Ａ", "ﬁ", "①", " ", "  ", "　", "\xa0", "\x00", "\x07", "\n", "é", "é", "ﷺ", "ｶﾞ", "¨", "▁", "漢", "Å", "ß", "İ"]
    for _ in range(600):
        text = "".join(rnd.choice(alphabet) if rnd.random() < 0.8 else chr(rnd.randrange(32, 0xD800)) for _ in range(rnd.randrange(12)))
        want, places = library.normalize(text, with_offsets=True)
        written, at = own(text)
        assert written.decode() == want
        if want:  # the library counts characters, the alignment bytes
            begin = np.cumsum([0, *[len(c.encode()) for c in want]])
            assert [len(text.encode()[: int(at[b])].decode()) for b in begin] == list(places)


def _message(number, value):
    out = bytes([number << 3 | 2]) + bytes([len(value) & 127 | 128, len(value) >> 7]) if len(value) > 127 else bytes([number << 3 | 2, len(value)])
    return out + value


def _model(pieces, trainer, rules):
    import struct

    body = b"".join(_message(1, _message(1, p.encode()) + b"\x15" + struct.pack("<f", s) + bytes([0x18, k])) for p, s, k in pieces)
    return body + _message(2, trainer) + _message(3, rules)


def test_unknown_pieces_crossing_blanks_and_tied_scores():
    """A hand-made model: no byte fallback, a piece with a blank inside, equal scores."""
    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), ("a▁b", -2, 1), ("a▁", -1, 1), ("▁", -9, 1), ("a", -9, 1), ("b", -9, 1), ("aa", -3, 1), ("ab", -3, 1)]
    data = _model(pieces, b"\x18\x02", b"\x18\x00\x20\x00")
    own, library = pe.PieceCodec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    rnd = random.Random(6)
    _same(own, library, ["".join(rnd.choice("aab xy") for _ in range(rnd.randrange(14))) for _ in range(400)])


def test_models_of_other_kinds_are_refused():
    with pytest.raises(ValueError):
        pe.PieceCodec(_model([("<unk>", 0, 2), ("a", 0, 1)], b"\x18\x01", b""))
    with pytest.raises(ValueError):
        pe.PieceCodec(_model([("<unk>", 0, 2), ("a", 0, 4)], b"\x18\x02", b""))


def test_tables(spark, library):
    ready(spark)
    rows = [(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, "word " * 40_000 + "é漢")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, n_tokens int")
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.span_bytes) for r in pe.document_digests(docs, PATH).collect()), key=str)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), len((t or "").encode())))
    assert got == sorted(want, key=str)
    coded = pe.encode_documents(docs, PATH)
    assert coded.columns == ["doc_id", "ids", "starts", "ends"]
    back = coded.select("doc_id", pe.decode(coded["ids"], PATH).alias("text")).collect()
    assert sorted(map(str, back)) == sorted(f"Row(doc_id={i!r}, text={(t or '')!r})" for i, t in rows)
    assert pe.document_digests(docs.limit(0), PATH).collect() == []
