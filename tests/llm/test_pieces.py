"""SentencePiece ids by the prefix table, against the library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from punctua.llm import piece_codec
from punctua.llm.queries import PIECE_BPE, QUERIES

from edge import docs

ODD = [
    "", " ", "  ", "\n", "\n\n a", " \n ", "▁", "▁▁ x", "a▁b", "a" * 3000, " " * 100 + "x" + " " * 37 + "word   two", "();\r\n\r\n{\r",
    "<s></s><unk><0x0A>", "日本語テスト 벨ゼ梦", "\U0001F600 z", "é", "\x00\x01", "\t\ttab", "00112233445566778899 ==== ....", "x " * 500,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


@pytest.fixture(scope="module")
def model():
    return piece_codec.PieceModel(PIECE_BPE)


def ids_of(model, text):
    return np.frombuffer(model.encode(text), "<u4").tolist()


def test_ids_and_texts_equal_the_library(model, library):
    rng = random.Random(5)
    bits = ["a", "b", "e", "r", "t", "s", "in", "ing", "the", " ", "  ", "\n", "\r", ";", "(", ")", "}", "{", "▁", "é", "ß", "日", "1", "00", "//", "==", "\t", "\U0001F600"]
    for text in ODD + ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(3000)]:
        ids = ids_of(model, text)
        assert ids == library.encode(text, add_bos=True, add_eos=True), text
        assert model.decode(ids) == library.decode(ids), text


def test_decode_equals_the_library_on_any_ids(model, library):
    rng = random.Random(6)
    for top in (262, 32_000):
        for _ in range(3000):
            ids = [rng.randrange(top) for _ in range(rng.randint(0, 9))]
            assert model.decode(ids) == library.decode(ids), ids


def test_memory_of_words_and_pairs_may_overflow(library, monkeypatch):
    monkeypatch.setattr(piece_codec, "REMEMBERED", 3)
    model = piece_codec.PieceModel(PIECE_BPE)
    for text in ("one two three four five six seven", "seven eight nine ten one"):
        assert ids_of(model, text) == library.encode(text, add_bos=True, add_eos=True)


def test_odd_rows(spark, library):
    frame = docs(spark)
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in frame.select("doc_id", "text").collect())
    got = piece_codec.encode(frame, PIECE_BPE)
    back = piece_codec.decode(got, PIECE_BPE)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in back.collect()) == texts
    want = sorted((no_id, i, library.encode(t, add_bos=True, add_eos=True)) for no_id, i, t in texts)
    assert sorted((r.doc_id is None, r.doc_id or 0, list(r.ids)) for r in got.collect()) == want
    assert piece_codec.round_trip(frame.limit(0), PIECE_BPE).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert piece_codec.decode(nothing, PIECE_BPE).first().text is None


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    got = QUERIES["op13_sentencepiece_round_trip"](spark, folder).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)


def test_other_models_are_refused():
    # A trainer part with model type 1 (unigram) in place of 2.
    with pytest.raises(ValueError):
        piece_codec._check_settings(bytes([2 << 3 | 2, 2, 3 << 3, 1, 3 << 3 | 2, 0]))
