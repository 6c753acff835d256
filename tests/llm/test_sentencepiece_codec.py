import os
import random

import pyarrow as pa
import pytest

sentencepiece = pytest.importorskip("sentencepiece")

from riskledger.llm import sentencepiece_codec as sc  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.exists(sc.MODEL), reason="no vocabulary file")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=sc.MODEL)


@pytest.fixture(scope="module")
def codec():
    return sc.Codec(sc.Vocabulary())


def texts(model):
    rnd = random.Random(3)
    letters = "ab  ▁\n\tétheion日本𠀀😀\x00.,1239-THE_"
    some = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    pieces = [
        model.id_to_piece(rnd.randrange(259, model.vocab_size())).replace("▁", " ")
        for _ in range(5000)
    ]
    some += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 15))) for _ in range(3000)]
    some += ["", " ", "  ", "▁", "\n", "a" * 3000, "aaa " * 50, "ha" * 200, None, " " * 100 + "x"]
    return some + ["é" * 100, "one very long text " * 20_000]


def test_ids_equal_those_of_the_library(model, codec):
    given = texts(model)
    expected = [None if t is None else model.encode(t) for t in given]
    assert codec.encode(pa.array(given, pa.string())).to_pylist() == expected
    # Again, now that segments and pairs are remembered.
    assert codec.encode(pa.array(given, pa.string())).to_pylist() == expected


def test_small_suffix_arrays_and_tables(model, codec, monkeypatch):
    monkeypatch.setattr(sc, "SUFFIX_BYTES", 200)
    monkeypatch.setattr(sc, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(sc, "PAIR_BITS", 6)
    monkeypatch.setattr(sc, "KEPT_SEGMENTS", 10)
    given = texts(model)[1300:1700]
    fresh = sc.Codec(codec.v)
    assert fresh.encode(pa.array(given, pa.string())).to_pylist() == [model.encode(t) for t in given]


def test_round_trip(model, codec):
    given = texts(model)
    back = codec.decode(codec.encode(pa.array(given, pa.string()))).to_pylist()
    assert back == [None if t is None else t.replace("▁", " ") for t in given]


def test_decoding_ids_that_are_no_text(codec):
    raw = int(codec.v.byte_ids[0xFF])
    assert codec.decode(pa.array([[raw], [], None, [1, 2]])).to_pylist() == ["\ufffd", "", None, ""]


def test_documents(documents, model):
    rows = [(1, "The cat"), (2, None), (3, ""), (None, "déjà\nvu"), (1, "The cat"), (4, "x" * 99)]
    got = sc.encode_documents(documents(rows)).collect()
    expected = [(i, len(ids := model.encode(t) if t else []), None if t is None else ids) for i, t in rows]
    assert sorted(((r.doc_id, r.n_tokens, r.ids) for r in got), key=str) == sorted(expected, key=str)
    assert all(r.round_trip for r in got)
    assert sc.encode_documents(documents([])).count() == 0
