"""Hashes of spans, and what relies on them, with words built to cancel in a power sum."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from brute import contamination, mirrored_words, near_duplicates
from riskledger.llm import blocks as bl
from riskledger.llm import decontamination as dc
from riskledger.llm import ngram_join as nj
from riskledger.llm import sentencepiece_codec as sc


def test_hashes_go_by_the_bytes_alone():
    rnd = random.Random(1)
    texts = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    hashes = bl.hash_spans(data, ends - [len(t) for t in texts], ends).tolist()
    by_text = dict(zip(texts, hashes))
    assert [by_text[t] for t in texts] == hashes
    assert len(set(by_text.values())) == len(by_text)


def test_words_that_cancel():
    a, b = (w.encode() for w in mirrored_words())
    data = np.frombuffer(a + b, np.uint8)
    own = bl.hash_spans(data, np.array([0, 1024, 0]), np.array([1024, 2048, 2048]))
    assert len(set(own.tolist())) == 3


@pytest.mark.skipif(not os.path.exists(sc.MODEL), reason="no vocabulary file")
def test_codec_tells_them_apart():
    model = sentencepiece.SentencePieceProcessor(model_file=sc.MODEL)
    given = [*mirrored_words(), " ".join(mirrored_words())]
    assert sc.Codec(sc.Vocabulary()).encode(pa.array(given)).to_pylist() == [model.encode(t) for t in given]


def test_join_tells_them_apart(documents):
    a, b = mirrored_words()
    rows = [(1, a), (2, b), (3, f"{a} x y z w v"), (4, f"{b} x y z w v"), (5, a)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.near_duplicates(documents(rows)).collect()}
    assert got == near_duplicates(rows)


def test_decontamination_tells_them_apart(spark, documents):
    a, b = mirrored_words()
    rows, items = [(1, a), (2, f"say {b}"), (3, "x")], [("i", a)]
    table = spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: r for r in dc.contamination_report(documents(rows), table).collect()}
    wanted = {i: row for (i, _), row in zip(rows, contamination(rows, items))}
    assert {i: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for i, r in got.items()} == wanted
