"""Aligned tokens against the two libraries and a plain Python grouping."""

import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers

from brute import sha
from riskledger.llm import token_alignment as ta
from riskledger.llm.queries import QUERIES
from riskledger.llm.segments import _byte_letters
from riskledger.llm.storage import Scratch

pytestmark = pytest.mark.skipif(
    not (os.path.exists(ta.FIRST) and os.path.exists(ta.SECOND)), reason="no vocabulary files"
)
LETTERS = _byte_letters()


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(ta.FIRST)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=ta.SECOND)


def piece_bytes(piece):
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def brute(libraries, rows):
    a, b = libraries
    ids_of = {i: t for t, i in a.get_vocab().items()}
    docs, held = [], Counter()
    for doc_id, text in rows:
        tokens_a = tokens_b = []
        if text:
            whole = (" " + text).encode()
            tokens_a = [(i, bytes(LETTERS[c] for c in ids_of[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
            tokens_b = [(i, piece_bytes(b.id_to_piece(i))) for i in b.encode(text)]
            if any(b"".join(t[1] for t in x) != whole for x in (tokens_a, tokens_b)):
                tokens_a = tokens_b = []
        spans = []
        for tokens in (tokens_a, tokens_b):
            at, own = 0, []
            for i, raw in tokens:
                own.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(own)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in own if start <= s and e <= end) for own in spans))
            start = end
        links, k = [], 0
        for i, s, e in spans[0]:
            while k < len(spans[1]) and spans[1][k][2] <= s:
                k += 1
            m = k
            while m < len(spans[1]) and spans[1][m][1] < e:
                links.append((i, spans[1][m][0]))
                m += 1
        held.update(set(links))
        docs.append((doc_id, len(tokens_a), len(tokens_b), len(groups), links, sha(";".join(groups)) if groups else ""))
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    return [(d, na, nb, ng, len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), digest)
            for d, na, nb, ng, links, digest in docs]


ODD = [None, "", " ", "  ", "a", "\n", " a", "▁", "a ▁b", "x <|endoftext|> y", "<s> </s> <unk>", "日本語  テスト", "😀 😀😀", "a\x00 b", "é  é  x　 y",
       "The quick brown fox doesn't jump. " * 30, "ﬁ ½ Å", "a\t b\r\n c  ", "x" * 3000, "same words here", "same words here", "tail  "]


def texts(n):
    rnd = random.Random(7)
    words = "the of tokenization überraschung naïve 12345 re-entry  they're \n\n foo_bar C++ 日本 ... hello,world".split(" ")
    return [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("size", [1 << 20, 300])
def test_documents(documents, libraries, size):
    rows = [(i, t) for i, t in enumerate(ODD + texts(300))] + [(None, "no id"), (3, "same words here")]
    got = ta.alignment_report(documents(rows).repartition(3), block_bytes=size).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(libraries, rows), key=str)


def test_pair_table(spark, documents):
    scratch = Scratch(spark, "pairs")
    rows = [(1, "hello world"), (2, "hello there"), (3, "▁")]
    pairs = ta.token_pairs(ta.pair_counts(ta.alignments(documents(rows), scratch))).collect()
    assert max(r["count"] for r in pairs) == 2 and all(r.best for r in pairs if r["count"] == 2)
    best = defaultdict(int)
    for r in pairs:
        best[r.a] = max(best[r.a], r["count"])
    assert all(r.best == (r["count"] == best[r.a]) for r in pairs)


def test_pointers_end_at_common_ends():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randint(1, 60)
        a, b = (np.array(sorted({*rnd.sample(range(1, n + 1), rnd.randint(0, n)), n})) for _ in "ab")
        common = sorted(set(a.tolist()) & set(b.tolist()))
        label = ta.farthest(a, b)
        for end, target in zip([*a.tolist(), *b.tolist()], label.tolist()):
            assert a[target] == next(c for c in common if c >= end)
        left, right = ta.overlaps(a, b)
        begins = [np.r_[0, x[:-1]] for x in (a, b)]
        pairs = [(i, j) for i in range(len(a)) for j in range(len(b))
                 if begins[0][i] < b[j] and begins[1][j] < a[i]]
        assert list(zip(left.tolist(), right.tolist())) == pairs


def test_empty_table(documents):
    assert ta.alignment_report(documents([])).count() == 0


def test_query(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_token_alignment"](spark, folder).collect()
    assert sorted(map(tuple, got)) == sorted(brute(libraries, rows))
