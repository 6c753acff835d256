import random

import pytest

pytest.importorskip("ahocorasick")

from riskledger.llm.pii import BASE, find_spans, join_spans, personal_data_report, redact
from brute import base_spans, sha

PIECES = [*"0123456789012345", "12", "4111 1111 1111 1111", "255", ".", ".", "-", " ", "+", "(",
          ")", "@", "a", "b.c", "://", "x:y@h", "IBAN: DE44500105175407324931", "é", "١", "İ"]


def only_base(spans):
    return [s for s in spans if s[0] in BASE]


def test_base_spans_equal_leftmost_patterns():
    rnd = random.Random(7)
    for _ in range(20_000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30)))
        assert only_base(find_spans(text)) == base_spans(text), text


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("see ftp://bob:s3cret@example.org/x", "login", "bob:s3cret"),
        ("IBAN: DE44 5001 0517 5407 3249 31 thanks", "account", "DE44 5001 0517 5407 3249 31"),
        ("Passport no. X1234567", "account", "X1234567"),
    ],
)
def test_method_adds_spans(text, kind, found):
    assert [text[s:e] for k, s, e in find_spans(text) if k == kind] == [found]


@pytest.mark.parametrize("text", [None, "", "no personal data: 12 a.b @ +1 ://", "account of 2024"])
def test_clean_texts(text):
    assert find_spans(text) == []


def test_added_spans_leave_base_spans_alone():
    text = "ssn: 4111 1111 1111 1111"
    assert find_spans(text) == [("card", 5, 24)]


def test_report_over_rows(spark):
    rows = [(1, "a@b.co " * 3, "k"), (2, None, "k"), (3, "", "k"), (None, "ip 10.0.0.1", None)]
    rows += [(1, "a@b.co " * 3, "k"), (4, "é 1.2.3.4 " + "x" * 300_000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = personal_data_report(df).collect()
    expected = []
    for i, text, _ in rows:
        base = base_spans(text or "")
        counts = [sum(s[0] == k for s in base) for k in BASE]
        expected.append((i, *counts, sha(join_spans(base)), join_spans(find_spans(text))))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_empty_table_and_redaction(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert personal_data_report(empty).count() == 0
    df = spark.createDataFrame([(1, "to a@b.co, 10.0.0.1"), (2, None)], "doc_id long, text string")
    assert [r.text for r in redact(df).orderBy("doc_id").collect()] == ["to <email>, <ip>", None]
