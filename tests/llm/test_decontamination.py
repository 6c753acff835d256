import random

import pytest

from brute import contamination as expected_of
from riskledger.llm import decontamination as dc

ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve."),
    (2, "short ITEM here"),
    (3, None),
    (4, "  ...  "),
    (5, "one two three four five six seven eight nine ten"),
    (5, "one two three four five six seven eight nine ten"),
    (None, "never counted words"),
    (6, "a a a a a a a a a a a"),
    (7, "naïve ÉCOLE"),
]
DOCS = [
    (1, "x one TWO three, four five six seven eight nine ten; eleven twelve y"),
    (2, "a short item here, a short item here"),
    (3, None),
    (4, ""),
    (5, "one two three four five six seven eight nine eleven ten"),
    (6, "a " * 40),
    (7, "nothing of note"),
    (8, "never counted words"),
    (9, "the naïve École of the naïve ÉCOLE"),
    (10, "filler " * 30_000 + "short item here"),
    (2, "a short item here, a short item here"),
    (None, "short item here"),
]


def rows_of(df):
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted(tuple([r["doc_id"], *[r[c] for c in names]]) for r in df.fillna(-1, ["doc_id"]).collect())


def expected(docs, items):
    found = expected_of(docs, items)
    return sorted((-1 if i is None else i, *f) for (i, _), f in zip(docs, found))


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_counts_and_items(documents, items):
    assert rows_of(dc.contamination_report(documents(DOCS), items)) == expected(DOCS, ITEMS)


def test_blocks_of_windows_and_full_vocabulary(documents, items, monkeypatch):
    monkeypatch.setattr(dc, "WINDOWS_AT_A_TIME", 3)
    monkeypatch.setattr(dc, "VOCABULARY", 2)
    monkeypatch.setattr(dc, "ROWS_AT_A_TIME", 2)
    assert rows_of(dc.contamination_report(documents(DOCS), items)) == expected(DOCS, ITEMS)


def test_random_texts(spark, documents):
    rnd = random.Random(11)
    word = lambda: rnd.choice("abcde")
    items = [(i, " ".join(word() for _ in range(rnd.randint(0, 13)))) for i in range(12)]
    docs = [(i, " ".join(word() for _ in range(rnd.randint(0, 120)))) for i in range(60)]
    docs += [(100 + i, f"{docs[i][1]} {items[i % 12][1]}") for i in range(30)]
    given = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(dc.contamination_report(documents(docs), given)) == expected(docs, items)


def test_proximity_tolerates_small_shifts(documents, items):
    docs = [(1, "one two three four um five six seven eight nine ten"), (2, "ten nine eight one")]
    found = {r.doc_id: r for r in dc.contamination(documents(docs), items).collect()}
    assert not found[1].spans and found[1].n_near > 0
    assert found[2].n_near == 0


def test_dropping(documents, items):
    docs = documents(DOCS)
    kept = dc.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7, 8]


def test_empty_tables(spark, documents, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contamination_report(documents([]), items).count() == 0
    clean = dc.contamination_report(documents(DOCS[:3]), none).collect()
    assert [r.contaminated for r in clean] == [False] * 3
