import random

import numpy as np
import pytest

from brute import least_roots, shingle_set
from brute import near_duplicates as expected_of
from riskledger.llm import ngram_join as nj

WORDS = [f"w{k}" for k in range(3000)]


def corpus(seed, near, others, chain):
    rnd = random.Random(seed)
    base = [rnd.choice(WORDS) for _ in range(90)]
    rows = []
    for i in range(near):
        text = base[:]
        for _ in range(rnd.randint(1, 4)):
            text[rnd.randrange(len(text))] = rnd.choice(WORDS)
        rows.append((3 * i + 50, " ".join(text)))
    passage = " ".join(rnd.choice(WORDS) for _ in range(30))
    for i in range(others):
        tail = " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(3, 20)))
        rows.append((3 * i + 51, f"{passage} {tail}"))
        rows.append((3 * i + 52, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 40)))))
    long = [rnd.choice(WORDS) for _ in range(300)]
    rows += [(9000 + i, " ".join(long[5 * i : 5 * i + 90])) for i in range(chain)]
    rows += [(9500 + i, " ".join(base)) for i in range(40)]
    return rows


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


EDGES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one\tTWO"), (6, "one"),
    (7, "É a b c d"), (8, "é a b c d"), (9, "a b c d e f"), (10, "word " * 50_000),
    (11, "word " * 40), (12, "a b c d e f"), (12, "a b c d e f"),
]


def test_edge_cases(documents):
    assert result(nj.near_duplicates(documents(EDGES))) == expected_of(EDGES)


def test_null_ids_link_with_nothing(documents):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (None, None)]
    got = sorted(map(tuple, nj.near_duplicates(documents(rows)).collect()), key=str)
    assert got == sorted([(None, 2, None), (3, 2, 3), (None, 0, None)], key=str)


def test_empty_table(documents):
    assert nj.near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("group", [512, 48])
def test_equals_all_pairs(documents, monkeypatch, group):
    monkeypatch.setattr(nj, "GROUP", group)
    monkeypatch.setattr(nj, "DELEGATING", 6)
    rows = corpus(5, 160, 60, 30)
    assert result(nj.near_duplicates(documents(rows))) == expected_of(rows)


def pages_of_a_template(seed, rows, fields, cities, words=30):
    """Pages of one template with 0 to ``fields`` of their words replaced, some by shared ones."""
    rnd = random.Random(seed)
    page = [rnd.choice(WORDS) for _ in range(words)]
    found = []
    for i in range(rows):
        text = page[:]
        for k in range(rnd.randint(0, fields)):
            at = 7 + 9 * k
            text[at % words] = f"city{rnd.randrange(cities)}" if rnd.random() < 0.5 else f"id{i}x{k}"
        found.append((i, " ".join(text + [f"end{i}"] * rnd.randint(0, 1))))
    return found


@pytest.mark.parametrize("group", [512, 16])
@pytest.mark.parametrize("fields, cities, words", [(1, 5, 30), (2, 40, 40), (3, 4, 90), (3, 60, 60)])
def test_templates_equal_all_pairs(documents, monkeypatch, group, fields, cities, words):
    monkeypatch.setattr(nj, "GROUP", group)
    monkeypatch.setattr(nj, "DELEGATING", 6)
    rows = pages_of_a_template(fields, 200, fields, cities, words)
    assert result(nj.near_duplicates(documents(rows))) == expected_of(rows)


def test_pages_that_differ_too_much_form_no_cluster(spark, documents):
    rnd = random.Random(4)
    page = [rnd.choice(WORDS) for _ in range(31)]
    rows = [(i, " ".join([*page[:15], f"id{i}", *page[16:]])) for i in range(300)]
    docs = documents(rows)
    scratch = nj.Scratch(spark, "template")
    named = docs.select("doc_id", "text").withColumnRenamed("doc_id", "id")
    profiles = docs.select("doc_id", "text").mapInArrow(
        nj._profiles(5, 75), "doc_id bigint, n bigint, d1 bigint, d2 bigint, prefix array<bigint>"
    )
    sets = named.join(
        profiles.select(profiles["doc_id"].alias("id"), "d1", "d2"), "id"
    ).mapInArrow(nj._whole_sets(5), "id bigint, n bigint, shingles array<bigint>")
    found = scratch.write("found", nj._searchable(sets, scratch, 75))
    assert found.count() == 300
    assert nj._clusters(found, scratch, 75, 300).count() == 0


def test_near_copies_with_negative_ids(spark, documents):
    rnd = random.Random(8)
    rows = []
    for i in range(12):
        text = [rnd.choice(WORDS) for _ in range(80)]
        rows += [(k, " ".join([*text[:-1], f"end{k}"])) for k in (-1 - i, -100 - i, 500 + i)]
    # Every row is a piece of its own.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        assert result(nj.near_duplicates(documents(rows))) == expected_of(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def rows_brute(rows):
    """Rows (doc_id, size, component) where an id may have several texts."""
    own = list(enumerate(t for _, t in rows))
    sets = {k: shingle_set(t) for k, t in own}
    links = [
        (rows[a][0], rows[b][0])
        for a in sets
        for b in sets
        if a < b and sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])
    ]
    roots = least_roots([i for i, _ in rows], links)
    return sorted((i, len(sets[k]), roots[i] if sets[k] else i) for k, (i, _) in enumerate(rows))


def test_repeated_rows(documents):
    rnd = random.Random(9)

    def text(n):
        return [rnd.choice(WORDS) for _ in range(n)]

    rows = []
    for i in range(0, 60, 2):
        # A quarter of all shingles in common, and rows twice or three times.
        both = text(44)
        for k in (i, i + 1):
            rows += [(k, " ".join(both + text(60)))] * rnd.choice((2, 2, 3))
    for i in range(100, 140, 4):
        # Two texts under one id, near copies of either, and one text that only it has.
        one, other = text(50), text(70)
        rows += [(i, " ".join(one)), (i, " ".join(other))] * rnd.choice((1, 2))
        rows += [(i + 1, " ".join(one[1:])), (i + 2, " ".join(other[1:])), (i + 3, " ".join(text(60)))]
        rows += [(i + 3, " ".join(other[2:])), (i - 1000, " ".join(text(30)))]
    got = sorted(map(tuple, nj.near_duplicates(documents(rows)).collect()))
    assert got == rows_brute(rows)


def test_keeps_one_of_each_group(documents):
    rows = [(4, "a b c d e f"), (2, "a b c d e f"), (9, "x"), (8, None), (None, "a b c d e f"), (7, "")]
    docs = documents(rows)
    kept = nj.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["2", "9", "8", "None", "7"])


def test_search_finds_every_link_of_a_group():
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 30, rnd.integers(1, 25))) for _ in range(120)]
    ids = np.arange(120) * 7
    sizes = np.array([len(s) for s in sets])
    links = nj.divide_skip(ids, sizes, sets)

    exact = []
    for a in range(120):
        for b in range(a):
            n = len(np.intersect1d(sets[a], sets[b]))
            if 100 * n >= 75 * (sizes[a] + sizes[b] - n):
                exact.append((ids[a], ids[b]))
    assert least_roots(ids.tolist(), links) == least_roots(ids.tolist(), exact)
    asked = rnd.random(120) < 0.3
    some = nj.divide_skip(ids, sizes, sets, queries=asked)
    wanted = [(a, b) for a, b in exact if asked[a // 7] or asked[b // 7]]
    assert least_roots(ids.tolist(), some) == least_roots(ids.tolist(), wanted)
