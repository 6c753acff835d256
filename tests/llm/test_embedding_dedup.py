import numpy as np
import pytest

from brute import least_roots
from riskledger.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, id long, copies int, size string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, "s") for i, v in rows], SCHEMA)


def expected(rows):
    good = [
        (i, np.array(v, np.float32).astype(float))
        for i, v in rows
        if i is not None and v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)
    ]
    ids = [i for i, _ in good]
    x = np.array([v / np.linalg.norm(v) for _, v in good])
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    roots = least_roots(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(close)))])
    links = dict(zip(ids, close.sum(axis=1).tolist()))
    return sorted(
        ((i, links.get(i, 0), roots.get(i, i), i is not None and roots.get(i, i) == i) for i, _ in rows), key=str
    )


def vectors(seed, n=300):
    rnd = np.random.default_rng(seed)
    plain = [(i, rnd.normal(size=16).astype(np.float32).tolist()) for i in range(n)]
    rows = list(plain)
    base = np.array(plain[5][1])
    rows += [(1000 + i, (base + rnd.normal(0, 0.12, 16)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(2000 + i, plain[7][1]) for i in range(20)] + [(3000, [2 * y for y in plain[9][1]])]
    return rows + [(4000, None), (4001, [0.0] * 16), (4002, [float("nan")] * 16), (4003, [1.0] * 3),
                   (4004, [None] + [1.0] * 15), (None, plain[7][1]), (4005, []), (4006, [float("inf")] * 16),
                   (None, None)]


@pytest.mark.parametrize("chunk", [512, 40])
def test_links_and_components(spark, monkeypatch, chunk):
    monkeypatch.setattr(ed, "CHUNK", chunk)
    rows = vectors(1)
    got = sorted(map(tuple, ed.near_duplicates(table(spark, rows)).collect()), key=str)
    wanted = expected(rows)
    found, all_ = sum(r[1] for r in got), sum(r[1] for r in wanted)
    assert [r[0] for r in got] == [r[0] for r in wanted]
    assert all(g[1] <= w[1] for g, w in zip(got, wanted))
    assert found >= 0.9 * all_
    assert sum(g == w for g, w in zip(got, wanted)) >= 0.95 * len(got)


def test_recall_at_the_threshold():
    """Pairs at exactly the threshold, the hardest ones, for several table sizes."""
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rnd.normal(size=x.shape)
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    pair = 0.9 * x + np.sqrt(1 - 0.81) * y
    for n in (5_000, 2_000_000):
        tables = ed.learn_tables(x[:2000], n)
        meet = (tables.keys(x) == tables.keys(pair)).any(axis=1)
        assert meet.mean() >= 0.93


def shifted(rnd, n, dim, cosine):
    """Unit vectors whose mean cosine is about the given one."""
    x = rnd.normal(size=(n, dim)) / np.sqrt(dim) * np.sqrt(1 - cosine)
    x[:, 0] += np.sqrt(cosine)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("cosine", [0.2, 0.5, 0.7])
def test_buckets_of_vectors_far_from_the_origin(cosine):
    rnd = np.random.default_rng(4)
    x = shifted(rnd, 20_000, 64, cosine)
    tables = ed.learn_tables(x[:4000], len(x))
    keys = tables.keys(x)
    largest = max(np.bincount(keys[:, t]).max() for t in range(tables.count))
    assert largest < 5 * len(x) / 2**tables.bits
    # Partners at the threshold with differences of all directions, of vectors not in the sample.
    y = rnd.normal(size=x.shape)
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    pair = 0.9 * x + np.sqrt(1 - 0.81) * y
    assert (keys[4000:] == tables.keys(pair[4000:])).any(axis=1).mean() >= 0.9


@pytest.mark.parametrize("kind", ["shifted", "clustered", "one cluster"])
def test_recall_against_brute_force(spark, kind):
    rnd = np.random.default_rng(5)
    x = shifted(rnd, 400, 16, 0.5)
    if kind == "clustered":
        x = np.concatenate([shifted(rnd, 100, 16, 0.75) * rnd.choice([-1, 1], 16) for _ in range(4)])
    if kind == "one cluster":
        x[:300] = shifted(rnd, 300, 16, 0.88)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    # Chains of partners a little above the threshold.
    rows += [(1000 + i, (v + rnd.normal(0, 0.1, 16)).astype(np.float32).tolist()) for i, v in enumerate(x)]
    got = sorted(map(tuple, ed.near_duplicates(table(spark, rows)).collect()), key=str)
    wanted = expected(rows)
    assert all(g[1] <= w[1] for g, w in zip(got, wanted))
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in wanted) > 0


def test_vectors_all_at_the_mean(spark):
    """Without spread, codes cut at the mean would be noise."""
    rows = [(i, [1.0 * (i + 1)] * 16) for i in range(60)]
    assert {r.n_links for r in ed.near_duplicates(table(spark, rows)).collect()} == {59}


def test_codes_are_balanced():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(3000, 32)) * np.linspace(3, 0.1, 32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    share = (x @ ed.learn_rotation(x, 0) >= 0).mean(axis=0)
    assert ((share > 0.4) & (share < 0.6)).all()


def test_tiny_tables(spark):
    assert ed.near_duplicates(table(spark, [])).count() == 0
    assert [tuple(r) for r in ed.near_duplicates(table(spark, [(1, [1.0, 2.0])])).collect()] == [(1, 0, 1, True)]
    two = ed.near_duplicates(table(spark, [(4, [1.0, 2.0]), (3, [1.0, 2.0])]))
    assert sorted(map(tuple, two.collect())) == [(3, 1, 3, True), (4, 1, 3, False)]


def test_each_length_links_among_itself(spark):
    rnd = np.random.default_rng(8)
    rows = [(i, rnd.normal(size=16).tolist()) for i in range(40)]
    rows += [(100 + i, [1.0, 2.0 + 0.01 * i]) for i in range(3)] + [(200, [1.0, 2.0, 3.0])]
    rows += [(300 + i, rnd.normal(size=8).tolist()) for i in range(20)] + [(320, [2.0, 4.0, 6.0])]
    got = {r.vec_id: r for r in ed.near_duplicates(table(spark, rows)).collect()}
    assert [got[100 + i].n_links for i in range(3)] == [2, 2, 2]
    assert {got[100 + i].component_id for i in range(3)} == {100}
    assert [(got[i].n_links, got[i].component_id) for i in (200, 320)] == [(1, 200)] * 2
    for n in (16, 8):
        own = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if len(v) == n]
        x = np.array([v / np.linalg.norm(v) for _, v in own])
        wanted = (x @ x.T >= 0.9).sum(axis=1) - 1
        assert [got[i].n_links for i, _ in own] == wanted.tolist()


def test_large_components_have_no_square(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.1e200]), (3, [1e-300, 1e-300]), (4, [1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in ed.near_duplicates(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}
