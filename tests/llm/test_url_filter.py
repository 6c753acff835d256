import re

import pytest

from riskledger.llm import url_filter as uf
from riskledger.llm.storage import Scratch

SCHEMA = "page_id long, url string, html string, host string, pages int, kind string"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 1, "k") for i, u, h in rows], SCHEMA)


URLS = [
    ("https://WWW.Example.NET/en/1?x#y", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/de/1", "example.net", "/de/1", "net/", "block"),
    ("http://a.example.com/de/x", "a.example.com", "/de/x", "example.com/de/", "block"),
    ("http://badexample.com/de/x", "badexample.com", "/de/x", None, "allow"),
    ("http://b.org/fr/", "b.org", "/fr/", "org/fr/", "allow"),
    ("http://b.org/fr", "b.org", "/fr", None, "allow"),
    ("http://x.net", "x.net", "", None, "allow"),
    ("http://x.net?q=/en/", "x.net", "", None, "allow"),
    ("x://É.Net/a://b", "É.net", "/a://b", "net/", "block"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("http://user:p@Host.COM:8080/p;x?y", "user:p@host.com:8080", "/p;x", None, "allow"),
]


def test_parts_and_rules(spark):
    rows = [(i, u[0], None) for i, u in enumerate(URLS)] + [(0, URLS[0][0], "x")]
    judged = uf.judged_by_rules(table(spark, rows)).collect()
    for r in judged:
        url, host, path, rule, verdict = URLS[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.decided == (verdict if rule else None)


def link(*hosts):
    return "".join(f'<p><a class="x" href="https://{h}/p">t</a> <a href=/own>o</a>' for h in hosts)


PAGES = [
    (1, "http://good.org/fr/1", link("near.com", "near.com")),
    (2, "http://near.com/a", link("far.com") + "<a href='//far.com/b'>"),
    (3, "http://far.com/a", None),
    (4, "http://bad.net/x", link("victim.com")),
    (5, "http://farm.com/a", link("bad.net", "bad.net")),
    (6, "http://feeder.com/a", link("farm.com")),
    (7, "http://victim.com/a", ""),
    (8, "http://mixed.com/a", link("bad.net", "near.com", *[f"h{i}.com" for i in range(30)])),
    (9, None, link("bad.net")),
    (10, "http://good.org/fr/2", "text only"),
]


def test_distrust_runs_against_the_links(spark):
    got = {r.page_id: r.verdict for r in uf.filter_urls(table(spark, PAGES)).collect()}
    blocked = {i for i, v in got.items() if v == "block"}
    assert blocked == {4, 5, 6}  # the blocked host, who links to it, and who links to that
    assert len(got) == len(PAGES)


def pagerank(edges, seeds):
    nodes = {x for a, b, _ in edges for x in (a, b)} | set(seeds)
    out = {n: sum(w for a, _, w in edges if a == n) for n in nodes}
    s = {n: (1 / len(seeds) if n in seeds else 0.0) for n in nodes}
    r = dict(s)
    for _ in range(uf.ROUNDS):
        flow = {n: 0.0 for n in nodes}
        for a, b, w in edges:
            flow[b] += r[a] * w / out[a]
        back = 1 - sum(flow.values())
        r = {n: 0.15 * s[n] + 0.85 * (flow[n] + back * s[n]) for n in nodes}
    return r


def test_ranks_equal_power_iteration(spark):
    pages = table(spark, PAGES)
    scratch = Scratch(spark, "test")
    edges = scratch.write("edges", uf.host_edges(pages))
    seeds = scratch.write("hosts", uf.host_seeds(uf.judged_by_rules(pages)))
    rows = [tuple(r) for r in edges.select("src", "dst", "pages").collect()]
    assert ("good.org", "near.com", 1) in rows and all(a != b for a, b, _ in rows)
    by_kind = {k: {r.host for r in seeds.collect() if r.kind == k} for k in ("allow", "block")}
    assert by_kind == {"allow": {"good.org"}, "block": {"bad.net"}}
    ranks = {(r.kind, r.host): r["rank"] for r in uf.propagate(edges, seeds, scratch).collect()}
    exact = {("allow", h): v for h, v in pagerank(rows, by_kind["allow"]).items()}
    links = {a: sum(w for x, _, w in rows if x == a) for a, _, _ in rows}
    back = [(b, a, w / links[a]) for a, b, w in rows]
    exact |= {("block", h): v for h, v in pagerank(back, by_kind["block"]).items()}
    for key, value in exact.items():
        assert ranks.get(key, 0.0) == pytest.approx(value, abs=1e-6)


def test_rounds_run_until_nothing_moves(spark, monkeypatch):
    """Two hosts that link to each other: what is left to move shrinks by the damping only."""
    edges = spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, pages long")
    seeds = spark.createDataFrame([("allow", "a")], "kind string, host string")
    ranks = {r.host: r["rank"] for r in uf.propagate(edges, seeds, Scratch(spark, "test")).collect()}
    assert ranks == pytest.approx({"a": 0.15 / (1 - 0.85**2), "b": 0.85 * 0.15 / (1 - 0.85**2)}, abs=1e-6)
    monkeypatch.setattr(uf, "ROUNDS", 2)
    with pytest.raises(RuntimeError, match="still move"):
        uf.propagate(edges, seeds, Scratch(spark, "test"))


def test_host_pattern_against_plain_python():
    pattern = re.compile(uf._HREF.replace("(?i)", ""), re.I)
    html = "<A title='x' HREF = http://A.b/c> <a href='//d.e'> <a href='/f'> <link href='http://no.no'>"
    assert pattern.findall(html) == ["http://A.b/c", "//d.e"]


def test_empty_table(spark):
    assert uf.filter_urls(table(spark, [])).count() == 0
