from collections import Counter, defaultdict

from riskledger.llm import line_dedup as ld


def expected(rows, ratio, min_pages):
    hosts, seen = Counter(), defaultdict(Counter)
    for host, text in {(host, text) for _, text, _, host in rows}:
        hosts[host] += 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            seen[host][line] += 1
    out = []
    for i, text, _, host in rows:
        if text is None:
            out.append((i, host, 0, 0, None))
            continue
        lines = text.split("\n")
        bad = lambda x: (n := seen[host][x.strip(" ")]) >= min_pages and n / hosts[host] > ratio
        kept = [x for x in lines if not x.strip(" ") or not bad(x)]
        out.append((i, host, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "source", "n_lines", "n_dropped", "text").collect()), key=str)


def pages():
    rows = [(i, f"Home | About\nstory {i}\n  Home | About  \n\n© site", None, "a") for i in range(12)]
    rows += [(100 + i, f"Home | About\nother {i}" if i < 2 else f"only {i}\n", None, "b") for i in range(30)]
    rows += [(200 + i, "all the same", None, None) for i in range(6)]
    return rows + [(300, None, None, "a"), (301, "", None, "a"), (302, "x" * 200_000, None, "b"),
                   (0, rows[0][1], None, "a"), (None, "© site", None, "a")]


def test_equals_counting_by_hand(documents):
    rows = pages()
    for ratio, least in ((0.1, 5), (0.5, 2), (0.0, 1)):
        assert rows_of(ld.line_report(documents(rows), ratio, least)) == expected(rows, ratio, least)


def test_without_broadcast(documents, monkeypatch):
    import riskledger.llm.storage as storage

    monkeypatch.setattr(storage, "BROADCAST_BYTES", -1)
    rows = pages()
    assert rows_of(ld.line_report(documents(rows))) == expected(rows, ld.RATIO, ld.MIN_PAGES)


def test_stage_keeps_columns_and_counts_characters(documents):
    docs = documents(pages())
    cleaned = ld.drop_boilerplate(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    for r in cleaned.filter("text IS NOT NULL").collect():
        assert r.n_chars == len(r.text)


def test_empty_table_and_native_plan(documents):
    assert ld.line_report(documents([])).count() == 0
    plan = ld.line_report(documents(pages()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_copies_keep_their_lines(documents):
    """Copies that hold most of a host are one page; what stands on different texts goes."""
    copied = "menu\na story told often\nits second line"
    rows = [(i, copied, None, "a") for i in range(30)]
    rows += [(100 + i, f"menu\nstory {i}", None, "a") for i in range(12)]
    got = {r.doc_id: r.text for r in ld.line_report(documents(rows)).collect()}
    assert {got[i] for i in range(30)} == {"a story told often\nits second line"}
    assert [got[100 + i] for i in range(12)] == [f"story {i}" for i in range(12)]


def test_columns_with_the_names_used_inside(documents):
    docs = documents(pages())
    plain = ld.drop_boilerplate(docs)
    names = ["kept", "site", "boilerplate", "_kept", "lines", "host", "__kept", "__host", "__lines", "n_lines"]
    clashing = docs.selectExpr("*", *[f"1 AS `{n}`" for n in names if n not in docs.columns])
    cleaned = ld.drop_boilerplate(clashing)
    assert cleaned.columns == clashing.columns
    assert sorted(cleaned.select(*docs.columns).collect(), key=str) == sorted(plain.collect(), key=str)
