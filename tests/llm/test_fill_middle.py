"""Fill-in-the-middle texts against plain Python."""

import hashlib
import random
import re

import pytest

from brute import sha
from riskledger.llm import fill_middle as fm

ODD = ["", None, "\n", "\n\n", "a", "a\n", "a\nb", "é\n日本\n😀😀\nz", "x<P>y\nz", "<S>\nq", "a\n<M>", "<P\n<P\n>S>\n<",
       "\r\n\x00\nä b\n", "no end " * 9000, "ü😀\n" * 5000, "<\nP>\n<S\n>"]


def expected(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    h = [int(hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    cuts = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(u) for u in (units[: cuts[0]], units[cuts[0] : cuts[1]], units[cuts[1] :]))
    if doc_id is None or not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (doc_id, len(units), "plain", None, None, text)
    if h[3] % 100 < spm:
        return (doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def texts():
    rnd = random.Random(11)
    some = ["".join(rnd.choice("ab\n\né日😀<P>SM") for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    return ODD + some


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (40, 0), (0, 100)])
def test_outputs(documents, rate, spm):
    rows = [(i - 5 if i != 9 else None, t) for i, t in enumerate(texts())]
    rows += rows[20:23]
    settings = fm.Settings(rate=rate, suffix_first=spm)
    got = fm.fill_in_middle(documents(rows).repartition(3), settings).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(*r, rate, spm) for r in rows), key=str)
    for r in got:
        assert fm.restore(r.output, r.form) == next((t or "") for i, t in rows if i == r.doc_id)


def test_report(documents):
    rows = list(enumerate(texts()))
    got = fm.fill_report(documents(rows)).collect()
    wanted = []
    for i, t in rows:
        *head, output = expected(i, t)
        wanted.append((*head, sha(output), sha(t or "")))
    assert sorted(map(tuple, got)) == sorted(wanted)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_blocks_of_any_size(documents, monkeypatch):
    rows = list(enumerate(texts()))
    monkeypatch.setattr(fm, "blocks", lambda t, size=64: __import__("riskledger.llm.blocks", fromlist=["x"]).blocks(t, 64))
    import numpy as np
    import pyarrow as pa

    found = []
    for block in fm.blocks(pa.array([t for _, t in rows], pa.string())):
        cut = fm.cut_block(block, list(range(block.first, block.first + len(block))), fm.Settings())
        found += list(zip(np.asarray(cut["n"]).tolist(), cut["form"], cut["output"].to_pylist()))
    assert found == [(n, form, out) for _, n, form, _, _, out in (expected(*r) for r in rows)]


def test_empty_table(documents):
    assert fm.fill_report(documents([])).count() == 0
