"""Token files against the tokenizers library, and access to their sequences."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tokenizers

from riskledger.llm import segments as sg
from riskledger.llm import token_files as tf
from riskledger.llm.blocks import blocks
from riskledger.llm.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.exists(tf.VOCABULARY), reason="no vocabulary file")

ODD = [
    "", " ", "  ", "\n", " \n ", "a b", "a  b", "a \n b", "a\n\n b", "é  é  x", "x　 y", "  a",
    "it's  we'll  ' s", "a\x85 b", "a\x1c b", "<|endoftext|>", "a <|endoftext|>  b", "a  <|endoftext|> b", "日本 語  x",
    "x\x7f y", "😀 😀", "a\t b", "ÿ  ÿ ", "tail  ", "tail \n", "́ a", "a\x00 b", "one\r\n two", "word " * 9000,
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tf.VOCABULARY)


def random_texts(n=1500):
    rnd = random.Random(5)
    letters = "ab  \n\t'sé  日😀.,12\x00\x85E-"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def expected_rows(library, rows):
    """In ascending order of doc_id; rows of one doc_id are left in the order given."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_blocks_encode_like_the_library(library):
    own = sg.ByteLevel(open(tf.VOCABULARY).read(), True)
    given = ODD + random_texts()
    for size in (1 << 20, 200):
        got = []
        for block in blocks(pa.array(given, pa.string()), size):
            ids, sizes = tf.encode_block(own, block, 2)
            got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [[*library.encode(t, add_special_tokens=False).ids, 2] for t in given]


def test_special_tokens_as_text(library):
    own = sg.ByteLevel(open(tf.VOCABULARY).read(), False)
    library.encode_special_tokens = True
    ids, bounds, right = own.encode(pa.array([t.encode() for t in ODD if t], pa.binary()))
    got = [x.tolist() for x in np.split(ids, bounds[1:-1])]
    alone = [library.encode(t, add_special_tokens=False).ids for t in ODD if t]
    library.encode_special_tokens = False
    assert right.all()
    # Joined where no cut is safe, tokens may differ; what begins and ends safely may not.
    safe = [i for i, t in enumerate(t for t in ODD if t) if t in ("<|endoftext|>", "a b", "a  b")]
    assert [got[i] for i in safe] == [alone[i] for i in safe]


@pytest.mark.parametrize(("length", "rows"), [(2048, 128), (7, 3)])
def test_documents(spark, documents, library, tmp_path, length, rows):
    given = [(i * 3 % 101 - 50, t) for i, t in enumerate(ODD + random_texts(70))]
    given += [(None, "no id"), (900, None)]
    files = tf.write_tokens(documents(given).repartition(5), str(tmp_path / "t"), length=length, rows=rows)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tf.read_documents(files).collect())
    assert [(i, s, n, c) for s, i, n, c in got] == expected_rows(library, given)
    for row in files.collect():
        file = tf.TokenFile(row.file)
        assert len(file) == row.sequences
        sizes = [file.file.get_batch(k).num_rows for k in range(file.file.num_record_batches)]
        assert all(s == rows for s in sizes[:-1]) and sizes[-1] <= rows
        masks = np.concatenate([file.sequence(i)[1].to_numpy(zero_copy_only=False) for i in range(len(file))])
        assert masks[: row.tokens].all() and not masks[row.tokens :].any()
        last = [file.batch(k).column("last").values for k in range(file.file.num_record_batches)]
        assert sum(x.true_count for x in last) == row.documents


def test_repeated_rows_follow_each_other(documents, tmp_path):
    given = [(5, "same")] * 40 + [(5, "other")] * 2 + [(4, "four"), (6, "six")]
    got = tf.read_documents(tf.write_tokens(documents(given).repartition(4), str(tmp_path))).collect()
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == [4, *[5] * 42, 6]
    assert sum(a.ids_crc32 != b.ids_crc32 for a, b in zip(by_start, by_start[1:])) == 3
    assert all(a.start + a.n_tokens == b.start for a, b in zip(by_start, by_start[1:]))


def test_access_is_without_a_copy(documents, library, tmp_path):
    text = "It was a dark and stormy night. " * 400
    files = tf.write_tokens(documents([(1, text), (2, "b")]), str(tmp_path), length=64, rows=4)
    row = files.first()
    file = tf.TokenFile(row.file)
    ids, mask = file.sequence(9)
    size = os.path.getsize(row.file)
    mapped = file.source.read_buffer(size)
    own = [ids.__array_interface__["data"][0], mask.buffers()[1].address]
    assert all(mapped.address <= x < mapped.address + size for x in own)
    assert len(ids) == len(mask) == mask.true_count == 64
    whole = [*library.encode(text, add_special_tokens=False).ids, 2]
    assert file.tokens(0, len(whole)).tolist() == whole
    assert file.tokens(100, 50).tolist() == whole[100:150]
    with pytest.raises(IndexError):
        file.sequence(len(file))


def test_unlisted_files_are_not_read_and_tidied(documents, tmp_path):
    files = tf.write_tokens(documents([(1, "a"), (2, "b")]), str(tmp_path))
    stray = tmp_path / "part-000000-left-by-a-lost-task.arrow"
    stray.write_bytes(b"half a file")
    assert tf.read_documents(files).count() == 2
    assert tf.tidy(files, str(tmp_path)) == [stray.name] and not stray.exists()
    assert tf.read_documents(files).count() == 2


def test_empty_table(documents, tmp_path):
    files = tf.write_tokens(documents([]), str(tmp_path))
    assert files.count() == 0 and tf.read_documents(files).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in QUERIES["op11_token_files"](spark, folder).collect())
    assert [(i, s, n, c) for s, i, n, c in got] == expected_rows(library, given)
