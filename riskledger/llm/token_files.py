"""Token ids in Arrow files: batches of fixed-size lists, for zero-copy random access.

The documents' ids, each document's closed by an end id, form one stream in ascending order
of doc_id. Spark sorts the texts by range; each task encodes its range and writes its part of
the stream as one Arrow file (a stream of record batches with an index behind it). A row of a
batch is one sequence:

    ids        fixed_size_list<uint16 or uint32>[length]   the narrowest type for the vocabulary
    mask       fixed_size_list<bool>[length]               whether it is a token or padding
    last       fixed_size_list<bool>[length]               whether it is a document's last token
    documents  list<int64>                                 doc_ids whose last token is in this row

Masks are packed, a bit a token.

All batches but the last have the same number of rows and nothing is compressed, so sequence i
is row i % rows of batch i // rows: ``TokenFile`` maps the file and returns views of the mapped
memory, without a copy. A task's last sequence is padded; documents go on from row to row and
batch to batch, and so need no row of their own.

Files carry the number of the task and a random part in their names. The list of files is a
Parquet table that Spark commits: files of lost or repeated attempts are not in it and nobody
reads them. ``tidy`` deletes them. Executors write where the path says, through Arrow's file
systems (local or mounted folders, hdfs, s3, gs).

Defined cases: a null or empty text has the end id alone; rows without a doc_id come first;
rows of the same doc_id follow each other by a hash of their text, repeated rows side by side
(and a doc_id that holds a third of all rows is split between tasks); an empty table makes no
file; long texts are encoded whole, a block of texts or one text at a time; other columns are
ignored. Strings of special tokens inside texts become special tokens, as the library has it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger.llm.blocks import blocks, release_memory
from riskledger.llm.segments import ByteLevel, Shared, borders, distinct, gather
from riskledger.session import materialise, temporary_folder

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Ids of a sequence, and sequences of a batch.
LENGTH = 2048
ROWS = 128
END_ID = 2
#: Marks that a byte-level vocabulary never joins to a letter before them.
MARKS = b".,;:!?"
#: Bytes of text whose distinct segments are encoded together.
BLOCK_BYTES = 4 << 20


def open_folder(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or address, and the path there."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), path


def schema_of(length: int, ids: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("ids", pa.list_(ids, length)),
            ("mask", pa.list_(pa.bool_(), length)),
            ("last", pa.list_(pa.bool_(), length)),
            ("documents", pa.list_(pa.int64())),
        ]
    )


class _Writer:
    """Packs documents into sequences and sequences into batches of one file."""

    def __init__(self, folder: str, part: int, schema: pa.Schema, length: int, rows: int):
        self.fs, self.folder = open_folder(folder)
        self.name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        self.schema, self.length, self.rows = schema, length, rows
        self.dtype = schema.field("ids").type.value_type.to_pandas_dtype()
        self.ids = []  # not yet written, self.waiting ids in all
        self.documents, self.ends = [], []  # their doc_ids, and where each ends in what waits
        self.waiting = self.sequences = self.tokens = self.n_documents = 0
        self.sink = None

    def add(self, doc_ids: np.ndarray, known: np.ndarray, ids: np.ndarray, sizes: np.ndarray):
        """Whole documents: their ids one after the other, and how many each has."""
        ends = np.cumsum(sizes)
        self.ids.append(ids.astype(self.dtype))
        self.ends.append(ends + self.waiting)
        self.documents.append(pa.array(doc_ids, pa.int64(), mask=~known))
        self.waiting += len(ids)
        self.tokens += len(ids)
        self.n_documents += len(sizes)
        if self.waiting >= self.length * self.rows:
            self._write(self.waiting // (self.length * self.rows) * self.rows)

    def _write(self, sequences: int) -> None:
        """Writes the first so many sequences of what waits and keeps the rest."""
        if self.sink is None:
            self.fs.create_dir(self.folder, recursive=True)
            self.sink = self.fs.open_output_stream(f"{self.folder}/{self.name}")
            self.file = pa.ipc.new_file(self.sink, self.schema)
        ids, ends = (np.concatenate(x) for x in (self.ids, self.ends))
        documents = pa.concat_arrays(self.documents)
        n = sequences * self.length
        ready = int(np.searchsorted(ends, n, side="right"))
        self.ids, self.ends = [ids[n:]], [ends[ready:] - n]
        self.waiting, self.documents = max(0, len(ids) - n), [documents[ready:]]
        mask, last = np.arange(n) < len(ids), np.zeros(n, bool)
        last[ends[:ready] - 1] = True
        ids = np.r_[ids[:n], np.zeros(n - min(n, len(ids)), ids.dtype)]
        bounds = np.searchsorted(ends[:ready], np.arange(sequences + 1) * self.length, side="right")
        listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), documents[:ready])
        fields = [
            pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask, last)
        ]
        batch = pa.record_batch([*fields, listed], schema=self.schema)
        for at in range(0, sequences, self.rows):
            self.file.write_batch(batch.slice(at, self.rows))
        self.sequences += sequences

    def close(self) -> None:
        if self.waiting:
            self._write(-(-self.waiting // self.length))
        if self.sink is not None:
            self.file.close()
            self.sink.close()


def write_tokens(
    docs: DataFrame,
    folder: str,
    path: str = VOCABULARY,
    length: int = LENGTH,
    rows: int = ROWS,
    end_id: int = END_ID,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Writes the ids of all documents below ``folder``; returns the list of files.

    (part, file, start, tokens, documents, sequences), one row per file in order of the stream;
    ``start`` is the number of ids before the file's first.
    """
    spark = docs.sparkSession
    encoder = Shared(spark, ByteLevel, path, True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(), TaskContext.get().partitionId()
        kind = pa.uint16() if max(len(own.sizes) - 1, end_id) < 1 << 16 else pa.uint32()
        out = _Writer(folder, part, schema_of(length, kind), length, rows)
        for batch in batches:
            keys = batch.column("doc_id")
            known = keys.is_valid().to_numpy(zero_copy_only=False)
            keys = keys.fill_null(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column("text"), block_bytes):
                ids, sizes = encode_block(own, block, end_id)
                to = block.first + len(block)
                out.add(keys[block.first : to], known[block.first : to], ids, sizes)
            release_memory()
        out.close()
        if out.tokens:
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        "file": f"{folder}/{out.name}",
                        "tokens": out.tokens,
                        "documents": out.n_documents,
                        "sequences": out.sequences,
                    }
                ]
            )

    # Repeated rows are told apart by where they stand in the input, so that tasks share them.
    keys = ["doc_id", "__hash", "__copy"]
    files = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .withColumns({"__hash": F.xxhash64("text"), "__copy": F.monotonically_increasing_id()})
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text")
        .mapInArrow(write, "part BIGINT, file STRING, tokens BIGINT, documents BIGINT, sequences BIGINT")
    )
    written = materialise(files, f"{folder}/files")
    # One row per task that wrote a file: bounded by the number of partitions.
    listed = sorted(written.collect(), key=lambda r: r["part"])
    starts = np.cumsum([0] + [r["tokens"] for r in listed])
    return spark.createDataFrame(
        [(r["part"], r["file"], int(s), r["tokens"], r["documents"], r["sequences"])
         for r, s in zip(listed, starts)],
        "part BIGINT, file STRING, start BIGINT, tokens BIGINT, documents BIGINT, sequences BIGINT",
    )


def encode_block(encoder: ByteLevel, block, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the block's texts, each closed by ``end_id``, and how many each text has."""
    places = borders(block, b" \n", MARKS)
    which, segments = distinct(block.data, places)
    ids, bounds, right = encoder.encode(segments)
    if not right.all():
        raise ValueError("the vocabulary does not spell every text")
    counts = np.diff(bounds)[which]
    body = gather(ids, bounds[:-1][which], counts)
    # Segments of text i are first[i] .. first[i + 1]; empty texts have one border for none.
    before = np.r_[0, np.cumsum(counts)][np.searchsorted(places[:-1], block.offsets)]
    own = np.diff(before)
    out = np.full(len(body) + len(own), end_id, np.int32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(own + 1) - 1] = False
    out[keep] = body
    return out, own + 1


class TokenFile:
    """Random access to the sequences of one file; a local one is mapped, not read."""

    def __init__(self, path: str):
        fs, at = open_folder(path)
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        self.source = pa.memory_map(at) if local else fs.open_input_file(at)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        n = self.file.num_record_batches
        self.rows = self.file.get_batch(0).num_rows
        self.sequences = (n - 1) * self.rows + self.file.get_batch(n - 1).num_rows

    def __len__(self) -> int:
        return self.sequences

    def batch(self, k: int) -> pa.RecordBatch:
        """Batch ``k``, in the memory of the file."""
        return self.file.get_batch(k)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and (packed) mask of sequence ``i``, as views of the file."""
        if not 0 <= i < self.sequences:
            raise IndexError(i)
        batch, at = self.batch(i // self.rows), i % self.rows * self.length
        ids, mask = (batch.column(c).values.slice(at, self.length) for c in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the file on, over as many sequences as that takes."""
        first, last = start // self.length, (start + max(n, 1) - 1) // self.length
        out = np.concatenate([self.sequence(i)[0] for i in range(first, last + 1)])
        return out[start - first * self.length :][:n]

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(doc_id, ids, CRC-32 of the ids as 32-bit integers) of every document, in order."""
        crc = size = 0
        for k in range(self.file.num_record_batches):
            batch = self.batch(k)
            ids, mask, last = (
                batch.column(c).values.to_numpy(zero_copy_only=False) for c in ("ids", "mask", "last")
            )
            ids, owners, at = ids.astype("<u4"), batch.column("documents").flatten(), 0
            for owner, end in zip(owners.to_pylist(), np.flatnonzero(last).tolist()):
                yield owner, size + end + 1 - at, zlib.crc32(ids[at : end + 1], crc)
                crc = size = 0
                at = end + 1
            to = int(np.count_nonzero(mask))
            if to > at:
                crc, size = zlib.crc32(ids[at:to], crc), size + to - at


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the listed files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start, found = row["start"], []
                for doc_id, size, crc in TokenFile(row["file"]).documents():
                    found.append((doc_id, start, size, crc))
                    start += size
                    if len(found) == 10_000:
                        yield _as_batch(found)
                        found = []
                yield _as_batch(found)

    return files.select("file", "start").mapInArrow(
        read, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT"
    )


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    columns = list(zip(*rows)) or [[]] * 4
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)


def tidy(files: DataFrame, folder: str) -> list[str]:
    """Deletes the files below ``folder`` that are not listed, and returns their names.

    Only for after the job: another job's files in the same folder would go as well.
    """
    # One row per file.
    listed = {r["file"].rsplit("/", 1)[1] for r in files.select("file").collect()}
    fs, at = open_folder(folder)
    there = fs.get_file_info(pyarrow.fs.FileSelector(at, allow_not_found=True))
    stray = [x for x in there if x.base_name.endswith(".arrow") and x.base_name not in listed]
    for x in stray:
        fs.delete_file(x.path)
    return [x.base_name for x in stray]


def token_report(spark: SparkSession, docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Writes the files into a folder of this run and reads every document back from them."""
    return read_documents(write_tokens(docs, temporary_folder(spark, "tokens"), path))
