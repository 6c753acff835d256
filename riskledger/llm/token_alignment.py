"""Two tokenizers' tokens of the same texts, grouped where both end, and linked where they overlap.

Tokens are byte ranges. Every token points to the token that reaches farthest to the right among
those it overlaps (of two with the same end the first tokenizer's). Replacing each pointer by the
pointer of what it points to, for all tokens at once, doubles the distance each time; when nothing
moves, every token points to the last one of its connected piece, a token of the first tokenizer
that ends where one of the second does. That token labels the group.

Both vocabularies start anew at a cut of ``segments``, so no group reaches across one: the
distinct segments of a block of texts are encoded, grouped and linked once, and the figures and
digests of a text are put together from its segments.

How many documents hold a pair of linked ids is counted over the whole corpus. Blocks bound what
that takes: a block lists each of its pairs once, with the number of its documents that hold it;
the lists are summed by pair, joined with the pairs of each block again, and a block's documents
meet the counts of their own block only. A frequent pair is one row a block, and a task holds one
block's pairs at a time. Best partners are a maximum per id of the first vocabulary, at most one
row per id of that vocabulary, which bounds what is broadcast.

Defined cases: null and empty texts, and texts that the tokens of either side do not spell (U+2581
in a text, which the pieces spell as a blank), have zeros and an empty digest; strings of special
tokens are ordinary text; repeated rows are documents of their own; ties for the best count are
all best; long texts are handled whole, as a block; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.llm.blocks import Block, blocks, release_memory
from riskledger.llm.segments import (
    ByteLevel,
    Encoder,
    Pieces,
    Shared,
    borders,
    distinct,
    gather,
    with_blank,
)
from riskledger.llm.storage import Scratch

FIRST = "/opt/tokenizers/byte_bpe_50k.json"
SECOND = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text in a block.
BLOCK_BYTES = 3 << 19
#: Bits of the second tokenizer's id in the number of a pair.
SHIFT = 32

_DOCUMENTS = (
    "block BIGINT, doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT,"
    " groups_sha256 STRING, pairs ARRAY<INT>, times ARRAY<INT>,"
    " codes ARRAY<BIGINT>, held ARRAY<INT>"
)
_RESULT = (
    "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT,"
    " count_sum BIGINT, groups_sha256 STRING"
)


def farthest(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For every token, first those of A, then those of B, the place of the last token of its group.

    Ends are ascending byte places; both sides cover the same bytes and end at the same place.
    """
    a_begins, b_begins = (np.r_[0, x[:-1]] if len(x) else x for x in (a_ends, b_ends))
    # The last token of the other side that begins before this one's end reaches that end at least.
    b_of_a = np.searchsorted(b_begins, a_ends, side="left") - 1
    a_of_b = np.searchsorted(a_begins, b_ends, side="left") - 1
    own = np.arange(len(a_ends))
    points = np.r_[np.where(b_ends[b_of_a] > a_ends, len(a_ends) + b_of_a, own), a_of_b]
    while True:
        doubled = points[points]
        if np.array_equal(doubled, points):
            return points
        points = doubled


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in A, place in B) of tokens whose byte ranges overlap, by A and B."""
    if not len(a_ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a_begins, b_begins = np.r_[0, a_ends[:-1]], np.r_[0, b_ends[:-1]]
    lo = np.searchsorted(b_ends, a_begins, side="right")
    n = np.searchsorted(b_begins, a_ends, side="left") - lo
    a = np.repeat(np.arange(len(a_ends)), n)
    return a, np.arange(len(a)) + np.repeat(lo - np.cumsum(n) + n, n)


@dataclass
class Aligned:
    """Segments by number: tokens, groups and links of each, and the links' pairs."""

    right: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    #: Pair numbers of the links, those of segment i at links[i]:links[i + 1].
    pairs: np.ndarray
    links: np.ndarray
    #: The groups as text, that of segment i (with a closing ;) at places[i]:places[i + 1].
    text: np.ndarray
    places: np.ndarray


def align(first: Encoder, second: Encoder, segments: pa.Array) -> Aligned:
    """Groups and links of each segment."""
    a, a_bounds, a_right = first.encode(segments)
    b, b_bounds, b_right = second.encode(segments)
    right = a_right & b_right
    n = len(segments)
    a_of, b_of = (np.repeat(np.arange(n), np.diff(x)) for x in (a_bounds, b_bounds))
    a, a_of = a[right[a_of]], a_of[right[a_of]]
    b, b_of = b[right[b_of]], b_of[right[b_of]]
    a_ends, b_ends = np.cumsum(first.sizes[a]), np.cumsum(second.sizes[b])
    label = farthest(a_ends, b_ends)
    closes = np.zeros(len(a), bool)
    closes[label] = True
    # Groups in order: their last A tokens are in order too.
    group = np.cumsum(closes) - closes
    group_a, group_b = group[label[: len(a)]], group[label[len(a) :]]
    a_at, b_at = overlaps(a_ends, b_ends)
    pairs = a[a_at].astype(np.int64) << SHIFT | b[b_at]
    counts = [np.bincount(x, minlength=n) for x in (a_of, b_of, a_of[closes], a_of[a_at])]
    text, size_a, size_b = spell_groups(a, b, group_a, group_b)
    sizes = np.bincount(a_of, size_a, n).astype(np.int64) + np.bincount(b_of, size_b, n).astype(np.int64)
    return Aligned(
        right, *counts[:3], pairs, np.r_[0, np.cumsum(counts[3])], text, np.r_[0, np.cumsum(sizes)]
    )


def _decimal(ids: np.ndarray) -> np.ndarray:
    """A row of bytes per id: its decimal digits, zero bytes for those it has not, a free byte."""
    width = len(str(int(ids.max()))) if len(ids) else 1
    out = np.zeros((len(ids), width + 1), np.uint8)
    left = ids.astype(np.int64)
    for k in range(width - 1, -1, -1):
        out[:, k] = np.where((left > 0) | (k == width - 1), 0x30 + left % 10, 0)
        left = left // 10
    return out


def spell_groups(a, b, group_a, group_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;`` for all groups, and how many bytes each token takes of them."""
    rows_a, rows_b = _decimal(a), _decimal(b)
    if len(a):
        rows_a[:, -1] = np.where(np.r_[group_a[1:] != group_a[:-1], True], ord("|"), ord(","))
        rows_b[:, -1] = np.where(np.r_[group_b[1:] != group_b[:-1], True], ord(";"), ord(","))
    size_a, size_b = (np.count_nonzero(r, axis=1) for r in (rows_a, rows_b))
    width = max(rows_a.shape[1], rows_b.shape[1])
    out = np.zeros((len(a) + len(b), width), np.uint8)
    # A group's A tokens come behind all B tokens of earlier groups, its B tokens behind its A.
    out[np.arange(len(a)) + np.searchsorted(group_b, group_a, side="left"), : rows_a.shape[1]] = rows_a
    out[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right"), : rows_b.shape[1]] = rows_b
    flat = out.reshape(-1)
    return flat[flat != 0], size_a, size_b


def align_block(first: Encoder, second: Encoder, block: Block) -> dict:
    """Figures of the block's texts (each with its leading blank), and the pairs of each."""
    places = borders(block, b" ")
    which, segments = distinct(block.data, places)
    found = align(first, second, segments)
    n = len(block)
    bounds = np.searchsorted(places[:-1], block.offsets)
    text_of = np.repeat(np.arange(n), np.diff(bounds))
    wrong = np.bincount(text_of, ~found.right[which], n) > 0
    # A blank alone is the empty text, which has no tokens.
    filled = ~wrong & (np.diff(block.offsets) > 1)
    use = filled[text_of]
    which, text_of = which[use], text_of[use]
    figures = {
        name: np.bincount(text_of, values[which], n).astype(np.int64)
        for name, values in (
            ("n_a", found.n_a),
            ("n_b", found.n_b),
            ("n_groups", found.n_groups),
            ("n_links", np.diff(found.links)),
        )
    }
    figures["groups_sha256"] = _digests(found, which, text_of, filled)
    # Each text's distinct segments and their number, then the pairs of these.
    own, times = np.unique(text_of * max(1, len(segments)) + which, return_counts=True)
    text_of, which = np.divmod(own, max(1, len(segments)))
    sizes = np.diff(found.links)[which]
    codes, pair = np.unique(found.pairs, return_inverse=True)
    pair = gather(pair, found.links[:-1][which], sizes)
    key = np.repeat(text_of, sizes) * max(1, len(codes)) + pair
    order = np.argsort(key, kind="stable")
    key, times = key[order], np.repeat(times, sizes)[order]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    times = np.add.reduceat(times, new) if len(new) else times
    text_of, pair = np.divmod(key[new], max(1, len(codes)))
    ends = np.r_[0, np.cumsum(np.bincount(text_of, minlength=n))]
    held = np.bincount(pair, minlength=len(codes))
    # The codes of segments in texts that are left out are not the block's.
    there = held > 0
    place = np.cumsum(there) - there
    return figures | {
        "pairs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[pair], pa.int32())),
        "times": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(times, pa.int32())),
        "codes": codes[there],
        "held": held[there],
    }


def _digests(found: Aligned, which, text_of, filled) -> list[str]:
    """Hex digest of each text's groups; empty for texts without tokens."""
    sizes = np.diff(found.places)[which]
    text = gather(found.text, found.places[:-1][which], sizes).tobytes()
    ends = np.cumsum(np.bincount(text_of, sizes, len(filled)).astype(np.int64))
    out, at = [], 0
    for end, there in zip(ends.tolist(), filled.tolist()):
        # Without the last ;
        out.append(hashlib.sha256(text[at : end - 1]).hexdigest() if there else "")
        at = end
    return out


def alignments(
    docs: DataFrame,
    scratch: Scratch,
    first: str = FIRST,
    second: str = SECOND,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One stored row per document: its figures, and its pairs as places in its block's list.

    The first row of a block carries that list (``codes``) and how many documents hold each.
    """
    spark = docs.sparkSession
    a, b = Shared(spark, ByteLevel, first, False), Shared(spark, Pieces, second)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, doc_ids = with_blank(batch.column("text")), batch.column("doc_id")
            for block in blocks(texts, block_bytes):
                found = align_block(a(), b(), block)
                n, codes, held = len(block), found.pop("codes"), found.pop("held")
                bounds = pa.array(np.r_[0, np.full(n, len(codes))], pa.int32())
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": np.full(n, number, np.int64),
                        "doc_id": doc_ids.slice(block.first, n),
                        **found,
                        "codes": pa.ListArray.from_arrays(bounds, pa.array(codes, pa.int64())),
                        "held": pa.ListArray.from_arrays(bounds, pa.array(held, pa.int32())),
                    }
                )
                number += 1
                del found, codes, held, bounds
                release_memory()

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return scratch.write("documents", source.mapInArrow(run, _DOCUMENTS))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(code, count, best): documents that hold each pair, and whether no pair of its A id has more."""
    listed = aligned.filter(F.size("codes") > 0).select(F.inline(F.arrays_zip("codes", "held")))
    counts = listed.groupBy(F.col("codes").alias("code")).agg(F.sum("held").alias("count"))
    counts = counts.withColumn("a", F.shiftright("code", SHIFT))
    # At most one row per id of the first vocabulary.
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), "a").select(
        "code", "count", (F.col("count") == F.col("most")).alias("best")
    )


def token_pairs(counts: DataFrame) -> DataFrame:
    """``pair_counts`` with the two ids: a table of which tokens stand for each other."""
    return counts.select(
        F.shiftright("code", SHIFT).alias("a"),
        F.col("code").bitwiseAND((1 << SHIFT) - 1).alias("b"),
        "count",
        "best",
    )


def alignment_report(
    docs: DataFrame,
    first: str = FIRST,
    second: str = SECOND,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: tokens, groups and links, how many links are best, and their counts."""
    scratch = Scratch(docs.sparkSession, "alignment")
    aligned = alignments(docs, scratch, first, second, block_bytes)
    counts = scratch.write("counts", pair_counts(aligned))
    listed = aligned.filter(F.size("codes") > 0).select(
        F.col("block").alias("of"), F.posexplode("codes").alias("place", "code")
    )
    known = listed.join(counts, "code").select("of", "place", "count", "best")
    own = aligned.select(
        "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"
    )
    grouped = own.groupBy("block").cogroup(known.groupBy("of"))
    return grouped.applyInArrow(_total, _RESULT)


def _total(texts: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of one block with the sums over their links."""
    place = known.column("place").to_numpy()
    count, best = np.zeros(len(place) + 1, np.int64), np.zeros(len(place) + 1, bool)
    count[place] = known.column("count").to_numpy()
    best[place] = known.column("best").to_numpy()
    pairs, times = (texts.column(c).combine_chunks() for c in ("pairs", "times"))
    pairs, times = (x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks) for x in (pairs, times))
    sizes = np.diff(pairs.offsets.to_numpy())
    at, n = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    sums = [np.r_[0, np.cumsum(n * x[at])] for x in (best, count)]
    bounds = np.r_[0, np.cumsum(sizes)]
    n_best, count_sum = (np.diff(s[bounds]) for s in sums)
    columns = {c: texts.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(
        columns
        | {"n_best": n_best, "count_sum": count_sum, "groups_sha256": texts.column("groups_sha256")}
    )
