"""Texts cut where no token of a byte-level or piece vocabulary reaches across, and encoded once.

A cut is made before a blank that follows a character which is surely no white space. Both
kinds of vocabulary start a new run there, so the tokens of a text are those of its segments,
one after the other. A block's distinct segments (compared as bytes, not by a hash) are joined
again, still only at such places, and given to the library a few thousand at a time; the bytes
of the tokens tell where each segment's own begin.
"""

from __future__ import annotations

import re
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark.sql import SparkSession

from riskledger.llm.blocks import Block
from riskledger.llm.storage import bound_batches

#: Bytes that a library encodes as one text.
JOINED_BYTES = 800
#: Segments that a worker remembers from block to block, and the longest it remembers.
KEPT, KEPT_BYTES = 400_000, 40

#: ASCII characters that are neither white space nor control characters.
_SOLID = np.zeros(256, dtype=bool)
_SOLID[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def borders(block: Block, before: bytes = b" ", marks: bytes = b"") -> np.ndarray:
    """Places where segments begin, and the end of the block; texts always begin one.

    A segment begins at a byte of ``before`` that follows a printable ASCII character or a
    two-byte character from U+00C0 on: none of these is white space in any vocabulary's eyes.
    With ``marks``, also at one of these bytes that follows an ASCII letter (for vocabularies
    that never join the two).
    """
    data = block.data
    solid = _SOLID[data]
    solid[1:] |= (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    cut = np.zeros(len(data) + 1, dtype=bool)
    begins = np.zeros(256, dtype=bool)
    begins[list(before)] = True
    cut[1:-1] = begins[data[1:]] & solid[:-1]
    if marks:
        mark = np.zeros(256, dtype=bool)
        mark[list(marks)] = True
        cut[1:-1] |= mark[data[1:]] & _LETTER[data[:-1]]
    cut[block.offsets] = True
    return np.flatnonzero(cut)


def _ends_solid(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether each span ends with a character a cut may follow."""
    last = places[1:] - 1
    lead = data[np.maximum(last - 1, 0)]
    two = (places[1:] - places[:-1] > 1) & (lead >= 0xC3) & (lead < 0xE0)
    return _SOLID[data[last]] | two


def distinct(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For each segment its number among the distinct ones, and these."""
    segments = pa.Array.from_buffers(
        pa.binary(),
        len(places) - 1,
        [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))],
    ).dictionary_encode()
    return segments.indices.to_numpy(zero_copy_only=False), segments.dictionary


def flat_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and where each begins (and the last ends)."""
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int32)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]] if len(values) else (
        np.zeros(0, np.uint8)
    )
    return data, offsets.astype(np.int64) - int(offsets[0])


def gather(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``data[begin : begin + size]``, one after the other."""
    shift = np.repeat(begin - np.cumsum(sizes) + sizes, sizes)
    shift += np.arange(len(shift))
    return data[shift]


class Encoder:
    """Token ids of segments. ``sizes`` and ``spelled`` give the bytes each id stands for."""

    def __init__(self, spellings: list[bytes]):
        self.sizes = np.array([len(s) for s in spellings], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.spelled = np.frombuffer(b"".join(spellings), np.uint8)
        self.known = pa.array([], pa.binary())
        self.known_ids = np.zeros(0, np.int32)
        self.known_bounds = np.zeros(1, np.int64)

    def _encode(self, joined: list[bytes]) -> list[list[int]]:
        raise NotImplementedError

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.spelled, self.begins[ids], self.sizes[ids])

    def encode(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct segments, where each one's begin, and which are spelled by their ids.

        Ids of a segment that isn't are left out.
        """
        at = pc.index_in(segments, self.known)
        new = at.is_null().to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy(zero_copy_only=False)
        fresh = segments.filter(pa.array(new))
        ids, bounds, fits = self._encode_new(fresh)
        right = np.ones(len(segments), bool)
        right[new] = fits
        begins, counts = np.zeros(len(segments), np.int64), np.zeros(len(segments), np.int64)
        begins[~new] = self.known_bounds[at[~new]]
        counts[~new] = np.diff(self.known_bounds)[at[~new]]
        begins[new], counts[new] = bounds[:-1] + len(self.known_ids), np.diff(bounds)
        out = gather(np.concatenate([self.known_ids, ids]), begins, counts)
        self._remember(fresh, ids, bounds, fits)
        return out, np.r_[0, np.cumsum(counts)], right

    def _remember(self, fresh: pa.Array, ids, bounds, fits) -> None:
        short = pc.binary_length(fresh).to_numpy(zero_copy_only=False) <= KEPT_BYTES
        keep = np.flatnonzero(fits & short)[: max(0, KEPT - len(self.known))]
        if not len(keep):
            return
        counts = np.diff(bounds)[keep]
        self.known = pa.concat_arrays([self.known, fresh.take(pa.array(keep))])
        self.known_bounds = np.r_[self.known_bounds, self.known_bounds[-1] + np.cumsum(counts)]
        self.known_ids = np.r_[self.known_ids, gather(ids, bounds[:-1][keep], counts)]

    def _encode_new(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segments are joined where a cut would be safe; those that begin or end otherwise (a
        text's first and last) are encoded by themselves.
        """
        n = len(segments)
        data, places = flat_bytes(segments)
        joins = (np.isin(data[places[:-1]], [0x20, 0x0A]) & _ends_solid(data, places)) if n else (
            np.zeros(0, bool)
        )
        order = np.r_[np.flatnonzero(joins), np.flatnonzero(~joins)]
        data, places = flat_bytes(segments.take(pa.array(order)))
        # Where each text to encode begins, in numbers of segments.
        joined = int(joins.sum())
        starts = np.r_[
            np.flatnonzero(np.diff(np.r_[-1, places[:joined] // JOINED_BYTES])), np.arange(joined, n)
        ]
        ids, counts, right = self._encode_groups(data, places, starts)
        if not right.all():
            # A segment that isn't spelled by its ids throws those off it is joined with.
            group = np.cumsum(np.isin(np.arange(n), starts)) - 1
            wrong = np.bincount(group, ~right, len(starts)) > 0
            starts = np.flatnonzero(np.isin(np.arange(n), starts) | wrong[group])
            ids, counts, right = self._encode_groups(data, places, starts)
        back = np.argsort(order)
        begins, counts = (np.cumsum(counts) - counts)[back], counts[back]
        return gather(ids, begins, counts), np.r_[0, np.cumsum(counts)], right[back]

    def _encode_groups(self, data, places, starts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all segments, how many each has, and whether they spell it.

        Segments from one of ``starts`` to the next are encoded as one text; if its ids spell
        anything else, or a token reaches across segments, none of these has ids.
        """
        n, edges = len(places) - 1, np.r_[starts, len(places) - 1]
        cuts = places[edges]
        found = self._encode([data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])])
        sizes = np.array([len(x) for x in found], np.int64)
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        group = np.repeat(np.arange(len(found)), sizes)
        right = np.bincount(group, self.sizes[ids], len(found)).astype(np.int64) == np.diff(cuts)
        ids, group = ids[right[group]], group[right[group]]
        ends = np.cumsum(self.sizes[ids])
        first = np.searchsorted(group, np.arange(len(found)))
        ends += (cuts[:-1] - np.r_[0, ends][first])[group]
        # Byte by byte, in the groups of the right size.
        spelled = self.bytes_of(ids)
        given = gather(data, cuts[:-1][right], np.diff(cuts)[right])
        if len(given) and not np.array_equal(spelled, given):
            owner = np.repeat(np.flatnonzero(right), np.diff(cuts)[right])
            right[owner[spelled != given]] = False
        of = np.searchsorted(edges, np.arange(n), side="right") - 1
        last = np.searchsorted(ends, places[1:], side="right") - 1
        meets = (last >= 0) & (np.r_[ends, -1][last] == places[1:])
        right[of[~meets]] = False
        counts = np.diff(np.r_[0, np.where(last >= 0, last + 1, 0)]) * right[of]
        return ids[right[group]], counts, right[of]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 stands for itself, the rest for the letters from U+0100 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class ByteLevel(Encoder):
    """A byte-level vocabulary of the tokenizers library, given as its file's content.

    With ``specials`` the strings of special tokens inside texts become these tokens, as the
    library has it by default; without, they are ordinary text.
    """

    def __init__(self, content: str, specials: bool):
        self.tokenizer = tokenizers.Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = not specials
        letters = _byte_letters()
        added = self.tokenizer.get_added_tokens_decoder()
        names = sorted(self.tokenizer.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        spellings = [b""] * (names[-1][1] + 1)
        for name, i in names:
            spellings[i] = name.encode() if i in added else bytes(letters[c] for c in name)
        super().__init__(spellings)

    def _encode(self, joined):
        texts = [x.decode() for x in joined]
        return [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


class Pieces(Encoder):
    """A SentencePiece model that puts a blank before a text: segments begin with that blank."""

    def __init__(self, content: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        spellings = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"piece {piece} reaches across a cut")
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            spellings.append(
                bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()
            )
        super().__init__(spellings)

    def _encode(self, joined):
        found = self.model.encode([x[1:].decode() for x in joined], num_threads=1)
        # The library gives an empty text no blank; a blank at a text's end is a piece.
        blank = self.model.piece_to_id("▁")
        return [[blank] if x == b" " else ids for x, ids in zip(joined, found)]


#: Encoders of this worker process, by name.
_encoders: dict[str, Encoder] = {}


class Shared:
    """An encoder that executors build once each, from a vocabulary file the driver reads."""

    def __init__(self, spark: SparkSession, kind, path: str, *arguments):
        bound_batches(spark)
        with open(path, "rb") as file:
            content = file.read()
        if kind is ByteLevel:
            content = content.decode()
        self.content = spark.sparkContext.broadcast(content)
        self.kind, self.arguments, self.name = kind, arguments, uuid.uuid4().hex

    def __call__(self) -> Encoder:
        if self.name not in _encoders:
            while len(_encoders) > 3:
                _encoders.pop(next(iter(_encoders)))
            _encoders[self.name] = self.kind(self.content.value, *self.arguments)
        return _encoders[self.name]


def with_blank(texts: pa.Array) -> pa.Array:
    """Every text with a blank before it; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts.fill_null(""), "")
