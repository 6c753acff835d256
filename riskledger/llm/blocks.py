"""Whole texts of an Arrow batch as byte blocks: words, their places and their hashes.

All work is on whole numpy arrays, so the cost per byte is a few nanoseconds. A block
holds complete texts: batches are cut between texts only, so memory is bounded by the
block size or by the longest single text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

try:
    _trim = ctypes.CDLL(None).malloc_trim
except AttributeError:  # a C library without it
    _trim = None

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that belong to words cut at ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes that belong to words of ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Keeps the first so many bytes of a word of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all 64 bits (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def release_memory() -> None:
    """Gives memory that arrays no longer use back to the machine.

    Workers live on from task to task; without this each keeps what its largest batch took.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


@dataclass
class Block:
    """Texts ``first .. first + len(offsets) - 1`` of a batch, as bytes."""

    first: int
    offsets: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def blocks(texts: pa.Array, size: int = BLOCK_BYTES, rows: int = 1 << 20) -> Iterator[Block]:
    """The texts in pieces of about ``size`` bytes; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, width)[texts.offset : texts.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(n, at + rows, max(to, at + 1))
        yield Block(at, offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]])
        at = to


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span.

    Every eight bytes are mixed by themselves, then with their place, and the results summed and
    mixed with the length, so no arrangement of letters cancels out. Spans with equal hashes are
    taken as equal elsewhere: for any two different spans that is wrong once in 2^64.
    """
    sizes = ends - starts
    eight_byte_blocks = (sizes + 7) >> 3
    first = np.cumsum(eight_byte_blocks) - eight_byte_blocks
    place = np.arange(int(eight_byte_blocks.sum())) - np.repeat(first, eight_byte_blocks)
    at = np.repeat(starts, eight_byte_blocks) + 8 * place
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    value = eights[at] & _FIRST[np.minimum(8, np.repeat(ends, eight_byte_blocks) - at)]
    total = np.zeros(len(starts), np.uint64)
    filled = np.flatnonzero(eight_byte_blocks)
    with np.errstate(over="ignore"):
        value = mix(mix(value + _STEP) + place.astype(np.uint64) * _STEP)
        if len(filled):
            total[filled] = np.add.reduceat(value, first[filled])
        return mix(total + sizes.astype(np.uint64) * _STEP)


@dataclass
class Words:
    """Words of a block in order; ``bounds[i]:bounds[i + 1]`` are those of text i."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray


def words(block: Block, inside: np.ndarray) -> Words:
    """Maximal runs of bytes marked in ``inside``, hashed after lower-casing A-Z."""
    data = LOWER[block.data]
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(block) + 1, np.int64), none.astype(np.uint64))
    mask = inside[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[block.offsets] = True
    begins, stops = mask.copy(), mask
    begins[1:] &= ~mask[:-1] | edge[1:-1]
    stops = mask.copy()
    stops[:-1] &= ~mask[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    bounds = np.searchsorted(starts, block.offsets)
    return Words(starts, ends, bounds, hash_spans(data, starts, ends))


def arrow_lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list per text, from flat values and their bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))
