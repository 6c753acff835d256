"""SentencePiece encoding and decoding by suffix-array matching.

Texts of a block are cut into segments (a run of blanks and what follows it; no piece spans
two segments), and the distinct segments are joined into one byte string with a suffix
array, built by prefix doubling. Every piece of the vocabulary is looked up in it by binary
search, which gives the range of its occurrences. Occurrences are edges from their start to
their end; sorted by end position, they are relaxed for all segments at once.

For byte-pair models the relaxation keeps the one edge that agrees with the piece before it:
the encoding of a text is the only sequence of pieces in which every neighbouring pair is
what merging the two would leave apart, and it is reached position by position, since every
prefix of an encoding is the encoding of that prefix. So the ids equal those of merging by
score, not those of a best path by sums of scores.

Models: byte-pair with byte fallback, a leading blank, blanks as U+2581 and no other
normalisation. The vocabulary is read on the driver and broadcast: a few MB, whatever the
data. Nothing is shuffled.

Defined cases: null gives null, an empty text no ids; characters without a piece become
their bytes; U+2581 in a text is a blank; long texts and long segments are encoded whole;
repeated rows are encoded each by itself.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger.llm.blocks import Block, blocks, hash_spans, mix, release_memory
from riskledger.llm.storage import bound_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Bytes of text per block, and of distinct segments per suffix array.
BLOCK_BYTES = 1 << 20
SUFFIX_BYTES = 1 << 18
#: Texts whose ids are put together at a time.
TEXTS_AT_A_TIME = 1000
#: Frequent segments remembered by a worker, and the size of its table of pairs of pieces.
KEPT_SEGMENTS = 150_000
PAIR_BITS = 20

_END = 0xFF


class Vocabulary:
    """Pieces as bytes, their ranks, and how each was merged."""

    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.unknown = n  # stands for a character without a piece, until it becomes bytes
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes: list[bytes] = [b""] * n
        names: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.bytes[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                names[piece] = i
                self.bytes[i] = piece.replace(SPACE, " ").encode()
        scored = sorted((x for x in names if len(x) > 1), key=lambda x: -model.get_score(names[x]))
        #: Order in which merges are made; characters come before all merges.
        self.rank = {names[x]: r for r, x in enumerate(scored)}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for x in scored:
            for k in range(1, len(x)):
                a, b = names.get(x[:k]), names.get(x[k:])
                if a is not None and b is not None:
                    self.merged[(a, b)] = names[x]
        made = [i for x, i in names.items() if len(x) == 1]
        for x in scored:
            last = self._last_merge([names.get(c) for c in x], self.rank[names[x]])
            if last:
                self.left[names[x]], self.right[names[x]] = last
                made.append(names[x])
        #: Pieces that merging can produce; only they are matched.
        self.pieces = np.array(sorted(made), np.int64)
        self.isolated = np.zeros(256, bool)
        for value in range(128):
            self.isolated[value] = chr(value).replace(" ", SPACE) not in names

    def _last_merge(self, symbols: list[int | None], rank: int) -> tuple[int, int] | None:
        """The two pieces that merges before ``rank`` leave of a piece's characters."""
        while len(symbols) > 2:
            best, at = rank, -1
            for k in range(len(symbols) - 1):
                whole = self.merged.get((symbols[k], symbols[k + 1]))
                if whole is not None and self.rank[whole] < best:
                    best, at = self.rank[whole], k
            if at < 0:
                return None
            symbols[at : at + 2] = [self.merged[(symbols[at], symbols[at + 1])]]
        a, b = symbols
        return None if a is None or b is None else (a, b)

    def apart(self, a: int, b: int) -> bool:
        """Whether merging the text of two pieces leaves just these two.

        Goes back in time from the final pair, undoing the later merge of the two, and looks
        whether at any moment the pieces at the border would have merged with each other.
        """
        if a == self.unknown or b == self.unknown:
            return True
        limit = len(self.rank) + 1
        while True:
            whole = self.merged.get((a, b))
            if whole is not None and self.rank[whole] < limit:
                return False
            rank_a, rank_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if rank_a > rank_b:
                limit, a = rank_a, self.right[a]
            elif rank_b >= 0:
                # Of equal merges the one further left, at the border, comes first.
                limit, b = rank_b + 1, self.left[b]
            else:
                return True


class Codec:
    """A vocabulary laid out for matching, with what a worker remembers between blocks."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        texts = [vocabulary.bytes[i] for i in vocabulary.pieces]
        self.length = np.array([len(x) for x in texts], np.int64)
        self.n_blocks = -(-int(self.length.max(initial=1)) // 8)
        width = 8 * self.n_blocks
        low = b"".join(x.ljust(width, b"\0") for x in texts)
        high = b"".join(x.ljust(width, b"\xff") for x in texts)
        shape = (len(texts), self.n_blocks)
        self.low = np.frombuffer(low, ">u8").reshape(shape).astype(np.uint64)
        self.high = np.frombuffer(high, ">u8").reshape(shape).astype(np.uint64)
        self.one_char = np.array([len(x.decode()) == 1 for x in texts])
        self.pair_codes = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_apart = np.zeros(1 << PAIR_BITS, bool)
        self.known = np.zeros(0, np.uint64)
        self.known_bounds = np.zeros(1, np.int64)
        self.known_ids = np.zeros(0, np.int32)
        sizes = [len(x) for x in vocabulary.bytes]
        self.byte_bounds = np.cumsum([0, *sizes])
        self.byte_data = np.frombuffer(b"".join(vocabulary.bytes), np.uint8)

    # -- encoding -------------------------------------------------------------------------

    def encode(self, texts: pa.Array) -> pa.Array:
        """Lists of ids of an array of texts."""
        parts = [
            self._encode_some(texts.slice(at, TEXTS_AT_A_TIME))
            for at in range(0, len(texts), TEXTS_AT_A_TIME)
        ]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def encode_and_check(self, texts: pa.Array) -> pa.Array:
        """Structs of the ids and whether they decode to the text, blanks for U+2581."""
        parts = []
        for at in range(0, len(texts), TEXTS_AT_A_TIME):
            some = texts.slice(at, TEXTS_AT_A_TIME)
            ids = self._encode_some(some)
            same = pc.equal(self.decode(ids), pc.replace_substring(some, SPACE, " "))
            parts.append(pa.StructArray.from_arrays([ids, same], ["ids", "round_trip"]))
        kind = pa.struct([("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])
        out = pa.concat_arrays(parts) if parts else pa.array([], kind)
        release_memory()
        return out

    def _encode_some(self, texts: pa.Array) -> pa.Array:
        nulls = np.asarray(pc.is_null(texts))
        spaced = pc.replace_substring(texts.fill_null(""), SPACE, " ")
        empty = np.asarray(pc.equal(spaced, ""))
        spaced = pc.if_else(empty, "", pc.binary_join_element_wise(" ", spaced, ""))
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for block in blocks(spaced, BLOCK_BYTES):
            one, count = self._encode_block(block)
            ids.append(one)
            counts.append(count)
        bounds = np.cumsum(np.r_[0, np.concatenate(counts)])
        offsets = pa.array(
            np.r_[bounds[:-1], bounds[-1]], pa.int32(), mask=np.r_[nulls, False]
        )
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))

    def _encode_block(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        data, n = block.data, len(block.data)
        if n == 0:
            return np.zeros(0, np.int32), np.zeros(len(block), np.int64)
        before = np.r_[np.uint8(0), data[:-1]]
        cut = (data == 0x20) & (before != 0x20)
        alone = self.v.isolated[data]
        cut |= alone
        cut[1:] |= alone[:-1]
        cut[block.offsets[:-1][block.offsets[:-1] < n]] = True
        starts = np.flatnonzero(cut)
        ends = np.r_[starts[1:], n]
        hashes = hash_spans(data, starts, ends)
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        which = np.zeros(len(hashes), np.int64)
        which[order] = np.cumsum(new) - 1
        distinct, first = ordered[new], order[new]
        times = np.bincount(which)
        at = np.searchsorted(self.known, distinct)
        at[at == len(self.known)] = 0
        old = self.known[at] == distinct if len(self.known) else np.zeros(len(distinct), bool)
        new = np.flatnonzero(~old)
        ids, counts = self._encode_segments(data, starts[first[new]], ends[first[new]])
        # All distinct segments: remembered ones first, then the new ones.
        sizes = np.zeros(len(distinct), np.int64)
        begin = np.zeros(len(distinct), np.int64)
        sizes[old] = np.diff(self.known_bounds)[at[old]]
        begin[old] = self.known_bounds[:-1][at[old]]
        sizes[new] = counts
        begin[new] = len(self.known_ids) + np.cumsum(counts) - counts
        pool = np.concatenate([self.known_ids, ids])
        out = _gather(pool, begin[which], sizes[which])
        totals = np.r_[0, np.cumsum(sizes[which])]
        borders = np.searchsorted(starts, block.offsets)
        self._remember(distinct, times, begin, sizes, pool, old)
        return out, np.diff(totals[borders])

    def _remember(self, distinct, times, begin, sizes, pool, old) -> None:
        fresh = np.flatnonzero(~old & (times > 1))[: max(0, KEPT_SEGMENTS - len(self.known))]
        if not len(fresh):
            return
        keys = np.r_[self.known, distinct[fresh]]
        starts = np.r_[self.known_bounds[:-1], begin[fresh]]
        lengths = np.r_[np.diff(self.known_bounds), sizes[fresh]]
        order = np.argsort(keys, kind="stable")
        self.known_ids = _gather(pool, starts[order], lengths[order])
        self.known, self.known_bounds = keys[order], np.r_[0, np.cumsum(lengths[order])]

    def _encode_segments(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments, a suffix array for about ``SUFFIX_BYTES`` of them at a time."""
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        total = np.r_[0, np.cumsum(ends - starts + 1)]
        at = 0
        while at < len(starts):
            to = int(np.searchsorted(total, total[at] + SUFFIX_BYTES, side="right")) - 1
            to = max(to, at + 1)
            one, count = self._match(data, starts[at:to], ends[at:to])
            ids.append(one)
            counts.append(count)
            at = to
        return np.concatenate(ids), np.concatenate(counts)

    def _match(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        lengths = ends - starts
        base = np.cumsum(np.r_[0, lengths + 1])[:-1]
        n = int(base[-1] + lengths[-1] + 1)
        text = np.full(n + 8 * (self.n_blocks + 1), _END, np.uint8)
        flat = np.repeat(base - np.r_[0, np.cumsum(lengths)[:-1]], lengths)
        text[np.arange(len(flat)) + flat] = _gather(data, starts, lengths)
        block = np.zeros(len(text) - 7, np.uint64)
        for k in range(8):
            block = (block << np.uint64(8)) | text[k : len(text) - 7 + k]
        suffixes = self._suffix_array(block, n)
        lo, hi = self._ranges(block, suffixes, n)
        count = hi - lo
        piece = np.repeat(np.arange(len(count)), count)
        start = suffixes[np.repeat(lo - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(len(piece))]
        token, size = self.v.pieces[piece], self.length[piece]
        # Characters without a piece: edges of their own.
        covered = np.zeros(n, bool)
        covered[start[self.one_char[piece]]] = True
        bare = np.flatnonzero(
            ~covered & (text[:n] != _END) & ((text[:n] & 0xC0) != 0x80)
        )
        lead = text[bare]
        width = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
        start = np.r_[start, bare]
        token = np.r_[token, np.full(len(bare), self.v.unknown)]
        size = np.r_[size, width]
        last, origin = self._relax(base, n, start, token, start + size)
        return self._trace(text, base, lengths, last, origin)

    def _suffix_array(self, block: np.ndarray, n: int) -> np.ndarray:
        """Places 0 .. n - 1 by the text from there on, to the length of the longest piece."""
        key, reach = block[:n], 8
        while True:
            order = np.argsort(key)
            if reach >= 8 * self.n_blocks:
                return order
            ordered = key[order]
            rank = np.zeros(n + reach, np.uint64)
            rank[order] = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]])
            key = (rank[:n] << np.uint64(32)) | rank[reach : reach + n]
            reach *= 2

    def _ranges(self, block, suffixes, n) -> tuple[np.ndarray, np.ndarray]:
        """Bounds in the suffix array of the places where each piece occurs."""
        lo = np.zeros(len(self.length), np.int64)
        hi = np.full(len(self.length), n, np.int64)
        for j in range(self.n_blocks):
            more = np.flatnonzero((self.length > 8 * j) & (lo < hi))
            first = _bisect(block, suffixes, 8 * j, self.low[more, j], lo[more], hi[more], False)
            hi[more] = _bisect(
                block, suffixes, 8 * j, self.high[more, j], first, hi[more], True
            )
            lo[more] = first
        return lo, np.maximum(lo, hi)

    def _relax(self, base, n, start, token, end) -> tuple[np.ndarray, np.ndarray]:
        """The last piece at each end position, and where it began."""
        last = np.full(n, -1, np.int64)
        origin = np.full(n, -1, np.int64)
        begin = np.repeat(base, np.diff(np.r_[base, n]))[start]
        offset = end - begin
        if len(offset) and offset.max() < 1 << 16:
            offset = offset.astype(np.uint16)  # numpy sorts these by radix
        order = np.argsort(offset, kind="stable")
        start, token, end, offset = start[order], token[order], end[order], offset[order]
        first = start == begin[order]
        borders = np.r_[0, np.flatnonzero(np.diff(offset)) + 1, len(offset)]
        for s, e in zip(borders[:-1].tolist(), borders[1:].tolist()):
            a, t = last[start[s:e]], token[s:e]
            fits = first[s:e] | ((a >= 0) & self._apart(a, t))
            spot = s + np.flatnonzero(fits)
            last[end[spot]] = token[spot]
            origin[end[spot]] = start[spot]
        return last, origin

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``Vocabulary.apart`` of pairs with a >= 0, through a table of pairs seen before."""
        codes = a * (self.v.unknown + 1) + b
        with np.errstate(over="ignore"):
            slot = (mix(codes.view(np.uint64)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        fits = self.pair_apart[slot]
        missing = np.flatnonzero((self.pair_codes[slot] != codes) & (a >= 0))
        if len(missing):
            fresh, which = np.unique(codes[missing], return_inverse=True)
            answers = np.array(
                [self.v.apart(*divmod(c, self.v.unknown + 1)) for c in fresh.tolist()], bool
            )
            fits[missing] = answers[which]
            self.pair_codes[slot[missing]] = codes[missing]
            # Of pairs that share a slot the last one stays, in both tables alike.
            self.pair_apart[slot[missing]] = answers[which]
        return fits

    def _trace(self, text, base, lengths, last, origin) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each segment, read back from its end."""
        at, live = base + lengths, np.arange(len(base))
        owners, places, tokens = [], [], []
        while len(live):
            here = at[live]
            owners.append(live)
            places.append(origin[here])
            tokens.append(last[here])
            at[live] = origin[here]
            live = live[at[live] > base[live]]
        owner, place, token = (np.concatenate(x) for x in (owners, places, tokens))
        order = np.argsort(place, kind="stable")
        owner, place, token = owner[order], place[order], token[order]
        # A character without a piece becomes one id per byte.
        bare = token == self.v.unknown
        lead = text[place]
        width = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
        times = np.where(bare, width, 1)
        ids = np.repeat(token, times)
        within = np.arange(len(ids)) - np.repeat(np.cumsum(times) - times, times)
        raw = self.v.byte_ids[text[np.repeat(place, times) + within]]
        ids = np.where(np.repeat(bare, times), raw, ids).astype(np.int32)
        counts = np.bincount(owner, weights=times, minlength=len(base)).astype(np.int64)
        return ids, counts

    # -- decoding -------------------------------------------------------------------------

    def decode(self, lists: pa.Array) -> pa.Array:
        """Texts of an array of id lists; bytes that are no UTF-8 become U+FFFD."""
        out = []
        for ids in lists:
            if not ids.is_valid:
                out.append(None)
                continue
            own = ids.values.to_numpy(zero_copy_only=False)
            begin = self.byte_bounds[own]
            raw = _gather(self.byte_data, begin, self.byte_bounds[own + 1] - begin)
            text = raw.tobytes().decode("utf-8", "replace")
            out.append(text[1:] if text.startswith(" ") else text)
        return pa.array(out, pa.string())


def _gather(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``data[begin : begin + size]``, one after the other."""
    shift = np.repeat(begin - np.cumsum(sizes) + sizes, sizes)
    shift += np.arange(len(shift))
    return data[shift]


def _bisect(block, suffixes, shift, key, lo, hi, right: bool) -> np.ndarray:
    """For all keys at once, the border in [lo, hi) of suffixes below the key."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        value = block[suffixes[np.where(open_, mid, 0)] + shift]
        below = open_ & ((value <= key) if right else (value < key))
        lo = np.where(below, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)
    return lo


#: The codec of this worker process, by the name of its vocabulary.
_codecs: dict[str, Codec] = {}


class Tokenizer:
    """Column functions of one vocabulary, which is sent to the executors once."""

    def __init__(self, spark: SparkSession, path: str = MODEL):
        bound_batches(spark)
        self.vocabulary = spark.sparkContext.broadcast(Vocabulary(path))
        self.name = uuid.uuid4().hex

    def _worker(self):
        shared, name = self.vocabulary, self.name

        def codec() -> Codec:
            if name not in _codecs:
                _codecs.clear()
                _codecs[name] = Codec(shared.value)
            return _codecs[name]

        return codec

    def encode(self, text: Column) -> Column:
        codec = self._worker()
        return F.arrow_udf(lambda x: codec().encode(x), "array<int>")(text)

    def encode_and_check(self, text: Column) -> Column:
        """A struct of the ids and whether decoding them gives the text back."""
        codec = self._worker()
        return F.arrow_udf(
            lambda x: codec().encode_and_check(x), "struct<ids:array<int>,round_trip:boolean>"
        )(text)

    def decode(self, ids: Column) -> Column:
        codec = self._worker()
        return F.arrow_udf(lambda x: codec().decode(x), "string")(ids)


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip), one row per row of ``docs``.

    ``round_trip`` tells whether decoding the ids gives the text back, U+2581 as blanks.
    """
    tokenizer = Tokenizer(docs.sparkSession, path)
    # Both directions in one function: one worker per task, one copy of the vocabulary.
    encoded = docs.select("doc_id", tokenizer.encode_and_check(F.col("text")).alias("e"))
    return encoded.select(
        "doc_id",
        F.coalesce(F.size("e.ids"), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.col("e.ids").alias("ids"),
        F.coalesce("e.round_trip", F.lit(True)).alias("round_trip"),
    )
