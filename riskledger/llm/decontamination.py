"""Benchmark decontamination with a distributed positional inverted index.

The index is a table, sharded by document: one row per training document with the
postings (term, word position) of every term that the benchmark uses. Nothing is shuffled
to build it. Benchmark windows are looked up shard by shard: the list of a window's rarest
term, shifted by the term's offset, gives candidate places, and the shifted lists of the
other terms, from rare to frequent, are intersected with it by binary search. What stays
is an exact phrase match; with a tolerance per term it is a proximity match.

Benchmarks of any size work: windows are looked up in blocks of bounded size, each of
which passes over the index; if even the vocabulary is too large to send to the
executors, postings of all terms are stored.

Defined cases: a null text has no words; a benchmark item without words, or with a null
id, matches nothing; repeated items count once; rows of documents are judged each by
itself, so repeated rows give repeated results; an empty table gives an empty result or
documents without hits. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.llm.blocks import ALNUM, arrow_lists, blocks, release_memory, words
from riskledger.llm.storage import Scratch, broadcast_if_small

WINDOW = 10
SLACK = 3
#: Benchmark windows looked up at a time, and benchmark terms sent to executors.
WINDOWS_AT_A_TIME = 200_000
VOCABULARY = 4_000_000
#: Documents of the index that are looked at together.
ROWS_AT_A_TIME = 512

_GAP = 1 << 40
_SHIFT = np.uint64(40)


def _benchmark_windows(width: int):
    """Arrow batches of (item_id, text) to (item_id, terms): one row per window."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = words(block, ALNUM)
                ids, rows = [], []
                for i in range(len(block)):
                    own = found.hashes[found.bounds[i] : found.bounds[i + 1]].view(np.int64)
                    item = batch.column("item_id")[block.first + i].as_py()
                    if len(own) and item is not None:
                        for k in range(max(1, len(own) - width + 1)):
                            ids.append(item)
                            rows.append(own[k : k + width])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(rows, pa.list_(pa.int64()))],
                    ["item_id", "terms"],
                )

    return make


def _postings(vocabulary):
    """Arrow batches of (doc_id, text) to index rows; ``vocabulary`` None keeps all terms."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if vocabulary is None else vocabulary.value
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = words(block, ALNUM)
                terms = found.hashes.view(np.int64)
                places = np.arange(len(terms)) - np.repeat(
                    found.bounds[:-1], np.diff(found.bounds)
                )
                bounds = found.bounds
                if known is not None:
                    at = np.searchsorted(known, terms)
                    at[at == len(known)] = 0
                    kept = np.flatnonzero(known[at] == terms) if len(known) else at[:0]
                    terms, places = terms[kept], places[kept]
                    bounds = np.searchsorted(kept, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, len(block)),
                        pa.array(np.diff(found.bounds), pa.int64()),
                        arrow_lists(terms, bounds, pa.int64()),
                        arrow_lists(places.astype(np.int32), bounds, pa.int32()),
                    ],
                    ["doc_id", "n_words", "terms", "positions"],
                )
            release_memory()

    return make


def build_index(docs: DataFrame, vocabulary=None) -> DataFrame:
    """Positional postings of every document, sharded by document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _postings(vocabulary),
        f"doc_id {kind}, n_words bigint, terms array<bigint>, positions array<int>",
    )


def _term_counts(known):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = known.value
        if not len(terms):  # an empty block of windows
            return
        total = np.zeros(len(terms) + 1, np.int64)
        for batch in batches:
            values = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
            at = np.searchsorted(terms, values)
            at[at == len(terms)] = 0
            at[terms[at] != values] = len(terms)
            total += np.bincount(at, minlength=len(total))
        seen = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms[seen], pa.int64()), pa.array(total[seen], pa.int64())],
            ["term", "n"],
        )

    return count


class _Lookup:
    """The windows of one block, their terms ordered from rare to frequent."""

    def __init__(self, items: list[str], windows: list[list[int]], counts: dict[int, int]):
        self.items = np.array(items, dtype=object)
        self.vocabulary = np.unique(np.array([t for w in windows for t in w], np.int64))
        width = max((len(w) for w in windows), default=1)
        n = len(windows)
        self.length = np.array([len(w) for w in windows], np.int64)
        self.term = np.full((n, width), -1, np.int64)
        self.offset = np.zeros((n, width), np.int64)
        number = {int(t): i for i, t in enumerate(self.vocabulary)}
        for i, window in enumerate(windows):
            order = sorted(range(len(window)), key=lambda k: (counts.get(window[k], 0), k))
            self.term[i, : len(window)] = [number[window[k]] for k in order]
            self.offset[i, : len(window)] = order

    def _among(self, lists: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        at = np.searchsorted(lists, low)
        at[at == len(lists)] = 0
        return (lists[at] >= low) & (lists[at] <= high)

    def find(self, lists: np.ndarray, slack: int) -> tuple[np.ndarray, ...]:
        """Windows and starts of exact matches, then windows and starts of near ones.

        ``lists`` are all postings of the shard as term << 40 | place, sorted.
        """
        rarest = self.term[:, 0].astype(np.uint64) << _SHIFT
        first = np.searchsorted(lists, rarest)
        count = np.searchsorted(lists, rarest + np.uint64(_GAP)) - first
        which = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + first[which]
        start = (lists[at] & np.uint64(_GAP - 1)).astype(np.int64) - self.offset[which, 0]
        near_which, near_start = which, start
        for r in range(1, self.term.shape[1]):
            which, start = self._step(lists, which, start, r, 0)
            near_which, near_start = self._step(lists, near_which, near_start, r, slack)
        return which, start, near_which, near_start

    def _step(self, lists, which, start, r, slack):
        if not len(which):
            return which, start
        term = self.term[which, r]
        place = start + self.offset[which, r]
        base = np.maximum(term, 0).astype(np.uint64) << _SHIFT
        low = base + np.maximum(place - slack, 0).astype(np.uint64)
        high = base + (place + slack).astype(np.uint64)
        kept = (term < 0) | self._among(lists, low, high)
        return which[kept], start[kept]


def _search(lookup, slack: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = lookup.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
                yield _search_batch(batch.slice(at, ROWS_AT_A_TIME), look, slack)
        release_memory()

    return search


def _search_batch(batch: pa.RecordBatch, look: _Lookup, slack: int) -> pa.RecordBatch:
    n = batch.num_rows
    n_words = batch.column("n_words").to_numpy()
    apart = 2 * look.term.shape[1] + 2 * slack + 2
    base = np.cumsum(np.r_[apart, n_words + apart])[:-1]
    terms = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
    places = batch.column("positions").flatten().to_numpy(zero_copy_only=False)
    sizes = batch.column("terms").value_lengths().to_numpy()
    number = np.searchsorted(look.vocabulary, terms)
    number[number == len(look.vocabulary)] = 0
    none = np.zeros(0, np.int64)
    own = np.flatnonzero(look.vocabulary[number] == terms) if len(look.vocabulary) else none
    glob = (np.repeat(base, sizes) + places)[own]
    lists = np.sort((number[own].astype(np.uint64) << _SHIFT) | glob.astype(np.uint64))
    spans: list[list[list[int]]] = [[] for _ in range(n)]
    items: list[list[str]] = [[] for _ in range(n)]
    near = np.zeros(n, np.int64)
    if len(lists):
        which, start, near_which, near_start = look.find(lists, slack)
        order = np.lexsort((which, start))
        which, start = which[order], start[order]
        doc = np.searchsorted(base, start, side="right") - 1
        for w, s, d in zip(which.tolist(), start.tolist(), doc.tolist()):
            s -= int(base[d])
            e = s + int(look.length[w])
            items[d].append(look.items[w])
            if spans[d] and s <= spans[d][-1][1]:
                spans[d][-1][1] = max(e, spans[d][-1][1])
            else:
                spans[d].append([s, e])
        reach = look.term.shape[1] + slack  # a near match may begin before its document
        near_doc = np.searchsorted(base, near_start + reach, side="right") - 1
        pairs = np.unique(near_doc * len(look.length) + near_which)
        near += np.bincount(pairs // len(look.length), minlength=n)[:n]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("row"),
            batch.column("doc_id"),
            batch.column("n_words"),
            pa.array(spans, pa.list_(pa.list_(pa.int64()))),
            pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
            pa.array(near, pa.int64()),
        ],
        ["row", "doc_id", "n_words", "spans", "items", "n_near"],
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = SLACK
) -> DataFrame:
    """Every document with the word spans and items that benchmark windows hit.

    A window is ``window`` consecutive words of an item; an item of fewer words is one
    window. Returns ``row`` (a number of the row), ``doc_id``, ``n_words``, ``spans``
    (merged [first word, end) pairs), ``items`` (sorted ids of items with occurring
    windows) and ``n_near`` (windows all of whose terms stand within ``slack`` words of
    their places, exact matches included).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontamination")
    kind = docs.schema["doc_id"].dataType.simpleString()
    windows = scratch.write(
        "windows",
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
        .mapInArrow(_benchmark_windows(window), "item_id string, terms array<bigint>")
        .dropDuplicates(),
    )
    n_windows = windows.count()
    n_blocks = max(1, -(-n_windows // WINDOWS_AT_A_TIME))
    blocked = windows.withColumn(
        "block", F.pmod(F.xxhash64("item_id", "terms"), F.lit(n_blocks)).cast("int")
    )
    vocabulary = None
    distinct = windows.select(F.explode("terms").alias("term")).distinct()
    if distinct.count() <= VOCABULARY:
        known = distinct.toPandas()["term"].to_numpy(dtype=np.int64)
        vocabulary = spark.sparkContext.broadcast(np.sort(known))
    index = scratch.write(
        "index",
        build_index(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()),
    )
    found = None
    for b in range(n_blocks):
        rows = blocked.filter(F.col("block") == b).select("item_id", "terms").toPandas()
        lists = [list(map(int, t)) for t in rows["terms"]]
        own = np.unique(np.array([t for w in lists for t in w], np.int64))
        known = spark.sparkContext.broadcast(own)
        counts = (
            index.select("terms")
            .mapInArrow(_term_counts(known), "term bigint, n bigint")
            .groupBy("term")
            .agg(F.sum("n").alias("n"))
            .toPandas()
        )
        lookup = spark.sparkContext.broadcast(
            _Lookup(list(rows["item_id"]), lists, dict(zip(counts["term"], counts["n"])))
        )
        part = index.mapInArrow(
            _search(lookup, slack),
            f"row bigint, doc_id {kind}, n_words bigint, spans array<array<bigint>>,"
            " items array<string>, n_near bigint",
        )
        found = part if found is None else found.unionByName(part)
    if n_blocks > 1:
        found = _merge_blocks(found)
    return found


def _merge_blocks(found: DataFrame) -> DataFrame:
    """One row per document from the results of several blocks of windows."""
    joined = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sum("n_near").alias("n_near"),
    )

    def extend(done, span):
        last = F.element_at(done, -1)
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))[1] >= span[0]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.array(last[0], F.greatest(last[1], span[1]))),
            ),
        ).otherwise(F.concat(done, F.array(span)))

    empty = F.array().cast("array<array<bigint>>")
    return joined.withColumn("spans", F.aggregate("spans", empty, extend))


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Counts and digest of ``contamination``, one row per row of ``docs``."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    return contamination(docs, benchmark, window).select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "n_near",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents no benchmark window occurs in, with all their columns.

    Documents go by id: if one of several rows with the same id is contaminated, all go.
    """
    scratch = Scratch(docs.sparkSession, "decontaminated")
    hit = scratch.write(
        "ids",
        contamination(docs, benchmark, window)
        .filter(F.size("spans") > 0)
        .select(F.col("doc_id").alias("__contaminated_id"))
        .distinct(),
    )
    hit = broadcast_if_small(hit, hit.count(), 64)
    same = docs["doc_id"].eqNullSafe(hit["__contaminated_id"])
    return docs.join(hit, same, "left_anti")


__all__ = ["build_index", "contamination", "contamination_report", "drop_contaminated"]
