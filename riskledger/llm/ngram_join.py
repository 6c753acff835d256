"""Near-duplicate documents by a Jaccard join on word shingles, with T-occurrence search.

Two documents link when their sets of distinct ``SHINGLE``-word shingles have a Jaccard
similarity of at least ``PERCENT`` per cent. Every step below is exact:

1. One pass over the texts gives each document's set size, a 128-bit digest of the set and
   its ``prefix``: the smallest hashes of the set, a third of it. Two linked documents share
   at least a twelfth of their sizes within these prefixes, so only documents that many of
   whose prefix shingles occur elsewhere go on. Occurrences are first combined within each
   task: a shingle on every page costs one row per task.
2. Equal sets, found by digest, go on as one document.
3. Whole sets of those documents are cut to shingles that at least two of them have; a
   document that keeps less than ``PERCENT`` of its set has no partner.
4. Linked documents share one of their rarest shingles (a prefix in order of frequency).
   Documents whose prefixes share a shingle form a cluster, named by the least id that has
   the shingle; a document is in as many clusters as its prefix has such names. If a shared
   shingle is the first that two documents share, what they share is at most what follows
   it, which bounds the partner's size (``top``): a shingle none of whose documents can have
   a partner of any size found there forms no cluster. Pages of one template that differ too
   much to link are told apart by this, without comparing them.
5. Each cluster is searched in groups of bounded size by T-occurrence search (DivideSkip):
   inverted lists of a document's shingles are divided into short ones, whose runs are
   merged and counted, and long ones, which are probed by binary search for candidates
   that can still reach the required overlap. Pairs that are connected already are
   skipped, so a group yields links of a spanning forest, not all pairs.
6. A cluster larger than a group is searched group by group; delegates of the components
   found then meet, level by level, and finally all documents outside the cluster's largest
   component are searched against those of the cluster whose sizes, in bands, lie between
   their least partner's and ``top``.

Sets are searched under numbers of their own, one row per distinct set, however many rows or
ids have it and however many sets an id has.

Defined cases: a null or blank text has an empty set and no links; fewer than ``SHINGLE``
words form one shingle; rows with the same id are the same document, which links by each of
its texts; rows with a null id link with nothing and have a null component; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.llm.blocks import NOT_SPACE, arrow_lists, blocks, mix, release_memory, words
from riskledger.llm.components import components
from riskledger.llm.storage import Scratch, broadcast_if_small

SHINGLE = 5
PERCENT = 75
#: Documents searched together in one task.
GROUP = 512
#: Documents whose postings are combined before the shuffle.
COMBINED = 3000
#: Components of at least this size send that many delegates to the next level.
DELEGATING, DELEGATES = 32, 8
#: Bands of set sizes in the last step: the ratio of a band's ends.
BAND = 1.05
#: Steepness of the rule that divides short from long lists.
MU = 0.0085

_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first text, sorted distinct shingle hashes of each text) per block."""
    for block in blocks(texts):
        found = words(block, NOT_SPACE)
        w = found.hashes
        rolled = np.zeros(max(0, len(w) - width + 1), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(width):
                rolled = rolled * _STEP + w[k : k + len(rolled)]
        rolled = mix(rolled)
        sets = []
        for s, e in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
            if e - s >= width:
                own = rolled[s : e - width + 1]
            elif e > s:
                short = np.uint64(e - s)
                with np.errstate(over="ignore"):
                    for h in w[s:e]:
                        short = short * _STEP + h
                own = mix(np.array([short], np.uint64))
            else:
                own = rolled[:0]
            sets.append(np.unique(own.view(np.int64)))
        yield block.first, sets


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + max(1, -(-n // 12))


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits of each set, in two rows."""
    digests = np.zeros((2, len(sets)), np.int64)
    with np.errstate(over="ignore"):
        for i, x in enumerate(sets):
            u = x.view(np.uint64)
            digests[0, i] = mix(u).sum(dtype=np.uint64).view(np.int64)
            digests[1, i] = mix(u ^ _STEP).sum(dtype=np.uint64).view(np.int64)
    return digests


def _profiles(width: int, percent: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column("text"), width):
                prefixes = [x[: _prefix_size(len(x), percent)] if len(x) else x for x in sets]
                digests = _digests(sets)
                bounds = np.cumsum([0, *map(len, prefixes)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(sets)),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(digests[0]),
                        pa.array(digests[1]),
                        arrow_lists(
                            np.concatenate([np.zeros(0, np.int64), *prefixes]), bounds, pa.int64()
                        ),
                    ],
                    ["doc_id", "n", "d1", "d2", "prefix"],
                )
        release_memory()

    return make


_POSTING = "key bigint, doc bigint, n int"


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of a batch: one row per shingle, and local counts of repeated ones.

    n = 0: a shingle (key) that one document of the batch has; n = -1: one that several
    have; n > 0: that many shingles of a document are repeated within the batch.
    """
    pieces = (b.slice(at, COMBINED) for b in batches for at in range(0, b.num_rows, COMBINED))
    for batch in pieces:
        lists = batch.column("prefix")
        keys = lists.flatten().to_numpy(zero_copy_only=False)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        docs = np.repeat(ids, lists.value_lengths().to_numpy(zero_copy_only=False))
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        new = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(keys)])
        single = starts[sizes == 1]
        repeated = np.repeat(sizes > 1, sizes)
        owners, counts = np.unique(docs[repeated], return_counts=True)
        several = keys[starts[sizes > 1]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([keys[single], several, mix(owners.view(np.uint64)).view(np.int64)])),
                pa.array(np.concatenate([docs[single], np.full(len(several), -1), owners])),
                pa.array(
                    np.concatenate(
                        [np.zeros(len(single)), np.full(len(several), -1), counts]
                    ).astype(np.int32)
                ),
            ],
            ["key", "doc", "n"],
        )
    release_memory()


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, n): a row per shingle that others have too, of one hash partition."""
    parts = [[b.column(i).to_numpy() for i in range(3)] for b in batches]
    if not parts:
        return
    keys, docs, n = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    local = n > 0
    known_docs, known = docs[local], n[local]
    keys, docs, named = keys[~local], docs[~local], n[~local] == 0
    order = np.argsort(keys, kind="stable")
    keys, docs, named = keys[order], docs[order], named[order]
    new = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, len(keys)])
    docs = docs[np.repeat(sizes > 1, sizes) & named]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([docs, known_docs])),
            pa.array(np.concatenate([np.ones(len(docs)), known]).astype(np.int64)),
        ],
        ["doc", "n"],
    )
    del keys, docs, named, order, new, starts, sizes
    release_memory()


def _digested(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column("text"), width):
                some, digests = batch.slice(first, len(sets)), _digests(sets)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("text"), *map(pa.array, digests)],
                    ["id", "text", "d1", "d2"],
                )

    return make


def _whole_sets(width: int):
    """(id, n, shingles) of the texts whose set has the digest that ``id`` stands for."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column("text"), width):
                some, digests = batch.slice(first, len(sets)), _digests(sets)
                named = (digests[0] == some.column("d1").to_numpy()) & (
                    digests[1] == some.column("d2").to_numpy()
                )
                sets = [x for x, own in zip(sets, named.tolist()) if own]
                bounds = np.cumsum([0, *map(len, sets)])
                flat = np.concatenate([np.zeros(0, np.int64), *sets])
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("id").filter(pa.array(named)),
                        pa.array(np.diff(bounds)),
                        arrow_lists(flat, bounds, pa.int64()),
                    ],
                    ["id", "n", "shingles"],
                )

    return make


class _Forest:
    """Union-find whose roots are the least members."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def divide_skip(
    ids: np.ndarray,
    sizes: np.ndarray,
    shingles: list[np.ndarray],
    percent: int = PERCENT,
    queries: np.ndarray | None = None,
    joined: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Links (id, id) that connect all linked documents of the group.

    ``sizes`` are whole set sizes; ``shingles`` may leave out what no other document has.
    ``queries`` marks the documents that are searched for (default all); pairs of others
    are not compared. ``joined`` are known components.
    """
    order = np.lexsort((ids, sizes))
    m = len(order)
    size = sizes[order]
    asked = np.ones(m, bool) if queries is None else queries[order]
    forest = _Forest(m)
    if joined is not None:
        first: dict[int, int] = {}
        for i, c in enumerate(joined[order].tolist()):
            forest.join(first.setdefault(c, i), i)
    lengths = np.array([len(shingles[i]) for i in order])
    flat = np.concatenate([np.zeros(0, np.int64), *(shingles[i] for i in order)])
    vocabulary, number = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(m), lengths)
    # Inverted lists, one after the other: (shingle, place of the document), sorted.
    lists = np.sort(number.astype(np.int64) * m + owner)
    bounds = np.cumsum(np.r_[0, lengths])
    links = []
    for q in range(m):
        # Partners of smaller or equal size come before q; later ones ask for q themselves,
        # unless they are not searched for.
        low = int(np.searchsorted(size, -(-percent * size[q] // 100)))
        high = q
        if queries is not None:
            if not asked[q]:
                continue
            high = int(np.searchsorted(size, size[q] * 100 // percent, side="right"))
        if low >= high:
            continue
        own = number[bounds[q] : bounds[q + 1]].astype(np.int64)
        start = np.searchsorted(lists, own * m + low)
        stop = np.searchsorted(lists, own * m + high)
        length = stop - start
        used = np.flatnonzero(length)
        # Overlap needed at least, whatever the partner's size.
        need = -(-percent * int(max(size[q], 1)) // 100)
        if queries is not None:
            need = -(-percent * max(int(size[q]), int(size[low])) // 100)
        if len(used) < need:
            continue
        used = used[np.argsort(length[used], kind="stable")]
        longest = int(length[used[-1]])
        n_long = min(int(need / (MU * np.log2(longest + 1) + 1)), need - 1, len(used) - 1)
        short, long = used[: len(used) - n_long], used[len(used) - n_long :]
        at = np.repeat(start[short] - np.r_[0, np.cumsum(length[short])[:-1]], length[short])
        merged = np.sort(lists[at + np.arange(len(at))] % m, kind="stable")
        candidates, counts = np.unique(merged, return_counts=True)
        enough = (counts >= need - n_long) & (candidates != q)
        candidates, counts = candidates[enough], counts[enough]
        by_count = np.argsort(-counts, kind="stable")
        candidates, counts = candidates[by_count], counts[by_count]
        at = 0
        while at < len(candidates):
            mine = forest.root(q)
            rest = np.array([forest.root(c) != mine for c in candidates[at:].tolist()], bool)
            candidates, counts, at = candidates[at:][rest], counts[at:][rest], 0
            some, found = candidates[:16], counts[:16].copy()
            if not len(some):
                break
            wanted = (own[long] * m)[:, None] + some[None, :]
            spot = np.searchsorted(lists, wanted)
            spot[spot == len(lists)] = 0
            found += (lists[spot] == wanted).sum(axis=0)
            union = size[q] + size[some] - found
            for c in some[100 * found >= percent * union].tolist():
                links.append((int(ids[order[q]]), int(ids[order[c]])))
                forest.join(q, c)
            at = len(some)
    return links


def _search(percent: int):
    def search(key, group):
        names = group.column_names
        # Several clusters, or both sides of a square, may have brought the same document.
        if "asked" in names:
            group = group.sort_by([("asked", "descending")])
        _, once = np.unique(group.column("id").to_numpy(), return_index=True)
        group = group.take(pa.array(once))
        ids = group.column("id").to_numpy()
        sets = group.column("shingles").combine_chunks()
        flat = sets.flatten().to_numpy(zero_copy_only=False)
        bounds = np.cumsum(np.r_[0, sets.value_lengths().to_numpy(zero_copy_only=False)])
        links = divide_skip(
            ids,
            group.column("n").to_numpy(),
            [flat[s:e] for s, e in zip(bounds[:-1], bounds[1:])],
            percent,
            group.column("asked").to_numpy(zero_copy_only=False) if "asked" in names else None,
            group.column("joined").to_numpy() if "joined" in names else None,
        )
        return pa.table(
            {
                "a": pa.array([x for x, _ in links], pa.int64()),
                "b": pa.array([y for _, y in links], pa.int64()),
            }
        )

    return search


def _links(groups: DataFrame, percent: int) -> DataFrame:
    return groups.groupBy("unit").applyInArrow(_search(percent), "a bigint, b bigint")


def _survivors(profiles: DataFrame, percent: int) -> DataFrame:
    """(d1, d2, doc_id): the distinct sets that may have a partner, and who has them first."""
    counts = (
        profiles.select("doc_id", "prefix")
        .filter(F.size("prefix") > 0)
        .mapInArrow(_combined, _POSTING)
        .repartition("key")
        .mapInArrow(_shared_counts, "doc bigint, n bigint")
        .groupBy(F.col("doc").alias("doc_id"))
        .agg(F.sum("n").alias("shared"))
    )
    # The least share any partner's size asks for.
    smallest = F.ceil(F.col("n") * percent / 100)
    needed = F.greatest(F.lit(1), F.ceil(smallest / 12))
    return (
        profiles.select("doc_id", "n", "d1", "d2")
        .join(counts, "doc_id")
        .filter(F.col("shared") >= needed)
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("doc_id"))
    )


def _distinct_sets(
    docs: DataFrame, named: DataFrame, scratch: Scratch, width: int
) -> DataFrame:
    """(id, n, shingles): each set of ``named`` (id, d1, d2, doc_id) once."""
    n_named = named.count()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    columns = ["id", "d1", "d2", "text"]
    several = scratch.write(
        "several-sets",
        named.groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1").select("doc_id"),
    )
    n_several = several.count()
    if n_several:
        # Ids with several sets: their texts are told apart by digest.
        several = broadcast_if_small(several, n_several, 16)
        others = (
            texts.join(several, "doc_id")
            .withColumnRenamed("doc_id", "id")
            .mapInArrow(_digested(width), "id bigint, text string, d1 bigint, d2 bigint")
            .withColumnRenamed("id", "doc_id")
            .join(broadcast_if_small(named, n_named, 32), ["doc_id", "d1", "d2"])
            .select(*columns)
        )
        named = named.join(several, "doc_id", "left_anti")
    found = texts.join(broadcast_if_small(named, n_named, 32), "doc_id").select(*columns)
    if n_several:
        found = found.unionByName(others)
    sets = scratch.write(
        "sets",
        found.mapInArrow(_whole_sets(width), "id bigint, n bigint, shingles array<bigint>"),
    )
    again = scratch.write(
        "repeated-sets",
        sets.groupBy("id").agg(F.count("*").alias("k")).filter("k > 1").select("id"),
    )
    n_again = again.count()
    if not n_again:
        return sets
    again = broadcast_if_small(again, n_again, 16)
    once = sets.join(again, "id").dropDuplicates(["id"])
    return sets.join(again, "id", "left_anti").unionByName(once)


def _searchable(sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """(id, n, shingles): shingles that others have, rarest first; hopeless documents gone."""
    rows = sets.select("id", "n", F.explode("shingles").alias("shingle"))
    common = scratch.write(
        "frequencies",
        rows.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1"),
    )
    return (
        rows.join(common, "shingle")
        .groupBy("id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("s"))
        .filter(F.size("s") * 100 >= F.col("n") * percent)
        .select("id", "n", F.col("s.shingle").alias("shingles"))
    )


def _clusters(found: DataFrame, scratch: Scratch, percent: int, rows: int) -> DataFrame:
    """(cluster, id, top): documents whose rare prefixes share a shingle, of two or more.

    ``top`` is the largest set that a document can link with by the cluster's shingles.
    """
    n, kept = F.col("n"), F.size("shingles")
    prefix = n - F.ceil(n * percent / 100) + 1 - (n - kept)
    shingles = F.slice("shingles", F.lit(1), prefix.cast("int"))
    after = kept - F.col("at")
    top = F.least(
        F.floor(n * 100 / percent), F.floor(after * (100 + percent) / percent) - n
    ).cast("bigint")
    postings = found.select("id", "n", "shingles", F.posexplode(shingles).alias("at", "s")).select(
        "id", "n", top.alias("top"), "s"
    )
    heads = scratch.write(
        "heads",
        postings.groupBy("s")
        .agg(
            F.min("id").alias("cluster"),
            F.count("*").alias("df"),
            F.min("n").alias("least"),
            F.max("top").alias("most"),
        )
        .filter("df > 1 AND least <= most")
        .drop("df"),
        20 * rows,
    )
    return (
        postings.join(heads, "s")
        .filter("top >= least AND n <= most")
        .groupBy("cluster", "id")
        .agg(F.max("top").alias("top"))
    )


def near_duplicate_links(
    docs: DataFrame, scratch: Scratch, percent: int = PERCENT, width: int = SHINGLE
) -> tuple[DataFrame, DataFrame]:
    """(profiles, links): set sizes and digests of all rows, and links between documents.

    A set's links are those of the least id that has it.
    """
    spark = docs.sparkSession
    profiles = scratch.write(
        "profiles",
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .filter(F.col("doc_id").isNotNull())
        .mapInArrow(
            _profiles(width, percent),
            "doc_id bigint, n bigint, d1 bigint, d2 bigint, prefix array<bigint>",
        ),
    )
    named = scratch.write(
        "survivors",
        _survivors(profiles, percent).withColumn("id", F.monotonically_increasing_id()),
    )
    sets = _distinct_sets(docs, named, scratch, width)
    found = scratch.write("searchable", _searchable(sets, scratch, percent))
    n_found = found.count()
    clusters = scratch.write("clusters", _clusters(found, scratch, percent, n_found), 20 * n_found)
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    large = scratch.write("large-clusters", sizes.filter(F.col("size") > GROUP), n_found // GROUP)
    n_large = large.count()
    # Small clusters share groups; a large one has groups of its own.
    bins = F.lit(1 + clusters.count() // GROUP)
    parts = F.ceil(F.col("size") / GROUP)
    unit = F.when(F.col("size").isNull(), F.pmod(F.xxhash64("cluster"), bins)).otherwise(
        F.xxhash64("cluster", F.pmod(F.xxhash64("id"), parts))
    )
    placed = clusters.join(broadcast_if_small(large, n_large, 16), "cluster", "left")
    placed = found.join(placed, "id").withColumn("unit", unit)
    columns = ["unit", "id", "n", "shingles"]
    small = placed.filter(F.col("size").isNull()).select(*columns)
    links = scratch.write("links", _links(small, percent))
    if n_large:
        links = _finish_large(placed.filter(F.col("size").isNotNull()), links, scratch, percent)
    for side in ("a", "b"):
        owners = named.select(F.col("id").alias(side), F.col("doc_id").alias("owner"))
        links = links.join(owners, side).drop(side).withColumnRenamed("owner", side)
    return profiles, scratch.write("document-links", links)


def _finish_large(
    placed: DataFrame, links: DataFrame, scratch: Scratch, percent: int
) -> DataFrame:
    """``links`` and those of clusters that are larger than a group."""
    columns = ["unit", "cluster", "id", "n", "top", "shingles"]
    placed = scratch.write("large", placed.select(*columns))
    rows = placed.count()
    own = scratch.write("links-0", _links(placed.drop("cluster", "top"), percent))
    members = placed.drop("unit")
    level = 0
    while True:
        level += 1
        labelled = _label(members, own, scratch, f"level-{level}", rows)
        part = scratch.write(
            f"parts-{level}",
            labelled.groupBy("cluster", "joined").agg(F.count("*").alias("part")),
            rows,
        )
        big = part.filter(F.col("part") >= DELEGATING)
        several = big.groupBy("cluster").agg(F.count("*").alias("k")).filter("k > 1")
        meeting = scratch.write(f"meeting-{level}", several, rows // DELEGATING)
        if meeting.isEmpty():
            break
        # A component sends a sample of itself; samples of a cluster meet in groups.
        share = F.greatest(F.lit(1), F.floor(F.col("part") / DELEGATES))
        delegates = (
            labelled.join(big, ["cluster", "joined"])
            .join(meeting, "cluster")
            .filter(F.pmod(F.xxhash64("id", F.lit(level)), share) == 0)
        )
        groups = F.ceil(F.col("k") * 2 * DELEGATES / GROUP)
        unit = F.xxhash64("cluster", F.pmod(F.xxhash64("joined", F.lit(level)), groups))
        columns = ["unit", "id", "n", "shingles", "joined"]
        more = scratch.write(
            f"links-{level}", _links(delegates.withColumn("unit", unit).select(*columns), percent)
        )
        if more.isEmpty():
            break
        own = own.unionByName(more)
    # Whoever is outside the largest component of the cluster is compared with those of the
    # cluster that have a fitting size.
    largest = scratch.write(
        "largest",
        part.groupBy("cluster").agg(
            F.max_by("joined", F.struct("part", "joined")).alias("main"),
            F.max("part").alias("inside"),
            F.sum("part").alias("all"),
        ),
        rows // GROUP,
    )
    sides = labelled.join(largest.filter("inside < all"), "cluster").withColumn("band", _band("n"))
    bands = scratch.write(
        "bands",
        sides.groupBy("cluster", "band").agg(
            F.count("*").alias("listed"), F.max("top").alias("most")
        ),
    )
    lowest = F.ceil(F.col("n") * percent / 100)
    reached = F.sequence(_band(lowest), F.greatest(_band(lowest), _band("top")))
    asking = sides.filter((F.col("joined") != F.col("main")) & (F.col("top") >= lowest))
    asked = scratch.write(
        "asked",
        asking.select("cluster", "id", "n", F.explode(reached).alias("band"))
        .join(bands, ["cluster", "band"])
        .filter("n <= most")
        .select("cluster", "band", "id"),
    )
    half = GROUP // 2
    cells = scratch.write(
        "cells",
        asked.groupBy("cluster", "band")
        .agg(F.count("*").alias("asked"))
        .join(bands, ["cluster", "band"])
        .select(
            "cluster",
            "band",
            F.ceil(F.col("asked") / half).alias("rows"),
            F.ceil(F.col("listed") / half).alias("columns"),
        ),
    )
    columns = ["cluster", "band", "id", "n", "shingles", "joined"]

    def spread(number: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(number) - 1))

    place = F.pmod(F.xxhash64("id"), F.col("rows")), F.pmod(F.xxhash64("id"), F.col("columns"))
    left = (
        asked.join(cells, ["cluster", "band"])
        .join(sides.drop("band"), ["cluster", "id"])
        .select(*columns, F.lit(True).alias("asked"), place[0].alias("r"), spread("columns").alias("c"))
    )
    right = sides.join(cells, ["cluster", "band"]).select(
        *columns, F.lit(False).alias("asked"), spread("rows").alias("r"), place[1].alias("c")
    )
    # A document may be on both sides of one square; the asked copy counts.
    square = left.unionByName(right).select(
        F.xxhash64("cluster", "band", "r", "c").alias("unit"),
        "id", "n", "shingles", "asked", "joined",
    )
    last = scratch.write("links-outside", _links(square, percent))
    return links.unionByName(own).unionByName(last)


def _band(size: str | Column) -> Column:
    size = F.col(size) if isinstance(size, str) else size
    return F.floor(F.log(size.cast("double")) / float(np.log(BAND)))


def _label(
    members: DataFrame, links: DataFrame, scratch: Scratch, name: str, rows: int
) -> DataFrame:
    found = components(links, scratch, name, rows).select(
        F.col("node").alias("id"), F.col("component").alias("found")
    )
    return scratch.write(
        f"{name}-labels",
        members.join(found, "id", "left")
        .withColumn("joined", F.coalesce("found", "id"))
        .drop("found"),
    )


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "ngram-join")
    profiles, links = near_duplicate_links(docs, scratch, percent, width)
    sets = scratch.write(
        "classes",
        profiles.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("id")),
    )
    # A document of several sets is linked to the least document of each.
    several = scratch.write(
        "several-texts",
        profiles.filter("n > 0")
        .groupBy("doc_id")
        .agg(*(f(x).alias(f"{f.__name__}_{x}") for x in ("d1", "d2") for f in (F.min, F.max)))
        .filter("min_d1 <> max_d1 OR min_d2 <> max_d2")
        .select("doc_id"),
    )
    n_several = several.count()
    if n_several:
        own = profiles.filter("n > 0").select("doc_id", "d1", "d2")
        own = own.join(broadcast_if_small(several, n_several, 16), "doc_id").distinct()
        own = own.join(sets, ["d1", "d2"]).select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
        links = scratch.write("all-links", links.unionByName(own))
    named = scratch.write("components", components(links, scratch, "final", links.count()))
    classes = scratch.write(
        "class-components",
        sets.join(named.withColumnRenamed("node", "id"), "id", "left").select(
            "d1", "d2", F.coalesce("component", "id").alias("component")
        ),
    )
    members = profiles.select("doc_id", "n", "d1", "d2")
    result = members.join(classes, ["d1", "d2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    missing = docs.filter(F.col("doc_id").isNull()).select(
        F.lit(None).cast("bigint").alias("doc_id"), "text"
    )
    sizes = missing.mapInArrow(
        _null_sizes(width), "doc_id bigint, n_shingles bigint, component_id bigint"
    )
    return result.unionByName(sizes)


def _null_sizes(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in shingle_sets(batch.column("text"), width):
                none = pa.nulls(len(sets), pa.int64())
                sizes = pa.array([len(x) for x in sets], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [none, sizes, none], ["doc_id", "n_shingles", "component_id"]
                )

    return make


def keep_one_of_each(
    docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE
) -> DataFrame:
    """``docs`` without all but one document of each group: the one with the least id.

    Documents with an empty set, or a null id, stay. Of rows with one id, all stay or none.
    """
    scratch = Scratch(docs.sparkSession, "ngram-kept")
    found = near_duplicates(docs, percent, width)
    gone = scratch.write(
        "gone",
        found.filter("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct(),
    )
    gone = broadcast_if_small(gone, gone.count(), 16)
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
