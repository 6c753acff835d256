"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation that brings vectors close to the corners of a cube (iterative quantisation, after
principal components) is learned on a bounded sample (``SAMPLE`` vectors drawn by a hash of
the id) and gives every vector a balanced binary code. Codes are cut into substrings, and
each substring is a hash table of its own: similar vectors agree in at least one of them
with high probability. Vectors that share a bucket are reranked with their original values
in double precision, so no link is below the threshold.

Substrings grow with the logarithm of the number of vectors, so buckets keep their size,
and so many tables are used that a pair at the threshold is missed with ``MISS`` probability
at most (closer pairs far less often); further rotations supply more bits where one code
is too short. A pair is counted in the first table in which it meets.

Vectors whose mean is far from the origin (``NEAR_ORIGIN``) would nearly all agree in the signs
of their projections. Their codes are then cut at the mean, which makes the angles of pairs
larger: tables are added until no more than ``MISS`` of pairs at the threshold, made from the
quarter of the sample nearest the mean, meet in none. Where that takes more than ``MOST``
times the tables, or costs more than the large buckets would, codes stay cut at the origin.

Equal vectors are one class with a multiplicity. Buckets above ``CHUNK`` are cut into
chunks, and pairs of chunks go to different tasks; a task returns sums per vector and a
spanning forest of its links, never pairs. Counting the links of a group of near copies takes
every pair of different vectors in it; these products are dense matrix products.

Defined cases: a vector that is null, zero, or holds null or non-finite components links
with nothing and is its own component; vectors of different lengths do not link; rows with
equal ids are one vector with several rows; a null id has a null component and is not kept;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.llm.components import components
from riskledger.llm.storage import Scratch, broadcast_if_small

THRESHOLD = 0.9
SAMPLE = 10_000
MISS = 0.03
CHUNK = 512
#: Average number of vectors in a bucket, as a power of two, and least substring length.
BUCKET_BITS, LEAST_BITS = 6, 8
#: Rows handed to a task at a time.
UNIT_ROWS = 4000
ROUNDS = 30
#: Squared length of the mean of unit vectors up to which codes are cut at the origin.
NEAR_ORIGIN = 0.05
#: Bound of the tables of centred codes, as a multiple of those of balanced ones.
MOST = 12
#: Pairs made to measure misses, and vectors taken to estimate the sizes of buckets.
PAIRS = 2000
#: What a vector in a table costs, in products of two vectors.
ENTRY_COST = 100


@dataclass
class Tables:
    """Projections of all code bits, in table order, where each is cut, and the bits of a substring."""

    planes: np.ndarray
    cuts: np.ndarray
    bits: int

    @property
    def count(self) -> int:
        return self.planes.shape[1] // self.bits

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """The substring of each vector in each table, as integers."""
        signs = (vectors @ self.planes) >= self.cuts
        weights = np.int64(1) << np.arange(self.bits, dtype=np.int64)
        return signs.reshape(len(vectors), self.count, self.bits) @ weights


def plan_tables(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits of a substring, tables) for ``n`` vectors.

    Two vectors at angle a differ in a share a / pi of balanced bits.
    """
    bits = max(LEAST_BITS, math.ceil(math.log2(max(n, 2))) - BUCKET_BITS)
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - agree)))


def learn_rotation(sample: np.ndarray, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """An orthogonal matrix whose signs quantise the sample with little loss.

    Principal directions first, then alternately the nearest corners of the cube and the
    rotation that fits them best (an orthogonal Procrustes problem).
    """
    dim = sample.shape[1]
    _, _, principal = np.linalg.svd(sample.T @ sample)
    projected = sample @ principal.T
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    for _ in range(rounds):
        corners = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(corners.T @ projected)
        rotation = (left @ right).T
    return principal.T @ rotation


def learn_tables(sample: np.ndarray, n: int, threshold: float = THRESHOLD) -> Tables:
    """Tables for ``n`` vectors, cut at the origin or, where that is cheaper, at the mean."""
    bits, least = plan_tables(n, threshold)
    dim = sample.shape[1]
    codes = [learn_rotation(sample, seed) for seed in range(-(-bits * least // dim))]
    planes = np.concatenate(codes, axis=1)[:, : bits * least]
    balanced = Tables(planes, np.zeros(bits * least), bits)
    middle = sample.mean(axis=0)
    if middle @ middle <= NEAR_ORIGIN:
        return balanced
    centred = _centred_tables(sample, middle, bits, least, threshold)
    if centred is None or _cost(centred, sample, n) >= _cost(balanced, sample, n):
        return balanced
    return centred


def _pairs_at(
    start: np.ndarray, sample: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of ``start`` and partners at the threshold, apart in directions the sample varies in."""
    rnd = np.random.default_rng(0)
    x = start[rnd.integers(len(start), size=PAIRS)]
    step = sample[rnd.integers(len(sample), size=PAIRS)]
    step = step - sample[rnd.integers(len(sample), size=PAIRS)]
    step -= (step * x).sum(axis=1, keepdims=True) * x
    size = np.linalg.norm(step, axis=1, keepdims=True)
    able = size[:, 0] > 1e-9
    x, step = x[able], step[able] / size[able]
    return x, threshold * x + math.sqrt(1 - threshold * threshold) * step


def _centred_tables(
    sample: np.ndarray, middle: np.ndarray, bits: int, least: int, threshold: float
) -> Tables | None:
    """Codes cut at the mean, with as many tables as the pairs need; None if ``MOST`` is not enough."""
    moved = sample - middle
    nearest = np.argsort(np.linalg.norm(moved, axis=1), kind="stable")[: -(-len(sample) // 4)]
    x, y = _pairs_at(sample[nearest], sample, threshold)
    if not len(x):
        return None
    planes = np.zeros((sample.shape[1], 0))
    seed = count = 0
    while count < MOST * least:
        planes = np.concatenate([planes, learn_rotation(moved, seed)], axis=1)
        seed += 1
        count = min(planes.shape[1] // bits, MOST * least)
        if count < least:
            continue
        own = planes[:, : count * bits]
        tables = Tables(own, middle @ own, bits)
        met = np.logical_or.accumulate(tables.keys(x) == tables.keys(y), axis=1).mean(axis=0)
        enough = np.flatnonzero(met[least - 1 :] >= 1 - MISS)
        if len(enough):
            columns = (least + int(enough[0])) * bits
            return Tables(own[:, :columns], tables.cuts[:columns], bits)
    return None


def _cost(tables: Tables, sample: np.ndarray, n: int) -> float:
    """Products expected of ``n`` vectors, with what their entries cost."""
    keys = tables.keys(sample[:PAIRS])
    some = len(keys)
    share = 0.0
    for t in range(tables.count):
        _, sizes = np.unique(keys[:, t], return_counts=True)
        share += float((sizes * (sizes - 1)).sum()) / max(1, some * (some - 1))
    return tables.count * n * ENTRY_COST + share * n * n / 2


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    vectors = flat.reshape(n, -1) if n else np.zeros((0, 1))
    # The largest component first, as squares of large ones have no double.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _bucket_keys(tables):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tables.value
        for batch in batches:
            found = own.keys(_matrix(batch.column("embedding"))) if batch.num_rows else None
            if found is not None:
                number = np.tile(np.arange(own.count, dtype=np.int32), len(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number), pa.array(found.ravel())], ["t", "key"]
                )

    return keys


def _entries(tables):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tables.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                found = own.keys(_matrix(some.column("embedding")))
                n = len(found)
                row = pa.array(np.repeat(np.arange(n), own.count))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(own.count, dtype=np.int32), n)),
                        pa.array(found.ravel()),
                        some.column("id").take(row),
                        some.column("copies").take(row),
                        some.column("embedding").take(row),
                    ],
                    ["t", "key", "id", "copies", "embedding"],
                )

    return entries


def _rerank(tables, threshold: float):
    def rerank(key, group):
        own = tables.value
        group = group.sort_by([("t", "ascending"), ("key", "ascending"), ("pair", "ascending")])
        t = group.column("t").to_numpy()
        bucket = group.column("key").to_numpy()
        pair = group.column("pair").to_numpy()
        part = group.column("part").to_numpy()
        ids = group.column("id").to_numpy()
        copies = group.column("copies").to_numpy()
        vectors = _matrix(group.column("embedding"))
        keys = own.keys(vectors)
        new = np.r_[True, (np.diff(t) != 0) | (np.diff(bucket) != 0) | (np.diff(pair) != 0)]
        borders = np.r_[np.flatnonzero(new), len(t)]
        counts: dict[int, int] = {}
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        edges = []
        for s, e in zip(borders[:-1].tolist(), borders[1:].tolist()):
            rows = np.arange(s, e)
            first, second = rows[part[s:e] == 0], rows[part[s:e] == 1]
            within = not len(second)
            if within:
                second = first
            close = vectors[first] @ vectors[second].T >= threshold
            if within:
                close = np.triu(close, 1)
            x, y = np.nonzero(close)
            x, y = first[x], second[y]
            # Counted in the first table in which the two meet.
            fresh = ~(keys[x, : t[s]] == keys[y, : t[s]]).any(axis=1)
            x, y = x[fresh], y[fresh]
            for one, other in ((x, y), (y, x)):
                who, where = np.unique(one, return_inverse=True)
                sums = np.bincount(where, weights=copies[other], minlength=len(who))
                for i, n in zip(ids[who].tolist(), sums.tolist()):
                    counts[i] = counts.get(i, 0) + int(n)
            for a, b in zip(ids[x].tolist(), ids[y].tolist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    edges.append((a, b))
        return pa.table(
            {
                "a": pa.array([a for a, _ in edges] + list(counts), pa.int64()),
                "b": pa.array([b for _, b in edges] + [None] * len(counts), pa.int64()),
                "n": pa.array([0] * len(edges) + list(counts.values()), pa.int64()),
            }
        )

    return rerank


def _usable(vectors: DataFrame) -> DataFrame:
    """Finite, non-zero vectors with an id."""
    value = F.col("embedding")
    finite = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"
    ).filter(
        F.col("vec_id").isNotNull()
        & F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embedding-dedup")
    digest = [F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding")]
    usable = _usable(vectors).withColumns({"d1": digest[0], "d2": digest[1]})
    classes = scratch.write(
        "classes",
        usable.groupBy("d1", "d2").agg(
            F.min("vec_id").alias("id"),
            F.count("*").alias("copies"),
            F.first("embedding").alias("embedding"),
        ),
    )
    # Vectors of different lengths have no cosine: each length has tables of its own. A length
    # is a model's, so there are a few.
    lengths = classes.groupBy(F.size("embedding").alias("length")).count().orderBy("length").collect()
    found = spark.createDataFrame([], "a bigint, b bigint, n bigint")
    for length, n in lengths:
        if n > 1:
            own = classes.filter(F.size("embedding") == length)
            found = found.unionByName(_links(own, n, scratch, threshold, length))
    found = scratch.write("links", found)
    counts = found.filter(F.col("b").isNull()).groupBy("a").agg(F.sum("n").alias("others"))
    named = components(found.filter(F.col("b").isNotNull()), scratch, "component")
    described = scratch.write(
        "described",
        classes.select("d1", "d2", "id", "copies")
        .join(counts.withColumnRenamed("a", "id"), "id", "left")
        .join(named.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "d1",
            "d2",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        ),
    )
    members = scratch.write("members", usable.select("vec_id", "d1", "d2"))
    linked = members.join(described, ["d1", "d2"]).select("vec_id", "n_links", "component_id")
    rest = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").withColumns(
        {"d1": digest[0], "d2": digest[1]}
    )
    alone = rest.join(
        described.select("d1", "d2"), ["d1", "d2"], "left_anti"
    ).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    nameless = rest.filter(F.col("vec_id").isNull()).join(
        described.select("d1", "d2"), ["d1", "d2"], "left_semi"
    ).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).unionByName(nameless).withColumn("kept", kept)


def _links(
    classes: DataFrame, n: int, scratch: Scratch, threshold: float, length: int
) -> DataFrame:
    """(a, b, n) of the ``n`` classes, all of one length: links of a spanning forest, and rows without b with numbers of links."""
    spark = classes.sparkSession
    share = min(1.0, SAMPLE / n)
    drawn = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    rows = classes.filter(drawn).select("embedding").toArrow()
    sample = _matrix(rows.column("embedding"))
    if not len(sample):
        sample = _matrix(classes.select("embedding").limit(1).toArrow().column("embedding"))
    tables = spark.sparkContext.broadcast(learn_tables(sample, n, threshold))
    data = classes.select("id", "copies", "embedding")
    sizes = (
        data.select("embedding")
        .mapInArrow(_bucket_keys(tables), "t int, key bigint")
        .groupBy("t", "key")
        .agg(F.count("*").alias("size"))
    )
    hot = scratch.write(f"hot-{length}", sizes.filter(F.col("size") > CHUNK))
    hot = broadcast_if_small(hot, hot.count(), 32)
    kind = data.schema["embedding"].dataType.simpleString()
    entries = data.mapInArrow(
        _entries(tables), f"t int, key bigint, id bigint, copies bigint, embedding {kind}"
    ).join(hot, ["t", "key"], "left")
    # A chunk meets itself and every other chunk of its bucket, once each.
    chunks = F.ceil(F.coalesce("size", F.lit(1)) / CHUNK)
    entries = entries.withColumn("chunks", chunks).withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
    entries = entries.withColumn("other", other)
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    units = F.lit(max(1, -(-n * tables.value.count // UNIT_ROWS)))
    entries = entries.select(
        "t",
        "key",
        (low * F.col("chunks") + high).alias("pair"),
        (F.col("chunk") > F.col("other")).cast("int").alias("part"),
        "id",
        "copies",
        "embedding",
        F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("t", "key"), units))
        .otherwise(F.xxhash64("t", "key", low, high))
        .alias("unit"),
    )
    return entries.groupBy("unit").applyInArrow(
        _rerank(tables, threshold), "a bigint, b bigint, n bigint"
    )
