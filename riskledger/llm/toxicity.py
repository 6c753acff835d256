"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other: the probability of each earlier category is a
feature of every later model. Later models are trained on out-of-fold probabilities, that
is, on what models said that had not seen the row, so that they learn how far to trust them.

Features are the distinct words of the whole text and their first four and five bytes, as
64-bit hashes; present or not, so one toxic word counts the same in a short and a long text.
Models are logistic regressions with an L1 penalty, which leaves a few hundred features.
Fitting takes a bounded sample of the labelled rows (``TRAIN_ROWS``, drawn by a hash of the
id, up to half of it rows of the last category, weighted back) and, chosen on that sample,
the ``FEATURES`` features of ``MIN_ROWS`` rows or more that tell most (by chi-square).
Prediction is one pass without a shuffle.

Defined cases: a null or empty text has no features and is never flagged; a null label keeps
the row out of that category's model; a document labelled twice has a category if one label
says so; a category with one class among the labels has that constant probability, without
labels zero; labels without a document, or with a null id, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.llm.blocks import (
    Block,
    arrow_lists,
    blocks,
    hash_spans,
    release_memory,
    words,
)
from riskledger.llm.storage import Scratch
from riskledger.plans.batch import together

TRAIN_ROWS = 12_000
FEATURES = 16_000
MIN_ROWS = 5
FOLDS = 2
PREFIXES = (4, 5)
PENALTY = 5e-5
THRESHOLD = 0.5
#: A training row weighs as much as so many plain rows when tasks are formed.
DENSE = 25

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def text_features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): the distinct features of each text, sorted."""
    found = words(block, _LETTERS)
    owner = np.repeat(np.arange(len(block)), np.diff(found.bounds))
    hashes, owners = [found.hashes], [owner]
    for length in PREFIXES:
        long = np.flatnonzero(found.ends - found.starts > length)
        starts = found.starts[long]
        # Another length, another seed: a word is not its own prefix.
        hashes.append(hash_spans(block.data, starts, starts + length) ^ np.uint64(length))
        owners.append(owner[long])
    owner, value = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    if len(value):
        new = np.r_[True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])]
        owner, value = owner[new], value[new]
    return np.searchsorted(owner, np.arange(len(block) + 1)), value.view(np.int64)


@dataclass
class Link:
    """One model of the chain; ``earlier`` are the weights of earlier probabilities."""

    category: str
    hashes: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def probability(self, bounds, features, earlier: list[np.ndarray]) -> np.ndarray:
        score = np.full(len(bounds) - 1, self.intercept)
        if len(self.hashes):
            at = np.searchsorted(self.hashes, features)
            at[at == len(self.hashes)] = 0
            hit = np.flatnonzero(self.hashes[at] == features)
            owner = np.searchsorted(bounds, hit, side="right") - 1
            score += np.bincount(owner, weights=self.weights[at[hit]], minlength=len(score))
        for weight, value in zip(self.earlier, earlier):
            score += weight * value
        return 1 / (1 + np.exp(-np.clip(score, -500, 500)))


@dataclass
class Chain:
    links: list[Link] = field(default_factory=list)

    def predict(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities by category, whether a text has any feature)."""
        bounds, features = text_features(block)
        done: list[np.ndarray] = []
        for link in self.links:
            done.append(link.probability(bounds, features, done))
        return np.array(done).reshape(len(self.links), len(block)), np.diff(bounds) > 0


def _sample_features(columns: list[str]):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                bounds, features = text_features(block)
                kept = [batch.column(c).slice(block.first, len(block)) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*kept, arrow_lists(features, bounds, pa.int64())], [*columns, "hashes"]
                )

    return make


def fit(
    docs: DataFrame, labels: DataFrame, categories: list[str], train_rows: int = TRAIN_ROWS
) -> Chain:
    """A chain over the 0/1 columns ``categories`` of ``labels`` (doc_id, ...), in their order."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    known = scratch.write(
        "labels",
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(*(F.max(F.col(c).cast("int")).alias(c) for c in categories)),
    )
    last = F.coalesce(F.col(categories[-1]), F.lit(0)) == 1
    sizes = known.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(last.cast("int")), F.lit(0)).alias("positive")
    ).first()
    half = train_rows // 2
    rest = max(0, sizes["n"] - sizes["positive"])

    def drawn(wanted: int, there: int) -> Column:
        part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1_000_000))
        return part < F.lit(wanted * 1_000_000 // max(there, 1) + 1)

    positive = min(half, sizes["positive"])
    negative = train_rows - positive
    # Weights undo the unequal shares, so probabilities stay those of the labelled rows.
    weight = F.when(last, sizes["positive"] / max(positive, 1)).otherwise(
        max(1.0, rest / max(negative, 1))
    )
    chosen = known.filter(
        (last & drawn(positive, sizes["positive"])) | (~last & drawn(negative, rest))
    ).withColumn("weight", weight.cast("double"))
    # At most about ``train_rows`` rows of a few bytes.
    texts = docs.select("doc_id", F.lower("text").alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    columns = ["doc_id", *categories, "weight"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.select(columns).schema)
    rows = scratch.write(
        "sample",
        texts.select(*columns, "text").mapInArrow(
            _sample_features(columns), f"{kinds}, hashes array<bigint>"
        ),
    )
    vocabulary = _telling_features(rows, categories)
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.udf(VectorUDT())
    def vector(hashes):
        known_ = shared.value
        own = np.array(hashes, np.int64)
        at = np.searchsorted(known_, own)
        at[at == len(known_)] = 0
        places = at[known_[at] == own] if len(known_) else at[:0]
        return Vectors.sparse(max(1, len(known_)), np.sort(places), np.ones(len(places)))

    n_rows = rows.count()
    if n_rows == 0:
        scratch.close()
        return Chain([_link(0.0, c, vocabulary, 0) for c in categories])
    data = scratch.write(
        "vectors",
        rows.select(
            *columns,
            "hashes",
            vector("hashes").alias("words"),
            F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold"),
        ),
        DENSE * n_rows,
    )
    chain, earlier = Chain(), []
    for i, category in enumerate(categories):
        name = f"__p{i}"
        rows = VectorAssembler(inputCols=["words", *earlier], outputCol="features").transform(data)
        known_rows = rows.filter(F.col(category).isNotNull())
        parts = [known_rows]
        if i + 1 < len(categories):
            parts += [known_rows.filter(F.col("fold") != fold) for fold in range(FOLDS)]
        # The models of a category are independent and small: fitted side by side.
        model, *others = together([lambda p=p: _model(p, category) for p in parts])
        chain.links.append(_link(model, category, vocabulary, len(earlier)))
        if others:
            links = [_link(other, category, vocabulary, len(earlier)) for other in others]
            data = scratch.write(
                f"vectors-{i}", _out_of_fold(data, links, earlier, name), DENSE * n_rows
            )
            earlier.append(name)
    scratch.close()
    return chain


def _telling_features(rows: DataFrame, categories: list[str]) -> np.ndarray:
    """The ``FEATURES`` features whose rows differ most from all rows in some category."""
    shares = rows.agg(*(F.avg(c).alias(c) for c in categories)).first()
    found = (
        rows.select(*categories, F.explode("hashes").alias("hash"))
        .groupBy("hash")
        .agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in categories))
        .filter(F.col("n") >= MIN_ROWS)
    )
    differ = [F.lit(0.0), F.lit(0.0)]
    for c in categories:
        p = shares[c] or 0.0
        if 0 < p < 1:
            off = F.coalesce(F.col(c), F.lit(0)) - F.col("n") * p
            differ.append(off * off / (F.col("n") * (p * (1 - p))))
    best = found.orderBy(F.desc(F.greatest(*differ)), "hash").limit(FEATURES).select("hash")
    return np.sort(best.toPandas()["hash"].to_numpy(dtype=np.int64))


def _model(rows: DataFrame, category: str):
    """A fitted model, or the constant probability if there are not two classes."""
    classes = {r[category]: r["count"] for r in rows.groupBy(category).count().collect()}
    if len(classes) < 2:
        return float(next(iter(classes), 0))
    return LogisticRegression(
        labelCol=category, weightCol="weight", elasticNetParam=1.0, regParam=PENALTY, maxIter=20, standardization=False
    ).fit(rows)


def _link(model, category: str, vocabulary: np.ndarray, n_earlier: int) -> Link:
    none = np.zeros(0)
    if isinstance(model, float):
        return Link(category, none.astype(np.int64), none, none, 500.0 if model else -500.0)
    weights = model.coefficients.toArray()
    split = len(weights) - n_earlier
    used = np.flatnonzero(weights[:split])
    used = used[used < len(vocabulary)]
    return Link(
        category, vocabulary[used], weights[used], weights[split:], float(model.intercept)
    )


def _out_of_fold(data: DataFrame, links: list[Link], earlier: list[str], name: str) -> DataFrame:
    """``data`` with the probability that the model of the other folds gives each row."""
    context = data.sparkSession.sparkContext
    result = F.lit(None).cast("double")
    for fold, link in enumerate(links):
        result = F.when(F.col("fold") == fold, _probability(context.broadcast(link), earlier)).otherwise(
            result
        )
    return data.withColumn(name, result)


def _probability(shared, earlier: list[str]) -> Column:
    def judge(hashes: pa.Array, *before: pa.Array) -> pa.Array:
        sizes = hashes.value_lengths().to_numpy(zero_copy_only=False)
        features = hashes.flatten().to_numpy(zero_copy_only=False)
        done = [x.to_numpy(zero_copy_only=False) for x in before]
        return pa.array(shared.value.probability(np.cumsum(np.r_[0, sizes]), features, done))

    return F.arrow_udf(judge, "double")("hashes", *earlier)


def predict(docs: DataFrame, chain: Chain, text: str = "text") -> Column:
    """A struct column: a probability per category, and ``any_word``."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [link.category for link in chain.links]

    def judge(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(block) for block in blocks(texts)]
        p = np.concatenate([np.zeros((len(names), 0)), *(x for x, _ in found)], axis=1)
        some = np.concatenate([np.zeros(0, bool), *(x for _, x in found)])
        release_memory()
        return pa.StructArray.from_arrays(
            [*(pa.array(row) for row in p), pa.array(some)], [*names, "any_word"]
        )

    fields = ",".join([*(f"`{c}`:double" for c in names), "any_word:boolean"])
    return F.arrow_udf(judge, f"struct<{fields}>")(F.lower(F.col(text)))


def held_out(doc_id: Column) -> Column:
    """A fifth of the ids, whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Probabilities of low quality and, given that, toxicity, for every row of ``docs``."""
    known = labels.filter(~held_out(F.col("doc_id"))).select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic"
    )
    chain = fit(docs, known, ["low_quality", "toxic"])
    judged = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(docs, chain).alias("p")
    )
    return judged.select(
        "doc_id",
        "held_out",
        F.col("p.low_quality").alias("p_low_quality"),
        F.col("p.toxic").alias("p_toxic"),
        (F.col("p.any_word") & (F.col("p.toxic") >= THRESHOLD)).alias("toxic"),
    )
