"""Language identification by hierarchical discrimination.

A linear support vector machine first tells the language family; linear machines for every
pair of languages of a family (one versus one) then separate the close relatives within
it. Features are the letter trigrams of the whole text, hashed into ``BINS`` bins, as
square roots of shares (so the length of a text does not matter).

Fitting uses Spark's ``LinearSVC`` on a bounded sample of the labelled rows: about
``TRAIN_ROWS`` texts per language, drawn by a hash of the id, all rows if there are fewer.
Prediction is one pass without a shuffle; each block of texts is one matrix product.

Defined cases: a null text and a text without a letter are ``und`` with score 0; rows with a
null language are not learned from; with one learned language every other text gets it;
with none every text is ``und``. Repeated rows are judged each by itself; equal margins go to
the language that sorts first. Languages without a known family share the family ``other``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.llm.blocks import Block, arrow_lists, blocks, release_memory
from riskledger.llm.storage import Scratch

BINS = 4096
TRAIN_ROWS = 1500
UNDETERMINED = "und"
#: Margins are turned into scores by a logistic curve of this steepness.
STEEPNESS = 3.0

#: Families by primary language subtag.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

# Letters keep their byte, all else becomes a blank.
_FOLD = np.full(256, 0x20, dtype=np.uint8)
for _b in [*range(0x61, 0x7B), *range(0x80, 0x100)]:
    _FOLD[_b] = _b


def family_of(language: str) -> str:
    return _FAMILY.get(language.lower().replace("_", "-").split("-")[0], "other")


def trigram_shares(block: Block) -> np.ndarray:
    """Square roots of trigram shares, one row per text of the block."""
    n = len(block)
    data = np.full(len(block.data) + 2 * n, 0x20, dtype=np.uint8)
    text = np.repeat(np.arange(n), np.diff(block.offsets))
    data[np.arange(len(block.data)) + 2 * text + 1] = _FOLD[block.data]
    a, b, c = data[:-2], data[1:-1], data[2:]
    # A trigram counts if its middle is a letter, so blanks only mark word edges.
    at = np.flatnonzero(b != 0x20)
    code = (a[at].astype(np.uint32) << 16) | (b[at].astype(np.uint32) << 8) | c[at]
    with np.errstate(over="ignore"):
        spot = (code * np.uint32(2654435761)) >> np.uint32(20)
    owner = np.searchsorted(block.offsets[1:] + 2 * np.arange(1, n + 1), at + 1, side="right")
    counts = np.bincount(owner * BINS + spot, minlength=n * BINS).reshape(n, BINS)
    counts = counts.astype(np.float32)
    total = counts.sum(axis=1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1))


@dataclass
class Machine:
    weights: np.ndarray
    intercept: float


@dataclass
class Model:
    """Families, languages and the machines between them; a few hundred KB at most."""

    languages: dict[str, list[str]] = field(default_factory=dict)
    family_machines: dict[str, Machine] = field(default_factory=dict)
    pair_machines: dict[tuple[str, str], Machine] = field(default_factory=dict)

    def predict(self, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row."""
        n = len(shares)
        families = list(self.languages)
        if not families:
            return np.full(n, UNDETERMINED, object), np.zeros(n)
        margins = np.zeros((n, len(families)))
        for j, family in enumerate(families):
            if machine := self.family_machines.get(family):
                margins[:, j] = shares @ machine.weights + machine.intercept
        best = margins.argmax(axis=1)
        score = _share(margins) if len(families) > 1 else np.ones(n)
        out = np.full(n, UNDETERMINED, object)
        for j, family in enumerate(families):
            rows = np.flatnonzero(best == j)
            own = self.languages[family]
            if len(rows):
                chosen, inner = self._within(shares[rows], own)
                out[rows] = np.array(own, object)[chosen]
                score[rows] *= inner
        return out, np.clip(score, 0.0, 1.0)

    def _within(self, shares: np.ndarray, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
        votes = np.zeros((len(shares), len(languages)))
        margins = np.zeros_like(votes)
        for (i, a), (j, b) in combinations(enumerate(languages), 2):
            machine = self.pair_machines[(a, b)]
            margin = shares @ machine.weights + machine.intercept
            votes[:, i] += margin > 0
            votes[:, j] += margin <= 0
            margins[:, i] += margin
            margins[:, j] -= margin
        # Votes decide; margins, squeezed below one vote, break ties.
        chosen = (votes + np.tanh(margins) * 0.49).argmax(axis=1)
        if len(languages) == 1:
            return chosen, np.ones(len(shares))
        return chosen, _share(margins)


def _share(margins: np.ndarray) -> np.ndarray:
    """Logistic share of the best margin against the next one."""
    top = np.sort(margins, axis=1)
    return 1 / (1 + np.exp(-STEEPNESS * np.clip(top[:, -1] - top[:, -2], 0, 50) / 2))


def _features(batches):
    for batch in batches:
        for block in blocks(batch.column("text"), rows=512):
            shares = trigram_shares(block)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang").slice(block.first, len(block)),
                    arrow_lists(
                        shares.ravel(), np.arange(len(block) + 1) * BINS, pa.float32()
                    ),
                ],
                ["lang", "shares"],
            )


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from ``text``, ``lang`` and the sampling key ``doc_id`` of labelled rows."""
    usable = labelled.filter(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return Model()
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000))
    limit = F.lit(0)
    for language, n in sorted(sizes.items()):
        limit = F.when(
            F.col("lang") == language, F.lit(min(1_000_000, train_rows * 1_000_000 // n + 1))
        ).otherwise(limit)
    scratch = Scratch(labelled.sparkSession, "language-sample")
    sample = scratch.write(
        "features",
        usable.filter(part < limit)
        .filter(has_letter(F.col("text")))
        .select("lang", F.lower("text").alias("text"))
        .mapInArrow(_features, "lang string, shares array<float>"),
    ).select("lang", array_to_vector("shares").alias("features"))
    present = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    model = Model()
    for language in present:
        model.languages.setdefault(family_of(language), []).append(language)
    model.languages = dict(sorted(model.languages.items()))
    families = list(model.languages)
    if len(families) == 2:
        machine = _machine(sample, model.languages[families[0]], model.languages[families[1]])
        model.family_machines[families[0]] = machine
    elif len(families) > 2:
        for family, own in model.languages.items():
            rest = [x for x in present if x not in own]
            model.family_machines[family] = _machine(sample, own, rest)
    for own in model.languages.values():
        for a, b in combinations(own, 2):
            model.pair_machines[(a, b)] = _machine(sample, [a], [b])
    scratch.close()
    return model


def _machine(sample: DataFrame, positive: list[str], negative: list[str]) -> Machine:
    rows = sample.filter(F.col("lang").isin(positive + negative)).withColumn(
        "label", F.col("lang").isin(positive).cast("double")
    )
    fitted = LinearSVC(
        maxIter=30, regParam=1e-4, standardization=False, aggregationDepth=2
    ).fit(rows)
    return Machine(fitted.coefficients.toArray(), float(fitted.intercept))


def predict(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column (lang, score) for ``text``; rows keep their place."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(texts: pa.Array) -> pa.Array:
        languages, scores = [], []
        for block in blocks(texts, rows=512):
            found, score = shared.value.predict(trigram_shares(block))
            languages += found.tolist()
            scores.append(score)
        release_memory()
        return pa.StructArray.from_arrays(
            [
                pa.array(languages, pa.string()),
                pa.array(np.concatenate([np.zeros(0), *scores]), pa.float64()),
            ],
            ["lang", "score"],
        )

    column = F.col(text)
    judged = F.arrow_udf(judge, "struct<lang:string,score:double>")(F.lower(column))
    unknown = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
    return F.when(has_letter(column), judged).otherwise(unknown)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    """Language and score of every row of ``docs``, learned from the rows not held out."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    out = held_out(F.col("doc_id"))
    judged = docs.select("doc_id", out.alias("held_out"), predict(docs, model).alias("p"))
    return judged.select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")
    )


def keep_identified(
    docs: DataFrame, model: Model, languages: list[str] | None = None, min_score: float = 0.0
) -> DataFrame:
    """The rows whose language is determined, and wanted if ``languages`` names some."""
    # The row stands beside the judgement as one column, so no name can clash.
    judged = docs.select(F.struct("*").alias("row"), predict(docs, model).alias("language"))
    keep = (F.col("language.lang") != UNDETERMINED) & (F.col("language.score") >= min_score)
    if languages is not None:
        keep &= F.col("language.lang").isin(languages)
    return judged.filter(keep).select("row.*")
