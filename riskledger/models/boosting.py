"""Boosted trees by first and second derivatives of the log loss, grown level by level.

Every level is one grouped aggregate: per node, feature and bin the sums of the gradients and
hessians of the rows there. Its result has at most (nodes x features x bins) rows and is all the
driver sees; the splits chosen from it go back into the next aggregate as a constant. Derivatives
are summed as whole multiples of 2^-40 (of a larger power for more than four million rows), so
sums do not depend on the order of rows, and neither do the trees.

Rows are stored once with their bins, one small array each. Numbers are binned at quantiles;
a categorical feature is one bin per value, and each of its values is a column of its own ("is
it this value"), as after one-hot encoding. Trees are complete binary heaps of ``depth`` levels:
a node sends a bin within [lo, hi] to the right, and a leaf above the last level sends every
row to the left, so scoring is ``depth`` steps for every row and tree.

A fitted model is a small table (``model_table``): base value, bins and the nodes of its trees.
``BoostedModel`` turns it into column expressions, for batches and streams.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.models.features import CATEGORICAL_FEATURES, KEY, LABEL, NUMERIC_FEATURES
from riskledger.session import materialise, remove_folder, spread

#: Derivatives are kept as multiples of this while sums of all rows fit a long, see ``unit_for``.
UNIT = 2.0**-40
#: No bin is as high.
TOP = 1 << 20
#: Trees whose values are added up anew at each pass before the sums are stored.
TREES_AT_A_TIME = 10
#: Rows that one task handles at least and at most.
ROWS_A_TASK = 10_000
MOST_ROWS_A_TASK = 250_000
CELLS = ["node", "feature", "bin", "g", "h"]
TREES = "array<struct<feature:array<int>,lo:array<int>,hi:array<int>,value:array<double>>>"


@dataclass(frozen=True)
class BoostSettings:
    """Defaults are fixed values, the published configuration; the rest as that library has it."""

    rounds: int = 250
    depth: int = 5
    step: float = 0.08
    row_share: float = 0.85
    column_share: float = 0.85
    l2: float = 1.0
    least_hessian: float = 1.0
    least_gain: float = 1e-6
    bins: int = 256
    seed: int = 42
    unit: float = UNIT


def unit_for(n: int) -> float:
    """The unit in which sums of ``n`` derivatives, none above one in size, fit a long."""
    return max(UNIT, 2.0 ** (n.bit_length() - 62))


@dataclass
class Bins:
    """Ascending cuts per numeric feature and ascending values per categorical one.

    A number's bin is how many cuts it reaches, a value's bin its place (-1 if unknown).
    """

    cuts: dict[str, list[float]]
    values: dict[str, list[str]]

    @property
    def features(self) -> list[str]:
        return [*self.cuts, *self.values]

    def columns(self) -> list[tuple[int, int | None]]:
        """What a tree may draw: (feature, None) for numbers, (feature, bin) for a value."""
        numbers = [(i, None) for i in range(len(self.cuts))]
        values = [
            (len(self.cuts) + i, v) for i, own in enumerate(self.values.values()) for v in range(len(own))
        ]
        return numbers + values

    def expression(self) -> Column:
        """The bins of a row as an array, one per feature."""
        numbers = [_reached(cuts, F.col(c).cast("double")) for c, cuts in self.cuts.items()]
        values = [
            (F.coalesce(F.array_position(F.lit(own), F.col(c)), F.lit(0)) - 1).cast("int")
            if own
            else F.lit(-1)
            for c, own in self.values.items()
        ]
        return F.array(*numbers, *values)


def _reached(cuts: list[float], x: Column) -> Column:
    return F.size(F.filter(F.lit(cuts), lambda cut: cut <= x)) if cuts else F.lit(0)


def find_bins(
    rows: DataFrame,
    numbers: Sequence[str] = NUMERIC_FEATURES,
    categories: Sequence[str] = CATEGORICAL_FEATURES,
    bins: int = 256,
) -> Bins:
    """Cuts at the distinct values of a number, or at its quantiles if there are more than bins.

    Two aggregates; the driver gets at most ``bins`` values per number and the values of each
    categorical feature, which are columns of the model and so few by nature.
    """
    shares = [k / bins for k in range(1, bins)]
    found = rows.agg(
        *[F.percentile_approx(F.col(c).cast("double"), shares, 100 * bins).alias(f"q_{c}") for c in numbers],
        *[F.min(F.col(c).cast("double")).alias(f"least_{c}") for c in numbers],
        *[F.sort_array(F.collect_set(c)).alias(f"v_{c}") for c in categories],
    ).first()
    few = rows.agg(
        *[F.approx_count_distinct(c, 0.02).alias(c) for c in numbers]
    ).first()
    small = [c for c in numbers if few[c] <= bins / 2]
    exact = (
        rows.agg(*[F.sort_array(F.collect_set(F.col(c).cast("double"))).alias(c) for c in small]).first()
        if small
        else {}
    )
    cuts = {}
    for c in numbers:
        own = exact[c] if c in small else found[f"q_{c}"] or []
        # The least value would cut nothing off.
        cuts[c] = sorted({x for x in own if x > found[f"least_{c}"]})
    return Bins(cuts, {c: found[f"v_{c}"] for c in categories})


@dataclass
class Tree:
    """Nodes of a complete heap: inner ones have feature, lo and hi, the last level values."""

    depth: int
    feature: list[int] = field(default_factory=list)
    lo: list[int] = field(default_factory=list)
    hi: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def __post_init__(self):
        inner = (1 << self.depth) - 1
        # Nothing is within [1, 0]: all rows go to the left.
        self.feature = self.feature or [0] * inner
        self.lo, self.hi = self.lo or [1] * inner, self.hi or [0] * inner
        self.value = self.value or [0.0] * (inner + 1)

    def nodes_of(self, bins: np.ndarray, level: int) -> np.ndarray:
        """The node each row is in after ``level`` steps."""
        feature, lo, hi = (np.array(x) for x in (self.feature, self.lo, self.hi))
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(level):
            own = bins[rows, feature[node]]
            node = 2 * node + 1 + ((own >= lo[node]) & (own <= hi[node]))
        return node

    def values_of(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes_of(bins, self.depth) - (1 << self.depth) + 1]

    def fields(self) -> dict:
        return {"feature": self.feature, "lo": self.lo, "hi": self.hi, "value": self.value}


def literal(trees: Sequence[Tree]) -> Column:
    """The trees as a constant; folded once, and the code compiled for it serves other trees too."""
    return F.from_json(F.lit(json.dumps([t.fields() for t in trees])), TREES)


def node_at(tree: Column, bins: Column, level: int) -> Column:
    """The node of ``tree`` that a row is in after ``level`` steps (the root after none)."""

    def step(node: Column, _: Column) -> Column:
        own = F.get(bins, F.get(tree["feature"], node))
        right = (own >= F.get(tree["lo"], node)) & (own <= F.get(tree["hi"], node))
        return node * 2 + 1 + right.cast("int")

    if not level:
        return F.lit(0)
    return F.aggregate(F.sequence(F.lit(1), F.lit(level)), F.lit(0), step)


def margin(trees: Column, bins: Column, depth: int, start: Column) -> Column:
    """``start`` plus the value of each tree, added in their order."""
    first_leaf = (1 << depth) - 1
    return F.aggregate(
        trees,
        start,
        lambda total, tree: total + F.get(tree["value"], node_at(tree, bins, depth) - first_leaf),
    )


def chance(total: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def drawn_columns(n: int, round_: int, settings: BoostSettings) -> list[int]:
    wanted = max(1, int(settings.column_share * n))
    return sorted(random.Random(f"{settings.seed}:{round_}").sample(range(n), wanted))


def histogram(rows: DataFrame, trees: Sequence[Tree], level: int, round_: int, settings) -> DataFrame:
    """(node, feature, bin, g, h) of the nodes that ``trees[-1]`` has at ``level``: one aggregate.

    ``trees[:-1]`` are those whose values the stored sums lack. Each task walks its rows through
    them and adds its rows' derivatives up by node, feature and bin; the sums of tasks are added
    by a grouped aggregate. Sums are in units.
    """
    added, grown = list(trees[:-1]), trees[-1]
    limit = round(settings.row_share * 1_000_000)

    nodes = 1 << level

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per feature, rows and sums by node and bin.
        cells: dict[int, np.ndarray] = {}
        for batch in batches:
            taken = batch.filter(pc.less(batch.column("part"), limit))
            if not taken.num_rows:
                continue
            bins = _matrix(taken.column("bins"))
            total = taken.column("total").to_numpy()
            for tree in added:
                total = total + tree.values_of(bins)
            p = 1.0 / (1.0 + np.exp(-total))
            g = np.round((p - taken.column("label").to_numpy()) / settings.unit).astype(np.int64)
            h = np.round(np.maximum(p * (1 - p), 1e-16) / settings.unit).astype(np.int64)
            node = grown.nodes_of(bins, level) - (nodes - 1)
            for feature in range(bins.shape[1]):
                own = bins[:, feature] + 1
                kept = cells.get(feature, np.zeros((3, nodes, 0), np.int64))
                more = max(0, int(own.max()) + 1 - kept.shape[2])
                kept = np.pad(kept, ((0, 0), (0, 0), (0, more)))
                code, size = node * kept.shape[2] + own, nodes * kept.shape[2]
                sums = [np.bincount(code, minlength=size), _whole_sums(code, g, size), _whole_sums(code, h, size)]
                cells[feature] = kept + np.reshape(sums, kept.shape)
        for feature, (rows_there, g, h) in cells.items():
            node, bin_ = np.nonzero(rows_there)
            columns = [node + nodes - 1, np.full(len(node), feature), bin_ - 1, g[node, bin_], h[node, bin_]]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in columns], names=CELLS)

    part = F.pmod(F.xxhash64("key", F.lit(round_), F.lit(settings.seed)), F.lit(1_000_000))
    partial_sums = rows.select("bins", "label", "total", part.alias("part")).mapInArrow(
        partial, ", ".join(f"{c} BIGINT" for c in CELLS)
    )
    return partial_sums.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def _whole_sums(code: np.ndarray, units: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of whole numbers by code: of their upper and lower halves, which doubles hold."""
    half = 20
    upper, lower = units >> half, units & ((1 << half) - 1)
    sums = (np.bincount(code, x, size).astype(np.int64) for x in (upper, lower))
    return (next(sums) << half) + next(sums)


def _matrix(bins: pa.Array) -> np.ndarray:
    """One row of bins per row of the batch; all rows have as many."""
    return bins.flatten().to_numpy().reshape(len(bins), -1).astype(np.int64)


def add_values(rows: DataFrame, trees: Sequence[Tree]) -> DataFrame:
    """The stored rows with the values of ``trees`` added to their sums, in order."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, bins = batch.column("total").to_numpy(), _matrix(batch.column("bins"))
            for tree in trees:
                total = total + tree.values_of(bins)
            yield batch.set_column(batch.schema.get_field_index("total"), "total", pa.array(total))

    return rows.mapInArrow(add, rows.schema)


def best_splits(
    cells: np.ndarray, columns: Sequence[tuple[int, int | None]], settings: BoostSettings
) -> dict[int, tuple]:
    """The best split of each node: node -> (feature, lo, hi, (g, h) left, (g, h) right).

    ``cells`` has rows (node, feature, bin, g, h). Among equal gains the first column and
    the lowest cut win. A node without a gain is missing.
    """
    best = {}
    for node in np.unique(cells[:, 0]).tolist():
        own = cells[cells[:, 0] == node]
        anywhere = own[own[:, 1] == own[0, 1]]
        g, h = int(anywhere[:, 3].sum()), int(anywhere[:, 4].sum())
        whole, found = _worth(np.array([g]), np.array([h]), settings)[0], (settings.least_gain, None)
        of_feature = {f: own[own[:, 1] == f] for f in {f for f, _ in columns}}
        for f, value in columns:
            at = of_feature[f]
            at = at[np.argsort(at[:, 2])]
            if value is None:
                right_g, right_h = (np.cumsum(at[::-1, k])[::-1][1:] for k in (3, 4))
                lows, highs = at[1:, 2], np.full(max(0, len(at) - 1), TOP)
            else:
                here = at[at[:, 2] == value]
                right_g, right_h = here[:, 3], here[:, 4]
                lows = highs = here[:, 2]
            left_g, left_h = g - right_g, h - right_h
            gain = (_worth(left_g, left_h, settings) + _worth(right_g, right_h, settings) - whole) / 2
            least = settings.least_hessian / settings.unit
            gain = np.where((left_h >= least) & (right_h >= least), gain, -math.inf)
            if len(gain) and gain.max() > found[0]:
                k = int(np.argmax(gain))
                split = (f, int(lows[k]), int(highs[k]))
                sums = (int(left_g[k]), int(left_h[k])), (int(right_g[k]), int(right_h[k]))
                found = float(gain[k]), (*split, *sums)
        if found[1]:
            best[node] = found[1]
    return best


def _worth(g: np.ndarray, h: np.ndarray, settings: BoostSettings) -> np.ndarray:
    return (g * settings.unit) ** 2 / (h * settings.unit + settings.l2)


def leaf_value(g: int, h: int, settings: BoostSettings) -> float:
    return -settings.step * (g * settings.unit) / (h * settings.unit + settings.l2)


def grow(cells_at, columns, settings: BoostSettings) -> Tree:
    """One tree; ``cells_at(tree, level)`` gives the histogram of that level's nodes."""
    tree, first_leaf = Tree(settings.depth), (1 << settings.depth) - 1
    open_nodes, sums = {0}, {}
    for level in range(settings.depth):
        cells = cells_at(tree, level)
        cells = cells[np.isin(cells[:, 0], sorted(open_nodes))]
        if level == 0 and len(cells):
            root = cells[cells[:, 1] == cells[0, 1]]
            sums[0] = int(root[:, 3].sum()), int(root[:, 4].sum())
        splits = best_splits(cells, columns, settings) if len(cells) else {}
        for node in open_nodes - set(splits):
            if node in sums:
                _settle(tree, node, level, leaf_value(*sums[node], settings))
        open_nodes = set()
        for node, (feature, lo, hi, left, right) in splits.items():
            tree.feature[node], tree.lo[node], tree.hi[node] = feature, lo, hi
            children = 2 * node + 1, 2 * node + 2
            sums[children[0]], sums[children[1]] = left, right
            open_nodes |= set(children)
        if not open_nodes:
            return tree
    for node in open_nodes:
        tree.value[node - first_leaf] = leaf_value(*sums[node], settings)
    return tree


def _settle(tree: Tree, node: int, level: int, value: float) -> None:
    """A leaf above the last level: its rows go left all the way down."""
    for _ in range(level, tree.depth):
        node = 2 * node + 1
    tree.value[node - (1 << tree.depth) + 1] = value


class BoostedModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fraud predictions of boosted trees: adds rawPrediction, probability and prediction."""

    content = Param(Params._dummy(), "content", "base, bins and trees", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, content=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, base: float, bins: Bins, trees: Sequence[Tree], settings: BoostSettings):
        content = {
            "base": base,
            "depth": settings.depth,
            "cuts": bins.cuts,
            "values": bins.values,
            "trees": [t.fields() for t in trees],
        }
        return cls(content=json.dumps(content))

    def parts(self) -> tuple[float, Bins, list[Tree]]:
        own = json.loads(self.getOrDefault("content"))
        trees = [Tree(own["depth"], **t) for t in own["trees"]]
        return own["base"], Bins(own["cuts"], own["values"]), trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        base, bins, trees = self.parts()
        depth = json.loads(self.getOrDefault("content"))["depth"]
        return (
            dataset.withColumn("__bins", bins.expression())
            .withColumn("__total", margin(literal(trees), F.col("__bins"), depth, F.lit(base)))
            .withColumn("__p", chance(F.col("__total")))
            .withColumns(
                {
                    "rawPrediction": array_to_vector(F.array(-F.col("__total"), F.col("__total"))),
                    "probability": array_to_vector(F.array(1 - F.col("__p"), F.col("__p"))),
                    "prediction": (F.col("__p") > 0.5).cast("double"),
                }
            )
            .drop("__bins", "__total", "__p")
        )


def fit(
    rows: DataFrame,
    folder: str,
    settings: BoostSettings | None = None,
    label: str = LABEL,
    key: str = KEY,
    numbers: Sequence[str] = NUMERIC_FEATURES,
    categories: Sequence[str] = CATEGORICAL_FEATURES,
) -> BoostedModel:
    """Boosted trees of the complete rows of ``rows`` (a stored table); scratch below ``folder``.

    Starts from the log odds of the label. Each round draws rows and columns; each level of its
    tree is one pass over the stored bins. The sums of finished trees are stored every few rounds,
    so a pass adds up few trees, and a lost executor costs a re-read.
    """
    settings = settings or BoostSettings()
    spark = rows.sparkSession
    bins = find_bins(rows, numbers, categories, settings.bins)
    n, positives = rows.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0))).first()
    settings = replace(settings, unit=unit_for(n))
    # One label only, or no rows: odds of half a row against the others.
    share = min(max(positives, 0.5), n - 0.5) / n if n else 0.5
    base = math.log(share / (1 - share))
    columns = bins.columns()
    binned = rows.select(
        F.col(key).alias("key"),
        F.col(label).cast("double").alias("label"),
        bins.expression().alias("bins"),
        F.lit(base).alias("total"),
    )
    stored = materialise(
        spread(binned, n, "key", ROWS_A_TASK, MOST_ROWS_A_TASK), f"{folder}/boost-0"
    )
    trees: list[Tree] = []
    waiting: list[Tree] = []
    for round_ in range(settings.rounds):

        def cells_at(tree: Tree, level: int, round_=round_) -> np.ndarray:
            # At most nodes x features x bins rows.
            found = histogram(stored, [*waiting, tree], level, round_, settings).toArrow()
            return np.stack([found.column(c).to_numpy() for c in CELLS], axis=1)

        drawn = [columns[i] for i in drawn_columns(len(columns), round_, settings)]
        trees.append(grow(cells_at, drawn, settings) if n else Tree(settings.depth))
        waiting.append(trees[-1])
        if len(waiting) == TREES_AT_A_TIME and round_ + 1 < settings.rounds:
            before = f"{folder}/boost-{len(trees) - len(waiting)}"
            stored = materialise(add_values(stored, waiting), f"{folder}/boost-{len(trees)}")
            remove_folder(spark, before)
            waiting = []
    return BoostedModel.of(base, bins, trees, settings)
