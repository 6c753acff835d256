"""Every report grain from one stored table of sums.

Run on its own, each report scans the fact table once. A refresh of all reports would
scan it once per report, so the refresh aggregates the grains of few groups together with
grouping sets: one scan, one shuffle of partially aggregated rows, and every report is then
a filter on a small table. Merchants, of which there can be millions, are an aggregate of
their own beside it, so that they do not fill the map-side table the other grains share.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.functions.measures import additive_measures, measure_inputs, summarise

GRAINS: dict[str, tuple[str, ...]] = {
    "overall": (),
    "daily": ("transaction_date",),
    "hourly": ("hour",),
    "monthly": ("month",),
    "merchant": ("merchant_id", "merchant_category"),
    "category": ("merchant_category",),
    "channel": ("channel",),
    "method": ("payment_method",),
    "location": ("customer_location",),
    "weekend": ("is_weekend",),
    "response": ("slow_response",),
    "value": ("high_value_txn",),
    "reason": ("failure_reason",),
    "level": ("risk_level",),
}
DIMENSIONS = list(dict.fromkeys(column for keys in GRAINS.values() for column in keys))
#: Grains whose number of groups grows with the data.
LARGE = ("merchant",)


def grouping_number(keys: tuple[str, ...], dimensions: list[str]) -> int:
    """The value of ``grouping_id()`` for a set: one bit per dimension left out."""
    return int("".join("0" if d in keys else "1" for d in dimensions), 2)


def kpi_rollup(scored: DataFrame) -> DataFrame:
    """Additive measures for every grain, labelled by ``grain``.

    Grouping sets copy each row once per grain before the map-side aggregation, so what a
    row contributes is computed beforehand and only numbers are copied.
    """
    inputs = scored.select(
        *DIMENSIONS, *measure_inputs(), F.col("risk_score").alias("score_total")
    )
    sums = [*additive_measures(), F.sum("score_total").alias("score_total")]
    few = {name: keys for name, keys in GRAINS.items() if name not in LARGE}
    shared = [d for d in DIMENSIONS if any(d in keys for keys in few.values())]
    rolled = inputs.groupingSets(
        [[F.col(c) for c in keys] for keys in few.values()], *shared
    ).agg(F.grouping_id().alias("grouping"), *sums)
    grain = F.lit(None).cast("string")
    for name, keys in few.items():
        grain = F.when(F.col("grouping") == grouping_number(keys, shared), name).otherwise(grain)
    result = rolled.withColumn("grain", grain).drop("grouping")
    for name in LARGE:
        own = inputs.groupBy(*GRAINS[name]).agg(*sums).withColumn("grain", F.lit(name))
        result = result.unionByName(own, allowMissingColumns=True)
    return result


def at_grain(rollup: DataFrame, name: str) -> DataFrame:
    """The rows of one grain, shaped like ``summarise`` over that grain's keys."""
    others = [d for d in DIMENSIONS if d not in GRAINS[name]]
    return rollup.filter(F.col("grain") == name).drop("grain", *others)


@dataclass(frozen=True)
class Report:
    """A report: its grain, and how to shape that grain's additive sums.

    ``rows`` may narrow the payments beforehand; it must not change the shaped result, as
    the rollup has all payments. ``order`` sorts the result; files of a table have no order,
    so what goes to a table is left ``unsorted``.
    """

    grain: str
    shape: Callable[[DataFrame], DataFrame]
    rows: Callable[[DataFrame], DataFrame] | None = None
    order: tuple[str, ...] = ()

    def unsorted(self) -> Report:
        return replace(self, order=())

    def over_payments(self, payments: DataFrame) -> DataFrame:
        chosen = self.rows(payments) if self.rows else payments
        return self.sorted(self.shape(summarise(chosen, *GRAINS[self.grain])))

    def over_rollup(self, rollup: DataFrame) -> DataFrame:
        return self.sorted(self.shape(at_grain(rollup, self.grain)))

    def sorted(self, report: DataFrame) -> DataFrame:
        return report.orderBy(*sort_columns(self.order)) if self.order else report


def sort_columns(keys: Sequence[str]) -> list[Column]:
    """Sort columns by name, a leading ``-`` meaning descending."""
    return [F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys]
