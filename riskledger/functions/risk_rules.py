"""The additive risk rules, as data.

A rule group is a ladder: the first step whose condition holds gives its points and its
label, so a group with one step is an independent rule. Groups marked ``known_after``
look at outcomes (fraud, chargeback) that are not known while a payment is in flight.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Step:
    """A SQL condition, the points it gives and the label it is listed under."""

    condition: str
    points: int
    label: str


@dataclass(frozen=True)
class RuleGroup:
    steps: tuple[Step, ...]
    known_after: bool = False

    def points(self) -> str:
        return self.first_match([str(step.points) for step in self.steps], "0")

    def label(self) -> str:
        return self.first_match([sql_text(step.label) for step in self.steps], "NULL")

    def first_match(self, results: list[str], otherwise: str) -> str:
        branches = " ".join(
            f"WHEN {step.condition} THEN {result}" for step, result in zip(self.steps, results)
        )
        return f"CASE {branches} ELSE {otherwise} END"


# Rules in the order their labels are listed.
RULES = (
    RuleGroup(
        (
            Step("transaction_amount >= 2000", 30, "Very high amount"),
            Step("transaction_amount >= 1000", 20, "High amount"),
            Step("transaction_amount >= 500", 10, "Elevated amount"),
        )
    ),
    RuleGroup((Step("is_fraud = 1", 40, "Fraud indicator"),), known_after=True),
    RuleGroup((Step("is_chargeback = 1", 35, "Chargeback"),), known_after=True),
    RuleGroup((Step("transaction_status = 'Failed'", 15, "Failed transaction"),)),
    RuleGroup((Step("slow_response = 1", 10, "Slow processor response"),)),
    RuleGroup(
        (
            Step("channel = 'Online'", 8, "Online channel"),
            Step("channel = 'Mobile App'", 4, "Mobile channel"),
        )
    ),
    RuleGroup(
        (
            Step(
                "merchant_category IN ('Travel', 'Electronics', 'Financial Services')",
                12,
                "High-risk merchant category",
            ),
        )
    ),
    RuleGroup((Step("customer_location IN ('FL', 'NV', 'NY')", 8, "High-risk location"),)),
)

# Lowest score of each level, highest first.
LEVELS = ((75, "Critical Risk"), (50, "High Risk"), (25, "Medium Risk"))
LOWEST_LEVEL = "Low Risk"
NO_REASON = "No major indicators"

POST_TXN = RULES
PRE_TXN = tuple(group for group in RULES if not group.known_after)


def score_of(rules: tuple[RuleGroup, ...]) -> Column:
    return F.expr(" + ".join(group.points() for group in rules))


def level_of(score: str) -> Column:
    branches = " ".join(f"WHEN {score} >= {floor} THEN {sql_text(name)}" for floor, name in LEVELS)
    return F.expr(f"CASE {branches} ELSE {sql_text(LOWEST_LEVEL)} END")


def reasons_of(rules: tuple[RuleGroup, ...]) -> Column:
    """Labels of the rules that fired, as an array."""
    return F.expr(f"array_compact(array({', '.join(group.label() for group in rules)}))")


def reason_text_of(rules: tuple[RuleGroup, ...]) -> Column:
    labels = ", ".join(group.label() for group in rules)
    return F.expr(f"coalesce(nullif(concat_ws(', ', {labels}), ''), {sql_text(NO_REASON)})")
