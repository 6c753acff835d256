"""Text forms of figures, for export projections only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(value: str) -> Column:
    return F.format_number(F.col(value), 0)


def currency(value: str) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.col(value), 2))


def percent(value: str) -> Column:
    """Two decimals and a percent sign."""
    return F.concat(F.format_number(F.col(value), 2), F.lit("%"))


def timestamp_text(value: str) -> Column:
    return F.date_format(F.col(value), "yyyy-MM-dd HH:mm:ss")
