"""First rows of a frame in a stated order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The ``n`` first rows; Spark keeps ``n`` per partition and never sorts the whole.

    The order should end in a key, so that the same rows come first every time. An ordered
    limit at the root of a plan is merged on the driver, ``n`` rows from every partition;
    with the (free) coalesce above it, a task does that and the driver sees ``n`` rows.
    """
    return df.orderBy(*order).limit(n).coalesce(1)
