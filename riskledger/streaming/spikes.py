"""Fraud-spike alerts on arriving payment files.

A micro-batch appends the window counts of its new payments; copies of payments seen before
are left out by ``write_stream``. Alerts are read from the sums of these counts, so a late
payment changes the window it belongs to, and any order and grouping of files ends with the
alerts of the batch. Memory does not grow with the stream, and a batch that runs again
replaces its own counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskledger.operators.cleaning import repair_and_derive
from riskledger.operators.spikes import BASELINE, DAYS, WINDOW, added_up, spikes, window_counts
from riskledger.streaming.payments import BATCH, write_stream


def write_window_counts(
    raw: DataFrame, path: str, checkpoint: str | None = None, days: int = DAYS
) -> StreamingQuery:
    """Append the window counts of what is available now, and stop."""
    return write_stream(
        raw, path, checkpoint, lambda new: window_counts(repair_and_derive(new), days)
    )


def current_spikes(spark: SparkSession, path: str, **rule: int) -> DataFrame:
    """All alerts as of the last batch; ``rule`` as for ``spikes``."""
    return spikes(added_up(spark.read.parquet(path)), **rule)


def spikes_after(
    spark: SparkSession, path: str, batch: int, baseline: int = BASELINE, **rule: int
) -> DataFrame:
    """Alerts that payments of one batch can have raised or changed.

    These are the alerts of the windows with such payments and of those whose past they
    are in; only counts of the merchants concerned are added up.
    """
    stored = spark.read.parquet(path)
    reached = F.explode(F.sequence(F.col(WINDOW), F.col(WINDOW) + baseline)).alias("reached")
    touched = stored.filter(F.col(BATCH) == batch).select(
        F.col("merchant_id").alias("merchant"), reached
    )
    own = F.col("merchant_id").eqNullSafe(F.col("merchant"))
    concerned = stored.join(touched.select("merchant").distinct(), own, "left_semi")
    found = spikes(added_up(concerned), baseline=baseline, **rule)
    return found.join(touched.distinct(), own & (F.col(WINDOW) == F.col("reached")), "left_semi")
