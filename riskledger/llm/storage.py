"""Tables of a run, its intermediate folders, and joins that check what they broadcast."""

from __future__ import annotations

import atexit
import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger.session import materialise, remove_folder, shared_folder

#: Largest side that is sent to every executor, as rows times bytes of a row.
BROADCAST_BYTES = 32 << 20
#: Rows of a few bytes that one task writes at least.
ROWS_A_FILE = 100_000


#: Bytes of rows that Spark hands to a Python worker at a time, where the session says nothing.
BATCH_BYTES = 8 << 20
_BATCH, _SPARKS_OWN = "spark.sql.execution.arrow.maxBytesPerBatch", {"67108864b", "64m", "64MB"}


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's 64 MB, which a worker holds several times over."""
    if spark.conf.get(_BATCH) in _SPARKS_OWN:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Folders of one run below the shared folder.

    ``write`` cuts lineage: the rows are read back from files every executor reaches, so a
    lost executor costs a re-read. ``drop`` frees what later steps no longer read. What a
    lazily returned result still reads is removed when the process ends.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        bound_batches(spark)
        self.spark, self.purpose, self.paths = spark, purpose, {}
        atexit.register(self.close)

    def write(self, name: str, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Stores ``df``; with about ``rows`` small rows expected, by as few tasks as fit."""
        path = shared_folder(self.spark, f"{self.purpose}-{name}")
        self.paths[name] = path
        if rows is not None:
            df = df.coalesce(1 + rows // ROWS_A_FILE)
        return materialise(df, path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove_folder(self.spark, self.paths.pop(name))

    def close(self) -> None:
        with contextlib.suppress(Exception):  # the session may be gone already
            for name in list(self.paths):
                self.drop(name)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Marks a side of counted size for broadcast; a larger one is left to a shuffle join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
