"""The batch operators applied to arriving payment files.

Every micro-batch is cleaned, scored or predicted by the batch functions and appended to a
Parquet table. Copies are recognised by a digest of the raw row: within the batch, and by an
anti-join against the digests stored for the same days. So no row is ever too late, memory
does not grow with the stream, and the result does not depend on how files fall into
batches. A batch that runs again after a failure replaces its own part of the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskledger.operators.cleaning import repair_and_derive
from riskledger.operators.scoring import score_transactions
from riskledger.schema import RAW_COLUMNS, RAW_SCHEMA
from riskledger.session import shared_folder

BATCH, ROW_KEY, DAY = "batch", "row_key", "row_day"
KEY_SCHEMA = f"{ROW_KEY} STRING, {DAY} DATE, {BATCH} BIGINT"


def read_payment_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw payments from Parquet files as they arrive."""
    return (
        spark.readStream.schema(RAW_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def scored_payments(raw: DataFrame) -> DataFrame:
    return score_transactions(repair_and_derive(raw))


def not_seen(batch: DataFrame, number: int, keys: str) -> DataFrame:
    """Rows of a batch with their digest and day, without copies and rows of other batches."""
    spark = batch.sparkSession
    cells = F.to_json(F.struct(*RAW_COLUMNS), {"ignoreNullFields": "false"})
    new = batch.withColumns(
        {ROW_KEY: F.sha2(cells, 256), DAY: F.to_date("transaction_datetime")}
    ).dropDuplicates([ROW_KEY])
    days = new.select(F.col(DAY).alias("day")).distinct()
    seen = (
        spark.read.schema(KEY_SCHEMA)
        .parquet(keys)
        .filter(F.col(BATCH) != number)
        .join(days, F.col(DAY).eqNullSafe(F.col("day")), "left_semi")
    )
    return new.join(seen, ROW_KEY, "left_anti")


def write_stream(
    raw: DataFrame,
    path: str,
    checkpoint: str | None = None,
    shape: Callable[[DataFrame], DataFrame] = scored_payments,
) -> StreamingQuery:
    """Append what is available now, shaped, and stop; a restart resumes where it ended.

    ``shape`` turns raw payments into the rows to store. Digests go to ``path`` + ``-keys``.
    """
    spark = raw.sparkSession
    keys = f"{path}-keys"
    spark.createDataFrame([], f"{ROW_KEY} STRING, {DAY} DATE").write.mode("overwrite").parquet(
        f"{keys}/{BATCH}=-1"
    )

    def append(batch: DataFrame, number: int) -> None:
        new = not_seen(batch, number, keys).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            shape(new.select(*RAW_COLUMNS)).write.mode("overwrite").parquet(
                f"{path}/{BATCH}={number}"
            )
            new.select(ROW_KEY, DAY).write.mode("overwrite").parquet(f"{keys}/{BATCH}={number}")
        finally:
            new.unpersist()

    return (
        raw.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint or shared_folder(spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
