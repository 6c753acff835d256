"""Raw payments from CSV, with a declared schema instead of inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskledger.schema import MISSING_TOKENS, RAW_COLUMNS, RAW_SCHEMA

TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
UNREADABLE = "unreadable"


def blank_to_null(column: str) -> Column:
    value = F.col(column)
    return F.when(~F.trim(value).isin(MISSING_TOKENS), value)


def as_type(text: Column, kind: T.DataType) -> Column:
    """The value of a cell, null if it can't be read; whole numbers may end in ``.0``."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.IntegerType):
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number.cast("bigint").try_cast("int"))
        return F.coalesce(text.try_cast("int"), whole)
    return text.try_cast(kind.simpleString())


def scan_payments_csv(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(payments, quarantined) from one set of files; every row is in one of the two.

    Missing-value text is null in any column. A row with a cell that is neither missing nor
    readable is quarantined: its cells as text, and the names of the ``unreadable`` columns.
    """
    text = spark.read.schema(TEXT_SCHEMA).option("header", True).csv(path)
    present = text.select(*[blank_to_null(c).alias(c) for c in RAW_COLUMNS])
    values = {f.name: as_type(F.col(f.name), f.dataType) for f in RAW_SCHEMA}
    failed = F.filter(
        F.array(
            *[
                F.when(F.col(c).isNotNull() & value.isNull(), F.lit(c))
                for c, value in values.items()
                if not isinstance(RAW_SCHEMA[c].dataType, T.StringType)
            ]
        ),
        lambda c: c.isNotNull(),
    )
    parsed = present.withColumn(UNREADABLE, failed)
    payments = parsed.filter(F.size(UNREADABLE) == 0).select(
        *[value.alias(c) for c, value in values.items()]
    )
    return payments, parsed.filter(F.size(UNREADABLE) > 0)


def read_payments_csv(
    spark: SparkSession, path: str | list[str], mode: str = "PERMISSIVE"
) -> DataFrame:
    """The readable rows; with ``mode="FAILFAST"`` an unreadable cell stops the job.

    ``scan_payments_csv`` also gives the rows that were left out.
    """
    payments, quarantined = scan_payments_csv(spark, path)
    if mode == "FAILFAST":
        stop = F.raise_error(
            F.concat(F.lit("unreadable payment cells: "), F.to_json(F.struct(*TEXT_SCHEMA.names)))
        )
        never = quarantined.select(
            *[stop.cast(f.dataType).alias(f.name) for f in RAW_SCHEMA]
        )
        payments = payments.unionByName(never)
    return payments
