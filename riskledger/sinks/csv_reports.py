"""CSV output with a header row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str) -> None:
    """Any number of part files, written by all tasks in parallel.

    Timestamps are written as text, because the CSV writer's own format stops at
    milliseconds.
    """
    text = {
        f.name: F.col(f.name).cast("string")
        for f in df.schema
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))
    }
    if text:
        df = df.withColumns(text)
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """Part files in the order of the report, the first rows in the first file.

    AQE merges the rows of a small report into one partition and so into one file. A large
    one, such as merchants by the million, stays in several files on purpose.
    """
    write_csv(df, path)


def export_tables(
    spark: SparkSession,
    tables: Iterable[str],
    folder: str,
    order: Mapping[str, list[str]] | None = None,
) -> dict[str, str]:
    """Each table to its own CSV folder; returns where each one went.

    ``order`` gives sort columns per table, a leading ``-`` meaning descending.
    """
    written = {}
    for table in tables:
        keys = [
            F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in (order or {}).get(table, [])
        ]
        df = spark.table(table)
        written[table] = f"{folder}/{table}"
        write_report_csv(df.orderBy(*keys) if keys else df, written[table])
    return written
