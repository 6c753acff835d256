"""Session settings and the shared folder for materialised intermediates."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits oversized partitions of a rebalanced write and merges tiny ones.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Python call sites for every column expression; costs a round trip each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "riskledger",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with this library's settings; cluster sizing stays with the caller.

    On a cluster leave ``master`` to spark-submit and give ``shuffle_partitions`` a
    number near (shuffled bytes / 128 MB): AQE merges what turns out too small, but
    never splits a partition of an ordinary aggregate.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is chosen only when Spark itself runs inside one machine.
    """
    context = spark.sparkContext
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="riskledger-")
        context.setCheckpointDir(root)
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder (not created yet)."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write once as Parquet, usually to a ``shared_folder``, and read back.

    Cuts the lineage without pinning executor storage: a lost executor re-reads files
    instead of replaying the shuffles, and later readers still prune columns.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, n: int, key: str, least: int, most: int) -> DataFrame:
    """``n`` rows dealt evenly by ``key`` for many short passes over them, in order of the key.

    A task a slot, so that a pass is one wave: fewer if tasks would have under ``least`` rows,
    more if they would have over ``most``.
    """
    slots = rows.sparkSession.sparkContext.defaultParallelism
    tasks = min(1 + n // least, max(slots, 1 + n // most))
    return rows.repartition(tasks, key).sortWithinPartitions(key)


def temporary_folder(spark: SparkSession, purpose: str) -> str:
    """A ``shared_folder`` that is deleted when the process ends.

    For results that are read lazily, so nobody else knows when they are done with.
    """
    path = shared_folder(spark, purpose)
    atexit.register(_forget, spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone already
        remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
