"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join by node. The minima are written before they are
joined, so both join sides come straight from a shuffle and Spark can split the rows of a
hub. The number of steps grows with the logarithm of the number of nodes; the edges never
outnumber the input. Nothing is collected but the count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.llm.storage import Scratch


def _stored(
    scratch: Scratch, name: str, edges: DataFrame, rows: int | None
) -> tuple[DataFrame, tuple[int, int]]:
    """``edges`` as stored, with their number and a checksum.

    Counted from the files, not by an observation while writing: a session that has made an
    observation can no longer serialise the fitted models that hold on to it.
    """
    stored = scratch.write(name, edges, rows)
    seen = stored.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("sum")
    ).first()
    return stored, (seen["n"], seen["sum"])


def components(
    edges: DataFrame, scratch: Scratch, name: str, rows: int | None = None
) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node.

    Loops (a = b) count as nodes without a partner. Self-contained: the result is stored.
    ``rows`` tells how many edges there are, if that is known.
    """
    ordered = edges.select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    ).distinct()
    now, state = _stored(scratch, f"{name}-0", ordered, rows)
    round_ = 0
    while True:
        before = f"{name}-{round_}"
        round_ += 1
        step = f"{name}-{round_}"
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.filter("hi <> lo").select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = scratch.write(
            f"{step}-m", both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")),
            2 * state[0],
        )
        large = scratch.write(
            f"{step}-large",
            both.filter("v >= u")
            .join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .unionByName(least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
            .distinct(),
            2 * state[0],
        )
        below = scratch.write(
            f"{step}-s", large.groupBy("hi").agg(F.min("lo").alias("m")), 2 * state[0]
        )
        small = (
            large.join(below, "hi")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(below.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        last = state
        now, state = _stored(scratch, step, small, 2 * state[0])
        scratch.drop(before, f"{step}-m", f"{step}-large", f"{step}-s")
        if state == last:
            break
    return now.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))
