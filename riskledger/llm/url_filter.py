"""URL filter: rules first, then trust and distrust propagated over the link graph of hosts.

A rule names a host, which stands for its subdomains too, and the beginning of a path; the
longest rule that fits decides. Pages that no rule decides go by their host. Hosts most of
whose pages rules allow are trusted seeds, hosts most of whose pages rules block are blocked
seeds. Trust is a personalised PageRank from the trusted seeds along links; distrust is one
from the blocked seeds against the links, since who links to bad hosts is suspect, the more the larger the share of
its links that do. Both run
in one loop of a join and a sum per host, each round stored, until nothing moves. A host is
blocked if its distrust, in units of what a blocked seed starts with, reaches
``DISTRUST`` and exceeds its trust in units of a trusted seed.

Edges are counted per page, summed per pair of hosts before any join, so a hub with a third
of all pages is a few rows. Only two sums per round reach the driver.

Defined cases: a url that is null or without ``://`` has an empty host and path, no rule
fits it and it is allowed; a null page has no links; links to the own host or without a
host are no edges; repeated rows are pages of their own; without seeds or links only rules
and seeds decide; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.llm.storage import Scratch, broadcast_if_small

ALLOW, BLOCK = "allow", "block"
RULES = ((BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/"))
DAMPING = 0.85
TOLERANCE = 1e-7
#: A round moves at most ``DAMPING`` times what the one before it moved, the first two a kind.
ROUNDS = 2 + math.ceil(math.log(TOLERANCE / 4) / math.log(DAMPING))
DISTRUST = 0.1

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^"'\s>]*)"""


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, slash, rest = rule.partition("/")
    under = (host == name) | host.endswith(f".{name}")
    return under & path.startswith(slash + rest)


def judged_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, decided): the longest rule that fits, and what it says."""
    host, path = F.col("host"), F.col("path")
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, pattern in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        fits = _fits(pattern, host, path)
        rule = F.when(fits, pattern).otherwise(rule)
        decided = F.when(fits, action).otherwise(decided)
    parsed = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    return parsed.withColumns({"rule": rule, "decided": decided})


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, pages): how many pages of a host link to another host."""
    found = F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))
    # A link without a scheme begins with two slashes.
    hosts = F.transform(
        found,
        lambda x: host_of(F.when(x.startswith("//"), F.concat(F.lit("x:"), x)).otherwise(x)),
    )
    return (
        pages.select(host_of(F.col("url")).alias("src"), F.explode(F.array_distinct(hosts)).alias("dst"))
        .filter("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("pages"))
    )


def host_seeds(judged: DataFrame) -> DataFrame:
    """(kind, host) of trusted and blocked seeds."""
    share = [
        F.avg(F.when(F.col("decided") == action, 1.0).otherwise(0.0)).alias(action)
        for action in (ALLOW, BLOCK)
    ]
    hosts = judged.filter("host <> ''").groupBy("host").agg(*share)
    kind = F.when(F.col(ALLOW) > 0.5, ALLOW).when(F.col(BLOCK) > 0.5, BLOCK)
    return hosts.select(kind.alias("kind"), "host").filter("kind IS NOT NULL")


def propagate(edges: DataFrame, seeds: DataFrame, scratch: Scratch) -> DataFrame:
    """(kind, host, rank): personalised PageRank of trust, and of distrust on reversed edges.

    Mass of hosts without links returns to the seeds. Ranks of a kind add up to one.
    """
    both = edges.select(
        F.lit(ALLOW).alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "pages"
    ).unionByName(
        edges.select(
            F.lit(BLOCK).alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "pages"
        )
    )
    # Distrust goes to a linking host by the share of its links that point here.
    links = edges.groupBy("src").agg(F.sum("pages").alias("links"))
    both = both.join(links.withColumnRenamed("src", "to"), "to", "left").withColumn(
        "force", F.when(F.col("kind") == ALLOW, F.col("pages")).otherwise(F.col("pages") / F.col("links"))
    )
    out = both.groupBy("kind", "host").agg(F.sum("force").alias("all"))
    weights = scratch.write(
        "weights",
        both.join(out, ["kind", "host"]).select(
            "kind", "host", "to", (F.col("force") / F.col("all")).alias("weight")
        ),
    )
    sizes = {r["kind"]: r["count"] for r in seeds.groupBy("kind").count().collect()}

    def per_kind(values: dict) -> Column:
        out = F.lit(0.0)
        for kind in (ALLOW, BLOCK):
            out = F.when(F.col("kind") == kind, F.lit(float(values.get(kind, 0.0)))).otherwise(out)
        return out

    start = scratch.write(
        "seeds", seeds.withColumn("seed", per_kind({k: 1 / n for k, n in sizes.items()}))
    )
    ranks = start.withColumnRenamed("seed", "rank")
    if weights.isEmpty():
        return ranks
    for i in range(ROUNDS):
        flow = scratch.write(
            f"flow-{i}",
            weights.join(ranks, ["kind", "host"])
            .groupBy("kind", F.col("to").alias("host"))
            .agg(F.sum(F.col("rank") * F.col("weight")).alias("flow")),
        )
        moved = {r["kind"]: r["m"] for r in flow.groupBy("kind").agg(F.sum("flow").alias("m")).collect()}
        back = per_kind({k: 1 - moved.get(k, 0.0) for k in (ALLOW, BLOCK)})
        seed, inflow = F.coalesce("seed", F.lit(0.0)), F.coalesce("flow", F.lit(0.0))
        now = scratch.write(
            f"ranks-{i}",
            start.join(flow, ["kind", "host"], "full")
            .join(ranks.withColumnRenamed("rank", "was"), ["kind", "host"], "left")
            .select(
                "kind",
                "host",
                ((1 - DAMPING) * seed + DAMPING * (inflow + back * seed)).alias("rank"),
                F.coalesce("was", F.lit(0.0)).alias("was"),
            ),
        )
        moved = now.agg(F.sum(F.abs(F.col("rank") - F.col("was"))).alias("m")).first()["m"] or 0.0
        ranks = now.drop("was")
        scratch.drop(f"flow-{i}", *([f"ranks-{i - 1}"] if i else []))
        if moved < TOLERANCE:
            return ranks
    raise RuntimeError(f"ranks still move by {moved} after {ROUNDS} rounds")


def blocked_hosts(ranks: DataFrame, sizes: dict[str, int], distrust: float = DISTRUST) -> DataFrame:
    """(host): hosts whose distrust is high, and higher than their trust."""
    lifts = ranks.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == ALLOW, F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == BLOCK, F.col("rank")).otherwise(0.0)).alias("distrust"),
    )
    trust = F.col("trust") * sizes.get(ALLOW, 0)
    bad = F.col("distrust") * sizes.get(BLOCK, 0)
    return lifts.filter((bad >= distrust) & (bad > trust)).select(F.col("host").alias("bad_host"))


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``."""
    scratch = Scratch(pages.sparkSession, "url-filter")
    judged = judged_by_rules(pages, rules)
    seeds = scratch.write("hosts", host_seeds(judged))
    edges = scratch.write("edges", host_edges(pages))
    sizes = {r["kind"]: r["count"] for r in seeds.groupBy("kind").count().collect()}
    bad = scratch.write("bad", blocked_hosts(propagate(edges, seeds, scratch), sizes))
    bad = broadcast_if_small(bad, bad.count(), 64)
    by_host = F.when(F.col("bad_host").isNotNull(), BLOCK).otherwise(ALLOW)
    return judged.join(bad, judged["host"] == bad["bad_host"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("decided", by_host).alias("verdict")
    )
