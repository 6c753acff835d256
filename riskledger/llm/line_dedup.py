"""Line dedup by site-relative frequency, in DataFrame functions only.

For every host, the share of its pages that contain a line is taken; lines on more than
``ratio`` of the pages, and on ``min_pages`` at least (a line on one page repeats nothing), are
boilerplate and are dropped from all pages of that host. Lines are compared without surrounding
blanks, and blank lines are left alone. Rows of one host with equal texts are one page: else a
group of copies would make boilerplate of all its lines, and every copy would lose them.

Equal texts are found by 128-bit digests, one row per task and text of a group of copies. They
travel with a pair of 64-bit hashes per distinct line of the page; these are then counted, summed
per task first, so a line that stands on every page costs a row per task. A host has at most
(lines per page / ratio) boilerplate lines, so they fit in one row per host. Texts stay
where they are while those rows are few enough to broadcast; beyond that Spark joins by host,
splitting hot hosts (adaptive skew join).

Defined cases: repeated rows are one page, and all of them are cleaned; a null host is a host;
null texts of a host are one page without lines and stay null; an empty text has one blank
line; a page whose lines all go keeps its row with an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.llm.storage import Scratch, broadcast_if_small

RATIO = 0.1
MIN_PAGES = 2


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _key(line: Column) -> Column:
    """128 bits of a line: two hashes with different seeds."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b"))


def _blank(line: Column) -> Column:
    return F.trim(line) == ""


def _pages(docs: DataFrame, host: str, text: str) -> DataFrame:
    """(host, d1, d2, lines): one row per distinct text of a host, with the keys of its lines."""
    keys = F.array_distinct(F.transform(F.filter(_lines(text), lambda x: ~_blank(x)), _key))
    return docs.select(
        F.col(host).alias("host"),
        F.xxhash64(text).alias("d1"),
        F.xxhash64(F.lit(1), text).alias("d2"),
        keys.alias("lines"),
    ).dropDuplicates(["host", "d1", "d2"])


def boilerplate(
    docs: DataFrame,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    host: str = "source",
    text: str = "text",
) -> DataFrame:
    """(host, lines): the keys of boilerplate lines, one row per host that has any."""
    pages = _pages(docs, host, text)
    counts = (
        pages.select("host", F.explode("lines").alias("line"))
        .groupBy("host", "line.a", "line.b")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_pages)
    )
    totals = pages.groupBy(F.col("host").alias("site")).agg(F.count("*").alias("pages"))
    share = F.col("n").cast("double") / F.col("pages")
    return (
        counts.join(totals, F.col("host").eqNullSafe(F.col("site")))
        .filter(share > ratio)
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("lines"))
    )


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``docs`` has no column called so."""
    taken = {c.lower() for c in docs.columns}
    free = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        free.append(name)
    return free


def without_boilerplate(
    docs: DataFrame,
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    host: str = "source",
    text: str = "text",
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` with boilerplate dropped from ``text``.

    ``counts`` names two more columns: the lines that were there, and those that went.
    """
    scratch = Scratch(docs.sparkSession, "boilerplate")
    site, listed, left = _unused(docs, "site", "boilerplate", "kept")
    found = scratch.write(
        "lines",
        boilerplate(docs, ratio, min_pages, host, text).select(
            F.col("host").alias(site), F.col("lines").alias(listed)
        ),
    )
    size = found.agg(F.count("*").alias("hosts"), F.sum(F.size(listed)).alias("lines")).first()
    small = broadcast_if_small(found, size["hosts"] + (size["lines"] or 0), 64)
    joined = docs.join(small, docs[host].eqNullSafe(small[site]), "left")
    lines = _lines(text)
    kept = F.filter(lines, lambda x: _blank(x) | ~F.array_contains(F.col(listed), _key(x)))
    marked = joined.withColumn(left, F.when(F.col(listed).isNull(), lines).otherwise(kept))
    changed = {text: F.array_join(left, "\n")}
    if counts:
        n_lines = F.coalesce(F.size(lines), F.lit(0))
        none = F.when(F.col(text).isNull(), 0)
        changed[counts[0]] = none.otherwise(n_lines).cast("bigint")
        changed[counts[1]] = none.otherwise(n_lines - F.size(left)).cast("bigint")
    return marked.withColumns(changed).drop(left, site, listed)


def line_report(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Every page with its remaining text, its number of lines and how many went."""
    wanted = docs.select("doc_id", "source", "text")
    return without_boilerplate(wanted, ratio, min_pages, counts=("n_lines", "n_dropped")).select(
        "doc_id", "source", "n_lines", "n_dropped", "text"
    )


def drop_boilerplate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with boilerplate lines gone and ``n_chars`` brought up to date."""
    cleaned = without_boilerplate(docs, **options)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast("bigint"))
    return cleaned.select(*docs.columns)


SQL = f"""
WITH page AS (SELECT row_number() OVER () AS page, doc_id, source, text FROM documents),
line AS (
  SELECT page, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM page WHERE text IS NOT NULL
),
different AS (
  SELECT row_number() OVER () AS copy, source, text FROM (SELECT DISTINCT source, text FROM documents)
),
counted AS (SELECT copy, source, unnest(string_split(text, chr(10))) AS line FROM different),
seen AS (
  SELECT source, trim(line) AS line, count(DISTINCT copy) AS n
  FROM counted WHERE trim(line) <> '' GROUP BY ALL
),
total AS (SELECT source, count(*) AS pages FROM different GROUP BY source),
boilerplate AS (
  SELECT seen.source, line
  FROM seen JOIN total ON seen.source IS NOT DISTINCT FROM total.source
  WHERE n >= {MIN_PAGES} AND n::DOUBLE / pages > {RATIO}::DOUBLE
),
marked AS (
  SELECT l.page, l.line, l.place, b.line IS NOT NULL AS dropped
  FROM line l LEFT JOIN boilerplate b
    ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line) = b.line
),
result AS (
  SELECT page, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '') AS text
  FROM marked GROUP BY page
)
SELECT doc_id, source, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       result.text AS text
FROM page LEFT JOIN result USING (page)
"""
