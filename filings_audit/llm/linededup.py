"""Line deduplication by site-relative frequency.

A line that many pages of one host carry is boilerplate there. The share of a line is the number of the host's pages
that contain it, divided by the number of the host's pages; pages with equal texts are one page. Lines above a share are
dropped from every page of that host. A host can't have more such lines than its mean number of lines per page divided
by the share, so the list kept per host is short however large the host is.

A text with many near copies on a host looks like boilerplate, too. ``drop_boilerplate_keeping_texts`` leaves one copy of the
lines of which a page would lose most of its text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filings_audit.llm.common import WHITE_SPACE
from filings_audit.session import materialize

# The characters of the class as a text.
BLANK = "".join(c for c in map(chr, range(0x3001)) if re.fullmatch(f"[{WHITE_SPACE}]", c))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(BLANK))


def _digest(line: Column) -> Column:
    """What stands for a line in shuffles: 128 bits, the same for lines that differ in white space at their ends."""
    return F.unhex(F.md5(_trimmed(line).cast("binary")))


def _page(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def distinct_pages(docs: DataFrame, host: str, text: str) -> DataFrame:
    """host, page (digest of the whole text) and found: digest and length of each distinct line that is not blank.

    Digests instead of texts are shuffled; copies go in every map task before. Pages without text are one page.
    """
    each = F.transform(
        F.filter(_lines(F.col("text")), lambda l: _trimmed(l) != ""),
        lambda l: F.struct(_digest(l).alias("line"), F.length(_trimmed(l)).alias("length")),
    )
    rows = docs.select(docs[host].alias("host"), docs[text].alias("text"))
    rows = rows.select("host", _page(F.col("text")).alias("page"), F.array_distinct(each).alias("found"))
    return materialize(rows.groupBy("host", "page").agg(F.first("found").alias("found")), "distinct-pages")


def boilerplate(distinct: DataFrame, share: float, pages: int) -> DataFrame:
    """``host`` and ``lines``: digests of each host's lines on more than ``share`` of its pages and on at least ``pages``.

    A null host is a host of its own. Counts are partial before any shuffle, so a large host costs no more than others.
    """
    totals = distinct.groupBy("host").agg(F.count("*").alias("total"))
    counts = distinct.select("host", F.explode("found.line").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    # Nearly all lines are rare: they go before the totals are joined.
    return materialize(_above(counts, totals, share, pages), "boilerplate")  # its size decides whether texts are shuffled


def _above(counts: DataFrame, totals: DataFrame, share: float, pages: int) -> DataFrame:
    common = counts.where(F.col("n") >= pages).alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
    return (
        common.where(F.col("n") > F.col("total") * share)
        .groupBy(F.col("c.host").alias("host")).agg(F.collect_list("line").alias("lines"))
    )


def drop_boilerplate(
    docs: DataFrame, share: float = 0.1, pages: int = 2, host: str = "source", text: str = "text"
) -> DataFrame:
    """All columns of ``docs`` with the boilerplate lines of its host taken out of ``text``. Null texts stay null.

    The kept lines stand in their order, joined by line feeds. No row is dropped; a text of boilerplate only becomes empty.
    Blank lines are never boilerplate. Columns that ``docs`` has besides are carried; their names must not begin
    with two underscores.
    """
    common = boilerplate(distinct_pages(docs, host, text), share, pages)
    common = common.select(F.col("host").alias("__host"), F.col("lines").alias("__lines"))
    joined = docs.join(common, docs[host].eqNullSafe(F.col("__host")), "left")
    kept = F.filter(_lines(F.col(text)), lambda line: ~F.array_contains(F.col("__lines"), _digest(line)))
    cleaned = F.when(F.col("__lines").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn(text, cleaned).select(*docs.columns)


def drop_boilerplate_keeping_texts(
    docs: DataFrame, share: float = 0.1, pages: int = 2, host: str = "source", text: str = "text"
) -> DataFrame:
    """As ``drop_boilerplate``, but no text is lost because a host has many near copies of it.

    Where pages lose more than half of their characters, each line they lose stays on the longest of them (of equal lengths,
    that with the largest digest) and on its exact copies. So the longest of a group of copies stays whole. Columns as there.
    """
    distinct = distinct_pages(docs, host, text)
    common = boilerplate(distinct, share, pages)

    held = distinct.alias("p").join(common.alias("b"), F.col("p.host").eqNullSafe(F.col("b.host"))).select(
        "p.host", "page", "found", F.filter("found", lambda l: F.array_contains("lines", l["line"])).alias("lost")
    )

    def length(name: str) -> Column:
        return F.aggregate(name, F.lit(0).cast("long"), lambda n, l: n + l["length"])

    lossy = held.select("host", "page", "lost", length("found").alias("whole"), length("lost").alias("less"))
    lossy = lossy.where(2 * F.col("less") > F.col("whole"))
    stays = lossy.select("host", F.explode("lost.line").alias("line"), F.struct("whole", "page").alias("at"))
    stays = stays.groupBy("host", "line").agg(F.max("at").alias("at"))
    stays = stays.groupBy("host").agg(F.collect_list(F.concat("line", "at.page")).alias("stays"))
    both = common.alias("b").join(stays.alias("s"), F.col("b.host").eqNullSafe(F.col("s.host")), "left")
    none = F.array().cast("array<binary>")
    both = both.select(F.col("b.host").alias("__host"), F.col("lines").alias("__lines"), F.coalesce("stays", none).alias("__stays"))
    both = materialize(both, "boilerplate-and-kept")

    def kept(page: Column) -> Column:
        return F.filter(
            _lines(F.col(text)),
            lambda line: ~F.array_contains("__lines", _digest(line))
            | F.array_contains("__stays", F.concat(_digest(line), page)),
        )

    joined = docs.join(both, docs[host].eqNullSafe(F.col("__host")), "left")
    # The digest of a text is taken once and not for each line.
    lines = F.transform(F.array(_page(F.col(text))), kept)[0]
    cleaned = F.when(F.col("__lines").isNull(), F.col(text)).otherwise(F.array_join(lines, "\n"))
    return joined.withColumn(text, cleaned).select(*docs.columns)


# What drop_boilerplate returns, in DuckDB's SQL over the table or query {docs}; hosts null or not.
_TRIM = "trim(line, " + " || ".join(f"chr({ord(c)})" for c in BLANK) + ")"
SQL = (
    """
WITH pages AS (SELECT *, row_number() OVER () AS page FROM {docs}),
cut AS (SELECT page, source, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM pages),
lines AS (SELECT page, source, text, i, string_split(text, chr(10))[i] AS line FROM cut),
common AS (
  SELECT t.source, line
  FROM (SELECT source, {trim} AS line, count(DISTINCT text) AS n FROM lines GROUP BY ALL) c
  JOIN (SELECT source, count(*) AS total FROM (SELECT DISTINCT source, text FROM pages) GROUP BY source) t
    ON c.source IS NOT DISTINCT FROM t.source
  WHERE line <> '' AND n >= {pages} AND n > total * {share}
),
kept AS (
  SELECT page, string_agg(line, chr(10) ORDER BY i) AS text
  FROM lines l
  WHERE NOT EXISTS (SELECT 1 FROM common c WHERE c.source IS NOT DISTINCT FROM l.source AND c.line = {trim_l})
  GROUP BY page
)
SELECT pages.* REPLACE (CASE WHEN pages.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text)
FROM pages LEFT JOIN kept USING (page)
"""
).replace("{trim}", _TRIM).replace("{trim_l}", _TRIM.replace("(line,", "(l.line,"))
