"""Boilerplate lines by site-relative frequency.

A line is boilerplate on a site if it stands on more than a given share of the site's pages. Per
page each distinct line counts once; lines are compared without blanks at their ends.

Lines are counted by site and SHA-256 digest, combined before the shuffle, so a line on a third
of all pages sends one row per task. Texts cross the network once, when each page meets the
digests of its own boilerplate lines. A site has at most (mean lines of a page) / (share) of them,
whatever its size, so no list grows with a hot site. The two joins are ordinary equi-joins, which
adaptive execution splits at a hot site or line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.llm.support import unused

#: A line on more than this share of a site's pages is boilerplate ...
MAX_SHARE = 0.05
#: ... if it is on this many pages at least: on a site of few pages a share says nothing.
MIN_PAGES = 3

BLANKS = " \t\r"


def line_key(line: Column) -> Column:
    """What a line is compared by."""
    return F.unhex(F.sha2(F.trim(line, F.lit(BLANKS)).cast("binary"), 256))


def distinct_lines(pages: DataFrame, id_column: str, host_column: str, text_column: str) -> DataFrame:
    """A row (id, host, key) for each page and distinct line that is not blank."""
    stripped = F.transform(F.split(F.col(text_column), "\n"), lambda line: F.trim(line, F.lit(BLANKS)))
    return (
        pages.select(
            F.col(id_column).alias("id"),
            F.col(host_column).alias("host"),
            F.explode(F.array_distinct(stripped)).alias("line"),
        )
        .filter(F.col("line") != "")
        .select("id", "host", F.unhex(F.sha2(F.col("line").cast("binary"), 256)).alias("key"))
    )


def boilerplate(
    lines: DataFrame, pages: DataFrame, host_column: str, max_share: float, min_pages: int
) -> DataFrame:
    """The (host, key) of lines that are on too many of their host's pages."""
    counted = lines.groupBy("host", "key").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    totals = (
        pages.groupBy(F.col(host_column).alias("site")).agg(F.count("*").alias("total"))
    )
    return (
        counted.join(totals, F.col("host").eqNullSafe(F.col("site")))
        .filter(F.col("pages") > F.col("total") * F.lit(max_share))
        .select("host", "key")
    )


def drop_boilerplate(
    pages: DataFrame,
    id_column: str = "doc_id",
    host_column: str = "source",
    text_column: str = "text",
    max_share: float = MAX_SHARE,
    min_pages: int = MIN_PAGES,
    kept_text: str | None = None,
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """`pages` without boilerplate lines, all other columns and all rows unchanged.

    The text is replaced, or written to the new column `kept_text`; `counts` names two columns for
    the lines of the text and the lines dropped. Blank lines are never dropped. A page that loses
    every line stays with an empty text; null text stays null, counts 0 lines, and the page still
    counts for its host. Pages without a host form one site of their own. Repeated rows are pages of
    their own, also under one id or none; a line on exactly `max_share` of the pages is kept.
    """
    lines = distinct_lines(pages, id_column, host_column, text_column)
    found = boilerplate(lines, pages, host_column, max_share, min_pages)
    hits = lines.alias("l").join(
        found.alias("b"),
        F.col("l.host").eqNullSafe(F.col("b.host")) & (F.col("l.key") == F.col("b.key")),
    )
    site, page, drops = (unused(pages, name) for name in ("site_of_line", "page_of_line", "drops"))
    # Whether a line is boilerplate depends on its host alone, so rows that share an id and a host
    # may share one list; it holds lines of that host only.
    per_page = hits.groupBy(F.col("l.id").alias(page), F.col("l.host").alias(site)).agg(
        F.collect_set("l.key").alias(drops)
    )
    joined = pages.join(
        per_page,
        F.col(id_column).eqNullSafe(F.col(page)) & F.col(host_column).eqNullSafe(F.col(site)),
        "left",
    )
    text, whole = F.col(text_column), F.split(F.col(text_column), "\n")
    left = F.filter(whole, lambda line: ~F.array_contains(F.col(drops), line_key(line)))
    new = F.when(F.col(drops).isNull() | text.isNull(), text).otherwise(F.array_join(left, "\n"))
    columns = [F.col(name) for name in pages.columns]
    if kept_text is None:
        columns = [new.alias(name) if name == text_column else F.col(name) for name in pages.columns]
    else:
        columns.append(new.alias(kept_text))
    if counts:
        total = F.coalesce(F.size(whole), F.lit(0))
        total = F.when(text.isNull(), 0).otherwise(total)
        gone = F.when(F.col(drops).isNull() | text.isNull(), 0).otherwise(F.size(whole) - F.size(left))
        columns += [total.cast("long").alias(counts[0]), gone.cast("long").alias(counts[1])]
    return joined.select(*columns)
