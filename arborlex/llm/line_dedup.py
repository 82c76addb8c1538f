"""Operator 6: boilerplate lines by site-relative frequency (DataFrame functions only).

A *host* is the value of a column (``source`` for documents).  A *page* is a distinct text of a
host: exact copies count once, so that a crowd of copies doesn't make its own lines boilerplate.
A line's ratio is the number of its host's pages that contain it over the host's pages; lines
above the ratio on at least ``min_pages`` pages are dropped from every text of the host.  Lines
are cut at ``\\n`` and compared without white space at their ends; blank lines are never counted
or dropped.

With ``families`` a crowd of near copies counts as one page too: a page of whose characters half or more stand in lines that
other pages of the host have (its own changes stand in lines of its own) is named by the first of those lines, any other page by
itself, and names are counted in place of pages.  So the lines that a family shares stay for the copy that a later step keeps.

Lines and pages travel as 128-bit digests, pre-aggregated per task, until the last step, where
the lines to drop are joined to the texts on (host, page); nothing is grouped by host with its
texts.

Edge cases.  A null text stays null, and rows with a null host form a host of their own.  Repeated
rows all keep their place.  A text whose lines all go becomes empty, and its row stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CLASS, written

RATIO, MIN_PAGES = 0.02, 5


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, f"^[{WS_CLASS}]+|[{WS_CLASS}]+$", "")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _key(host: str) -> tuple[Column, Column]:
    """``_host`` (never null) and ``_page`` (the text's digest)."""
    return (F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("_host"),
            _digest(F.coalesce("text", F.lit(""))).alias("_page"))


def _pages(docs: DataFrame, host: str, sizes: bool = False) -> DataFrame:
    """(_host, _page, lines): every distinct text of a host with its distinct line digests, and with ``sizes`` their lengths."""
    bare = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), _bare), lambda x: x != "")
    if not sizes:
        lines = F.array_distinct(F.transform(bare, _digest))
        return docs.select(*_key(host), lines.alias("lines")).groupBy("_host", "_page").agg(F.first("lines").alias("lines"))
    lines = F.transform(F.array_distinct(bare), lambda x: F.struct(_digest(x).alias("line"), F.length(x).alias("size")))
    rows = docs.select(*_key(host), lines.alias("both")).groupBy("_host", "_page").agg(F.first("both").alias("both"))
    return rows.select("_host", "_page", F.col("both.line").alias("lines"), F.col("both.size").alias("sizes"))


def _named(pages: DataFrame) -> DataFrame:
    """(_host, _page, _name): the family of each page, itself if it has none."""
    rows = pages.select("_host", "_page", F.explode(F.arrays_zip("lines", "sizes")).alias("x")).select(
        "_host", "_page", F.col("x.lines").alias("line"), F.col("x.sizes").alias("size"))
    shared = rows.groupBy("_host", "line").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_host", "line", F.lit(True).alias("shared"))
    low = rows.join(shared, ["_host", "line"], "left").groupBy("_host", "_page").agg(
        F.sum("size").alias("size"), F.sum(F.when(F.col("shared"), F.col("size"))).alias("of_shared"),
        F.min(F.when(F.col("shared"), F.col("line"))).alias("line")).where(2 * F.col("of_shared") >= F.col("size"))
    named = pages.select("_host", "_page").join(low.select("_host", "_page", "line"), ["_host", "_page"], "left")
    return named.select("_host", "_page", F.coalesce(F.concat(F.lit(b"f"), "line"), F.concat(F.lit(b"p"), "_page")).alias("_name"))


def _boilerplate(pages: DataFrame, ratio: float, min_pages: int, families: bool = False) -> DataFrame:
    lines = pages.select("_host", "_page", F.explode("lines").alias("line"))
    seen = lines.groupBy("_host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    if families:  # the pages of a family count once
        names = written(_named(pages), "families")
        often = lines.join(seen.select("_host", "line"), ["_host", "line"]).join(names, ["_host", "_page"])
        seen = often.select("_host", "line", "_name").distinct().groupBy("_host", "line").agg(
            F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
        pages = names.select("_host", "_name").distinct()
    totals = pages.groupBy("_host").agg(F.count(F.lit(1)).alias("pages"))
    return seen.join(totals, "_host").where(F.col("n") > ratio * F.col("pages")).select("_host", "line", "n", "pages")


def line_ratios(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line digest, n, pages) of the boilerplate lines; a null host is null again."""
    found = _boilerplate(_pages(docs, host), ratio, min_pages)
    return found.select(F.when(F.col("_host") != "", F.expr("substring(_host, 2)")).alias("host"),
                        F.lower(F.hex("line")).alias("line"), "n", "pages")


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, families: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and the number of lines before and
    after in ``_n_lines`` and ``_n_dropped`` (columns of these two names are replaced).  With ``families``, near copies count
    as one page."""
    pages = written(_pages(docs, host, families), "pages")
    lines = _boilerplate(pages, ratio, min_pages, families).select("_host", "line")
    drops = pages.select("_host", "_page", F.explode("lines").alias("line")).join(lines, ["_host", "line"]).groupBy(
        "_host", "_page").agg(F.collect_set("line").alias("_drop"))
    keep = [c for c in docs.columns if c not in ("_n_lines", "_n_dropped")]
    # the row travels as one struct, so that no column of it can clash with those made here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_doc"), *_key(host))
    all_lines = F.split("_doc.text", "\n", -1)
    stays = F.filter(all_lines, lambda x: ~F.array_contains("_drop", _digest(_bare(x))))
    # rows of a hot page can be split by the adaptive plan: nothing after the join needs them together
    out = rows.join(drops, ["_host", "_page"], "left").withColumn("_stays", F.when(F.col("_drop").isNotNull(), stays))
    return out.select(
        *[(F.coalesce(F.array_join("_stays", "\n"), F.col("_doc.text")) if c == "text" else F.col("_doc")[c]).alias(c)
          for c in keep],
        F.coalesce(F.size(all_lines), F.lit(0)).alias("_n_lines"),
        F.when(F.col("_stays").isNotNull(), F.size(all_lines) - F.size("_stays")).otherwise(0).alias("_n_dropped"))
