"""Boilerplate lines: lines that a large share of a host's pages carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.tables import columns, own_name, written
from lendscope.llm.words import WORD_PATTERN

RATIO = 0.08
MIN_PAGES = 5


def _key(line: Column) -> Column:
    """128 bits that stand for a line; two lines share them with probability 2**-128."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("second"), line).alias("b"))


def boilerplate_lines(pages: DataFrame, text: str = "text", host: str = "source",
                      ratio: float = RATIO, min_pages: int = MIN_PAGES, distinct: bool = False) -> DataFrame:
    """Hosts with the keys of their boilerplate lines: (host, lines), one row per such host.

    A line is trimmed of blanks; empty lines never count. A page counts once for a line however
    often it repeats it. The share is taken over all pages of the host, those without text
    included. Pages whose host is null form one host. Per host there are at most
    (mean lines per page) / ratio such lines, so the arrays stay short however large the host is.
    With ``distinct``, pages of a host with the same text are one page, for lines and totals alike.
    """
    lines = F.transform(F.split(F.col(text), "\n"), lambda line: F.trim(line, F.lit(" \t\r")))
    lines = F.array_distinct(F.transform(F.filter(lines, lambda line: line != ""), _key))
    page = [F.col(host).alias("host"), *([_key(F.col(text)).alias("page")] if distinct else [])]
    each, every = pages.select(*page, F.explode(lines).alias("line")), pages.select(*page)
    if distinct:
        each, every = each.distinct(), every.distinct()
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = every.groupBy(F.col("host").alias("its_host")).agg(F.count("*").alias("total"))
    found = counts.join(totals, F.col("host").eqNullSafe(F.col("its_host")))
    return (found.where(F.col("n") > ratio * F.col("total")).groupBy("host")
            .agg(F.collect_list("line").alias("lines")))


def _first_copies(joined: DataFrame, gone: Column, text: str, host: str, number: str, names: list[str]) -> DataFrame:
    """``joined`` with the keys of the boilerplate lines that a page keeps as the first of its host that would lose
    more than half of its words; null for all other pages. ``names``: three free names, that of the keys first.

    Only lines of such pages are exploded, and each leaves one row, so the table joined back is as short as that of
    boilerplate lines.
    """
    kept, its_host, its_page = names
    n = F.coalesce(F.col(number), F.lit(0))
    page = F.struct(F.col(number).isNull().alias("none"), n.alias("n"), _key(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    words = F.aggregate(gone, F.lit(0), lambda total, line: total + F.regexp_count(line, F.lit(WORD_PATTERN)))
    losing = joined.where(2 * words > F.regexp_count(F.col(text), F.lit(WORD_PATTERN)))
    keys = F.array_distinct(F.transform(gone, lambda line: _key(F.trim(line, F.lit(" \t\r")))))
    firsts = (losing.select(F.col(host).alias(its_host), page.alias("page"), F.explode(keys).alias("line"))
              .groupBy(its_host, "line").agg(F.min("page").alias(its_page))
              .groupBy(its_host, its_page).agg(F.collect_list("line").alias(kept)))
    firsts = written(firsts)
    return joined.join(firsts, joined[host].eqNullSafe(firsts[its_host]) & (page == firsts[its_page]), "left")


def drop_boilerplate(pages: DataFrame, text: str = "text", host: str = "source",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES, one_stays: str | None = None) -> DataFrame:
    """Pages without the lines whose share of their host's pages exceeds ``ratio``.

    The text column holds the lines that stay, joined by newlines, unchanged; ``n_lines`` and
    ``n_dropped`` are added. A null text stays null and counts no lines; an empty text is one
    (empty) line. Equal rows give equal rows. Lines on fewer than ``min_pages`` pages stay, as a
    small host says little. Columns named like the two added ones are replaced; all others,
    whatever their names, pass through.

    Counting shuffles 16-byte keys summed per task, never texts. The lines found are written as a
    table, so that the planner knows its true size: a small one is sent to all tasks and the pages
    stay where they are. A large one is joined by host, where adaptive execution splits hot hosts.

    Copies of a page vote for their own lines. With ``one_stays``, the name of a column of numbers, they cannot make
    a text vanish: pages of the same text count once, and of the lines that pages lose which lose more than half of their
    words (so near copies too), one copy stays in each host: in the page of least number, null last. Copies of that
    page with the same number keep it too.
    """
    hosts = written(boilerplate_lines(pages, text, host, ratio, min_pages, one_stays is not None))
    at, known = own_name(pages, "host"), own_name(pages, "lines")
    hosts = hosts.select(F.col("host").alias(at), F.col("lines").alias(known))
    joined = pages.join(hosts, pages[host].eqNullSafe(hosts[at]), "left")
    parts = F.split(F.col(text), "\n")

    def goes(line: Column) -> Column:
        return F.array_contains(F.col(known), _key(F.trim(line, F.lit(" \t\r"))))

    if one_stays is None:
        stays = F.filter(parts, lambda line: ~goes(line))
    else:
        names = [own_name(joined, n) for n in ("kept", "its_host", "its_page")]
        joined = _first_copies(joined, F.filter(parts, goes), text, host, one_stays, names)
        here = F.coalesce(F.col(names[0]), F.array().cast("array<struct<a:bigint,b:bigint>>"))
        stays = F.filter(parts, lambda line: ~goes(line) | F.array_contains(here, _key(F.trim(line, F.lit(" \t\r")))))
    kept = F.when(F.col(known).isNull(), parts).otherwise(stays)
    numbers = {"n_lines": F.coalesce(F.size(parts), F.lit(0)).cast("long"),
               "n_dropped": F.coalesce(F.size(parts) - F.size(kept), F.lit(0)).cast("long")}
    counted = joined.withColumns({k: F.when(F.col(text).isNull(), 0).otherwise(v).cast("long") for k, v in numbers.items()})
    counted = counted.withColumn(text, F.array_join(kept, "\n"))
    return counted.select(*columns(pages.columns, *numbers), *numbers)
