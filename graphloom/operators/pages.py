"""OCR text to pages and offsets, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import LINE_BREAK, PAGE_MARKER, strip


def assemble_markdown(pages: DataFrame) -> DataFrame:
    """(title, content) from pages(title, page_number, text): a heading, then each page under its 'Page i of N' line."""
    whole = pages.groupBy("title").agg(F.array_sort(F.collect_list(F.struct("page_number", "text"))).alias("p")).withColumn("n", F.size("p"))
    listed = F.transform("p", lambda x: F.concat(F.lit("Page "), x["page_number"].cast("string"), F.lit(" of "), F.col("n").cast("string"), F.lit("\n\n"), strip(F.coalesce(x["text"], F.lit(""))), F.lit("\n")))
    head = F.concat(F.lit("# OCR Output for "), F.regexp_replace("title", r"\.md\z", ".pdf"), F.lit("\n"))
    return whole.select("title", F.concat(strip(F.concat_ws("\n", head, F.array_join(listed, "\n"))), F.lit("\n")).alias("content"))


def assemble_plain(pages: DataFrame) -> DataFrame:
    """(title, content) of pages(title, page_number, text) without markers: every page with an empty line behind it."""
    whole = pages.groupBy("title").agg(F.array_sort(F.collect_list(F.struct("page_number", "text"))).alias("p"))
    return whole.select("title", F.array_join(F.transform("p", lambda x: F.concat(F.coalesce(x["text"], F.lit("")), F.lit("\n\n"))), "").alias("content"))


def assemble_ranges(ranges: DataFrame) -> DataFrame:
    """(title, content) of ranges(title, first_page, last_page, text): a heading, then each range with a rule behind it; one without text
    leaves a note of its pages."""
    whole = ranges.groupBy("title").agg(F.array_sort(F.collect_list(F.struct("first_page", "last_page", "text"))).alias("p"))
    note = lambda x: F.concat(F.lit("\n[OCR Failed for Pages "), x["first_page"].cast("string"), F.lit("-"), x["last_page"].cast("string"), F.lit("]\n\n"))
    parts = F.transform("p", lambda x: F.when(F.coalesce(x["text"], F.lit("")) == "", note(x)).otherwise(F.concat(x["text"], F.lit("\n\n---\n\n"))))
    return whole.select("title", F.concat(F.lit("# OCR Output for "), F.col("title"), F.lit("\n\n"), F.array_join(parts, "")).alias("content"))


def split_pages(docs: DataFrame) -> DataFrame:
    """(title, page_ord, page_number, total_pages, text) from docs(title, content).

    A marker line begins a page and is dropped; text before the first one is page 0 and stays unless blank. Without markers the whole
    stripped text is page 1 of 1. All within a row: lines are numbered in an array, never exploded into a shuffle.
    """
    lines = F.split(F.coalesce("content", F.lit("")), LINE_BREAK, -1)
    marked = F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"), x.rlike(PAGE_MARKER).alias("m")))
    marks = F.filter(F.col("_lines"), lambda x: x["m"])
    begins = F.concat(F.array(F.struct(F.lit(-1).alias("i"), F.lit("").alias("x"), F.lit(False).alias("m"))), marks)

    def page(b, k):
        end = F.coalesce(F.get(F.col("_begins"), k + 1)["i"], F.size("_lines"))
        body = F.slice("_lines", b["i"] + 2, F.greatest(end - b["i"] - 1, F.lit(0)))
        number = F.when(b["m"], F.regexp_extract(b["x"], PAGE_MARKER, 1).cast("int")).otherwise(0)
        total = F.when(b["m"], F.regexp_extract(b["x"], PAGE_MARKER, 2).cast("int"))
        return F.struct(number.alias("page_number"), total.alias("total_pages"), strip(F.array_join(F.transform(body, lambda y: y["x"]), "\n")).alias("text"))

    out = docs.withColumn("_lines", marked).withColumn("_begins", begins).withColumn("_pages", F.transform("_begins", page))
    first = F.col("_pages")[0]
    dropped = F.when((first["page_number"] == 0) & (first["text"] == ""), F.slice("_pages", 2, F.size("_pages"))).otherwise(F.col("_pages"))
    alone = F.array(F.struct(F.lit(1).alias("page_number"), F.lit(1).alias("total_pages"), strip(F.coalesce("content", F.lit(""))).alias("text")))
    pages = F.when(F.size("_begins") == 1, alone).otherwise(dropped)
    return out.select("title", F.posexplode(pages).alias("page_ord", "_p")).select("title", "page_ord", "_p.page_number", "_p.total_pages", "_p.text")


def page_offsets(pages: DataFrame, by_number: bool = True) -> DataFrame:
    """pages with page_offset (long): where each stands in the pages of its document joined by two line feeds.

    by_number: pages of one number share the offset of the last of them, as staging keys them by number; else each keeps its own.
    """
    order = W.partitionBy("title").orderBy("page_ord").rowsBetween(W.unboundedPreceding, -1)
    own = F.coalesce(F.sum(F.length("text") + 2).over(order), F.lit(0)).cast("long")
    out = pages.withColumn("page_offset", own)
    return out.withColumn("page_offset", F.max("page_offset").over(W.partitionBy("title", "page_number"))) if by_number else out


def first_pages(pages: DataFrame, most: int | None) -> DataFrame:
    """The first so many pages of each document in order, page 0 counted."""
    return pages if most is None else pages.where(F.col("page_ord") < most)


def request_ranges(docs: DataFrame, per_request: int = 25) -> DataFrame:
    """(title, range_ord, start, end) of the page ranges [start, end) in which docs(title, n_pages) go to a recogniser."""
    step = max(1, per_request)
    starts = F.when(F.col("n_pages") > 0, F.sequence(F.lit(0), F.col("n_pages") - 1, F.lit(step)))
    return docs.select("title", "n_pages", F.posexplode(starts).alias("range_ord", "start")).select("title", "range_ord", "start", F.least(F.col("start") + step, "n_pages").alias("end"))
