"""Organising source files: deduplication by content, numbering, recovery of origins, renaming, stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import page_label, safe_name
from graphloom.plans.lineage import cut

# Extensions that are analysed.
EXTENSIONS = (".pdf", ".doc", ".docx", ".txt", ".rtf")
UNKNOWN, NOT_FOUND = "Unknown", "Unknown (Hash not found in source)"


def walk(files: DataFrame, skip: tuple[str, ...] = ("organized", "ai_docs")) -> DataFrame:
    """files(path) without hidden parts and without directories named in skip."""
    parts = F.split("path", "/")
    return files.where(~F.exists(parts, lambda p: p.startswith(".") & ~p.isin(".", "..")) & ~F.exists(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.isin(*skip)))


def deduplicated(files: DataFrame) -> DataFrame:
    """(hash, path, copies) of files(path, hash): of equal content the first path; files without a hash are left out."""
    return files.where(F.col("hash").isNotNull()).groupBy("hash").agg(F.min("path").alias("path"), F.count("*").alias("copies"))


def numbered(rows: DataFrame, by: str, start: int = 1) -> DataFrame:
    """rows with number (from start) in the order of a column of distinct strings.

    Rows are dealt into sorted ranges, which are materialised so that they stay what they are; only the ranges' sizes, one row a partition,
    meet in one window, and each range numbers its own rows.
    """
    dealt = cut(rows.repartitionByRange(F.encode(by, "UTF-8")).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).drop("_n")
    within = F.row_number().over(W.partitionBy("_range").orderBy(F.encode(by, "UTF-8")))
    return dealt.withColumn("_k", within).join(before, "_range").withColumn("number", F.col("_before") + F.col("_k") - 1 + start).drop("_range", "_k", "_before")


def copy_plan(files: DataFrame) -> DataFrame:
    """(src, dst, number) of deduplicated files, numbered by hash: DOC_%04d_ and the safe name."""
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    return numbered(deduplicated(files), "hash").select(F.col("path").alias("src"), safe_name(F.col("number"), name).alias("dst"), "number")


def renumbered(names: DataFrame) -> DataFrame:
    """(old, new) of names(name) in their order: DOC_%04d_ and what followed a DOC_<digits>_ before, else the whole name."""
    rest = F.regexp_extract("name", r"(?s)^DOC_\d+_(.*)\z", 1)
    old = F.when(rest != "", rest).otherwise(F.col("name"))
    return numbered(names, "name").select(F.col("name").alias("old"), F.concat(F.format_string("DOC_%04d_", "number"), old).alias("new"))


def recovered(organised: DataFrame, sources: DataFrame) -> DataFrame:
    """(new_filename, original_path) of organised(name, hash): of the sources(path, hash) with that content the last path; NOT_FOUND without one."""
    last = sources.where(F.col("hash").isNotNull()).groupBy("hash").agg(F.max("path").alias("path"))
    return organised.join(last, "hash", "left").select(F.col("name").alias("new_filename"), F.coalesce("path", F.lit(NOT_FOUND)).alias("original_path"))


def with_origin(rows: DataFrame, inventory: DataFrame) -> DataFrame:
    """rows(name, ..) with original_path from inventory(new_filename, original_path); UNKNOWN without an entry."""
    known = inventory.select(F.col("new_filename").alias("name"), "original_path").dropDuplicates(["name"])
    return rows.join(known, "name", "left").withColumn("original_path", F.coalesce("original_path", F.lit(UNKNOWN)))


def renamed_rows(rows: DataFrame, renames: DataFrame) -> DataFrame:
    """Analysis rows under their new names; rows whose name was not renamed are dropped."""
    return rows.join(renames, rows["name"] == renames["old"]).drop("name", "old").withColumnRenamed("new", "name")


def to_analyse(files: DataFrame, processed: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """files(name) of the known kinds with a DOC_ name that are not processed yet and hold none of the skipped parts."""
    kind = F.lower(F.regexp_extract("name", r"(\.[^.]*)\z", 1))
    wanted = files.where(kind.isin(*EXTENSIONS) & F.col("name").startswith("DOC_"))
    for part in skip:
        wanted = wanted.where(~F.col("name").contains(part))
    return wanted.join(processed.select("name").distinct(), "name", "left_anti")


def large_files(files: DataFrame, above: int = 30) -> DataFrame:
    """PDF files(name, n_pages) of more than so many pages with DOC_ in their names."""
    return files.where((F.col("n_pages") > above) & F.col("name").contains("DOC_") & F.lower("name").endswith(".pdf"))


def page_stamps(files: DataFrame) -> DataFrame:
    """(name, page, label) for every page of files(name, n_pages)."""
    pages = files.where(F.col("n_pages") > 0).select("name", F.explode(F.sequence(F.lit(1), F.col("n_pages"))).alias("page"))
    return pages.withColumn("label", page_label(F.col("name"), F.col("page")))
