"""The manifest: one row a document with its state, merged so that progress is never lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import doc_prefix
from graphloom.operators.files import numbered

IDENTITY = ("title", "source_file", "ocr_markdown_path", "source_file_path")
COUNTS = ("chunk_count", "page_count_detected")
TIMES = ("started_at", "completed_at", "staged_at", "loaded_at")
COLUMNS = ("document_uuid", *IDENTITY, "status", "error", *COUNTS, *TIMES)


def filled(x: Column) -> Column:
    """Null for ''."""
    return F.nullif(x, F.lit(""))


def coerced(rows: DataFrame) -> DataFrame:
    """Rows of any age as COLUMNS: without a status they are staged if they have a staging time or chunks, else pending."""
    have = set(rows.columns)
    col = lambda c: F.col(c) if c in have else F.lit(None)
    base = rows.select("document_uuid", *[F.coalesce(col(c).cast("string"), F.lit("")).alias(c) for c in (*IDENTITY, "status", "error", *TIMES)], *[F.coalesce(col(c).cast("int"), F.lit(0)).alias(c) for c in COUNTS])
    old = F.when((F.col("staged_at") != "") | (F.col("chunk_count") > 0), "staged").otherwise("pending")
    return base.withColumn("status", F.coalesce(filled(F.trim("status")), old)).select(*COLUMNS)


def merge(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both manifests by document_uuid. Names and times are taken from incoming where it has any; counts never fall; a pending incoming row
    leaves the status; success clears the error, another incoming error replaces it."""
    a, b = existing.alias("a"), incoming.alias("b")
    both = F.col("a.status").isNotNull() & F.col("b.status").isNotNull()

    def pick(merged: Column, c: str) -> Column:
        return F.when(both, merged).otherwise(F.coalesce(f"a.{c}", f"b.{c}")).alias(c)

    newer = {c: F.coalesce(filled(F.col(f"b.{c}")), F.col(f"a.{c}")) for c in (*IDENTITY, *TIMES)}
    status = F.when(F.col("b.status") != "pending", F.col("b.status")).otherwise(F.col("a.status"))
    error = F.when(F.col("b.status").isin("staged", "loaded"), F.col("b.error")).otherwise(F.coalesce(filled(F.col("b.error")), F.col("a.error")))
    values = newer | {"status": status, "error": error} | {c: F.greatest(f"a.{c}", f"b.{c}") for c in COUNTS}
    return a.join(b, "document_uuid", "full_outer").select("document_uuid", *[pick(values[c], c) for c in COLUMNS[1:]])


def to_ingest(files: DataFrame, manifest: DataFrame, staged: DataFrame, resume: bool = True) -> DataFrame:
    """files(document_uuid, ..) still to be ingested: all, or on resume those not staged or loaded with their staging output at hand."""
    if not resume:
        return files
    done = manifest.where(F.col("status").isin("staged", "loaded")).select("document_uuid").join(staged.select("document_uuid"), "document_uuid", "left_semi")
    return files.join(done, "document_uuid", "left_anti")


def selected(rows: DataFrame, prefix: str = "", start: int = 0, limit: int | None = None) -> DataFrame:
    """rows(document_uuid, title, ..) of the wanted prefix, a slice in the order of title or uuid; limit 0 is none of them. A negative start
    counts from the end."""
    rows = rows.where(doc_prefix(F.col("title")) == prefix.upper()) if prefix else rows
    if not start and limit is None:
        return rows
    if start > 0 and limit is None:  # no bound on the rows behind the start, so they are numbered by ranges
        place = F.concat(F.coalesce(filled(F.col("title")), F.col("document_uuid")), F.lit("\0"), F.col("document_uuid"))
        return numbered(rows.withColumn("_place", place), "_place").where(F.col("number") > start).select(*rows.columns)
    order = [F.coalesce(filled(F.col("title")), F.col("document_uuid")), F.col("document_uuid")]
    if start < 0:
        rows = rows.orderBy(*[c.desc() for c in order]).limit(-start)
    rows = rows.orderBy(*order).offset(max(start, 0))
    return rows if limit is None else rows.limit(limit)


def to_load(manifest: DataFrame, resume: bool = True, prefix: str = "", start: int = 0, limit: int | None = None) -> DataFrame:
    """Manifest rows to be loaded: those selected(), without loaded ones on resume."""
    rows = selected(manifest, prefix, start, limit)
    return rows.where(F.col("status") != "loaded") if resume else rows
