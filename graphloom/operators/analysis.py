"""Review metadata onto documents: a key join in two passes that explains itself, and its reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import doc_prefix, strip, title_key


def unwrapped(answer: Column) -> Column:
    """A reviewer's JSON answer as struct(relevance_status, relevance_explanation, summary): an object, or the first of a list; else null."""
    return F.get(F.from_json(answer, "array<struct<relevance_status:string,relevance_explanation:string,summary:string>>"), F.lit(0))


def with_keys(documents: DataFrame) -> DataFrame:
    """documents with doc_prefix and normalized_title_key filled: the stored value, else from title, else from source_file; and
    keys_changed, whether a stored value differs and must be written back."""
    out = documents
    changed = F.lit(False)
    for key, make in (("doc_prefix", doc_prefix), ("normalized_title_key", title_key)):
        stored = strip(F.coalesce(key, F.lit(""))) if key in documents.columns else F.lit("")
        made = F.coalesce(F.nullif(stored, F.lit("")), F.nullif(make(F.coalesce("title", F.lit(""))), F.lit("")), make(F.coalesce("source_file", F.lit(""))))
        changed = changed | (~F.col(key).eqNullSafe(made) if key in documents.columns else F.lit(True))
        out = out.withColumn(f"_{key}", made)
    out = out.withColumn("keys_changed", changed)
    return out.drop("doc_prefix", "normalized_title_key").withColumnsRenamed({"_doc_prefix": "doc_prefix", "_normalized_title_key": "normalized_title_key"})


def classify(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """rows(row_no, organized_doc_number, ..) with document_uuid, strategy and confidence.

    A prefix that documents have decides: one document is a match (prefix, 1.0), several are ambiguous, and nothing else is tried. Else
    the title key: one document (normalized, 0.7), several ambiguous, none unmatched (none, 0.0). documents: see with_keys().
    """
    keyed = rows.withColumns({"_p": doc_prefix(F.coalesce("organized_doc_number", F.lit(""))), "_k": title_key(F.coalesce("organized_doc_number", F.lit("")))})
    for key, column in (("_p", "doc_prefix"), ("_k", "normalized_title_key")):
        known = documents.where(F.col(column) != "").groupBy(F.col(column).alias(key)).agg(F.count("*").alias(f"{key}n"), F.min("document_uuid").alias(f"{key}u"))
        keyed = keyed.join(known, key, "left")
    strategy = (
        F.when(F.col("_pn") == 1, "prefix").when(F.col("_pn") > 1, "ambiguous").when(F.col("_kn") == 1, "normalized").when(F.col("_kn") > 1, "ambiguous").otherwise("none")
    )
    out = keyed.withColumn("strategy", strategy)
    out = out.withColumn("document_uuid", F.when(F.col("strategy") == "prefix", F.col("_pu")).when(F.col("strategy") == "normalized", F.col("_ku")))
    return out.withColumn("confidence", F.when(F.col("strategy") == "prefix", 1.0).when(F.col("strategy") == "normalized", 0.7).otherwise(0.0)).drop("_p", "_k", "_pn", "_pu", "_kn", "_ku")


def join_analysis(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """The update of each matched document: its last matching row, with summary_text, analysis_join_strategy and analysis_join_confidence."""
    hits = classify(rows, documents).where(F.col("document_uuid").isNotNull())
    last = hits.withColumn("_n", F.row_number().over(W.partitionBy("document_uuid").orderBy(F.col("row_no").desc()))).where("_n = 1")
    summary = strip(F.concat(F.coalesce("file_description", F.lit("")), F.lit("\n\n"), F.coalesce("relevance_analysis", F.lit(""))))
    return last.select("document_uuid", "file_type", "file_description", "relevance_analysis", "original_file_path", "organized_doc_number", summary.alias("summary_text"), F.lit(True).alias("analysis_ingested"), F.col("strategy").alias("analysis_join_strategy"), F.col("confidence").alias("analysis_join_confidence"))


def join_counts(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """One row: documents updated, and rows matched, unmatched and ambiguous."""
    return classify(rows, documents).agg(
        F.count_distinct("document_uuid").alias("updated_documents"), F.count_if(F.col("document_uuid").isNotNull()).alias("matched_rows"),
        F.count_if(F.col("strategy") == "none").alias("unmatched_rows"), F.count_if(F.col("strategy") == "ambiguous").alias("ambiguous_rows"),
    )


def examples(rows: DataFrame, documents: DataFrame, strategy: str, most: int = 25) -> DataFrame:
    """The names of the first so many rows that ended so ('none' or 'ambiguous')."""
    return classify(rows, documents).where(F.col("strategy") == strategy).orderBy("row_no").limit(most).select("row_no", "organized_doc_number")


def coverage(documents: DataFrame) -> DataFrame:
    """One row: documents in all, with analysis, and marked ambiguous."""
    return documents.agg(F.count("*").alias("total_documents"), F.count_if(F.coalesce("analysis_ingested", F.lit(False))).alias("with_analysis"), F.count_if(F.coalesce("analysis_join_strategy", F.lit("")) == "ambiguous").alias("ambiguous_documents"))


def without_analysis(documents: DataFrame, most: int | None = None) -> DataFrame:
    """Documents without analysis in the order of prefix and title (null titles last)."""
    out = documents.where(~F.coalesce("analysis_ingested", F.lit(False))).select("doc_prefix", "title", "document_uuid")
    return out if most is None else out.orderBy(F.coalesce("doc_prefix", F.lit("")), F.col("title").asc_nulls_last(), "document_uuid").limit(most)
