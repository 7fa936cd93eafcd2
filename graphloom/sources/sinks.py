"""Sinks: partitioned staging tables, manifests, text and CSV outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage(rows: DataFrame, path: str, keep_stale: bool = False) -> None:
    """Chunks or documents as Parquet by project_uuid. A project's partition is replaced, so rows of earlier runs go;
    keep_stale appends instead and readers take the last row of a key."""
    writer = rows.write.partitionBy("project_uuid")
    if keep_stale:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def new_version(rows: DataFrame, path: str, version: str) -> str:
    """Write a table beside its older versions and return its path: a plan never overwrites what it reads."""
    rows.write.mode("errorifexists").parquet(f"{path}/version={version}")
    return f"{path}/version={version}"


def manifest(rows: DataFrame, project_uuid: str, generated_at: str, path: str) -> None:
    """One JSON object with the rows in the order of title or document_uuid."""
    row = F.struct(F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("document_uuid")).alias("_o"), *rows.columns)
    packed = rows.agg(F.array_sort(F.collect_list(row)).alias("d")).select(F.lit(project_uuid).alias("project_uuid"), F.lit(generated_at).alias("generated_at"), F.transform("d", lambda x: x.dropFields("_o")).alias("documents"))
    packed.write.mode("overwrite").json(path)


def analysis_rows(rows: DataFrame, path: str) -> None:
    """Append analysis rows as CSV."""
    rows.write.mode("append").option("escape", '"').csv(path, header=True)


def table_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("escape", '"').csv(path, header=True)


def path_list(rows: DataFrame, path: str) -> None:
    """A relative path a line."""
    rows.select("path").write.mode("overwrite").text(path)


def markdown_files(rows: DataFrame, path: str, existing: DataFrame | None = None) -> None:
    """OCR texts (title, content) as a table of text; titles that exist already are left as they are."""
    if existing is not None:
        rows = rows.join(existing.select("title").distinct(), "title", "left_anti")
    rows.write.mode("append").parquet(path)


def report(spark: SparkSession, text: str, path: str) -> None:
    """A small report as a text file, through Spark's own writer."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
