"""Run metrics and their Markdown reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from graphloom.functions.text import clipped


def rate(n: Column, seconds: Column) -> Column:
    """n a second; 0 without time."""
    return F.when(seconds > 0, n / seconds).otherwise(0.0)


def run_metrics(manifest: DataFrame, seconds: float) -> DataFrame:
    """One row: documents by status, chunks of those staged or loaded, and both a second."""
    ok = F.col("status").isin("staged", "loaded")
    counts = manifest.agg(*[F.count_if(F.col("status") == s).alias(f"{s}_documents") for s in ("pending", "staged", "loaded", "failed")], F.coalesce(F.sum(F.when(ok, F.col("chunk_count"))), F.lit(0)).cast("long").alias("chunks"), F.count_if(ok).alias("documents"))
    return counts.withColumns({"docs_per_second": rate(F.col("documents"), F.lit(float(seconds))), "chunks_per_second": rate(F.col("chunks"), F.lit(float(seconds)))})


def failures(manifest: DataFrame, most: int = 50) -> DataFrame:
    """The first so many failed documents with their errors, clipped."""
    return manifest.where(F.col("status") == "failed").orderBy("title", "document_uuid").limit(most).select("title", clipped(F.col("error")).alias("error"))


def markdown(title: str, metrics: Row, failed: list[Row] = (), notes: dict[str, str] | None = None) -> str:
    """A report of one metrics row and the failures, for a small sink."""
    lines = [f"# {title}", "", *[f"- {k}: {v}" for k, v in (notes or {}).items()], "", "## Metrics", ""]
    lines += [f"- {k}: {v:.3f}" if isinstance(v, float) else f"- {k}: {v}" for k, v in metrics.asDict().items()]
    if failed:
        lines += ["", "## Failures", "", *[f"- {r['title']}: {r['error']}" for r in failed]]
    return "\n".join(lines) + "\n"
