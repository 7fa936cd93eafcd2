"""Questions to the finished graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.operators.graph import next_edges
from graphloom.plans.lineage import cut


#: Steps after which the paths found so far are cut from their lineage.
STEPS = 10


def paths(edges: DataFrame, starts: DataFrame, longest: int = 10) -> DataFrame:
    """(start, length, end, path as array) of all paths along edges(src, dst) from starts(id), of 0 to longest steps.

    As in a pattern of variable length: a path may come back to a node, but uses no edge twice. Branches give paths of their own; a start
    without edges has the path of length 0. Each step joins the ends of the paths with the edges, which are dealt out by their source once for all steps;
    paths that go on nowhere stay, under keys of their own. The paths found are then the prefixes of the longest ones, each once.
    Repeated edges count once, as do repeated starts; nulls are no nodes.
    """
    onward = edges.select("src", "dst").dropna().distinct().withColumn("at", F.xxhash64("src"))
    rows = starts.select(F.col("id").alias("start")).dropna().distinct().select("start", F.col("start").alias("end"), F.array("start").alias("path"))
    for step in range(1, longest + 1):
        used = F.exists(F.sequence(F.lit(1), F.greatest(F.size("path") - 1, F.lit(1))), lambda i: (F.get("path", i - 1) == F.col("end")) & (F.get("path", i) == F.col("dst")))
        rows = rows.withColumn("here", F.coalesce(F.when(F.col("end").isNotNull(), F.xxhash64("end")), F.xxhash64("path")))
        met = (F.col("here") == F.col("at")) & (F.col("end") == F.col("src")) & ~F.coalesce(used, F.lit(False))
        longer = F.when(F.col("dst").isNotNull(), F.concat("path", F.array("dst"))).otherwise(F.col("path"))
        rows = rows.join(onward, met, "left").select("start", F.col("dst").alias("end"), longer.alias("path"))
        rows = cut(rows) if step % STEPS == 0 and step < longest else rows
    prefixes = F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", 1, n))
    found = rows.select("start", F.explode(prefixes).alias("path")).distinct()
    return found.select("start", (F.size("path") - 1).alias("length"), F.element_at("path", -1).alias("end"), "path")


def sequence_paths(chunks: DataFrame, longest: int = 10, edges: DataFrame | None = None) -> DataFrame:
    """(document_uuid, length, end_uuid, path) of the paths along NEXT_CHUNK from each document's chunks of index 0, of 0 to longest steps.
    edges: NEXT_CHUNK(src, dst) as stored, with its branches and gaps; by default from each chunk to the one after it."""
    edges = next_edges(chunks) if edges is None else edges
    heads = chunks.where(F.col("chunk_index") == 0).select("document_uuid", F.col("chunk_uuid").alias("start")).distinct()
    found = paths(edges, heads.select(F.col("start").alias("id")), longest).join(heads, "start")
    return found.select("document_uuid", "length", F.col("end").alias("end_uuid"), F.array_join("path", ">").alias("path"))


def related_documents(edges: DataFrame, min_count: int = 3, most: int | None = None) -> DataFrame:
    """(src, dst, count, rank): along SHARES_ENTITY from src only, at least min_count in common, most first."""
    w = W.partitionBy("src").orderBy(F.col("count").desc(), "dst")
    out = edges.where(F.col("count") >= min_count).withColumn("rank", F.row_number().over(w))
    return out if most is None else out.where(F.col("rank") <= most)


def chunks_of_exhibit(chunks: DataFrame, exhibit: str) -> DataFrame:
    return chunks.where(F.col("exhibit_name") == exhibit).select("document_uuid", "chunk_index", "chunk_uuid", "page_number")
