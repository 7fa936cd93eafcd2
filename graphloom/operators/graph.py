"""Node and edge tables of the property graph, keyed upserts, and integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def next_edges(chunks: DataFrame, document: str = "document_uuid", key: str = "chunk_uuid", order: tuple[str, ...] = ("chunk_index",)) -> DataFrame:
    """NEXT_CHUNK (src, dst): each chunk to the one after it in its document; a single chunk has none."""
    w = W.partitionBy(document).orderBy(*order, key)
    return chunks.select(F.col(key).alias("src"), F.lead(key).over(w).alias("dst")).where(F.col("dst").isNotNull())


def has_edges(rows: DataFrame, src: str, dst: str) -> DataFrame:
    """HAS_DOCUMENT or HAS_CHUNK (src, dst): a projection of the node table."""
    return rows.select(F.col(src).alias("src"), F.col(dst).alias("dst")).dropna().dropDuplicates()


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], once: tuple[str, ...] = (), overwrite_null: bool = False) -> DataFrame:
    """existing with incoming merged in by key: incoming values win where they are not null (or always, with overwrite_null), columns
    named in once keep their first value, columns of one side only stay. incoming must have a key once; see last_wins()."""
    a, b = existing.alias("a"), incoming.alias("b")
    joined = a.join(b, keys, "full_outer")
    columns = [c for c in dict.fromkeys(existing.columns + incoming.columns) if c not in keys]
    present = F.coalesce(*[F.col(f"b.{c}").isNotNull() for c in incoming.columns if c not in keys], F.lit(False)) if overwrite_null else None
    out = []
    for c in columns:
        old = F.col(f"a.{c}") if c in existing.columns else None
        new = F.col(f"b.{c}") if c in incoming.columns else None
        if old is None or new is None:
            out.append((new if old is None else old).alias(c))
        elif c in once:
            out.append(F.coalesce(old, new).alias(c))
        else:
            out.append((F.when(present, new).otherwise(old) if overwrite_null else F.coalesce(new, old)).alias(c))
    return joined.select(*keys, *out)


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with one key the last by order."""
    w = W.partitionBy(*keys).orderBy(F.col(order).desc())
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_edges(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Edges (src, dst) of both, each once."""
    return existing.unionByName(incoming).dropDuplicates(["src", "dst"])


def replace_edges(existing: DataFrame, incoming: DataFrame, sources: DataFrame) -> DataFrame:
    """existing without the edges that leave any of sources(src), and incoming: a reset of those sources."""
    return existing.join(sources.select("src").distinct(), "src", "left_anti").unionByName(incoming)


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows have: a uniqueness constraint's violations."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def document_maxima(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per document its greatest page number and its number of chunks, 0 without any."""
    per = chunks.groupBy("document_uuid").agg(F.max("page_number").alias("page_count_detected"), F.count("*").alias("chunk_count"))
    out = documents.select("document_uuid").join(per, "document_uuid", "left")
    return out.select("document_uuid", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("page_count_detected", "chunk_count")])


def load_stats(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: documents and chunks loaded, and edges from cases to documents, from documents to chunks and from chunk to chunk."""
    per = document_maxima(documents, chunks.withColumn("page_number", F.lit(0)))
    following = F.coalesce(F.sum(F.greatest(F.col("chunk_count") - 1, F.lit(0))), F.lit(0)).alias("next_chunk")
    n, c = F.count("*"), F.coalesce(F.sum("chunk_count"), F.lit(0))
    return per.agg(n.alias("documents"), c.alias("chunks"), n.alias("has_document"), c.alias("has_chunk"), following)


def integrity(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per document: chunks, distinct chunk indexes, expected next edges, chunks without an exhibit name, the first 20 indexes, max page."""
    per = chunks.groupBy("document_uuid").agg(
        F.count("*").alias("chunk_count"), F.count_distinct("chunk_index").alias("indexes"), F.count_if(F.coalesce("exhibit_name", F.lit("")) == "").alias("without_exhibit"),
        F.array_join(F.slice(F.array_sort(F.collect_set("chunk_index")), 1, 20), ",").alias("first_indexes"), F.max("page_number").alias("page_count_detected"),
    )
    out = documents.select("document_uuid").join(per, "document_uuid", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("chunk_count", "indexes", "without_exhibit", "page_count_detected")}
    return out.withColumns(zero | {"first_indexes": F.coalesce("first_indexes", F.lit(""))}).withColumn("next_edges", F.greatest(F.col("chunk_count") - 1, F.lit(0)))
