"""Neighbourhood context of each chunk: neighbours, edge counts and hints as compact JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.text import json_text

MOST_NEIGHBOURS, MOST_ENTITIES, MOST_HINTS = 8, 6, 3
VERSION = "1.0"


def chunk_entities(entities: DataFrame, edges: DataFrame, most: int = MOST_ENTITIES) -> DataFrame:
    """(chunk_uuid, ents): of each chunk's entities the most mentioned ones, ties by id. The rank's limit is applied
    before the shuffle as well, so no row ever holds all entities of a chunk."""
    known = edges.join(entities.select("canonical_id", "canonical_text", "mention_count"), "canonical_id")
    rank = F.row_number().over(W.partitionBy("chunk_uuid").orderBy(F.col("mention_count").desc(), "canonical_id"))
    known = known.withColumn("_n", rank).where(F.col("_n") <= most)
    row = F.struct((-F.col("mention_count")).alias("k"), F.col("canonical_id").alias("id"), F.coalesce("canonical_text", F.lit("")).alias("text"))
    return known.groupBy("chunk_uuid").agg(F.array_sort(F.collect_set(row)).alias("ents"))


def neighbourhoods(chunks: DataFrame, documents: DataFrame, entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(chunk_uuid, document_uuid, title, prev, next, neighbours, n_next, n_mentions, ents): the structures that render() writes as JSON.

    Neighbours: the document (0.9), the chunk before and after (0.6), then entities (0.3 and a fiftieth a mention, 1 at most); the first
    MOST_NEIGHBOURS. n_mentions counts the entities considered, even those cut off.
    """
    w = W.partitionBy("document_uuid").orderBy("chunk_index", "chunk_uuid")
    base = chunks.select("chunk_uuid", "document_uuid", F.lag("chunk_uuid").over(w).alias("prev"), F.lead("chunk_uuid").over(w).alias("next"))
    base = base.join(documents.select("document_uuid", "title"), "document_uuid", "left").join(chunk_entities(entities, edges), "chunk_uuid", "left")
    ents = F.coalesce("ents", F.array())

    def one(kind, key, label, score, rel):
        return F.struct(kind.alias("t"), F.substring(key, 1, 12).alias("id"), F.substring(label, 1, 30).alias("l"), F.round(score, 2).alias("r"), F.substring(rel, 1, 12).alias("rel"))

    lit = F.lit
    fixed = F.array(
        F.when(F.col("document_uuid").isNotNull(), one(lit("doc"), F.col("document_uuid"), F.coalesce("title", lit("")), lit(0.9), lit("HAS_CHUNK"))),
        F.when(F.col("prev").isNotNull(), one(lit("chunk"), F.col("prev"), lit("prev"), lit(0.6), lit("PREV"))),
        F.when(F.col("next").isNotNull(), one(lit("chunk"), F.col("next"), lit("next"), lit(0.6), lit("NEXT"))),
    )
    more = F.transform(ents, lambda e: one(lit("entity"), e["id"], e["text"], F.least(lit(1.0), lit(0.3) + -e["k"] / 50.0), lit("MENTIONED_IN")))
    return base.select(
        "chunk_uuid", "document_uuid", "title", "prev", "next", F.slice(F.concat(F.filter(fixed, lambda x: x.isNotNull()), more), 1, MOST_NEIGHBOURS).alias("neighbours"),
        (F.col("prev").isNotNull().cast("int") + F.col("next").isNotNull().cast("int")).alias("n_next"), F.size(ents).alias("n_mentions"), ents.alias("ents"),
    )


def _number(x):
    """A score of two decimals as JSON writes it: 0.9, 1.0, 0.34."""
    return F.regexp_replace(F.format_number(x, 2), r"0\z", "")


def render(rows: DataFrame) -> DataFrame:
    """(chunk_uuid, neighbor_summary, edge_summary, traversal_hints, context_enriched, markov_version) as JSON text with ', ' and ': '."""
    pair = lambda k, v: F.concat(F.lit(f'"{k}": '), v)
    item = lambda *parts: F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    listed = lambda x: F.concat(F.lit("["), F.array_join(x, ", "), F.lit("]"))
    near = F.transform("neighbours", lambda n: item(pair("t", json_text(n["t"])), pair("id", json_text(n["id"])), pair("l", json_text(n["l"])), pair("r", _number(n["r"])), pair("rel", json_text(n["rel"]))))
    summary = F.array(*[item(pair("type", F.lit(f'"{t}"')), pair("n", F.col(c).cast("string"))) for t, c in (("NEXT_CHUNK", "n_next"), ("MENTIONED_IN", "n_mentions"))])
    top = F.get("ents", F.lit(0))
    hint = lambda kind, text, key: item(pair("type", F.lit(f'"{kind}"')), pair("desc", json_text(text)), pair("id", json_text(F.substring(key, 1, 12))))
    hints = F.array(
        F.when(top.isNotNull(), hint("explore_entity", F.concat(F.lit("Explore entity "), F.substring(top["text"], 1, 30)), top["id"])),
        F.when(F.col("next").isNotNull(), hint("continue", F.lit("Continue to next chunk"), F.col("next"))),
    )
    hints = F.slice(F.filter(hints, lambda x: x.isNotNull()), 1, MOST_HINTS)
    return rows.select("chunk_uuid", listed(near).alias("neighbor_summary"), listed(summary).alias("edge_summary"), listed(hints).alias("traversal_hints"), F.lit(True).alias("context_enriched"), F.lit(VERSION).alias("markov_version"))
