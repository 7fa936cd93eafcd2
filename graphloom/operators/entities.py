"""Entities: from chunk payloads to canonical entities, mentions and co-occurrence."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.ids import entity_id
from graphloom.functions.text import entity_text, strip
from graphloom.operators.fuzzy import greedy, similar_pairs
from graphloom.plans.lineage import cut

# How alike spellings in one cluster must be, by type; others 0.85.
THRESHOLDS = {"PERSON": 0.85, "ORGANIZATION": 0.90, "PLACE": 0.85, "DATE": 1.0, "PHONE": 0.95, "EMAIL": 0.95, "ADDRESS": 0.85, "OTHER": 0.90}
PAYLOAD = "array<struct<entity_type:string,text:string>>"


def raw_entities(chunks: DataFrame) -> DataFrame:
    """(document_uuid, chunk_index, chunk_uuid, pos, entity_type, text) of chunks' entities_json; malformed payloads and empty texts give none."""
    parsed = F.from_json(F.nullif(F.col("entities_json"), F.lit("")), PAYLOAD)
    rows = chunks.select("document_uuid", "chunk_index", "chunk_uuid", F.posexplode(parsed).alias("pos", "e"))
    kind = F.upper(F.coalesce(F.nullif(F.col("e.entity_type"), F.lit("")), F.lit("OTHER")))
    return rows.select("document_uuid", "chunk_index", "chunk_uuid", "pos", kind.alias("entity_type"), strip(F.coalesce("e.text", F.lit(""))).alias("text")).where("text <> ''")


def common_length(x: str, y: str) -> int:
    """Length of the longest common subsequence: a row of the usual table as the bits of one integer, so a step is some machine words."""
    places: dict[str, int] = {}
    for i, c in enumerate(x):
        places[c] = places.get(c, 0) | 1 << i
    full = row = (1 << len(x)) - 1
    for c in y:
        met = row & places.get(c, 0)
        row = (row + met | row - met) & full
    return len(x) - row.bit_count()


def token_sort_ratio(a: str, b: str) -> float:
    """100 times the normalised indel similarity of the texts with their blank-separated words sorted."""
    x, y = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 100.0 if x == y else 200.0 * common_length(x, y) / (len(x) + len(y))


def similarity(a: Column, b: Column) -> Column:
    """token_sort_ratio() as a column; null counts as ''."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([token_sort_ratio(p or "", q or "") for p, q in zip(x, y, strict=True)])

    return run(a, b)


def split_surfaces(surfaces: list[tuple[str, int]], threshold: float) -> list[list[tuple[str, int]]]:
    """Spellings (text, count) in the order first seen, split greedily: the first left takes all that are alike enough, best first."""
    out, left = [], list(surfaces)
    while left:
        seed = left.pop(0)
        scored = [(token_sort_ratio(seed[0], s[0]), -i, s) for i, s in enumerate(left)]
        near = sorted((x for x in scored if x[0] >= threshold * 100), reverse=True)
        taken = {-i for _, i, _ in near}
        out.append([seed, *(s for _, _, s in near)])
        left = [s for i, s in enumerate(left) if i not in taken]
    return out


CLUSTERS = "array<struct<cluster_ord:int,canonical_text:string,variants:array<string>,mention_count:long>>"


def best_surface(part: list[tuple[str, int]]) -> str:
    """The most frequent spelling; of equals the shortest, then the first."""
    return min(enumerate(part), key=lambda x: (-x[1][1], len(x[1][0]), x[0]))[1][0]


def clusters(kind: Column, surfaces: Column) -> Column:
    """split_surfaces() as a column of CLUSTERS."""

    @F.pandas_udf(CLUSTERS)
    def run(kinds: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for k, rows in zip(kinds, lists, strict=True):
            parts = split_surfaces([(r["text"], int(r["n"])) for r in rows], THRESHOLDS.get(k, 0.85))
            out.append([{"cluster_ord": i, "canonical_text": best_surface(p), "variants": sorted({t for t, _ in p}), "mention_count": sum(n for _, n in p)} for i, p in enumerate(parts)])
        return pd.Series(out)

    return run(kind, surfaces)


#: Clusters of more spellings are split by a similarity join instead of one after another in a row of their own.
MANY_SPELLINGS = 64


def split_many(surfaces: DataFrame) -> DataFrame:
    """What clusters() makes of surfaces(entity_type, normalized_text, text, n, first), for clusters of any number of spellings: a row for each split."""
    keys = ["entity_type", "normalized_text"]
    kind = F.coalesce(F.create_map(*[F.lit(x) for k in THRESHOLDS.items() for x in k])[F.col("entity_type")], F.lit(0.85))
    place = F.row_number().over(W.partitionBy(*keys).orderBy("first", "text", "n")) - 1
    rows = surfaces.select(*keys, F.concat_ws("\0", *keys).alias("cluster"), place.alias("i"), "text", "n", kind.alias("threshold"))
    rows = cut(rows)
    owners = greedy(rows, similar_pairs(rows, similarity))
    best = F.min_by("text", F.struct((-F.col("n")).alias("less"), F.char_length("text").alias("length"), (F.col("seed") != F.col("i")).alias("later"), (-F.col("score")).alias("unlike"), "i"))
    parts = rows.join(owners, ["cluster", "i"]).groupBy(*keys, "seed").agg(best.alias("canonical_text"), F.array_sort(F.collect_set("text")).alias("variants"), F.sum("n").alias("mention_count"))
    order = F.row_number().over(W.partitionBy(*keys).orderBy("seed")) - 1
    return parts.select(*keys, order.alias("cluster_ord"), "canonical_text", "variants", "mention_count")


def canonical_entities(raw: DataFrame, project: Column, all_splits: bool = False) -> DataFrame:
    """(canonical_id, entity_type, normalized_text, cluster_ord, canonical_text, variants, mention_count).

    Mentions of one type and normalised text are a cluster; unlike spellings inside it are split. All splits have one id, of which the
    last one is stored; all_splits keeps them. Spellings are counted before any Python runs, and clusters of one spelling,
    nearly all, never reach it. Those of a few spellings are split each in a row, larger ones by split_many(), with the same result.
    """
    keys = ["entity_type", "normalized_text"]
    normal = entity_text(F.col("text"))
    surfaces = cut(raw.groupBy("entity_type", normal.alias("normalized_text"), "text").agg(F.count("*").alias("n"), F.min(F.struct("document_uuid", "chunk_index", "pos")).alias("first")))
    large = cut(surfaces.groupBy(*keys).count().where(F.col("count") > MANY_SPELLINGS).select(*keys))
    none = large.isEmpty()
    small = surfaces if none else surfaces.join(large, keys, "left_anti")
    grouped = small.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first", "text", "n"))).alias("s"))
    one = grouped.where(F.size("s") == 1).select(*keys, F.lit(0).alias("cluster_ord"), F.col("s")[0]["text"].alias("canonical_text"), F.array(F.col("s")[0]["text"]).alias("variants"), F.col("s")[0]["n"].alias("mention_count"))
    plain = F.transform("s", lambda x: F.struct(x["text"].alias("text"), x["n"].alias("n")))
    several = grouped.where(F.size("s") > 1).select(*keys, clusters(F.col("entity_type"), plain).alias("c"))
    if not all_splits:
        several = several.withColumn("c", F.slice("c", -1, 1))
    out = one.unionByName(several.select(*keys, F.inline("c")))
    if not none:
        many = split_many(surfaces.join(large, keys, "left_semi"))
        if not all_splits:
            last = F.max("cluster_ord").over(W.partitionBy(*keys))
            many = many.withColumn("last", last).where(F.col("cluster_ord") == F.col("last")).drop("last")
        out = out.unionByName(many)
    return out.withColumn("canonical_id", entity_id(project, F.col("entity_type"), F.col("normalized_text")))


def mentions(raw: DataFrame, project: Column) -> DataFrame:
    """MENTIONED_IN (canonical_id, chunk_uuid): every split's chunks."""
    return raw.select(entity_id(project, F.col("entity_type"), entity_text(F.col("text"))).alias("canonical_id"), "chunk_uuid").distinct()


def existing_mentions(edges: DataFrame, entities: DataFrame, chunks: DataFrame) -> DataFrame:
    """MENTIONED_IN edges both ends of which exist."""
    return edges.join(entities.select("canonical_id").distinct(), "canonical_id", "left_semi").join(chunks.select("chunk_uuid").distinct(), "chunk_uuid", "left_semi")


def chunk_lists(edges: DataFrame) -> DataFrame:
    """(canonical_id, chunk_ids): an entity's chunks, each once, sorted. An entity of very many chunks is a long row, as defined; the edge table says the same."""
    return edges.groupBy("canonical_id").agg(F.array_sort(F.collect_set("chunk_uuid")).alias("chunk_ids"))


def flat_entities(payload: Column) -> Column:
    """'TYPE::text' of each entity of a payload; OTHER and '' where one is missing, null for a malformed payload."""
    return F.transform(F.from_json(payload, PAYLOAD), lambda e: F.concat(F.coalesce(e["entity_type"], F.lit("OTHER")), F.lit("::"), F.coalesce(e["text"], F.lit(""))))


def co_occurrence(edges: DataFrame) -> DataFrame:
    """CO_OCCURS_WITH (src, dst, count), src < dst: in how many chunks both stand. A chunk's entities are one array, so pairs need no
    self-join; each member is a row with those after it, so no row holds all pairs."""
    per = edges.groupBy("chunk_uuid").agg(F.array_sort(F.collect_set("canonical_id")).alias("e")).where(F.size("e") > 1)
    each = per.select(F.posexplode("e").alias("i", "src"), "e")
    return each.select("src", F.explode(F.slice("e", F.col("i") + 2, F.size("e"))).alias("dst")).groupBy("src", "dst").agg(F.count("*").alias("count"))


#: Above so many entities their ids meet the mentions in a shuffle join.
BROADCAST_ENTITIES = 100_000


def shares_entity(entities: DataFrame, edges: DataFrame, chunks: DataFrame, min_mentions: int = 3, limit_entities: int = 5000, max_docs: int = 50, min_shared: int = 2) -> DataFrame:
    """SHARES_ENTITY (src, dst, count), src < dst: documents with at least min_shared common entities, of the limit_entities most mentioned
    ones with min_mentions; of each the first max_docs documents by id count. The three limits are the operator's own parameters."""
    top = entities.where(F.col("mention_count") >= min_mentions).orderBy(F.col("mention_count").desc(), "canonical_id").limit(limit_entities).select("canonical_id")
    top = F.broadcast(top) if limit_entities <= BROADCAST_ENTITIES else top
    docs = edges.join(top, "canonical_id").join(chunks.select("chunk_uuid", "document_uuid"), "chunk_uuid").select("canonical_id", "document_uuid").distinct()
    first = F.row_number().over(W.partitionBy("canonical_id").orderBy("document_uuid"))  # the limit is applied before the shuffle as well
    docs = docs.withColumn("_n", first).where(F.col("_n") <= max_docs)
    per = docs.groupBy("canonical_id").agg(F.array_sort(F.collect_list("document_uuid")).alias("d")).where(F.size("d") > 1)
    pairs = F.flatten(F.transform("d", lambda a, i: F.transform(F.slice("d", i + 2, max_docs), lambda b: F.struct(a.alias("src"), b.alias("dst")))))
    return per.select(F.explode(pairs).alias("p")).groupBy("p.src", "p.dst").agg(F.count("*").alias("count")).where(F.col("count") >= min_shared)


def surface_entities(text: Column) -> Column:
    """A local stand-in for a model: e-mail addresses, phone numbers, dates and capitalised words of a text, as the payload type."""
    found = [("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), ("PHONE", r"\+[0-9][0-9 ().-]{7,}[0-9]"), ("DATE", r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b"), ("OTHER", r"\b[A-Z][a-z]{3,}\b")]

    def named(kind: str):
        return lambda x: F.struct(F.lit(kind).alias("entity_type"), x.alias("text"))

    return F.concat(*[F.transform(F.regexp_extract_all(text, F.lit(p), 0), named(k)) for k, p in found])
