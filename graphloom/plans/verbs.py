"""The verbs of a case: from scans to staged chunks to the tables of the graph. Each reads tables, applies operators and writes tables.

Staged rows are appended with their staging time; a document's newest row says which of its chunks are valid, so a run that broke off
leaves nothing that readers see. All other tables are keyed tables, changed by the buckets that a verb's rows fall into.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import ids, text
from graphloom.operators import analysis, enrich, entities, graph, manifest, pages, reports, similarity, vector_index
from graphloom.plans.lineage import cut, shared_folder
from graphloom.sources import keyed, providers, scans, sinks

# The columns of the graph's tables beyond those that staging has.
REVIEWED = "file_type string, file_description string, relevance_analysis string, original_file_path string, organized_doc_number string, summary_text string, analysis_ingested boolean, analysis_join_strategy string, analysis_join_confidence double"
EDGE = "project_uuid string, src string, dst string"
TABLES = {
    "ocr_text": "project_uuid string, title string, content string",
    "staged_chunk": f"{scans.CHUNK}, staged_at string",
    "staged_document": scans.DOCUMENT,
    "manifest": f"project_uuid string, {scans.MANIFEST_ROW.replace(':', ' ')}",
    "case": "project_uuid string, tenant_uuid string, case_name string, status string, created_at string",
    "document": f"{scans.DOCUMENT}, {REVIEWED}, summary_embedding array<float>, summary_embedding_model string",
    "chunk": f"{scans.CHUNK}, neighbor_summary string, edge_summary string, traversal_hints string, context_enriched boolean, markov_version string",
    "canonical_entity": "project_uuid string, canonical_id string, entity_type string, canonical_text string, variants array<string>, mention_count long",
    "has_document": EDGE,
    "has_chunk": EDGE,
    "next_chunk": f"{EDGE}, document_uuid string",
    "mentioned_in": EDGE,
    "co_occurs_with": f"{EDGE}, count long",
    "similar_to": f"{EDGE}, score double",
    "shares_entity": f"{EDGE}, count long",
}
#: Tables that only grow, read by their newest rows; the others are keyed tables, dealt to buckets by these columns.
STAGED = ("staged_chunk", "staged_document")
BY = {
    "ocr_text": ["title"], "manifest": ["document_uuid"], "case": ["project_uuid"], "document": ["document_uuid"], "chunk": ["document_uuid"], "canonical_entity": ["canonical_id"], "next_chunk": ["document_uuid"],
    **dict.fromkeys(("has_document", "has_chunk", "mentioned_in", "co_occurs_with", "similar_to", "shares_entity"), ["src"]),
}


@dataclass(frozen=True)
class Case:
    """Where a case's files and tables are. project: its id, by default GRAPHLOOM_PROJECT_UUID, else made from the name."""

    name: str
    root: str
    tenant: str = "default"
    project: str = field(default_factory=lambda: os.environ.get("GRAPHLOOM_PROJECT_UUID", ""))
    input: str = ""
    buckets: int | None = None

    @property
    def uuid(self) -> str:
        return self.project or str(uuid.uuid5(uuid.UUID(ids.CASES), self.name))

    def inputs(self, part: str) -> str:
        return f"{self.input or self.root + '/input'}/{part}"

    def table(self, name: str) -> str:
        return f"{self.root}/output/{name}"


def now() -> str:
    """This moment in UTC as ISO text that ends in Z."""
    return datetime.now(UTC).isoformat(timespec="microseconds").replace("+00:00", "Z")


def keyed_table(spark: SparkSession, case: Case, name: str) -> keyed.KeyedTable:
    return keyed.KeyedTable(spark, case.table(name), TABLES[name], case.buckets)


def every(spark: SparkSession, case: Case, name: str) -> DataFrame:
    """A table's rows of all projects; none where it was never written. Columns that older files lack are null."""
    if name not in STAGED:
        return keyed_table(spark, case, name).every()
    try:
        return spark.read.schema(TABLES[name]).parquet(case.table(name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], TABLES[name])


def rows_of(spark: SparkSession, case: Case, name: str) -> DataFrame:
    """A table's rows of the case's project."""
    if name in STAGED:
        return every(spark, case, name).where(F.col("project_uuid") == case.uuid)
    return keyed_table(spark, case, name).rows(case.uuid)


def _typed(rows: DataFrame, case: Case, name: str) -> DataFrame:
    """rows with the table's columns and types; missing ones null."""
    schema = rows.sparkSession.createDataFrame([], TABLES[name]).schema
    rows = rows.withColumn("project_uuid", F.lit(case.uuid))
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def put(rows: DataFrame, case: Case, name: str) -> None:
    """Replace the project's rows of a table, even by none."""
    keyed_table(rows.sparkSession, case, name).replace(case.uuid, _typed(rows, case, name), BY[name])


def append(rows: DataFrame, case: Case, name: str) -> None:
    sinks.stage(_typed(rows, case, name), case.table(name), keep_stale=True)


def merged(spark: SparkSession, case: Case, name: str, rows: DataFrame, keys: list[str], once: tuple[str, ...] = ()) -> None:
    """Upsert rows into a table by key; only the buckets that they fall into are read and written."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        return graph.upsert(old, new, keys, once)

    keyed_table(spark, case, name).update(case.uuid, rows.drop("project_uuid"), BY[name], merge)


def noted(spark: SparkSession, case: Case, rows: DataFrame) -> None:
    """Merge rows into the manifest."""
    keyed_table(spark, case, "manifest").update(case.uuid, manifest.coerced(rows), BY["manifest"], lambda old, new: manifest.merge(old.select(*manifest.COLUMNS), new))


def staged(spark: SparkSession, case: Case) -> tuple[DataFrame, DataFrame]:
    """(documents, chunks) as last staged."""
    documents = graph.last_wins(rows_of(spark, case, "staged_document"), ["document_uuid"], "staged_at")
    valid = documents.select("document_uuid", "staged_at")
    return documents, rows_of(spark, case, "staged_chunk").join(valid, ["document_uuid", "staged_at"], "left_semi")


def note(spark: SparkSession, case: Case, verb: str, began: float, metrics: dict, failed: list) -> dict:
    """Write the verb's report and return its metrics."""
    metrics = metrics | {"seconds": time.time() - began}
    row = spark.createDataFrame([tuple(metrics.values())], list(metrics)).first()
    stamp = datetime.now(UTC).strftime("%Y%m%d_%H%M%S_%f")
    sinks.report(spark, reports.markdown(f"{verb}: {case.name}", row, failed, {"project": case.uuid}), f"{case.root}/reports/{verb}_{stamp}")
    return metrics


# Verbs


def ocr(
    spark: SparkSession, case: Case, make: Callable[[], providers.Recogniser], start_at: int = 0, limit_docs: int | None = None, force: bool = False, max_pages_per_request: int = 25, tries: int = 3, backoff_seconds: float = 1.0,
    request_delay_seconds: float = 0.0, write_raw: bool = False, count: Callable[[bytes], int] = providers.page_count, rate: float = 0.0,
) -> dict:
    """Texts of the PDFs of the input folder, page by page under markers. A document with a failed range, or whose pages can't be counted, is
    left out and reported; texts that exist are kept unless force. write_raw: the answers of every range as JSON files beside the table. rate:
    requests a second that all tasks together begin at most; 0 is no limit."""
    began = time.time()
    files = scans.pdfs(spark, case.inputs("")).withColumn("document_uuid", F.col("title"))
    chosen = manifest.selected(files.select("document_uuid", "title"), "", start_at, limit_docs).withColumn("md", _markdown_name(F.col("title")))
    have = rows_of(spark, case, "ocr_text").select(F.col("title").alias("md"))
    todo = chosen if force else chosen.join(have, "md", "left_anti")
    found = cut(providers.recognise(files.join(todo.select("title"), "title", "left_semi"), make, max_pages_per_request, tries, backoff_seconds, request_delay_seconds, count, rate))
    failed = found.where("error is not null").groupBy("title").agg(F.min("error").alias("error"))
    good = found.join(failed.select("title"), "title", "left_anti")
    each = good.select(_markdown_name(F.col("title")).alias("title"), "first_page", F.posexplode("pages").alias("i", "text"))
    texts = pages.assemble_markdown(each.select("title", (F.col("first_page") + F.col("i")).alias("page_number"), "text"))
    merged(spark, case, "ocr_text", texts, ["title"])
    if write_raw:
        raw = good.withColumn("name", F.format_string("%s__pages_%04d-%04d", F.regexp_replace("title", r"\.[^.]*\z", ""), "first_page", "last_page"))
        raw.select("name", F.transform("pages", lambda p: F.struct(p.alias("markdown"))).alias("pages")).write.mode("append").json(case.table("ocr_raw"))
    errors = failed.orderBy("title").limit(50).collect()
    return note(spark, case, "ocr", began, {"selected": chosen.count(), "recognised": good.select("title").distinct().count(), "failed": failed.count()}, errors)


def _markdown_name(pdf: Column) -> Column:
    return F.regexp_replace(pdf, r"(?i)\.pdf\z", ".md")


def ocr_texts(spark: SparkSession, case: Case, only_prefix: str = "") -> DataFrame:
    """(path, title, content): the Markdown files of the OCR folder, and recognised texts without such a file. only_prefix: files without it in
    their names are not opened."""
    made = rows_of(spark, case, "ocr_text").select(F.concat(F.lit(f"{case.table('ocr_text')}/"), "title").alias("path"), "title", "content")
    try:
        files = scans.markdown(spark, case.inputs("organized/ocr"), only_prefix)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return made
    return files.unionByName(made.join(files.select("title"), "title", "left_anti"))


def ingest(
    spark: SparkSession, case: Case, docs: DataFrame | None = None, make: Callable[[], providers.Chunker] = providers.local_chunker, only_prefix: str = "", start_at: int = 0, limit_docs: int | None = None,
    max_pages_per_doc: int | None = None, tries: int = 3, backoff_seconds: float = 1.0, resume: bool = True, rate: float = 0.0, lanes: int = 0, batch_docs: int = 0,
) -> dict:
    """Stage the chunks of docs(path, title, content), by default ocr_texts(), and keep the manifest. A document with a page whose chunker
    failed in all tries is marked failed. Chunks without entities get those that their text shows. resume: staged documents are skipped.
    rate: pages a second that all tasks together ask the chunker for, in so many lanes; 0 is no limit. batch_docs: about so many documents are
    staged and noted in the manifest at a time, so that a run that breaks off loses the last batch alone; 0 is all at once."""
    began = time.time()
    docs = ocr_texts(spark, case, only_prefix) if docs is None else docs
    stem = F.regexp_replace("title", r"(?<=.)\.[^.]*\z", "")
    files = docs.withColumns({"document_uuid": ids.document_id(F.lit(case.uuid), F.col("title")), "stem": stem})
    names = manifest.selected(files.select("document_uuid", "title", "path", "stem"), only_prefix, start_at, limit_docs)
    seed = names.select("document_uuid", "title", F.col("stem").alias("source_file"), F.col("path").alias("ocr_markdown_path"), F.col("path").alias("source_file_path"), F.lit("pending").alias("status"))
    known = cut(manifest.merge(rows_of(spark, case, "manifest").select(*manifest.COLUMNS), manifest.coerced(seed)))
    todo = cut(manifest.to_ingest(names, known, staged(spark, case)[0], resume))
    noted(spark, case, known.join(names.select("document_uuid"), "document_uuid", "left_semi"))
    selected, pending = names.count(), todo.count()
    batches = -(-pending // batch_docs) if batch_docs else min(pending, 1)
    done, errors = [0, 0], []
    for k in range(batches):
        own = todo.where(F.pmod(F.xxhash64("document_uuid"), F.lit(batches)) == k)
        made, failed = _staged_batch(spark, case, files, own, make, max_pages_per_doc, tries, backoff_seconds, rate, lanes)
        done = [x + y for x, y in zip(done, made, strict=True)]
        errors += failed
    return note(spark, case, "ingest", began, {"selected": selected, "skipped": selected - pending, "staged": done[0], "chunks": done[1], "failed": pending - done[0]}, errors[:50])


def _staged_batch(spark: SparkSession, case: Case, files: DataFrame, todo: DataFrame, make: Callable, max_pages_per_doc: int | None, tries: int, backoff_seconds: float, rate: float, lanes: int) -> tuple[list[int], list]:
    """Stage the documents of todo and note them in the manifest: how many, and their chunks; and the first failures."""
    started = now()
    texts = files.join(todo.select("document_uuid"), "document_uuid", "left_semi")
    parts = pages.first_pages(pages.split_pages(texts), max_pages_per_doc)
    found = cut(providers.chunk_with(parts.where("text <> ''"), make, tries, backoff_seconds, rate, lanes))
    failed = found.where("error is not null").groupBy("title").agg(F.min("error").alias("error"))
    good = found.join(failed.select("title"), "title", "left_anti").select("title", "page_ord", F.posexplode("chunks").alias("pos", "c"))
    good = good.join(pages.page_offsets(parts).select("title", "page_ord", "page_number", "page_offset"), ["title", "page_ord"]).join(todo, "title")
    shown = F.to_json(F.when(F.size("c.entities") > 0, F.col("c.entities")).otherwise(entities.surface_entities(F.col("c.text"))))
    numbered = F.row_number().over(graph.W.partitionBy("document_uuid").orderBy("page_ord", "pos")) - 1
    chunks = good.select(
        "document_uuid", "title", F.lit(case.tenant).alias("tenant_uuid"), F.col("stem").alias("exhibit_name"), numbered.alias("chunk_index"), "page_number", (F.col("page_offset") + F.col("c.start")).alias("char_start"),
        (F.col("page_offset") + F.col("c.end")).alias("char_end"), F.col("c.text").alias("text"), text.strip(F.col("c.text")).alias("clean_text"), shown.alias("entities_json"), F.col("stem").alias("source_file"),
        F.col("path").alias("source_file_path"), F.col("path").alias("ocr_markdown_path"),
    )
    chunks = chunks.withColumn("chunk_uuid", ids.chunk_id(F.col("document_uuid"), F.col("char_start"), F.col("char_end")))
    staged_at = now()
    chunks = cut(chunks.withColumns({"id": F.col("chunk_uuid"), "entities_flat": entities.flat_entities(F.col("entities_json")), "staged_at": F.lit(staged_at)}))

    numbers = parts.groupBy("title").agg(F.max("page_number").alias("page_count_detected")).join(chunks.groupBy("title").agg(F.count("*").alias("chunk_count")), "title", "left")
    done = todo.join(failed.select("title"), "title", "left_anti").join(numbers, "title", "left").fillna(0, ["page_count_detected", "chunk_count"])
    documents = done.select(
        "document_uuid", "title", F.lit(case.tenant).alias("tenant_uuid"), F.lit(case.name).alias("case_name"), F.col("stem").alias("source_file"), F.col("stem").alias("exhibit_name"),
        text.doc_prefix(F.col("title")).alias("doc_prefix"), text.base_name(F.col("title")).alias("organized_basename"), text.title_key(F.col("title")).alias("normalized_title_key"),
        F.col("path").alias("ocr_markdown_path"), F.col("path").alias("source_file_path"), "page_count_detected", "chunk_count", F.lit(staged_at).alias("staged_at"),
    )
    append(chunks, case, "staged_chunk")
    counted = Observation()
    append(documents.observe(counted, F.count("*").alias("documents"), F.coalesce(F.sum("chunk_count"), F.lit(0)).alias("chunks")), case, "staged_document")  # last: only now are the chunks valid
    times = {"started_at": F.lit(started), "completed_at": F.lit(staged_at)}
    ok = documents.select("document_uuid", "chunk_count", "page_count_detected", "staged_at", F.lit("staged").alias("status")).withColumns(times)
    bad = todo.join(failed, "title").select("document_uuid", "error", F.lit("failed").alias("status")).withColumns(times)
    noted(spark, case, ok.unionByName(bad, allowMissingColumns=True))
    return [counted.get["documents"], counted.get["chunks"]], failed.orderBy("title").limit(50).collect()


def load(spark: SparkSession, case: Case, only_prefix: str = "", start_at: int = 0, limit_docs: int | None = None, resume: bool = True) -> dict:
    """Staged documents and chunks into the graph's node and edge tables; the manifest says which were loaded, and which had no staged
    document."""
    began, moment = time.time(), now()
    state = rows_of(spark, case, "manifest").select(*manifest.COLUMNS)
    todo = cut(manifest.to_load(state, resume, only_prefix, start_at, limit_docs).select("document_uuid", "title"))
    documents, chunks = (rows.join(todo.select("document_uuid"), "document_uuid", "left_semi") for rows in staged(spark, case))
    documents, chunks = cut(documents), cut(chunks.drop("staged_at"))
    root = spark.createDataFrame([(case.tenant, case.name, "active", moment, case.uuid)], "tenant_uuid string, case_name string, status string, created_at string, key string")
    old = rows_of(spark, case, "case").withColumn("key", F.col("project_uuid")).drop("project_uuid")
    put(graph.upsert(old, root, ["key"], once=("created_at",)), case, "case")  # one row
    merged(spark, case, "document", documents, ["document_uuid"])
    merged(spark, case, "chunk", chunks, ["document_uuid", "chunk_uuid"])
    follows = chunks.select(F.col("chunk_uuid").alias("src"), "document_uuid")
    for name, edges in (
        ("has_document", graph.has_edges(documents.withColumn("case", F.lit(case.uuid)), "case", "document_uuid")),
        ("has_chunk", graph.has_edges(chunks, "document_uuid", "chunk_uuid")),
        ("next_chunk", graph.next_edges(chunks).join(follows, "src")),
    ):
        keyed_table(spark, case, name).update(case.uuid, edges, BY[name], graph.merge_edges)
    ok = documents.select("document_uuid", F.lit("loaded").alias("status"), F.lit(moment).alias("loaded_at"), F.lit(moment).alias("completed_at"))
    missing = cut(todo.join(documents.select("document_uuid"), "document_uuid", "left_anti").withColumn("error", F.lit("no staged document")))
    bad = missing.select("document_uuid", F.lit("failed").alias("status"), "error", F.lit(moment).alias("completed_at"))
    noted(spark, case, ok.unionByName(bad, allowMissingColumns=True))
    stats = graph.load_stats(documents, chunks).first().asDict()
    return note(spark, case, "load", began, stats | {"failed": missing.count()}, missing.orderBy("title").limit(50).collect())


def duplicates(spark: SparkSession, case: Case) -> DataFrame:
    """(table, key, rows) of keys that several rows of a node table have: none, if the constraints hold."""
    keys = {"case": "project_uuid", "document": "document_uuid", "chunk": "chunk_uuid", "canonical_entity": "canonical_id"}
    found = None
    for name, key in keys.items():
        rows = graph.duplicate_keys(rows_of(spark, case, name), [key]).select(F.lit(name).alias("table"), F.col(key).alias("key"), "rows")
        found = rows if found is None else found.unionByName(rows)
    return found


def indexes(spark: SparkSession, case: Case) -> dict:
    """How many keys break the uniqueness of each node table, and how many vectors of which length the documents have: what a store would check
    when it makes its indexes. The report names the first keys."""
    began = time.time()
    found = cut(duplicates(spark, case))
    counts = {f"duplicate_{r['table']}": r["n"] for r in found.groupBy("table").agg(F.count("*").alias("n")).collect()}
    sizes = rows_of(spark, case, "document").where("summary_embedding is not null").groupBy(F.size("summary_embedding").alias("n")).count()
    worst = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("vectors"), F.count("*").alias("lengths")).first().asDict()
    named = [{"title": r["key"], "error": f"{r['rows']} rows in {r['table']}"} for r in found.orderBy("table", "key").limit(50).collect()]
    return note(spark, case, "indexes", began, {f"duplicate_{t}": counts.get(f"duplicate_{t}", 0) for t in ("case", "document", "chunk", "canonical_entity")} | worst, named)


def ingest_analysis(spark: SparkSession, case: Case) -> dict:
    """The analysis file's values onto the documents they belong to."""
    rows = cut(scans.analysis_csv(spark, case.inputs("organized/analysis/analysis.csv")))
    documents = cut(analysis.with_keys(rows_of(spark, case, "document")))
    update = analysis.join_analysis(rows, documents).join(documents.select("document_uuid", "doc_prefix", "normalized_title_key"), "document_uuid", "right")
    merged(spark, case, "document", update, ["document_uuid"])
    return analysis.join_counts(rows, documents).first().asDict()


def analysis_join_report(spark: SparkSession, case: Case, top_n: int = 50) -> dict:
    """How the analysis file meets the documents: counts, coverage and the first names that found none or several."""
    began = time.time()
    rows = cut(scans.analysis_csv(spark, case.inputs("organized/analysis/analysis.csv")))
    documents = cut(analysis.with_keys(rows_of(spark, case, "document")))
    metrics = analysis.join_counts(rows, documents).first().asDict() | analysis.coverage(documents).first().asDict()
    named = [(kind, r["organized_doc_number"]) for kind in ("none", "ambiguous") for r in analysis.examples(rows, documents, kind, top_n).collect()]
    named += [("without analysis", r["title"]) for r in analysis.without_analysis(documents, top_n).collect()]
    return note(spark, case, "analysis_join_report", began, metrics, [{"title": name, "error": kind} for kind, name in named])


def embed_docs(spark: SparkSession, case: Case, limit: int = 0, service: Callable | None = None, model: str = "hashed words") -> dict:
    """Vectors of the summaries that have none yet, of the first so many documents; 0 is all."""
    rows = similarity.pending(rows_of(spark, case, "document"), limit).select("document_uuid", providers.embed(F.col("summary_text"), service).alias("summary_embedding"))
    rows = cut(rows.withColumn("summary_embedding_model", F.lit(model)))
    merged(spark, case, "document", rows, ["document_uuid"])
    return {"embedded": rows.count()}


def build_doc_similarity(spark: SparkSession, case: Case, top_k: int = 10, max_edges_per_doc: int | None = None, limit_docs: int = 0, min_score: float = 0.75, reset: bool = False, probes: int = 0) -> dict:
    """SIMILAR_TO edges between the project's documents; all projects' documents compete for the places. reset: the project's old edges go.
    probes: 0 compares all pairs; otherwise an index of cells is made, of which so many are searched for each document."""
    vectors = every(spark, case, "document").select(F.col("document_uuid").alias("id"), F.col("summary_embedding").alias("v"))
    within = rows_of(spark, case, "document").select(F.col("document_uuid").alias("id"))
    if probes:
        index = vector_index.build(vectors, f"{shared_folder(spark)}/index-{uuid.uuid4().hex}")
        asked = vectors.join(within.orderBy("id").limit(limit_docs) if limit_docs else within, "id", "left_semi")
        found = vector_index.similar_edges(index, asked, top_k if max_edges_per_doc is None else max_edges_per_doc, min_score, probes)
        edges = cut(found.join(within.select(F.col("id").alias("dst")), "dst", "left_semi"))
    else:
        edges = cut(similarity.similar_edges(vectors, top_k, max_edges_per_doc, min_score, limit_docs, within=within))
    old = rows_of(spark, case, "similar_to").select("src", "dst", "score")
    kept = old.limit(0) if reset else old.join(edges.select("src", "dst"), ["src", "dst"], "left_anti")
    put(kept.unionByName(edges), case, "similar_to")
    return {"similar_to": edges.count()}


def load_entities(spark: SparkSession, case: Case, limit_chunks: int = 0) -> dict:
    """Canonical entities of the chunks' payloads, their mentions and co-occurrence; of the first so many chunks, 0 is all."""
    chunks = rows_of(spark, case, "chunk")
    asked = chunks.where(F.coalesce("entities_json", F.lit("")) != "")
    asked = asked.orderBy("document_uuid", "chunk_index", "chunk_uuid").limit(limit_chunks) if limit_chunks else asked
    raw = cut(entities.raw_entities(asked))
    found = cut(entities.canonical_entities(raw, F.lit(case.uuid)))
    merged(spark, case, "canonical_entity", found.drop("normalized_text", "cluster_ord"), ["canonical_id"])
    edges = cut(entities.existing_mentions(entities.mentions(raw, F.lit(case.uuid)), found, chunks))
    keyed_table(spark, case, "mentioned_in").update(case.uuid, edges.select(F.col("canonical_id").alias("src"), F.col("chunk_uuid").alias("dst")), BY["mentioned_in"], graph.merge_edges)
    pairs = cut(entities.co_occurrence(_mentions(spark, case)))
    merged(spark, case, "co_occurs_with", pairs, ["src", "dst"])
    return {"raw_entities": raw.count(), "canonical_entities": found.count(), "mentions": edges.count(), "cooccurs": pairs.count()}


def _mentions(spark: SparkSession, case: Case) -> DataFrame:
    return rows_of(spark, case, "mentioned_in").select(F.col("src").alias("canonical_id"), F.col("dst").alias("chunk_uuid"))


def build_doc_entity_links(spark: SparkSession, case: Case, min_entity_mentions: int = 3, limit_entities: int = 5000, max_docs_per_entity: int = 50, min_shared_entities: int = 2) -> dict:
    """SHARES_ENTITY edges between documents."""
    found = entities.shares_entity(rows_of(spark, case, "canonical_entity"), _mentions(spark, case), rows_of(spark, case, "chunk"), min_entity_mentions, limit_entities, max_docs_per_entity, min_shared_entities)
    found = cut(found)
    merged(spark, case, "shares_entity", found, ["src", "dst"])
    return {"shares_entity": found.count()}


def markov_enrich(spark: SparkSession, case: Case, limit_chunks: int = 0) -> dict:
    """Context of each chunk as JSON; of the first so many chunks, 0 is all."""
    chunks = rows_of(spark, case, "chunk")
    near = enrich.neighbourhoods(chunks, rows_of(spark, case, "document"), rows_of(spark, case, "canonical_entity"), _mentions(spark, case))
    if limit_chunks:
        asked = chunks.orderBy("document_uuid", "chunk_index", "chunk_uuid").limit(limit_chunks).select("chunk_uuid")
        near = near.join(asked, "chunk_uuid", "left_semi")
    rows = cut(enrich.render(near).join(chunks.select("chunk_uuid", "document_uuid"), "chunk_uuid"))
    merged(spark, case, "chunk", rows, ["document_uuid", "chunk_uuid"])
    return {"enriched": rows.count()}


#: Verbs as the command line names them.
VERBS = {
    "ocr": ocr, "indexes": indexes, "ingest": ingest, "load": load, "ingest-analysis": ingest_analysis, "analysis-join-report": analysis_join_report, "embed-docs": embed_docs, "build-doc-similarity": build_doc_similarity,
    "load-entities": load_entities, "build-doc-entity-links": build_doc_entity_links, "markov-enrich": markov_enrich,
}
