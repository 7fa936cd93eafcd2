"""Queries: each operator over stand-ins made of the driver's tables. Stand-ins are DataFrames named as in the graph's model."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions import ids, text
from graphloom.operators import analysis, chunks, enrich, entities, files, graph, manifest, pages, reports, retrieval, similarity, vector_index
from graphloom.plans.lineage import cut, shared_folder
from graphloom.sources import pdf, providers

PROJECT = str(uuid.uuid5(uuid.UUID(ids.CASES), "demo case"))
TARGET = 1200
#: Bytes of generated files that are held at once.
PDF_BYTES = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Stand-ins


def titled(spark, sf_dir):
    """documents with a title: DOC_#### names for even ids, others without a number; and document_uuid."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    title = F.when(F.col("doc_id") % 2 == 0, F.format_string("DOC_%04d_%s_%s.md", "doc_id", "source", "lang")).otherwise(F.format_string("%s %s %d.md", "source", "lang", "doc_id"))
    return d.withColumn("title", title).withColumn("document_uuid", ids.document_id(F.lit(PROJECT), F.col("title")))


def turns(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select(F.format_string("conv_%d.md", "conv_id").alias("title"), (F.col("turn") + 1).cast("int").alias("page_number"), "text")


def conversation_pages(spark, sf_dir):
    return pages.split_pages(pages.assemble_markdown(turns(spark, sf_dir)))


def plain_chunks(spark, sf_dir):
    d = titled(spark, sf_dir).select("doc_id", "document_uuid", "text")
    one = d.select("doc_id", "document_uuid", F.lit(0).alias("page_ord"), F.lit(1).alias("page_number"), F.lit(0).cast("long").alias("page_offset"), "text")
    return chunks.chunk_pages(one, TARGET)


def relational_chunks(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return o.select(F.col("o_custkey").alias("document_uuid"), F.col("o_orderkey").alias("chunk_uuid"), (F.row_number().over(w) - 1).alias("chunk_index"), F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.col("o_orderstatus")).alias("exhibit_name"), F.year("o_orderdate").alias("page_number"))


def relational_mentions(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("canonical_id"), F.col("l_orderkey").alias("chunk_uuid")).distinct()


def relational_entities(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("canonical_id")).agg(F.count("*").alias("mention_count"))
    return n.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("canonical_id"), F.col("p_name").alias("canonical_text")), "canonical_id")


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


def planted_vectors(spark, sf_dir):
    """The table's vectors in groups of five that lean to the first of them, so that each has near neighbours."""
    v = vectors(spark, sf_dir).withColumn("head", F.col("id") - F.col("id") % 5)
    heads = vectors(spark, sf_dir).where("id % 5 = 0").select(F.col("id").alias("head"), F.col("v").alias("h"))
    near = F.zip_with("h", "v", lambda h, x: h.cast("double") + 0.3 * x.cast("double"))
    return v.join(heads, "head").select("id", near.alias("v"))


def document_pdfs(spark, sf_dir):
    """A PDF of each document, a page for each 2000 characters; those of odd ids have their objects in deflated object streams."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("title"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            titles, contents, size = [], [], 0
            for title, text in zip(batch.column("title"), batch.column("text"), strict=True):
                t = text.as_py()
                titles.append(title.as_py())
                contents.append(pdf.made([t[k : k + 2000] for k in range(0, len(t), 2000)] or [""], int(titles[-1]) % 2 == 1))
                size += len(contents[-1])
                if size >= PDF_BYTES:
                    yield pa.RecordBatch.from_pydict({"title": titles, "content": contents})
                    titles, contents, size = [], [], 0
            if titles:
                yield pa.RecordBatch.from_pydict({"title": titles, "content": contents})

    return d.mapInArrow(run, "title string, content binary")


def old_manifest(spark, sf_dir):
    """All documents, and one that only this manifest has."""
    k = F.col("doc_id")
    status = F.element_at(F.array(*[F.lit(s) for s in ("", "pending", "staged", "loaded", "failed")]), (k % 5 + 1).cast("int"))
    rows = titled(spark, sf_dir).select("document_uuid", "title", F.lit("a").alias("source_file"), status.alias("status"), F.when(k % 5 == 4, "broken").alias("error"), (k % 11).cast("int").alias("chunk_count"), F.when(k % 4 == 0, "2024-01-01T00:00:00Z").alias("staged_at"))
    hand = spark.createDataFrame([("old1", "old one", "a", "failed", "gone", 3, "")], "document_uuid string, title string, source_file string, status string, error string, chunk_count int, staged_at string")
    return manifest.coerced(rows.unionByName(hand))


def new_manifest(spark, sf_dir):
    """All documents, and one that only this manifest has."""
    k = F.col("doc_id")
    status = F.element_at(F.array(*[F.lit(s) for s in ("pending", "staged", "failed", "loaded")]), (k % 4 + 1).cast("int"))
    rows = titled(spark, sf_dir).select("document_uuid", F.when(k % 2 == 0, F.col("title")).otherwise("").alias("title"), F.lit("b").alias("source_file"), status.alias("status"), F.when(k % 4 == 2, "again").alias("error"), (k % 13).cast("int").alias("chunk_count"), F.when(k % 4 == 1, "2024-02-02T00:00:00Z").alias("staged_at"))
    hand = spark.createDataFrame([("new1", "new one", "b", "staged", "", 4, "")], "document_uuid string, title string, source_file string, status string, error string, chunk_count int, staged_at string")
    return manifest.coerced(rows.unionByName(hand))


def reviewed_documents(spark, sf_dir):
    """Titled documents and two made by hand, which make a prefix and a key ambiguous."""
    d = titled(spark, sf_dir).select("document_uuid", "title", F.lit("").alias("source_file"))
    more = spark.createDataFrame([("x1", "DOC_0002_other.md", ""), ("x2", "src1 en 1.txt", ""), ("x3", None, "lonely paper.pdf")], "document_uuid string, title string, source_file string")
    return analysis.with_keys(d.union(more))


def review_rows(spark, sf_dir):
    """A row for each label, and rows made by hand: ambiguous, repeated, by key, unmatched, nameless."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic").join(d, "doc_id")
    name = F.when(F.col("doc_id") % 2 == 0, F.format_string("DOC_%04d_x.pdf", "doc_id")).otherwise(F.format_string("%s-%s-%d.pdf", "source", "lang", "doc_id"))
    rows = labels.select((F.col("doc_id") * 10).alias("row_no"), name.alias("organized_doc_number"), F.lit("pdf").alias("file_type"), F.col("lang").alias("file_description"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("relevance_analysis"), F.col("source").alias("original_file_path"))
    hand = [(-1, "DOC_0002_x.pdf", "pdf", "a", "b", "p"), (100000001, "DOC_0004_again.pdf", "doc", "again", "", "q"), (100000002, "Lonely  Paper.doc", "doc", "", "c", "r"), (100000003, "DOC_7777_nowhere.pdf", "pdf", "d", "e", "s"), (100000004, "", "pdf", "f", "g", "t")]
    return rows.union(spark.createDataFrame(hand, "row_no long, organized_doc_number string, file_type string, file_description string, relevance_analysis string, original_file_path string"))


def entity_chunks(spark, sf_dir, near=False):
    """A chunk for each document, whose payload lists its capitalised words; in capitals for some documents, so that spellings differ. near: with
    a capital at the end in others, so that spellings one letter apart are taken together."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.transform(F.filter(F.split(F.coalesce("text", F.lit("")), " ", -1), lambda w: w.rlike(r"^[A-Z][a-z]{3,}[.,]?\z")), lambda w: F.rtrim(w, F.lit(".,")))
    words = F.transform(words, lambda w: F.when(F.col("doc_id") % 5 == 0, F.upper(w)).otherwise(w))
    if near:
        words = F.transform(words, lambda w: F.when(F.col("doc_id") % 5 == 1, F.concat(F.substring(w, F.lit(1), F.length(w) - 1), F.upper(F.right(w, F.lit(1))))).otherwise(w))
    kind = lambda w: F.when(F.length(w) % 3 == 0, "person").when(F.length(w) % 3 == 1, "PLACE")
    payload = F.to_json(F.transform(words, lambda w: F.struct(kind(w).alias("entity_type"), w.alias("text"))))
    payload = F.when(F.col("doc_id") % 17 == 3, "{not json").otherwise(payload)
    return d.select(F.format_string("%09d", "doc_id").alias("document_uuid"), F.lit(0).alias("chunk_index"), F.format_string("c%d", "doc_id").alias("chunk_uuid"), payload.alias("entities_json"))


# Queries


def uuid5_documents(spark, sf_dir):
    return titled(spark, sf_dir).select("doc_id", ids.project_id(F.lit("demo case")).alias("project_uuid"), "document_uuid", ids.uuid5("no uuid", F.col("title")).alias("named_uuid"))


def doc_prefix_keys(spark, sf_dir):
    return titled(spark, sf_dir).select("doc_id", text.doc_prefix(F.col("title")).alias("doc_prefix"), text.base_name(F.col("title")).alias("organized_basename"))


def normalized_title_keys(spark, sf_dir):
    return titled(spark, sf_dir).select("doc_id", text.title_key(F.col("title")).alias("normalized_title_key"))


def ocr_markdown(spark, sf_dir):
    return pages.assemble_markdown(turns(spark, sf_dir))


def page_split(spark, sf_dir):
    return conversation_pages(spark, sf_dir).select("title", "page_ord", "page_number", F.coalesce("total_pages", F.lit(0)).alias("total_pages"), "text")


def page_offsets(spark, sf_dir):
    return pages.page_offsets(conversation_pages(spark, sf_dir)).select("title", "page_number", "page_offset")


def first_pages(spark, sf_dir):
    return pages.first_pages(conversation_pages(spark, sf_dir), 3).select("title", "page_number")


def chunk_spans(spark, sf_dir):
    return plain_chunks(spark, sf_dir).select("doc_id", "chunk_index", "char_start", "char_end")


def chunk_ids(spark, sf_dir):
    return plain_chunks(spark, sf_dir).select("doc_id", "chunk_index", "chunk_uuid", F.md5("text").alias("text_md5"))


def next_chunk(spark, sf_dir):
    return graph.next_edges(relational_chunks(spark, sf_dir))


def doc_metadata(spark, sf_dir):
    p = pages.page_offsets(conversation_pages(spark, sf_dir))
    return p.groupBy("title").agg(F.max("page_number").alias("page_count_detected"), F.count("*").alias("n_pages"), F.max(F.col("page_offset") + F.length("text")).alias("n_chars"))


def manifest_merge(spark, sf_dir):
    return manifest.merge(old_manifest(spark, sf_dir), new_manifest(spark, sf_dir))


def resume_pending(spark, sf_dir):
    d = titled(spark, sf_dir).select("doc_id", "document_uuid")
    return manifest.to_ingest(d, old_manifest(spark, sf_dir), d.where(F.col("doc_id") % 2 == 0)).select("doc_id")


def load_selection(spark, sf_dir):
    return manifest.to_load(old_manifest(spark, sf_dir), prefix="doc_0", start=0, limit=None).unionByName(manifest.to_load(old_manifest(spark, sf_dir), start=5, limit=40)).select("document_uuid", "title", "status")


def analysis_join(spark, sf_dir):
    return analysis.join_analysis(review_rows(spark, sf_dir), reviewed_documents(spark, sf_dir))


def analysis_join_report_counts(spark, sf_dir):
    return analysis.join_counts(review_rows(spark, sf_dir), reviewed_documents(spark, sf_dir))


def analysis_examples(spark, sf_dir):
    rows, docs = review_rows(spark, sf_dir), reviewed_documents(spark, sf_dir)
    return analysis.examples(rows, docs, "none").withColumn("kind", F.lit("unmatched")).union(analysis.examples(rows, docs, "ambiguous").withColumn("kind", F.lit("ambiguous")))


def analysed_documents(spark, sf_dir):
    return graph.upsert(reviewed_documents(spark, sf_dir), analysis_join(spark, sf_dir), ["document_uuid"])


def analysis_coverage(spark, sf_dir):
    return analysis.coverage(analysed_documents(spark, sf_dir))


def analysis_unmatched_docs(spark, sf_dir):
    return analysis.without_analysis(analysed_documents(spark, sf_dir), 50)


def key_backfill(spark, sf_dir):
    k = F.col("doc_id")
    stored = titled(spark, sf_dir).select("doc_id", F.when(k % 4 != 1, F.col("title")).alias("title"), F.col("title").alias("source_file"), F.when(k % 3 == 1, "  ").when(k % 3 == 2, "DOC_9999 ").alias("doc_prefix"), F.when(k % 5 == 0, "stored key").alias("normalized_title_key"))
    return analysis.with_keys(stored).select("doc_id", "doc_prefix", "normalized_title_key", "keys_changed")


def raw_entities(spark, sf_dir):
    return entities.raw_entities(entity_chunks(spark, sf_dir)).select("chunk_uuid", "pos", "entity_type", "text")


def canonical_entities(spark, sf_dir):
    out = entities.canonical_entities(entities.raw_entities(entity_chunks(spark, sf_dir)), F.lit(PROJECT))
    return out.select("canonical_id", "entity_type", "normalized_text", "cluster_ord", "canonical_text", F.array_join("variants", "|").alias("variants"), "mention_count")


def canonical_splits(spark, sf_dir):
    out = entities.canonical_entities(entities.raw_entities(entity_chunks(spark, sf_dir)), F.lit(PROJECT), all_splits=True)
    return out.select("canonical_id", "cluster_ord", "canonical_text", "mention_count")


def canonical_absorbed(spark, sf_dir):
    out = entities.canonical_entities(entities.raw_entities(entity_chunks(spark, sf_dir, near=True)), F.lit(PROJECT), all_splits=True)
    return out.select("canonical_id", "cluster_ord", "canonical_text", F.array_join("variants", "|").alias("variants"), "mention_count")


def entity_mentions(spark, sf_dir):
    return entities.mentions(entities.raw_entities(entity_chunks(spark, sf_dir)), F.lit(PROJECT))


def fuzzy_ratio(spark, sf_dir):
    t = titled(spark, sf_dir).select("doc_id", "title")
    return t.select("doc_id", F.round(entities.similarity(F.col("title"), F.concat(F.lit("copy of "), F.col("title"))), 6).alias("ratio"))


def co_occurs(spark, sf_dir):
    return entities.co_occurrence(relational_mentions(spark, sf_dir))


def shares_entity(spark, sf_dir):
    return entities.shares_entity(relational_entities(spark, sf_dir), relational_mentions(spark, sf_dir), relational_chunks(spark, sf_dir))


def shares_entity_capped(spark, sf_dir):
    return entities.shares_entity(relational_entities(spark, sf_dir), relational_mentions(spark, sf_dir), relational_chunks(spark, sf_dir), min_mentions=20, limit_entities=200, max_docs=10, min_shared=1)


def similar_to(spark, sf_dir):
    return similarity.similar_edges(vectors(spark, sf_dir), min_score=0.25).withColumn("score", F.round("score", 6))


def similar_to_default(spark, sf_dir):
    return similarity.similar_edges(vectors(spark, sf_dir)).withColumn("score", F.round("score", 6))


def similar_planted(spark, sf_dir):
    return similarity.similar_edges(planted_vectors(spark, sf_dir)).withColumn("score", F.round("score", 6))


def similar_indexed(spark, sf_dir):
    v = planted_vectors(spark, sf_dir)
    index = vector_index.build(v, f"{shared_folder(spark)}/index-{uuid.uuid4().hex}")
    return vector_index.similar_edges(index, v, probes=4, exact=True).withColumn("score", F.round("score", 6))


def similar_to_reset(spark, sf_dir):
    v = vectors(spark, sf_dir)
    rows = cut(similarity.nearest(v, 10, min_score=0.2))  # all pairs are scored once for both
    old = similarity.edges(rows, 4, 0.2)
    new = similarity.edges(rows, 10, 0.3).where(F.col("src") % 2 == 0)
    return graph.replace_edges(old, new, v.where(F.col("id") % 2 == 0).select(F.col("id").alias("src"))).withColumn("score", F.round("score", 6))


def embed_pending(spark, sf_dir):
    k = F.col("doc_id")
    d = titled(spark, sf_dir).select("document_uuid", F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.col("title")).alias("summary_text"), F.when(k % 2 == 0, F.array(F.lit(1.0))).alias("summary_embedding"))
    return similarity.pending(d, 200).select("document_uuid", "summary_text")


def embed_documents(spark, sf_dir):
    from graphloom.sources.providers import embed

    return titled(spark, sf_dir).select("document_uuid", embed(F.col("title")).alias("v")).select("document_uuid", F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x), 4).alias("norm"))


def _neighbourhoods(spark, sf_dir):
    c = relational_chunks(spark, sf_dir).withColumns({"chunk_uuid": F.col("chunk_uuid").cast("string"), "document_uuid": F.col("document_uuid").cast("string")})
    d = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("document_uuid"), F.col("c_name").alias("title"))
    e = relational_entities(spark, sf_dir).withColumn("canonical_id", F.col("canonical_id").cast("string"))
    m = relational_mentions(spark, sf_dir).select(F.col("canonical_id").cast("string").alias("canonical_id"), F.col("chunk_uuid").cast("string").alias("chunk_uuid"))
    return enrich.render(enrich.neighbourhoods(c, d, e, m))


def markov_neighbors(spark, sf_dir):
    return _neighbourhoods(spark, sf_dir).select("chunk_uuid", "neighbor_summary", "markov_version")


def markov_hints(spark, sf_dir):
    return _neighbourhoods(spark, sf_dir).select("chunk_uuid", "traversal_hints", "context_enriched")


def edge_summary(spark, sf_dir):
    return _neighbourhoods(spark, sf_dir).select("chunk_uuid", "edge_summary")


def _text_files(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.format_string("%s/%d.txt", "source", "doc_id").alias("path"), F.sha2("text", 256).alias("hash"))


def pdf_page_counts(spark, sf_dir):
    parts = providers.page_ranges(document_pdfs(spark, sf_dir), 3)
    counted = parts.where("error is null").withColumn("own", F.col("last_page") - F.col("first_page") + 1)
    return counted.groupBy(F.col("title").cast("long").alias("doc_id")).agg(F.max("last_page").alias("pages"), F.count("*").alias("ranges"), F.sum("own").alias("asked"))


def file_dedup(spark, sf_dir):
    return files.deduplicated(_text_files(spark, sf_dir))


def copy_plan(spark, sf_dir):
    return files.copy_plan(_text_files(spark, sf_dir))


def file_renumber(spark, sf_dir):
    return files.renumbered(titled(spark, sf_dir).select(F.col("title").alias("name")))


def file_walk(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    folder = F.element_at(F.array(*[F.lit(x) for x in ("case", "organized", ".git", "case/ai_docs")]), (F.col("doc_id") % 4 + 1).cast("int"))
    return files.walk(d.select(F.concat_ws("/", folder, "source", F.format_string("%s%d.pdf", F.when(F.col("doc_id") % 7 == 0, ".").otherwise(""), "doc_id")).alias("path")))


def inventory_recover(spark, sf_dir):
    f = _text_files(spark, sf_dir)
    organised = f.select(F.concat(F.lit("DOC_"), F.regexp_extract("path", r"(\d+)\.txt", 1)).alias("name"), "hash")
    return files.recovered(organised, f.where(F.regexp_extract("path", r"(\d+)\.txt", 1).cast("long") % 3 != 0))


def inventory_origins(spark, sf_dir):
    t = titled(spark, sf_dir)
    return files.with_origin(t.select(F.col("title").alias("name")), t.where(F.col("doc_id") % 3 == 0).select(F.col("title").alias("new_filename"), F.col("source").alias("original_path")))


def rename_propagation(spark, sf_dir):
    t = titled(spark, sf_dir)
    return files.renamed_rows(t.select(F.col("title").alias("name"), "doc_id"), t.where(F.col("doc_id") % 3 == 1).select(F.col("title").alias("old"), F.concat(F.lit("new "), F.col("title")).alias("new")))


def to_analyse(spark, sf_dir):
    t = titled(spark, sf_dir)
    names = t.select(F.regexp_replace("title", r"\.md\z", "").alias("b"), "doc_id").select(F.concat("b", F.element_at(F.array(*[F.lit(x) for x in (".pdf", ".DOCX", ".png")]), (F.col("doc_id") % 3 + 1).cast("int"))).alias("name"), "doc_id")
    return files.to_analyse(names, names.where(F.col("doc_id") % 8 == 0), skip=("DOC_0010",))


def large_files(spark, sf_dir):
    t = titled(spark, sf_dir)
    return files.large_files(t.select(F.regexp_replace("title", r"\.md\z", ".PDF").alias("name"), (F.col("doc_id") % 90).cast("int").alias("n_pages")))


def bates_labels(spark, sf_dir):
    return files.page_stamps(titled(spark, sf_dir).select(F.col("title").alias("name"), (F.col("doc_id") % 4).cast("int").alias("n_pages")))


def ocr_page_ranges(spark, sf_dir):
    return pages.request_ranges(titled(spark, sf_dir).select("title", (F.col("doc_id") % 90).cast("int").alias("n_pages")))


def graph_integrity(spark, sf_dir):
    d = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("document_uuid"))
    return graph.integrity(d, relational_chunks(spark, sf_dir))


def has_chunk(spark, sf_dir):
    return graph.has_edges(relational_chunks(spark, sf_dir), "document_uuid", "chunk_uuid")


def duplicate_keys(spark, sf_dir):
    return graph.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


def seq_path(spark, sf_dir):
    c = relational_chunks(spark, sf_dir).withColumn("chunk_uuid", F.col("chunk_uuid").cast("string"))
    return retrieval.sequence_paths(c)


def seq_path_branches(spark, sf_dir):
    """NEXT_CHUNK with branches past a chunk, edges back and gaps, as loads of different versions leave them."""
    c = relational_chunks(spark, sf_dir).withColumn("chunk_uuid", F.col("chunk_uuid").cast("string"))
    e = graph.next_edges(c)
    skips = e.alias("a").join(e.alias("b"), F.col("a.dst") == F.col("b.src")).select("a.src", "b.dst").where(F.col("src").cast("long") % 7 == 0)
    backs = e.where(F.col("src").cast("long") % 11 == 0).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    kept = e.where(F.col("src").cast("long") % 13 != 0)
    return retrieval.sequence_paths(c, edges=kept.unionByName(skips).unionByName(backs), longest=6)


def related_docs(spark, sf_dir):
    return retrieval.related_documents(shares_entity(spark, sf_dir))


def exhibit_chunks(spark, sf_dir):
    return retrieval.chunks_of_exhibit(relational_chunks(spark, sf_dir), "O")


def run_rates(spark, sf_dir):
    return reports.run_metrics(old_manifest(spark, sf_dir), 12.5).unionByName(reports.run_metrics(new_manifest(spark, sf_dir), 0.0))


def failed_documents(spark, sf_dir):
    return reports.failures(manifest_merge(spark, sf_dir))


def upsert_document(spark, sf_dir):
    d = titled(spark, sf_dir)
    k = F.col("doc_id")
    old = d.where(k % 3 != 0).select("document_uuid", "title", F.lit("2024").alias("created_at"), F.when(k % 2 == 0, F.col("lang")).alias("lang"), F.col("source"))
    new = d.where(k % 2 == 0).select("document_uuid", F.upper("title").alias("title"), F.lit("2025").alias("created_at"), F.when(k % 4 == 0, F.col("lang")).alias("lang"), k.cast("string").alias("rank"))
    return graph.upsert(old, new, ["document_uuid"], once=("created_at",))


def document_maxima(spark, sf_dir):
    return graph.document_maxima(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("document_uuid")), relational_chunks(spark, sf_dir))


def load_stats(spark, sf_dir):
    return graph.load_stats(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("document_uuid")), relational_chunks(spark, sf_dir))


def mention_endpoints(spark, sf_dir):
    often = relational_entities(spark, sf_dir).where("mention_count >= 25")
    return entities.existing_mentions(relational_mentions(spark, sf_dir), often, relational_chunks(spark, sf_dir).where("exhibit_name <> ''"))


def entity_chunk_lists(spark, sf_dir):
    return entities.chunk_lists(relational_mentions(spark, sf_dir)).select("canonical_id", F.array_join(F.transform("chunk_ids", lambda x: x.cast("string")), ",").alias("chunk_ids"))


def entities_flat(spark, sf_dir):
    return entity_chunks(spark, sf_dir).select("chunk_uuid", F.coalesce(F.array_join(entities.flat_entities(F.col("entities_json")), "|"), F.lit("")).alias("entities_flat"))


def relevance_texts(spark, sf_dir):
    """Answers as an object, as a list of one, and as an empty list, which counts as no answer."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    answer = F.when(F.col("quality") == 1, '[{"relevance_status": "Relevant", "relevance_explanation": "good"}]').when(F.col("toxic") == 1, '{"relevance_explanation": "toxic"}').otherwise("[]")
    found = labels.select("doc_id", analysis.unwrapped(answer).alias("a")).where("a is not null")
    return found.select("doc_id", text.relevance(F.col("a.relevance_status"), F.col("a.relevance_explanation")).alias("relevance_analysis"))


def plain_markdown(spark, sf_dir):
    return pages.assemble_plain(turns(spark, sf_dir))


def range_markdown(spark, sf_dir):
    """Turns as ranges of ten pages; those of an even position among four fail."""
    c = table(spark, sf_dir, "conversations").select(F.format_string("conv_%d.pdf", "conv_id").alias("title"), "turn", "text")
    first = (F.col("turn") * 10 + 1).cast("int")
    return pages.assemble_ranges(c.select("title", first.alias("first_page"), (first + 9).alias("last_page"), F.when(F.col("turn") % 4 != 2, F.col("text")).alias("text")))


QUERIES = (
    uuid5_documents, doc_prefix_keys, normalized_title_keys, ocr_markdown, page_split, page_offsets, first_pages, chunk_spans, chunk_ids, next_chunk, doc_metadata, manifest_merge, resume_pending, load_selection,
    analysis_join, analysis_join_report_counts, analysis_examples, analysis_coverage, analysis_unmatched_docs, key_backfill, raw_entities, canonical_entities, canonical_splits, canonical_absorbed, entity_mentions, fuzzy_ratio,
    co_occurs, shares_entity, shares_entity_capped, similar_to, similar_to_default, similar_planted, similar_indexed, similar_to_reset, embed_pending, embed_documents, markov_neighbors, markov_hints, edge_summary, file_dedup, copy_plan, file_renumber,
    file_walk, inventory_recover, inventory_origins, rename_propagation, to_analyse, large_files, bates_labels, ocr_page_ranges, pdf_page_counts, graph_integrity, has_chunk, duplicate_keys, seq_path, seq_path_branches, related_docs, exhibit_chunks,
    run_rates, failed_documents, upsert_document, document_maxima, load_stats, mention_endpoints, entity_chunk_lists, entities_flat, relevance_texts, plain_markdown, range_markdown,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}
