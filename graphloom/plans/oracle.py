"""DuckDB SQL for the queries: written from the operators' definitions over the base tables, not from their plans."""

from __future__ import annotations

import uuid

from graphloom.functions.ids import CASES, DNS
from graphloom.plans.queries import PROJECT, TARGET


def u5(namespace: str, name: str) -> str:
    """SQL of a name-based UUID; namespace is a SQL string in the canonical form."""
    h = f"sha1(unhex(replace({namespace}, '-', '')) || encode({name}))"
    variant = f"substr('89ab', ('0x' || substr({h}, 17, 1))::INT % 4 + 1, 1)"
    return f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"


def prefix(x: str) -> str:
    return f"upper(regexp_extract({x}, '(?i)(DOC_\\d{{4}})', 1))"


def base(x: str) -> str:
    return rf"trim(regexp_replace(regexp_extract({x}, '([^/]*)$', 1), '(.)\.[^.]+$', '\1'))"


def key(x: str) -> str:
    return rf"trim(regexp_replace(lower(regexp_replace({base(x)}, '(?i)DOC_\d{{4}}', '', 'g')), '[^a-z0-9\\s]+', ' ', 'g'))"


TITLE = "CASE WHEN doc_id % 2 = 0 THEN printf('DOC_%04d_%s_%s.md', doc_id, source, lang) ELSE printf('%s %s %d.md', source, lang, doc_id) END"
TITLED = f"""titled AS (
  SELECT *, {u5(f"'{PROJECT}'", "'document::' || title")} AS document_uuid FROM (SELECT doc_id, text, lang, source, {TITLE} AS title FROM documents))"""

STRIP = r"regexp_replace(%s, '^\s+|\s+$', '', 'g')"
PAGES = f"""pages_ AS (
  SELECT title, page_ord, page_number, total_pages, text FROM (
    SELECT DISTINCT printf('conv_%d.md', conv_id) AS title, 0 AS page_ord, 0 AS page_number, NULL::INT AS total_pages, printf('# OCR Output for conv_%d.pdf', conv_id) AS text FROM conversations
    UNION ALL
    SELECT printf('conv_%d.md', conv_id), turn::INT + 1, turn::INT + 1, (count(*) OVER (PARTITION BY conv_id))::INT, {STRIP % "coalesce(text, '')"} FROM conversations)),
placed AS (
  SELECT *, coalesce(sum(length(text) + 2) OVER (PARTITION BY title ORDER BY page_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS page_offset FROM pages_)"""

SPANS = rf"""cutting AS (
  SELECT doc_id, title, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, 0 AS k, 0::BIGINT AS s, 0::BIGINT AS e FROM titled
  UNION ALL
  SELECT doc_id, title, t, n, k + 1, s2, s2 + length(regexp_replace(substr(t, (s2 + 1)::INT, (e2 - s2)::INT), '\s+$', ''))
  FROM (
    SELECT *, CASE WHEN least(s2 + {TARGET}, n) >= n THEN n WHEN length(head) > 0 THEN low + length(head) ELSE s2 + {TARGET} END AS e2
    FROM (
      SELECT *, regexp_extract(substr(t, (low + 1)::INT, (least(s2 + {TARGET}, n) - low)::INT), '^(?s:.*)[ \n]') AS head
      FROM (
        SELECT *, greatest(s2 + 1, least(s2 + {TARGET}, n) - 250) AS low
        FROM (SELECT *, e + length(regexp_extract(substr(t, (e + 1)::INT), '^\s*')) AS s2 FROM cutting) a WHERE s2 < n) b) c) d),
spans AS (SELECT doc_id, title, t, k - 1 AS chunk_index, s AS char_start, e AS char_end FROM cutting WHERE k > 0)"""

GRAPH = """chunks AS (
  SELECT o_custkey AS document_uuid, o_orderkey AS chunk_uuid, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1)::INT AS chunk_index,
    CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS exhibit_name, year(o_orderdate)::INT AS page_number
  FROM orders),
mentions AS (SELECT DISTINCT l_partkey AS canonical_id, l_orderkey AS chunk_uuid FROM lineitem),
ents AS (SELECT l_partkey AS canonical_id, count(*) AS mention_count, any_value(p_name) AS canonical_text FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey)"""


def shared(min_mentions: int, limit: int, docs: int, least: int) -> str:
    return f"""top AS (SELECT canonical_id FROM ents WHERE mention_count >= {min_mentions} ORDER BY mention_count DESC, canonical_id LIMIT {limit}),
doc_ents AS (SELECT DISTINCT canonical_id, document_uuid FROM top JOIN mentions USING (canonical_id) JOIN chunks USING (chunk_uuid)),
capped AS (SELECT * FROM doc_ents QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY document_uuid) <= {docs}),
shares AS (
  SELECT a.document_uuid AS src, b.document_uuid AS dst, count(*) AS count
  FROM capped a JOIN capped b ON a.canonical_id = b.canonical_id AND a.document_uuid < b.document_uuid GROUP BY ALL HAVING count(*) >= {least})"""


def manifest_rows(name: str, hand: str, title: str, source: str, statuses: list[str], modulus: int, error: str, count: int, staged: str) -> str:
    status = f"[{', '.join(repr(s) for s in statuses)}][doc_id % {modulus} + 1]"
    return f"""{name} AS (
  SELECT document_uuid, title, source_file, '' AS ocr_markdown_path, '' AS source_file_path,
    CASE WHEN status <> '' THEN status WHEN staged_at <> '' OR chunk_count > 0 THEN 'staged' ELSE 'pending' END AS status, error, chunk_count, 0 AS page_count_detected,
    '' AS started_at, '' AS completed_at, staged_at, '' AS loaded_at
  FROM (SELECT document_uuid, {title} AS title, '{source}' AS source_file, {status} AS status, CASE WHEN {error} ELSE '' END AS error, (doc_id % {count})::INT AS chunk_count, CASE WHEN {staged} ELSE '' END AS staged_at
    FROM titled UNION ALL VALUES {hand}))"""


OLD = manifest_rows("old_m", "('old1', 'old one', 'a', 'failed', 'gone', 3, '')", "title", "a", ["", "pending", "staged", "loaded", "failed"], 5, "doc_id % 5 = 4 THEN 'broken'", 11, "doc_id % 4 = 0 THEN '2024-01-01T00:00:00Z'")
NEW = manifest_rows("new_m", "('new1', 'new one', 'b', 'staged', '', 4, '')", "CASE WHEN doc_id % 2 = 0 THEN title ELSE '' END", "b", ["pending", "staged", "failed", "loaded"], 4, "doc_id % 4 = 2 THEN 'again'", 13, "doc_id % 4 = 1 THEN '2024-02-02T00:00:00Z'")


def newer(c: str) -> str:
    return f"coalesce(nullif(b.{c}, ''), a.{c}, b.{c}) AS {c}"


MERGED = f"""merged AS (
  SELECT document_uuid, {", ".join(newer(c) for c in ("title", "source_file", "ocr_markdown_path", "source_file_path", "started_at", "completed_at", "staged_at", "loaded_at"))},
    CASE WHEN a.status IS NULL THEN b.status WHEN b.status IS NULL OR b.status = 'pending' THEN a.status ELSE b.status END AS status,
    CASE WHEN a.status IS NULL THEN b.error WHEN b.status IS NULL THEN a.error WHEN b.status IN ('staged', 'loaded') THEN b.error ELSE coalesce(nullif(b.error, ''), a.error) END AS error,
    greatest(coalesce(a.chunk_count, 0), coalesce(b.chunk_count, 0))::INT AS chunk_count, greatest(coalesce(a.page_count_detected, 0), coalesce(b.page_count_detected, 0))::INT AS page_count_detected
  FROM old_m a FULL JOIN new_m b USING (document_uuid))"""

REVIEW = f"""named AS (
  SELECT document_uuid, title, '' AS source_file FROM titled
  UNION ALL VALUES ('x1', 'DOC_0002_other.md', ''), ('x2', 'src1 en 1.txt', ''), ('x3', NULL, 'lonely paper.pdf')),
docs_ AS (
  SELECT document_uuid, title, source_file, coalesce(nullif({prefix("coalesce(title, '')")}, ''), {prefix("source_file")}) AS p, coalesce(nullif({key("coalesce(title, '')")}, ''), {key("source_file")}) AS k FROM named),
review AS (
  SELECT doc_id * 10 AS row_no, CASE WHEN doc_id % 2 = 0 THEN printf('DOC_%04d_x.pdf', doc_id) ELSE printf('%s-%s-%d.pdf', source, lang, doc_id) END AS organized_doc_number, 'pdf' AS file_type, lang AS file_description,
    'quality ' || quality AS relevance_analysis, source AS original_file_path
  FROM labels JOIN documents USING (doc_id)
  UNION ALL VALUES (-1, 'DOC_0002_x.pdf', 'pdf', 'a', 'b', 'p'), (100000001, 'DOC_0004_again.pdf', 'doc', 'again', '', 'q'), (100000002, 'Lonely  Paper.doc', 'doc', '', 'c', 'r'),
    (100000003, 'DOC_7777_nowhere.pdf', 'pdf', 'd', 'e', 's'), (100000004, '', 'pdf', 'f', 'g', 't')),
keyed AS (SELECT *, {prefix("organized_doc_number")} AS p, {key("organized_doc_number")} AS k FROM review),
counted AS (
  SELECT r.*, (SELECT count(*) FROM docs_ d WHERE d.p = r.p AND r.p <> '') AS np, (SELECT min(document_uuid) FROM docs_ d WHERE d.p = r.p AND r.p <> '') AS up,
    (SELECT count(*) FROM docs_ d WHERE d.k = r.k AND r.k <> '') AS nk, (SELECT min(document_uuid) FROM docs_ d WHERE d.k = r.k AND r.k <> '') AS uk
  FROM keyed r),
judged AS (
  SELECT *, CASE WHEN np = 1 THEN 'prefix' WHEN np > 1 THEN 'ambiguous' WHEN nk = 1 THEN 'normalized' WHEN nk > 1 THEN 'ambiguous' ELSE 'none' END AS strategy,
    CASE WHEN np = 1 THEN up WHEN np = 0 AND nk = 1 THEN uk END AS document_uuid
  FROM counted),
hits AS (SELECT * FROM judged WHERE document_uuid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_uuid ORDER BY row_no DESC) = 1)"""

RAW = r"""raw_ AS (
  SELECT doc_id, 'c' || doc_id AS chunk_uuid, (unnest(range(len(w))))::INT AS pos, unnest(w) AS text FROM (
    SELECT doc_id, list_transform(list_filter(string_split(coalesce(text, ''), ' '), lambda x: regexp_matches(x, '^[A-Z][a-z]{3,}[.,]?$')),
      lambda x: CASE WHEN doc_id % 5 = 0 THEN upper(rtrim(x, '.,')) ELSE rtrim(x, '.,') END) AS w
    FROM documents WHERE doc_id % 17 <> 3)),
typed AS (SELECT *, CASE length(text) % 3 WHEN 0 THEN 'PERSON' WHEN 1 THEN 'PLACE' ELSE 'OTHER' END AS entity_type, lower(text) AS normalized_text FROM raw_)"""
CANONICAL = f"""surfaces AS (SELECT entity_type, normalized_text, text, count(*) AS n, min(printf('%09d %09d', doc_id, pos)) AS first_ FROM typed GROUP BY ALL),
splits AS (SELECT *, (row_number() OVER (PARTITION BY entity_type, normalized_text ORDER BY first_) - 1)::INT AS cluster_ord, count(*) OVER (PARTITION BY entity_type, normalized_text) AS of_ FROM surfaces),
canon AS (SELECT {u5(f"'{PROJECT}'", "'entity::' || entity_type || '::' || normalized_text")} AS canonical_id, * FROM splits)"""


def nearest(name: str, k: int, least: float) -> str:
    return f"""{name} AS (
  SELECT src, dst, score FROM (
    SELECT a.vec_id AS src, b.vec_id AS dst, list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS score
    FROM v_ a, v_ b QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY round(score, 9) DESC, b.vec_id) <= {k})
  WHERE src <> dst AND score >= {least})"""


VECTORS = "v_ AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
PLANTED = "v_ AS (SELECT a.vec_id, list_transform(list_zip(h.embedding, a.embedding), lambda x: x[1]::DOUBLE + 0.3::DOUBLE * x[2]::DOUBLE) AS v FROM embeddings a JOIN embeddings h ON h.vec_id = a.vec_id - a.vec_id % 5)"

MARKOV = """c_ AS (SELECT *, lag(chunk_uuid) OVER w AS prev, lead(chunk_uuid) OVER w AS next FROM chunks WINDOW w AS (PARTITION BY document_uuid ORDER BY chunk_index, chunk_uuid)),
top6 AS (
  SELECT chunk_uuid, list(e ORDER BY k) AS es FROM (
    SELECT chunk_uuid, row_number() OVER (PARTITION BY chunk_uuid ORDER BY mention_count DESC, canonical_id::VARCHAR) AS k, {'id': canonical_id::VARCHAR, 'text': canonical_text, 'n': mention_count} AS e
    FROM mentions JOIN ents USING (canonical_id) QUALIFY k <= 6) GROUP BY chunk_uuid),
near_ AS (
  SELECT c_.chunk_uuid::VARCHAR AS chunk_uuid, prev, next, coalesce(es, []) AS es,
    list_concat(list_filter([CASE WHEN c_name IS NOT NULL THEN '{"t": "doc", "id": "' || substr(document_uuid::VARCHAR, 1, 12) || '", "l": "' || substr(c_name, 1, 30) || '", "r": 0.9, "rel": "HAS_CHUNK"}' END,
      '{"t": "chunk", "id": "' || prev || '", "l": "prev", "r": 0.6, "rel": "PREV"}', '{"t": "chunk", "id": "' || next || '", "l": "next", "r": 0.6, "rel": "NEXT"}'], lambda x: x IS NOT NULL),
      list_transform(coalesce(es, []), lambda e: '{"t": "entity", "id": "' || substr(e.id, 1, 12) || '", "l": "' || substr(e.text, 1, 30) || '", "r": ' ||
        regexp_replace(printf('%.2f', least(1.0, 0.3 + e.n / 50.0)::DOUBLE), '0$', '') || ', "rel": "MENTIONED_IN"}')) AS items
  FROM c_ LEFT JOIN customer ON c_custkey = document_uuid LEFT JOIN top6 USING (chunk_uuid))"""

CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i))"


def crc32(text: str, table: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, by CRC_TABLE as a column."""
    data = f"list_transform(range(0, strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce({data}, lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1]), 4294967295))"


FILES = "files_ AS (SELECT doc_id, printf('%s/%d.txt', source, doc_id) AS path, sha256(text) AS hash FROM documents)"


def run_row(table: str, seconds: float) -> str:
    ok = "status IN ('staged', 'loaded')"
    chunks = f"coalesce(sum(chunk_count) FILTER ({ok}), 0)::BIGINT"
    per = (lambda n: f"{n} / {seconds}") if seconds else (lambda n: "0.0::DOUBLE")
    states = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}_documents" for s in ("pending", "staged", "loaded", "failed"))
    return f"SELECT {states}, {chunks} AS chunks, count(*) FILTER ({ok}) AS documents, {per(f'count(*) FILTER ({ok})')} AS docs_per_second, {per(chunks)} AS chunks_per_second FROM {table}"


def oracle_sql() -> dict[str, str]:
    no_uuid = str(uuid.uuid5(uuid.UUID(DNS), "no uuid"))
    w = "WITH "
    selection = lambda where, tail: f"(SELECT document_uuid, title, status FROM (SELECT * FROM old_m {where} ORDER BY coalesce(nullif(title, ''), document_uuid), document_uuid {tail}) WHERE status <> 'loaded')"
    return {
        "document_maxima": w + GRAPH + """ SELECT c_custkey AS document_uuid, coalesce(max(page_number), 0)::INT AS page_count_detected, count(chunk_uuid) AS chunk_count
            FROM customer LEFT JOIN chunks ON document_uuid = c_custkey GROUP BY c_custkey""",
        "load_stats": w + GRAPH + """, per AS (SELECT c_custkey, count(chunk_uuid) AS n FROM customer LEFT JOIN chunks ON document_uuid = c_custkey GROUP BY c_custkey)
            SELECT count(*) AS documents, sum(n)::BIGINT AS chunks, count(*) AS has_document, sum(n)::BIGINT AS has_chunk, sum(greatest(n - 1, 0))::BIGINT AS next_chunk FROM per""",
        "mention_endpoints": w + GRAPH + """ SELECT * FROM mentions WHERE canonical_id IN (SELECT canonical_id FROM ents WHERE mention_count >= 25)
            AND chunk_uuid IN (SELECT chunk_uuid FROM chunks WHERE exhibit_name <> '')""",
        "entity_chunk_lists": w + GRAPH + " SELECT canonical_id, string_agg(chunk_uuid::VARCHAR, ',' ORDER BY chunk_uuid) AS chunk_ids FROM mentions GROUP BY canonical_id",
        "entities_flat": """SELECT 'c' || doc_id AS chunk_uuid, CASE WHEN doc_id % 17 = 3 THEN '' ELSE
            array_to_string(list_transform(w, lambda x: CASE length(x) % 3 WHEN 0 THEN 'person' WHEN 1 THEN 'PLACE' ELSE 'OTHER' END || '::' || CASE WHEN doc_id % 5 = 0 THEN upper(x) ELSE x END), '|') END AS entities_flat
            FROM (SELECT doc_id, list_transform(list_filter(string_split(coalesce(text, ''), ' '), lambda x: regexp_matches(x, '^[A-Z][a-z]{3,}[.,]?$')), lambda x: rtrim(x, '.,')) AS w FROM documents)""",
        "relevance_texts": "SELECT doc_id, CASE WHEN quality = 1 THEN 'Relevant: good' ELSE 'Unknown: toxic' END AS relevance_analysis FROM labels WHERE quality = 1 OR toxic = 1",
        "plain_markdown": "SELECT printf('conv_%d.md', conv_id) AS title, string_agg(coalesce(text, '') || chr(10) || chr(10), '' ORDER BY turn) AS content FROM conversations GROUP BY conv_id",
        "range_markdown": """SELECT printf('conv_%d.pdf', conv_id) AS title, printf('# OCR Output for conv_%d.pdf', conv_id) || chr(10) || chr(10) || string_agg(CASE WHEN turn % 4 <> 2 AND text <> ''
            THEN text || chr(10) || chr(10) || '---' || chr(10) || chr(10) ELSE chr(10) || printf('[OCR Failed for Pages %d-%d]', (turn * 10 + 1)::INT, (turn * 10 + 10)::INT) || chr(10) || chr(10) END, '' ORDER BY turn) AS content
            FROM conversations GROUP BY conv_id""",
        "uuid5_documents": w + TITLED + f" SELECT doc_id, {u5(f"'{CASES}'", "'demo case'")} AS project_uuid, document_uuid, {u5(f"'{no_uuid}'", 'title')} AS named_uuid FROM titled",
        "doc_prefix_keys": w + TITLED + f" SELECT doc_id, {prefix('title')} AS doc_prefix, {base('title')} AS organized_basename FROM titled",
        "normalized_title_keys": w + TITLED + f" SELECT doc_id, {key('title')} AS normalized_title_key FROM titled",
        "ocr_markdown": f"""SELECT printf('conv_%d.md', conv_id) AS title, printf('# OCR Output for conv_%d.pdf', conv_id) || chr(10) || chr(10) ||
            {STRIP % "string_agg('Page ' || (turn + 1) || ' of ' || n || chr(10) || chr(10) || t || chr(10), chr(10) ORDER BY turn)"} || chr(10) AS content
            FROM (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n, {STRIP % "coalesce(text, '')"} AS t FROM conversations) GROUP BY conv_id""",
        "page_split": w + PAGES + " SELECT title, page_ord, page_number, coalesce(total_pages, 0) AS total_pages, text FROM pages_",
        "page_offsets": w + PAGES + " SELECT title, page_number, page_offset FROM placed",
        "first_pages": w + PAGES + " SELECT title, page_number FROM pages_ WHERE page_ord < 3",
        "chunk_spans": "WITH RECURSIVE " + TITLED + ", " + SPANS + " SELECT doc_id, chunk_index, char_start, char_end FROM spans",
        "chunk_ids": "WITH RECURSIVE " + TITLED + ", " + SPANS + f", named AS (SELECT *, {u5(f"'{PROJECT}'", "'document::' || title")} AS document_uuid FROM spans) SELECT doc_id, chunk_index, {u5('document_uuid', "char_start || ':' || char_end")} AS chunk_uuid, md5(substr(t, (char_start + 1)::INT, (char_end - char_start)::INT)) AS text_md5 FROM named",
        "next_chunk": w + GRAPH + " SELECT * FROM (SELECT chunk_uuid AS src, lead(chunk_uuid) OVER (PARTITION BY document_uuid ORDER BY chunk_index) AS dst FROM chunks) WHERE dst IS NOT NULL",
        "doc_metadata": w + PAGES + " SELECT title, max(page_number) AS page_count_detected, count(*) AS n_pages, max(page_offset + length(text)) AS n_chars FROM placed GROUP BY title",
        "manifest_merge": w + ", ".join((TITLED, OLD, NEW, MERGED)) + " SELECT * FROM merged",
        "resume_pending": w + ", ".join((TITLED, OLD)) + " SELECT doc_id FROM titled t WHERE NOT (doc_id % 2 = 0 AND EXISTS (SELECT 1 FROM old_m m WHERE m.document_uuid = t.document_uuid AND m.status IN ('staged', 'loaded')))",
        "load_selection": w + ", ".join((TITLED, OLD)) + " " + selection("WHERE upper(regexp_extract(title, '(?i)(DOC_\\d{4})', 1)) = 'DOC_0'", "") + " UNION ALL " + selection("", "LIMIT 40 OFFSET 5"),
        "analysis_join": w + ", ".join((TITLED, REVIEW)) + " SELECT document_uuid, file_type, file_description, relevance_analysis, original_file_path, organized_doc_number, " + STRIP % "(file_description || chr(10) || chr(10) || relevance_analysis)" + " AS summary_text, true AS analysis_ingested, strategy AS analysis_join_strategy, CASE strategy WHEN 'prefix' THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END AS analysis_join_confidence FROM hits",
        "analysis_join_report_counts": w + ", ".join((TITLED, REVIEW)) + " SELECT count(DISTINCT document_uuid) AS updated_documents, count(document_uuid) AS matched_rows, count(*) FILTER (strategy = 'none') AS unmatched_rows, count(*) FILTER (strategy = 'ambiguous') AS ambiguous_rows FROM judged",
        "analysis_examples": w + ", ".join((TITLED, REVIEW)) + " (SELECT row_no, organized_doc_number, 'unmatched' AS kind FROM judged WHERE strategy = 'none' ORDER BY row_no LIMIT 25) UNION ALL (SELECT row_no, organized_doc_number, 'ambiguous' AS kind FROM judged WHERE strategy = 'ambiguous' ORDER BY row_no LIMIT 25)",
        "analysis_coverage": w + ", ".join((TITLED, REVIEW)) + " SELECT (SELECT count(*) FROM docs_) AS total_documents, (SELECT count(*) FROM hits) AS with_analysis, 0::BIGINT AS ambiguous_documents",
        "analysis_unmatched_docs": w + ", ".join((TITLED, REVIEW)) + " SELECT p AS doc_prefix, title, document_uuid FROM docs_ WHERE document_uuid NOT IN (SELECT document_uuid FROM hits) ORDER BY p, title NULLS LAST, document_uuid LIMIT 50",
        "key_backfill": w + TITLED + f", s AS (SELECT doc_id, CASE WHEN doc_id % 4 <> 1 THEN title ELSE '' END AS title, title AS file, CASE doc_id % 3 WHEN 1 THEN '  ' WHEN 2 THEN 'DOC_9999 ' END AS p, CASE WHEN doc_id % 5 = 0 THEN 'stored key' END AS k FROM titled), f AS (SELECT *, coalesce(nullif(trim(coalesce(p, '')), ''), nullif({prefix('title')}, ''), {prefix('file')}) AS np, coalesce(k, nullif({key('title')}, ''), {key('file')}) AS nk FROM s) SELECT doc_id, np AS doc_prefix, nk AS normalized_title_key, (p IS DISTINCT FROM np OR k IS DISTINCT FROM nk) AS keys_changed FROM f",
        "raw_entities": w + RAW + " SELECT chunk_uuid, pos, entity_type, text FROM typed",
        "canonical_entities": w + RAW + ", " + CANONICAL + " SELECT canonical_id, entity_type, normalized_text, cluster_ord, text AS canonical_text, text AS variants, n AS mention_count FROM canon WHERE cluster_ord = of_ - 1",
        "canonical_absorbed": w + RAW.replace("ELSE rtrim(x, '.,') END", "WHEN doc_id % 5 = 1 THEN substr(rtrim(x, '.,'), 1, length(rtrim(x, '.,')) - 1) || upper(right(rtrim(x, '.,'), 1)) ELSE rtrim(x, '.,') END")
        + f""", surfaces AS (SELECT entity_type, normalized_text, text, count(*) AS n, min(printf('%09d %09d', doc_id, pos)) AS first_ FROM typed GROUP BY ALL),
            joined AS (SELECT *, CASE WHEN text = upper(text) THEN 'capitals' WHEN 1 - 1 / length(text) >= CASE WHEN entity_type = 'OTHER' THEN 0.9 ELSE 0.85 END THEN 'near' ELSE text END AS part FROM surfaces),
            parts AS (SELECT entity_type, normalized_text, min(first_) AS first_, arg_min(text, (-n, first_)) AS canonical_text, string_agg(text, '|' ORDER BY text) AS variants, sum(n)::BIGINT AS mention_count FROM joined GROUP BY entity_type, normalized_text, part)
            SELECT {u5(f"'{PROJECT}'", "'entity::' || entity_type || '::' || normalized_text")} AS canonical_id, (row_number() OVER (PARTITION BY entity_type, normalized_text ORDER BY first_) - 1)::INT AS cluster_ord, canonical_text, variants, mention_count FROM parts""",
        "canonical_splits": w + RAW + ", " + CANONICAL + " SELECT canonical_id, cluster_ord, text AS canonical_text, n AS mention_count FROM canon",
        "entity_mentions": w + RAW + f" SELECT DISTINCT {u5(f"'{PROJECT}'", "'entity::' || entity_type || '::' || normalized_text")} AS canonical_id, chunk_uuid FROM typed",
        "co_occurs": w + GRAPH + " SELECT a.canonical_id AS src, b.canonical_id AS dst, count(*) AS count FROM mentions a JOIN mentions b ON a.chunk_uuid = b.chunk_uuid AND a.canonical_id < b.canonical_id GROUP BY ALL",
        "shares_entity": w + GRAPH + ", " + shared(3, 5000, 50, 2) + " SELECT * FROM shares",
        "shares_entity_capped": w + GRAPH + ", " + shared(20, 200, 10, 1) + " SELECT * FROM shares",
        "similar_to": w + VECTORS + ", " + nearest("s", 10, 0.25) + " SELECT src, dst, round(score, 6) AS score FROM s",
        "similar_to_default": w + VECTORS + ", " + nearest("s", 10, 0.75) + " SELECT src, dst, round(score, 6) AS score FROM s",
        "similar_planted": w + PLANTED + ", " + nearest("s", 10, 0.75) + " SELECT src, dst, round(score, 6) AS score FROM s",
        "similar_indexed": w + PLANTED + ", " + nearest("s", 10, 0.75) + " SELECT src, dst, round(score, 6) AS score FROM s",
        "similar_to_reset": w + VECTORS + ", " + nearest("o", 4, 0.2) + ", " + nearest("s", 10, 0.3) + " SELECT src, dst, round(score, 6) AS score FROM o WHERE src % 2 = 1 UNION ALL SELECT src, dst, round(score, 6) FROM s WHERE src % 2 = 0",
        "embed_pending": w + TITLED + " SELECT document_uuid, title AS summary_text FROM titled WHERE doc_id % 3 = 1 AND doc_id % 2 = 1 ORDER BY document_uuid LIMIT 200",
        "markov_neighbors": w + GRAPH + ", " + MARKOV + " SELECT chunk_uuid, '[' || array_to_string(items[1:8], ', ') || ']' AS neighbor_summary, '1.0' AS markov_version FROM near_",
        "markov_hints": w + GRAPH + ", " + MARKOV + """ SELECT chunk_uuid, '[' || array_to_string(list_filter([CASE WHEN len(es) > 0 THEN '{"type": "explore_entity", "desc": "Explore entity ' || substr(es[1].text, 1, 30) || '", "id": "' || substr(es[1].id, 1, 12) || '"}' END,
            '{"type": "continue", "desc": "Continue to next chunk", "id": "' || next || '"}'], lambda x: x IS NOT NULL), ', ') || ']' AS traversal_hints, true AS context_enriched FROM near_""",
        "edge_summary": w + GRAPH + ", " + MARKOV + """ SELECT chunk_uuid, '[{"type": "NEXT_CHUNK", "n": ' || ((prev IS NOT NULL)::INT + (next IS NOT NULL)::INT) || '}, {"type": "MENTIONED_IN", "n": ' || len(es) || '}]' AS edge_summary FROM near_""",
        "file_dedup": w + FILES + " SELECT hash, min(path) AS path, count(*) AS copies FROM files_ GROUP BY hash",
        "copy_plan": w + FILES + ", d AS (SELECT hash, min(path) AS path FROM files_ GROUP BY hash), n AS (SELECT *, row_number() OVER (ORDER BY hash) AS number FROM d) SELECT path AS src, printf('DOC_%04d_%s', number, regexp_extract(path, '([^/]*)$', 1)) AS dst, number FROM n",
        "file_renumber": w + TITLED + " SELECT title AS old, printf('DOC_%04d_%s', row_number() OVER (ORDER BY title), regexp_replace(title, '^DOC_\\d+_', '')) AS new FROM titled",
        "file_walk": "SELECT printf('%s/%s/%s%d.pdf', ['case', 'organized', '.git', 'case/ai_docs'][doc_id % 4 + 1], source, CASE WHEN doc_id % 7 = 0 THEN '.' ELSE '' END, doc_id) AS path FROM documents WHERE doc_id % 4 = 0 AND doc_id % 7 <> 0",
        "inventory_origins": w + TITLED + " SELECT title AS name, CASE WHEN doc_id % 3 = 0 THEN source ELSE 'Unknown' END AS original_path FROM titled",
        "rename_propagation": w + TITLED + " SELECT 'new ' || title AS name, doc_id FROM titled WHERE doc_id % 3 = 1",
        "to_analyse": w + TITLED + " SELECT regexp_replace(title, '\\.md$', '') || ['.pdf', '.DOCX', '.png'][doc_id % 3 + 1] AS name, doc_id FROM titled WHERE doc_id % 2 = 0 AND doc_id % 3 <> 2 AND doc_id % 8 <> 0 AND doc_id NOT BETWEEN 10 AND 10",
        "large_files": w + TITLED + " SELECT regexp_replace(title, '\\.md$', '.PDF') AS name, (doc_id % 90)::INT AS n_pages FROM titled WHERE doc_id % 2 = 0 AND doc_id % 90 > 30",
        "bates_labels": w + TITLED + """, p AS (SELECT title AS name, unnest(range(1, doc_id % 4 + 1))::INT AS page FROM titled) SELECT name, page,
            upper(CASE WHEN regexp_matches(name, '^DOC_\\d+') THEN regexp_extract(name, '^DOC_\\d+') WHEN len(string_split(name, '_')) >= 2 THEN array_to_string(string_split(name, '_')[1:2], '_') ELSE name END || printf('-%03d', page)) AS label FROM p""",
        "ocr_page_ranges": w + TITLED + ", r AS (SELECT title, (doc_id % 90)::INT AS n, unnest(range(0, doc_id % 90, 25))::INT AS s FROM titled) SELECT title, s // 25 AS range_ord, s AS start, least(s + 25, n) AS \"end\" FROM r",
        "pdf_page_counts": "SELECT doc_id, n AS pages, ((n + 2) // 3)::BIGINT AS ranges, n::BIGINT AS asked FROM (SELECT doc_id, greatest(1, (length(coalesce(text, '')) + 1999) // 2000)::INT AS n FROM documents)",
        # The words of "copy of " sort in between those of the title, so the title is a common subsequence whole.
        "fuzzy_ratio": w + TITLED + " SELECT doc_id, round(200.0 * length(title) / (2 * length(title) + length('copy of ')), 6)::DOUBLE AS ratio FROM titled",
        "embed_documents": w + TITLED + f""", crc AS (SELECT {CRC_TABLE} AS t),
            words AS (SELECT document_uuid, unnest(list_filter(string_split(lower(title), ' '), lambda x: x <> '')) AS w FROM titled),
            hashed AS (SELECT document_uuid, {crc32("w", "t")} AS h FROM words, crc),
            places AS (SELECT document_uuid, sum(CASE WHEN (h >> 16) & 1 = 1 THEN 1 ELSE -1 END) AS v FROM hashed GROUP BY document_uuid, h % 64)
            SELECT document_uuid, round(sum(v * v)::DOUBLE / greatest(sum(v * v), 1), 4) AS norm FROM places GROUP BY document_uuid""",
        "graph_integrity": w + GRAPH + """ SELECT c_custkey AS document_uuid, count(chunk_uuid) AS chunk_count, count(DISTINCT chunk_index) AS indexes, count(*) FILTER (exhibit_name = '') AS without_exhibit, coalesce(max(page_number), 0) AS page_count_detected,
            coalesce(array_to_string(list_sort(list(DISTINCT chunk_index) FILTER (chunk_index IS NOT NULL))[1:20], ','), '') AS first_indexes, greatest(count(chunk_uuid) - 1, 0) AS next_edges FROM customer LEFT JOIN chunks ON document_uuid = c_custkey GROUP BY c_custkey""",
        "has_chunk": "SELECT DISTINCT o_custkey AS src, o_orderkey AS dst FROM orders",
        "duplicate_keys": "SELECT l_orderkey, l_partkey, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
        "seq_path": "WITH RECURSIVE " + GRAPH + """, e AS (SELECT chunk_uuid AS src, lead(chunk_uuid) OVER (PARTITION BY document_uuid ORDER BY chunk_index) AS dst FROM chunks),
            walk AS (SELECT document_uuid, 0 AS length, chunk_uuid AS cur, chunk_uuid::VARCHAR AS path FROM chunks WHERE chunk_index = 0
              UNION ALL SELECT document_uuid, length + 1, dst, path || '>' || dst FROM walk JOIN e ON src = cur AND dst IS NOT NULL WHERE length < 10)
            SELECT document_uuid, length, cur::VARCHAR AS end_uuid, path FROM walk""",
        "seq_path_branches": "WITH RECURSIVE " + GRAPH + """, n AS (SELECT * FROM (SELECT chunk_uuid AS src, lead(chunk_uuid) OVER (PARTITION BY document_uuid ORDER BY chunk_index) AS dst FROM chunks) WHERE dst IS NOT NULL),
            e AS (SELECT src, dst FROM n WHERE src % 13 <> 0 UNION SELECT a.src, b.dst FROM n a JOIN n b ON a.dst = b.src WHERE a.src % 7 = 0 UNION SELECT dst, src FROM n WHERE src % 11 = 0),
            walk AS (SELECT document_uuid, 0 AS length, chunk_uuid AS cur, chunk_uuid::VARCHAR AS path, []::VARCHAR[] AS used FROM chunks WHERE chunk_index = 0
              UNION ALL SELECT document_uuid, length + 1, dst, path || '>' || dst, list_append(used, src || '>' || dst) FROM walk JOIN e ON src = cur WHERE length < 6 AND NOT list_contains(used, src || '>' || dst))
            SELECT document_uuid, length, cur::VARCHAR AS end_uuid, path FROM walk""",
        "related_docs": w + GRAPH + ", " + shared(3, 5000, 50, 2) + " SELECT src, dst, count, row_number() OVER (PARTITION BY src ORDER BY count DESC, dst)::INT AS rank FROM shares WHERE count >= 3",
        "exhibit_chunks": w + GRAPH + " SELECT document_uuid, chunk_index, chunk_uuid, page_number FROM chunks WHERE exhibit_name = 'O'",
        "run_rates": w + ", ".join((TITLED, OLD, NEW)) + " " + run_row("old_m", 12.5) + " UNION ALL " + run_row("new_m", 0),
        "failed_documents": w + ", ".join((TITLED, OLD, NEW, MERGED)) + " SELECT title, error FROM merged WHERE status = 'failed' ORDER BY title, document_uuid LIMIT 50",
        "upsert_document": w + TITLED + """, o AS (SELECT document_uuid, title, '2024' AS created_at, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang, source FROM titled WHERE doc_id % 3 <> 0),
            n AS (SELECT document_uuid, upper(title) AS title, '2025' AS created_at, CASE WHEN doc_id % 4 = 0 THEN lang END AS lang, doc_id::VARCHAR AS rank FROM titled WHERE doc_id % 2 = 0)
            SELECT document_uuid, coalesce(n.title, o.title) AS title, coalesce(o.created_at, n.created_at) AS created_at, coalesce(n.lang, o.lang) AS lang, o.source AS source, n.rank AS rank FROM o FULL JOIN n USING (document_uuid)""",
        "inventory_recover": w + FILES + ", s AS (SELECT hash, max(path) AS path FROM files_ WHERE doc_id % 3 <> 0 GROUP BY hash) SELECT 'DOC_' || doc_id AS new_filename, coalesce(s.path, 'Unknown (Hash not found in source)') AS original_path FROM files_ f LEFT JOIN s USING (hash)",
    }
