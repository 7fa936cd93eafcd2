"""The operators' queries over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.best_fit import best_fit_packing
from graphloom.llm.common import read
from graphloom.llm.fingerprints import fingerprint_stability
from graphloom.llm.html_wrappers import extract_main_text
from graphloom.llm.lexical_search import lexical_search
from graphloom.llm.line_dedup import line_dedup
from graphloom.llm.mixing import temperature_mix
from graphloom.llm.near_dedup import near_components
from graphloom.llm.packing import pack_documents
from graphloom.llm.pii import personal_spans
from graphloom.llm.quality_classifier import folds, quality_classifier
from graphloom.llm.quality_rules import quality_rules
from graphloom.llm.spelling import spelling_variants
from graphloom.llm.toxicity import toxicity

MAX_REPEATS = 2.0


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_stability(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = personal_spans(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_term", "n_spans")


def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return temperature_mix(docs, max_repeats=MAX_REPEATS).select("doc_id", "source", "epoch", "block", "n_tokens", "mix_key")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_classifier(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"), learn=folds(5) != 0)
    return out.select("doc_id", (folds(5) == 0).alias("held_out"), "score", "predicted")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(read(spark, sf_dir, "documents").select("doc_id", "text"), words=2, percent=80)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"), learn=folds(4) != 2)
    return out.select("doc_id", (folds(4) == 2).alias("held_out"), "score", "predicted")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=7, min_count=2, slip=31, factor=10)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark").select("item_id", "text"), k=20)


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"), size=2048, end_id=0)


QUERIES = (
    op1_fingerprints, op2_personal_data, op3_temperature_mix, op4_html_extraction, op5_quality_rules, op6_quality_classifier, op7_near_dedup, op8_line_dedup, op9_toxicity, op10_packing,
    op11_spelling_variants, op12_lexical_search, op13_best_fit_packing,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


OP3_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens, md5('17:' || doc_id) AS h
  FROM documents),
per AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS n_docs FROM base GROUP BY source),
stat AS (SELECT sum(tokens)::DOUBLE AS total, min(tokens)::DOUBLE AS lo, max(tokens)::DOUBLE AS hi FROM per WHERE tokens > 0),
expo AS (SELECT *, CASE WHEN lo = hi THEN 0.0 ELSE greatest(0.0, round(1 - ln(2.0) / ln(hi / lo), 9)) END AS a FROM stat),
weights AS (
  SELECT source, tokens, n_docs, ceil(n_docs / 256.0)::BIGINT AS n_blocks,
    CASE WHEN tokens > 0 THEN round(tokens * pow(tokens / total, a - 1) / pow(hi / total, a - 1), 0)::BIGINT ELSE 0 END AS budget
  FROM per, expo),
w AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS full_, budget - (CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END) * tokens AS left_ FROM weights),
dealt AS (SELECT b.*, ('0x' || substr(h, 1, 8))::BIGINT % n_blocks AS block FROM base b JOIN w USING (source)),
blocks AS (SELECT source, block, sum(n_tokens)::BIGINT AS tokens FROM dealt GROUP BY ALL),
passes AS (
  SELECT k.source, k.block, k.tokens, full_, left_, budget, unnest(range(0, full_ + (left_ > 0)::INT)) AS epoch
  FROM blocks k JOIN w USING (source)),
ranked AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source, epoch ORDER BY md5('17:' || source || ':' || block || ':' || epoch), block ROWS UNBOUNDED PRECEDING) AS after_
  FROM passes),
chosen AS (
  SELECT source, block, epoch, CASE WHEN epoch < full_ OR after_ <= left_ THEN NULL ELSE left_ - (after_ - tokens) END AS room,
    round(CASE WHEN budget > 0 THEN (epoch * (greatest(budget - left_, 0) / greatest(full_, 1)) + after_ - tokens) / budget ELSE 0 END, 9) AS mix_key
  FROM ranked WHERE epoch < full_ OR after_ <= left_ OR left_ - (after_ - tokens) > 0),
drawn AS (
  SELECT d.*, epoch, room, mix_key, sum(n_tokens) OVER (PARTITION BY source, block, epoch ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS n
  FROM dealt d JOIN chosen USING (source, block))
SELECT doc_id, source, epoch::BIGINT AS epoch, block::BIGINT AS block, n_tokens::BIGINT AS n_tokens, mix_key::DOUBLE AS mix_key
FROM drawn WHERE room IS NULL OR (n <= room AND n_tokens > 0)
"""

OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
common AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT doc_id, pos, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS s FROM words),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT doc_id, b FROM reached JOIN links ON a = r)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(r)::BIGINT AS component_id, doc_id = min(r) AS kept FROM sets JOIN reached USING (doc_id) GROUP BY doc_id, s
"""


OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
each AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || w AS s, w, count(*) AS n FROM runs WHERE length(w) >= 7 GROUP BY ALL),
hashed AS (
  SELECT w, n, xor(4294967295, list_reduce(list_transform(range(0, strlen(s)), lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS h FROM each, crc),
slipped AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT c.word AS a, w.word AS b FROM cuts c JOIN words w ON w.word = c.rest),
links AS (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter),
best AS (SELECT a AS word, count(*) AS n_near, min({'less': -w.n, 'near': b}) AS top FROM links JOIN words w ON w.word = b GROUP BY a),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.less >= 10 * n THEN top.near END AS form, CASE WHEN -top.less >= 10 * n THEN -top.less END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, 0 AS step FROM words UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT word, form, arg_max(root, step) AS root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM formed JOIN chain USING (word) GROUP BY word, form, n, n_near, form_n
"""

OP12_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
stat AS (SELECT count(*)::BIGINT AS texts, sum(len(w))::BIGINT AS total FROM words WHERE len(w) > 0),
asked AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
held AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM words) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(texts) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, stat GROUP BY term),
counted AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * texts) // total))) AS s FROM held JOIN weight USING (term), stat),
scored AS (SELECT item_id, doc_id, r, sum(q * s)::BIGINT AS score FROM counted JOIN asked USING (term) GROUP BY item_id, doc_id, r),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_temperature_mix": OP3_SQL, "op7_near_dedup": OP7_SQL, "op8_line_dedup": OP8_SQL, "op11_spelling_variants": OP11_SQL, "op12_lexical_search": OP12_SQL}
