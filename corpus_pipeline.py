"""The corpus pipeline: quality rules, line dedup, near-dedup, source mixing, packing; each stage on all that the one before kept.

Every stage but the last returns the columns of documents (doc_id, text, lang, source, n_chars); the last returns the pieces of packed
sequences. Null texts count as empty; an empty table gives an empty result. Mixing repeats rows of small sources, so the last stage may
see a doc_id more than once and packs each row as a document of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import read, written
from graphloom.llm.line_dedup import line_dedup
from graphloom.llm.mixing import temperature_mix
from graphloom.llm.near_dedup import near_dedup
from graphloom.llm.packing import pack_documents
from graphloom.llm.quality_rules import quality_rules
from graphloom.llm.queries import MAX_REPEATS, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs.select(*COLUMNS), read(spark, sf_dir, "labels")).where("kept").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that several share; n_chars follows the text."""
    out = line_dedup(docs.select(*COLUMNS))
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the least doc_id."""
    return near_dedup(docs.select(*COLUMNS), words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least, those of small sources up to MAX_REPEATS times."""
    return temperature_mix(docs.select(*COLUMNS), max_repeats=MAX_REPEATS).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return pack_documents(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't express the classifier or the packing; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
