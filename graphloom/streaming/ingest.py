"""Continuous ingest: new Markdown files become staged chunks, batch by batch, exactly once a file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from graphloom.functions.ids import document_id
from graphloom.functions.text import utf8
from graphloom.operators.chunks import chunk_pages
from graphloom.operators.pages import page_offsets, split_pages
from graphloom.plans.verbs import Case, ingest
from graphloom.sources.providers import Chunker, local_chunker

FILES = "path string, modificationTime timestamp, length long, content binary"


def chunk_markdown(docs: DataFrame, project: str, target: int = 1200) -> DataFrame:
    """Chunks of docs(title, content): pages, offsets, spans and ids."""
    pages = page_offsets(split_pages(docs)).withColumn("document_uuid", document_id(F.lit(project), F.col("title")))
    return chunk_pages(pages, target)


def _documents(spark: SparkSession, path: str, files_a_batch: int | None = None) -> DataFrame:
    """(path, title, content) of the Markdown files of a folder as a stream."""
    reader = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.md")
    files = (reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader).load(path)
    return files.select("path", F.regexp_extract("path", r"([^/]*)\z", 1).alias("title"), utf8(F.col("content")).alias("content"))


def start_case(spark: SparkSession, case: Case, checkpoint: str, make: Callable[[], Chunker] = local_chunker, files_a_batch: int = 1000) -> StreamingQuery:
    """The verb ingest over the files that have come since the last run, so many at a time; ends when there are none left.

    A batch is noted in the manifest before the stream forgets its files. One that broke off comes again, and documents that it had
    staged already are skipped, so every file is staged once.
    """

    def stage(batch: DataFrame, number: int) -> None:
        ingest(batch.sparkSession, case, batch, make)

    return _documents(spark, case.inputs("organized/ocr"), files_a_batch).writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start(spark: SparkSession, path: str, out: str, checkpoint: str, project: str, target: int = 1200) -> StreamingQuery:
    """Every batch of new files is chunked and appended under its batch number, so that a batch repeated after a failure
    replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        chunk_markdown(batch, project, target).write.mode("overwrite").parquet(f"{out}/batch={number}")

    docs = _documents(spark, path).select("title", "content")
    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
