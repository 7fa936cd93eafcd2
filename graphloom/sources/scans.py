"""Scans: OCR Markdown, PDFs, CSV tables, manifests, staging tables, plain and office text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import printable_runs, strip, utf8

# Column names of the tables as files have them, and ours.
ANALYSIS = {"Original File Path": "original_file_path", "Organized Doc Number": "organized_doc_number", "File Type": "file_type", "File Description": "file_description", "Relevance Analysis": "relevance_analysis"}
INVENTORY = {"New Filename": "new_filename", "Original Path": "original_path", "Summary": "summary"}
CHUNK = (
    "tenant_uuid string, project_uuid string, document_uuid string, chunk_uuid string, id string, exhibit_name string, chunk_index int, page_number int, char_start long, char_end long, text string, "
    "clean_text string, entities_json string, entities_flat array<string>, source_file string, source_file_path string, ocr_markdown_path string"
)
DOCUMENT = (
    "tenant_uuid string, project_uuid string, case_name string, document_uuid string, title string, source_file string, exhibit_name string, doc_prefix string, organized_basename string, "
    "normalized_title_key string, ocr_markdown_path string, source_file_path string, page_count_detected int, chunk_count int, staged_at string"
)
MANIFEST_ROW = "document_uuid:string,title:string,source_file:string,ocr_markdown_path:string,source_file_path:string,status:string,error:string,chunk_count:int,page_count_detected:int,started_at:string,completed_at:string,staged_at:string,loaded_at:string"
MANIFEST = f"project_uuid string, generated_at string, documents array<struct<{MANIFEST_ROW}>>"
OCR_RESPONSE = "pages array<struct<markdown:string>>"
ENTITY_PAYLOAD = "chunks array<struct<text:string,entities:array<struct<entity_type:string,text:string>>>>"


def _files(spark: SparkSession, path: str, glob: str, deep: bool = False) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    rows = (reader.option("recursiveFileLookup", "true") if deep else reader).load(path)
    return rows.select("path", F.regexp_extract("path", r"([^/]*)\z", 1).alias("title"), "content", "length")


def named(part: str, ending: str) -> str:
    """A glob of names that hold a part in capitals or small letters and have an ending."""
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isascii() and c.isalpha() else c if c.isascii() and (c.isdigit() or c == "_") else "?" for c in part) + ("*" if part else "") + ending


def markdown(spark: SparkSession, path: str, part: str = "") -> DataFrame:
    """(path, title, content) of the *.md files of a directory, or of those with a part in their names, which alone are listed and opened;
    bytes that are no UTF-8 are dropped."""
    return _files(spark, path, named(part, ".md")).select("path", "title", utf8(F.col("content")).alias("content"))


def pdfs(spark: SparkSession, path: str) -> DataFrame:
    """(path, title, content as bytes, length) of the *.pdf files of a directory."""
    return _files(spark, path, "*.[pP][dD][fF]")


def tree(spark: SparkSession, path: str) -> DataFrame:
    """(path, hash) of all files below a directory; content is hashed where it is read."""
    return _files(spark, path, "*", deep=True).select("path", F.sha2("content", 256).alias("hash"))


def _csv(spark: SparkSession, path: str, names: dict[str, str]) -> DataFrame:
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', enforceSchema=False)
    rows = rows.select(*[strip(F.coalesce(F.col(f"`{n}`"), F.lit(""))).alias(v) for n, v in names.items()])
    return rows.where(" or ".join(f"{v} <> ''" for v in names.values()))


def analysis_csv(spark: SparkSession, path: str) -> DataFrame:
    """Review metadata with row_no in file order; values stripped, missing ones '', empty rows left out."""
    return _csv(spark, path, ANALYSIS).withColumn("row_no", F.monotonically_increasing_id())


def inventory_csv(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, INVENTORY)


def processed_names(spark: SparkSession, path: str) -> DataFrame:
    """(name) of the analysis file's documents."""
    return analysis_csv(spark, path).select(F.col("organized_doc_number").alias("name")).distinct()


def path_list(spark: SparkSession, path: str) -> DataFrame:
    """(path): a relative path a line, blank lines left out."""
    return spark.read.text(path).select(strip(F.col("value")).alias("path")).where("path <> ''")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's rows as they are; see operators.manifest.coerced() for old ones."""
    return spark.read.schema(MANIFEST).json(path, multiLine=True).select("project_uuid", F.inline("documents"))


def staged_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk files of any number of documents, one JSON object each, anywhere below path."""
    return spark.read.schema(CHUNK).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path, multiLine=True)


def staged_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT).option("recursiveFileLookup", "true").option("pathGlobFilter", "document_metadata.json").json(path, multiLine=True)


def plain_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of .txt and .rtf files."""
    return _files(spark, path, "*.{txt,rtf}").select("path", utf8(F.col("content")).alias("text"))


def word_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of old .doc files: their runs of printable characters."""
    return _files(spark, path, "*.doc").select("path", printable_runs(F.col("content")).alias("text"))


def docx_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of .docx files: paragraphs joined by line feeds. A .docx is a zip of XML; broken files give null."""

    @F.pandas_udf("string")
    def paragraphs(contents: pd.Series) -> pd.Series:
        import io
        import zipfile
        from xml.etree import ElementTree

        space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

        def one(content):
            try:
                root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))
            except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                return None
            return "\n".join("".join(t.text or "" for t in p.iter(f"{space}t")) for p in root.iter(f"{space}p"))

        return contents.map(one)

    return _files(spark, path, "*.docx").select("path", paragraphs("content").alias("text"))
