"""Line dedup: explode normalised lines, hash, count documents per hash, drop common lines, reassemble by position."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import cut, id_of, pack, text_of, unpack

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line stripped of blanks at both ends, with A-Z (only) lower-cased."""
    return F.translate(F.trim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop lines that many documents share; JVM expressions only.

    Adds kept_text (string), n_lines and n_dropped (long) to every row of docs, other columns unchanged (one of the same
    name is replaced). A line whose key
    has at least min_chars code points and occurs in at least min_docs distinct doc_ids stays only in the largest
    of these. Null or empty texts are one empty line. Repeated rows of one doc_id count as one document and
    each is treated alike; a null doc_id is one document below all others. An empty table gives an empty one.

    Lines travel as two 64-bit hashes with (document, text hash, position), never as text. Counting combines on
    the map side; a line of a third of all documents is one aggregated row, and its occurrences meet that row in a
    sort-merge join whose hot partitions adaptive execution splits. Texts are shuffled once, for the last join. Work in a
    document is linear in its lines: the sorted positions of dropped lines become one mask, met line by line.
    """
    base = pack(docs, _d=id_of(), _t=F.xxhash64(text_of()), _text=text_of()).withColumn("_lines", F.split("_text", "\n", -1))
    lines = base.select("_d", "_t", F.posexplode("_lines").alias("_pos", "_line")).select("_d", "_t", "_pos", line_key(F.col("_line")).alias("_key"))
    lines = lines.where(F.length("_key") >= min_chars).select("_d", "_t", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit("line"), "_key").alias("_h2"))
    common = lines.groupBy("_h1", "_h2", "_d").agg(F.lit(1).alias("_one")).groupBy("_h1", "_h2").agg(F.count("*").alias("_docs"), F.max("_d").alias("_last"))
    common = cut(common.where(F.col("_docs") >= min_docs).select("_h1", "_h2", "_last"))
    gone = lines.join(common, ["_h1", "_h2"]).where(F.col("_d") != F.col("_last")).groupBy("_d", "_t").agg(F.array_sort(F.collect_set("_pos")).alias("_gone"))
    before = lambda i: F.coalesce(F.get("_gone", i - 1), F.lit(-1))
    runs = F.transform("_gone", lambda g, i: F.concat(F.array_repeat(F.lit(True), g - before(i) - 1), F.array(F.lit(False))))
    stays = F.zip_with("_lines", F.flatten(runs), lambda line, kept: F.when(F.coalesce(kept, F.lit(True)), line))  # concat_ws passes over nulls
    return unpack(
        base.join(gone, ["_d", "_t"], "left"),
        docs.columns,
        kept_text=F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.concat_ws("\n", stays)),
        n_lines=F.size("_lines").cast("long"),
        n_dropped=F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone")).cast("long"),
    )
