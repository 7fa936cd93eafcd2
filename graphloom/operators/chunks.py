"""Pages to chunks: spans near a target length, at white space; and the search for chunks that a model returned."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.functions.ids import chunk_id

LOOK_BACK = 250
#: Characters of spans that are held as Python strings at once.
PIECE = 1 << 18
SPANS = "array<struct<start:int,end:int,text:string>>"


def spans(text: str, target: int) -> list[tuple[int, int]]:
    """Consecutive trimmed spans of at most target characters; a span that is cut ends behind the last blank or line feed of its
    last LOOK_BACK characters, if there is one."""
    if target <= 0:
        raise ValueError("the target length must be above 0")
    out, at, n = [], 0, len(text)
    while True:
        at = _skip(text, at)
        if at >= n:
            return out
        end = min(at + target, n)
        if end < n:
            low = max(at + 1, end - LOOK_BACK)
            cut = max(text.rfind("\n", low, end), text.rfind(" ", low, end))
            end = cut + 1 if cut >= 0 else end
        stop = at + len(text[at:end].rstrip())
        out.append((at, stop))
        at = stop


def _skip(text: str, at: int) -> int:
    while at < len(text) and text[at].isspace():
        at += 1
    return at


def span_column(target: int):
    """The spans of texts and their texts, as SPANS. Spans become Arrow arrays after every PIECE characters, so that a batch has no Python object a span."""

    @F.arrow_udf(SPANS)
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield spans_of(batch, target)

    return run


def spans_of(texts: pa.Array, target: int) -> pa.Array:
    """spans() of each text and their texts, as an Arrow array of lists of structs."""
    ends, pieces, rows, size = np.zeros(len(texts) + 1, np.int32), [], [], 0
    for k, text in enumerate(texts):
        text = text.as_py() or ""
        found = spans(text, target)
        ends[k + 1] = ends[k] + len(found)
        for a, b in found:
            rows.append((a, b, text[a:b]))
            size += b - a
            if size >= PIECE:
                pieces.append(_structs(rows))
                rows, size = [], 0
    return pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays([*pieces, _structs(rows)]))


def _structs(rows: list[tuple[int, int, str]]) -> pa.Array:
    kinds = (("start", pa.int32()), ("end", pa.int32()), ("text", pa.string()))
    return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])


def chunk_pages(pages: DataFrame, target: int = 1200) -> DataFrame:
    """Chunks of pages(document_uuid, page_ord, page_number, page_offset, text): chunk_uuid, chunk_index, char_start and char_end in the
    document, text. Blank pages give none. The spans and their texts come from an Arrow UDF, so that a
    page is gone through once and does not follow its spans; everything else is JVM expressions."""
    found = pages.where(F.col("text") != "").withColumn("_s", F.explode(span_column(target)("text")))
    start, end = F.col("_s.start"), F.col("_s.end")
    found = found.withColumns({"char_start": (F.col("page_offset") + start).cast("long"), "char_end": (F.col("page_offset") + end).cast("long"), "text": F.col("_s.text")})
    order = W.partitionBy("document_uuid").orderBy("page_ord", "_s.start")
    return found.withColumn("chunk_index", F.row_number().over(order) - 1).withColumn("chunk_uuid", chunk_id(F.col("document_uuid"), F.col("char_start"), F.col("char_end"))).drop("_s")


def locate(page: str, chunks: list[str], slack: int = 50) -> list[tuple[int, int]] | str:
    """Spans of chunks in the page, in order and apart; or what is wrong. A chunk is looked for as it is from the end of the one before,
    else with every run of white space equal to every other, from a little before."""
    out, at = [], 0
    squeezed, places = _squeeze(page)
    for k, chunk in enumerate(chunks):
        if not chunk or not chunk.strip():
            return f"chunk {k} is empty"
        start = page.find(chunk, at)
        end = start + len(chunk)
        if start < 0:
            wanted = _squeeze(chunk)[0].strip()
            low = bisect_left(places, at)
            hit = squeezed.find(wanted, max(0, low - slack))
            if hit < 0:
                return f"chunk {k} is not in the page"
            start, end = places[hit], places[hit + len(wanted) - 1] + 1
        if start < at:
            return f"chunk {k} overlaps the one before"
        out.append((start, end))
        at = end
    return out


def _squeeze(text: str) -> tuple[str, list[int]]:
    """The text with runs of white space as one blank, and where each remaining character stood."""
    out, places, blank = [], [], False
    for i, c in enumerate(text):
        if not c.isspace():
            out.append(c)
            places.append(i)
            blank = False
        elif not blank:
            out.append(" ")
            places.append(i)
            blank = True
    return "".join(out), places


def located(page: Column, wanted: Column) -> Column:
    """locate() as a column: struct<spans, error>."""

    @F.pandas_udf("struct<spans:array<struct<start:int,end:int>>,error:string>")
    def run(pages: pd.Series, chunks: pd.Series) -> pd.DataFrame:
        found = [locate(p or "", list(c) if c is not None else []) for p, c in zip(pages, chunks, strict=True)]
        return pd.DataFrame({"spans": [[{"start": a, "end": b} for a, b in f] if isinstance(f, list) else None for f in found], "error": [None if isinstance(f, list) else f for f in found]})

    return run(page, wanted)
