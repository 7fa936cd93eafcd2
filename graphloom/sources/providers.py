"""Services behind an interface, with deterministic local stand-ins: page chunker, embeddings, recogniser, chat."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.chunks import locate, spans
from graphloom.sources.pacing import may_pass, spread, this_lane
from graphloom.sources.pdf import page_count, part, shown_texts

# The kinds of entity a model may name, and how much of the petition and of a text goes into a review.
KINDS = ("PERSON", "ORGANIZATION", "PLACE", "DATE", "PHONE", "EMAIL", "ADDRESS", "OTHER")
PETITION_CHARS, REVIEW_CHARS = 30_000, 100_000


class Chunker(Protocol):
    def __call__(self, page_number: int, text: str) -> list[dict]: ...


class Recogniser(Protocol):
    def __call__(self, content: bytes, start: int, end: int) -> list[str]: ...


class Chat(Protocol):
    def __call__(self, prompt: str, temperature: float) -> str: ...


def with_retry(call: Callable, tries: int = 3, first_wait: float = 1.0, transient: Callable[[Exception], bool] = lambda e: True, sleep: Callable = time.sleep):
    """call, tried again with doubled waits while its errors are transient; the last error is raised."""

    def run(*args, **kwargs):
        for attempt in range(tries):
            try:
                return call(*args, **kwargs)
            except Exception as error:
                if attempt == tries - 1 or not transient(error):
                    raise
                sleep(first_wait * 2**attempt)
        return None

    return run


def unfenced(answer: str) -> str:
    """A model's answer without the fence of a code block around it."""
    text = answer.strip()
    if text.startswith("```"):
        text = text.split("```")[1].removeprefix("json")
    return text.strip()


def json_chat(chat: Chat, tries: int = 3, first_wait: float = 0.5, sleep: Callable = time.sleep) -> Callable:
    """chat with its answers read as JSON. An answer that is none goes back with the request to mend it; waits grow by first_wait. The last
    error is raised as ValueError."""

    def run(prompt: str, temperature: float = 0.2):
        asked, error = prompt, None
        for attempt in range(tries):
            sleep(first_wait * attempt) if attempt else None
            answer = ""
            try:
                answer = chat(asked, temperature)
                return json.loads(unfenced(answer))
            except Exception as e:  # whatever the service raises
                error = e
            asked = f"This was no valid JSON:\n{answer}\nDo the same task again and answer with valid JSON only.\n{prompt}"
        raise ValueError(f"no JSON in {tries} tries: {error}") from error

    return run


def checked(answer: object) -> list[dict]:
    """The chunks of a model's answer {"chunks": [{"text", "entities": [{"entity_type", "text"}]}]}. Texts must be strings with content and
    types be of KINDS, else ValueError; entities may be missing."""

    def text(holder: object) -> str:
        found = holder.get("text") if isinstance(holder, dict) else None
        if not isinstance(found, str) or not found:
            raise ValueError(f"no text in {holder!r:.80}")
        return found

    out = []
    chunks = answer.get("chunks") if isinstance(answer, dict) else None
    if not isinstance(chunks, list):
        raise ValueError("the answer has no list of chunks")
    for chunk in chunks:
        entities = [{"entity_type": e.get("entity_type") if isinstance(e, dict) else None, "text": text(e)} for e in (text(chunk) and chunk.get("entities", []))]
        unknown = [e["entity_type"] for e in entities if e["entity_type"] not in KINDS]
        if unknown:
            raise ValueError(f"unknown type of entity: {unknown[0]!r}")
        out.append({"text": text(chunk), "entities": entities})
    return out


def chat_chunker(chat: Chat, target: int = 1200, tries: int = 3, sleep: Callable = time.sleep) -> Chunker:
    """A chat model's chunks with their entities and the spans found for them. Where its answer is invalid, empty or not in the page, the
    local spans stand and the model is asked for their entities alone, one entry each; ValueError if that fails too."""
    ask = json_chat(chat, tries, sleep=sleep)
    form = '{"chunks": [{"text": "...", "entities": [{"entity_type": "...", "text": "..."}]}]}'
    rules = f"Answer with JSON of the form {form} only. Types of entities: {', '.join(KINDS)}. Texts are word for word."

    def run(page_number: int, text: str) -> list[dict]:
        try:
            answer = checked(ask(f"Cut page {page_number} into chunks of about {target} characters and name their entities. {rules}\n\n{text}", 0.1))
            found = locate(text, [c["text"] for c in answer])
            if answer and isinstance(found, list):
                return [{"text": text[a:b], "entities": c["entities"], "start": a, "end": b} for c, (a, b) in zip(answer, found, strict=True)]
        except ValueError:
            pass
        local = local_chunker(target)(page_number, text)
        listed = json.dumps([c["text"] for c in local], ensure_ascii=False)
        answer = checked(ask(f"Name the entities of each of these {len(local)} chunks of page {page_number}, in their order. {rules}\n\n{listed}", 0.1))
        if len(answer) != len(local):
            raise ValueError(f"entities of {len(answer)} chunks instead of {len(local)}")
        return [{**mine, "entities": theirs["entities"]} for mine, theirs in zip(local, answer, strict=True)]

    return run


def local_chunker(target: int = 1200) -> Chunker:
    """Spans at white space, without entities."""

    def run(page_number: int, text: str) -> list[dict]:
        return [{"text": text[a:b], "entities": [], "start": a, "end": b} for a, b in spans(text, target)]

    return run


def model_chunker(model: Callable[[int, str], list[dict]], target: int = 1200) -> Chunker:
    """A model's chunks with the spans found for them; where they are not in the page, the local spans with the model's entities in order."""

    def run(page_number: int, text: str) -> list[dict]:
        answer = model(page_number, text)
        found = locate(text, [c["text"] for c in answer])
        if isinstance(found, list) and answer:
            return [{"text": text[a:b], "entities": c.get("entities", []), "start": a, "end": b} for c, (a, b) in zip(answer, found, strict=True)]
        local = local_chunker(target)(page_number, text)
        if len(answer) == len(local):
            for mine, theirs in zip(local, answer, strict=True):
                mine["entities"] = theirs.get("entities", [])
        return local

    return run


CHUNKS = "title string, page_ord int, chunks array<struct<text:string,entities:array<struct<entity_type:string,text:string>>,start:int,end:int>>, error string"


def chunk_with(pages: DataFrame, make: Callable[[], Chunker], tries: int = 1, first_wait: float = 1.0, rate: float = 0.0, lanes: int = 0) -> DataFrame:
    """CHUNKS of pages(title, page_ord, page_number, text); each page is tried so often with doubled waits. A page that fails has its error
    and no chunks, so one failure costs one document. rate: pages a second that all tasks begin together, dealt to so many lanes (0: no limit)."""
    kind = pa.struct([("title", pa.string()), ("page_ord", pa.int32()), ("chunks", pa.list_(pa.struct([("text", pa.string()), ("entities", pa.list_(pa.struct([("entity_type", pa.string()), ("text", pa.string())]))), ("start", pa.int32()), ("end", pa.int32())]))), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]):
        made, slot = make(), this_lane(rate, lanes)

        def paced(page_number: int, text: str) -> list[dict]:
            slot()
            return made(page_number, text)

        chunker = with_retry(paced, tries, first_wait)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                try:
                    rows.append({"title": r["title"], "page_ord": r["page_ord"], "chunks": chunker(r["page_number"], r["text"]), "error": None})
                except Exception as error:
                    rows.append({"title": r["title"], "page_ord": r["page_ord"], "chunks": [], "error": str(error)})
            yield pa.RecordBatch.from_struct_array(pa.array(rows, kind))

    return spread(pages.select("title", "page_ord", "page_number", "text"), lanes, rate, "title", "page_ord").mapInArrow(run, CHUNKS)


RANGES = "title string, range_ord int, first_page int, last_page int, pages array<string>, error string"
PARTS = "title string, range_ord int, first_page int, last_page int, content binary, error string"


def page_ranges(files: DataFrame, per_request: int = 25, count: Callable[[bytes], int] = page_count, cut: Callable[[bytes, int, int], bytes] = part) -> DataFrame:
    """PARTS of files(title, content): a row for every range of per_request pages, with a file of these pages alone. A file whose pages can't
    be counted has one row, with the error; so every file has a row at least."""
    schema = pa.schema([("title", pa.string()), ("range_ord", pa.int32()), ("first_page", pa.int32()), ("last_page", pa.int32()), ("content", pa.binary()), ("error", pa.string())])

    def rows(title: str, content: bytes) -> Iterator[tuple]:
        try:
            pages = count(content)
            if pages < 1:
                raise ValueError("no page is found in the file")
        except Exception as error:  # whatever a counter raises
            yield title, 0, 1, 0, None, str(error) or type(error).__name__
            return
        for k, start in enumerate(range(0, pages, max(1, per_request))):
            end = min(start + max(1, per_request), pages)
            yield title, k, start + 1, end, cut(content, start, end), None

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for title, content in zip(batch.column("title").to_pylist(), batch.column("content"), strict=True):
                for row in rows(title, content.as_py() or b""):  # one range at a time is held
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

    return files.select("title", "content").mapInArrow(run, PARTS)


def recognise(
    files: DataFrame, make: Callable[[], Recogniser], per_request: int = 25, tries: int = 3, first_wait: float = 1.0, delay: float = 0.0, count: Callable[[bytes], int] = page_count, rate: float = 0.0, lanes: int = 32
) -> DataFrame:
    """RANGES of files(title, content): the texts of every range of per_request pages, first and last page counted from 1. Ranges are dealt
    to `lanes` tasks, so those of one file are recognised at once; all tasks together begin at most `rate` requests a second (0: as many
    as they can). A range is tried so often with doubled waits while its errors may pass, delay seconds before each request; one that fails has its
    error and no pages, as has a file whose pages can't be counted."""
    kind = pa.struct([("title", pa.string()), ("range_ord", pa.int32()), ("first_page", pa.int32()), ("last_page", pa.int32()), ("pages", pa.list_(pa.string())), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]):
        service, slot = make(), this_lane(rate, lanes)

        def paced(content: bytes, start: int, end: int) -> list[str]:
            time.sleep(delay)
            slot()
            return service(content, start, end)

        call = with_retry(paced, tries, first_wait, may_pass)
        for batch in batches:
            contents = batch.column("content")
            for k, row in enumerate(batch.drop_columns(["content"]).to_pylist()):
                row["pages"] = None
                if row["error"] is None:
                    try:
                        row["pages"] = list(call(contents[k].as_py(), row["first_page"] - 1, row["last_page"]))
                    except Exception as error:  # whatever the service raises
                        row["error"] = str(error) or type(error).__name__
                yield pa.RecordBatch.from_struct_array(pa.array([row], kind))

    parts = page_ranges(files, per_request, count)
    return spread(parts, lanes, rate, "title", "range_ord").mapInArrow(run, RANGES)


def local_recogniser() -> Recogniser:
    """A local stand-in: the texts that pages show as hexadecimal UTF-16, as pdf.made() writes them; '' for other pages."""
    return lambda content, start, end: shown_texts(content)[: end - start]


def review(text: Column, petition: str, make: Callable[[], Chat], tries: int = 3, first_wait: float = 1.0) -> Column:
    """A reviewer's JSON answer on each text in the light of one petition, both cut at their fixed lengths; null for empty texts and where
    all tries fail. See operators.analysis.unwrapped() for its fields."""
    context = petition[:PETITION_CHARS]
    wanted = '{"summary": "...", "relevance_status": "Relevant | Not Relevant | Potentially Relevant", "relevance_explanation": "..."}'

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ask = json_chat(make(), tries, first_wait)

        def one(t: str | None) -> str | None:
            try:
                return json.dumps(ask(f"Sum up the text and judge its relevance to the petition. Answer with JSON: {wanted}\n\nPETITION\n{context}\n\nTEXT\n{t[:REVIEW_CHARS]}")) if t else None
            except ValueError:
                return None

        for batch in batches:
            yield batch.map(one)

    return run(text)


def hashed_embedding(dim: int = 64) -> Callable[[pd.Series], pd.Series]:
    """A stand-in for an embedding service: signed hashed words, normalised; equal texts have equal vectors."""
    import zlib

    def one(text: str) -> list[float]:
        v = np.zeros(dim)
        for w in text.lower().split():
            h = zlib.crc32(w.encode())
            v[h % dim] += 1 if h >> 16 & 1 else -1
        n = np.linalg.norm(v)
        return (v / n if n else v).astype(np.float32).tolist()

    return lambda texts: texts.map(lambda t: one(t or ""))


def embed(text: Column, service: Callable[[pd.Series], pd.Series] | None = None) -> Column:
    """Vectors of texts, in their order, by batches."""
    call = service or hashed_embedding()

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield call(batch)

    return run(text)
