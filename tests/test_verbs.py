import json

import pytest

from graphloom.__main__ import main, parser
from graphloom.operators import analysis
from graphloom.plans import verbs
from graphloom.sources import providers, scans

LETTER = "Letter of Mira Keller, mira@example.org, dated 2024-03-05, about Harbour Street. "


@pytest.fixture
def case(tmp_path):
    folder = tmp_path / "input" / "organized" / "ocr"
    folder.mkdir(parents=True)
    for k in (1, 2, 3):
        body = "".join(f"Page {p} of 2\n\n{LETTER * 20}\n" for p in (1, 2))
        (folder / f"DOC_000{k}_letter.md").write_text(f"# Letters\n{body}")
    (folder / "blank.md").write_text("  \n")
    review = tmp_path / "input" / "organized" / "analysis"
    review.mkdir()
    rows = "p,DOC_0001_letter.pdf,pdf,A letter,Relevant: yes\np,DOC_0002_letter.pdf,pdf,A letter,Relevant: yes\np,DOC_0009_x.pdf,pdf,x,y\n"
    (review / "analysis.csv").write_text("Original File Path,Organized Doc Number,File Type,File Description,Relevance Analysis\n" + rows)
    return verbs.Case("Demo case", str(tmp_path))


def test_a_case_from_files_to_graph(spark, case, capsys):
    first = verbs.ingest(spark, case)
    assert {k: first[k] for k in ("selected", "skipped", "staged", "failed")} == {"selected": 4, "skipped": 0, "staged": 4, "failed": 0}
    documents, chunks = verbs.staged(spark, case)
    assert {r.title: r.page_count_detected for r in documents.collect()} == {"DOC_0001_letter.md": 2, "DOC_0002_letter.md": 2, "DOC_0003_letter.md": 2, "blank.md": 1}
    assert chunks.count() == first["chunks"] > 6
    one = chunks.where("chunk_index = 1").first()
    assert one.id == one.chunk_uuid
    assert "EMAIL::mira@example.org" in one.entities_flat
    again = verbs.ingest(spark, case)
    assert (again["skipped"], again["staged"]) == (4, 0)
    assert verbs.ingest(spark, case, resume=False)["staged"] == 4
    assert verbs.staged(spark, case)[1].count() == first["chunks"]  # the older rows of the same chunks are passed over

    stats = verbs.load(spark, case)
    assert (stats["documents"], stats["chunks"], stats["failed"]) == (4, first["chunks"], 0)
    assert verbs.rows_of(spark, case, "next_chunk").count() == stats["next_chunk"]
    assert verbs.rows_of(spark, case, "has_document").count() == 4
    assert verbs.load(spark, case)["documents"] == 0
    created = verbs.rows_of(spark, case, "case").first().created_at
    main(["load", "--case-name", case.name, "--root", case.root, "--no-resume"])
    assert "'documents': 4" in capsys.readouterr().out
    assert verbs.rows_of(spark, case, "case").first().created_at == created
    assert verbs.rows_of(spark, case, "chunk").count() == first["chunks"]

    assert verbs.ingest_analysis(spark, case) == {"updated_documents": 2, "matched_rows": 2, "unmatched_rows": 1, "ambiguous_rows": 0}
    assert verbs.analysis_join_report(spark, case)["with_analysis"] == 2
    assert verbs.embed_docs(spark, case) == {"embedded": 2}
    assert verbs.embed_docs(spark, case) == {"embedded": 0}
    assert verbs.build_doc_similarity(spark, case) == {"similar_to": 2}
    assert verbs.build_doc_similarity(spark, case, min_score=1.1, reset=True) == {"similar_to": 0}
    assert verbs.rows_of(spark, case, "similar_to").count() == 0
    got = verbs.load_entities(spark, case)
    assert got["mentions"] == verbs.rows_of(spark, case, "mentioned_in").count() > 0
    assert verbs.load_entities(spark, case, limit_chunks=1)["raw_entities"] < got["raw_entities"]
    assert verbs.build_doc_entity_links(spark, case) == {"shares_entity": 3}
    assert verbs.markov_enrich(spark, case) == {"enriched": first["chunks"]}
    row = verbs.rows_of(spark, case, "chunk").where("chunk_index = 0").first()
    assert json.loads(row.neighbor_summary)[0]["t"] == "doc"
    assert row.text
    assert verbs.duplicates(spark, case).count() == 0


def test_failures_cost_their_document_alone(spark, case):
    def make():
        def run(number, text):
            if "Page" in text or number == 0:
                return providers.local_chunker()(number, text)
            raise RuntimeError("busy")

        return run

    got = verbs.ingest(spark, case, make=make, tries=2, backoff_seconds=0.0, only_prefix="DOC_0002")
    assert (got["selected"], got["staged"], got["failed"]) == (1, 0, 1)
    row = verbs.rows_of(spark, case, "manifest").first()
    assert (row.status, row.error) == ("failed", "busy")
    assert verbs.load(spark, case)["failed"] == 1
    assert verbs.ingest(spark, case, only_prefix="DOC_0002")["staged"] == 1
    assert verbs.load(spark, case)["documents"] == 1


def test_ocr_by_ranges(spark, case, tmp_path):
    folder = tmp_path / "input"
    (folder / "a.pdf").write_bytes(b"%PDF /Type /Pages " + b"/Type /Page " * 3)
    (folder / "b.pdf").write_bytes(b"/Type/Page\n")

    def make():
        def run(content, start, end):
            if end - start == 1 and content.startswith(b"/Type"):
                raise RuntimeError("quota")
            return [f"page text {i}" for i in range(start, end)]

        return run

    got = verbs.ocr(spark, case, make, max_pages_per_request=2, backoff_seconds=0.0, write_raw=True)
    assert (got["selected"], got["recognised"], got["failed"]) == (2, 1, 1)
    (row,) = verbs.rows_of(spark, case, "ocr_text").collect()
    assert row.title == "a.md"
    assert "Page 3 of 3\n\npage text 2" in row.content
    raw = spark.read.json(case.table("ocr_raw"))
    assert {r.name for r in raw.collect()} == {"a__pages_0001-0002", "a__pages_0003-0003"}
    assert verbs.ocr(spark, case, make, backoff_seconds=0.0, limit_docs=1)["recognised"] == 0
    assert "a.md" in {r.title for r in verbs.ocr_texts(spark, case).collect()}


def test_flags_follow_the_verbs():
    given = parser().parse_args(["ingest", "--case-name", "c", "--root", "r", "--limit-docs", "3", "--no-resume", "--backoff-seconds", "0.5"])
    assert (given.limit_docs, given.resume, given.backoff_seconds, given.start_at) == (3, False, 0.5, 0)
    assert parser().parse_args(["build-doc-similarity", "--case-name", "c", "--root", "r", "--reset"]).reset


def test_chat_answers():
    waits = []
    answers = iter(["nonsense", "```json\n{\"a\": 1}\n```"])
    asked = []
    ask = providers.json_chat(lambda prompt, t: asked.append(prompt) or next(answers), sleep=waits.append)
    assert ask("task") == {"a": 1}
    assert waits == [0.5]
    assert "nonsense" in asked[1]
    with pytest.raises(ValueError, match="no JSON in 2 tries"):
        providers.json_chat(lambda p, t: "no", 2, sleep=waits.append)("task")
    good = {"chunks": [{"text": "one", "entities": [{"entity_type": "PERSON", "text": "Mira"}]}, {"text": "two"}]}
    assert [len(c["entities"]) for c in providers.checked(good)] == [1, 0]
    for bad in ([], {"chunks": {}}, {"chunks": [{"text": ""}]}, {"chunks": [{"text": "x", "entities": [{"entity_type": "CAT", "text": "y"}]}]}, {"chunks": [{"text": "x", "entities": ["y"]}]}):
        with pytest.raises(ValueError):
            providers.checked(bad)


def test_chat_chunker_falls_back_on_entities_alone():
    def chat(prompt, temperature):
        if "Cut page" in prompt:
            return json.dumps({"chunks": [{"text": "not in the page"}]})
        return json.dumps({"chunks": [{"text": "x", "entities": [{"entity_type": "PLACE", "text": "Harbour"}]}]})

    (chunk,) = providers.chat_chunker(chat)(1, "At the Harbour")
    assert (chunk["text"], chunk["entities"][0]["text"]) == ("At the Harbour", "Harbour")
    found = providers.chat_chunker(lambda p, t: json.dumps({"chunks": [{"text": "At the"}, {"text": "Harbour"}]}))(1, "At the Harbour")
    assert [(c["start"], c["end"]) for c in found] == [(0, 6), (7, 14)]
    with pytest.raises(ValueError, match="entities of 2 chunks instead of 1"):
        providers.chat_chunker(lambda p, t: json.dumps({"chunks": [{"text": "nowhere"}, {"text": "x"}]}))(1, "At the Harbour")


def test_review(spark):
    def make():
        return lambda prompt, t: "[]" if "TEXT\nlist" in prompt else json.dumps({"summary": "s", "relevance_status": "Relevant", "relevance_explanation": str(prompt.count("p"))})

    rows = spark.createDataFrame([("a",), ("list",), ("",), (None,)], "t string")
    got = rows.select("t", analysis.unwrapped(providers.review(rows.t, "petition", make)).alias("r")).collect()
    assert [(r.t, r.r and r.r.summary) for r in got] == [("a", "s"), ("list", None), ("", None), (None, None)]


def test_other_scans(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"plain\xff")
    (tmp_path / "b.doc").write_bytes(b"\x00word\xe9s\x01no\x00")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "c.PDF").write_bytes(b"pdf")
    (tmp_path / "inventory.csv").write_text("New Filename,Original Path,Summary\nn,o, s \n")
    assert [r.text for r in scans.plain_text(spark, str(tmp_path)).collect()] == ["plain"]
    assert [r.text for r in scans.word_text(spark, str(tmp_path)).collect()] == ["wordés"]
    assert [r.title for r in scans.pdfs(spark, str(tmp_path / "deep")).collect()] == ["c.PDF"]
    assert scans.tree(spark, str(tmp_path)).count() == 4
    assert scans.inventory_csv(spark, str(tmp_path / "inventory.csv")).first().asDict() == {"new_filename": "n", "original_path": "o", "summary": "s"}


def test_a_run_that_breaks_off_skips_the_batches_it_noted(spark, case, monkeypatch):
    whole, calls = verbs._staged_batch, []

    def breaking(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return whole(*args)

    docs = spark.createDataFrame([(f"p{k}", f"n{k}.md", f"text of {k}") for k in range(12)], "path string, title string, content string")
    with monkeypatch.context() as m:
        m.setattr(verbs, "_staged_batch", breaking)
        with pytest.raises(RuntimeError, match="killed"):
            verbs.ingest(spark, case, docs, batch_docs=4)
    state = {r.title: r.status for r in verbs.rows_of(spark, case, "manifest").collect()}
    before = sum(s == "staged" for s in state.values())
    assert 0 < before < 12 == len(state)
    got = verbs.ingest(spark, case, docs, batch_docs=20)
    assert (got["selected"], got["skipped"], got["staged"]) == (12, before, 12 - before)
    documents, chunks = verbs.staged(spark, case)
    assert documents.count() == chunks.count() == 12
