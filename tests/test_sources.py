import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from graphloom.operators import manifest as m
from graphloom.plans.queries import PROJECT
from graphloom.sources import providers, scans, sinks
from graphloom.streaming import ingest


def test_markdown_scan(spark, tmp_path):
    (tmp_path / "a b, c.md").write_bytes(b"x\xff\ny")
    (tmp_path / "skip.txt").write_text("z")
    rows = scans.markdown(spark, str(tmp_path)).collect()
    assert [r.content for r in rows] == ["x\ny"]


def test_csv_round_trip(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Original File Path,Organized Doc Number,File Type,File Description,Relevance Analysis\np, DOC_0001_x ,pdf,"two\nlines, ""q""",\n,,,,\n')
    rows = scans.analysis_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [(r.organized_doc_number, r.file_description, r.relevance_analysis) for r in rows] == [("DOC_0001_x", 'two\nlines, "q"', "")]
    assert scans.processed_names(spark, str(tmp_path / "a.csv")).first()["name"] == "DOC_0001_x"


def test_manifest_round_trip(spark, tmp_path):
    rows = m.coerced(spark.createDataFrame([("u2", "B", "staged"), ("u1", "", "pending")], "document_uuid string, title string, status string"))
    sinks.manifest(rows, "p", "now", str(tmp_path / "m"))
    back = scans.manifest(spark, str(tmp_path / "m"))
    assert back.drop("project_uuid").select(*m.COLUMNS).exceptAll(rows).isEmpty()
    assert m.coerced(back).count() == 2


def test_staging_replaces_a_project(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    df = lambda *rows: spark.createDataFrame(list(rows), "chunk_uuid string, project_uuid string")
    sinks.stage(df(("a", "p"), ("b", "q")), path)
    sinks.stage(df(("c", "p")), path)
    assert sorted(r.chunk_uuid for r in spark.read.parquet(path).collect()) == ["b", "c"]
    sinks.stage(df(("d", "p")), path, keep_stale=True)
    assert spark.read.parquet(path).count() == 3


def test_staged_json(spark, tmp_path):
    d = tmp_path / "doc" / "chunks"
    d.mkdir(parents=True)
    (d / "c1.json").write_text(json.dumps({"chunk_uuid": "c1", "chunk_index": 3, "text": "t", "unknown": 1}, indent=1))
    row = scans.staged_chunks(spark, str(tmp_path)).first()
    assert (row.chunk_uuid, row.chunk_index, row.text) == ("c1", 3, "t")


def test_office_text(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>a</w:t><w:t>b</w:t></w:p><w:p/></w:document>')
    (tmp_path / "x.docx").write_bytes(buffer.getvalue())
    (tmp_path / "y.docx").write_bytes(b"broken")
    assert {r.text for r in scans.docx_text(spark, str(tmp_path)).collect()} == {"ab\n", None}


def test_path_list(spark, tmp_path):
    sinks.path_list(spark.createDataFrame([("a/b",)], "path string"), str(tmp_path / "l"))
    assert [r.path for r in scans.path_list(spark, str(tmp_path / "l")).collect()] == ["a/b"]


def test_retry():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")
        return "ok"

    assert providers.with_retry(flaky, 3, 1.0, sleep=waits.append)() == "ok"
    assert waits == [1.0, 2.0]
    with pytest.raises(ValueError, match="no"):
        providers.with_retry(lambda: (_ for _ in ()).throw(ValueError("no")), 2, sleep=waits.append)()
    assert providers.unfenced("```json\n{}\n```") == "{}"


def test_chunk_providers(spark):
    p = spark.createDataFrame([("t", 0, 1, "one two"), ("t", 1, 2, "bad")], "title string, page_ord int, page_number int, text string")

    def make():
        def run(number, text):
            if text == "bad":
                raise RuntimeError("refused")
            return providers.local_chunker(4)(number, text)

        return run

    rows = sorted(providers.chunk_with(p, make).collect(), key=lambda r: r.page_ord)
    assert [c.text for c in rows[0].chunks] == ["one", "two"]
    assert rows[1].error == "refused"
    model = providers.model_chunker(lambda n, t: [{"text": "one  two", "entities": [{"entity_type": "X", "text": "one"}]}])
    assert model(1, "one two three")[0]["end"] == 7
    assert providers.model_chunker(lambda n, t: [{"text": "nine", "entities": ["e"]}])(1, "one")[0]["entities"] == ["e"]
    same = spark.createDataFrame([("a b",), ("a b",)], "t string").select(providers.embed(F.col("t")).alias("v")).distinct()
    assert same.count() == 1


def test_stream_is_incremental(spark, tmp_path):
    files, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    files.mkdir()
    (files / "a.md").write_text("Page 1 of 1\nhello there")
    ingest.start(spark, str(files), out, state, PROJECT).awaitTermination()
    (files / "b.md").write_text("more")
    ingest.start(spark, str(files), out, state, PROJECT).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["hello there", "more"]
