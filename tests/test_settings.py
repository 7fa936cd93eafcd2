import pytest

from graphloom.__main__ import main, parser
from graphloom.operators import manifest
from graphloom.plans import settings, verbs
from graphloom.sources import pdf, scans


def test_environment_and_flags(monkeypatch):
    for n in settings.NAMES:
        monkeypatch.delenv(f"GRAPHLOOM_{n.upper()}", raising=False)
    with pytest.raises(ValueError, match="GRAPHLOOM_CASE_NAME.*GRAPHLOOM_ROOT"):
        settings.case({})
    monkeypatch.setenv("GRAPHLOOM_CASE_NAME", "from outside")
    monkeypatch.setenv("GRAPHLOOM_ROOT", "/data/")
    monkeypatch.setenv("GRAPHLOOM_INPUT", "letters")
    found = settings.case({"case_name": "given", "tenant": "t"})
    assert (found.name, found.root, found.tenant, found.inputs("x")) == ("given", "/data", "t", "/data/letters/x")
    monkeypatch.setenv("GRAPHLOOM_INPUT", "s3a://in")
    assert settings.case({}).inputs("x") == "s3a://in/x"
    assert settings.factory("graphloom.sources.pdf:page_count") is pdf.page_count
    with pytest.raises(ValueError, match="module:function"):
        settings.factory("nothing")


def test_ocr_and_indexes_as_commands(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("GRAPHLOOM_ROOT", str(tmp_path))
    (tmp_path / "input").mkdir()
    (tmp_path / "input" / "DOC_0001_a.pdf").write_bytes(pdf.made(["one", "two"], True))
    with pytest.raises(ValueError, match="--service"):
        main(["ocr", "--case-name", "c"])
    assert parser().parse_args(["ocr", "--service", "a:b"]).make == "a:b"
    got = main(["ocr", "--case-name", "c", "--service", "graphloom.sources.providers:local_recogniser", "--rate", "50"])
    assert (got["selected"], got["recognised"], got["failed"]) == (1, 1, 0)
    found = main(["indexes", "--case-name", "c"])
    assert (found["duplicate_document"], found["vectors"]) == (0, 0)
    text = verbs.ocr_texts(spark, settings.case({"case_name": "c"})).first()
    assert text.title == "DOC_0001_a.md"
    assert "Page 2 of 2\n\ntwo" in text.content


def test_a_prefix_opens_no_other_file(spark, tmp_path):
    for name in ("DOC_0001_a.md", "x doc_0001 b.md", "DOC_0002_c.md"):
        (tmp_path / name).write_text(name)
    rows = scans.markdown(spark, str(tmp_path), "DOC_0001")
    assert sorted(r.title for r in rows.collect()) == ["DOC_0001_a.md", "x doc_0001 b.md"]
    assert len(rows.inputFiles()) == 2
    assert scans.markdown(spark, str(tmp_path), "DOC_0009").count() == 0


def test_offsets_without_a_limit_run_in_ranges(spark):
    rows = spark.createDataFrame([(f"u{k:03}", None if k % 3 else f"t{k:03}") for k in range(200)], "document_uuid string, title string").repartition(5)
    whole = manifest.selected(rows, limit=1000).collect()
    assert sorted(manifest.selected(rows, start=150).collect()) == sorted(whole[150:])
    assert manifest.selected(rows, start=500).count() == 0
