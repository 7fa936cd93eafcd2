import pytest
from pyspark.errors import StreamingQueryException

from graphloom.plans import verbs
from graphloom.streaming import ingest


def test_new_files_are_staged_once_batch_by_batch(spark, tmp_path, monkeypatch):
    case = verbs.Case("Streamed", str(tmp_path))
    folder = tmp_path / "input" / "organized" / "ocr"
    folder.mkdir(parents=True)
    for name in ("a", "b"):
        (folder / f"{name}.md").write_text(f"Page 1 of 1\ntext of {name}")
    whole, calls = verbs._staged_batch, []

    def breaking(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return whole(*args)

    with monkeypatch.context() as m:
        m.setattr(verbs, "_staged_batch", breaking)
        with pytest.raises(StreamingQueryException, match="killed"):
            ingest.start_case(spark, case, str(tmp_path / "seen"), files_a_batch=1).awaitTermination()
    assert verbs.staged(spark, case)[0].count() == 1
    (folder / "c.md").write_text("Page 1 of 1\ntext of c")
    ingest.start_case(spark, case, str(tmp_path / "seen"), files_a_batch=2).awaitTermination()
    assert sorted(r.title for r in verbs.rows_of(spark, case, "staged_document").collect()) == ["a.md", "b.md", "c.md"]
    assert {r.status for r in verbs.rows_of(spark, case, "manifest").collect()} == {"staged"}
    assert verbs.staged(spark, case)[1].count() == 3
