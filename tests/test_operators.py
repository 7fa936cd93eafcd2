import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphloom.operators import analysis, chunks, enrich, entities, files, graph, manifest, pages, reports, similarity


def split(spark, content):
    rows = pages.split_pages(spark.createDataFrame([("t", content)], "title string, content string")).orderBy("page_ord").collect()
    return [(r.page_number, r.total_pages, r.text) for r in rows]


def test_pages(spark):
    assert split(spark, " a\nb ") == [(1, 1, "a\nb")]
    assert split(spark, "") == [(1, 1, "")]
    assert split(spark, None) == [(1, 1, "")]
    assert split(spark, "head\nPage 1 of 2\n x \n  pAGE  2 of 2 \r\ny") == [(0, None, "head"), (1, 2, "x"), (2, 2, "y")]
    assert split(spark, "\n \nPage 1 of 2\nPage 2 of 2\nz") == [(1, 2, ""), (2, 2, "z")]
    assert split(spark, "say Page 1 of 2\nx") == [(1, 1, "say Page 1 of 2\nx")]


def test_offsets_of_equal_numbers(spark):
    p = pages.split_pages(spark.createDataFrame([("t", "Page 1 of 2\nabc\nPage 1 of 2\nde")], "title string, content string"))
    assert [r.page_offset for r in pages.page_offsets(p).orderBy("page_ord").collect()] == [5, 5]
    assert [r.page_offset for r in pages.page_offsets(p, by_number=False).orderBy("page_ord").collect()] == [0, 5]


def test_markdown_round_trip(spark):
    rows = [("a.md", 2, " two "), ("a.md", 1, "one"), ("b.md", 1, None)]
    md = pages.assemble_markdown(spark.createDataFrame(rows, "title string, page_number int, text string"))
    back = pages.split_pages(md).orderBy("title", "page_ord").collect()
    assert [(r.title, r.page_number, r.text) for r in back] == [("a.md", 0, "# OCR Output for a.pdf"), ("a.md", 1, "one"), ("a.md", 2, "two"), ("b.md", 0, "# OCR Output for b.pdf"), ("b.md", 1, "")]


@settings(max_examples=200, deadline=None)
@given(st.text("ab \n\t.", max_size=400), st.integers(1, 60))
def test_spans_cover_the_text(text, target):
    at = 0
    for a, b in chunks.spans(text, target):
        assert at <= a < b <= a + target
        assert not text[at:a].strip()
        assert text[a:b] == text[a:b].strip()
        at = b
    assert not text[at:].strip()


def test_spans_by_hand():
    assert chunks.spans("x" * 30, 10) == [(0, 10), (10, 20), (20, 30)]
    assert chunks.spans("aaa bbb ccc", 8) == [(0, 7), (8, 11)]
    assert chunks.spans("aaa bbb\nccc", 8) == [(0, 7), (8, 11)]
    assert chunks.spans("  ", 5) == []
    with pytest.raises(ValueError, match="above 0"):
        chunks.spans("a", 0)


def test_locate():
    page = "one two\n three  four one"
    assert chunks.locate(page, ["one two", "three four", "one"]) == [(0, 7), (9, 20), (21, 24)]
    assert chunks.locate(page, ["five"]) == "chunk 0 is not in the page"
    assert chunks.locate(page, ["one", " "]) == "chunk 1 is empty"


def test_located_column(spark):
    row = spark.createDataFrame([("ab cd", ["ab", "cd"])], "p string, c array<string>").select(chunks.located(F.col("p"), F.col("c")).alias("x")).first()["x"]
    assert [(s.start, s.end) for s in row.spans] == [(0, 2), (3, 5)]
    assert row.error is None


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "id string, n int, once string")
    new = spark.createDataFrame([("b", None, "y"), ("c", 3, "z")], "id string, n int, once string")
    first = graph.upsert(old, new, ["id"], once=("once",))
    assert sorted(map(tuple, first.collect())) == [("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")]
    assert sorted(graph.upsert(first, new, ["id"], once=("once",)).collect()) == sorted(first.collect())


def test_next_edges_count(spark):
    c = spark.createDataFrame([("d", "x", 1), ("d", "y", 0), ("d", "z", 2), ("e", "w", 0)], "document_uuid string, chunk_uuid string, chunk_index int")
    assert sorted(map(tuple, graph.next_edges(c).collect())) == [("x", "z"), ("y", "x")]


def test_manifest_states(spark):
    make = lambda *rows: manifest.coerced(spark.createDataFrame(list(rows), "document_uuid string, title string, status string, error string, chunk_count int, loaded_at string"))
    old = make(("a", "A", "loaded", "e", 5, "t"), ("b", "B", "loaded", "", 5, "t"), ("c", "C", None, "", 2, None), ("d", "D", None, "", 0, None))
    new = make(("a", "", "pending", "", 1, ""), ("b", "B2", "failed", "oops", 9, ""), ("e", "E", "staged", "", 1, ""))
    got = {r.document_uuid: (r.title, r.status, r.error, r.chunk_count, r.loaded_at) for r in manifest.merge(old, new).collect()}
    assert got == {"a": ("A", "loaded", "e", 5, "t"), "b": ("B2", "failed", "oops", 9, "t"), "c": ("C", "staged", "", 2, ""), "d": ("D", "pending", "", 0, ""), "e": ("E", "staged", "", 1, "")}
    assert manifest.merge(manifest.merge(old, new), new).exceptAll(manifest.merge(old, new)).isEmpty()
    assert {r.document_uuid for r in manifest.to_load(old).collect()} == {"c", "d"}


def test_analysis_ladder(spark):
    docs = analysis.with_keys(spark.createDataFrame([("1", "DOC_0001_a.md", ""), ("2", "DOC_0002_b.md", ""), ("3", "DOC_0002_c.md", ""), ("4", "Plain Name.md", ""), ("5", "twin.md", ""), ("6", "Twin.txt", "")], "document_uuid string, title string, source_file string"))
    names = ["DOC_0001_zzz.pdf", "DOC_0002_b.pdf", "plain-name.doc", "DOC_0009_plain name.pdf", "TWIN.pdf", "nothing.pdf", "", "DOC_0001_last.pdf"]
    rows = spark.createDataFrame([(i, n, "t", "d", "r", "p") for i, n in enumerate(names)], "row_no long, organized_doc_number string, file_type string, file_description string, relevance_analysis string, original_file_path string")
    got = [(r.strategy, r.document_uuid) for r in analysis.classify(rows, docs).orderBy("row_no").collect()]
    assert got == [("prefix", "1"), ("ambiguous", None), ("normalized", "4"), ("normalized", "4"), ("ambiguous", None), ("none", None), ("none", None), ("prefix", "1")]
    last = {r.document_uuid: r.organized_doc_number for r in analysis.join_analysis(rows, docs).collect()}
    assert last == {"1": "DOC_0001_last.pdf", "4": "DOC_0009_plain name.pdf"}
    assert tuple(analysis.join_counts(rows, docs).first()) == (2, 4, 2, 2)


def test_token_sort_ratio():
    assert entities.token_sort_ratio("b a", "a b") == 100.0
    assert entities.token_sort_ratio("abc", "abd") == pytest.approx(200 * 2 / 6)
    assert entities.token_sort_ratio("ACME", "acme") == 0.0
    assert entities.token_sort_ratio("", "") == 100.0


def test_canonical_entities_split_by_case(spark):
    names = ["Acme Corp", "Acme Corp", "ACME CORP", "acme, corp.", "Acme Corp."]
    rows = [("d", i, f"c{i}", 0, "ORGANIZATION", n) for i, n in enumerate(names)]
    raw = spark.createDataFrame(rows, "document_uuid string, chunk_index int, chunk_uuid string, pos int, entity_type string, text string")
    project = F.lit("6ba7b810-9dad-11d1-80b4-00c04fd430c8")
    every = sorted((r.cluster_ord, r.canonical_text, r.mention_count) for r in entities.canonical_entities(raw, project, all_splits=True).collect())
    assert every == [(0, "Acme Corp", 3), (1, "ACME CORP", 1), (2, "acme, corp.", 1)]
    stored = entities.canonical_entities(raw, project).collect()
    assert [(r.canonical_text, r.mention_count) for r in stored] == [("acme, corp.", 1)]
    assert entities.mentions(raw, project).count() == 5


def test_raw_entities(spark):
    payloads = ['[{"entity_type":"person","text":" Al "},{"text":"x"},{"entity_type":"","text":"y"},{"entity_type":"PLACE","text":"  "}]', "{bad", "", None]
    c = spark.createDataFrame([("d", i, f"c{i}", p) for i, p in enumerate(payloads)], "document_uuid string, chunk_index int, chunk_uuid string, entities_json string")
    assert sorted((r.entity_type, r.text) for r in entities.raw_entities(c).collect()) == [("OTHER", "x"), ("OTHER", "y"), ("PERSON", "Al")]


def test_surface_entities(spark):
    got = spark.createDataFrame([("Write Alice at al@ex.org or +1 555 123 4567 by 2024-01-02",)], "t string").select(entities.surface_entities(F.col("t")).alias("e")).first()["e"]
    assert {(e.entity_type, e.text) for e in got} >= {("EMAIL", "al@ex.org"), ("DATE", "2024-01-02"), ("OTHER", "Alice")}


def test_spans_are_arrow_arrays_piece_by_piece(monkeypatch):
    monkeypatch.setattr(chunks, "PIECE", 10)
    texts = ["one two three four", None, "", "  ", "a" * 25, "é ü 漢 字"]
    got = chunks.spans_of(pa.array(texts), 9).to_pylist()
    assert got == [[{"start": a, "end": b, "text": t[a:b]} for a, b in chunks.spans(t or "", 9)] for t in ((x or "") for x in texts)]
    assert chunks.spans_of(pa.array([], pa.string()), 9).to_pylist() == []


def test_memory_of_a_block_of_vectors(monkeypatch):
    """Scores are held by tiles, not for a strip of queries and the whole block; copies do not change that."""
    import tracemalloc

    rng = np.random.default_rng(3)
    v = rng.standard_normal((60_000, 8))
    v[::2] = v[0]
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    ids = pa.array(np.arange(len(v)))
    tracemalloc.start()
    got = similarity._links((ids[:256], unit[:256]), (ids, unit), 5, -2.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6 < 256 * len(v) * 8
    assert len(got) == 5 * 256
    assert got.filter(pc.equal(got["src"], 100))["dst"].to_pylist() == [0, 2, 4, 6, 8]


@pytest.mark.parametrize("vectors", [10_256, 102_564, 615_384, 6_000_000])
def test_blocks_stop_growing(vectors):
    """A task's two blocks hold BLOCK_VALUES numbers each at most, whatever the table."""
    assert -(-vectors * 64 // similarity.blocks_of(vectors * 64, similarity.BLOCK_VALUES, similarity.BLOCKS)) <= similarity.BLOCK_VALUES


def test_nearest_in_its_own_precision_and_for_some(spark, monkeypatch):
    """Floats, queries that are a subset, and a floor give the same as all pairs."""
    monkeypatch.setattr(similarity, "BLOCK_VALUES", 90)
    rng = np.random.default_rng(2)
    v = rng.standard_normal((70, 6)).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<float>").repartition(3)
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    score = unit @ unit.T
    want = {(i, int(j)): score[i, j] for i in range(0, 70, 3) for j in np.argsort(-score[i])[:5] if score[i, j] >= 0.4}
    got = {(r.src, r.dst): r.score for r in similarity.nearest(df, 5, df.where("id % 3 = 0").select("id"), 0.4).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-12 for p in want)
    every = {(r.src, r.dst) for r in similarity.edges(similarity.nearest(df, 5), 3, 0.4).collect()}
    assert every == {(i, int(j)) for i in range(70) for j in np.argsort(-score[i])[:3] if score[i, j] >= 0.4 and i != j}


def test_nearest_by_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((60, 5))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(60, None)], "id long, v array<double>").repartition(3)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    want = {(i, int(j)) for i, row in enumerate(unit @ unit.T) for j in np.argsort(-row)[:4]}
    for block in (1 << 20, 80):
        monkeypatch.setattr(similarity, "BLOCK_VALUES", block)
        assert {(r.src, r.dst) for r in similarity.nearest(df, 4).collect()} == want
    assert all(r.src != r.dst for r in similarity.similar_edges(df, top_k=4, min_score=-1.0).collect())
    assert similarity.similar_edges(df, top_k=4, min_score=-1.0).count() == 180
    assert similarity.nearest(df.limit(0), 4).count() == 0


def test_neighbourhood_caps(spark):
    c = spark.createDataFrame([("d", f"c{i}", i) for i in range(3)], "document_uuid string, chunk_uuid string, chunk_index int")
    d = spark.createDataFrame([("d", "Title")], "document_uuid string, title string")
    e = spark.createDataFrame([(f"e{i}", f"E {i}", 10 * i) for i in range(9)], "canonical_id string, canonical_text string, mention_count long")
    m = spark.createDataFrame([(f"e{i}", "c1") for i in range(9)], "canonical_id string, chunk_uuid string")
    row = enrich.neighbourhoods(c, d, e, m).where("chunk_uuid = 'c1'").first()
    assert len(row.neighbours) == 8
    assert row.n_mentions == 6
    assert row.neighbours[3].r == 1.0
    shown = enrich.render(enrich.neighbourhoods(c, d, e, m)).where("chunk_uuid = 'c0'").first()
    assert shown.edge_summary == '[{"type": "NEXT_CHUNK", "n": 1}, {"type": "MENTIONED_IN", "n": 0}]'
    assert shown.traversal_hints == '[{"type": "continue", "desc": "Continue to next chunk", "id": "c1"}]'


def test_file_operators(spark):
    f = spark.createDataFrame([("a/x.pdf", "h2"), ("b/x.pdf", "h2"), ("c.txt", "h1"), ("d", None)], "path string, hash string")
    assert sorted((r.src, r.dst) for r in files.copy_plan(f).collect()) == [("a/x.pdf", "DOC_0002_x.pdf"), ("c.txt", "DOC_0001_c.txt")]
    names = spark.createDataFrame([("DOC_0009_b",), ("DOC_0010_a",), ("plain",)], "name string")
    assert sorted(map(tuple, files.renumbered(names).collect())) == [("DOC_0009_b", "DOC_0001_b"), ("DOC_0010_a", "DOC_0002_a"), ("plain", "DOC_0003_plain")]


def test_reports(spark):
    m = manifest.coerced(spark.createDataFrame([("a", "A", "staged", "", 4), ("b", "B", "failed", "bad " * 300, 0)], "document_uuid string, title string, status string, error string, chunk_count int"))
    row = reports.run_metrics(m, 2.0).first()
    assert (row.documents, row.chunks, row.failed_documents, row.chunks_per_second) == (1, 4, 1, 2.0)
    text = reports.markdown("Run", row, reports.failures(m).collect())
    assert "- chunks: 4" in text
    assert "..." in text


def test_common_subsequences_equal_the_table():
    import random

    from graphloom.operators.entities import common_length

    def table(x, y):
        before = [0] * (len(y) + 1)
        for c in x:
            now = [0]
            for j, d in enumerate(y):
                now.append(before[j] + 1 if c == d else max(before[j + 1], now[j]))
            before = now
        return before[-1]

    chance = random.Random(7)
    for _ in range(400):
        x, y = ("".join(chance.choice("abcé ") for _ in range(chance.randrange(90))) for _ in range(2))
        assert common_length(x, y) == table(x, y)


def test_neighbours_within_a_project(spark):
    from graphloom.operators.similarity import similar_edges

    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [1.0, 0.2]), (4, [1.0, 0.3])]
    v = spark.createDataFrame(rows, "id long, v array<double>")
    got = similar_edges(v, top_k=3, within=v.where("id in (1, 4)").select("id")).collect()
    assert got == []  # 2 and 3 take the places
    got = similar_edges(v, top_k=4, within=v.where("id in (1, 4)").select("id")).collect()
    assert {(r.src, r.dst) for r in got} == {(1, 4), (4, 1)}
