import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.operators import similarity, vector_index


def frame(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"id {kind}, v array<float>")


@pytest.fixture(scope="module")
def grouped(spark):
    """40 directions of very unequal size, the largest with a third of all; copies, a null and a vector of length 0."""
    rng = np.random.default_rng(4)
    heads = rng.normal(size=(40, 24))
    own = np.concatenate([np.zeros(500, int), rng.integers(1, 40, 1000)])
    points = heads[own] + 0.35 * rng.normal(size=(1500, 24))
    points[700:720] = points[700]
    rows = [(k, p.tolist()) for k, p in enumerate(points)] + [(5000, [0.0] * 24), (5001, None)]
    return frame(spark, rows).repartition(4).cache()


@pytest.fixture(scope="module")
def index(grouped, tmp_path_factory):
    return vector_index.build(grouped, str(tmp_path_factory.mktemp("index")))


def pairs(df):
    return sorted((r.src, r.rank, r.dst, round(r.score, 9)) for r in df.collect())


def test_all_rows_are_indexed(grouped, index):
    assert index.rows.count() == grouped.where("v is not null").count() == index.cells.agg(F.sum("n")).first()[0]
    assert len(index.centroids) == 39


def test_recall_of_few_probes(grouped, index):
    assert vector_index.recall(index, grouped, grouped.select("id"), 10, probes=6) >= 0.95


def test_exact_search_equals_all_pairs(grouped, index, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK_VALUES", 2000)  # several blocks a cell
    asked = grouped.where("id % 7 = 0 or id >= 5000")
    want = pairs(similarity.nearest(grouped, 10, asked.select("id")))
    assert pairs(vector_index.search(index, asked, 10, probes=1, exact=True)) == want
    few = pairs(vector_index.search(index, asked, 10, probes=1))
    assert few != want
    assert len(few) <= len(want)


def test_threshold_needs_fewer_cells(grouped, index):
    """With a floor, an exact search passes over cells out of reach and still finds every neighbour above it."""
    asked = grouped.where("id % 11 = 0")
    want = similarity.nearest(grouped, 10, asked.select("id")).where("score >= 0.75")
    got = vector_index.search(index, asked, 10, probes=1, exact=True, min_score=0.75).where("score >= 0.75")
    assert pairs(got) == pairs(want)
    edges = vector_index.similar_edges(index, asked, 10, 0.75, probes=1, exact=True)
    assert {(r.src, r.dst) for r in edges.collect()} == {(s, d) for s, _, d, _ in pairs(want) if s != d}


def test_only_visited_cells_are_read(grouped, index, capsys):
    one = index.rows.where(F.col("cell") == 3)
    one.explain("formatted")
    assert "PartitionFilters: [isnotnull(cell" in capsys.readouterr().out


def test_new_queries_and_empty_tables(spark, grouped, index, tmp_path):
    strange = frame(spark, [("q", grouped.first().v)], "string")
    assert [r.rank for r in vector_index.search(index, strange, 3).collect()] == [1, 2, 3]
    assert vector_index.search(index, grouped.limit(0), 3, exact=True).count() == 0
    none = vector_index.build(grouped.limit(0), str(tmp_path))
    assert vector_index.search(none, grouped, 3, exact=True).count() == 0
    again = vector_index.load(spark, str(tmp_path))
    assert again.rows.count() == 0


def test_a_query_is_sent_once_a_block_of_cells(grouped, index, monkeypatch):
    """What an exact search sends grows with the blocks, of which there are few, not with the cells a query visits."""
    monkeypatch.setattr(vector_index, "BLOCK_VALUES", 9000)
    asked = grouped.where("v is not null").select("id", "v", F.lit(-1.0).alias("floor"))
    dealt = vector_index._dealt(index)
    blocks = len(set(dealt[2]))
    assert 2 <= blocks <= 6 < len(index.centroids)
    sent = vector_index._visits(asked, index, 1, dealt, True).groupBy("id").agg(F.count("*").alias("n"), F.sum(F.size("cells")).alias("cells")).agg(F.max("n"), F.max("cells"), F.min("cells")).first()
    assert (sent[0], sent[1], sent[2]) == (blocks, 38, 38)


def test_a_small_cell_is_one_file(spark, grouped, tmp_path):
    vector_index.build(grouped, str(tmp_path), cells=5)
    assert len(list(tmp_path.glob("rows/cell=*/*.parquet"))) == len(list(tmp_path.glob("rows/cell=*"))) == 5


def test_many_copies_are_ranked_by_id(spark, tmp_path, monkeypatch):
    """Tiles crowded with equal scores are thinned out without losing the first ids."""
    monkeypatch.setattr(similarity, "TILE", 4096)
    rng = np.random.default_rng(7)
    one, other = rng.normal(size=16), rng.normal(size=(200, 16))
    df = frame(spark, [(k, (one if k % 3 else other[k % 200]).tolist()) for k in range(900)]).repartition(3)
    copies = [k for k in range(900) if k % 3]
    built = vector_index.build(df, str(tmp_path), cells=9)
    for found in (similarity.nearest(df, 7), vector_index.search(built, df, 7, probes=1, exact=True)):
        rows = {(r.src, r["rank"]): r.dst for r in found.collect()}
        assert [rows[copies[-1], n] for n in range(1, 8)] == copies[:7]
        assert len(rows) == 7 * 900
