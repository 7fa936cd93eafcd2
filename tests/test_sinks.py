import pytest
from pyspark.errors import AnalysisException

from graphloom.operators import graph
from graphloom.sources import scans, sinks

ODD = 'he said "yes", then\nleft; ünï \\ end'


def test_analysis_rows_are_appended_and_read_again(spark, tmp_path):
    names = list(scans.ANALYSIS)
    for k in range(2):
        rows = spark.createDataFrame([(f"in/{k}", f"DOC_000{k}_x.pdf", "pdf", ODD, "")], ", ".join(f"`{n}` string" for n in names))
        sinks.analysis_rows(rows, str(tmp_path / "a"))
    got = scans.analysis_csv(spark, str(tmp_path / "a")).collect()
    assert sorted((r.original_file_path, r.organized_doc_number, r.file_description, r.relevance_analysis) for r in got) == [(f"in/{k}", f"DOC_000{k}_x.pdf", ODD, "") for k in range(2)]


def test_a_table_replaces_the_older_one(spark, tmp_path):
    for k in range(2):
        sinks.table_csv(spark.createDataFrame([(f"f{k}", "p", ODD)], ", ".join(f"`{n}` string" for n in scans.INVENTORY)), str(tmp_path / "t"))
    (row,) = scans.inventory_csv(spark, str(tmp_path / "t")).collect()
    assert (row.new_filename, row.summary) == ("f1", ODD)


def test_versions_stand_beside_each_other(spark, tmp_path):
    path = str(tmp_path / "v")
    first = sinks.new_version(spark.range(3), path, "1")
    second = sinks.new_version(spark.read.parquet(first).where("id > 0"), path, "2")
    assert (spark.read.parquet(first).count(), spark.read.parquet(second).count()) == (3, 2)
    with pytest.raises(AnalysisException):
        sinks.new_version(spark.range(1), path, "2")


def test_edges_of_both_stand_once(spark):
    old = spark.createDataFrame([("a", "b"), ("a", "c")], "src string, dst string")
    new = spark.createDataFrame([("c", "a"), ("a", "b"), ("c", "a")], "src string, dst string")
    want = [("a", "b"), ("a", "c"), ("c", "a")]
    assert sorted(map(tuple, graph.merge_edges(old, new).collect())) == want
    assert sorted(map(tuple, graph.merge_edges(graph.merge_edges(old, new), new).collect())) == want
    valued = graph.upsert(old.selectExpr("*", "1 AS count"), new.distinct().selectExpr("*", "5 AS count"), ["src", "dst"])
    assert sorted(map(tuple, valued.collect())) == [("a", "b", 5), ("a", "c", 1), ("c", "a", 5)]
