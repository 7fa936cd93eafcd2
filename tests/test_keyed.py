import os

import pytest
from pyspark.sql import functions as F

from graphloom.operators import graph
from graphloom.sources import keyed

DDL = "project_uuid string, k long, a string, b string"


@pytest.fixture
def table(spark, tmp_path):
    return keyed.KeyedTable(spark, str(tmp_path / "t"), DDL, buckets=8)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, a string, b string")


def upsert(old, new):
    return graph.upsert(old, new, ["k"])


def values(rows):
    return {(r.project_uuid, r.k): (r.a, r.b) for r in rows.collect()}


def folders(table, project):
    return {(d.split("bucket=")[1].split("/")[0], d.split("version=")[1]) for d, _, files in os.walk(f"{table.path}/data/project_uuid={project}") if any(f.endswith(".parquet") for f in files)}


def test_upserts_of_two_projects(spark, table):
    assert table.every().count() == table.rows("p").count() == 0
    table.update("p", frame(spark, [(k, f"a{k}", None) for k in range(100)]), ["k"], upsert)
    table.update("q", frame(spark, [(1, "other", "x")]), ["k"], upsert)
    table.update("p", frame(spark, [(3, None, "b3"), (500, "new", None)]), ["k"], upsert)
    want = {("p", k): (f"a{k}", "b3" if k == 3 else None) for k in range(100)} | {("p", 500): ("new", None)}
    assert values(table.rows("p")) == want
    assert values(table.every()) == want | {("q", 1): ("other", "x")}
    table.replace("p", frame(spark, [(7, "only", None)]), ["k"])
    assert values(table.every()) == {("p", 7): ("only", None), ("q", 1): ("other", "x")}
    table.replace("p", frame(spark, []), ["k"])
    assert values(table.every()) == {("q", 1): ("other", "x")}
    assert table.update("p", frame(spark, []), ["k"], upsert) == []


def test_only_touched_buckets_are_read_and_written(spark, table, capsys):
    table.update("p", frame(spark, [(k, "x" * 50, None) for k in range(2000)]), ["k"], upsert)
    before = folders(table, "p")
    assert len(before) == 8
    seen = []

    def merge(old, new):
        seen.append(old.count())
        old.explain("formatted")
        return upsert(old, new)

    (bucket,) = table.update("p", frame(spark, [(5, "changed", None)]), ["k"], merge)
    ((name, _),) = folders(table, "p") - before
    assert name == str(bucket)
    assert 100 < seen[0] < 500
    assert "PartitionFilters: [isnotnull(project_uuid" in capsys.readouterr().out
    assert table.rows("p").count() == 2000
    assert [(r.bucket, r.version) for r in table.stale().collect()] == [(bucket, next(v for b, v in before if b == str(bucket)))]


def test_a_run_that_breaks_off_before_its_commit_loses_nothing(spark, table, monkeypatch):
    table.update("p", frame(spark, [(k, "old", None) for k in range(50)]), ["k"], upsert)
    want = values(table.rows("p"))

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(table, "_commit", broken)
        for change in (table.update, table.replace):
            args = (upsert,) if change == table.update else ()
            with pytest.raises(RuntimeError, match="lost"):
                change("p", frame(spark, [(1, "new", None), (99, "new", None)]), ["k"], *args)
    assert values(table.rows("p")) == values(table.every()) == want
    assert table.stale().count() > 0
    table.update("p", frame(spark, [(1, "new", None), (99, "new", None)]), ["k"], upsert)
    assert values(table.rows("p")) == want | {("p", 1): ("new", None), ("p", 99): ("new", None)}


def test_a_new_number_of_buckets(spark, table):
    table.update("p", frame(spark, [(k, "x", None) for k in range(64)]), ["k"], upsert)
    table.replace("p", table.rows("p"), ["k"], buckets=2)
    assert table.rows("p").count() == table.every().count() == 64
    assert set(table.update("p", frame(spark, [(k, "y", None) for k in range(64)]), ["k"], upsert)) == {0, 1}
    table.replace("p", table.rows("p").where("k < 60"), ["k"], buckets=16)
    assert values(table.every()) == {("p", k): ("y", None) for k in range(60)}
    assert table.rows("p", [0, 1]).count() < 60
    assert table.log().where("project_uuid = 'p'").select(F.max("buckets")).first()[0] == 16


def test_numbers_of_buckets():
    assert [keyed.fitting(n) for n in (0, 1, 4_000_000, 4_000_001, 8_000_000, 10**12)] == [16, 16, 16, 32, 32, 4096]
