import math

import pytest
from pyspark.sql import functions as F

from graphloom.llm import mixing


def tokens(spark, sizes):
    return spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, n_tokens long")


def test_repetition_limit(spark):
    sizes = {"a": 1000, "b": 100, "c": 10}
    got = {r.source: r for r in mixing.source_weights(tokens(spark, sizes), max_repeats=3.0).collect()}
    epochs = {s: got[s].budget / n for s, n in sizes.items()}
    assert epochs["a"] == 1.0
    assert epochs["c"] == 3.0
    assert sum(r.weight for r in got.values()) == pytest.approx(1)
    alpha = 1 - math.log(3) / math.log(100)
    assert got["b"].weight / got["a"].weight == pytest.approx(0.1**alpha, rel=1e-6)


def test_entropy(spark):
    sizes = {"a": 1000, "b": 100, "c": 10}
    got = mixing.source_weights(tokens(spark, sizes), max_repeats=None, target_entropy=0.9, budget_tokens=900).collect()
    assert -sum(r.weight * math.log(r.weight) for r in got) == pytest.approx(0.9, abs=1e-6)
    assert abs(sum(r.budget for r in got) - 900) <= 2


def test_one_source_and_sources_without_tokens(spark):
    got = {r.source: (r.weight, r.budget) for r in mixing.source_weights(tokens(spark, {"a": 7, "": 0})).collect()}
    assert got == {"a": (1.0, 7), "": (0.0, 0)}


def test_budgets_are_met_by_whole_passes_and_a_part(spark):
    rows = [(i, "s" if i < 30 else "t", "w " * (1 + i % 5)) for i in range(1000)]
    out = mixing.temperature_mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), max_repeats=1.5, block_docs=16)
    got = {r.source: r for r in out.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count_distinct("doc_id").alias("d"), F.max("epoch").alias("e")).collect()}
    assert (got["t"].d, got["t"].e, got["s"].d) == (970, 0, 30)
    small = sum(1 + i % 5 for i in range(30))
    assert small * 1.5 - 5 <= got["s"].n <= small * 1.5
    per = out.groupBy("doc_id", "epoch").count()
    assert per.where("count > 1").isEmpty()
    keys = [r.mix_key for r in out.collect()]
    assert min(keys) >= 0
    assert max(keys) < 1


def test_no_window_sees_a_whole_source(spark):
    rows = [(i, "s", "w " * (1 + i % 5)) for i in range(2000)]
    out = mixing.temperature_mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), block_docs=64)
    assert out.select("block").distinct().count() == 32


def test_odd_rows(odd):
    out = mixing.temperature_mix(odd)
    assert out.select("doc_id", "text").distinct().count() == odd.select("doc_id", "text").distinct().count()
    assert dict(out.dtypes)["epoch"] == "bigint"
    assert mixing.temperature_mix(odd.limit(0)).count() == 0
