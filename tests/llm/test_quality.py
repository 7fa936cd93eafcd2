import collections
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from graphloom.llm import quality_classifier as qc
from graphloom.llm import quality_rules as qr

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORDS.findall(text)
    seen, lines, covered = set(), 0, set()
    windows = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    for i in range(len(w) - 2):
        if windows[w[i], w[i + 1], w[i + 2]] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORDS.search(line):
            lines += line in seen
            seen.add(line)
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab \n\té#|", max_size=60), max_size=8))
def test_counts_equal_brute_force(texts):
    got = qr.counts(pa.array(texts, pa.large_string()))
    assert [[int(got[k][i]) for k in qr.COUNTS] for i in range(len(texts))] == [brute(t) for t in texts]


def auc(score, y):
    rank = np.argsort(np.argsort(score))
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def test_rules_on_labelled_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = qr.quality_rules(docs, labels).join(labels, "doc_id").toPandas()
    long = out[out.n_words >= 50]
    assert long[long.quality == 1].kept.mean() > 0.98
    assert long[long.quality == 0].kept.mean() < 0.1
    assert not out[out.base_failed].kept.any()


def test_classifier_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = qc.quality_classifier(docs, labels, learn=qc.folds(5) != 0).withColumn("held_out", qc.folds(5) == 0).join(labels, "doc_id").toPandas()
    held = out[out.held_out]
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.9
    assert ((held.score >= 0.3) == (held.predicted == 1)).all()


def test_a_score_depends_on_its_text_alone(spark, odd, labels):
    out = qc.quality_classifier(odd, labels).select("doc_id", "text", "score").collect()
    again = {(r.doc_id, r.text): r.score for r in qc.quality_classifier(odd.repartition(1).orderBy("n_chars", "doc_id"), labels).collect()}
    assert all(abs(again[r.doc_id, r.text] - r.score) < 1e-9 for r in out)


def test_odd_rows(spark, odd, labels):
    for one, name in ((lambda d, q: qr.quality_rules(d, q), "kept"), (lambda d, q: qc.quality_classifier(d, q), "predicted")):
        out = one(odd, labels)
        assert out.count() == 12
        assert name in out.columns
        assert one(odd.limit(0), labels).count() == 0
        assert one(odd, labels.limit(0)).count() == 12
    kept = {r.doc_id: r.kept for r in qr.quality_rules(odd, labels.limit(0)).collect()}
    assert kept[7]
    assert not kept[2]
