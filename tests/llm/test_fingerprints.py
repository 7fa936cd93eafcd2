import hashlib

import duckdb

from graphloom.llm import fingerprints as fp


def test_canonical():
    assert fp.canonical("  Ａ\tb\nC ") == "a b c"
    assert fp.canonical("Straße ﬁ") == "strasse fi"
    assert fp.canonical("é") == fp.canonical("É".lower())


def test_against_brute_force(spark, small):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet' ORDER BY doc_id DESC").fetchall()
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").repartition(3)
    for target in (12 << 20, 40_000):
        got = {r.doc_id: tuple(r)[1:] for r in fp.fingerprint_stability(docs, target_bytes=target).collect()}
        for k, (doc_id, text) in enumerate(rows):
            after = rows[(k + 1) % len(rows)][1]
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            a, b, c = (fp.canonical(t) for t in (text, edited, after))
            assert got[doc_id] == (len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.digest(a.encode()), fp.digest(b.encode()), float(a == b), float(a == c))


def test_collisions_are_told_apart(spark):
    docs = spark.createDataFrame([(i, f"text {i // 2}") for i in range(600)], "doc_id long, text string")
    by_text, by_print = {}, {}
    for r in fp.fingerprints(docs, bits=8).collect():
        by_text.setdefault(r.text, set()).add(r.fingerprint)
        by_print.setdefault(r.fingerprint, set()).add(r.text)
    assert all(len(v) == 1 for v in by_text.values())
    assert all(len(v) == 1 for v in by_print.values())


def test_odd_rows(spark, odd):
    out = fp.fingerprints(odd)
    assert set(out.columns) == set(odd.columns)
    got = {(r.doc_id, r.text): r.fingerprint for r in out.collect()}
    assert got[5, "same text here"] == got[6, "Same  TEXT here"]
    assert got[2, None] == got[3, ""] == got[4, " \n\t "]
    stable = fp.fingerprint_stability(odd)
    assert stable.count() == 12
    assert fp.fingerprints(odd.limit(0)).count() == fp.fingerprint_stability(odd.limit(0)).count() == 0
    alone = fp.fingerprint_stability(odd.where("doc_id = 9")).first()
    assert (alone.near_next, alone.near_edited) == (1.0, 0.0)


def test_collisions_of_edited_texts_are_told_apart(spark):
    rows = [(i, f"text number {i * i} of many {i}") for i in range(150)]
    out = fp.fingerprint_stability(spark.createDataFrame(rows, "doc_id long, text string"), bits=8).collect()
    canon, order = {}, sorted(rows, reverse=True)
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        canon[i] = (fp.canonical(t), fp.canonical(t[: len(t) - len(t) // 2] + after[: len(t) // 2]))
    by = {}
    for r in out:
        for name, text in zip((r.fingerprint, r.edited_fingerprint), canon[r.doc_id], strict=True):
            by.setdefault(name, set()).add(text)
    assert all(len(v) == 1 for v in by.values())
    assert len(by) == len({t for pair in canon.values() for t in pair})
