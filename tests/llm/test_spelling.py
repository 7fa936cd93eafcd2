import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from graphloom.llm import spelling


def near(a, b):
    """One inserted, deleted or replaced character, by trying all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(rows, factor=10, slip=31, min_chars=7, min_count=2):
    n = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % slip == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_count}
    partners = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, k in n.items():
        best = min(partners[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= factor * k:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), k, len(partners[w]), n[form[w]] if w in form else None) for w, k in n.items())


def got(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@settings(max_examples=300, deadline=None)
@given(st.text("abé", min_size=1, max_size=9), st.text("abé", min_size=1, max_size=9))
def test_one_edit(a, b):
    a, b = sorted((a, b), key=len)
    at = spelling.one_edit(a, b) if len(b) - len(a) < 2 else -1
    assert (at >= 0) == near(a, b)
    if at >= 0:
        assert a[:at] == b[:at]


@pytest.mark.parametrize("most", [1, 4, 48])
def test_pairs_by_brute_force(spark, most):
    """Words over three letters, so that blocks are full and divided down to one open character; long words, and words of two characters."""
    import random

    rng = random.Random(most)
    words = {"".join(rng.choices("abé", k=rng.randint(2, 7))) for _ in range(500)}
    long = "x" * 61
    words |= {long + "abcd", long + "abc", long + "abcde", long + "bbcd", "y" + long + "abc", long + "abcdefgh", long[:-1] + "abc"}
    out = spelling.near_words(spark.createDataFrame([(w, len(w)) for w in words], "word string, n long"), most).collect()
    assert all((r.n, r.near_n) == (len(r.word), len(r.near)) for r in out)
    assert sorted((r.word, r.near) for r in out) == sorted((a, b) for a in words for b in words if near(a, b))


def test_documents_by_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    assert got(spelling.spelling_variants(docs, most=3)) == expected([tuple(r) for r in docs.collect()])


def test_forms_chain_and_ties(spark):
    rows = [(k, "internet " * 1000 + "internat " * 1001 + "inernet intornet " * 100 + "inornet " * 4) for k in range(3)]
    want = expected(rows)
    assert any(r[1] and r[1] != r[2] for r in want)
    assert got(spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(None, "Übermäßig übermäßig Ångström×÷ straße—straßen ǅungle " * 3)]
    more = spark.createDataFrame([(*rows[-1], None, None, None, "k", 1, "t", 2, "n", 3, "e", 4)], odd.schema)
    assert got(spelling.spelling_variants(odd.union(more))) == expected(rows)
    assert spelling.spelling_variants(odd.limit(0)).count() == 0
