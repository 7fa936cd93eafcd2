import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from graphloom.llm import lexical_search as ls

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms_of(text):
    return [w.translate({i: i + 32 for i in range(65, 91)}) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def expected(docs, items, k):
    held = [(d, Counter(terms_of(t))) for d, t in docs]
    texts, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms_of(t))
    out = []
    for i, q in asked.items():
        scores = []
        for d, c in held:
            m = 75 + (25 * sum(c.values()) * texts) // max(total, 1)
            score = sum(n * math.floor(1000 * math.log((2 * texts + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, n in q.items() if c[t])
            if score > 0:
                scores.append((-score, (d is not None, d or 0), d))
        out += [(i, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("limits", [(256, 1 << 14, 1 << 21), (2, 20, 300)])
def test_by_brute_force(spark, monkeypatch, limits):
    """Ties by copies, lengths from one term to thousands, several query blocks and blocks of few documents."""
    for name, value in zip(("BLOCK_ITEMS", "BLOCK_PAIRS", "TABLE_VALUES"), limits, strict=True):
        monkeypatch.setattr(ls, name, value)
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["Éa", "漢字", "x-y", "É", "a_b"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(k, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 30, 300])))) for k in range(500)]
    docs += [(1000 + k, docs[k % 3][1].upper()) for k in range(200)] + [(7, "w1 w2"), (None, "w1, w1"), (None, None), (3000, "w0 " * 9000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=6))) for k in range(9)] + [(50, None), (51, "!!"), (52, "nowhere"), (None, "w1 w5"), (0, "w3"), (53, "w0")]
    assert got(ls.lexical_search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), k=7)) == expected(docs, items, 7)


def test_bounds_hold():
    """No bound lies below a score, and few documents are scored exactly."""
    rng = np.random.default_rng(3)
    size, n_terms = 4000, 50
    kinds = rng.integers(1, 20, size)
    terms = np.concatenate([np.sort(rng.choice(n_terms, x, replace=False)) for x in kinds])
    times = rng.geometric(0.5, len(terms))
    n = np.add.reduceat(times, np.cumsum(kinds) - kinds) + rng.integers(0, 500, size)
    pairs = [(np.sort(rng.choice(n_terms, 8, replace=False)), rng.integers(1, 3, 8)) for _ in range(6)]
    weights = rng.integers(0, 15000, n_terms)
    ranking = ls.Ranking(weights, pairs, 5, size, int(n.sum()))
    made, first = 0, np.cumsum(kinds) - kinds
    for at in range(0, size, 1000):
        own = slice(first[at], first[at] + kinds[at : at + 1000].sum())
        made += ranking.add(np.arange(at, at + 1000), n[at : at + 1000], kinds[at : at + 1000], terms[own], times[own])
    table = np.zeros((size, n_terms), np.int64)
    rows = np.repeat(np.arange(size), kinds)
    table[rows, terms] = ls.impacts(times, n[rows], size, int(n.sum()))
    for i, (t, q) in enumerate(pairs):
        scores = table[:, t] @ (weights[t] * q)
        best = np.lexsort((np.arange(size), -scores))[:5]
        assert ranking.ids[i].tolist() == best.tolist()
        assert ranking.scores[i].tolist() == scores[best].tolist()
    assert made < size * len(pairs) // 20


def test_odd_rows(spark, odd):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "same TEXT here null"), (2, None), (3, "word1 line7 of49 漢字")]
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, rank string, score int")
    assert got(ls.lexical_search(odd, asked)) == expected(docs, items, 20)
    assert ls.lexical_search(odd.limit(0), asked).count() == 0
    assert ls.lexical_search(odd, asked.limit(0)).count() == 0
