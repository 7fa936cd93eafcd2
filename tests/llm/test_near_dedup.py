import random

import pytest

from graphloom.llm import near_dedup as nd


def brute(rows, words):
    sets = [(i, nd.shingles(t or "", words)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            common = len(a & b)
            if a and b and 100 * common >= 80 * (len(a) + len(b) - common):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def noisy(seed, groups, copies, edits):
    random.seed(seed)
    rows = []
    for g in range(groups):
        base = [f"w{random.randrange(400)}" for _ in range(60)]
        for _ in range(copies):
            w = list(base)
            for _ in range(random.randrange(edits)):
                w[random.randrange(60)] = f"x{random.randrange(10**6)}"
            rows.append(" ".join(w))
    random.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("words", "groups", "copies", "edits"), [(2, 12, 10, 7), (5, 12, 10, 4), (2, 1, 150, 12)])
def test_against_brute_force(spark, words, groups, copies, edits):
    rows = noisy(words, groups, copies, edits)
    want = brute(rows, words)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_components(spark.createDataFrame(rows, "doc_id long, text string"), words).collect()}
    assert got == want
    kept = {r.doc_id for r in nd.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), words).collect()}
    assert kept == {c for _, c in want.values()}


def test_large_nodes_are_not_given_up(spark, monkeypatch):
    monkeypatch.setattr(nd, "SMALL", 3)
    rows = noisy(5, 2, 40, 12)
    want = brute(rows, 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == want


def test_large_nodes_of_unrelated_sets_lose_no_pair(spark, monkeypatch):
    """Sets of frequent words: every node above the last depth is large, and its least member resembles neither of a pair."""
    monkeypatch.setattr(nd, "SMALL", 3)
    random.seed(7)
    words = [f"w{i}" for i in range(60)]
    sets = [random.sample(words, 30) for _ in range(1000)]
    pairs = []
    for _ in range(500):
        a = random.sample(words, 30)
        pairs += [a, a[:27] + random.sample(sorted(set(words) - set(a)), 3)]
    rows = [(i, " ".join(s)) for i, s in enumerate(sets + pairs)]
    want = brute(rows, 1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 1).collect()}
    assert got == want


def test_odd_rows(spark, odd):
    rows = nd.near_components(odd, 2).collect()
    assert len(rows) == 12
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id in (5, 6)} == {(5, 5), (6, 5)}
    assert all(r.n_shingles == 0 and r.kept for r in rows if r.doc_id in (2, 3, 4))
    assert nd.near_components(odd.limit(0)).count() == 0
    out = nd.near_dedup(odd, 2)
    assert out.columns == odd.columns


def test_components(spark):
    random.seed(5)
    edges = [(i, i + 1) for i in range(300, 340)] + [(i, 500) for i in range(400, 480)]  # a chain, a star around its greatest member
    edges += [(random.randrange(200), random.randrange(200)) for _ in range(150)] + [(7, 7), (450, 500), (500, 450)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    got = {r._d: r._comp for r in nd.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_clusters_of_many_blocks(spark, monkeypatch):
    """Open sets, sets joined with the first one, and both kinds in several blocks."""
    monkeypatch.setattr(nd, "BLOCK", 4)
    monkeypatch.setattr(nd, "SMALL", 3)
    rows = noisy(2, 2, 40, 14)
    want = brute(rows, 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == want


def test_sketches_tell_unrelated_long_texts_apart():
    import pyarrow as pa

    texts = [" ".join(f"{k}w{i}" for i in range(3000)) for k in range(20)]
    sketch = nd.signatures(pa.array(texts, pa.large_string()), 2)["sig"][:, : nd.SKETCH].astype("uint8")
    agree = [(sketch[a] == sketch[b]).sum() for a in range(20) for b in range(a)]
    assert max(agree) < 10


def test_one_document_of_several_texts_links_them(spark):
    """Rows of one doc_id with different texts are one vertex: of (3, X), (5, X), (5, Y), (9, Y) all are one component."""
    x, y = (" ".join(f"{c}{k}" for k in range(30)) for c in "xy")
    plain = [(3, x), (5, x), (5, y), (9, y), (20, None), (20, y), (21, "alone"), (21, ""), (30, x + " more"), (40, y), (40, "and another")]
    texts = [t for _, t in noisy(9, 6, 6, 5)]
    rng = random.Random(2)
    many = [(rng.randrange(30), t) for t in texts] + [(k, "") for k in range(0, 40, 7)]
    for rows in (plain, many):
        want = brute(rows, 2)
        sizes = [len(nd.shingles(t or "", 2)) for _, t in rows]
        got = nd.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted((i, n, want[i][1], want[i][1] == i) for (i, _), n in zip(rows, sizes, strict=True))
    assert {c for _, c in brute(plain, 2).values()} == {3, 21}
