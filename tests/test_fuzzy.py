import random
import time

import pytest
from pyspark.sql import functions as F

from graphloom.operators import entities, fuzzy

RAW = "document_uuid string, chunk_index int, chunk_uuid string, pos int, entity_type string, text string"
PROJECT = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"


def spellings(name, n, rng, changes):
    """Spellings of one normalised name: case and marks differ."""
    out = set()
    while len(out) < n:
        s = list(name)
        for _ in range(rng.randint(0, changes)):
            k = rng.randrange(len(s))
            s[k] = rng.choice([s[k].swapcase(), s[k] + ".", s[k] + "'"]) if s[k] != " " else "  "
        out.add("".join(s))
    return sorted(out, key=lambda s: rng.random())


def test_pairs_by_brute_force(spark):
    rng = random.Random(3)
    names = {"PERSON": 0.85, "OTHER": 0.9, "PHONE": 0.95, "DATE": 1.0, "LOW": 0.4}
    rows = []
    for kind, threshold in names.items():
        for c, name in enumerate(("al", "anna maria", "b", "the old bank of the city")):
            texts = [name.upper(), *spellings(name, 12 if len(name) > 2 else 3, rng, 4), " ".join(reversed(name.split()))]
            rows += [(f"{kind}{c}", i, t, threshold) for i, t in enumerate(dict.fromkeys(texts))]
    frame = spark.createDataFrame(rows, "cluster string, i int, text string, threshold double")
    got = {(r.cluster, r.a, r.b): round(r.score, 6) for r in fuzzy.similar_pairs(frame, entities.similarity).collect()}
    want = {}
    for c, i, x, t in rows:
        for d, j, y, _ in rows:
            if c == d and i < j and entities.token_sort_ratio(x, y) >= 100 * t:
                want[c, i, j] = round(entities.token_sort_ratio(x, y), 6)
    assert got == want
    assert len(want) > 100


@pytest.mark.parametrize("small", [64, 1])
def test_large_clusters_are_split_alike(spark, monkeypatch, small):
    """The similarity join and the split in a row give one result, with absorption, ties and repeated mentions."""
    monkeypatch.setattr(entities, "MANY_SPELLINGS", small)
    rng, rows, n = random.Random(8), [], 0
    for kind in ("PERSON", "ORGANIZATION", "DATE"):
        for name in ("anna maria", "acme corporation", "x y"):
            for s in spellings(name, 20 if len(name) > 3 else 4, rng, 3):
                rows += [("d", n := n + 1, f"c{n}", 0, kind, s)] * rng.randint(1, 3)
    raw = spark.createDataFrame(rows, RAW)
    got = sorted((r.entity_type, r.normalized_text, r.cluster_ord, r.canonical_text, tuple(r.variants), r.mention_count) for r in entities.canonical_entities(raw, F.lit(PROJECT), all_splits=True).collect())
    counted = {}
    for _, i, _, _, kind, s in rows:
        key = (kind, " ".join("".join(c for c in s.lower() if c not in ".'").split()))
        counted.setdefault(key, {}).setdefault(s, [i, 0])[1] += 1
    want = []
    for (kind, name), own in counted.items():
        parts = entities.split_surfaces([(s, k) for s, (_, k) in sorted(own.items(), key=lambda x: x[1][0])], entities.THRESHOLDS[kind])
        want += [(kind, name, i, entities.best_surface(p), tuple(sorted({t for t, _ in p})), sum(k for _, k in p)) for i, p in enumerate(parts)]
    assert got == sorted(want)
    assert any(len(w[4]) > 1 for w in want)
    last = entities.canonical_entities(raw, F.lit(PROJECT)).collect()
    assert {(r.entity_type, r.normalized_text, r.canonical_text) for r in last} == {w[:2] + (w[3],) for w in want if w[2] == max(v[2] for v in want if v[:2] == w[:2])}


def test_thousands_of_spellings(spark):
    """Twenty-five ways to write a name, each with 80 spellings a mark or a capital apart."""
    rng = random.Random(1)
    heads = spellings("international society of the friends of old maps", 25, rng, 40)
    texts = sorted({s for h in heads for s in spellings(h, 80, rng, 1) + [h]}, key=lambda s: rng.random())
    rows = spark.createDataFrame([("ORGANIZATION", "n", t, 1, i) for i, t in enumerate(texts)], "entity_type string, normalized_text string, text string, n long, first int")
    began = time.time()
    parts = entities.split_many(rows).collect()
    assert sum(r.mention_count for r in parts) == len(texts) > 1500
    assert sum(len(r.variants) for r in parts) == len(texts)
    assert len(parts) < len(texts) / 10
    assert time.time() - began < 240
