import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from graphloom.llm import best_fit as bf


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


PARTS = st.sampled_from([" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "　", "\x85", "\x1c", "a", "word", "Été", "it's", "'s", "'", "12", "١٢", "漢字", "😀", "-", "...", "«", "»", "<|endoftext|>", "<|", "é", "​", "×"])


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return bf.ByteIds(vocabulary)


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=9).map("".join), min_size=1, max_size=4))
@example(["word \n\n<|endoftext|>", "a\n\nb \n c", "", "  x", "\n x"])
def test_ids_of_whole_texts(encoder, whole, texts):
    got = encoder(pa.array(texts, pa.large_string()))
    assert [x.tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 31), min_size=1, max_size=40), st.integers(0, 9))
def test_children_are_packings(lengths, seed):
    """A child of two packings holds every piece once and no bin too full; injected bins come whole."""
    n, rng = np.array(lengths), np.random.default_rng(seed)
    a, b = (bf.packed(n, 32, rng.permutation(len(n))) for _ in range(2))
    for child in (bf.crossed(a, b, n, 32, rng), bf.mutated(a, n, 32, rng)):
        full = bf.fills(child, n)
        assert full.min() > 0
        assert full.max() <= 32
        assert len(child) == len(n)
    fixed = np.isin(b, b[:1])
    gone = np.isin(np.arange(a.max() + 1), a[fixed])
    child = bf.rebuilt(a, n, 32, gone, fixed, b)
    assert len(set(child[fixed].tolist())) == 1
    for k in np.flatnonzero(~gone).tolist():  # other bins stay together, and may get more
        assert len(set(child[a == k].tolist())) == 1


def least_bins(lengths, size):
    """The fewest bins, by trying all ways."""
    best = len(lengths)

    def place(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(lengths):
            best = len(room)
            return
        for b in {r: i for i, r in enumerate(room)}.values():
            if room[b] >= lengths[k]:
                room[b] -= lengths[k]
                place(k + 1, room)
                room[b] += lengths[k]
        place(k + 1, [*room, size - lengths[k]])

    place(0, [])
    return best


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(8, 45), min_size=1, max_size=9))
def test_few_pieces_take_the_fewest_bins(lengths):
    n = np.array(sorted(lengths, reverse=True))
    best = bf.evolve(n, [], 64, 1, children=300)[0]
    assert len(bf.fills(best, n)) == least_bins(n.tolist(), 64)


def test_better_than_best_fit():
    """Triples that fill bins to the last token: the islands come nearer the bound than best fit of the longest first."""
    rng = np.random.default_rng(2)
    x = rng.integers(380, 500, (150, 2))
    n = np.concatenate([x[:, 0], x[:, 1], 1000 - x.sum(1)])
    plain = len(bf.fills(bf.packed(n, 1000, np.argsort(-n, kind="stable")), n))
    islands = [bf.evolve(n, [], 1000, k, 150) for k in range(3)]
    mixed = [bf.evolve(n, islands[k] + islands[k - 1][: bf.ELITES], 1000, 10 + k, 150) for k in range(3)]
    best = min(len(bf.fills(m[0], n)) for m in mixed)
    assert 150 <= best < plain


def whole_result(rows, docs, whole, size):
    ids = {d: [np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for x, t in docs if x == d] for d in {d for d, _ in docs}}
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    want = {}
    for d, texts in ids.items():
        for x in texts:
            edges = [0, *range(len(x) % size or size, len(x) + 1, size)] if len(x) >= size else [0, len(x)]
            want.setdefault(d, []).extend((k, a, b - a, zlib.crc32(x[a:b].tobytes())) for k, (a, b) in enumerate(itertools.pairwise(edges)))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}
    sequences = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert sequences.get(r.sequence_id, 0) == r.offset
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= size
    return len(sequences), sum(sequences.values())


@pytest.mark.parametrize("group", [4096, 30])
def test_round_trip(spark, small, vocabulary, whole, monkeypatch, group):
    """All ids in exactly one piece, gapless sequences, about as few as the bound allows; also when dealt into many groups."""
    monkeypatch.setattr(bf, "GROUP", group)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(9001, "it's <|endoftext|>\n\n x"), (9002, None), (9002, "again"), (None, ""), (9003, "a" * 9000)], "doc_id long, text string"))
    n, tokens = whole_result(bf.best_fit_packing(docs, vocabulary).collect(), [tuple(r) for r in docs.collect()], whole, 2048)
    assert n <= math.ceil(tokens / 2048) + (1 if group > 30 else 8)


def test_odd_rows(odd, vocabulary, whole):
    rows = bf.best_fit_packing(odd, vocabulary, size=64).collect()
    whole_result(rows, [(r.doc_id, r.text) for r in odd.collect()], whole, 64)
    assert bf.best_fit_packing(odd.limit(0), vocabulary).count() == 0
