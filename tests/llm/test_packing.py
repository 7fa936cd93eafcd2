import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from graphloom.llm import packing


def brute(ends, costs, size):
    best = {0: 0}
    for e, c in zip(ends, costs, strict=True):
        options = [best[s] + (0 if e == ends[-1] else size - e + s) + c for s in best if e - size <= s < e]
        if options:
            best[e] = min(options)
    return best[ends[-1]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.sets(st.integers(1, 30), max_size=4)), min_size=1, max_size=8), st.sampled_from([4, 8, 16, 64]))
def test_cuts_are_the_cheapest(docs, size):
    lengths = [n for n, _ in docs]
    ends, costs = packing.possible(lengths, [np.array(sorted(x for x in stops if x <= n), int) for n, stops in docs], size)
    chosen = packing.cuts(ends, costs, size)
    price, cost, at = dict(zip(ends.tolist(), costs.tolist(), strict=True)), 0, 0
    for e in chosen:
        assert 0 < e - at <= size
        cost += price[e] + (0 if e == chosen[-1] else size - e + at)
        at = e
    assert at == sum(lengths)
    assert cost == brute(ends.tolist(), costs.tolist(), size)


def test_round_trip(spark, odd, tokenizer):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokenizer)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    special = [(9001, "it's <|endoftext|> x<|startoftext|>y ①２３ ÿ× İ \x1c z"), (9002, None), (9003, "")]
    docs = docs.union(spark.createDataFrame(special, "doc_id long, text string"))
    for target in (12 << 20, 60_000):
        pieces = packing.pack_documents(docs, tokenizer, target_bytes=target).toPandas()
        for r in docs.collect():
            ids = np.array([*tk.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
            mine, at = pieces[pieces.doc_id == r.doc_id].sort_values("start"), 0
            for p in mine.itertuples():
                assert (p.start, p.ids_crc32, p.doc_tokens) == (at, zlib.crc32(ids[at : at + p.length].tobytes()), len(ids))
                at += p.length
            assert at == len(ids)
        lengths = pieces.groupby("sequence_id").length.sum()
        assert lengths.max() <= 2048
        for _, g in pieces.sort_values("offset").groupby("sequence_id"):
            assert list(g.offset) == list(np.cumsum(g.length) - g.length)
        padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths)
        assert padding < 0.01 * lengths.sum()
        order = pieces.sort_values(["sequence_id", "offset"]).doc_id
        assert order.is_monotonic_increasing


def test_odd_rows(odd, tokenizer):
    out = packing.pack_documents(odd, tokenizer).toPandas()
    assert (out.start == 0).sum() == 12
    assert out.doc_id.isna().sum() == 2
    assert packing.pack_documents(odd.limit(0), tokenizer).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 90), min_size=1, max_size=30), st.sampled_from([1, 40, 200, 10_000]), st.sampled_from([8, 16, 64]))
def test_held_ids_round_trip(lengths, held, size):
    """Documents that stream through a packer holding few ids come out whole, in gapless sequences."""
    packer, rows, at = packing.Packer(7 << 32, size, held), [], 0
    docs = []
    for k, n in enumerate(lengths):
        docs.append(np.arange(at, at + n, dtype="<u4"))
        at += n
        rows += packer.add(k, docs[-1], np.arange(5, n, 7))
    rows += packer.take(True)
    assert [r[0] for r in rows] == sorted(r[0] for r in rows)
    for k, ids in enumerate(docs):
        pieces = [r for r in rows if r[0] == k]
        start = 0
        for _, used, take, crc, total, _, _ in pieces:
            assert (used, total, crc) == (start, len(ids), zlib.crc32(ids[used : used + take].tobytes()))
            start += take
        assert start == len(ids)
    sequences = {}
    for *_, take, _, _, sequence, offset in rows:
        assert sequences.get(sequence, 0) == offset
        sequences[sequence] = offset + take
    assert max(sequences.values()) <= size
    assert sorted(sequences) == list(range(7 << 32, (7 << 32) + len(sequences)))


PARTS = st.one_of(
    st.text("abzAZéÀÞßÿ×÷ñ09 .,'<>|!#\n", max_size=12), st.text(max_size=6), st.sampled_from(["it's", "<|endoftext|>", "<|ENDOFTEXT|>", "e\u0301A", "\xa0", "\x00", "\x1c", "²①", "İ", "The", "(x)", "12-34"])
)


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.lists(PARTS, max_size=8).map("".join), min_size=1, max_size=5))
def test_ids_are_the_tokenizers(tokenizer, texts):
    from tokenizers import Tokenizer

    known = packing.worker_store("tokenizer of a test")
    tk = known.get("tk") or known.setdefault("tk", Tokenizer.from_file(tokenizer))
    got = [ids.tolist() for ids, _ in packing.WordIds(tokenizer)(pa.array(texts, pa.large_string()))]
    assert got == [tk.encode(t, add_special_tokens=False).ids for t in texts]


def test_different_words_are_not_remembered(tokenizer):
    """Texts of ever new words take no more memory than others, and no call a word."""
    import tracemalloc

    rng = np.random.default_rng(4)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnoprstuvwé"), (150_000, 9))]
    encoder = packing.WordIds(tokenizer)
    tracemalloc.start()
    n = sum(len(ids) for ids, _ in encoder(pa.array([" ".join(words[i : i + 500]) for i in range(0, len(words), 500)], pa.large_string())))
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert n > len(words)
    assert kept < 8e6


@pytest.mark.parametrize("word", ["ab" * 400_000, "A" * 300_000, "é" * 200_000 + "." * 100_000])
def test_a_very_long_word(tokenizer, word):
    from tokenizers import Tokenizer

    ((ids, stops),) = packing.WordIds(tokenizer)(pa.array([word], pa.large_string()))
    assert ids.tolist() == Tokenizer.from_file(tokenizer).encode(word, add_special_tokens=False).ids
