"""Hashed word and character n-grams of whole texts, vectorised over the bytes of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from graphloom.llm.common import BASE_INV, byte_sums, mix, raw, scaled, slices, span_hashes, word_spans

BITS = 18
#: Lengths in bytes of the character n-grams; then come words, word pairs and pairs of word shapes (first and last
#: byte, and whether the word repeats the one before). One group of features each.
CHARS = (3, 5)
GROUPS = len(CHARS) + 3
#: 0 for other bytes, 1 for A-Z, 2 for a-z, 3 for digits, 4 for bytes of other scripts.
KIND = np.zeros(256, np.int64)
KIND[65:91], KIND[97:123], KIND[48:58], KIND[128:] = 1, 2, 3, 4
#: Multipliers that keep the groups' hashes apart.
SALTS = [np.uint64(0xD6E8FEB86659FD93 + 2 * 0x1000193 * g) for g in range(GROUPS)]


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each group: the bucket of each n-gram of all texts in order, and where each text's begin and end there."""
    n = len(data)
    sums = byte_sums(data)
    shift = np.uint64(64 - BITS)
    for group, size in enumerate(CHARS):
        m = max(0, n - size + 1)
        h = scaled(sums[size : size + m] - sums[:m], BASE_INV)
        h = (h ^ (h >> np.uint64(29))) * SALTS[group] >> shift
        low = np.minimum(offsets[:-1], m)
        yield h.astype(np.int32), low, np.maximum(low, np.minimum(offsets[1:] - size + 1, m))
    starts, ends, first = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    low, high = first[:-1], first[1:]
    yield (words * SALTS[-3] >> shift).astype(np.int32), low, high
    again = np.zeros(len(words), np.int64)
    again[1:] = words[1:] == words[:-1]
    again[low[high > low]] = 0
    shape = (KIND[data[starts]] * 256 + data[ends - 1] * (data[ends - 1] < 128)) * 2 + again
    two = [(words[:-1] * np.uint64(3) + words[1:], SALTS[-2]), ((shape[:-1] * 4096 + shape[1:]).astype(np.uint64), SALTS[-1])]
    low, high = np.minimum(low, max(len(words) - 1, 0)), np.minimum(high - 1, max(len(words) - 1, 0))
    for h, salt in two:
        yield (mix(h + np.uint64(1)) * salt >> shift).astype(np.int32), low, np.maximum(low, high)


def mean_scores(table: np.ndarray, texts: pa.Array) -> np.ndarray:
    """For each text the sum over groups of its n-grams' mean value in table (float32, 2^BITS); 0 for a group without any."""
    data, offsets = raw(texts)
    out = np.zeros(len(texts))
    for i, j in slices(offsets):
        part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        for buckets, low, high in grams(part, own):
            sums = np.zeros(len(buckets) + 1)
            np.cumsum(table[buckets], dtype=np.float64, out=sums[1:])
            out[i:j] += (sums[high] - sums[low]) / np.maximum(high - low, 1)
    return out


def sparse_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same features as compressed sparse rows (buckets, values, row starts), for fitting on a bounded sample."""
    ids, values, starts = [], [], [0]
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        all_ids, all_values = [], []
        for buckets, low, high in grams(data, np.array([0, len(data)])):
            got = buckets[low[0] : high[0]]
            all_ids.append(got)
            all_values.append(np.full(len(got), 1 / max(len(got), 1), np.float32))
        unique, where = np.unique(np.concatenate(all_ids), return_inverse=True)
        ids.append(unique.astype(np.int32))
        values.append(np.bincount(where, np.concatenate(all_values), len(unique)).astype(np.float32))
        starts.append(starts[-1] + len(unique))
    return np.concatenate([np.empty(0, np.int32), *ids]), np.concatenate([np.empty(0, np.float32), *values]), np.array(starts)
