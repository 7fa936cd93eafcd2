"""Quality rules: hashed n-gram logistic regression fitted on labelled rows, calibrated, beside two counting rules."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from graphloom.llm.common import SPACE, annotate, calibrate, labelled, mix, raw, sigmoid, slices, span_hashes, strings, word_spans
from graphloom.llm.ngrams import BITS, grams, mean_scores

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs at least twice."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of each text. Words, lines and 3-word windows are compared by 64-bit hashes within one text."""
    data, offsets = raw(texts)
    out = {k: np.zeros(len(texts), np.int64) for k in COUNTS}
    for i, j in slices(offsets):
        part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        place = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[own])  # noqa: B023, E731
        starts, ends, first = word_spans(part, own)
        out["n_words"][i:j] = np.diff(first)
        out["word_chars"][i:j] = place(((part & 0xC0) != 0x80) & ~SPACE[part])
        out["n_symbols"][i:j] = place(SYMBOLS[part])
        doc = np.repeat(np.arange(j - i), np.diff(first))

        words = span_hashes(part, starts, ends)
        covered = np.zeros(len(words), bool)
        if len(words) > 2:
            window = mix(mix(words[:-2] * np.uint64(5) + words[1:-1]) * np.uint64(7) + words[2:]) + mix(doc[:-2].astype(np.uint64))
            inside = np.flatnonzero(doc[:-2] == doc[2:])
            again = inside[repeated(window[inside])]
            for k in range(3):
                covered[again + k] = True
        out["n_repeat_words"][i:j] = np.bincount(doc[covered], minlength=j - i)

        # Lines with a word: from the first to the last line break around each.
        breaks = np.flatnonzero(part == 10)
        low = np.union1d(np.minimum(breaks + 1, len(part)), own[:-1])
        high = np.append(low[1:], len(part))
        high = np.where((high > low) & (part[np.maximum(high - 1, 0)] == 10 if len(part) else False), high - 1, high)
        has = np.searchsorted(starts, high) > np.searchsorted(starts, low)
        low, high = low[has], high[has]
        line_doc = np.searchsorted(own, low, "right") - 1
        keys = mix(span_hashes(part, low, high) + (high - low).astype(np.uint64)) + mix(line_doc.astype(np.uint64))
        _, earliest = np.unique(keys, return_index=True)
        later = np.ones(len(keys), bool)
        later[earliest] = False
        out["n_dup_lines"][i:j] = np.bincount(line_doc[later], minlength=j - i)
    return out


class Batch:
    """The n-grams of some texts, for scores and gradients of a linear model over their mean features."""

    def __init__(self, texts: list[str]):
        data, offsets = raw(pa.array(texts, pa.large_string()))
        self.rows, self.groups = len(texts), list(grams(data, offsets))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.rows)
        for buckets, low, high in self.groups:
            sums = np.zeros(len(buckets) + 1)
            np.cumsum(weights[buckets], dtype=np.float64, out=sums[1:])
            out += (sums[high] - sums[low]) / np.maximum(high - low, 1)
        return out

    def gradient(self, errors: np.ndarray) -> np.ndarray:
        out = np.zeros(1 << BITS)
        for buckets, low, high in self.groups:
            each = errors / np.maximum(high - low, 1)
            change = np.zeros(len(buckets) + 1)
            np.add.at(change, low, each)
            np.subtract.at(change, high, each)
            out += np.bincount(buckets, np.cumsum(change)[:-1], 1 << BITS)
        return out


def fit(texts: list[str], y: np.ndarray, epochs: int = 4, rate: float = 0.5, ridge: float = 1e-6, batch_bytes: int = 128 << 10, seed: int = 7) -> tuple[np.ndarray, float, float]:
    """(weights by bucket, a, b): the probability of label 1 is sigmoid(a * mean score + b).

    AdaGrad over minibatches of about batch_bytes of text on four fifths of the rows; the rest calibrate. Features are made anew for each batch, so
    memory is the model's and a batch's. With one class only, a constant: its smoothed share.
    """
    weights = np.zeros(1 << BITS, np.float32)
    if len(y) < 10 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 1) if len(y) else 1.0
        return weights, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    train = np.arange(len(y)) % 5 != 4
    sizes = np.array([len(t) for t in texts])
    balance = np.where(y > 0, 0.5 / max(y[train].mean(), 1e-9), 0.5 / max(1 - y[train].mean(), 1e-9))
    rng, squares, bias = np.random.default_rng(seed), np.full_like(weights, 1e-8), 0.0

    def parts(rows: np.ndarray):
        at = np.concatenate([[0], np.cumsum(sizes[rows])])
        return [rows[i:j] for i, j in slices(at, batch_bytes)]

    for _ in range(epochs):
        for rows in parts(rng.permutation(np.flatnonzero(train))):
            batch = Batch([texts[k] for k in rows])
            errors = (sigmoid(batch.scores(weights) + bias) - y[rows]) * balance[rows] / len(rows)
            slope = batch.gradient(errors).astype(np.float32) + ridge * weights
            squares += slope * slope
            weights -= rate * slope / np.sqrt(squares)
            bias -= rate * errors.sum()
    every = np.concatenate([Batch([texts[k] for k in rows]).scores(weights) for rows in parts(np.arange(len(y)))])
    rest = ~train if len(set(y[~train])) == 2 else np.ones(len(y), bool)
    return weights, *calibrate(every[rest], y[rest])


def quality_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = 3000, min_words: int = 50, max_repeat_percent: int = 50, threshold: float = 0.5) -> DataFrame:
    """docs with COUNTS (long), base_failed (boolean), quality_score (double) and kept (boolean).

    base_failed: fewer than min_words words, or more than max_repeat_percent of them in repeated 3-word windows. Others are
    kept if the model's probability of labels.quality = 1 reaches threshold. The model is fitted on at most
    sample_rows labelled rows (see labelled()); everything else covers all rows and whole texts, in one pass
    without a shuffle. The model is one table of 2^18 floats, whatever the data. Null texts count as empty: no words, so
    base_failed. Without labels nothing but the base rules rejects. Empty tables give an empty result.
    """
    weights, a, b = fit(*labelled(docs, labels, "quality", sample_rows))
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        def run(batch):
            texts = strings(batch, "text")
            found = counts(texts)
            failed = (found["n_words"] < min_words) | (100 * found["n_repeat_words"] > max_repeat_percent * found["n_words"])
            score = sigmoid(a * mean_scores(model.value, texts) + b)
            return {k: pa.array(v) for k, v in (found | {"base_failed": failed, "quality_score": score, "kept": ~failed & (score >= threshold)}).items()}

        return run

    return annotate(docs, make, {k: "long" for k in COUNTS} | {"base_failed": "boolean", "quality_score": "double", "kept": "boolean"})
