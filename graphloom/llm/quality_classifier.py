"""Quality classifier: supervised subword embeddings averaged per document, softmax, trained by numpy SGD."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import annotate, labelled, sigmoid, strings
from graphloom.llm.ngrams import BITS, GROUPS, mean_scores, sparse_rows


def folds(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def fit(texts: list[str], y: np.ndarray, dim: int = 10, epochs: int = 6, rate: float = 1.0, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embeddings by bucket, output weights dim x 2, output bias): each document's vector is the mean over groups of its
    n-grams' mean vector; softmax over two labels; one document a step, with a falling rate."""
    rng = np.random.default_rng(seed)
    table = (rng.standard_normal((1 << BITS, dim)) / dim).astype(np.float32)
    out, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    if not len(y):
        return table, out, bias
    if y.min() == y.max():
        bias[y[0]] = np.log(len(y) + 1)
        return table, out, bias
    ids, values, starts = sparse_rows(texts)
    values = values / np.float32(GROUPS)
    cost = len(y) / (2 * np.bincount(y, minlength=2))
    steps, done = epochs * len(y), 0
    for _ in range(epochs):
        for k in rng.permutation(len(y)):
            here, v = ids[starts[k] : starts[k + 1]], values[starts[k] : starts[k + 1]]
            hidden = v @ table[here]
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[k]] -= 1
            step = np.float32(rate * (1 - done / steps) * cost[y[k]])
            back = out @ p
            out -= step * 0.1 * np.outer(hidden, p)
            bias -= step * 0.01 * p
            table[here] -= np.outer(step * np.minimum(v * len(here), 20) / 10, back)
            done += 1
    return table, out, bias


def quality_classifier(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample_rows: int = 3000, threshold: float = 0.3) -> DataFrame:
    """docs with score (double, 0 to 1: the probability of labels.quality = 1) and predicted (int).

    Learns from at most sample_rows labelled rows for which learn holds; only the text is an input. The logit of a text is
    linear in its mean n-gram vector, so scoring gathers one number an n-gram from a table of 2^18 floats. Null texts count
    as empty and get the bias alone. Without labels every score is 0.5. Repeated rows score alike.
    """
    table, out, bias = fit(*labelled(docs, labels, "quality", sample_rows, learn))
    line = (table @ (out[:, 1] - out[:, 0]) / GROUPS).astype(np.float32)
    offset = float(bias[1] - bias[0])
    model = docs.sparkSession.sparkContext.broadcast(line)

    def make():
        def run(batch):
            score = sigmoid(mean_scores(model.value, strings(batch, "text")) + offset)
            return {"score": pa.array(score), "predicted": pa.array((score >= threshold).astype(np.int32))}

        return run

    return annotate(docs, make, {"score": "double", "predicted": "int"})
