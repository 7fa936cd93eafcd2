"""Ranked lexical search: byte impacts rounded up bound every score, documents whose bound reaches the k-th are scored exactly."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm.common import LOWER, NO_ID, id_of, raw, slices, span_hashes, strings, text_of, word_spans, written
from graphloom.llm.spelling import lower_ascii

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A query block holds about so many items and (item, term) pairs, so that its weights are a table of bounded size in every task.
BLOCK_ITEMS, BLOCK_PAIRS = 256, 1 << 14
#: Numbers of the table of a block of documents against the query block's terms.
TABLE_VALUES = 1 << 21
#: An impact is below 10^6; as a byte it counts in steps of so much, rounded up.
STEP = 4096
#: Parts that the candidates of an item are ranked in before they meet.
PARTS = 32

# Every byte as it counts in a term: letters lower-cased, digits, bytes of other characters; 32 for all that separates terms.
FOLDED = np.full(256, 32, np.uint8)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    FOLDED[_low:_high] = LOWER[_low:_high]


class Terms:
    """The distinct terms of a query block, found in texts by their 64-bit hash and length."""

    def __init__(self, terms: list[str]):
        data, offsets = raw(pa.array(terms, pa.large_string()))
        hashes = span_hashes(data, offsets[:-1], offsets[1:])
        self.order = np.argsort(hashes)
        self.hashes, self.lengths = hashes[self.order], np.diff(offsets)[self.order]

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(terms in all of each text; and by text, then term: number of different ones of the block, these, their occurrences)."""
        data, offsets = raw(texts)
        total, kinds, found, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in slices(offsets):
            part = FOLDED[data[offsets[i] : offsets[j]]]
            starts, ends, first = word_spans(part, offsets[i : j + 1] - offsets[i])
            total.append(np.diff(first))
            hashes = span_hashes(part, starts, ends)
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = np.flatnonzero((self.hashes[at] == hashes) & (self.lengths[at] == ends - starts))
            text = np.repeat(np.arange(j - i), total[-1])[hit]
            keys, n = np.unique(text * len(self.order) + self.order[at[hit]], return_counts=True)
            kinds.append(np.bincount(keys // len(self.order), minlength=j - i))
            found.append(keys % len(self.order))
            times.append(n)
        return tuple(np.concatenate(x) for x in (total, kinds, found, times))


def postings(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, times) of every row with a term: how many it has in all, and which of `terms` (numbers in that list) how often."""

    def run(batches):
        known = Terms(terms)
        for batch in batches:
            n, kinds, found, times = known.count(strings(batch, "text"))
            ends = pa.array(np.concatenate([[0], np.cumsum(kinds)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (found, times)]
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "times"])
            yield out.filter(pa.array(n > 0))

    return docs.select(id_of().alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def impacts(times: np.ndarray, n: np.ndarray, texts: int, total: int) -> np.ndarray:
    """What an occurring term counts, before its weight: times of it in a document of n terms, in whole numbers."""
    times, m = times.astype(np.int64), 75 + (25 * n * texts) // total
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


class Ranking:
    """The k best documents of each item of a query block, by score and then the least id, over blocks of documents."""

    def __init__(self, weights: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], k: int, texts: int, total: int):
        self.pairs, self.k, self.texts, self.total = [(t, weights[t] * q) for t, q in pairs], k, texts, total
        self.table = np.zeros((len(weights), len(pairs)), np.float32)
        for item, (t, w) in enumerate(self.pairs):
            self.table[t, item] = w
        # Sums of so many 32-bit products lie below the true ones by no more than this.
        self.margin = 1 + (len(weights) + 4) * 2.0**-23
        self.scores = [np.zeros(0, np.int64)] * len(pairs)
        self.ids = [np.zeros(0, np.int64)] * len(pairs)
        self.floor = np.ones(len(pairs))  # a score below can't be among the best; at first, one must be above 0

    def add(self, ids: np.ndarray, n: np.ndarray, kinds: np.ndarray, terms: np.ndarray, times: np.ndarray) -> int:
        """Take documents: their ids and numbers of terms, and as in Terms.count. Returns how many scores were made exactly."""
        rows = np.repeat(np.arange(len(ids)), kinds)
        exact = np.zeros((len(ids), len(self.table)), np.int64)
        exact[rows, terms] = impacts(times, n[rows], self.texts, self.total)
        upper = ((exact + (STEP - 1)) // STEP).astype(np.uint8).astype(np.float32) @ self.table
        upper = upper.astype(np.float64) * (STEP * self.margin)
        # A byte b stands for more than b - 1 steps; a document's least byte is that of a single occurrence.
        least = (impacts(np.ones_like(n), n, self.texts, self.total) + (STEP - 1)) // STEP
        if len(ids) >= self.k:
            lower = upper * ((least - 1) / np.maximum(least, 1) / self.margin**2)[:, None]
            self.floor = np.maximum(self.floor, np.partition(lower, len(ids) - self.k, axis=0)[len(ids) - self.k])
        row, item = np.nonzero(upper >= self.floor)
        order = np.argsort(item, kind="stable")
        row, bounds = row[order], np.searchsorted(item[order], np.arange(len(self.pairs) + 1))
        for i in np.flatnonzero(np.diff(bounds)).tolist():
            own = row[bounds[i] : bounds[i + 1]]
            t, w = self.pairs[i]
            scores = np.concatenate([self.scores[i], exact[np.ix_(own, t)] @ w])
            ids_ = np.concatenate([self.ids[i], ids[own]])
            best = np.lexsort((ids_, -scores))[: self.k]
            best = best[scores[best] > 0]
            self.scores[i], self.ids[i] = scores[best], ids_[best]
            if len(best) == self.k:
                self.floor[i] = max(self.floor[i], scores[best[-1]])
        return len(row)


def _ranked(index: DataFrame, items: list[int | None], ranking: Ranking) -> DataFrame:
    """(item_id, doc_id, score): each task's k best documents of every item."""
    width = max(64, TABLE_VALUES // max(1, len(ranking.table)))

    def run(batches):
        best = ranking
        for batch in batches:
            for at in range(0, batch.num_rows, width):
                part = batch.slice(at, width)
                lists = [part.column(c) for c in ("terms", "times")]
                best.add(part.column("doc_id").to_numpy(), part.column("n").to_numpy(), np.diff(lists[0].offsets.to_numpy()), *(x.flatten().to_numpy() for x in lists))
        item = np.repeat(np.arange(len(items)), [len(x) for x in best.ids])
        ids, scores = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (best.ids, best.scores))
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()).take(pa.array(item)), pa.array(ids), pa.array(scores)], names=["item_id", "doc_id", "score"])

    return index.mapInArrow(run, "item_id long, doc_id long, score long")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The k highest-scoring documents of every item: item_id, rank (int, from 1), doc_id, score (long).

    An item's terms weigh w = floor(1000 ln((2N + 2) / (2 df + 1))), a document of n terms with tf of one adds w * (10^9 tf div (1000 tf + 12 m)),
    m = 75 + (25 n N div L); N documents have a term, L terms in all, df of them hold one. Equal scores stand by ascending doc_id.

    Items are dealt into query blocks of bounded size. For each the documents are scanned once, to postings of the block's terms in
    Parquet. First level: impacts are bytes, rounded up, and one product of a block of documents with the items' weights bounds all scores.
    Second level: each document whose bound reaches the k-th lower bound so far is scored exactly in whole numbers. A task keeps k documents an
    item; these meet in windows of parts, then of items. Terms are told apart by a 64-bit hash and their length.

    Rows of one item_id are one item (their terms count together), null too; an item without terms, or whose terms occur nowhere, has no
    row. Every row of docs is a document, those of a repeated or null doc_id too; null texts have no term. Empty tables give an empty one.
    """
    spark = docs.sparkSession
    term = F.explode(F.regexp_extract_all(text_of(), F.lit(TERM), F.lit(0)))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), term.alias("term")).groupBy("item_id", lower_ascii(F.col("term")).alias("term")).agg(F.count("*").alias("q"))
    asked = written(asked)
    sizes = asked.agg(F.count("*").alias("pairs"), F.countDistinct(id_of("item_id")).alias("items")).first()
    n_blocks = max(1, math.ceil(sizes["pairs"] / BLOCK_PAIRS), math.ceil(sizes["items"] / BLOCK_ITEMS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for block in range(n_blocks):
        own = asked.where(F.col("block") == block).sort("item_id", "term").toArrow()  # about BLOCK_PAIRS rows
        if not len(own):
            continue
        terms, item = (own.column(c).combine_chunks().dictionary_encode(null_encoding="encode") for c in ("term", "item_id"))
        names, ids = terms.dictionary.to_pylist(), item.dictionary.to_pylist()
        terms, item, q = terms.indices.to_numpy(), item.indices.to_numpy(), own.column("q").to_numpy()
        index = written(postings(docs, names))
        sums = index.agg(F.count("*").alias("texts"), F.sum("n").alias("total")).first()
        df = np.zeros(len(names), np.int64)
        for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a number for each term of the block
            df[r["t"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * sums["texts"] + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        if sums["texts"]:
            pairs = [(terms[item == i], q[item == i]) for i in range(len(ids))]
            found = found.unionByName(_ranked(index, ids, Ranking(weights, pairs, k, sums["texts"], sums["total"])))
    order = (F.desc("score"), F.asc("doc_id"))
    part = F.row_number().over(W.partitionBy("item_id", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).orderBy(*order))
    best = found.withColumn("rank", part).where(F.col("rank") <= k).drop("rank")
    best = best.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return best.select("item_id", "rank", F.nullif(F.col("doc_id"), F.lit(NO_ID)).alias("doc_id"), "score")
