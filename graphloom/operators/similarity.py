"""Vector similarity: pending embeddings, exact top-k neighbours by blocks of queries, and their edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Numbers of the vectors of a block, at most; and how many blocks a table is dealt to if each has LEAST_VALUES. So what is sent grows
#: with the table, until blocks are full.
BLOCK_VALUES, BLOCKS, LEAST_VALUES = 1 << 22, 12, 1 << 16
#: Queries of a block that are scored together, and scores that are held at once.
STRIP, TILE = 256, 1 << 19
#: Candidates a place above which a tile is thinned out before they are scored exactly.
CROWD = 4


def pending(documents: DataFrame, limit: int = 0) -> DataFrame:
    """Documents with a summary but no embedding yet, in the order of their ids; limit 0 is none."""
    rows = documents.where((F.coalesce("summary_text", F.lit("")) != "") & F.col("summary_embedding").isNull()).orderBy("document_uuid")
    return rows.limit(limit) if limit else rows


def _unit(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of length 1 (zeros stay)."""
    rows = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(vectors), -1)
    norms = np.linalg.norm(rows, axis=1)
    return rows / np.where(norms > 0, norms, 1)[:, None]


class Nearest:
    """The k best of each of asked among vectors that come tile by tile; equal scores by place. Scores in single precision choose the
    candidates, with its error to spare; these are scored in double precision."""

    def __init__(self, asked: np.ndarray, k: int, floors: np.ndarray):
        self.asked, self.rough, self.k, self.floors = asked, asked.astype(np.float32), k, floors
        self.slack = (asked.shape[1] + 16) * 1.2e-7
        self.last = np.full(len(asked), -np.inf)
        self.least = (floors - self.slack).astype(np.float32)
        self.kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def meet(self, rows: np.ndarray, known: np.ndarray, rough: np.ndarray, places: np.ndarray) -> None:
        """Score some rows of asked with known vectors, whose places ascend; rough: these in single precision."""
        step = max(1, TILE // max(1, len(rows)))
        for at in range(0, len(known) if len(rows) else 0, step):
            hit = self.rough[rows] @ rough[at : at + step].T >= self.least[rows][:, None]
            n = np.count_nonzero(hit)
            if n > CROWD * self.k * len(rows):
                hit = self._thinned(rows, known[at : at + step])
            if n:
                row, col = np.nonzero(hit)
                self.waiting.append((rows[row], places[at + col], self._exact(rows[row], known, at + col)))
                if sum(len(w[0]) for w in self.waiting) > self.k * len(self.asked) // 2:
                    self.settle()

    def _thinned(self, rows: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Which of a crowded tile may stay: of each row those above its k-th score, and the first k that equal it."""
        score = self.asked[rows] @ known.T
        far = -score.round(9)
        hit = (far <= -self.last[rows][:, None]) & (score >= self.floors[rows][:, None] - 1e-9)
        if far.shape[1] > self.k:
            cut = np.partition(far, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            hit &= (far < cut) | ((far == cut) & (np.cumsum(far == cut, axis=1) <= self.k))
        return hit

    def _exact(self, rows: np.ndarray, known: np.ndarray, cols: np.ndarray) -> np.ndarray:
        step = max(1, TILE // max(1, known.shape[1]))
        return np.concatenate([np.einsum("ij,ij->i", self.asked[rows[i : i + step]], known[cols[i : i + step]]) for i in range(0, max(1, len(rows)), step)])

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, score) of the k best so far."""
        row, place, score = (np.concatenate(c) for c in zip(self.kept, *self.waiting, strict=True))
        self.waiting = []
        order = np.lexsort((place, -score.round(9), row))
        row, place, score = row[order], place[order], score[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        full = nth == self.k - 1
        self.last[row[full]] = score[full].round(9)
        self.least = (np.maximum(self.floors, self.last) - self.slack).astype(np.float32)
        stay = (nth < self.k) & (score >= self.floors[row])
        self.kept = (row[stay], place[stay], score[stay])
        return self.kept


def _side(table: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """Ids in ascending order, and their vectors of length 1, of the last two columns."""
    ids, vectors = (c.combine_chunks() for c in table.columns[-2:])
    order = pc.sort_indices(ids)
    return ids.take(order), _unit(pa.chunked_array([vectors]))[order.to_numpy()]


def _links(asked: tuple[pa.Array, np.ndarray], known: tuple[pa.Array, np.ndarray], k: int, floor: float) -> pa.Table:
    """(src, dst, score): the k nearest known to each of asked."""
    rough, places, out = known[1].astype(np.float32), np.arange(len(known[1])), []
    for at in range(0, len(asked[1]), STRIP):
        part = asked[1][at : at + STRIP]
        top = Nearest(part, k, np.full(len(part), floor))
        top.meet(np.arange(len(part)), known[1], rough, places)
        row, place, score = top.settle()
        out.append((row + at, place, score))
    row, place, score = (np.concatenate(c) for c in zip(*out, strict=True))
    return pa.table({"src": asked[0].take(pa.array(row)), "dst": known[0].take(pa.array(place)), "score": score})


def blocks_of(values: int, most: int, blocks: int) -> int:
    """How many blocks so many numbers make, of at most so many each."""
    return max(1, -(-values // most), min(blocks, values // LEAST_VALUES))


def nearest(vectors: DataFrame, k: int, queries: DataFrame | None = None, min_score: float = -2.0) -> DataFrame:
    """(src, dst, score, rank) of the k nearest of vectors(id, v) to each query by cosine, the query itself among them; ties by id.

    queries: a subset of vectors, all by default. min_score: neighbours below it are left out. Vectors are dealt to blocks by a hash of their
    id; each block of queries meets each block of vectors in a task of its own, which keeps k candidates a query, and these meet in a
    window. Where all ask, a task answers both ways for its two blocks, so that half the pairs of blocks do. A vector is sent once for each block of
    the other side, in its own precision. Nothing passes through the driver. Null vectors are left out.
    """
    vectors = vectors.where(F.col("v").isNotNull()).select("id", "v")
    asked = vectors if queries is None else vectors.join(queries.select("id").distinct(), "id", "left_semi")
    block_of = lambda blocks: F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    n, m = (blocks_of(df.agg(F.sum(F.size("v"))).first()[0] or 0, BLOCK_VALUES, BLOCKS) for df in ((vectors,) * 2 if queries is None else (asked, vectors)))
    low, high = (block_of(n), block_of(m)) if queries is None else (F.lit(0), F.lit(n - 1))  # a pair of blocks once, if all ask
    left = asked.select(block_of(n).alias("i"), F.explode(F.sequence(low, F.lit(m - 1))).alias("j"), "id", "v").groupBy("i", "j")
    right = vectors.select(F.explode(F.sequence(F.lit(0), high)).alias("i"), block_of(m).alias("j"), F.col("id").alias("key"), F.col("v").alias("w")).groupBy("i", "j")
    kind = vectors.schema["id"].dataType.simpleString()
    result = f"src {kind}, dst {kind}, score double"
    none = vectors.sparkSession.createDataFrame([], result).toArrow()
    both = queries is None

    def run(key: tuple, one: pa.Table, other: pa.Table) -> pa.Table:
        if not len(one) or not len(other) or k < 1:  # a group without rows of one side has no columns there
            return none
        a, b = _side(one), _side(other)
        tables = [_links(a, b, k, min_score)] + ([_links(b, a, k, min_score)] if both and key[0] != key[1] else [])
        return pa.concat_tables(tables)

    order = W.partitionBy("src").orderBy(F.round("score", 9).desc(), "dst")
    return left.cogroup(right).applyInArrow(run, result).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def similar_edges(vectors: DataFrame, top_k: int = 10, max_edges_per_doc: int | None = None, min_score: float = 0.75, limit_docs: int = 0, score_scale: str = "raw", within: DataFrame | None = None) -> DataFrame:
    """SIMILAR_TO (src, dst, score): of each document's k nearest those that are others and score min_score; directed. The document itself
    takes one of the k places. limit_docs: so many documents ask, in the order of ids; 0 is all. score_scale: raw cosine, or
    'unit' for (1 + cosine) / 2. within: (id) of one project, whose documents alone ask and answer, though all vectors compete for the k
    places."""
    k = max_edges_per_doc if max_edges_per_doc is not None else top_k
    asking = vectors.select("id") if within is None else vectors.select("id").join(within.select("id").distinct(), "id", "left_semi")
    asking = asking.orderBy("id").limit(limit_docs) if limit_docs else asking
    raw = min_score if score_scale == "raw" else 2 * min_score - 1
    rows = nearest(vectors, k, asking if limit_docs or within is not None else None, raw - 1e-9)
    if within is not None:
        rows = rows.join(within.select(F.col("id").alias("dst")).distinct(), "dst", "left_semi")
    score = F.col("score") if score_scale == "raw" else (1 + F.col("score")) / 2
    return edges(rows.withColumn("score", score), k, min_score)


def edges(rows: DataFrame, k: int, min_score: float) -> DataFrame:
    """SIMILAR_TO (src, dst, score) of nearest()'s rows: of the first k places those that are others and score min_score."""
    return rows.where((F.col("rank") <= k) & (F.col("src") != F.col("dst")) & (F.col("score") >= min_score)).select("src", "dst", "score")
