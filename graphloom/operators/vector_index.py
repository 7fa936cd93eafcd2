"""An inverted file over vectors: cells of a spherical k-means, searched in the cells nearest to a query, or exactly by the cells' reach."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.operators import similarity
from graphloom.operators.similarity import BLOCK_VALUES, _unit
from graphloom.plans.lineage import cut

#: Numbers of the centroids, which every task holds, and of the sample they are learned on.
CENTROID_VALUES, SAMPLE_VALUES = 1 << 22, 1 << 23
#: Sampled vectors a cell, and rounds of learning.
PER_CELL, ROUNDS = 48, 8
#: Angles are compared with this much to spare, as they come from rounded cosines.
SLACK = 1e-6
#: Blocks of cells, and parts of a block's queries, if each has similarity.LEAST_VALUES; queries scored together; scores of centroids held at once.
BLOCKS, STRIP, VISITS = 6, 2048, 1 << 20
#: Bytes of a file of a cell's vectors.
FILE_BYTES = 1 << 26


def learned(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of length 1 of unit vectors. A cell that loses all its vectors takes one of those farthest from their own centroid."""
    centroids = sample[np.linspace(0, len(sample) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        own, best = _closest(sample, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=cells) == 0)
        sums[empty] = sample[np.argsort(best, kind="stable")[: len(empty)]]
        norms = np.linalg.norm(sums, axis=1)
        centroids = np.where(norms[:, None] > 0, sums / np.where(norms > 0, norms, 1)[:, None], centroids)
    return centroids


def _closest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, and its cosine."""
    own, best = np.zeros(len(rows), np.int64), np.zeros(len(rows))
    step = max(1, VISITS // len(centroids))
    for at in range(0, len(rows), step):
        score = rows[at : at + step] @ centroids.T
        own[at : at + step] = score.argmax(1)
        best[at : at + step] = score.max(1)
    return own, best


@dataclass(frozen=True)
class VectorIndex:
    """Rows (id, v) in folders by cell; cells (cell, n, reach): how many vectors, and the widest angle of one to the centroid."""

    rows: DataFrame
    cells: DataFrame
    centroids: np.ndarray


def build(vectors: DataFrame, path: str, cells: int | None = None) -> VectorIndex:
    """Write an index of vectors(id, v) under path. Null vectors are left out; all others are assigned, whatever their number.

    Centroids are learned on a bounded sample in the order of a hash of the id: PER_CELL vectors a cell, at most SAMPLE_VALUES numbers. cells: by
    default the square root of the number of vectors, at most CENTROID_VALUES numbers. Vectors of length 0 stand in one cell.
    """
    spark = vectors.sparkSession
    vectors = vectors.where(F.col("v").isNotNull()).select("id", F.col("v").cast("array<double>").alias("v"))
    total, dim = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    cells = min(cells or math.isqrt(max(0, total - 1)) + 1, max(1, CENTROID_VALUES // max(1, dim or 1)))
    size = max(1, min(cells * PER_CELL, SAMPLE_VALUES // max(1, dim or 1)))
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(size).select("v").toArrow().column("v")
    centroids = learned(_unit(sample), min(cells, len(sample))) if len(sample) else np.zeros((1, 1))
    kind = f"{vectors.schema['id'].simpleString().replace(':', ' ', 1)}, v array<double>, angle double, cell int"

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                own, best = _closest(_unit(pa.chunked_array([batch.column("v")])), centroids)
                more = [pa.array(np.arccos(np.clip(best, -1, 1))), pa.array(own.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=["id", "v", "angle", "cell"])

    # a cell is one file, one that the sample shows to be large so many that each has about FILE_BYTES
    share = np.bincount(_closest(_unit(sample), centroids)[0], minlength=len(centroids)) / len(sample) if len(sample) else np.zeros(1)
    pieces = F.element_at(F.lit(np.maximum(1, np.ceil(share * total * 8 * (dim or 1) / FILE_BYTES)).astype(int).tolist()), F.col("cell") + 1)
    vectors.mapInArrow(assign, kind).repartition("cell", F.pmod(F.xxhash64("id"), pieces)).write.partitionBy("cell").mode("overwrite").parquet(f"{path}/rows")
    rows = _rows(spark, path, kind)
    rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("reach")).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    spark.createDataFrame([(i, c.tolist(), kind) for i, c in enumerate(centroids)], "cell int, v array<double>, kind string").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> VectorIndex:
    centroids = spark.read.parquet(f"{path}/centroids").sort("cell").toArrow()  # at most CENTROID_VALUES numbers
    rows = _rows(spark, path, centroids.column("kind")[0].as_py())
    return VectorIndex(rows.select("id", "v", "cell"), spark.read.parquet(f"{path}/cells"), np.array(centroids.column("v").to_pylist()))


def _rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(kind).parquet(f"{path}/rows")


def _dealt(index: VectorIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cell, reach, block, values of the block) of all cells: consecutive cells share a block of up to BLOCK_VALUES numbers; a larger cell has its own."""
    known = index.cells.sort("cell").toArrow()  # as many rows as there are centroids
    values = known.column("n").to_numpy() * index.centroids.shape[1]
    size = max(1, -(-int(values.sum()) // similarity.blocks_of(int(values.sum()), BLOCK_VALUES, BLOCKS)))
    block = (np.cumsum(values) - values) // size
    return known.column("cell").to_numpy(), known.column("reach").to_numpy(), block, np.array([values[block == b].sum() for b in block], np.int64)


def _visits(queries: DataFrame, index: VectorIndex, probes: int, dealt: tuple, rest: bool) -> DataFrame:
    """(id, v, floor, block, cells): which cells a query visits, a row for each block of cells. These are the `probes` nearest cells, with rest all
    others that may hold a vector scoring its floor."""
    names, reach, block, _ = dealt
    own = index.centroids[names]
    width = min(probes, len(names))
    schema = f"{queries.schema['id'].simpleString().replace(':', ' ', 1)}, {queries.schema['v'].simpleString().replace(':', ' ', 1)}, floor double, block long, cells array<int>"

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, VISITS // max(1, len(names)))):
                part = batch.slice(at, max(1, VISITS // max(1, len(names))))
                score = _unit(pa.chunked_array([part.column("v")])) @ own.T
                near = np.argsort(-score, axis=1, kind="stable")[:, :width]
                wanted = np.zeros(score.shape, bool)
                np.put_along_axis(wanted, near, True, 1)
                if rest:
                    best = np.cos(np.clip(np.arccos(np.clip(score, -1, 1)) - reach - SLACK, 0, np.pi))
                    wanted = ~wanted & (best >= part.column("floor").to_numpy()[:, None] - SLACK)
                row, col = np.nonzero(wanted)
                first = np.flatnonzero(np.diff(row, prepend=-1) | np.diff(block[col], prepend=-1))
                cells = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)), pa.array(names[col].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(row[first])) for c in ("id", "v", "floor")), pa.array(block[col[first]]), cells], names=["id", "v", "floor", "block", "cells"])

    return queries.mapInArrow(run, schema) if len(names) else queries.sparkSession.createDataFrame([], schema)


def _met(visits: DataFrame, index: VectorIndex, k: int, dealt: tuple) -> DataFrame:
    """(src, dst, score): the k best of each block's visited cells for each visit. A block that many visit, or that has one large cell, is dealt to parts by
    hashes of the ids, and a vector is sent once for each part of the queries, not for each query or cell."""
    names, _, block, values = dealt
    spark, dim = visits.sparkSession, index.centroids.shape[1]
    of_cell = spark.createDataFrame([(int(c), int(b), similarity.blocks_of(int(v), BLOCK_VALUES, 1)) for c, b, v in zip(names, block, values, strict=True)], "cell int, block long, vs int")
    asked = F.count("*") * dim
    parts = F.greatest(F.lit(1), F.ceil(asked / BLOCK_VALUES), F.least(F.lit(BLOCKS), F.floor(asked / similarity.LEAST_VALUES))).cast("int").alias("qs")
    sizes = F.broadcast(visits.groupBy("block").agg(parts).join(F.broadcast(of_cell.select("block", "vs").distinct()), "block"))
    block_of = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = visits.join(sizes, "block").select("block", block_of("qs").alias("i"), every("vs").alias("j"), "id", "v", "floor", "cells").groupBy("block", "i", "j")
    rows = index.rows.join(F.broadcast(of_cell.select("cell", "block")), "cell").join(sizes, "block")
    right = rows.select("block", every("qs").alias("i"), block_of("vs").alias("j"), F.col("id").alias("key"), F.col("v").alias("w"), "cell").groupBy("block", "i", "j")
    result = f"src {visits.schema['id'].dataType.simpleString()}, dst {index.rows.schema['id'].dataType.simpleString()}, score double"
    none = spark.createDataFrame([], result).toArrow()

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not len(queries) or not len(vectors) or k < 1:  # a group without rows of one side has no columns there
            return none
        vectors = vectors.sort_by([("cell", "ascending"), ("key", "ascending")])
        ids, cells = vectors.column("key").combine_chunks(), vectors.column("cell").to_numpy()
        order = pc.sort_indices(ids).to_numpy()
        places = np.empty(len(order), np.int64)
        places[order] = np.arange(len(order))
        known, asked = _unit(vectors.column("w")), _unit(queries.column("v"))
        rough, floors = known.astype(np.float32), queries.column("floor").to_numpy()
        own, starts = np.unique(cells, return_index=True)
        ends, out = np.append(starts[1:], len(cells)), []
        for at in range(0, len(asked), STRIP):
            lists = queries.column("cells").slice(at, STRIP).combine_chunks()
            visited, whose = lists.flatten().to_numpy(), pc.list_parent_indices(lists).to_numpy()
            by_cell = np.argsort(visited, kind="stable")
            low, high = (np.searchsorted(visited[by_cell], own, side) for side in ("left", "right"))
            top = similarity.Nearest(asked[at : at + STRIP], k, floors[at : at + STRIP])
            for a, b, start, end in zip(low, high, starts, ends, strict=True):
                top.meet(whose[by_cell[a:b]], known[start:end], rough[start:end], places[start:end])
            row, place, score = top.settle()
            out.append((row + at, place, score))
        row, place, score = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"src": queries.column("id").take(pa.array(row)), "dst": ids.take(pa.array(order[place])), "score": score})

    return left.cogroup(right).applyInArrow(run, result)


def search(index: VectorIndex, queries: DataFrame, k: int, probes: int = 8, exact: bool = False, min_score: float = -1.0) -> DataFrame:
    """(src, dst, score, rank) of the k nearest indexed vectors to each of queries(id, v) by cosine; equal ones by id, as similarity.nearest().

    probes: so many of the cells nearest to a query are searched, with exact scores. exact: then every other cell whose reach lets it hold
    one as near as the k-th found, or min_score if that is more, is searched as well, so that no neighbour of min_score or more is missed. Null vectors are left out.
    """
    queries = queries.where(F.col("v").isNotNull()).select("id", "v", F.lit(min_score if exact else -2.0).alias("floor"))
    order = W.partitionBy("src").orderBy(F.round("score", 9).desc(), "dst")
    best = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    dealt = _dealt(index)
    found = best(_met(_visits(queries, index, probes, dealt, False), index, k, dealt))
    if not exact:
        return found
    found = cut(found)  # k rows a query, which are used twice
    last = found.groupBy(F.col("src").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).otherwise(-1.0).alias("kth"))
    floors = queries.join(last, "id", "left").select("id", "v", F.greatest(F.coalesce("kth", F.lit(-1.0)) - 1e-9, F.lit(min_score)).alias("floor"))
    return best(found.drop("rank").unionByName(_met(_visits(floors, index, probes, dealt, True), index, k, dealt)))


def similar_edges(index: VectorIndex, queries: DataFrame, top_k: int = 10, min_score: float = 0.75, probes: int = 8, exact: bool = False) -> DataFrame:
    """SIMILAR_TO (src, dst, score) as similarity.similar_edges(), from an index."""
    rows = search(index, queries, top_k, probes, exact, min_score)
    return rows.where((F.col("src") != F.col("dst")) & (F.col("score") >= min_score)).select("src", "dst", "score")


def recall(index: VectorIndex, vectors: DataFrame, queries: DataFrame, k: int, probes: int = 8) -> float:
    """The share of the true k nearest (similarity.nearest) that a search finds for some queries of the indexed vectors."""
    truth = similarity.nearest(vectors, k, queries).select("src", "dst")
    found = search(index, vectors.join(queries.select("id").distinct(), "id", "left_semi"), k, probes).select("src", "dst")
    return truth.join(found, ["src", "dst"], "left_semi").count() / max(1, truth.count())
