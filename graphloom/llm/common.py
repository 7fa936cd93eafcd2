"""Helpers shared by the operators: lineage cuts, Arrow text access, vectorised word hashing, range buckets."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
NO_ID = -(1 << 63)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a local session (tests) gets a folder
    of its own and a cluster an error, since executors could not read the driver's."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="graphloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_of(column: str = "doc_id") -> Column:
    """The id as a long that is never null: a null id sorts before all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def strings(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column of a batch as large_string without nulls."""
    return pc.fill_null(batch.column(name).cast(pa.large_string()), "")


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large_string array without nulls; offsets start at 0."""
    offsets = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1 + arr.offset)[arr.offset :]
    if not len(arr) or arr.buffers()[2] is None:
        return np.empty(0, np.uint8), offsets - (offsets[0] if len(offsets) else 0)
    data = np.frombuffer(arr.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of about limit bytes each; a longer text is alone. Bounds the numpy work arrays."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Base of the polynomial word hash, its inverse modulo 2^64, and the finaliser's multipliers.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: The tables of powers hold 2^TABLE entries, whatever the text; longer ones are gone through in pieces.
TABLE = 16


def table(base: int) -> np.ndarray:
    """The first 2^TABLE powers of base. Kept for the life of the process, but not in this module, with which it would be pickled into every function."""
    known = worker_store("powers")
    if base not in known:
        x = np.full(1 << TABLE, base, np.uint64)
        x[0] = 1
        known[base] = np.cumprod(x, dtype=np.uint64)
    return known[base]


def scaled(values: np.ndarray, base: int) -> np.ndarray:
    """values[i] * base^i, in place."""
    powers = table(base)
    for at in range(0, len(values), 1 << TABLE):
        part = values[at : at + (1 << TABLE)]
        part *= powers[: len(part)] * np.uint64(pow(base, at, 1 << 64))
    return values


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Sums over the first i bytes of (byte + 1) * BASE^i."""
    sums = np.zeros(len(data) + 1, np.uint64)
    sums[1:] = data
    sums[1:] += np.uint64(1)
    np.cumsum(scaled(sums[1:], BASE), out=sums[1:])
    return sums


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, on a uint64 array."""
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of all texts, and the number of words before each text (and in all)."""
    solid = np.zeros(len(data) + 2, bool)
    np.logical_not(SPACE[data], out=solid[1:-1])
    begins = solid[1:] & ~solid[:-1]
    closes = solid[:-1] & ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    both = inner[solid[inner] & solid[inner + 1]]  # words that touch across a text's end
    begins[both] = closes[both] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes)
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial by prefix sums, then a finaliser."""
    sums = byte_sums(data)
    low, high = table(BASE_INV)[starts & ((1 << TABLE) - 1)], starts >> TABLE
    above = np.array([pow(BASE_INV, k << TABLE, 1 << 64) for k in range((len(data) >> TABLE) + 1)], np.uint64)
    return mix((sums[ends] - sums[starts]) * low * above[high])


def pack(docs: DataFrame, **columns: Column) -> DataFrame:
    """All columns of docs as one struct _row, so that their names can't clash with an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(k) for k, c in columns.items()])


def unpack(df: DataFrame, columns: list[str], **added: Column) -> DataFrame:
    """The columns of docs again, then the added ones; an added column replaces one of its name."""
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns if c not in added], *[c.alias(k) for k, c in added.items()])


def worker_store(name: str) -> dict:
    """A dict that lives as long as its Python worker, across tasks; holders bound its size themselves."""
    import sys

    return sys.__dict__.setdefault(f"_graphloom_{name}", {})


def annotate(docs: DataFrame, make, added: dict) -> DataFrame:
    """docs with columns added by make()(batch) -> dict of Arrow arrays, batch by batch; one of the same name is replaced.

    added: DDL type by name. make is called once in each task.
    """
    from pyspark.sql import types as T

    keep = [c for c in docs.columns if c not in added]
    ddl = T._parse_datatype_string(", ".join(f"`{k}` {v}" for k, v in added.items()))
    schema = T.StructType([docs.schema[c] for c in keep] + list(ddl.fields))
    names = keep + list(added)

    def run(batches):
        fn = make()
        for batch in batches:
            new = fn(batch)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [new[k] for k in added], names=names)

    return docs.mapInArrow(run, schema)


def labelled(docs: DataFrame, labels: DataFrame, column: str, rows: int, learn=None) -> tuple[list[str], np.ndarray]:
    """(texts, labels 0/1) of at most rows labelled documents, on the driver: the bounded sample a model is fitted on.

    Documents are taken in the order of a hash of their id, so the choice depends on nothing else. learn: predicate on
    doc_id of rows that may be learned from. Null labels and null ids are left out; of a document labelled twice the least
    label counts; of repeated rows the least text.
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y")).dropna()
    if learn is not None:
        labels = labels.where(learn)
    labels = labels.groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = texts.join(F.broadcast(labels), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # labels: at most rows
    got = found.sort("doc_id").select("text", "y").toArrow()
    return got.column("text").to_pylist(), (got.column("y").to_numpy() > 0).astype(np.int64)


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Platt scaling: (a, b) of sigmoid(a * x + b) by Newton's method, with Platt's smoothed targets."""
    n1, n0 = int(y.sum()), int((1 - y).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design = np.stack([x, np.ones_like(x)], 1).astype(float)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - target) + ridge * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def by_range(docs: DataFrame, key: Column, target: int = 16 << 20, most: int = 50_000) -> tuple[DataFrame, list[int]]:
    """(docs with _bucket, cut points): ascending ranges of the long key with about target bytes of text each, or total / most if that is more.

    Bytes are summed by the key's high bits, and by more of them where one sum is above target, until they are below or the key is whole;
    so the cut points depend on the rows alone, and the sums at the driver are some for each range. All rows of one key are in one range.
    The lookup is an Arrow UDF on the key alone.
    """
    sized = docs.select(key.alias("k"), F.octet_length(text_of()).alias("b"))
    stats = sized.agg(F.sum("b").alias("bytes"), F.min("k").alias("low"), F.max("k").alias("high")).first()
    target = max(target, (stats["bytes"] or 0) // most)
    points: list[int] = []
    if (stats["bytes"] or 0) > target:
        shift = max(0, ((stats["high"] >> 12) - (stats["low"] >> 12)).bit_length())
        found: dict[int, int] = {}  # bytes by the last key of a span of keys
        heavy: list[int] | None = None  # the high bits that are looked at again with more of them
        while heavy is None or heavy:
            here = sized.withColumn("x", F.shiftright("k", shift))
            if heavy is not None:
                coarse = docs.sparkSession.createDataFrame([(x,) for x in heavy], "c long")
                here = here.join(F.broadcast(coarse), F.shiftright("k", above) == F.col("c"))  # at most one for each range
            heavy, above = [], shift
            for r in here.groupBy("x").agg(F.sum("b").alias("b")).collect():
                if r["b"] > target and shift > 0:
                    heavy.append(r["x"])
                else:
                    found[((r["x"] + 1) << shift) - 1] = r["b"]
            shift = max(0, shift - 8)
        held = 0
        for last in sorted(found):
            if held and held + found[last] > target:
                points.append(before)
                held = 0
            held, before = held + found[last], last
    edges = np.array(points, np.int64)

    @F.pandas_udf("int")
    def bucket(keys):
        import pandas as pd

        return pd.Series(np.searchsorted(edges, keys.to_numpy(), "left").astype(np.int32))

    return docs.withColumn("_bucket", bucket(key)), points


def written(df: DataFrame) -> DataFrame:
    """df written as Parquet under the shared folder and read again. The result reads that table whenever it is used, so the table
    stays until the folder is cleared, as checkpoints do."""
    import uuid

    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
