"""Document fingerprints: canonical exact digests, grouped by a wide hash and compared byte for byte inside a group."""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import annotate, by_range, cut, id_of, pack, strings, text_of, unpack


def canonical(text: str) -> str:
    """NFKC, case folding (normalised again, as folding can undo it), runs of white space as one space, trimmed."""
    if text.isascii():
        return " ".join(text.lower().split())
    return " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold()).split())


def digest(canon: bytes, bits: int = 128) -> str:
    """Hex xxh3-128 of a canonical text; fewer bits only to provoke collisions in tests."""
    return xxhash.xxh3_128_hexdigest(canon)[: bits // 4]


#: Bits of the bitmap by which rows whose digest no other row has are passed over: 8 MB, whatever the data.
BITMAP = 26
#: Above so many colliding digests their table is joined by shuffle, not broadcast.
BROADCAST_CLASHES = 10_000


def prefix(column: Column) -> Column:
    """The first BITMAP bits of a hex digest (left-aligned if it is shorter) as a long."""
    return F.shiftright(F.conv(F.rpad(F.substring(column, 1, 8), 8, "0"), 16, 10).cast("long"), 32 - BITMAP)


def digests(docs: DataFrame, bits: int) -> DataFrame:
    """The columns of docs with _digest, _strong (a second, 128-bit digest) and _canon of the column _text."""

    def make():
        def run(batch):
            canons = [canonical(t).encode() for t in strings(batch, "_text").to_pylist()]
            return {"_digest": pa.array([digest(c, bits) for c in canons], pa.string()), "_strong": pa.array([strong(c) for c in canons], pa.string()), "_canon": pa.array([c.decode() for c in canons], pa.string())}

        return run

    return annotate(docs, make, {"_digest": "string", "_strong": "string", "_canon": "string"}).drop("_text")


def clashes(keys: DataFrame, docs: DataFrame, bits: int) -> DataFrame:
    """_key (hash of the digest) of the groups in which canonical bytes differ: real collisions, normally none.

    keys has _digest and _strong of every row of docs, and of texts made of them that are not kept: these are told apart by the second,
    independent digest inside a group. Digests of several rows set a bit of a bitmap of fixed size; the texts
    of rows without their bit are passed over, the others meet by digest as least and greatest bytes, combined on the map
    side, so that a group of a third of all rows is one row a task. A fuller bitmap only lets more texts through.
    """
    key, other = F.xxhash64("_digest").alias("_key"), F.xxhash64("_strong").alias("_other")
    groups = keys.select(key, other, prefix(F.col("_digest")).alias("x")).groupBy("_key").agg(F.count("*").alias("n"), F.min("_other").alias("a"), F.max("_other").alias("z"), F.min("x").alias("x"))
    several = cut(groups.where("n > 1"))
    parts = several.groupBy(F.bitmap_bucket_number(F.col("x") + 1).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("x") + 1)).alias("m")).collect()
    bitmap = np.zeros(1 << BITMAP >> 3, np.uint8)
    for r in parts:  # at most 2^BITMAP bits in all
        at = (r["b"] - 1) * 4096
        bitmap[at : at + 4096] = np.frombuffer(bytes(r["m"]), np.uint8)[: len(bitmap) - at]
    marked = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        seen = marked.value
        for batch in batches:
            got = []
            for t in strings(batch, "_text").to_pylist():
                canon = canonical(t)
                d = digest(canon.encode(), bits)
                x = int(d[:8].ljust(8, "0"), 16) >> (32 - BITMAP)
                if seen[x >> 3] >> (x & 7) & 1:
                    got.append((d, canon))
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.string()) for i in range(2)], names=["_digest", "_canon"])

    shared = docs.select(text_of().alias("_text")).mapInArrow(run, "_digest string, _canon string")
    unlike = shared.groupBy("_digest").agg(F.min("_canon").alias("_a"), F.max("_canon").alias("_z")).where("_a <> _z").select(key)
    return cut(unlike.union(several.where("a <> z").select("_key")).distinct().withColumn("_clash", F.lit(True)))


def resolved(rows: DataFrame, clash: DataFrame, named: dict[str, tuple[str, str]]) -> DataFrame:
    """rows with fingerprints: by name, from (digest, strong) columns; only digests in clash take the second digest as well."""
    few = clash.limit(BROADCAST_CLASHES + 1).count() <= BROADCAST_CLASHES
    for name, (d, s) in named.items():
        side = clash.withColumnRenamed("_key", "_on")
        rows = rows.join(F.broadcast(side) if few else side, F.xxhash64(d) == F.col("_on"), "left")
        rows = rows.withColumn(name, F.when(F.col("_clash"), F.concat(d, F.lit("-"), s)).otherwise(F.col(d))).drop("_on", "_clash")
    return rows


def fingerprints(docs: DataFrame, bits: int = 128) -> DataFrame:
    """docs with fingerprint (string): equal if and only if the canonical texts are equal.

    The wide digest groups; inside groups of several rows the canonical texts themselves are compared (see clashes()). Where they
    differ, the second digest is appended. Null texts count as empty. Repeated rows have equal fingerprints. An empty
    table gives an empty one; a column fingerprint of docs is replaced.
    """
    base = digests(pack(docs, _text=text_of()), bits).drop("_canon")
    out = resolved(base, clashes(base.select("_digest", "_strong"), docs, bits), {"_fp": ("_digest", "_strong")})
    return unpack(out, docs.columns, fingerprint=F.col("_fp"))


def strong(canon: bytes) -> str:
    return hashlib.sha256(canon).hexdigest()[:32]


PAIR = "doc_id long, n_chars long, edited_sha256 string, _digest string, _strong string, _edited string, _edited_strong string, near_edited double, near_next double"


def edited_pairs(docs: DataFrame, bits: int = 128, target_bytes: int = 12 << 20) -> DataFrame:
    """For every row its digest, that of its edited text, and whether the canonical bytes agree with it and with the next row's.

    The next row follows in descending doc_id (null last; repeated ids in the order of texts); after the last comes the first. The
    edited text: the last floor(n_chars / 2) code points replaced by the next text's first as many, or all.

    Rows are dealt by ranges of doc_id, one partition each, and sorted; texts are shuffled once. The first row of each range goes
    to the one before as well, where it ends the order. Rows stream through; a task holds two texts and one batch.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (-1 - id_of()).alias("_k"), text_of().alias("text"))
    ranged, points = by_range(base, F.col("_k"), target_bytes)
    heads = {r["_bucket"]: r["k"] for r in ranged.select("_bucket", "_k").groupBy("_bucket").agg(F.min("_k").alias("k")).collect()}
    if not heads:
        return docs.sparkSession.createDataFrame([], PAIR)
    order = sorted(heads)  # at most as many as there are ranges
    before = {heads[b]: order[i - 1] for i, b in enumerate(order)}
    keys = np.array(sorted(before), np.int64)
    targets = np.array([before[k] for k in keys.tolist()], np.int32)

    @F.pandas_udf("int")
    def also(k):
        import pandas as pd

        k = k.to_numpy()
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        return pd.Series(np.where(keys[at] == k, targets[at], -1).astype(np.int32))

    dealt = ranged.withColumn("_also", also("_k"))
    dealt = dealt.withColumn("_to", F.explode(F.when(F.col("_also") >= 0, F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("t")), F.struct(F.col("_also").alias("b"), F.lit(True).alias("t")))).otherwise(F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("t"))))))
    dealt = dealt.select("doc_id", "_k", "text", F.col("_to.b").alias("_bucket"), F.col("_to.t").alias("_tail"))
    dealt = dealt.repartitionById(len(points) + 1, "_bucket").sortWithinPartitions("_bucket", "_tail", "_k", "text")

    def row(doc_id, text, canon, key, after, after_canon):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        changed_canon = canonical(changed).encode()
        same = 1.0 if changed_canon == canon else 0.0
        return doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *key, digest(changed_canon, bits), strong(changed_canon), same, 1.0 if canon == after_canon else 0.0

    def run(batches):
        types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
        names, kinds = zip(*(field.split() for field in PAIR.split(", ")), strict=True)
        held = None
        for batch in batches:
            rows = []
            for b, is_tail, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("_bucket", "_tail", "doc_id", "text")), strict=True):
                canon = canonical(text).encode()
                if held is not None and held[0] == b:
                    rows.append(row(*held[1:], text, canon))
                held = None if is_tail else (b, doc_id, text, canon, (digest(canon, bits), strong(canon)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))

    return dealt.mapInArrow(run, PAIR)


def fingerprint_stability(docs: DataFrame, bits: int = 128, target_bytes: int = 12 << 20) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    fingerprint as of fingerprints(), over all texts and edited texts together; texts are compared by their bytes inside equal digests, edited
    ones, which are not kept, by a second independent digest. The digest is exact, so likeness is 1.0 for equal canonical texts (by their
    bytes) and 0.0 else. A single row is its own next. An empty table gives an empty one.
    """
    pairs = cut(edited_pairs(docs, bits, target_bytes))
    keys = pairs.select("_digest", "_strong").union(pairs.select("_edited", "_edited_strong"))
    out = resolved(pairs, clashes(keys, docs, bits), {"fingerprint": ("_digest", "_strong"), "edited_fingerprint": ("_edited", "_edited_strong")})
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
