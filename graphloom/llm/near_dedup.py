"""MinHash near-dedup by a chosen-path set similarity join: trees of minwise tokens, small nodes compared exhaustively."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import LOWER, NO_ID, annotate, cut, id_of, mix, pack, raw, slices, span_hashes, strings, text_of, unpack, word_spans

#: A pair of Jaccard similarity s shares a node of depth d in one tree with probability s^d. Every pair that shares a node of the last
#: depth is found, however large the nodes above it are, so TREES bounds the recall: 1 - (1 - 0.8^7)^50 = 0.99999 at 0.8.
TREES = 50
#: Trees whose nodes are looked at from the first level on; of the others only those of the last depth.
FULL = 16
#: Depths at which nodes are looked at.
LEVELS = (3, 7)
DEPTH = LEVELS[-1]
TOKENS = TREES * DEPTH
#: Tokens a set is screened by, a byte of each.
SKETCH = 96
#: A node of so many sets is compared pair by pair; a larger one is compared with its least member and branched further, and at the
#: last depth becomes one cluster.
SMALL = 32
#: Of the sketch so large a share must agree before whole sets are compared: five standard deviations below 0.8.
SCREEN = 0.6
#: Sets of a block, and bytes of their texts, unless one text alone has more; a task compares the sets of two blocks of one cluster.
BLOCK, BLOCK_BYTES = 1024, 4 << 20
#: Bits of the bitmap by which texts of no candidate are passed over: 2 MB, whatever the data.
BITMAP = 24
#: Odd multipliers of the minwise hash functions.
FACTORS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_words(text: str) -> list[bytes]:
    """Words between blanks, A-Z lower-cased."""
    return text.encode().lower().split()


def shingles(text: str, words: int) -> frozenset:
    """Distinct shingles of so many words; with fewer words the whole sequence as one; without words none."""
    w = shingle_words(text)
    if not w:
        return frozenset()
    return frozenset(zip(*(w[i:] for i in range(words)), strict=False)) if len(w) >= words else frozenset([tuple(w)])


def signatures(texts: pa.Array, words: int) -> dict[str, np.ndarray]:
    """For each text: n_shingles, a 128-bit digest of the set (k1, k2) and the minwise tokens (TOKENS of 32 bits)."""
    data, offsets = raw(texts)
    data = LOWER[data]
    n = len(texts)
    out = {"n": np.zeros(n, np.int64), "k1": np.zeros(n, np.uint64), "k2": np.zeros(n, np.uint64), "sig": np.zeros((n, len(FACTORS)), np.uint32)}
    for i, j in slices(offsets):
        for i0 in range(i, j, 60_000):  # documents are numbered in 16 bits below
            chunk(data, offsets, i0, min(j, i0 + 60_000), words, out)
    return out


def hashed_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, texts): the distinct shingles of all texts as 64-bit hashes, by text, then hash. At most 65,536 texts."""
    starts, ends, first = word_spans(data, offsets)
    h = span_hashes(data, starts, ends)
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    step = np.uint64(0x9E3779B97F4A7C15)
    m = max(0, len(h) - words + 1)
    rolled = h[:m].copy()
    for k in range(1, words):
        rolled = mix(rolled * step + h[k : k + m])
    inside = doc[:m] == doc[words - 1 : words - 1 + m]
    g, d = [rolled[inside]], [doc[:m][inside]]
    for k in np.flatnonzero((count > 0) & (count < words)):
        seq = h[first[k] : first[k + 1]]
        whole = seq[:1].copy()
        for x in seq[1:]:
            whole = mix(whole * step + x)
        g.append(mix(whole + np.uint64(len(seq))))
        d.append(np.array([k]))
    g, d = np.concatenate(g), np.concatenate(d)
    order = np.argsort(g)
    order = order[np.argsort(d[order].astype(np.uint16), kind="stable")]
    g, d = g[order], d[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    return g[new], d[new]


def hashed_sets_of(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """hashed_sets() of any number of texts, by slices."""
    g, d = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in slices(offsets):
        for low in range(i, j, 60_000):  # texts are numbered in 16 bits there
            high = min(j, low + 60_000)
            x, y = hashed_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], words)
            g.append(x)
            d.append(y + low)
    return np.concatenate(g), np.concatenate(d)


def chunk(data: np.ndarray, offsets: np.ndarray, i: int, j: int, words: int, out: dict) -> None:
    g, d = hashed_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
    if not len(g):
        return
    heads = np.flatnonzero(np.diff(d, prepend=-1))
    rows = i + d[heads]
    out["n"][rows] = np.diff(np.append(heads, len(d)))
    out["k1"][rows] = np.add.reduceat(mix(g ^ np.uint64(0xA5A5A5A5A5A5A5A5)), heads)
    out["k2"][rows] = np.bitwise_xor.reduceat(mix(g + np.uint64(0x1234567)), heads)
    for f, factor in enumerate(FACTORS):
        out["sig"][rows, f] = np.minimum.reduceat((g * factor >> np.uint64(32)).astype(np.uint32), heads)


def branches(sig: np.ndarray) -> np.ndarray:
    """For each set its nodes at LEVELS in the first FULL trees, then those of the last depth in the others: 64-bit hashes of the tree and
    the tokens chosen on the way down."""
    out = []
    for t in range(TREES):
        h = np.full(len(sig), t + 1, np.uint64)
        for depth in range(1, DEPTH + 1):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, t * DEPTH + depth - 1].astype(np.uint64) + np.uint64(1))
            if depth == DEPTH or (t < FULL and depth in LEVELS):
                out.append(h)
    return np.stack(out, 1)


def lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.ravel()))


def signed(docs: DataFrame, words: int) -> DataFrame:
    """The columns of docs but _text, with _n, _k1, _k2, _nodes (see branches()) and _sketch (a byte of each of SKETCH minwise tokens)."""

    def make():
        def run(batch):
            found = signatures(strings(batch, "_text"), words)
            nodes = branches(found["sig"]).view(np.int64)
            sketch = found["sig"][:, :SKETCH].astype(np.uint8).view(np.int8)  # the low byte: a minimum's high ones are mostly 0
            return {"_n": pa.array(found["n"]), "_k1": pa.array(found["k1"].view(np.int64)), "_k2": pa.array(found["k2"].view(np.int64)), "_nodes": lists(nodes), "_sketch": lists(sketch)}

        return run

    return annotate(docs, make, {"_n": "long", "_k1": "long", "_k2": "long", "_nodes": "array<long>", "_sketch": "array<tinyint>"}).drop("_text")


def texts_of(ends: DataFrame, docs: DataFrame) -> DataFrame:
    """(_d, _text) of docs whose _d is among ends, and of a few more: a bitmap of fixed size decides without a shuffle."""
    place = F.xxhash64("_d").bitwiseAND((1 << BITMAP) - 1)
    parts = ends.select((place + 1).alias("x")).groupBy(F.bitmap_bucket_number("x").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("m")).collect()
    bitmap = np.zeros(1 << BITMAP >> 3, np.uint8)
    for r in parts:  # at most 2^BITMAP bits in all
        at = (r["b"] - 1) * 4096
        bitmap[at : at + 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        for batch in batches:
            x = batch.column("_x").to_numpy()
            yield batch.filter(pa.array((shared.value[x >> 3] >> (x & 7) & 1).astype(bool))).select(["_d", "_text"])

    return docs.select("_d", "_text", place.alias("_x")).mapInArrow(run, "_d long, _text string")


def clusters(rows: DataFrame, deep: DataFrame, sketches: DataFrame) -> DataFrame:
    """(_d, _comp): sets that may be similar, in clusters, of rows(_d, _3, _7) with their nodes in the first FULL trees and
    deep(_d, _7) with those of the last depth in the others.

    Members of a small node are compared by sketch, pair by pair; those of a large one with its least member, and it branches on;
    those large still at the last depth are one cluster each, whatever the sketches say. So a pair that shares a node of the last depth in
    any tree is compared or in one cluster. Clusters are the components of these edges; only ids and sketches move.
    """
    found, here = None, rows
    for depth in LEVELS:
        if depth == DEPTH:
            here = here.select("_d", f"_{depth}").union(deep)
        node = F.col(f"_{depth}").alias("_node")
        stats = cut(here.groupBy(node).agg(F.count("*").alias("_size"), F.min("_d").alias("_least")).where("_size > 1"))
        members = here.select("_d", node).join(stats.where(F.col("_size") <= SMALL).select("_node"), "_node").groupBy("_node").agg(F.array_sort(F.collect_set("_d")).alias("_m"))
        every = F.flatten(F.transform("_m", lambda x, i: F.transform(F.slice("_m", i + 2, SMALL), lambda y: F.struct(x.alias("a"), y.alias("b")))))
        pairs = members.select(F.explode(every).alias("p")).select("p.a", "p.b").distinct()
        found = pairs if found is None else found.union(pairs)
        large = stats.where(F.col("_size") > SMALL)
        stars = here.select("_d", node).join(large, "_node").where(F.col("_d") != F.col("_least")).select(F.col("_least").alias("a"), F.col("_d").alias("b")).distinct()
        if depth == DEPTH:
            break
        found = found.union(stars)
        here = cut(here.join(large.select(F.col("_node").alias(f"_{depth}")), f"_{depth}", "left_semi"))
    s = sketches.select("_d", "_sketch")
    near = found.distinct().join(s.select(F.col("_d").alias("a"), F.col("_sketch").alias("_sa")), "a").join(s.select(F.col("_d").alias("b"), F.col("_sketch").alias("_sb")), "b")
    agree = F.size(F.filter(F.zip_with("_sa", "_sb", lambda x, y: x == y), lambda x: x))
    return components(near.where(agree >= int(SCREEN * SKETCH)).select("a", "b").union(stars))


def common_shingles(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, intersections) of all texts' whole sets: products of a 0/1 matrix by slices of the shingles that several texts have."""
    data, offsets = raw(pa.array(texts, pa.large_string()))
    g, d = hashed_sets_of(LOWER[data], offsets, words)
    n = len(texts)
    sizes = np.bincount(d, minlength=n)
    _, column, count = np.unique(g, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    rank = np.cumsum(count > 1) - 1
    column, d = rank[column[shared]], d[shared]
    order = np.argsort(column, kind="stable")
    column, d = column[order], d[order]
    out = np.zeros((n, n), np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, total, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        part = np.zeros((n, min(4096, total - low)), np.float32)
        part[d[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return sizes, out.astype(np.int64)


def compare(ids: list[int], texts: list[str], low: int, words: int, percent: int) -> list[tuple[int, int]]:
    """Links among a block's sets (low = len(ids)), or of the first low sets with the others, decided on whole sets; of those that a spanning
    forest doesn't need none, so at most len(ids) - 1."""
    sizes, both = common_shingles(texts, words)
    near = (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)) & (both > 0)
    rows, columns = np.nonzero(np.triu(near, 1) if low == len(ids) else near[:low, low:])
    columns = columns if low == len(ids) else columns + low
    parent, links = list(range(len(ids))), []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, j in zip(rows.tolist(), columns.tolist(), strict=True):
        x, y = find(i), find(j)
        if x != y:
            parent[max(x, y)] = min(x, y)
            links.append((ids[i], ids[j]))
    return links


def beside_first(groups: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(_d, _comp, _bytes, _linked) of groups(_d, _comp): whether a set is linked with its cluster's least one, decided on whole sets.

    The least set's text travels to the others in a join by cluster, whose hot partitions adaptive execution splits, so the time is linear in
    a cluster's size.
    """
    full = cut(groups.join(texts_of(groups.select("_d"), docs), "_d"))
    first = full.where("_d = _comp").select("_comp", F.col("_text").alias("_first"))

    def run(batches):
        for batch in batches:
            texts, firsts = strings(batch, "_text"), batch.column("_first").cast(pa.large_string()).dictionary_encode()
            which, n = firsts.indices.to_numpy(), len(batch)
            linked = np.zeros(n, bool)
            every = pa.concat_arrays([firsts.dictionary, texts])
            data, offsets = raw(every)
            g, d = hashed_sets_of(LOWER[data], offsets, words)
            at = np.searchsorted(d, np.arange(len(every) + 1))
            k = len(firsts.dictionary)
            for i in range(n):
                x, y = g[at[which[i]] : at[which[i] + 1]], g[at[k + i] : at[k + i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            bytes_ = np.diff(offsets[k:])
            yield pa.RecordBatch.from_arrays([batch.column("_d"), batch.column("_comp"), pa.array(bytes_), pa.array(linked)], names=["_d", "_comp", "_bytes", "_linked"])

    paired = full.join(first.hint("shuffle_merge"), "_comp").select("_d", "_comp", "_text", "_first")
    return cut(paired.mapInArrow(run, "_d long, _comp long, _bytes long, _linked boolean"))


def blocks(side: Column) -> Column:
    """In how many blocks a cluster's sets are dealt: by their number and by their bytes."""
    return F.ceil(F.greatest(F.sum(side.cast("long")) / BLOCK, F.sum(F.when(side, F.col("_bytes")).otherwise(0)) / BLOCK_BYTES)).cast("int")


def verified(groups: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that join the sets of each cluster of groups(_d, _comp), confirmed on whole sets.

    Every set is compared with the least of its cluster first; those linked with it are joined then, and need no comparison among
    themselves. The others, the open ones, are compared with each other and with the joined ones: both are dealt by hash into blocks of about
    BLOCK sets or BLOCK_BYTES, and a task's unit of work is two blocks of one cluster (or one with itself), so that no group of any size
    meets in one task, and every pair that matters meets once. A set is sent once for each block it is compared with.
    """
    seen = beside_first(groups, docs, words, percent)
    stars = seen.where(F.col("_linked") & (F.col("_d") != F.col("_comp"))).select(F.col("_comp").alias("a"), F.col("_d").alias("b"))
    rest = seen.where("_d <> _comp").withColumn("_open", ~F.col("_linked"))
    sizes = rest.groupBy("_comp").agg(blocks(F.col("_open")).alias("_open_blocks"), blocks(F.col("_linked")).alias("_linked_blocks"), F.count("*").alias("_sets"))
    sizes = sizes.where("_open_blocks > 0 and _sets > 1").drop("_sets")
    dealt = rest.join(sizes, "_comp").withColumn("_b", F.pmod(F.xxhash64("_d"), F.when(F.col("_open"), F.col("_open_blocks")).otherwise(F.col("_linked_blocks"))).cast("int"))
    span = lambda n: F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
    unit = lambda i, j, second, joined: F.struct(i.alias("_i"), j.alias("_j"), second.alias("_second"), F.lit(joined).alias("_joined"))
    b = F.col("_b")
    among = F.transform(span(F.col("_open_blocks")), lambda o: unit(F.least(b, o), F.greatest(b, o), b > o, False))
    across = F.transform(span(F.col("_linked_blocks")), lambda o: unit(b, o, F.lit(False), True))
    joined = F.transform(span(F.col("_open_blocks")), lambda o: unit(o, b, F.lit(True), True))
    work = cut(dealt.select("_d", "_comp", F.inline(F.when(F.col("_open"), F.concat(among, across)).otherwise(joined))))
    keys = ["_comp", "_joined", "_i", "_j"]
    full = work.join(texts_of(work.select("_d"), docs), "_d").repartition(*keys).sortWithinPartitions(*keys, "_second", "_d")

    def run(batches):
        key, ids, texts, low = None, [], [], 0

        def links():
            first = low if key[1] or key[2] != key[3] else len(ids)
            return compare(ids, texts, first, words, percent)

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in (*keys, "_second", "_d", "_text"))
            for comp, joined_, i, j, second, d, text in zip(*columns, strict=True):
                if (comp, joined_, i, j) != key:
                    if key is not None:
                        out += links()
                    key, ids, texts, low = (comp, joined_, i, j), [], [], 0
                low += not second
                ids.append(d)
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
        if key is not None:
            out = links()
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return cut(stars.union(full.select(*keys, "_second", "_d", "_text").mapInArrow(run, "a long, b long")).where("a <> b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(_d, _comp) of every end of edges(a, b): the least id reachable.

    Round by round: every vertex points to the least of its neighbours and itself, pointers jump over themselves until they rest, and
    the graph is contracted to what they point to. Dense groups become one vertex in the first round, chains halve; every round is materialised.
    """
    left, rounds = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()), []
    while not rounds or not left.isEmpty():
        ends = left.select(F.col("a").alias("_d"), F.col("a").alias("_up")).union(left.select(F.col("b"), F.col("a"))).union(left.select(F.col("a"), F.col("b")))
        up = ends.groupBy("_d").agg(F.min("_up").alias("_up"))
        while True:
            above = up.select(F.col("_d").alias("_up"), F.col("_up").alias("_top"))
            up = cut(up.join(above, "_up").select("_d", F.col("_top").alias("_up"), (F.col("_top") != F.col("_up")).alias("_moved")))
            if up.where("_moved").isEmpty():
                break
        rounds.append(up)
        moved = left.join(up.select(F.col("_d").alias("a"), F.col("_up").alias("_a")), "a").join(up.select(F.col("_d").alias("b"), F.col("_up").alias("_b")), "b")
        left = cut(moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).where("a <> b").distinct())
    labels = rounds.pop().select("_d", F.col("_up").alias("_comp"))
    for up in reversed(rounds):
        labels = up.select("_d", "_up").join(labels.withColumnRenamed("_d", "_up"), "_up", "left").select("_d", F.coalesce("_comp", "_up").alias("_comp"))
    return cut(labels) if rounds else labels


def near_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, component_id (long) and kept (boolean).

    Documents whose sets of word shingles have 100 * intersection >= percent * union are linked; component_id is
    the least doc_id reachable, kept whether that is the document's own. Sets are formed of whole texts. Empty ones (null texts, no
    words) are linked with nothing. Rows of one doc_id are one document, linked with all that one of its texts is linked with; a null
    doc_id is least of all; it is shown as null.
    An empty table gives an empty one.

    Equal sets are one class first, by a 128-bit digest, and go on as its least doc_id. Each class descends TREES trees, at each step
    choosing the branch by its next minwise token. Nodes of at most SMALL classes are compared pair by pair; larger ones are linked
    through their least member and branch on, and at the last depth are clusters whole, so none is given up. Inside a cluster every pair
    is decided on whole sets (of 64-bit shingle hashes), block by block (see verified()), whether it shared a node or not.

    Recall for a pair of similarity s is at least 1 - (1 - s^7)^50, whatever the sizes of the nodes: 0.99999 at 0.8. That is the worst case,
    where all nodes above the last depth are large; where those of depth 3 are small, 16 trees alone give 0.99999. The sketch of a small
    node's pair costs about 0.000001 more. percent under 80 lowers these figures. Copies are one class; no group of near copies meets in one task.
    """
    base = docs.select(id_of().alias("_d"), text_of().alias("_text"))
    narrow = cut(signed(base, words))
    classes = cut(narrow.where("_n > 0").groupBy("_k1", "_k2", "_n").agg(F.min("_d").alias("_rep"), F.count("*").alias("_rows")))
    sets = narrow.join(classes.select(F.col("_rep").alias("_d"), "_k1", "_k2", "_n"), ["_d", "_k1", "_k2", "_n"], "left_semi").dropDuplicates(["_d", "_k1", "_k2"])
    sets = cut(sets.select("_d", "_nodes", "_sketch"))
    nodes = [F.struct(*[F.col("_nodes")[t * len(LEVELS) + i].alias(f"_{depth}") for i, depth in enumerate(LEVELS)]) for t in range(FULL)]
    rows = sets.select("_d", F.inline(F.array(*nodes)))
    deep = sets.select("_d", F.explode(F.slice("_nodes", FULL * len(LEVELS) + 1, TREES - FULL)).alias(f"_{DEPTH}"))
    links = verified(clusters(rows, deep, sets), base, words, percent)
    # A document whose rows have different texts links their classes.
    repeated = cut(narrow.groupBy("_d").agg(F.count("*").alias("_c")).where("_c > 1").select("_d"))
    once = repeated.isEmpty()
    if not once:
        own = narrow.where("_n > 0").join(repeated, "_d", "left_semi").join(classes.select("_rep", "_k1", "_k2", "_n"), ["_k1", "_k2", "_n"]).select("_d", "_rep").distinct()
        least = own.groupBy("_d").agg(F.min("_rep").alias("a"))
        links = links.union(own.join(least, "_d").select("a", F.col("_rep").alias("b")).where("a <> b"))
    comps = components(links)
    named = classes.join(comps.withColumnRenamed("_d", "_rep"), "_rep", "left").where("_rows > 1 or _comp is not null")
    named = cut(named.select("_k1", "_k2", "_n", F.coalesce("_comp", "_rep").alias("_comp")))
    marked = narrow.select("_d", "_k1", "_k2", "_n").join(named, ["_k1", "_k2", "_n"], "left").withColumn("_comp", F.coalesce("_comp", "_d"))
    if not once:  # an empty row of a repeated document belongs where its other rows do
        several = marked.join(repeated, "_d", "left_semi").groupBy("_d").agg(F.min("_comp").alias("_all"))
        marked = marked.join(several, "_d", "left").withColumn("_comp", F.coalesce("_all", "_comp")).drop("_all")
    shown = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return marked.select(shown("_d").alias("doc_id"), F.col("_n").alias("n_shingles"), shown("_comp").alias("component_id"), (F.col("_d") == F.col("_comp")).alias("kept"))


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose document is the one that stays of its component (see near_components()); columns unchanged."""
    gone = near_components(docs, words, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_d")).distinct()
    return unpack(pack(docs, _d=id_of()).join(cut(gone), "_d", "left_anti"), docs.columns)
