"""Best-fit packing: a grouping genetic algorithm on islands, with elites that migrate between them."""

from __future__ import annotations

import json
import math
import re
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import mix, raw, slices, span_hashes, strings, text_of, worker_store, written
from graphloom.llm.packing import CACHE_BYTES

#: A chunk of letters, with a space before, which needs nothing of the tokenizer but its model.
PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
SPECIAL = "<|endoftext|>"
#: First bytes of characters that are no white space, whatever follows.
SOLID = np.zeros(256, bool)
SOLID[33:127] = True
SOLID[[b for b in range(0xC3, 0xF5) if b not in (0xE1, 0xE2, 0xE3)]] = True
LETTER, MARK = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
MARK[33:127] = ~LETTER[33:127]
MARK[48:58] = False

#: Pieces that a group of islands packs together, islands of a group, and packings that an island keeps.
GROUP, ISLANDS, MEMBERS = 4096, 3, 6
#: Islands that evolve one after another in a task, at first.
TASK_ISLANDS = 16
#: Rounds between which the ELITES best of each island go to the next one, and children in each.
ROUNDS, CHILDREN, ELITES = 3, 40, 2
#: Share of the well-filled bins that a child is given, and of its bins that a mutation empties.
INJECTED, EMPTIED = 0.15, 0.02
#: Bins filled up to this share of their size are done; pieces of others are dealt into new groups once more.
WELL_FILLED = 0.995


def piece_encoder(path: str):
    """A function from the bytes of one word to its ids, by merging pairs in the order of the vocabulary's ids."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    # The byte alphabet of byte-level BPE: printable bytes stand for themselves, others follow from 256 on.
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    byte = {chr(b) if b in same else chr(next(rest)): b for b in range(256)}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token != SPECIAL}
    return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece


class ByteIds:
    """Ids of whole texts under a byte-level BPE, whose words begin with the space before them.

    Texts are cut before a space, and around a line feed, that a character other than white space follows, and between a letter and a
    mark; the tokenizer always ends a word there. Chunks are then encoded one by one and remembered, up to a bound. A text that names the special token is encoded whole.
    """

    def __init__(self, path: str):
        self.kept = worker_store(f"byte ids {path}")  # what lives as long as the worker: the models, and chunks remembered
        if not self.kept:
            from tokenizers import Tokenizer

            self.kept |= {"whole": Tokenizer.from_file(path), "piece": piece_encoder(path), "new": {}, "old": {}, "bytes": 0}

    def encode(self, chunk: bytes) -> bytes:
        word = chunk[1:] if chunk[:1] == b" " else chunk
        if word.isalpha() or PLAIN.fullmatch(chunk.decode()):
            ids = self.kept["piece"](chunk)
        else:
            ids = self.kept["whole"].encode(chunk.decode(), add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def remembered(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks. Those looked up since half the bound was full are kept when it is full again; others are forgotten."""
        kept, out = self.kept, []
        new, old = kept["new"], kept["old"]
        for w in chunks:
            ids = new.get(w)
            if ids is None:
                ids = old.get(w) or self.encode(w)
                if len(w) < 256:
                    kept["bytes"] += len(w) + len(ids) + 170
                    if kept["bytes"] > CACHE_BYTES // 2:
                        old = kept["old"] = new
                        new, kept["bytes"] = {}, 0
                        kept["new"] = new
                    new[w] = ids
            out.append(ids)
        return out

    @staticmethod
    def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions where chunks begin, and the number of chunks before each text (and in all)."""
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before = SOLID[data[1:]]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        before[inner - 1] = False  # the next byte is another text's
        line = data == 10
        cut[:-2] |= before & ((data[:-1] == 32) | line[:-1])
        cut[1:-1] |= before & line[:-1]
        cut[1:-1] |= (data[:-1] > 32) & (data[:-1] < 127) & line[1:]  # and before a line feed behind a printable byte
        cut[1:-1] |= LETTER[data[:-1]] & MARK[data[1:]]
        cut[-1] = False
        starts = np.flatnonzero(cut)
        return starts, np.searchsorted(starts, offsets)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        data, offsets = raw(texts)
        out = []
        for i, j in slices(offsets):
            part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            buffer = part.tobytes()
            if not len(part):
                out += [np.zeros(0, "<u4")] * (j - i)
                continue
            starts, first = self.spans(part, own)
            ends = np.append(starts[1:], len(part))
            codes, _ = pd.factorize(span_hashes(part, starts, ends))
            where = np.empty(codes.max() + 1, np.int64)
            where[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)  # the first place of each
            found = self.remembered([buffer[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            flat = np.frombuffer(b"".join(found), "<u4")
            sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
            begin = np.cumsum(sizes) - sizes
            length = sizes[codes]
            upto = np.concatenate([[0], np.cumsum(length)])
            ids = flat[np.repeat(begin[codes] - upto[:-1], length) + np.arange(upto[-1])]
            for k in range(j - i):
                lo, hi = own[k], own[k + 1]
                if buffer.find(SPECIAL.encode(), lo, hi) >= 0:
                    out.append(np.array(self.kept["whole"].encode(buffer[lo:hi].decode(), add_special_tokens=False).ids, "<u4"))
                else:
                    out.append(ids[upto[first[k]] : upto[first[k + 1]]])
        return out


PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int) -> DataFrame:
    """PIECES of every text's ids and end_id: the first piece takes what is above a multiple of size, so only it can be shorter. row tells pieces apart."""

    def run(batches):
        from pyspark import TaskContext

        encoder, row = ByteIds(tokenizer), TaskContext.get().partitionId() << 36
        schema = pa.schema([pa.field(c.split()[0], pa.int32() if c.endswith(" int") else pa.int64()) for c in PIECES.split(", ")])
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(strings(batch, "text")), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                edges = [0, *range(len(ids) % size or size, len(ids) + 1, size)] if len(ids) >= size else [0, len(ids)]
                for piece, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    rows.append((row, doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                    row += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, PIECES)


def best_fit(lengths: list[int], size: int, room: list[int]) -> list[int]:
    """The bin of each length in turn: the one with the least room that is enough, else a new one. room: of the bins there are; grows with new ones."""
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    mask = 0  # a bit for each room that some bin has
    for b, r in enumerate(room):
        if r:
            stacks[r].append(b)
            mask |= 1 << r
    out = []
    for n in lengths:
        enough = mask >> n
        if enough:
            r = n + (enough & -enough).bit_length() - 1
            stack = stacks[r]
            b = stack.pop()
            if not stack:
                mask ^= 1 << r
        else:
            r, b = size, len(room)
            room.append(size)
        left = room[b] = r - n
        if left:
            stacks[left].append(b)
            mask |= 1 << left
        out.append(b)
    return out


def fills(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(bins, lengths).astype(np.int64)


def worth(bins: np.ndarray, lengths: np.ndarray, size: int) -> tuple[int, float]:
    """Sorts packings best first: fewest bins, then the largest mean square of how full they are, so that room gathers in few bins."""
    full = fills(bins, lengths) / size
    return len(full), -float((full * full).mean())


def packed(lengths: np.ndarray, size: int, order: np.ndarray) -> np.ndarray:
    bins = np.empty(len(lengths), np.int32)
    bins[order] = best_fit(lengths[order].tolist(), size, [])
    return bins


def rebuilt(bins: np.ndarray, lengths: np.ndarray, size: int, gone: np.ndarray, fixed: np.ndarray, given: np.ndarray) -> np.ndarray:
    """A packing whose bins `gone` are emptied: their pieces go into the bins `given` where `fixed`, and by best fit, longest first, elsewhere."""
    out = np.full(len(lengths), -1, np.int64)
    stay = ~gone[bins] & ~fixed
    kept = np.cumsum(~gone) - 1
    out[stay] = kept[bins[stay]]
    n = int(kept[-1]) + 1
    _, names = np.unique(given[fixed], return_inverse=True)
    out[fixed] = n + names
    placed = out >= 0
    room = (size - np.bincount(out[placed], lengths[placed], minlength=n)).astype(np.int64).tolist()
    loose = np.flatnonzero(~placed)
    loose = loose[np.argsort(-lengths[loose], kind="stable")]
    out[loose] = best_fit(lengths[loose].tolist(), size, room)
    return out.astype(np.int32)


def crossed(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """A child of a: whole well-filled bins of b are injected, bins of a that hold one of their pieces dissolve, what that displaces is best-fit."""
    full = fills(b, lengths)
    chosen = (full >= np.median(full)) & (rng.random(len(full)) < 2 * INJECTED)
    fixed = chosen[b]
    gone = np.zeros(int(a.max()) + 1, bool)
    gone[a[fixed]] = True
    return rebuilt(a, lengths, size, gone, fixed, b)


def mutated(a: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """a with its emptiest bin and some at random dissolved and best-fit again."""
    full = fills(a, lengths)
    gone = rng.random(len(full)) < EMPTIED
    gone[full.argmin()] = True
    return rebuilt(a, lengths, size, gone, np.zeros(len(a), bool), a)


def evolve(lengths: np.ndarray, members: list[np.ndarray], size: int, seed: int, children: int = CHILDREN) -> list[np.ndarray]:
    """The MEMBERS best packings of an island, best first, after some children; stops at once where no packing can have fewer bins.

    Without members, the island begins with best fit of the longest first and of random orders.
    """
    rng = np.random.default_rng(seed)
    least = max(1, math.ceil(int(lengths.sum()) / size))
    if not members:
        members = [packed(lengths, size, np.argsort(-lengths + (0 if k == 0 else 0.3 * size * rng.random(len(lengths))), kind="stable")) for k in range(MEMBERS)]
    ranked = sorted(((worth(m, lengths, size), k, m) for k, m in enumerate(members)), key=lambda x: x[:2])[:MEMBERS]
    for k in range(len(members), len(members) + children):
        if ranked[0][0][0] <= least:
            break
        a, b = (min(rng.integers(len(ranked), size=2)) for _ in range(2))
        child = crossed(ranked[a][2], ranked[b][2], lengths, size, rng) if a != b else mutated(ranked[a][2], lengths, size, rng)
        value = worth(child, lengths, size)
        if value < ranked[-1][0] and all(value != v for v, _, _ in ranked):
            ranked = sorted([*ranked[: MEMBERS - 1], (value, k, child)], key=lambda x: x[:2])
    return [m for *_, m in ranked]


def _islands(state: DataFrame, size: int, turn: int) -> DataFrame:
    """Each row is an island: its members evolve; bins and worth are those of its best."""

    def run(batches):
        keep = ["group", "island", "rows", "lengths"]
        for batch in batches:
            for k in range(batch.num_rows):  # one island at a time
                own = batch.slice(k, 1)
                group, island, lengths, members = (own.column(c)[0].as_py() for c in ("group", "island", "lengths", "members"))
                n = np.array(lengths, np.int64)
                seed = int(mix(np.array([group * 97 + island * 13 + turn], np.uint64))[0] >> np.uint64(1))
                best = evolve(n, [np.frombuffer(m, "<i4") for m in members], size, seed)
                bins, full = worth(best[0], n, size)
                made = [pa.array([[m.astype("<i4").tobytes() for m in best]], pa.list_(pa.binary())), pa.array([bins], pa.int32()), pa.array([full], pa.float64())]
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in keep], *made], names=[*keep, "members", "bins", "full"])

    return state.mapInArrow(run, "group long, island int, rows array<long>, lengths array<int>, members array<binary>, bins int, full double")


def _places(best: DataFrame) -> DataFrame:
    """(row, group, bin, offset, fill) of each piece in its group's best packing."""

    def run(batches):
        for batch in batches:
            for group, rows, lengths, bins in zip(*(batch.column(c).to_pylist() for c in ("group", "rows", "lengths", "best")), strict=True):
                bins, n = np.frombuffer(bins, "<i4"), np.array(lengths, np.int64)
                order = np.argsort(bins, kind="stable")
                full, upto = fills(bins, n), np.cumsum(n[order]) - n[order]
                offset = upto - (np.cumsum(full) - full)[bins[order]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(rows)[order]), pa.array(np.full(len(n), group)), pa.array(bins[order].astype(np.int64)), pa.array(offset), pa.array(full[bins[order]])],
                    names=["row", "group", "bin", "offset", "fill"],
                )

    return best.mapInArrow(run, "row long, group long, bin long, offset long, fill long")


def grouped_bins(loose: DataFrame, size: int, deal: int, groups: int) -> DataFrame:
    """(row, group, bin, offset, fill) of loose (row, length): pieces are dealt into groups by a hash of their row, each packed by ISLANDS islands."""
    dealt = loose.groupBy(F.pmod(F.xxhash64("row", F.lit(deal)), F.lit(groups)).alias("group")).agg(F.array_sort(F.collect_list(F.struct("row", "length"))).alias("own"))
    state = dealt.select("group", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("own.row").alias("rows"), F.col("own.length").cast("array<int>").alias("lengths"))
    tasks = max(8, math.ceil(groups * ISLANDS / TASK_ISLANDS))  # set, as an island is small data and much work
    state = state.repartition(tasks, "group", "island").withColumn("members", F.array().cast("array<binary>"))
    for turn in range(ROUNDS):
        state = _islands(state, size, turn)
        if turn < ROUNDS - 1:
            elites = state.select("group", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.slice("members", 1, ELITES).alias("elites"))
            state = state.drop("bins", "full").join(elites, ["group", "island"]).withColumn("members", F.concat("members", "elites")).drop("elites")
    best = state.groupBy("group").agg(F.min_by(F.struct("rows", "lengths", F.col("members")[0].alias("best")), F.struct("bins", "full", "island")).alias("b"))
    return _places(best.select("group", "b.*"))


def best_fit_packing(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack the token ids of all texts, each with end_id behind, into few sequences of at most size tokens; one row a piece.

    Returns doc_id, piece (int), start, length, ids_crc32, sequence_id, offset (long). Only documents longer than size are cut: into
    pieces of size, before them one of what is left. Full pieces are sequences of their own. The others are dealt into groups of about
    GROUP by a hash, so no source or group of copies gathers in one; each group is packed by islands, tasks of their own, that evolve packings:
    a child gets whole well-filled bins of one parent, bins of the other that share a piece with them dissolve, and what was displaced is best-fit. Between
    rounds each island's elites go to the next. Pieces of bins that are not well filled then are dealt once more, all groups' together.

    Every row is a document, those of a repeated or null doc_id too; a null text is empty: its end_id alone. An empty table gives an
    empty one. Other columns are not looked at. tokenizer is the path of a byte-level BPE's file that every executor has.
    """
    pieces = written(cut_pieces(docs, tokenizer, size, end_id))
    loose = pieces.where(F.col("length") < size).select("row", "length")
    groups = lambda rows: max(1, math.ceil(rows.count() / GROUP))
    first = written(grouped_bins(loose, size, 0, groups(loose)))
    well = F.col("fill") >= math.ceil(WELL_FILLED * size)
    rest = first.where(~well)
    again = grouped_bins(rest.join(loose, "row").select("row", "length"), size, 1, groups(rest))
    named = lambda df, deal: df.select("row", "offset", (F.lit(deal << 61) + F.shiftleft("group", 24) + F.col("bin")).alias("sequence_id"))
    placed = named(first.where(well), 0).unionByName(named(again, 1))
    out = pieces.where(F.col("length") < size).join(placed, "row").unionByName(pieces.where(F.col("length") == size).withColumns({"offset": F.lit(0).cast("long"), "sequence_id": -F.col("row") - 1}))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
