"""Packing: order-preserving dynamic programming over document and sentence ends, with a monotone queue."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import LOWER, SPACE, by_range, id_of, raw, slices, span_hashes, strings, text_of, word_spans, worker_store

#: Kinds of bytes: white space, letters (ASCII, and two-byte ones from \xC3 on), digits, and marks, of which words are made whose pieces
#: are known without the tokenizer; a word with an other byte needs it.
BLANK, LETTER, DIGIT, MARK, OTHER = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[SPACE] = BLANK
KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = LETTER
KIND[48:58] = DIGIT
KIND[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = MARK
#: Bytes that end a sentence, and closing marks that may follow them.
STOPS, CLOSERS = np.zeros(256, bool), np.zeros(256, bool)
STOPS[list(b".!?")], CLOSERS[list(b"'\")]")] = True, True
#: Words that need the tokenizer and their ids, which a Python worker remembers, counted with what a dict takes for them.
CACHE_BYTES = 48 << 20
#: Costs in tokens: of cutting at a sentence's end, and elsewhere. A document's end costs nothing, a token of padding 1.
SENTENCE_COST, HARD_COST = 2, 96


def piece_encoder(path: str):
    """(encoding, whether a token ends a piece by its id) of a BPE whose pieces end in </w>, for text in which \\0 stands for that.

    Pairs are merged in the order of the ids of what they make, which is the vocabulary's order of merges.
    """
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    # The byte alphabet of byte-level BPE: printable bytes stand for themselves, others follow from 256 on.
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    byte = {chr(b) if b in same else chr(next(rest)): b for b in range(256)}
    ranks, final = {}, np.zeros(max(vocabulary.values()) + 1, bool)
    for token, i in vocabulary.items():
        last = token.endswith("</w>")
        whole = bytes(byte[c] for c in (token[:-4] if last else token))
        if 0 not in whole or whole == b"\0" and not last:  # pieces hold no \0 of their own
            ranks[whole + b"\0" * last] = i
            final[i] = last
    return tiktoken.Encoding("pieces", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}), final


class WordIds:
    """Ids of whole texts. The tokenizer drops white space and no token crosses it, so a text's ids are its words' ids. Words of letters,
    digits and marks alone are cut where their kind changes and around digits, as the tokenizer does, and lower-cased; the different
    pieces of a slice of texts are encoded together. Other words are given to the tokenizer and remembered, up to a bound."""

    def __init__(self, path: str):
        self.kept = worker_store(f"ids {path}")  # what lives as long as the worker
        if not self.kept:
            from tokenizers import Tokenizer

            encoding, final = piece_encoder(path)
            self.kept |= {"whole": Tokenizer.from_file(path), "pieces": encoding, "final": final, "words": {}, "bytes": 0}

    def word(self, word: bytes) -> np.ndarray:
        """The ids of a word that is no sequence of plain pieces."""
        kept = self.kept
        ids = kept["words"].get(word)
        if ids is None:
            ids = np.array(kept["whole"].encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
            kept["bytes"] += len(word) + len(ids) + 170
            if kept["bytes"] > CACHE_BYTES:
                kept["words"].clear()
                kept["bytes"] = 0
            kept["words"][word] = ids
        return np.frombuffer(ids, "<u4")

    @staticmethod
    def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(lower-cased bytes, starts and ends of pieces, which of them are words for the tokenizer)."""
        kind = KIND[data]
        odd = kind == OTHER
        wide = (data[:-1] == 0xC3) & (data[1:] < 0xC0)
        odd[1:] |= wide & ((data[1:] == 0x97) | (data[1:] == 0xB7))  # multiplication and division signs
        low = LOWER[data]
        low[1:][wide & (data[1:] < 0x9F)] += 32
        begins = np.zeros(len(data), bool)
        begins[1:] = (kind[1:] != BLANK) & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
        slow = np.zeros(len(starts), bool)
        if odd.any():
            slow[np.searchsorted(starts, np.flatnonzero(odd), "right") - 1] = True
            inside = np.zeros(len(data) + 1, np.int8)
            np.add.at(inside, starts[slow], 1)
            np.add.at(inside, ends[slow], -1)
            whole = np.cumsum(inside[:-1], dtype=np.int8) > 0
            begins &= ~whole
            low[whole] = data[whole]
        begins[starts] = True
        first = np.flatnonzero(begins)
        of = np.searchsorted(starts, first, "right") - 1
        return low, first, np.minimum(np.append(first[1:], len(data)), ends[of]), slow[of]

    def different(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, slow: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, place of the first, number) of pieces, those for the tokenizer behind the others."""
        sizes, begin = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        length = (ends - starts)[~slow] + 1  # one more for the end
        upto = np.cumsum(length)
        flat = np.zeros(0, np.uint32)
        if len(length):
            places = np.repeat(starts[~slow] - upto + length, length) + np.arange(upto[-1])
            places[upto - 1] = 0
            text = low[places]
            text[upto - 1] = 0
            flat = self.kept["pieces"].encode_to_numpy(text.tobytes().decode(), disallowed_special=())
            last = np.flatnonzero(self.kept["final"][flat]) + 1
            begin[~slow] = np.concatenate([[0], last[:-1]])
            sizes[~slow] = np.diff(last, prepend=0)
        if slow.any():
            found = [self.word(low[a:b].tobytes()) for a, b in zip(starts[slow].tolist(), ends[slow].tolist(), strict=True)]
            sizes[slow] = [len(ids) for ids in found]
            begin[slow] = len(flat) + np.cumsum(sizes[slow]) - sizes[slow]
            flat = np.concatenate([flat, *found])
        return flat, begin, sizes

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids (uint32), and how many of them precede each sentence's end; held for a slice of texts at a time.

        Equal pieces of a slice are found by their 64-bit hash, encoded once, and their ids gathered.
        """
        data, offsets = raw(texts)
        for i, j in slices(offsets):
            part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            starts, ends, first = word_spans(part, own)
            low, begins, closes, slow = self.pieces(part, starts, ends)
            codes, _ = pd.factorize(span_hashes(low, begins, closes))
            where = np.empty(codes.max() + 1 if len(codes) else 0, np.int64)
            where[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)  # the first place of each
            flat, begin, sizes = self.different(low, begins[where], closes[where], slow[where])
            length = sizes[codes]
            upto = np.concatenate([[0], np.cumsum(length)])
            ids = flat[np.repeat(begin[codes] - upto[:-1], length) + np.arange(upto[-1])]
            upto = upto[np.append(np.searchsorted(begins, starts), len(begins))]  # now by words
            last = ends - 1
            for _ in range(3):
                last = last - (CLOSERS[part[last]] & (last > starts))
            stop = STOPS[part[last]] if len(last) else np.zeros(0, bool)
            for k in range(i, j):
                lo, hi = first[k - i], first[k - i + 1]
                yield ids[upto[lo] : upto[hi]], np.unique(upto[lo + 1 : hi + 1][stop[lo:hi]] - upto[lo])


def cuts(ends: np.ndarray, costs: np.ndarray, size: int) -> list[int]:
    """Positions at which windows end, for a stream whose possible cuts are ends (ascending, the last its length).

    Minimises the padding of windows to size plus the costs of cuts, by dynamic programming: best(e) = min over starts s in
    [e - size, e) of best(s) + s, plus size - e + cost(e); the minimum over the sliding range comes from a monotone queue.
    ends must have no gap above size. The last window's padding is not counted.
    """
    queue: deque[tuple[int, float]] = deque([(-1, 0.0)])  # (index, best + position); -1 is the stream's start
    at = [*ends.tolist(), 0]  # at[-1]: the start
    best = [0.0] * len(at)
    back = [0] * len(ends)
    last = len(ends) - 1
    for k, cost in enumerate(costs.tolist()):
        e = at[k]
        if k == last:
            back[k] = min((j for j in (-1, *range(int(np.searchsorted(ends, e - size)), last)) if at[j] >= e - size), key=best.__getitem__)
            break
        while at[queue[0][0]] < e - size:
            queue.popleft()
        back[k], value = queue[0]
        best[k] = value + size - e + cost
        while queue and queue[-1][1] >= best[k] + e:
            queue.pop()
        queue.append((k, best[k] + e))
    chosen, k = [], last
    while k >= 0:
        chosen.append(int(ends[k]))
        k = back[k]
    return chosen[::-1]


def possible(lengths: list[int], inner: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts of a stream of documents and their costs: document ends, sentence ends, and hard cuts on a grid of
    size / 64 tokens, between which windows can be full. Of equal positions the cheapest counts."""
    ends, costs, at = [], [], 0
    for n, stops in zip(lengths, inner, strict=True):
        ends.append(stops + at)
        costs.append(np.full(len(stops), SENTENCE_COST))
        at += n
        ends.append(np.array([at]))
        costs.append(np.zeros(1, np.int64))
    step = max(1, size // 64)
    ends.append(np.arange(step, at, step))
    costs.append(np.full(len(ends[-1]), HARD_COST))
    ends, costs = np.concatenate(ends), np.concatenate(costs)
    order = np.lexsort((costs, ends))
    ends, costs = ends[order], costs[order]
    first = np.diff(ends, prepend=-1) > 0
    return ends[first], costs[first]


def tail(start: int, end: int, size: int) -> list[int]:
    """Ends of the pieces of a short last window: powers of two, which need no padding, largest first."""
    out, n = [], end - start
    while n:
        piece = 1 << (n.bit_length() - 1)
        start += piece
        out.append(start)
        n -= piece
    return out if end - start < size else [end]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Tokens of a range that are held before their windows are chosen.
HELD_TOKENS = 1 << 20


class Packer:
    """Takes the documents of one range in order and gives rows of PIECES; holds about `held` tokens, besides one document."""

    def __init__(self, first_id: int, size: int, held: int):
        self.sequence, self.size, self.held = first_id, size, held
        self.docs: deque[tuple[int | None, np.ndarray, np.ndarray]] = deque()
        self.used = self.tokens = 0  # ids of the first document that are packed already; ids that are not packed yet

    def add(self, doc_id: int | None, ids: np.ndarray, stops: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, ids, stops))
        self.tokens += len(ids)
        return self.take(False) if self.tokens >= self.held else []

    def take(self, last: bool) -> list[tuple]:
        """The rows of all windows but the last one, whose end depends on what follows; with last, of all."""
        if not self.docs:
            return []
        skip = [self.used, *[0] * (len(self.docs) - 1)]
        ends, costs = possible([len(ids) - k for (_, ids, _), k in zip(self.docs, skip, strict=True)], [stops[stops > k] - k for (*_, stops), k in zip(self.docs, skip, strict=True)], self.size)
        chosen = cuts(ends, costs, self.size)
        if last:
            start = chosen[-2] if len(chosen) > 1 else 0
            chosen[-1:] = tail(start, chosen[-1], self.size)
        else:
            chosen.pop()
        rows, at = [], 0
        for end in chosen:
            begin = at
            while at < end:
                doc_id, ids, _ = self.docs[0]
                take = min(end - at, len(ids) - self.used)
                rows.append((doc_id, self.used, take, zlib.crc32(ids[self.used : self.used + take].tobytes()), len(ids), self.sequence, at - begin))
                at, self.used = at + take, self.used + take
                if self.used == len(ids):
                    self.docs.popleft()
                    self.used = 0
            self.sequence += 1
        self.tokens -= at
        return rows


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, target_bytes: int = 12 << 20) -> DataFrame:
    """Pack the token ids of all texts into sequences of at most size tokens; one row for each piece of a document.

    Returns PIECES: start counts the document's ids before the piece, offset the sequence's before it. Documents stand in the order
    of doc_id (null first; repeated ids in the order of their texts; each row is a document). The order is dealt into
    ranges of about target_bytes of text, one task each; sequences don't cross ranges. Documents stream through a task, which holds about
    HELD_TOKENS ids, besides one document: cuts() chooses the windows of these, and the last of them, whose end depends on what follows,
    is chosen again with the next. At the end of a range the last, shorter one is split into powers of two, which need no padding.
    sequence_id is the range's number times 2^32 plus the number in it; ranges depend on the rows alone, so it is the same in every run.
    A null text is empty: its end_id alone. An empty table gives an empty one. tokenizer is the path of a vocabulary file that every
    executor has.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_of().alias("_d"), text_of().alias("text"))
    ranged, points = by_range(base, F.col("_d"), target_bytes)
    ranged = ranged.repartitionById(len(points) + 1, "_bucket").sortWithinPartitions("_bucket", "_d", "text")
    held = HELD_TOKENS

    def run(batches):
        encoder = WordIds(tokenizer)
        schema = pa.schema([(field.split()[0], pa.int64()) for field in PIECES.split(", ")])
        packer, bucket = None, None
        for batch in batches:
            rows = []
            encoded = encoder(strings(batch, "text"))
            for b, doc_id, (ids, stops) in zip(batch.column("_bucket").to_pylist(), batch.column("doc_id").to_pylist(), encoded, strict=True):
                if b != bucket:
                    rows += packer.take(True) if packer else []
                    packer, bucket = Packer(b << 32, size, held), b
                rows += packer.add(doc_id, np.append(ids, np.uint32(end_id)).astype("<u4"), stops)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)
        if packer and (rows := packer.take(True)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

    return ranged.mapInArrow(run, PIECES)
