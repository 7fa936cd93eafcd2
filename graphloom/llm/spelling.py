"""Spelling variants: words one edit apart, found in blocks of a forward and a reversed dictionary that share a half."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import cut, text_of, written

#: Blocks of more words are divided again, as long as more than one character of their words is open.
BLOCK = 48
#: Words of more characters are compared one by one instead of in arrays.
WIDE = 64
#: Rows that a task compares at once, and characters of compared pairs.
SCAN_ROWS, SCAN_CHARS = 1 << 16, 1 << 22
LETTERS = r"[A-Za-zÀ-ÿ]"


def lower_ascii(word: Column) -> Column:
    return F.translate(word, string.ascii_uppercase, string.ascii_lowercase)


def without(word: Column, at: Column) -> Column:
    """The word without its character at a position from 0."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))


def word_counts(docs: DataFrame, min_chars: int = 7, min_count: int = 2, slip: int = 31) -> DataFrame:
    """(word, n): how often each word of at least min_chars characters occurs in all texts, if min_count times or more.

    A run of letters, with A-Z lower-cased, is a word; where slip divides the CRC-32 of "<doc_id>:<run>" it lacks the character at the
    CRC modulo its length, as a typing slip that is the same in every engine (slip 0: none). Counting combines on the map side, so a
    word of every document is one row of each task.
    """
    runs = F.explode(F.regexp_extract_all(text_of(), F.lit(LETTERS + "{%d,}" % min_chars), F.lit(0)))
    words = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), runs.alias("word")).select("d", lower_ascii(F.col("word")).alias("word"))
    if slip:
        words = words.withColumn("h", F.crc32(F.concat_ws(":", "d", "word").cast("binary")))
        slipped = without(F.col("word"), (F.col("h") % F.char_length("word")).cast("int"))
        words = words.select(F.when(F.col("h") % slip == 0, slipped).otherwise(F.col("word")).alias("word"))
    counted = words.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def halves(rows: DataFrame) -> DataFrame:
    """Each row (word, n, c, s, t) twice: with the left half of its open characters [s, t) closed, and with the right one.

    c is the length of the shorter word of a pair, the word's own or one less. An edit at e leaves all before e alone and all behind it,
    so of an edit in [s, t) either the left half is intact or the right one.
    """
    middle = F.shiftright(F.col("s") + F.col("t"), 1)
    spans = F.array(F.struct(middle.alias("s"), F.col("t").alias("t")), F.struct(F.col("s").alias("s"), middle.alias("t")))
    return rows.withColumn("half", F.explode(spans)).select("word", "n", "c", "half.s", "half.t")


def blocks(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """Rows (word, n, c, s, t, left, right): the words' places in blocks that share all but the characters [s, t).

    First the prefix blocks of the forward dictionary (the left half is shared) and the suffix blocks of the reversed one. A block of more
    than `most` words is divided by the next half that an edit leaves intact, until one character is open; such a block is bounded by the
    alphabet. Sizes meet their words in a join whose hot partitions adaptive execution splits. A block's name is a 64-bit hash of what it shares.
    """
    lengths = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1))
    rows = words.select("word", "n", lengths.alias("c")).where(F.col("c") >= F.lit(2)).withColumns({"s": F.lit(0), "t": F.col("c")})
    done = None
    while True:
        name = F.xxhash64("c", "s", "t", F.substring("word", F.lit(1), F.col("s")), F.right("word", F.col("c") - F.col("t")))
        rows = written(halves(rows).withColumn("block", name))
        large = rows.where(F.col("t") - F.col("s") > 1).groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > most).drop("size")
        large = cut(large)
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "block", "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = rows.join(large, "block", "left_semi").drop("block")


def one_edit(a: str, b: str) -> int:
    """Where b differs from a by exactly one edit, from the left; -1 if it doesn't. b is as long as a, or longer by one."""
    at = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    same = a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]
    return at if same and a != b else -1


def compare(words: list[str], c: np.ndarray, s: np.ndarray, t: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the near pairs of blocks. Rows of a block are together, those of c characters before those of c + 1; ends: of each row's block.

    A pair counts in the one block in whose open characters its leftmost edit stands; where it is found once more, it doesn't count.
    """
    size = np.fromiter(map(len, words), np.int64, len(words))
    alive = np.flatnonzero((size == c) & (np.arange(len(words)) + 1 < ends))
    short = size <= WIDE
    table = np.array([w if ok else "" for w, ok in zip(words, short, strict=True)], f"<U{max(1, int(size[short].max(initial=1)))}")
    table = table.view(np.uint32).reshape(len(words), -1)
    width, found, d = table.shape[1], [], 1
    places = np.arange(width)
    while len(alive):
        for at in range(0, len(alive), max(1, SCAN_CHARS // width)):
            i = alive[at : at + max(1, SCAN_CHARS // width)]
            j = i + d
            longer = size[j] > c[i]
            edit = np.full(len(i), -1)
            wide = c[i] >= WIDE
            edit[wide] = [one_edit(words[x], words[y]) for x, y in zip(i[wide].tolist(), j[wide].tolist(), strict=True)]
            k = np.flatnonzero(~wide)
            left, right = table[i[k]], table[j[k]]
            differ = left != right
            first = differ.argmax(1)
            single = (differ.sum(1) == 1) & ~longer[k]
            moved = np.zeros(len(k), bool)
            m = np.flatnonzero(longer[k])
            behind = (places[:-1] >= first[m, None]) & (places[:-1] < c[i[k[m]], None])
            moved[m] = ~((left[m, :-1] != right[m, 1:]) & behind).any(1)
            edit[k] = np.where(single | moved, first, -1)
            here = (edit >= s[i]) & ((edit < t[i]) | ((edit == c[i]) & (t[i] == c[i])))
            found.append((i[here], j[here]))
        d += 1
        alive = alive[alive + d < ends[alive]]
    return tuple(np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in (0, 1))


def _scan(batches):
    """Near pairs of the blocks of a sorted partition, both ways: (word, n, near, near_n). Holds SCAN_ROWS rows besides one block."""
    names = ["word", "n", "near", "near_n"]
    columns = ["word", "n", "c", "s", "t", "block"]

    def links(rows: pa.Table):
        block = rows.column("block").to_numpy()
        starts = np.flatnonzero(np.diff(block, prepend=~block[0]))
        ends = np.repeat(np.append(starts[1:], len(block)), np.diff(np.append(starts, len(block))))
        words, n = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
        i, j = (pa.array(x) for x in compare(words.to_pylist(), *(rows.column(k).to_numpy() for k in "cst"), ends))
        if len(i):
            a, b, x, y = words.take(i), words.take(j), n.take(i), n.take(j)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(p) for p in ((a, b), (x, y), (b, a), (y, x))], names=names)

    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch]).select(columns)
        held = part if held is None else pa.concat_tables([held, part])
        if len(held) >= SCAN_ROWS:
            block = held.column("block").to_numpy()
            whole = int(np.flatnonzero(block != block[-1]).max(initial=-1)) + 1  # the last block may go on in the next batch
            if whole:
                yield from links(held.slice(0, whole))
                held = held.slice(whole).combine_chunks()
    if held is not None and len(held):
        yield from links(held)


def near_words(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """(word, n, near, near_n): all pairs of distinct words that differ by exactly one inserted, deleted or replaced character, both ways, each once."""
    placed = blocks(words, most).withColumn("longer", F.char_length("word") > F.col("c"))
    ordered = placed.repartition("block").sortWithinPartitions("block", "longer", "word")
    return ordered.mapInArrow(_scan, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where following forms ends. Each round doubles the steps; forms grow in n, so there is no circle."""
    known = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(known.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        known = step.select("word", "root")
        if step.where("moved").isEmpty():
            return known


def spelling_variants(docs: DataFrame, min_chars: int = 7, min_count: int = 2, slip: int = 31, factor: int = 10, most: int = BLOCK) -> DataFrame:
    """Group the corpus's words with the frequent words they are one edit from.

    Returns a row a word of word_counts: word, form, root (string), n, n_near, form_n (long). n_near counts the words one edit away;
    form is the one of largest n (ties: the first in code-point order) if that is at least factor times the word's, else null; root is
    the last word that forms lead to, the word itself if none. Null texts hold no word, a null doc_id counts as an empty one in the slip, repeated rows
    count as often as they stand there; an empty table gives an empty one. Other columns are not looked at.
    """
    words = written(word_counts(docs, min_chars, min_count, slip))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = near_words(words, most).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= factor * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")
    )
    formed = written(formed)
    out = formed.join(roots(formed.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
