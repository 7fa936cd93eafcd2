"""Personal data: spans by pattern, and terms that corpus co-occurrence shows to disclose a protected entity."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import LOWER, NO_ID, annotate, cut, id_of, mix, pack, raw, slices, span_hashes, strings, text_of, unpack, word_spans

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # only a run's first digit can begin a match
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
#: Words on each side of an entity that count as occurring with it.
WINDOW = 8
#: Bits of the bitmap of candidate terms that a scan looks for: 2 MB, whatever the data.
BITMAP = 24
#: Odd multipliers of the minwise hashes of a text's words: texts that agree in all of them are copies.
FACTORS = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
#: Bytes of text over which a scan counts the words it found near entities: a lower bound of their number in the corpus.
BLOCK = 16 << 20
#: A word of so many bytes that mixes letters and digits is a code: it may be a key, a token or a password.
CODE_BYTES = 12
DIGITS, LOWERS, UPPERS = (np.zeros(256, bool) for _ in range(3))
DIGITS[48:58], LOWERS[97:123], UPPERS[65:91] = True, True, True
MARKS = np.zeros(256, bool)
MARKS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain: each holds one @, and starts where its run of local characters or the last match does."""
    at = floor = 0
    while (k := text.find("@", at)) >= 0:
        a = k
        while a > floor and text[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(text, k + 1) if a < k else None
        if m:
            yield a, m.end()
            at = floor = m.end()
        else:
            at = k + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(small(p) for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if len(m[0]) >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def entity(kind: int, value: str) -> int:
    """64-bit identity of a protected value: letters in lower case, of numbers the digits."""
    value = value.lower() if kind < 2 else "".join(c for c in value if c.isdigit())
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, words before each text): blank-separated words without ASCII marks at both ends, A-Z lower-cased."""
    starts, ends, first = word_spans(data, offsets)
    for _ in range(8):
        starts = starts + (MARKS[data[starts]] & (starts < ends - 1))
        ends = ends - (MARKS[data[ends - 1]] & (ends > starts + 1))
    return starts, ends, span_hashes(LOWER[data], starts, ends).view(np.int64), first


def copy_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit key of each text's set of words, of four minwise tokens: equal for copies, mostly equal for near copies (of word similarity
    s with probability s^4), different for texts that only share frequent words. Without words 0."""
    out = np.zeros(len(first) - 1, np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        for factor in FACTORS:
            low = np.minimum.reduceat(mix(hashes.view(np.uint64) * factor), first[some])
            out[some] = mix(out[some] * np.uint64(0x9E3779B97F4A7C15) + low + np.uint64(1))
    return out.view(np.int64)


def codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which words are codes, their shapes): a shape is the kinds of letters a code has and its length's power of two."""
    within = lambda flags: (lambda sums: sums[ends] > sums[starts])(np.concatenate([[0], np.cumsum(flags[data], dtype=np.int32)]))
    lower, upper = within(LOWERS), within(UPPERS)
    which = np.flatnonzero(within(DIGITS) & (lower | upper) & (ends - starts >= CODE_BYTES))
    return which, lower[which] + 2 * upper[which] + 4 * np.log2(np.maximum(ends - starts, 1)[which]).astype(np.int64)


def counted(rows: list[tuple], words: list[np.ndarray]) -> Iterator[tuple]:
    """rows, with (block, occurrences in the block) added to each word near an entity; words: the hashes of all words of the block."""
    wanted = np.unique(np.array([t for _, near, *_ in rows for _, t, _ in near], np.int64))
    if not len(wanted):
        yield from rows
        return
    mask = (1 << 20) - 1
    bits, counts, block = np.zeros(mask + 1, bool), np.zeros(len(wanted), np.int64), 0
    bits[wanted & mask] = True
    for hashes in words:
        hit = hashes[bits[hashes & mask]]
        at = np.minimum(np.searchsorted(wanted, hit), len(wanted) - 1)
        counts += np.bincount(at[wanted[at] == hit], minlength=len(wanted))
        block = int(mix(np.array([block], np.uint64) + hashes.view(np.uint64).sum(dtype=np.uint64))[0])
    block -= 1 << 63
    numbers = dict(zip(wanted.tolist(), counts.tolist(), strict=True))
    for spans, near, *rest in rows:
        yield spans, [(e, t, g, block, numbers[t]) for e, t, g in near], *rest


def scan(texts: pa.Array):
    """For each text: its base spans, the (entity, term, group, block, occurrences in the block) of words near them, its number of words,
    its codes as (hash, shape, start, end) in code points, and its group.

    group stands for a document and its copies (see copy_keys()), block for about BLOCK bytes of texts; blocks of the same texts are one.
    """
    data, offsets = raw(texts)
    values = texts.to_pylist()
    for i, j in slices(offsets, BLOCK):
        words: list[np.ndarray] = []
        rows = list(scan_block(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], values[i:j], words))
        yield from counted(rows, words)


def scan_block(data: np.ndarray, offsets: np.ndarray, values: list[str], words: list[np.ndarray]) -> Iterator[tuple]:
    """The rows of scan() before words are counted; the hashes of all words are put into words."""
    for i, j in slices(offsets):
        part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, hashes, first = terms(part, own)
        words.append(hashes)
        groups = copy_keys(hashes, first)
        coded, shapes = codes(part, starts, ends)
        points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)]) if len(coded) else None
        upto = np.searchsorted(coded, first)
        for k in range(i, j):
            text = values[k]
            spans, near = base_spans(text), []
            lo, hi = first[k - i], first[k - i + 1]
            if spans:
                group = int(groups[k - i])
                taken = [(len(text[:a].encode()) + own[k - i], len(text[:b].encode()) + own[k - i]) for _, a, b in spans]
                covered = np.zeros(hi - lo, bool)
                for a, b in taken:
                    covered |= (ends[lo:hi] > a) & (starts[lo:hi] < b)
                free = np.flatnonzero(~covered) + lo
                for (kind, a, b), (x, _) in zip(spans, taken, strict=True):
                    who = entity(kind, text[a:b])
                    at = int(np.searchsorted(starts[free], x))
                    near += [(who, int(hashes[w]), group) for w in free[max(0, at - WINDOW) : at + WINDOW]]
            own_codes = slice(upto[k - i], upto[k - i + 1])
            found = [(int(hashes[w]), int(shape), *(int(points[x[w]] - points[own[k - i]]) for x in (starts, ends))) for w, shape in zip(coded[own_codes], shapes[own_codes], strict=True)]
            yield spans, near, int(hi - lo), found, int(groups[k - i])


def found_spans(docs: DataFrame) -> DataFrame:
    """The columns of docs but _text, with _t, _n (array of long by kind), _spans (k: kind, s, e), _near, _words, _g (group) and _codes."""
    span_type = pa.list_(pa.struct([("k", pa.int64()), ("s", pa.int64()), ("e", pa.int64())]))
    code_type = pa.list_(pa.struct([("t", pa.int64()), ("c", pa.int64()), ("s", pa.int64()), ("e", pa.int64())]))
    near_type = pa.list_(pa.struct([(k, pa.int64()) for k in "etgbn"]))

    def make():
        def run(batch):
            spans, near, words, coded, groups = zip(*scan(strings(batch, "_text")), strict=True) if batch.num_rows else ((),) * 5
            return {
                "_n": pa.array([[sum(s[0] == k for s in x) for k in range(4)] for x in spans], pa.list_(pa.int64())),
                "_spans": pa.array([[dict(zip("kse", y, strict=True)) for y in x] for x in spans], span_type),
                "_near": pa.array([[dict(zip("etgbn", x, strict=True)) for x in rows] for rows in near], near_type),
                "_words": pa.array(words, pa.int64()),
                "_g": pa.array(groups, pa.int64()),
                "_codes": pa.array([[dict(zip("tcse", x, strict=True)) for x in rows] for rows in coded], code_type),
            }

        return run

    added = {"_n": "array<long>", "_spans": "array<struct<k:long,s:long,e:long>>", "_near": "array<struct<e:long,t:long,g:long,b:long,n:long>>", "_words": "long", "_g": "long", "_codes": "array<struct<t:long,c:long,s:long,e:long>>"}
    return annotate(docs.withColumn("_t", F.xxhash64("_text")), make, added).drop("_text")


def bitmap_of(df: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size with a bit for each value's low bits."""
    x = df.select((F.col(column).bitwiseAND((1 << BITMAP) - 1) + 1).alias("x"))
    parts = x.groupBy(F.bitmap_bucket_number("x").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("m")).collect()
    out = np.zeros(1 << BITMAP >> 3, np.uint8)
    for r in parts:  # at most 2^BITMAP bits in all
        at = (r["b"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return np.unpackbits(out, bitorder="little").astype(bool)


def looked_for(docs: DataFrame, wanted: np.ndarray, positions: bool) -> DataFrame:
    """Occurrences of terms whose bit is set: (t, n) counts a batch, or (_d, _t, t, start, end) in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(batches):
        bits = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            texts = strings(batch, "_text")
            data, offsets = raw(texts)
            rows: list[list] = [[] for _ in range(5)]
            for i, j in slices(offsets):
                part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends, hashes, first = terms(part, own)
                hit = np.flatnonzero(bits[hashes & ((1 << BITMAP) - 1)])
                if not positions:
                    t, n = np.unique(hashes[hit], return_counts=True)
                    rows[0].append(t)
                    rows[1].append(n)
                elif len(hit):
                    points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
                    doc = np.searchsorted(first, hit, "right") - 1
                    for k, v in enumerate((i + doc, hashes[hit], points[starts[hit]] - points[own[doc]], points[ends[hit]] - points[own[doc]])):
                        rows[k].append(v)
            flat = [np.concatenate(r).astype(np.int64) if r else np.zeros(0, np.int64) for r in rows]
            if positions:
                ids, keys = (batch.column(c).to_numpy() for c in ("_d", "_t"))
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (ids[flat[0]], keys[flat[0]], *flat[1:4])], names=["_d", "_t", "t", "start", "end"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(flat[0]), pa.array(flat[1])], names=["t", "n"])

    return docs.mapInArrow(run, "_d long, _t long, t long, start long, end long" if positions else "t long, n long")


def disclosing_terms(found: DataFrame, docs: DataFrame, alpha: float, level: float) -> DataFrame | None:
    """(t, disclosure) of terms that disclose an entity: pointwise mutual information of at least 1 / alpha of the entity's information.

    An entity e has information -log2 P(e); a term t tells log2(P(e, t) / (P(e) P(t))) of it: all, if it occurs with e alone.
    Occurrences are counted over all documents. Besides, chance must not explain the pair: were t spread over the groups of
    documents at random, it would meet e as often with a probability of at most level, divided by the number of pairs found in the corpus
    (Chernoff's bound). Copies are one group, so they are no evidence; of an entity most of whose
    documents are copies, the unlike rest are most likely near copies, and groups count by the effective number (inverse Simpson) of its texts
    over the number of its groups. An entity of one document can disclose terms only where few pairs are tried.

    A term's occurrences in the blocks where it stands near an entity are no more than all its occurrences. Both tests fail for good beyond some
    number of occurrences, so terms that fail on these blocks alone are left out of the scan that counts the rest over all documents.
    """
    near = found.select(F.explode("_near").alias("x")).select("x.*")
    pairs = near.groupBy("e", "t", "g").count().groupBy("e", "t").agg(F.sum("count").alias("n_et"), F.count("*").alias("groups"))
    every = found.agg(F.countDistinct("_g").alias("groups"), F.sum("_words").alias("words")).first()
    texts = found.select(F.explode(F.array_distinct(F.transform("_near", lambda x: x["e"]))).alias("e"), "_g").groupBy("e", "_g").agg(F.count("*").alias("c"))
    seen = texts.groupBy("e").agg(F.sum("c").alias("n_e"), F.count("*").alias("g_e"), (F.pow(F.sum("c"), F.lit(2)) / F.sum(F.col("c") * F.col("c"))).alias("apart_e"))
    least = near.groupBy("t", "b").agg(F.max("n").alias("n")).groupBy("t").agg(F.sum("n").alias("least_t"))
    pairs = cut(pairs)
    chance, limit = F.col("g_e") / F.lit(max(every["groups"], 1)), F.lit(math.log(level / max(pairs.count(), 1)))
    total = every["words"] or 1

    def disclosure(n_t: Column) -> Column:
        information = -F.log2(F.col("n_e") / total)
        return F.log2(F.least(F.col("n_et"), n_t) * total / (n_t * F.col("n_e"))) / information

    def holds(n_t: Column) -> Column:
        """Whether a term of n_t occurrences discloses; if it does not, it does not with more of them either."""
        apart = F.greatest(n_t - F.col("n_et"), F.lit(0))  # each occurrence elsewhere counts as a group of its own
        share = F.col("groups") / (F.col("groups") + apart)
        likely = -(F.col("groups") * F.log(share / F.col("q")) + F.when(apart > 0, apart * F.log((1 - share) / (1 - F.col("q")))).otherwise(0.0))
        return (share > F.col("q")) & (likely <= limit) & (disclosure(n_t) >= 1 / alpha)

    known = pairs.join(seen, "e").withColumn("q", chance).where(F.col("groups") * F.col("apart_e") / F.col("g_e") * F.log("q") <= limit)
    known = cut(known.join(least, "t").where(holds(F.col("least_t"))))
    if known.isEmpty():
        return None
    counts = looked_for(docs, bitmap_of(known, "t"), False).groupBy("t").agg(F.sum("n").alias("n_t"))
    known = known.join(counts, "t").where(holds(F.col("n_t")))
    return cut(known.groupBy("t").agg(F.max(disclosure(F.col("n_t"))).alias("disclosure")))


def disclosing_shapes(found: DataFrame, alpha: float, level: float) -> DataFrame:
    """(c, disclosure) of the shapes whose codes disclose the document they stand in, as keys, tokens and passwords do.

    A code that g of N groups of documents hold tells log2(N / g) of the log2(N) bits that a document's identity takes. The values of one
    shape seldom recur, so the shape is judged: by the mean share of its values, less what chance may add to a mean of so many (Hoeffding's
    bound at level). It must reach 1 / alpha. Names of standards and versions, which many documents share, tell little.
    """
    every = found.agg(F.countDistinct("_g").alias("groups"))
    each = found.select("_g", F.explode("_codes").alias("x")).groupBy("x.c", "x.t").agg(F.countDistinct("_g").alias("g"))
    share = 1 - F.log2("g") / F.log2(F.greatest("groups", F.lit(2)))
    shapes = each.crossJoin(F.broadcast(every)).groupBy("c").agg(F.avg(share).alias("disclosure"), F.count("*").alias("values"))  # one row
    return shapes.where(F.col("disclosure") - F.sqrt(-F.log(F.lit(level)) / (2 * F.col("values"))) >= 1 / alpha).select("c", "disclosure")


def personal_spans(docs: DataFrame, alpha: float = 1.25, level: float = 0.05) -> DataFrame:
    """A row for each row of docs: doc_id, n_email, n_ip, n_card, n_phone, n_term, n_spans (long), base_spans and spans
    (string), entities and terms (arrays) and _t (hash of the text) for sanitise().

    The four kinds are found by pattern in every whole text. The method adds kind term: words that, by co-occurrence over the whole
    corpus, disclose an entity (see disclosing_terms()) or, as codes of a disclosing shape do, the document itself (see
    disclosing_shapes()), wherever they stand outside base spans. A span string lists kind:start:end in code points, end exclusive, by
    kind and start, joined by commas. n_spans counts all spans.

    Null texts count as empty. Repeated rows get the same spans. An empty table gives an empty one. Texts are scanned in place
    and never shuffled; only words near entities, counts, and positions of disclosing terms move.
    """
    texts = docs.select(id_of().alias("_d"), text_of().alias("_text"))
    found = cut(found_spans(texts))
    texts = texts.withColumn("_t", F.xxhash64("_text"))
    flagged = disclosing_terms(found, texts, alpha, level)
    if flagged is None:
        found = found.withColumn("_terms", F.expr("cast(array() as array<struct<start:long,end:long,disclosure:double>>)"))
    else:
        places = looked_for(texts, bitmap_of(flagged, "t"), True).join(flagged, "t").select("_d", "_t", F.struct("start", "end", "disclosure").alias("p"))
        found = found.join(cut(places.groupBy("_d", "_t").agg(F.array_sort(F.collect_set("p")).alias("_terms"))), ["_d", "_t"], "left")
    shapes = {r["c"]: r["disclosure"] for r in disclosing_shapes(found, alpha, level).collect()}  # at most 4 kinds times 31 lengths
    table = F.create_map(*[F.lit(x) for pair in shapes.items() for x in pair]) if shapes else F.expr("cast(map() as map<bigint,double>)")
    coded = F.transform(F.filter("_codes", lambda x: F.map_contains_key(table, x["c"])), lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), table[x["c"]].alias("disclosure")))
    known = F.filter(F.coalesce("_terms", F.array()), lambda t: ~F.exists(coded, lambda x: (t["start"] < x["end"]) & (t["end"] > x["start"])))
    own = F.filter(F.array_sort(F.concat(known, coded)), lambda t: ~F.exists("_spans", lambda s: (t["start"] < s["e"]) & (t["end"] > s["s"])))
    found = found.withColumn("_own", own)
    names = F.array(*[F.lit(k) for k in KINDS])
    base = F.concat_ws(",", F.transform("_spans", lambda s: F.concat_ws(":", F.element_at(names, (s["k"] + 1).cast("int")), s["s"].cast("string"), s["e"].cast("string"))))
    more = F.concat_ws(",", F.transform("_own", lambda t: F.concat_ws(":", F.lit("term"), t["start"].cast("string"), t["end"].cast("string"))))
    return found.select(
        F.when(F.col("_d") != NO_ID, F.col("_d")).alias("doc_id"),
        *[F.element_at("_n", k + 1).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.size("_own").cast("long").alias("n_term"),
        (F.size("_own") + F.size("_spans")).cast("long").alias("n_spans"),
        base.alias("base_spans"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(more, F.lit(""))).alias("spans"),
        F.col("_spans").alias("entities"),
        F.col("_own").alias("terms"),
        "_t",
    )


def kind_of(word: str) -> str:
    return "[CODE]" if any(c.isdigit() for c in word) else "[NAME]" if word[:1].isupper() else "[WORD]"


def sanitise(docs: DataFrame, alpha: float = 1.25, level: float = 0.05, remove_at: float = 0.95) -> DataFrame:
    """docs with sanitised_text (string): entities replaced by their kind, terms whose disclosure reaches remove_at removed, other
    disclosing terms generalised to the class of their characters. Texts are shuffled once, to meet their spans.

    Overlapping entities are replaced together by the first one's kind. Null texts give ''. See personal_spans().
    """
    spans = personal_spans(docs, alpha, level).withColumn("_d", F.coalesce("doc_id", F.lit(NO_ID))).select("_d", "_t", "entities", "terms").dropDuplicates(["_d", "_t"])
    base = pack(docs, _d=id_of(), _text=text_of()).withColumn("_t", F.xxhash64("_text")).join(spans, ["_d", "_t"], "left")

    def make():
        def run(batch):
            out = []
            for text, entities, terms_ in zip(*(batch.column(c).to_pylist() for c in ("_text", "entities", "terms")), strict=True):
                marks = [(s["s"], s["e"], f"[{KINDS[s['k']].upper()}]") for s in entities or ()]
                marks += [(t["start"], t["end"], "" if t["disclosure"] >= remove_at else kind_of(text[t["start"] : t["end"]])) for t in terms_ or ()]
                parts, at = [], 0
                for a, b, name in sorted(marks):
                    if a >= at:
                        parts += [text[at:a], name]
                    at = max(at, b)
                out.append("".join([*parts, text[at:]]))
            return {"_clean": pa.array(out, pa.string())}

        return run

    return unpack(annotate(base, make, {"_clean": "string"}), docs.columns, sanitised_text=F.col("_clean"))
