"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding look-alikes, normalised by length, with exceptions."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from graphloom.llm.common import annotate, calibrate, labelled, mix, sigmoid, strings

# Insults with weights, the starting lexicon.
SEED_TERMS = {
    "idiot": 3.0, "idiots": 3.0, "stupid": 3.0, "moron": 3.0, "morons": 3.0, "scum": 3.0, "loser": 3.0, "losers": 3.0, "pathetic": 2.5,
    "worthless": 2.5, "disgusting": 2.5, "trash": 2.5, "clown": 2.5, "imbecile": 3.0, "dumbass": 3.5, "bastard": 3.0, "bitch": 3.5,
    "asshole": 3.5, "vermin": 2.5, "retard": 3.5, "fuck": 3.5, "fucking": 3.5, "shit": 3.0, "kill yourself": 4.0,
    "arschloch": 3.5, "vollidiot": 3.5, "abschaum": 3.0, "dummkopf": 3.0, "wertlos": 2.0, "connard": 3.5, "salope": 3.5, "ordure": 2.5,
    "crétin": 3.0, "imbécile": 3.0, "estúpido": 3.0, "imbécil": 3.0, "basura": 2.5, "gilipollas": 3.5, "pendejo": 3.5, "escoria": 2.5,
}
# Phrases in which a term is harmless.
SEED_EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "scum line", "pond scum", "sore loser rule", "bastard file", "idiot proof")
# Characters that stand for letters. l, I, 1 and | read alike, so all of them fold to i.
LOOKALIKES = str.maketrans(
    "ı1lі0οоѕ5$3еє4аα@7тτ8вβ9рρсхχуνнкκмпійáàâäãåéèêëíìîïóòôöõúùûüçñ",
    "iiiiooossseeeaaaatttbbbgppcxxyvhkkmniiaaaaaaeeeeiiiiooooouuuucn",
)
INVISIBLE = re.compile("[­​-‏⁠﻿]")
WORDS = re.compile(r"\w+")
#: A stem is a word's beginning of so many characters.
STEMS = (3, 4, 5, 6, 7)
#: A stem stands for words not seen, so more of the texts that have it must be toxic.
STEM_PRECISION = 0.95


def fold(text: str) -> str:
    """Lower case, without invisible characters, look-alike letters and digits replaced; $ and @ only before a letter."""
    text = INVISIBLE.sub("", text.lower())
    if "$" in text or "@" in text:
        text = re.sub(r"[$@](?!\w)", "#", text)
    return text.replace("|", "#").translate(LOOKALIKES)


SEEDS = {fold(term): w for term, w in SEED_TERMS.items()}


class Lexicon:
    """weights: by folded term; a term that ends in * matches every word that begins so. exceptions: folded phrases."""

    def __init__(self, weights: dict[str, float], exceptions: set[str], slope: float, bias: float):
        self.weights, self.exceptions, self.slope, self.bias = weights, exceptions, slope, bias

    def matcher(self):
        """A function from texts to (raw score normalised by length, hits)."""
        trie = ahocorasick.Automaton()
        for term, w in self.weights.items():
            trie.add_word(term.rstrip("*"), (len(term.rstrip("*")), term.endswith("*"), w))
        for phrase in self.exceptions:
            trie.add_word(phrase, (len(phrase), False, None))
        if len(trie):
            trie.make_automaton()

        def run(text: str) -> tuple[float, int]:
            folded = fold(text)
            found: dict[int, tuple[int, float]] = {}
            excused: list[tuple[int, int]] = []
            n = len(folded)
            for last, (size, stem, w) in trie.iter(folded) if len(trie) else ():
                at, end = last - size + 1, last + 1
                if (at and folded[at - 1].isalnum()) or (not stem and end < n and folded[end].isalnum()):
                    continue
                if w is None:
                    excused.append((at, end))
                elif at not in found or w > found[at][1]:
                    found[at] = (end, w)
            starts = sorted(excused)
            reach = list(accumulate((b for _, b in starts), max))  # how far phrases that begin here or before go
            hits = [w for at, (end, w) in found.items() if not (k := bisect_right(starts, (at, n))) or reach[k - 1] < end]
            return (sum(hits) / np.log2(4 + text.count(" ") + text.count("\n")), len(hits)) if hits else (0.0, 0)

        return run


def copy_key(words: list[str]) -> tuple:
    """Four minwise tokens of the set of words: equal for copies, different for texts that only share frequent words."""
    hashes = np.array([zlib.crc32(w.encode()) for w in set(words)], np.uint64)
    return tuple(int(mix(hashes + np.uint64(k << 32)).min()) for k in range(4)) if len(hashes) else ()


def learn_lexicon(texts: list[str], y: np.ndarray, min_share: float = 0.008, min_precision: float = 0.7, max_terms: int = 5000) -> tuple[dict[str, float], set[str]]:
    """Terms and exceptions from labelled texts, beside the seeds.

    A word or stem enters if at least max(3, min_share of the toxic texts) and min_precision of the texts that have it are
    toxic, more than chance explains among all terms tried (half an accident among them is expected). Weights are smoothed log odds. Near copies count once: texts are counted by the least hashes of their words under four functions (see copy_key()). A stem
    must stand for three words; words under a stem are left to it. Seeds that the labels contradict are dropped.
    """
    folded = [WORDS.findall(fold(text)) for text in texts]
    groups: list[dict[tuple, set[str]]] = [defaultdict(set), defaultdict(set)]
    for words, label in zip(folded, y, strict=True):
        groups[label][copy_key(words)].update(words)
    toxic, clean = max(len(groups[1]), 1), max(len(groups[0]), 1)
    least = max(3, min_share * toxic)
    stems_of = lambda words: {w[:k] + "*" for w in words for k in STEMS if len(w) > k}
    bad = Counter(t for words in groups[1].values() for t in words | stems_of(words))
    bad = Counter({t: n for t, n in bad.items() if n >= least or t in SEEDS})
    good_texts = Counter(t for words in groups[0].values() for t in (words | stems_of(words)) if t in bad or t in SEEDS)
    kin: dict[str, set[str]] = defaultdict(set)
    for words in groups[1].values():
        for w in words:
            for k in STEMS:
                if len(w) > k and w[:k] + "*" in bad:
                    kin[w[:k] + "*"].add(w)
    odds = lambda t: float(np.log((bad[t] + 0.5) / (toxic + 1)) - np.log((good_texts[t] + 0.5) / (clean + 1)))
    base = toxic / (toxic + clean)
    tried = sum(n >= least for n in bad.values())

    def chance(n: int, m: int) -> float:
        """Chernoff's bound on the logarithm of the probability that n or more of n + m texts are toxic by chance."""
        share = n / (n + m)
        return -(n + m) * (share * np.log(share / base) + ((1 - share) * np.log((1 - share) / (1 - base)) if m else 0.0)) if share > base else 0.0

    good = {t for t, n in bad.items() if n >= least and n >= min_precision * (n + good_texts[t]) and chance(n, good_texts[t]) <= np.log(0.5 / tried)}
    stems: set[str] = set()
    for t in sorted((t for t in good if t.endswith("*") and len(kin[t]) >= 3 and bad[t] >= STEM_PRECISION * (bad[t] + good_texts[t])), key=lambda t: (len(t), t)):
        if not any(t.startswith(s[:-1]) for s in stems):
            stems.add(t)
    chosen = stems | {t for t in good if not t.endswith("*") and not any(t.startswith(s[:-1]) for s in stems)}
    weights = {t: odds(t) for t in sorted(chosen, key=lambda t: (-odds(t), t))[:max_terms]}
    for term, w in SEEDS.items():
        if good_texts[term] <= 1 + bad[term]:
            weights.setdefault(term, w)
    pairs = [Counter(), Counter()]
    for words, label in zip(folded, y, strict=True):
        pairs[label].update((a, b) for a, b in zip(words, words[1:], strict=False) if a in weights or b in weights)
    exceptions = {fold(x) for x in SEED_EXCEPTIONS} | {f"{a} {b}" for (a, b), n in pairs[0].items() if n >= 3 and not pairs[1][a, b]}
    return weights, exceptions


def fit(texts: list[str], y: np.ndarray) -> Lexicon:
    lexicon = Lexicon(*learn_lexicon(texts, y), 2.0, -2.5)
    if len(y) and y.min() < y.max():
        run = lexicon.matcher()
        lexicon.slope, lexicon.bias = calibrate(np.log1p([run(t)[0] for t in texts]), y)
    return lexicon


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample_rows: int = 6000, threshold: float = 0.3) -> DataFrame:
    """docs with score (double, 0 to 1), n_hits (long) and predicted (int).

    The lexicon is fitted on at most sample_rows labelled rows (see labelled()) for which learn holds, and has a bounded
    number of terms; every whole text is then scanned once, without a shuffle. score: the sum of the matched terms' weights
    over the logarithm of the length, the logarithm of one more than that through a calibrated logistic. Null texts count as empty and score lowest.
    Without labels the seed lexicon and a fixed scale serve. Repeated rows score alike.
    """
    lexicon = fit(*labelled(docs, labels, "toxic", sample_rows, learn))
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.weights, lexicon.exceptions))  # plain values: executors may lack this module
    slope, bias = lexicon.slope, lexicon.bias

    def make():
        run = Lexicon(*shared.value, slope, bias).matcher()

        def batches(batch):
            found = [run(t) for t in strings(batch, "text").to_pylist()]
            score = sigmoid(slope * np.log1p(np.array([x[0] for x in found], float)) + bias)
            return {"score": pa.array(score), "n_hits": pa.array([x[1] for x in found], pa.int64()), "predicted": pa.array((score >= threshold).astype(np.int32))}

        return batches

    return annotate(docs, make, {"score": "double", "n_hits": "long", "predicted": "int"})
