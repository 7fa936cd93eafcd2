import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from graphloom.llm import toxicity as tx
from graphloom.llm.quality_classifier import folds


def test_folding():
    assert tx.fold("1D10T") == tx.fold("idiot")
    assert tx.fold("ІDІОТ") == tx.fold("idiot")
    assert tx.fold("tra$h @ home$") == tx.fold("trash") + " # home#".replace("home", tx.fold("home"))
    assert tx.fold("st­up​id") == tx.fold("stupid")


def test_matching():
    lexicon = tx.Lexicon({tx.fold("idiot"): 3.0, tx.fold("trash"): 2.0, "vex*": 1.0}, {tx.fold("trash can")}, 1.0, 0.0)
    run = lexicon.matcher()
    assert [run(t)[1] for t in ("You IDIOT!", "idiotic", "the trash can", "trash cans", "trash", "vexing", "convex", "", "1d1ot trash")] == [1, 0, 0, 1, 1, 1, 0, 0, 2]
    assert run("idiot")[0] > run("idiot" + " word" * 1000)[0] > 0
    assert tx.Lexicon({}, set(), 1.0, 0.0).matcher()("idiot") == (0.0, 0)


def test_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet").where("lang = 'en'"), spark.read.parquet(f"{d}/labels.parquet")
    out = tx.toxicity(docs, labels, learn=folds(4) != 2).withColumn("held_out", folds(4) == 2).join(labels, "doc_id").where("held_out").toPandas()
    assert out[out.toxic == 1].predicted.mean() > 0.9
    assert out[out.toxic == 0].predicted.mean() < 0.02


def test_odd_rows(odd, labels):
    out = tx.toxicity(odd, labels)
    assert out.count() == 12
    assert dict(out.dtypes)["score"] == "double"
    assert tx.toxicity(odd.limit(0), labels.limit(0)).count() == 0


def test_texts_that_share_frequent_words_are_no_copies():
    import itertools
    import zlib

    import numpy as np

    common = min(("".join(w) for w in itertools.product("bcdfghkmnp", repeat=5)), key=lambda w: zlib.crc32(w.encode()))  # the least hash of all
    texts = [f"{common} gronpish " + " ".join(f"a{i}x{j}" for j in range(60)) for i in range(40)] + [f"{common} " + " ".join(f"b{i}x{j}" for j in range(60)) for i in range(200)]
    weights, _ = tx.learn_lexicon(texts, np.array([1] * 40 + [0] * 200))
    assert weights.get("gronpish", 0) > 0 or any("gronpish".startswith(w[:-1]) for w in weights if w.endswith("*"))
    copies = [texts[0]] * 40 + texts[40:]
    assert "gronpish" not in tx.learn_lexicon(copies, np.array([1] * 40 + [0] * 200))[0]


TERMS, PHRASES = {"ab": 3.0, "ab cd": 2.0, "cd": 1.0, "e*": 0.5}, {"ab cd ab", "cd e", "x ab", "ef gh"}


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["ab", "cd", "e", "ef", "gh", "x", "."]), max_size=14).map(" ".join))
def test_matcher_by_brute_force(text):
    """Of terms at one place the heaviest counts, unless an exception covers it whole."""
    found, excused = {}, []
    whole = [(t, rf"(?<!\w){re.escape(t)}(?!\w)") for t in [*TERMS, *PHRASES] if t != "e*"] + [("e*", r"(?<!\w)e")]
    for term, pattern in whole:
        for at in range(len(text)):
            m = re.compile(pattern).match(text, at)
            if m and term in PHRASES:
                excused.append(m.span())
            elif m and TERMS[term] > found.get(at, (0, 0))[1]:
                found[at] = (m.end(), TERMS[term])
    hits = [w for at, (end, w) in found.items() if not any(a <= at and end <= b for a, b in excused)]
    score, n = tx.Lexicon(TERMS, PHRASES, 1.0, 0.0).matcher()(text)
    assert n == len(hits)
    assert score == (sum(hits) / np.log2(4 + text.count(" ")) if hits else 0.0)


def test_many_exceptions_in_a_long_text():
    run = tx.Lexicon({tx.fold("trash"): 2.0}, {tx.fold("trash can")}, 1.0, 0.0).matcher()
    began = time.process_time()
    assert run("trash can and " * 150_000 + "trash")[1] == 1
    assert time.process_time() - began < 20
