import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from graphloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


@settings(max_examples=2000, deadline=None)
@given(st.text("a.b-@1 2+(3)%4_5é\n0", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_known_values():
    text = "Ü a@b.co 4111 1111 1111 1111, 10.0.0.300 10.0.0.3 +1 (555) 123-4567, " + "9" * 6000
    assert [(pii.KINDS[k], text[a:b]) for k, a, b in pii.base_spans(text)] == [("email", "a@b.co"), ("ip", "10.0.0.3"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 123-4567")]


def test_terms_that_disclose(spark):
    rows = [(i, f"filler{i} note number{i} about projectzebra sent to boss{i % 1}x q@zebra.org today{i} by clerk{i}") for i in range(8)]
    rows += [(100 + i, f"plain text{i} that mentions the weather{i} today{i} and to sent about note") for i in range(60)]
    rows += [(200, "a late hint: Projectzebra, again")]
    got = {r.doc_id: r for r in pii.personal_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    assert {text[200][t["start"] : t["end"]] for t in got[200].terms} == {"Projectzebra"}
    assert got[100].n_term == 0
    assert got[0].base_spans in got[0].spans
    assert "term:" in got[0].spans
    clean = {r.doc_id: r.sanitised_text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert clean[200] == "a late hint: , again"
    assert "[EMAIL]" in clean[0]
    assert clean[101] == text[101]


def test_copies_are_no_evidence(spark):
    rows = [(i, "the same secretword next to q@zebra.org in every copy") for i in range(50)]
    got = pii.personal_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.agg({"n_term": "sum"}).first()[0] == 0


def test_entities_of_few_documents_disclose_terms(spark):
    """Of one document, of two; a word that others use as well tells nothing. All texts hold the same frequent words."""
    rows = [(i, f"the of and to note{i % 700} about weather{i % 900} today rain{i} sun{i % 1100} wind{i % 1300} fog{i % 1700}") for i in range(6000)]
    rows += [(9000, "the of and to by quagmire of one@zebra.org today"), (9001, "and to the heronfly of two@zebra.org of note1"), (9002, "of and the heronfly to two@zebra.org and note2 about")]
    rows += [(9003, "a hint to the of and quagmire")]
    got = {r.doc_id: r.terms for r in pii.personal_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    words = {i: {text[i][t["start"] : t["end"]] for t in terms} for i, terms in got.items() if terms}
    assert "heronfly" in words[9001] & words[9002]
    assert "quagmire" in words[9000] & words[9003]
    assert all(not w & {"the", "of", "and", "to", "today", "about"} for w in words.values())


def test_frequent_words_do_not_make_copies():
    import pyarrow as pa

    texts = [f"the of and to note{i} about weather{i * 7} and sun{i * 3} or rain{i * 5}" for i in range(300)]
    keys = [g for *_, g in pii.scan(pa.array([*texts, *texts, ""], pa.large_string()))]
    assert keys[:300] == keys[300:600]
    assert len(set(keys[:300])) > 270


def test_odd_rows(odd):
    assert pii.personal_spans(odd).count() == 12
    out = pii.sanitise(odd)
    assert out.count() == 12
    assert set(out.columns) == {*odd.columns, "sanitised_text"}
    assert pii.personal_spans(odd.limit(0)).count() == 0


def test_codes_of_a_shape_that_tells_documents_apart(spark):
    """Keys that each stand in one document; a standard's name that many share is of another shape and tells little."""
    import random

    random.seed(3)
    key = lambda: "AKIA" + "".join(random.choice("ABCDEFGHIJ23456789") for _ in range(16))
    rows = [(i, f"note{i} about weather{i * 7} rain{i * 3} by iso8859latin1text" + (f" key ({key()}), kept" if i % 3 == 0 else "")) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(20)]  # copies count once
    got = {r.doc_id: r for r in pii.personal_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    for i, r in got.items():
        assert [text[i][t["start"] : t["end"]][:4] for t in r.terms] == ["AKIA"] * ("AKIA" in text[i])
        assert r.n_spans == r.n_term == len(r.terms)


def test_few_codes_are_no_evidence(spark):
    rows = [(i, f"note{i} about weather{i * 7} rain{i * 3} zq{i * i}x88812345yz") for i in range(12)]
    assert pii.personal_spans(spark.createDataFrame(rows, "doc_id long, text string")).agg({"n_term": "sum"}).first()[0] == 0


def test_words_near_an_entity_are_counted_over_their_block(monkeypatch):
    texts = ["Ann writes a@b.org the the x", "the y the", "the lone one", "bob b@c.org the"]
    word = lambda w: int(pii.terms(*pii.raw(pa.array([w], pa.large_string())))[2][0])
    rows = list(pii.scan(pa.array(texts, pa.large_string())))
    counts = {t: n for _, near, *_ in rows for _, t, _, _, n in near}
    assert counts == {word("ann"): 1, word("writes"): 1, word("the"): 6, word("x"): 1, word("bob"): 1}
    assert len({b for _, near, *_ in rows for *_, b, _ in near}) == 1
    monkeypatch.setattr(pii, "BLOCK", 1)  # each text is a block
    single = list(pii.scan(pa.array(texts, pa.large_string())))
    assert [{t: n for _, t, _, _, n in near}.get(word("the")) for _, near, *_ in single] == [2, None, None, 1]
    assert [(r[0], r[2:]) for r in single] == [(r[0], r[2:]) for r in rows]
