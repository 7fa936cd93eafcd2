import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from graphloom.sources import pdf, providers


def texts_of(content):
    file = pdf.Pdf(content)
    return [bytes.fromhex(re.search(rb"<(.*)>", file[page[b"/Contents"]].body)[1].decode()).decode("utf-16-be") for _, page in file.pages()[0]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=30), st.booleans(), st.data())
def test_count_and_part(texts, packed, data):
    content = pdf.made(texts, packed)
    assert pdf.page_count(content) == len(texts)
    assert texts_of(content) == texts
    start = data.draw(st.integers(0, len(texts) - 1))
    end = data.draw(st.integers(start + 1, len(texts)))
    some = pdf.part(content, start, end)
    assert texts_of(some) == texts[start:end]
    assert pdf.Pdf(some).pages()[0][0][1][b"/MediaBox"] == [b"0", b"0", b"595", b"842"]


@pytest.mark.parametrize("packed", [False, True])
def test_damaged_files(packed):
    """A lost or wrong cross-reference, bytes before the head: objects are searched. Nothing raises but ValueError on arbitrary damage."""
    content = pdf.made([f"page {k}" for k in range(9)], packed)
    assert pdf.page_count(content[: content.rindex(b"startxref")]) == 9
    assert pdf.page_count(b"mail header\n" + content) == 9
    assert pdf.page_count(re.sub(rb"startxref\n\d+", b"startxref\n7", content)) == 9
    rng = random.Random(1)
    for _ in range(150):
        hurt = bytearray(content)
        for _ in range(rng.randint(1, 30)):
            hurt[rng.randrange(len(hurt))] = rng.randrange(256)
        try:
            pdf.page_count(bytes(hurt[: rng.randrange(len(hurt))]))
        except ValueError:
            pass
        pdf.part(bytes(hurt), 0, 1)


def test_tree_with_levels_inheritance_and_links():
    objects = [
        {b"/Type": b"/Catalog", b"/Pages": pdf.Ref(2)},
        {b"/Type": b"/Pages", b"/Count": b"3", b"/Kids": [pdf.Ref(3), pdf.Ref(4), pdf.Ref(99)], b"/Rotate": b"90"},
        {b"/Type": b"/Pages", b"/Count": b"2", b"/Parent": pdf.Ref(2), b"/Kids": [pdf.Ref(5), pdf.Ref(6)], b"/Resources": pdf.Ref(7)},
        {b"/Type": b"/Page", b"/Parent": pdf.Ref(2)},
        {b"/Type": b"/Page", b"/Parent": pdf.Ref(3), b"/Annots": [{b"/Dest": [pdf.Ref(6), b"/Fit"], b"/A": b"(go (there\\)) now)"}]},
        {b"/Type": b"/Page", b"/Parent": pdf.Ref(3), b"/Rotate": b"0"},
        {b"/Font": {b"/F1": pdf.Ref(8)}},
        {b"/Type": b"/Font", b"/Self": pdf.Ref(8)},
    ]
    content = pdf._file(objects)
    assert pdf.page_count(content) == 3
    some = pdf.Pdf(pdf.part(content, 0, 1))
    ((_, page),) = some.pages()[0]
    assert page[b"/Annots"] == [{b"/Dest": [b"null", b"/Fit"], b"/A": b"(go (there\\)) now)"}]
    assert (page[b"/Rotate"], some[some[some[page[b"/Resources"]][b"/Font"][b"/F1"]][b"/Self"]][b"/Type"]) == (b"90", b"/Font")
    assert len(some.places) == 6  # the other pages did not come along
    objects[2][b"/Kids"] = [pdf.Ref(3)]
    assert pdf.page_count(pdf._file(objects)) == 3  # a tree that holds itself: plain page objects count


def test_newer_parts_and_predictors():
    """A file with an appended update that adds a page; a cross-reference stream with PNG's Up predictor."""
    content = pdf.made(["one"])
    at = len(content)
    more = b"2 0 obj\n<</Type /Pages /Count 2 /Kids [3 0 R 9 0 R]>>\nendobj\n"
    page = b"9 0 obj\n<</Type /Page /Parent 2 0 R>>\nendobj\n"
    old = int(re.findall(rb"startxref\s+(\d+)", content)[-1])
    table = b"xref\n2 1\n%010d 00000 n \n9 1\n%010d 00000 n \ntrailer\n<</Size 10 /Root 1 0 R /Prev %d>>\nstartxref\n%d\n%%%%EOF" % (at, at + len(more), old, at + len(more) + len(page))
    assert pdf.page_count(content + more + page + table) == 2
    packed = pdf.made(["a", "b"], True)
    head, body = packed[: packed.rindex(b" 0 obj\n")], pdf.Pdf(packed)._at(int(re.findall(rb"startxref\s+(\d+)", packed)[-1]))
    rows = zlib.decompress(body.body)
    rows = [rows[k : k + 7] for k in range(0, len(rows), 7)]
    up = b"".join(b"\x02" + bytes((x - y) & 255 for x, y in zip(r, above, strict=True)) for r, above in zip(rows, [bytes(7), *rows], strict=False))
    new = {**body.head, b"/DecodeParms": {b"/Predictor": b"12", b"/Columns": b"7"}, b"/Length": b"%d" % len(zlib.compress(up))}
    assert pdf.page_count(head + b" 0 obj\n" + pdf._bytes(new) + b"\nstream\n" + zlib.compress(up) + b"\nendstream\nendobj\nstartxref\n%d\n%%%%EOF" % (head.rindex(b"\n") + 1)) == 2
    for kind in (1, 3, 4):
        row, above, flat = bytes(range(5, 12)), bytes(7), bytearray([kind])
        for k, x in enumerate(row):
            left = row[k - 1] if k else 0
            flat.append((x - {1: left, 3: left // 2, 4: left}[kind]) & 255)
        assert pdf._unpredicted(bytes(flat), 7) == row, above


def test_encrypted_files_fail():
    content = pdf.made(["secret"]).replace(b"/Root 1 0 R", b"/Root 1 0 R /Encrypt 4 0 R")
    with pytest.raises(ValueError, match="encrypted"):
        pdf.page_count(content)


def test_every_file_is_recognised_or_failed(spark):
    rows = [("plain", pdf.made([f"p{k}" for k in range(7)])), ("packed", pdf.made([f"q{k}" for k in range(5)], True)), ("locked", pdf.made(["x"]).replace(b"/Root", b"/Encrypt 4 0 R /Root")), ("empty", b""), ("none", None)]
    files = spark.createDataFrame(rows, "title string, content binary")

    def make():
        def run(content, start, end):
            file = pdf.Pdf(content)
            found = [bytes.fromhex(re.search(rb"<(.*)>", file[page[b"/Contents"]].body)[1].decode()).decode("utf-16-be") for _, page in file.pages()[0]]
            assert len(found) == end - start
            return found

        return run

    out = providers.recognise(files, make, 3, first_wait=0.0, lanes=4).collect()
    assert {r.title: r.error for r in out if r.error} == {"locked": "the file is encrypted", "empty": "no page is found in the file", "none": "no page is found in the file"}
    got = {(r.title, r.first_page, r.last_page): r.pages for r in out if not r.error}
    assert got == {("plain", 1, 3): ["p0", "p1", "p2"], ("plain", 4, 6): ["p3", "p4", "p5"], ("plain", 7, 7): ["p6"], ("packed", 1, 3): ["q0", "q1", "q2"], ("packed", 4, 5): ["q3", "q4"]}


def test_generated_files_come_in_small_batches(spark, small, monkeypatch):
    """However small the batches are, every document has its file."""
    from graphloom.plans import queries

    monkeypatch.setattr(queries, "PDF_BYTES", 1)
    files = queries.document_pdfs(spark, small).collect()
    texts = {str(r.doc_id): r.text or "" for r in queries.table(spark, small, "documents").collect()}
    assert {f.title: "".join(pdf.shown_texts(f.content)) for f in files} == texts
