"""The page tree of PDF files: cross-reference tables and streams, object streams, page counts, files of some pages only."""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

BLANK = rb"\x00\t\n\x0c\r "
TOKEN = re.compile(
    rb"(?:[%b]|%%[^\r\n]*)*(?:(?P<open><<|\[)|(?P<close>>>|\])|(?P<name>/[^%b()<>\[\]{}/%%]*)|(?P<ref>(\d+)[%b]+(\d+)[%b]+R(?![A-Za-z0-9]))|(?P<atom>[+-]?(?:\d+\.?\d*|\.\d+)|[A-Za-z]+|<[0-9A-Fa-f%b]*>)|(?P<text>\())"
    % ((BLANK,) * 5)
)
HEAD = re.compile(rb"[%b]*(\d+)[%b]+(\d+)[%b]+obj(?![A-Za-z])" % ((BLANK,) * 3))
#: Bytes that a stream may have when it is inflated, levels of nesting, and attributes that pages inherit.
INFLATED, DEPTH = 1 << 28, 100
INHERITED = (b"/Resources", b"/MediaBox", b"/CropBox", b"/Rotate")


class Ref(NamedTuple):
    number: int


class Stream(NamedTuple):
    head: dict
    body: bytes


def _value(data: bytes, at: int, depth: int = 0) -> tuple[object, int]:
    """The value at a position, and the position behind it: dict, list, Ref, or the bytes of a name, number, string or word."""
    token = TOKEN.match(data, at)
    if not token or depth > DEPTH:
        raise ValueError(f"no value at byte {at}")
    kind, at = token.lastgroup if token["ref"] is None else "ref", token.end()
    if kind == "ref":
        return Ref(int(token[5])), at
    if kind == "text":
        end, open_ = at, 1
        while open_:
            step = re.compile(rb"[()\\]").search(data, end)
            if not step:
                raise ValueError("a string without end")
            end = step.end() + (step[0] == b"\\")
            open_ += {b"(": 1, b")": -1}.get(step[0], 0)
        return data[at - 1 : end], end
    if kind != "open":
        return token[kind], at
    items, closing = [], b">>" if token["open"] == b"<<" else b"]"
    while (item := _value(data, at, depth + 1))[0] not in (b">>", b"]"):
        items.append(item[0])
        at = item[1]
    if item[0] != closing:
        raise ValueError(f"wrong bracket at byte {at}")
    if closing == b"]":
        return items, item[1]
    if not all(isinstance(k, bytes) and k[:1] == b"/" for k in items[::2]):
        raise ValueError(f"a key that is no name before byte {item[1]}")
    return dict(zip(items[::2], items[1::2], strict=False)), item[1]


def _inflated(stream: Stream) -> bytes:
    """A stream's content: plain, or deflated, with or without PNG's predictors."""
    kind, parms = stream.head.get(b"/Filter"), stream.head.get(b"/DecodeParms")
    kind, parms = (x[0] if isinstance(x, list) and len(x) == 1 else x for x in (kind, parms))
    if kind in (None, []):
        return stream.body
    if kind not in (b"/FlateDecode", b"/Fl"):
        raise ValueError(f"filter {kind!r}")
    inflater = zlib.decompressobj()
    data = inflater.decompress(stream.body, INFLATED)
    if inflater.unconsumed_tail:
        raise ValueError("a stream of more bytes than may be")
    if isinstance(parms, dict) and int(parms.get(b"/Predictor", 1)) >= 10:
        data = _unpredicted(data, int(parms.get(b"/Columns", 1)) * int(parms.get(b"/Colors", 1)) * int(parms.get(b"/BitsPerComponent", 8)) // 8)
    return data


def _unpredicted(data: bytes, width: int) -> bytes:
    """Rows of a byte that names the predictor and width bytes, for entries of one byte."""
    out, above = bytearray(), bytearray(width)
    for at in range(0, len(data) - width, width + 1):
        kind, row = data[at], bytearray(data[at + 1 : at + 1 + width])
        for k in range(width):
            a, b, c = (row[k - 1] if k else 0), above[k], (above[k - 1] if k else 0)
            near = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
            row[k] = (row[k] + (0, a, b, (a + b) // 2, near)[kind]) & 255
        out += row
        above = row
    return bytes(out)


class Pdf:
    """A file's objects by number. Where its cross-references can't be followed, the objects that stand in the file are searched."""

    def __init__(self, data: bytes):
        self.data = data
        self.places: dict[int, tuple[int, int | None]] = {}  # by number: a byte position and None, or an object stream and a place in it
        self.trailer: dict = {}
        self.packed: dict[int, list[tuple[int, object]]] = {}
        try:
            self._follow(int(re.findall(rb"startxref[%b]+(\d+)" % BLANK, data[-2048:])[-1]))
            if not isinstance(self[self.trailer.get(b"/Root")], dict):
                raise ValueError("no root")
        except (ValueError, IndexError, KeyError, zlib.error):
            self._search()
        if b"/Encrypt" in self.trailer:
            raise ValueError("the file is encrypted")

    def _follow(self, at: int) -> None:
        seen = set()
        while at is not None and at not in seen:
            seen.add(at)
            if re.compile(rb"[%b]*xref" % BLANK).match(self.data, at):
                trailer = self._table(at)
                if b"/XRefStm" in trailer:
                    self._stream(int(trailer[b"/XRefStm"]))
            else:
                trailer = self._stream(at)
            self.trailer = {**trailer, **self.trailer}
            at = int(trailer[b"/Prev"]) if b"/Prev" in trailer else None

    def _table(self, at: int) -> dict:
        at = self.data.index(b"xref", at) + 4
        section = re.compile(rb"[%b]*(\d+)[%b]+(\d+)[%b]*(?=\d)|[%b]*trailer" % ((BLANK,) * 4))
        entry = re.compile(rb"[%b]*(\d{10})[ ]+(\d{5})[ ]+([nf])" % BLANK)
        while (found := section.match(self.data, at)) and found[1]:
            at = found.end()
            for number in range(int(found[1]), int(found[1]) + int(found[2])):
                row = entry.match(self.data, at)
                if not row:
                    raise ValueError("a cross-reference without its row")
                at = row.end()
                if row[3] == b"n":
                    self.places.setdefault(number, (int(row[1]), None))
                else:
                    self.places.setdefault(number, (-1, None))
        if not found:
            raise ValueError("no trailer")
        return _value(self.data, found.end())[0]

    def _stream(self, at: int) -> dict:
        found = self._at(at)
        if not isinstance(found, Stream) or found.head.get(b"/Type") != b"/XRef":
            raise ValueError("no cross-reference stream")
        widths, data = [int(w) for w in found.head[b"/W"]], _inflated(found)
        span = [int(x) for x in found.head.get(b"/Index", [0, found.head[b"/Size"]])]
        numbers = [n for a, k in zip(span[::2], span[1::2], strict=True) for n in range(a, a + min(k, len(data)))]
        for k, number in enumerate(numbers[: len(data) // max(1, sum(widths))]):
            at, fields = k * sum(widths), []
            for w in widths:
                fields.append(int.from_bytes(data[at : at + w], "big"))
                at += w
            kind = fields[0] if widths[0] else 1
            self.places.setdefault(number, (fields[1], None) if kind == 1 else (fields[1], fields[2]) if kind == 2 else (-1, None))
        return found.head

    def _search(self) -> None:
        """Objects by where they stand; of one number the last counts. Object streams are opened."""
        self.places, self.trailer, self.packed = {}, {}, {}
        for found in re.finditer(rb"(?<![0-9])(\d+)[%b]+\d+[%b]+obj(?![A-Za-z])" % ((BLANK,) * 2), self.data):
            self.places[int(found[1])] = (found.start(), None)
        for found in re.finditer(rb"trailer(?=[%b]*<<)" % BLANK, self.data):
            try:
                self.trailer |= _value(self.data, found.end())[0]
            except ValueError:
                continue
        for number in list(self.places):
            found = self._object(number)
            head = found.head if isinstance(found, Stream) else found if isinstance(found, dict) else {}
            if head.get(b"/Type") == b"/ObjStm":
                for k, (inner, _) in enumerate(self._opened(number)):
                    self.places.setdefault(inner, (number, k))
            elif head.get(b"/Type") == b"/XRef":
                self.trailer = {**head, **self.trailer}
        if b"/Root" not in self.trailer:
            roots = [n for n in self.places if isinstance(x := self._object(n), dict) and x.get(b"/Type") == b"/Catalog"]
            self.trailer |= {b"/Root": Ref(roots[-1])} if roots else {}

    def _object(self, number: int):
        try:
            return self[Ref(number)]
        except (ValueError, zlib.error, KeyError, IndexError):
            return None

    def _at(self, at: int):
        head = HEAD.match(self.data, at) if at >= 0 else None
        if not head:
            return None
        value, at = _value(self.data, head.end())
        begin = re.compile(rb"[%b]*stream(\r\n|\n|\r)" % BLANK).match(self.data, at)
        if not isinstance(value, dict) or not begin:
            return value
        length = self[value.get(b"/Length")]
        end = begin.end() + int(length) if isinstance(length, bytes) and length.isdigit() else -1
        if end < 0 or not re.compile(rb"[%b]*endstream" % BLANK).match(self.data, end):
            end = self.data.find(b"endstream", begin.end())
            if end < 0:
                raise ValueError("a stream without end")
        return Stream(value, self.data[begin.end() : end])

    def _opened(self, number: int) -> list[tuple[int, object]]:
        """(number, value) of the objects of an object stream."""
        if number not in self.packed:
            self.packed[number] = []  # a stream that is said to be inside itself is empty
            stream = self._at(self.places.get(number, (-1, None))[0])
            data, first = _inflated(stream), int(self[stream.head[b"/First"]])
            pairs = [int(x) for x in data[:first].split()][: 2 * int(self[stream.head[b"/N"]])]
            self.packed[number] = [(n, _value(data, first + at)[0]) for n, at in zip(pairs[::2], pairs[1::2], strict=False)]
        return self.packed[number]

    def __getitem__(self, value):
        """What a value refers to, None if nothing; other values themselves."""
        for _ in range(DEPTH):
            if not isinstance(value, Ref):
                return value
            place, inner = self.places.get(value.number, (-1, None))
            if inner is None:
                value = self._at(place)
            else:
                objects = self._opened(place)
                value = next((v for n, v in objects[inner : inner + 1] if n == value.number), None) or dict(objects).get(value.number)
        raise ValueError("references in a circle")

    def pages(self) -> tuple[list[tuple[Ref | None, dict]], set[int]]:
        """(reference, attributes with the inherited ones) of every page in order; and the numbers of all nodes of the tree."""
        root = self[self.trailer.get(b"/Root")]
        todo: list[tuple[object, dict]] = [(root.get(b"/Pages"), {})] if isinstance(root, dict) else []
        found, nodes, inner = [], set(), set()
        while todo:
            ref, above = todo.pop()
            node = self[ref]
            if not isinstance(node, dict):
                continue
            if isinstance(ref, Ref):
                nodes.add(ref.number)
            own = {k: node[k] for k in INHERITED if k in node}
            kids = self[node.get(b"/Kids")]
            if isinstance(kids, list):
                if isinstance(ref, Ref):
                    if ref.number in inner:
                        raise ValueError("a page tree that holds itself")
                    inner.add(ref.number)
                todo += [(kid, above | own) for kid in reversed(kids)]
            else:
                found.append((ref if isinstance(ref, Ref) else None, above | node))
        return found, nodes


def _bytes(value: object) -> bytes:
    if isinstance(value, dict):
        return b"<<" + b" ".join(k + b" " + _bytes(v) for k, v in value.items()) + b">>"
    if isinstance(value, list):
        return b"[" + b" ".join(map(_bytes, value)) + b"]"
    return b"%d 0 R" % value.number if isinstance(value, Ref) else value


def _file(objects: list[object]) -> bytes:
    """A file of objects numbered from 1, the first of which is its root."""
    out, places = bytearray(b"%PDF-1.7\n"), []
    for k, value in enumerate(objects, 1):
        places.append(len(out))
        body = _bytes(value) if not isinstance(value, Stream) else _bytes({**value.head, b"/Length": b"%d" % len(value.body)}) + b"\nstream\n" + value.body + b"\nendstream"
        out += b"%d 0 obj\n%b\nendobj\n" % (k, body)
    table = b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + b"".join(b"%010d 00000 n \n" % p for p in places)
    return bytes(out) + table + b"trailer\n<</Size %d /Root 1 0 R>>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, len(out))


#: What a damaged file may raise where it is read.
DAMAGE = (ValueError, KeyError, IndexError, TypeError, AttributeError, zlib.error)


def page_count(content: bytes) -> int:
    """Pages of a file. ValueError if it is encrypted or its tree can't be read; then plain page objects in it count, if there are any."""
    try:
        pages = len(Pdf(content).pages()[0])
    except DAMAGE as error:
        if "encrypted" in str(error):
            raise
        pages = 0
    pages = pages or len(re.findall(rb"/Type\s*/Page(?![A-Za-z])", content))
    if not pages:
        raise ValueError("no page is found in the file")
    return pages


def part(content: bytes, start: int, end: int) -> bytes:
    """A file of the pages [start, end) and all that they use. References to other pages become null. A file whose tree can't be read, or whose whole is asked for, comes whole."""
    try:
        pdf = Pdf(content)
        pages, nodes = pdf.pages()
        whole = not pages or (start <= 0 and end >= len(pages))
        return content if whole else _part(pdf, pages[start:end], nodes)
    except DAMAGE:
        return content


def _part(pdf: Pdf, chosen: list[tuple[Ref | None, dict]], nodes: set[int]) -> bytes:
    numbers = {ref.number: k + 3 for k, (ref, _) in enumerate(chosen) if ref}
    out: list[object] = [{b"/Type": b"/Catalog", b"/Pages": Ref(2)}, {b"/Type": b"/Pages", b"/Count": b"%d" % len(chosen), b"/Kids": [Ref(k + 3) for k in range(len(chosen))]}, *[None] * len(chosen)]
    todo: list[int] = []

    def moved(value: object) -> object:
        if isinstance(value, dict):
            return {k: moved(v) for k, v in value.items()}
        if isinstance(value, list):
            return [moved(v) for v in value]
        if not isinstance(value, Ref):
            return value
        if value.number in nodes and value.number not in numbers:
            return b"null"
        if value.number not in numbers:
            out.append(None)
            numbers[value.number] = len(out)
            todo.append(value.number)
        return Ref(numbers[value.number])

    for k, (_, page) in enumerate(chosen):
        out[k + 2] = {**moved({n: v for n, v in page.items() if n != b"/Parent"}), b"/Parent": Ref(2)}
    while todo:
        number = todo.pop()
        value = pdf[Ref(number)]
        out[numbers[number] - 1] = Stream(moved(value.head), value.body) if isinstance(value, Stream) else b"null" if value is None else moved(value)
    return _file(out)


def shown_texts(content: bytes) -> list[str]:
    """The text of each page of a file that made() wrote; '' for pages of another kind."""
    pdf, out = Pdf(content), []
    for _, page in pdf.pages()[0]:
        stream = pdf[page.get(b"/Contents")]
        found = re.search(rb"<([0-9a-f]*)> Tj", _inflated(stream)) if isinstance(stream, Stream) else None
        out.append(bytes.fromhex(found[1].decode()).decode("utf-16-be") if found else "")
    return out


def made(texts: list[str], packed: bool = False) -> bytes:
    """A file with a page for each text. packed: its objects stand deflated in an object stream, with a cross-reference stream."""
    kids = [Ref(3 + 2 * k) for k in range(len(texts))]
    objects: list[object] = [{b"/Type": b"/Catalog", b"/Pages": Ref(2)}, {b"/Type": b"/Pages", b"/Count": b"%d" % len(texts), b"/MediaBox": [b"0", b"0", b"595", b"842"], b"/Kids": kids}]
    for k, text in enumerate(texts):
        objects.append({b"/Type": b"/Page", b"/Parent": Ref(2), b"/Contents": Ref(4 + 2 * k)})
        objects.append(Stream({}, b"BT <" + text.encode("utf-16-be").hex().encode() + b"> Tj ET"))
    if not packed:
        return _file(objects)
    inside = [(k, _bytes(v)) for k, v in enumerate(objects, 1) if not isinstance(v, Stream)]
    places = [sum(len(b) + 1 for _, b in inside[:k]) for k in range(len(inside))]
    index = b" ".join(b"%d %d" % (n, p) for (n, _), p in zip(inside, places, strict=True)) + b"\n"
    holder, size = len(objects) + 1, len(objects) + 3
    body = zlib.compress(index + b"\n".join(b for _, b in inside))
    out, rows = bytearray(b"%PDF-1.7\n"), {0: (0, 0, 0)} | {n: (2, holder, k) for k, (n, _) in enumerate(inside)}
    streams = [(k, v) for k, v in enumerate(objects, 1) if isinstance(v, Stream)]
    streams.append((holder, Stream({b"/Type": b"/ObjStm", b"/N": b"%d" % len(inside), b"/First": b"%d" % len(index), b"/Filter": b"/FlateDecode"}, body)))
    for number, s in streams:
        rows[number] = (1, len(out), 0)
        out += b"%d 0 obj\n%b\nstream\n%b\nendstream\nendobj\n" % (number, _bytes({**s.head, b"/Length": b"%d" % len(s.body)}), s.body)
    rows[holder + 1] = (1, len(out), 0)
    table = zlib.compress(b"".join(kind.to_bytes(1, "big") + a.to_bytes(4, "big") + b.to_bytes(2, "big") for kind, a, b in (rows[n] for n in range(size - 1))))
    head = {b"/Type": b"/XRef", b"/Size": b"%d" % (size - 1), b"/Root": Ref(1), b"/W": [b"1", b"4", b"2"], b"/Filter": b"/FlateDecode", b"/Length": b"%d" % len(table)}
    return bytes(out) + b"%d 0 obj\n%b\nstream\n%b\nendstream\nendobj\nstartxref\n%d\n%%%%EOF\n" % (holder + 1, _bytes(head), table, rows[holder + 1][1])
