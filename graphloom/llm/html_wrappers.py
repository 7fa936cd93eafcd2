"""HTML extraction with wrappers: union-free regular expressions inferred from the pages of a host."""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import annotate, cut, pack, text_of, unpack

#: A tag as browsers read it: a quote opens a value only behind '=', elsewhere it is part of a name; one that nothing closes is an ordinary character.
#: No part gives back what it took, so a tag is read once.
ATTRIBUTES = r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?>\"[^\"]*\"|'[^']*'|[^\s>]*+))?+)*+"
TAG = re.compile(rf"<(/?)([A-Za-z][^\s/>]*+)({ATTRIBUTES})>")
PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*+)))?+")
# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript template iframe svg math xmp noembed noframes".split())
#: What stands in these is no markup up to the literal end tag, whatever '<' or quotes it holds.
ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I) for tag in RAW | {"title"}}
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements never part of an article's text.
SKIPPED = RAW | frozenset("head title nav header footer aside form button select option input label fieldset menu dialog object canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: A class or id with one of these words marks a part outside the article. Words are split at case changes and non-letters.
NOTICES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar sidebars aside rail widget widgets related recommended share sharing social comment comments reply replies disqus discussion "
    "footer header masthead topbar toolbar copyright login signup form search toc tags print hidden skip".split()
)
#: Names that mark the article itself; they win over NOTICES.
ARTICLES = frozenset("article post story entry content main body".split())
#: A start tag of one closes an open element of the other kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body article section div main aside nav td".split())
#: An element deeper than this stands beside its parent, as in browsers; no text is lost.
MAX_DEPTH = 150
#: Lists of children whose lengths multiply to more are aligned by first matches, not by the longest common subsequence.
ALIGN_CELLS = 40_000
#: Wrappers of so many bytes in all are broadcast.
BROADCAST_BYTES = 8 << 20
#: So many different articles of a host must agree on a part of <article> or <main> before it counts as the template's.
WITNESSES = 3
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("children", "label", "notice", "tag")

    def __init__(self, tag: str, label: str, notice: bool):
        self.tag, self.label, self.notice, self.children = tag, label, notice, []


def is_notice(tag: str, attributes: dict[str, str]) -> bool:
    if tag in SKIPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    names = {w.lower() for w in NAME_WORDS.findall(attributes.get("class", "") + " " + attributes.get("id", ""))}
    return bool(names & NOTICES) and not (names & ARTICLES and not names & {"comment", "comments", "sidebar", "footer", "ad", "ads", "nav"})


class Scanner:
    """The tags of a page from left to right, in time linear in it. Of two tags that browsers would read to the page's end, the later ones are
    read up to the next '>', so that no text is lost behind a quote that swallows all of them."""

    def __init__(self, page: str):
        self.page, self.tag = page, TAG
        self.last, self.last_data = page.rfind(">"), page.rfind("]]>")

    def comment(self, at: int) -> int:
        """The end of the comment, CDATA section or declaration that begins here, 0 if none does."""
        page = self.page
        if page.startswith("<!--", at):
            if page.startswith((">", "->"), at + 4):
                return page.index(">", at) + 1
            end = page.find("-->", at + 4)
            other = page.find("--!>", at + 4, end if end >= 0 else len(page))
            return other + 4 if other >= 0 else end + 3 if end >= 0 else len(page)
        if page.startswith("<![CDATA[", at) and at < self.last_data:
            return page.index("]]>", at) + 3
        return page.index(">", at) + 1 if page.startswith(("<!", "<?"), at) and at < self.last else 0

    def start(self, at: int) -> re.Match | None:
        """The tag that begins here."""
        if at >= self.last:
            return None
        found = self.tag.match(self.page, at)
        if not found and self.tag is TAG and PLAIN_TAG.match(self.page, at):
            self.tag = PLAIN_TAG
            found = PLAIN_TAG.match(self.page, at)
        return found


def parse(page: str) -> Node:
    """The element tree of a page, with unclosed and stray tags mended the way browsers do. Text nodes are strings."""
    root = Node("#root", "#root", False)
    stack = [root]
    at, scanner = 0, Scanner(page)
    while at < len(page):
        begin = page.find("<", at)
        if begin != at:
            stack[-1].children.append(page[at : begin if begin >= 0 else len(page)])
            at = begin if begin >= 0 else len(page)
            continue
        end = scanner.comment(at)
        if end:
            at = end
            continue
        m = scanner.start(at)
        if not m:
            stack[-1].children.append("<")
            at += 1
            continue
        at = m.end()
        close, tag = m[1], m[2].lower()
        if close:
            if tag == "br":
                stack[-1].children.append(" ")
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break  # an inline end tag does not close blocks
            continue
        if tag in BLOCK and tag != "hr":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK:
                    break
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in CLOSES.get(tag, ()):
                del stack[k:]
                break
            if stack[k].tag in SCOPE or tag not in CLOSES:
                break
        attributes = {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in ATTRIBUTE.finditer(m[3])} if m[3].strip(" /") else {}
        names = " ".join(sorted(set(attributes.get("class", "").split())))
        node = Node(tag, tag + ("." + re.sub(r"\d+", "0", names) if names else ""), is_notice(tag, attributes))
        stack[-1].children.append(node)
        if tag in ENDS and not m[3].rstrip().endswith("/"):
            end = ENDS[tag].search(page, at)
            if tag == "title":
                node.children.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].rstrip().endswith("/") and len(stack) < MAX_DEPTH:
            stack.append(node)
    return root


# A wrapper is a union-free regular expression over tags: [label, quantifier, children, text]. quantifier: "1", "?" (optional),
# "+" (repeated) or "*" (both). text: None without text, a digest of the constant text all pages have there, or SLOT where it varies.
# The root has a fifth part: digests of up to WITNESSES different texts of the host's <article> or <main> elements.
SLOT = 0


def together(a: str, b: str) -> str:
    """Quantifier of two occurrences aligned with each other."""
    optional, many = "?*", "+*"
    return "1?+*"[(a in optional or b in optional) + 2 * (a in many or b in many)]


def expression(node: Node) -> list:
    """A page's own expression; neighbours of one label are folded into a repeated group at once."""
    text = " ".join(" ".join(c for c in node.children if isinstance(c, str)).split())
    children: list = []
    for c in node.children:
        if isinstance(c, Node):
            e = expression(c)
            if children and children[-1][0] == e[0]:
                children[-1] = align(children[-1], e)
                children[-1][1] = together(children[-1][1], "+")
            else:
                children.append(e)
    out = [node.label, "1", children, xxhash.xxh3_64_hexdigest(text) if text else None]
    return [*out, [xxhash.xxh3_64_hexdigest("\n".join(all_text(x) for x, _ in articles(node)))] if articles(node) else []] if node.label == "#root" else out


def all_text(node: Node) -> str:
    return "".join(c if isinstance(c, str) else all_text(c) for c in node.children)


def matches(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Places of equal labels in x and y, ascending in both: equal ends first, then a longest common subsequence of the rest; where that would
    take more than ALIGN_CELLS steps, each label's next place in y, if it is no farther than x is behind."""
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    n, m = len(x) - head - tail, len(y) - head - tail
    out = [(k, k) for k in range(head)]
    if n * m > ALIGN_CELLS:
        places: dict[str, list[int]] = {}
        for k in range(m):
            places.setdefault(y[head + k], []).append(k)
        at, width = 0, abs(n - m) + 64
        for k in range(n):
            where = places.get(x[head + k], [])
            j = bisect_left(where, at)
            if j < len(where) and where[j] <= k + width:
                out.append((head + k, head + where[j]))
                at = where[j] + 1
    else:
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            for j in range(m - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if x[head + i] == y[head + j] else max(best[i + 1][j], best[i][j + 1])
        i = j = 0
        while i < n and j < m:
            if x[head + i] == y[head + j]:
                out.append((head + i, head + j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    return out + [(len(x) - k, len(y) - k) for k in range(tail, 0, -1)]


def align(a: list, b: list) -> list:
    """The expression that generalises two of one label: children are aligned by a longest common subsequence of labels; the
    unmatched become optional, differing texts a slot, and equal labels left side by side one repeated group."""
    x, y = a[2], b[2]
    pairs = matches([e[0] for e in x], [e[0] for e in y])
    out: list = []

    def add(e: list, optional: bool) -> None:
        e = [e[0], together(e[1], "?") if optional else e[1], e[2], e[3]]
        if out and out[-1][0] == e[0]:
            q = together(together(out[-1][1], e[1]), "+")
            merged = align(out[-1], e)
            merged[1] = q
            out[-1] = merged
        else:
            out.append(e)

    i = j = 0
    for p, q in [*pairs, (len(x), len(y))]:
        for e in (*x[i:p], *y[j:q]):
            add(e, True)
        if p < len(x):
            add(align(x[p], y[q]), False)
        i, j = p + 1, q + 1
    text = a[3] if a[3] == b[3] else SLOT
    return [a[0], together(a[1], b[1]), out, text, *([sorted({*a[4], *b[4]})[:WITNESSES]] if len(a) > 4 else [])]


def constant_paths(wrapper: list) -> set[str]:
    """Paths of elements whose whole content is the same on every page of the host: the template, not data.

    Only elements that every page has once count, up to the root: what one page alone shows is equal to itself. A path that also leads to an element that
    varies is left out.
    """
    same, other = set(), set()

    def walk(e: list, prefix: str, sure: bool) -> bool:
        path, sure = f"{prefix}/{e[0]}", sure and e[1] == "1"
        inner = [walk(c, path, sure) for c in e[2]]
        constant = sure and e[3] != SLOT and all(inner)
        if not constant:
            other.add(path)
        elif e[3] or e[2]:
            same.add(path)
        return constant

    walk(wrapper, "", True)
    return same - other


def has_slot(wrapper: list) -> bool:
    """Whether pages of the host differ outside repeated groups, whose members differ on one page already; a single page, or
    copies of one, show no template."""
    return wrapper[1] in "1?" and (wrapper[3] == SLOT or any(has_slot(c) for c in wrapper[2]))


def container_path(wrapper: list) -> str:
    """Without <article> or <main>: the deepest element that still holds most text slots, as the wrapper shows them."""

    def slots(e: list) -> int:
        return (e[3] == SLOT) * (4 if e[1] in "+*" else 1) + sum(slots(c) for c in e[2])

    def bare(e: list) -> bool:
        return e[0].split(".")[0] in SKIPPED or bool({w.lower() for w in NAME_WORDS.findall(e[0].partition(".")[2])} & NOTICES)

    path, here = "", wrapper
    while True:
        path = f"{path}/{here[0]}"
        inner = [c for c in here[2] if not bare(c)]
        total = here[3] == SLOT, sum(slots(c) for c in inner)
        top = max(inner, key=slots, default=None)
        if top is None or total[0] or slots(top) < 0.6 * total[1] or top[0].split(".")[0] not in ("html", "body", "div", "section", "main", "article", "table", "tbody", "tr", "td", "center"):
            return path
        here = top


def blocks(node: Node, path: str, template: frozenset, out: list[str], run: list[str], inside: bool) -> None:
    """Append the texts of the blocks under node to out; run gathers the inline text of the open block."""

    def end() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            out.append(text)

    for c in node.children:
        if isinstance(c, str):
            run.append(c)
        elif c.tag == "br" or c.tag == "wbr":
            run.append(" " if c.tag == "br" else "")
        else:
            here = f"{path}/{c.label}"
            block = c.tag in BLOCK
            if block:
                end()
            if not c.notice and here not in template:
                blocks(c, here, template, out, run, inside)
            elif c.tag == "header" and inside:  # an article's own header: its headings are the article's
                for heading, at in find(c, ("h1", "h2", "h3", "h4", "h5", "h6"), here):
                    if at in template:
                        continue
                    blocks(heading, at, template, out, run, inside)
                    end()
            if block:
                end()


def find(node: Node, tags: tuple[str, ...], path: str = "/#root") -> list[tuple[Node, str]]:
    """The outermost elements of these tags that are in no notice, with their paths."""
    got = []
    for c in node.children:
        if isinstance(c, Node) and not c.notice:
            here = f"{path}/{c.label}"
            got += [(c, here)] if c.tag in tags else find(c, tags, here)
    return got


def at_path(node: Node, path: str, here: str = "/#root") -> list[tuple[Node, str]]:
    if here == path:
        return [(node, here)]
    return [x for c in node.children if isinstance(c, Node) and path.startswith(f"{here}/{c.label}") for x in at_path(c, path, f"{here}/{c.label}")]


def articles(root: Node) -> list[tuple[Node, str]]:
    return find(root, ("article",)) or find(root, ("main",))


def main_text(page: str, wrapper: list | None) -> str:
    """The article of a page. The host's wrapper says which parts are the template's, and without <article> or <main> also which
    element holds the data. Inside <article> or <main> it does so once WITNESSES different articles agree."""
    root = parse(page)
    found = articles(root)
    inside, template = bool(found), frozenset()
    if wrapper is not None and (len(wrapper[4]) >= WITNESSES if inside else has_slot(wrapper)):
        template = frozenset(constant_paths(wrapper))
        found = found or at_path(root, container_path(wrapper))
    found = found or [(root, "/#root")]
    out: list[str] = []
    for node, path in found:
        run: list[str] = []
        blocks(node, path, template, out, run, inside)
        rest = " ".join(html.unescape("".join(run)).split())
        if rest:
            out.append(rest)
    return "\n".join(out)


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(_host, _wrapper as JSON) of pages(_host, _html): one wrapper a host, over all its pages.

    Alignment may be grouped in any way: each task first folds the pages it reads into one expression a host and batch, these meet in
    eight salted parts, and those per host. An expression is as large as a template, however many pages it stands for.
    """

    def emit(held: dict):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())], names=["_host", "_wrapper"])

    def local(batches):
        for batch in batches:
            held: dict[str, list] = {}
            for host, page in zip(batch.column("_host").to_pylist(), batch.column("_html").to_pylist(), strict=True):
                e = expression(parse(page))
                held[host] = align(held[host], e) if host in held else e
            yield emit(held)

    def merge(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for host, w in zip(batch.column("_host").to_pylist(), batch.column("_wrapper").to_pylist(), strict=True):
                held[host] = align(held[host], json.loads(w)) if host in held else json.loads(w)
        if held:
            yield emit(held)

    schema = "_host string, _wrapper string"
    parts = pages.mapInArrow(local, schema).distinct()
    parts = parts.withColumn("_salt", F.pmod(F.xxhash64("_wrapper"), F.lit(8))).repartition("_host", "_salt").sortWithinPartitions("_host", "_wrapper").select("_host", "_wrapper").mapInArrow(merge, schema)
    return parts.repartition("_host").sortWithinPartitions("_host", "_wrapper").mapInArrow(merge, schema)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """pages with text (string) and n_chars (long, its code points).

    A wrapper is inferred over all pages of each host, then every page is parsed and its article taken: blocks in page
    order, white space inside a block one space, character references decoded, joined by a line feed. Menus, headers, footers,
    sidebars, notices, adverts, forms, scripts, styles and reader comments go. Parts equal on all pages of the host go as its
    template; within <article> and <main> too, if the host has at least WITNESSES different ones, and without these elements the wrapper also says
    which element holds the data. Equal members of a repeated group (a <p> among others without a class of its own) stay. Null html counts as empty and gives an empty
    text; a null or odd url belongs to the host ''. Repeated rows give equal texts. An empty table gives an empty one;
    columns text and n_chars of pages are replaced.

    Wrappers are broadcast if they have at most BROADCAST_BYTES together; else they meet pages in a join by host, whose hot
    partitions adaptive execution splits.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    base = pack(pages, _host=host, _html=text_of("html"))
    wrappers = cut(host_wrappers(base.select("_host", "_html")))

    def make():
        known: dict[str, list] = {}

        def run(batch):
            texts = []
            for page, w in zip(batch.column("_html").to_pylist(), batch.column("_wrapper").to_pylist(), strict=True):
                if w is not None and w not in known:
                    if len(known) >= 256:
                        known.clear()
                    known[w] = json.loads(w)
                texts.append(main_text(page, known.get(w)))
            return {"_text": pa.array(texts, pa.string())}

        return run

    small = (wrappers.agg(F.sum(F.length("_host") + F.length("_wrapper"))).first()[0] or 0) <= BROADCAST_BYTES
    out = annotate(base.join(F.broadcast(wrappers) if small else wrappers, "_host", "left"), make, {"_text": "string"})
    return unpack(out, pages.columns, text=F.col("_text"), n_chars=F.length("_text").cast("long"))
