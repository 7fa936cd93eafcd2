import html
import re

import duckdb
import pytest

from graphloom.llm import html_wrappers as hw


def infer(pages):
    w = None
    for p in pages:
        e = hw.expression(hw.parse(p))
        w = hw.align(w, e) if w else e
    return w


def test_pages_of_the_table(spark, small):
    rows = duckdb.sql(f"SELECT page_id, html FROM '{small}/pages.parquet'").fetchall()
    got = {r.page_id: (r.text, r.n_chars) for r in hw.extract_main_text(spark.read.parquet(f"{small}/pages.parquet")).collect()}
    for page_id, page in rows:
        article = re.search("<article>(.*)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert got[page_id] == (want, len(want))


def test_wrapper_is_union_free():
    w = infer(["<body><h1>a</h1><p>x</p><p>y</p></body>", "<body><h1>b</h1><div>ad</div><p>z</p></body>"])
    body = w[2][0]
    assert [(c[0], c[1], c[3] == hw.SLOT) for c in body[2]] == [("h1", "1", True), ("div", "?", False), ("p", "+", True)]


def test_template_parts_go_without_an_article_element():
    page = "<body><div class=top>Site</div><div class=w><h2>Head {0}</h2><p>text {0} &amp; more<br>line<p>next {0}</div><div>All rights</div></body>"
    pages = [page.format(i) for i in range(3)]
    assert hw.main_text(pages[1], infer(pages)) == "Head 1\ntext 1 & more line\nnext 1"
    assert "Site" in hw.main_text(pages[1], infer(pages[:1]))
    assert "Site" in hw.main_text(pages[1], infer([pages[1]] * 3))


def test_what_is_left_out_of_an_article():
    page = (
        "<body><header>h</header><article><header><h1>T</h1><span>by X</span></header><nav>m</nav><p>a<script>1<2</script>b &lt;c&gt; &#x41;</p><ul><li>i<li>j</ul><div class='comments'><p>c</p></div>"
        "<div class='cookie-notice'>n</div><table><tr><td>1<td>2</table><pre> x\n  y</pre><aside>z</aside><p>1 < 2 and<!-- c --> d</p><form>q</form></article><footer>f</footer></body>"
    )
    assert hw.main_text(page, None) == "T\nab <c> A\ni\nj\n1\n2\nx y\n1 < 2 and d"


def test_template_parts_go_inside_an_article_element(spark):
    page = "<body><article><header><h1>Head {0}</h1></header><div class=x1><p>Brought to you by us</p></div><p>text {0}</p><p>more {1}</p>{2}<div class=x2>Pass it on</div></article></body>"
    rows = [(i, "http://a.org/x", page.format(i, i * i, "<blockquote>quoted</blockquote>" if i == 1 else "")) for i in range(5)]
    got = {r.page_id: r.text for r in hw.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Head {i}\ntext {i}\nmore {i * i}" + "\nquoted" * (i == 1) for i in range(5)}
    w = infer([r[2] for r in rows[:2]])  # two articles are too few witnesses
    assert hw.main_text(rows[1][2], w) == "Head 1\nBrought to you by us\ntext 1\nmore 1\nquoted\nPass it on"
    assert "Pass it on" in hw.main_text(rows[1][2], infer([rows[1][2]] * 5))


def test_what_one_page_alone_shows_is_no_template():
    page = "<body><main><h1>Head {0}</h1>{1}<h2>Same</h2><p>a{0}</p><h2>Part {0}</h2></main></body>"
    pages = [page.format(i, "<section><p>only here</p></section>" if i == 2 else "") for i in range(4)]
    assert hw.main_text(pages[2], infer(pages)) == "Head 2\nonly here\nSame\na2\nPart 2"
    plain = [p.replace("main>", "div>") for p in pages]
    assert hw.main_text(plain[2], infer(plain)) == "Head 2\nonly here\nSame\na2\nPart 2"


@pytest.mark.parametrize(
    "head",
    [
        "<script>for(i=0;i<n;i++){f(i)}</script>", "<SCRIPT>if(a<b && c=='</p>'){}</Script >", "<style>/* a<b' */</style>", "<script>x = a<b + '\"';</script\n>",
        "<textarea>i<n</textarea>", "<title>i<n it's</title>", "<script>'<script>' + 1<n</script>", "<script>var s='<!--'</script>",
    ],
)
def test_content_of_raw_elements_is_no_markup(head):
    assert hw.main_text(f"<html>{head}<body><article><p>a</p>{head}<p>b's</p></article></body>", None) == "a\nb's"


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></p>", "<article>", "<p>a<p>b</div>c", "<script>never closed", "<!-- open", "<a href='x>y'>k</a> <"])
def test_broken_markup(page):
    hw.main_text(page, infer([page, "<p>x"]))


def test_wrappers_too_large_to_broadcast(spark, small, monkeypatch):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    want = {r.page_id: r.text for r in hw.extract_main_text(pages).collect()}
    monkeypatch.setattr(hw, "BROADCAST_BYTES", 0)
    assert {r.page_id: r.text for r in hw.extract_main_text(pages).collect()} == want


def test_odd_rows(spark):
    rows = [(1, None, None, "t"), (2, "http://a.b/c", "", None), (3, "nonsense", "<p>x", "t"), (3, "nonsense", "<p>x", "t"), (None, "https://A.B/", "plain " * 50000, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.text[:6], r.n_chars) for r in hw.extract_main_text(df).collect())
    assert got == [("1", "", 0), ("2", "", 0), ("3", "x", 1), ("3", "x", 1), ("None", "plain ", 299999)]
    assert hw.extract_main_text(df.limit(0)).count() == 0


def test_deep_and_wide_markup():
    deep = "<body>" + "<div>" * 100_000 + "x" + "</div>" * 100_000 + "<p>y</p></body>"
    assert hw.main_text(deep, infer([deep, "<p>x"])) == "x\ny"
    wide = "<body>" + "".join(f"<h2>a{i}</h2><p>b{i}</p>" for i in range(10_000)) + "</body>"
    other = wide.replace("<h2>a5000</h2>", "<hr>")
    text = "\n".join(f"a{i}\nb{i}" for i in range(10_000))
    assert hw.main_text(wide, infer([wide, other])) == text


def test_matches_are_a_longest_common_subsequence(monkeypatch):
    import random
    from itertools import combinations

    random.seed(4)
    for _ in range(200):
        x, y = ([random.choice("abc") for _ in range(random.randrange(7))] for _ in range(2))
        longest = max(k for k in range(len(x) + 1) for c in combinations(x, k) if any(list(c) == list(d) for d in combinations(y, k)))
        for cells in (40_000, -1):
            monkeypatch.setattr(hw, "ALIGN_CELLS", cells)
            got = hw.matches(x, y)
            assert all(x[i] == y[j] for i, j in got)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))
            assert len(got) == longest or cells < 0


def test_the_wrapper_decides_by_the_hosts_other_pages():
    page = "<body><article><h1>Head {0}</h1><div class=x1>Pass it on</div><p>text {0}</p></article></body>"
    same = [page.format(i) for i in range(4)]
    assert hw.main_text(same[0], infer(same)) == "Head 0\ntext 0"
    other = [same[0], *[page.format(i).replace("Pass it on", f"Note {i}") for i in range(1, 4)]]
    assert hw.main_text(same[0], infer(other)) == "Head 0\nPass it on\ntext 0"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><p title='don't'>hello</p><p>it's fine</p></article>", "hello\nit's fine"),
        ('<article><p title="a"b">one</p><p>two "quoted" words</p></article>', 'one\ntwo "quoted" words'),
        ('<article><p a=b"c d>one</p><p>two</p></article>', "one\ntwo"),
        ("<article><p title='>one</p><p>two</p></article>", "one\ntwo"),
        ('<article><p a = "x>y" b=>one</p></article>', "one"),
        ("<article><p/ a/b>one</p a='>'>two</article>", "one\ntwo"),
        ("<article><!--><p>one</p><!---><p>two</p><!-- x --!><p>three</p></article>", "one\ntwo\nthree"),
        ("<article>1 < 2 <3 <p>one</p></article>", "1 < 2 <3\none"),
        ("<article><![CDATA[ x > y ]]><p>one</p><! a><? b></article>", "one"),
    ],
)
def test_stray_quotes_and_comments(page, want):
    assert hw.main_text(page, None) == want


@pytest.mark.parametrize("piece", ["<a b ", "<![CDATA[", "<!", '<a b="', "<a b='x\" ", "<", "</a ", "<!--", "<a b=\"x>y\" ", "<p><b "])
@pytest.mark.parametrize("end", ["", '">', "c=\">\"", "-->"])
def test_broken_markup_takes_linear_time(piece, end):
    import time

    began = time.process_time()
    hw.parse(piece * (1_000_000 // len(piece)) + end)
    assert time.process_time() - began < 20
