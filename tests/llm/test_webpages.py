import re
import time
from html import unescape

import pytest

from kindred.llm import webpages as w
from kindred.llm.queries import op2_html

PAGE = """<html><body class="has-sidebar"><header class="top"><h1>Site</h1></header><nav><a href=1>Home</a></nav>
<div id="cookie-notice">We use cookies, accept them all now please, many words here.</div><div class="wrap">
<div class="post-123 content"><h1>Title &amp; more</h1><p>First   para <a href=x>link</a> text, with words.<p>Second
para&nbsp;here &lt;b&gt; "q" <script>x("</div>")</script> tail</p><!-- <p>no</p> --><ul><li>one<li>two</ul>
<form><input><label>Email</label><button>Go</button></form><div class="ad-box">Buy now this great thing</div></div>
<aside><p>Side text</p></aside></div><section class="comments"><p>Nice article I liked it very much and more words.</p>
</section><footer>c</footer></body></html>"""


def test_blocks_of_the_article():
    assert w.extract(w.parse(PAGE), None).split("\n\n") == [
        "Title & more", "First para link text, with words.", 'Second para here <b> "q" tail', "one", "two",
    ]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), ("<", "<"), ("<p", "<p"), ("plain  text", "plain text"), ("<div>unclosed <p>x", "unclosed\n\nx"),
        ("<script>never", ""), ("<!-- never", ""), ("<p>&#x1F600; &bogus; &am</p>", "\U0001f600 &bogus; &am"),
        ("<div class=ad>only ad</div>", ""), ("</p></div>a<br>b", "a b"), ("<p hidden>x</p><p>y</p>", "y"),
        ("<table><tr><td>a<td>b<tr><th>c</table>", "a\n\nb\n\nc"), ("<p title='a>b'>x</p>", "x"),
        ("<form><h1>All in a form</h1><p>text text text</p></form>", "All in a form\n\ntext text text"),
    ],
)
def test_odd_markup(page, text):
    parsed = w.parse(page)
    # fragments have no one container, so all that is not dropped counts
    assert "\n\n".join(t for n, t in parsed.blocks if not parsed.dropped[n]) == text


MALFORMED = {
    "tags never closed": lambda n: "<a" * n, "quotes never closed": lambda n: '"<div class="' * n, "deep": lambda n: "<div>" * n + "x",
    "odd quotes": lambda n: "<p 'x" * n, "unmatched ends": lambda n: "<div>" * n + "</p>" * n, "declarations": lambda n: "<!x " * n,
    "instructions": lambda n: "<?x " * n, "items behind a fence": lambda n: "<li><ul>" + "<div>" * n + "<li></li>" * n,
    "cells in depth": lambda n: "<div>" * n + "<td>x" * n, "paragraphs": lambda n: "<p>x" * n, "comments": lambda n: "<!-- " * n, "scripts": lambda n: "<script>" * n,
}


@pytest.mark.parametrize("kind", MALFORMED)
def test_time_stays_linear(kind):
    """300,000 repeats take seconds; quadratic time would take hours."""
    start = time.monotonic()
    w.parse(MALFORMED[kind](300_000))
    assert time.monotonic() - start < 60


def test_deep_levels_and_many_classes_have_paths_of_their_own():
    page = w.parse("<body>" + "<div>" * 40 + "<section>a</section><article>b</article>" + "</div>" * 40)
    paths = [n.path for n in page.nodes[1:]]
    assert len(set(paths)) == len(paths) and max(map(len, paths)) < 300
    names = {w._describe("div", f' class="a b c d {last}"')[0] for last in ("e", "f", "e f", "")}
    assert len(names) == 4 and w._describe("div", ' class="d c b a e9"')[0] == w._describe("div", ' class="e10 a b c d"')[0]


def test_paths_are_general():
    assert w._describe("div", ' class="post-17 Content" id=x')[0] == "div.content.post-#"
    assert [w._describe("div", f' class="{c}"')[1] for c in ("article", "comments", "with-sidebar", "left-sidebar", "adBox", "shadow")] == [0, 2, 0, 1, 2, 0]


def page(body):
    return f"<html><body><nav><a>menu menu</a></nav>{body}<footer>end</footer></body></html>"


def test_a_host_decides_where_one_page_would_err(spark):
    """A page with a short article beside a long list of teasers follows the path of the host's other pages."""
    article = lambda n: f"<div class='story'><p>{'the story goes on ' * n}</p></div>"
    teasers = "<div class='more'>" + "<p>another story you may read on this site </p>" * 6 + "</div>"
    rows = [(i, "http://a.example/x", page(article(40) + "<div class='more'><p>one</p></div>")) for i in range(5)]
    rows.append((9, "https://u@A.example:8080", page(article(8) + teasers)))
    rows.append((10, None, page(article(8) + teasers)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (1 << 20, 0):  # broadcast, and joined by salted hosts
        got = {r.page_id: r.text for r in w.extract_pages(df, limit).collect()}
        assert got[9] == ("the story goes on " * 8).strip() and got[0] == ("the story goes on " * 40).strip()
        assert "another story" in got[10]
    paths = w.path_votes(df.withColumn("host", w.host())).collect()
    best = min(paths, key=lambda r: tuple(r.order))
    assert (best.host, best.path) == ("a.example", "body>div.story")


def test_every_layout_of_a_host_counts(spark):
    """Twelve layouts and a small one on one host: short articles follow their own layout's path, none that of another."""
    teasers = "<div class='more'>" + "<p>another story you may read on this site </p>" * 6 + "</div>"
    name = "abcdefghijkl"
    story = lambda k, n: f"<div class='story {k}'><p>{'the story goes on ' * n}</p></div>"
    few = "<div class='more'><p>one</p></div>"
    rows = [(100 * k + i, page(story(c, 40) + few)) for k, c in enumerate(name) for i in range(60 if k == 0 else 5)]
    rows += [(5000 + k, page(story(c, 8) + teasers)) for k, c in enumerate(name)]
    # the minority has a short box on the path of the largest layout
    rows += [(9000 + i, page(f"<div class='note'><p>{'a minority text ' * 40}</p></div>" + story("a", 12) + f"<nav>{'menu ' * 200}</nav>")) for i in range(8)]
    df = spark.createDataFrame([(i, "http://a.example/", h) for i, h in rows], "page_id long, url string, html string")
    for limit in (1 << 20, 0):
        got = {r.page_id: r.text for r in w.extract_pages(df, limit).collect()}
        assert {got[5000 + k] for k in range(12)} == {("the story goes on " * 8).strip()}
        assert {got[9000 + i] for i in range(8)} == {("a minority text " * 40).strip()}


def test_hosts(spark):
    urls = ["http://A.b.c/x", "https://u:p@a.b:80?q", "ftp://h#x", "no url", None, "http:///x", "//x/y"]
    got = [r.h for r in spark.createDataFrame([(u,) for u in urls], "url string").select(w.host().alias("h")).collect()]
    assert got == ["a.b.c", "a.b", "h", "", "", "", ""]


def test_query_on_whole_pages(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = op2_html(spark, sf_dir).collect()
    assert {r.page_id for r in rows} == set(pages) and len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.DOTALL)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner))]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, host string, winners int, salt int, text string"
    rows = [(1, None, None, None, None, None, None), (None, "http://h", "", "x", 1, 2, "t"), (2, "http://h", PAGE, "x", 1, 2, "t"), (2, "http://h", PAGE, "x", 1, 2, "t")]
    got = w.extract_pages(spark.createDataFrame(rows, schema), 0).collect()
    assert sorted((str(r.page_id), r.n_chars > 0) for r in got) == [("1", False), ("2", True), ("2", True), ("None", False)]
    assert w.extract_pages(spark.createDataFrame([], schema)).collect() == []
