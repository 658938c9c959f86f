import random

import pytest
from pyspark.sql import functions as F

from trapiche.llm import page_text
from trapiche.llm.page_text import (
    Page,
    _page,
    around,
    extract_main_text,
    page_lines,
    shared_lines,
    template_lines,
)

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
<script>var t="</p><p>no</p>";</script></head><body><header>Site</header>
<nav><ul><li>Menu</ul></nav><!-- ad --><div class="ad">Buy</div>
<div class="content-with-sidebar"><article><h1>Head&amp;line &copy</h1>
<p><b>One<br>two &#233;  three<p>Four <a href="x">link</a>
<form><p>Mail <input></p></form><aside>Side</aside>
<div class="comments"><p>First!</p></div><section id="related-posts">More</section></article></div>
<div class="sidebar">Bar</div><footer>Foot</footer>"""


def as_page(html):
    return Page(*[_page(html)[c] for c in Page._fields])


def main_text(html, near=()):
    """The text of a page beside some neighbours, from the nearest outwards."""
    gone = template_lines(as_page(html), [as_page(other) for other in near])
    return "\n\n".join(x for i, x in enumerate(_page(html)["lines"]) if i not in gone)


def test_article_of_a_page():
    assert main_text(PAGE) == "Head&line ©\n\nOne two é three\n\nFour link"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><head><title>T</title><meta name=x><body><article><p>A</article>", "A"),
        ("<head><title>T</title><style>p{}</style><p>A", "A"),
        ("plain &lt;text&gt;", "plain <text>"),
        ("<p>a<p>b<div>c", "a\n\nb\n\nc"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>a < b & c</p></article>", "a < b & c"),
        ("<nav>x</nav>", ""),
        ("<main><p>x</p><script>y", "x"),
        ("<article><header><h1>t</h1></header><p>x</p></article>", "t\n\nx"),
        ("<div role=navigation>n</div><p>x</p>", "x"),
        ("<section class='comments'><article><p>me too</p></article></section><main>x</main>", "x"),
        ("<article><ul><li>a<li>b</ul></article>", "a\n\nb"),
        ("<p hidden>h</p><p>x", "x"),
        ("<form><nav>m</nav><article><p>A</article><p>send</form>", "A"),
        ("<body><form id=aspnet><p>A<p>B <input><label>n</label></form>", "A\n\nB"),
        ("<form><p>search</form><p>A", "A"),
        ("<article class='article share-buttons-on'><p>A</article><p>x", "A"),
        ("<main><div class='story related-topics'><p>A</div></main>", "A"),
        ("<main><div class='related-topics'><p>A</div></main><p>x", "A"),
        ("<main><p>A<div class='related-topics'><p>more</div></main>", "A"),
        ("<div class='with-notice'><article>A</article></div><p>x", "A"),
        ("<main><p>A</main><article class=comment><p>me too</article>", "A"),
        ("<article><p>A<textarea>x</article><p>B", "A"),
    ],
)
def test_markup(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("seed", range(6))
def test_shared_lines_are_a_longest_common_subsequence(seed):
    draw = random.Random(seed)
    a, b = ([draw.choice("abcdef") for _ in range(draw.randrange(40))] for _ in range(2))
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
    found = shared_lines(a, b)
    assert len(found) == table[-1][-1] and found == sorted(set(found))
    rest = iter(b)
    assert all(a[i] in rest for i in found)


def unmarked(number):
    body = "".join(f"<p>text {number} {i}</p>" for i in range(5))
    return f"<div>Home | News</div>{body}<div>All about us</div>"


@pytest.mark.parametrize("block", [256, 17])
def test_differencing_removes_the_template(spark, monkeypatch, block):
    monkeypatch.setattr("trapiche.llm.page_text.BLOCK", block)
    rows = [(i, f"http://h.com/a/{i:03d}", unmarked(i)) for i in range(20)]
    rows += [(100, "http://h.com/a/003?x=1", unmarked(3)), (101, "http://lone.com/", unmarked(1))]
    rows += [(102, "http://h.com/a/zzz", None), (103, None, unmarked(7)), (None, "no host", unmarked(8))]
    rows += [(104, "http://c.com/1", unmarked(50)), (105, "http://c.com/2", unmarked(50))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    pages = pages.withColumns({c: F.lit("own") for c in ("text", "host", "path", "content", "lines", "id", "mark")})
    found = {r["page_id"]: r for r in extract_main_text(pages).collect()}
    assert len(found) == len(rows)

    def article(number):
        return "\n\n".join(f"text {number} {i}" for i in range(5))

    for i in range(20):
        assert found[i]["text"] == article(i) and found[i]["n_chars"] == len(article(i))
    assert found[100]["text"] == article(3)
    whole = f"Home | News\n\n{article(1)}\n\nAll about us"
    assert found[101]["text"] == whole
    assert found[102]["text"] == "" and found[102]["n_chars"] == 0
    assert found[103]["text"].startswith("Home") and found[None]["text"].startswith("Home")
    # Copies of one article on one host show no template.
    assert found[104]["text"] == found[105]["text"] != ""


def test_differencing_inside_articles():
    def page(number):
        return f"<article><p>one {number}<p>Share this<p>two {number}<p>three {number}</article>"

    quoting = "<article><p>Share this<p>other<p>text</article>"
    other = "<article><p>a<p>b<p>c</article>"
    near = [page(i) for i in range(2, 7)]
    clean = "one 1\n\ntwo 1\n\nthree 1"
    # Copies, exact or near, show nothing, and the next page takes their place.
    nearly = page(1).replace("three 1", "three")
    for beside in ([*near, quoting], near[:3], [page(1), nearly, *near]):
        assert main_text(page(1), beside) == clean
    # Some neighbours may quote a line, and two pages are too few.
    for beside in ([], near[:2], [*near, other], [page(1), nearly, nearly]):
        assert "Share this" in main_text(page(1), beside)


def test_template_of_half_the_lines():
    def page(number, article=None):
        article = number if article is None else article
        return f"<div>Home</div><p>a {article}<p>b {article}<div>About</div><div>Page {number}</div>"

    near = [page(i) for i in range(2, 9)]
    assert main_text(page(1), near) == "a 1\n\nb 1\n\nPage 1"
    # Print and mobile copies of the article stand nearest.
    assert main_text(page(1), [page(20, 1), page(21, 1), *near]) == "a 1\n\nb 1\n\nPage 1"


def expected_texts(rows):
    """Plain differencing over one sorted list of the distinct pages of each host."""
    hosts = {}
    for _, host, path, html in rows:
        hosts.setdefault(host, {})[path, as_page(html).content] = as_page(html)
    texts = {}
    for own, host, path, html in rows:
        order = sorted(hosts[host])
        pages = [hosts[host][key] for key in order]
        place = order.index((path, as_page(html).content))
        gone = template_lines(as_page(html), around(pages, place))
        kept = [x for i, x in enumerate(_page(html)["lines"]) if i not in gone]
        texts[own] = ("\n\n".join(kept), len(gone))
    return texts


@pytest.mark.parametrize("block", [16, 33, 256])
def test_whole_operator_equals_plain_differencing(spark, monkeypatch, block):
    monkeypatch.setattr(page_text, "BLOCK", block)
    draw = random.Random(5)
    rows = []
    for own in range(400):
        host = draw.choice(["a.com", "a.com", "a.com", "b.com", f"c{own % 7}.com"])
        section = draw.choice("xyz")
        article = draw.choice([own, own, own, draw.randrange(20)])
        body = "".join(f"<p>text {article} {i}" for i in range(draw.randrange(4)))
        body = f"<div>Section {section}</div>{body}<div>Share</div>"
        if draw.random() < 0.5:
            body = f"<article>{body}</article>"
        html = f"<div>Menu of {host}</div>{body}<div>About {host}</div>"
        rows.append((own, host, f"/{section}/{draw.randrange(300)}", html))
    table = spark.createDataFrame(
        [(own, f"http://{host}{path}", html) for own, host, path, html in rows],
        "page_id long, url string, html string",
    ).repartition(5)
    found = {
        r["page_id"]: (r["text"], r["n_template"])
        for r in extract_main_text(table).collect()
    }
    expected = expected_texts(rows)
    assert found == expected
    assert sum(gone > 0 for _, gone in expected.values()) > 100


def test_text_ids(spark):
    pages = spark.createDataFrame([("a", "http://h.com/1", "<p>x")], "page_id string, url string, html string")
    assert [(r["page_id"], r["text"]) for r in extract_main_text(pages).collect()] == [("a", "x")]


@pytest.mark.parametrize("pages", [1, 2, 5, 9])
def test_every_page_of_a_host_is_settled_once(spark, pages):
    rows = [(10 * i + k, f"http://h.com/{i}", f"<main>text {i} {k}</main>") for i in range(pages) for k in range(i % 3 + 1)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract_main_text(table).collect()}
    assert found == {own: f"text {own // 10} {own % 10}" for own, _, _ in rows}


def test_long_page_and_empty_table(spark):
    long = "<article>" + "".join(f"<p>line {i}</p>" for i in range(20_000)) + "</article>"
    pages = spark.createDataFrame([(1, "http://a.com/x", long)] * 2, "page_id long, url string, html string")
    found = extract_main_text(pages).collect()
    assert len(found) == 2 and found[0]["text"].count("\n\n") == 19_999
    assert extract_main_text(pages.where("false")).collect() == []
