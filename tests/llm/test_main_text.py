"""Main text of pages: the table's template, hand-made pages, odd input and linear time."""

import time

import pytest

from sheafline.llm.page_text import extract_main_text, main_text

LONG = "The harbour was closed for a week, and nobody knew why; the ships waited outside, one behind the other. "

SOUP = f"""<html><body class="has-sidebar"><div class="site-header">Daily, paper. Of record.</div>
<div id="main-menu"><ul><li><a href="/">Home</a></li><li><a href="/a">Away</a></li></ul></div>
<div class="cookie-banner">We use cookies, as everybody does. Please agree, or leave.</div>
<div class="wrap"><div class="content"><h2>Ships &amp; Storms</h2><p>{LONG}<b>Bold</b> end.</p><p>Short.</p>
<ul><li>First point</li><li>Second point</li></ul><blockquote>{LONG}</blockquote><p>Caf&eacute;&nbsp;&#8212; <a href="x">link</a>.</p></div>
<div class="sidebar"><p>{LONG}</p></div></div>
<form action="/s"><p>{LONG}</p><textarea><p>{LONG}</p></textarea></form>
<section id="comments"><p>{LONG}</p><article class="comment"><p>{LONG}</p></article></section>
<div class="ad-slot-3">{LONG}</div><footer><p>{LONG}</p></footer><script>document.write("<p>{LONG}</p>")</script></body></html>"""


def test_soup():
    text = LONG.strip()
    assert main_text(SOUP).split("\n\n") == [
        "Ships & Storms", f"{text} Bold end.", "Short.", "First point", "Second point", text, "Café — link.",
    ]


def test_title_outside_the_text_and_what_stands_beside_it():
    page = f"""<body><div id="page"><div class="top"><p>My pages. Words, words.</p></div><div id="main"><div class="entry"><h1>A title</h1>
    <div class="by">By Ann</div><div class="text"><p>{LONG}</p><h3>Sub</h3><p>{LONG * 2}</p><pre>code  here</pre><p>Ok.</p></div>
    <div class="tags"><a href=t>tag</a> <a href=u>other</a></div></div></div><div id="more"><h3>Archives</h3><ul><li><a href=x>May</a></li></ul></div>
    <div id="end"><h2>Imprint</h2><p>Made of things.</p></div></div></body>"""
    assert main_text(page).split("\n\n") == ["A title", LONG.strip(), "Sub", (LONG * 2).strip(), "code here", "Ok."]


def test_unnamed_containers_are_told_apart_by_ratios():
    page = (
        "<body><div><span>Paper</span></div><table><tr><td><ul>" + "<li><a href=x>Section page</a></li>" * 12 + "</ul></td></tr></table>"
        f"<section><h1>Title</h1><p>{LONG}</p><p>{LONG * 3}</p><p>End.</p></section><div>Imprint</div></body>"
    )
    assert main_text(page).split("\n\n") == ["Title", LONG.strip(), (LONG * 3).strip(), "End."]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("plain text, no markup", "plain text, no markup"),
        ("<p>a<br>b\n\t c<p>d", "a b c\n\nd"),
        ("<article><p>kept</p><header><h1>Title</h1></header><footer>no</footer></article><header>no, no.</header>", "kept\n\nTitle"),
        ("<body><nav>a</nav><a href=x>only links</a></body>", ""),
        ("<p>a &lt;b&gt; c</p>", "a <b> c"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<p title='a > b'>x</p><!-- <p>y</p> --><p>z</p>", "x\n\nz"),
        ("<p>x</p><!-- never ends <p>y</p>", "x"),
        ("<p>x</p><script>if (a < b) '<p>y</p>'", "x"),
        ("<article></article>", ""),
    ],
)
def test_small_pages(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize(
    ("attribute", "dropped"),
    [
        ('class="rightsidebar"', True), ("id=cookieBar", True), ('class="x commentlist"', True), ("class='alert alert-info'", True),
        ('role="navigation"', True), ('class="post-content"', False), ('class="has-sidebar"', False), ('id="article-body"', False),
        ('class="content with-sidebar"', False), ('class="commentary"', False), ('class="admiral addendum"', False), ('data-class="ad"', False),
    ],
)
def test_declared_parts(attribute, dropped):
    page = f"<body><div class=story><p>{LONG}</p></div><div {attribute}><p>{LONG}</p></div></body>"
    assert main_text(page).count(LONG.strip()) == (1 if dropped else 2)


@pytest.mark.parametrize(
    "piece", ["<", "<!--", "<a x='", "<script>", "<div>x.", "<div class=a>", "<p>", "</div>", "= ", "&", "<td>", "&lt"]
)
def test_time_is_linear(piece):
    def taken(n):
        page, best = piece * n, float("inf")
        for _ in range(2):
            started = time.perf_counter()
            main_text(page)
            best = min(best, time.perf_counter() - started)
        return best

    assert taken(40_000) < 12 * taken(10_000) + 0.2


def test_odd_rows(spark):
    rows = [(1, None, "old", 1), (None, "<p>x</p>", "old", 2), (1, "<p>x</p>", None, 3), (1, "<p>x</p>", None, 3), (2, "", "t", 4)]
    pages = spark.createDataFrame(rows, "page_id long, html string, TEXT string, n_chars int")
    got = extract_main_text(pages)
    assert got.columns == ["page_id", "text", "n_chars"] and got.schema["n_chars"].dataType.simpleString() == "bigint"
    assert sorted(got.collect(), key=str) == sorted([(1, "", 0), (None, "x", 1), (1, "x", 1), (1, "x", 1), (2, "", 0)], key=str)
    assert extract_main_text(pages.limit(0)).collect() == []


def test_bytes_that_are_no_text_and_long_pages(spark):
    broken = spark.sql("SELECT 1 AS page_id, CAST(unhex('3C703E61FF62') AS STRING) AS html")
    assert extract_main_text(broken).first()["text"] == "a�b"
    page = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    got = extract_main_text(spark.createDataFrame([(1, page)], "page_id long, html string")).first()
    assert got["text"] == "\n\n".join([LONG.strip()] * 20_000) and got["n_chars"] == len(got["text"])
