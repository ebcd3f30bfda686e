"""Operator 4 on hand-made pages and on every page of the table."""

import re
from html import unescape

from voxlake.llm import html_text


def test_parts_that_are_not_content():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
    <header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
    <div class="cookie-notice">We use cookies, really, many of them, on this page and others.</div><!-- <p>no</p> -->
    <main><article><header><h1>Title &amp; more</h1></header><p>First  paragraph, with <b>bold</b>, and <a href="#">a link</a>.<p>Second,
    unclosed &#233;t&eacute;, long enough to count as a paragraph of prose.<br>Next line.</p><ul><li>One, item</li><li>Two</li></ul>
    <form><label>Mail</label><input></form><aside>Aside, not this.</aside></article>
    <section id="comments"><p>A comment, which is long, and has commas, so it would score well, but is no content.</p></section></main>
    <div class="sidebar"><p>Side, bar.</p></div><footer>&copy; F</footer></body></html>"""
    want = "Title & more\nFirst paragraph, with bold, and a link.\nSecond, unclosed été, long enough to count as a paragraph of prose. Next line.\nOne, item\nTwo"
    assert html_text.extract_one(page) == want


def test_broken_pages():
    assert html_text.extract_one("<p>a<b>b<p>c</i>d<script>x") == "ab\ncd"
    assert html_text.extract_one("plain, text & more &lt;") == "plain, text & more <"
    assert html_text.extract_one("<div" + "<div>" * 30_000 + "deep") == "deep"
    assert html_text.extract_one("<script>") == html_text.extract_one("") == html_text.extract_one(None) == ""


def test_long_bodies_inside_an_article():
    prose = lambda n: "".join(f"<p>Paragraph {i}, with some commas, and enough words, to score as prose would, if it were read.</p>" for i in range(n))
    lines = lambda n: [f"Paragraph {i}, with some commas, and enough words, to score as prose would, if it were read." for i in range(n)]
    menu = "<ul><li><a href='/a'>Another page</a></li><li><a href='/b'>One more page</a></li></ul>"
    for n in (1, 3, 20, 60):
        for tag in ("article", "main"):
            page = f"<body><{tag}><h1><a href='/'>Short title</a></h1><p>Short lead.</p><div>{prose(n)}</div><section><p>Small end.</p></section></{tag}></body>"
            assert html_text.extract_one(page).split("\n") == ["Short title", "Short lead.", *lines(n), "Small end."]
        page = f"<body><main><article><div><h2>T</h2></div><section>{prose(n)}</section><section>{prose(2)}<div><p>Tail.</p></div></section></article></main></body>"
        assert html_text.extract_one(page).split("\n") == ["T", *lines(n), *lines(2), "Tail."]
    page = f"<article><h1>Title</h1>{menu}<div>{prose(30)}{menu}</div><p>End.</p></article>"
    assert html_text.extract_one(page).split("\n") == ["Title", *lines(30), "Another page", "One more page", "End."]


P = [f"Paragraph {i}, with some commas, and enough words, to score as prose would, if it were read." for i in range(5)]
BODY = "".join(f"<p>{p}</p>" for p in P)
MENU = "<ul><li><a href='/a'>Another page</a></li><li><a href='/b'>One more page</a></li></ul>"


def test_page_shapes():
    """Ten shapes of pages: what is around the best container and belongs to the article stays, the rest goes."""
    say = html_text.extract_one
    assert say(f"<main><h1>Short title</h1><div class='body'>{BODY}</div></main>") == "\n".join(["Short title", *P])
    assert say(f"<body><div id='page'><div class='lead'>A lead.</div><div class='body'>{BODY}</div><ul><li>One</li><li>Two</li></ul></div></body>") == "\n".join(["A lead.", *P, "One", "Two"])
    assert say(f"<body><div><div>{BODY}</div><div><h2>More</h2><p>Short.</p></div></div></body>") == "\n".join([*P, "More", "Short."])
    assert say(f"<article>{BODY}<div class='related-work'><h2>Related work</h2><p>Others did this before.</p></div><p class='social'>The social question is old.</p></article>") == "\n".join([*P, "Related work", "Others did this before.", "The social question is old."])
    assert say(f"<article>{BODY}<div class='share'>Tweet Post</div><div class='related'>{MENU}</div><div class='comments'><p>A comment, this one.</p></div></article>") == "\n".join(P)
    assert say(f"<body><h1>Title</h1>{BODY}<div class='footer'>&copy; us</div></body>") == "\n".join(["Title", *P])
    assert say(f"<body>{MENU}<div><div>{MENU}</div><div><h1>Title</h1>{BODY}</div><div>© 2020 Someone. All rights reserved.</div></div></body>") == "\n".join(["Title", *P])
    assert say(f"<body><div>We use cookies, many. <button>Fine</button></div><h1>Title</h1><div>{BODY}</div><div>{MENU}</div></body>") == "\n".join(["Title", *P])
    assert say(f"<article><p><label>Term</label> means this.</p><object data='x'><p>Fallback text.</p></object>{BODY}</article>") == "\n".join(["Term means this.", "Fallback text.", *P])
    table = "<table><tr><th>Year</th><th>Sum</th></tr><tr><td>1999</td><td>12</td></tr></table>"
    assert say(f"<main><div class='entry'><h2>Q</h2>{BODY}{table}<blockquote>Said so.</blockquote><pre>x = 1</pre><dl><dt>A</dt><dd>B</dd></dl></div><div class='newsletter'><p>Get our letter, weekly.</p></div></main>") == "\n".join(["Q", *P, "Year", "Sum", "1999", "12", "Said so.", "x = 1", "A", "B"])


def test_names_are_no_verdict_on_a_whole_page():
    say, lines = html_text.extract_one, "\n".join(P)
    for name in ("tags-and-links", "comment-article", "widget", "related", "banner", "rail", "discussion", "alert"):
        assert say(f"<body><div class='{name}'>{BODY}</div></body>") == lines, name
        assert say(f"<body><nav>{MENU}</nav><div class='{name}'><div class='promo'>{BODY}</div></div><footer>x</footer></body>") == lines, name
    assert say(f"<body><div class='sidebar'><p>Side, bar.</p></div><div class='widget'>{BODY}</div></body>") == lines
    assert say(f"<body><article>{BODY}</article><div class='comments'>{BODY}{BODY}{BODY}</div></body>") == lines  # many comments are still comments


def test_readers_notices_and_rails():
    say, lines = html_text.extract_one, "\n".join(P)
    talk = "<p>I disagree, reader one said so.</p>"
    for name in ("discussion", "user-reviews", "responses", "feedback"):
        assert say(f"<article>{BODY}<section class='{name}'>{talk}</section></article>") == lines, name
        assert say(f"<main>{BODY}<div class='{name}'>{talk}</div></main>") == lines, name
    assert say(f"<article>{BODY}<section class='discussion'><h2>Discussion</h2><p>We find that, so far, all is well.</p></section></article>") == lines + "\nDiscussion\nWe find that, so far, all is well."
    assert say(f"<main><div class='alert'>This page will be offline on Sunday.</div>{BODY}</main>") == lines
    assert say(f"<body><div><div class='rail'><p>Beside, the content.</p></div><div class='story'>{BODY}</div></div></body>") == lines
    assert say(f"<article><p>Let <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation encoding='tex'>x+1</annotation></math> be odd.</p>{BODY}</article>") == "Let x+1 be odd.\n" + lines


def test_very_long_text():
    text = "long words, " * 100_000
    assert html_text.extract_one(f"<nav>x</nav><article><p>{text}</p></article>") == text.strip()


def test_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = {r.page_id: r for r in html_text.extract(pages).collect()}
    assert len(rows) == pages.count()
    for r in pages.collect():  # these pages hold one article each
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " ")))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        assert rows[r.page_id].text == "\n".join(b for b in blocks if b)
        assert rows[r.page_id].n_chars == len(rows[r.page_id].text)


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", "<p>x"), (1, "v", "")], "page_id long, url string, html string").selectExpr("*", "1 as text")
    assert sorted((r.text, r.n_chars) for r in html_text.extract(df).collect()) == [("", 0), ("", 0), ("x", 1)]
    assert html_text.extract(df.limit(0)).count() == 0
