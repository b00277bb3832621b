"""Main text of pages of many layouts, broken pages and long ones."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from folioworks.llm.html_extract import extract, extract_main_text, vote

LONG = "word " * 60
W = LONG.strip()


def through_host(body: str) -> str:
    """The text as a host of such pages gives it."""
    page = f"<html><head><title>t</title></head><body><nav>menu</nav>{body}<footer>foot</footer></body></html>"
    text = extract(page, vote(page)[0])
    assert text == extract(page, None)
    return text


@pytest.mark.parametrize(
    ("body", "due"),
    [
        (f"<article><h1>T</h1><div class=body><p>{LONG}</p></div><div class=end><p>bye</p></div></article>", ["T", W, "bye"]),
        (f"<article><h1>T</h1><p>intro</p><ul><li>{LONG}</li><li>x</li></ul><p>outro</p></article>", ["T", "intro", W, "x", "outro"]),
        (f"<article><h1>T</h1><p>intro</p><blockquote>{LONG}</blockquote><p>outro</p></article>", ["T", "intro", W, "outro"]),
        (f"<article><h1>T</h1><table><tr><th>h<td>{LONG}<tr><td>c</table><p>end</p></article>", ["T", "h", W, "c", "end"]),
        (f"<article><h1>T</h1><section><h2>A</h2><p>{LONG}</p></section><section><h2>B</h2><p>s</p></section></article>", ["T", "A", W, "B", "s"]),
        (f"<div class=post><div class=lead>lead</div><div class=text>{LONG}</div></div><div class=sidebar><p>x</p></div>", ["lead", W]),
        (f"<h1>T</h1><div><p>{LONG}</p></div>", ["T", W]),
        (f"<main><h1>T</h1><article><p>{LONG}</p></article></main>", ["T", W]),
        (f"<article><header class='entry-header'><h1>T</h1></header><p>{LONG}</p><div class='side-by-side'>both</div></article>", ["T", W, "both"]),
        (f"<form id=all><main><p>{LONG}</p></main></form>", [W]),
        (f"<div class='page with-sidebar'><div class='sidebar-layout'><article><p>{LONG}</p></article></div></div>", [W]),
        (f"<article><p>{LONG}</p></article><article class=teaser><p>more</p></article>", [W]),
        (f"<article><p>{LONG}</p></article><article><p>{LONG}</p></article>", [W, W]),
        (f"<article><p>{LONG}</p><dl><dt>t<dd>d<dt>u<dd>e</dl><figure><figcaption>cap</figcaption></figure><pre>a\n  b</pre></article>", [W, "t", "d", "u", "e", "cap", "a b"]),
        (f"<article><p title=it's>{LONG}</p><p title='a>b'>q</p></article>", [W, "q"]),
        (f"<div id=wrap><div id=inner><h2>T</h2><p>{LONG}</p><div class=comments><p>hi</p></div></div></div>", ["T", W]),
        (f"<article><p>{LONG}</p><ul><li>a<ul><li>b</ul><li>c</ul></article>", [W, "a", "b", "c"]),
        (f"<body class='modal-open'><div class='post comments-open'><p>{LONG}</p><pre>x = 1 <span class='token comment'># one</span></pre><p><code>y <i class=comment># two</i></code> z <span class=ad>buy</span></p></div></body>", [W, "x = 1 # one", "y # two z"]),
        (f"<div id=content class=sidebar-right><h1>T</h1><p>{LONG}</p></div><div class='right-sidebar'><p>x</p></div>", ["T", W]),
        (f"<article><p>{LONG}<aside>no</aside><p>x &amp; y &#8212; &eacute;<p>i<!-- c -->j</article>", [W, "x & y — é", "ij"]),
    ],
)
def test_the_whole_article_and_nothing_else(body, due):
    assert through_host(body) == "\n\n".join(due)


SECTIONS = ["section id=related-work", "section id=comments-and-discussion", "section id=sharing-data", "section id=advertising-history", "section id=social-history", "section id=navigation-at-sea", "div class=share-price", "div class=recommended-dose"]
BOILERPLATE = ["div class=comments", "section id=comments", "div class='comment-list'", "div class=share-buttons", "div class=related-posts", "section class='related-articles'", "div class=newsletter-signup", "div id=ad-slot-3", "div class=ad-300x250", "ul class=social-links", "div class=cookieBanner"]


@pytest.mark.parametrize("part", SECTIONS)
def test_sections_named_by_their_headings_stay(part):
    tag = part.split()[0]
    inner = f"<{part}><h2>H</h2><p>said here</p></{tag}>"
    assert through_host(f"<article><h1>T</h1><p>{LONG}</p>{inner}</article>") == "\n\n".join(["T", W, "H", "said here"])


@pytest.mark.parametrize("part", BOILERPLATE)
def test_boilerplate_of_an_article_goes(part):
    tag = part.split()[0]
    inner = "<li>x" if tag == "ul" else "<p>x</p>"
    assert through_host(f"<article><h1>T</h1><p>{LONG}</p><{part}>{inner}</{tag}><p>end</p></article>") == "\n\n".join(["T", W, "end"])


@pytest.mark.parametrize(("source", "due"), [("AT&<b>amp</b>;T", "AT&amp;T"), ("&lt<i>;x</i>", "<;x"), ("&am<!-- -->p; &#<b>65</b>;", "&am" + "p; &#65;"), ("&amp;lt; &eacute;&#x41", "&lt; éA")])
def test_references_end_with_their_run_of_text(source, due):
    assert through_host(f"<article><p>{LONG}</p><p>{source}</p></article>") == W + "\n\n" + due


def test_pages_without_a_main_text_are_empty():
    for body in ("", "<nav>a</nav>", "<div class=ad>x</div>", "<form><p>x</p></form>", "<script>x</script>", "<div class='cookie-banner'><p>x</p></div>"):
        assert extract(f"<html><body>{body}</body></html>", None) == ""


def test_a_page_of_another_layout_follows_its_host():
    page = f"<body><div class=story><p>s</p></div><div class=extra><p>{LONG}</p></div></body>"
    assert extract(page, "html>body>div.story") == "s"
    assert extract(page, "html>body>div.gone") == W
    assert extract("<section class=a1><p>x</p></section><section class=a22><p>y</p></section>", "html>body>section.a#") == "x\n\ny"


@pytest.mark.parametrize("bad", ['<a title="x"', "<div>", "<b>", '<a t=">x"', "<i></b>", "<div><li></li>", "<table><tr><td>", "<a t='", "<!-- ", "</", '<b c="d>', "<p><span class=ad>", "&amp", "<ul><li><div>"])
def test_broken_pages_take_time_by_their_length(bad):
    def seconds(size):
        page = bad * (size // len(bad))
        start = time.perf_counter()
        extract(page, vote(page)[0])
        return time.perf_counter() - start

    small, large = seconds(1 << 17), seconds(1 << 20)
    assert large < 20 * small + 1


def test_very_long_page_and_deep_paths():
    paragraphs = [f"p{i} {W}" for i in range(5000)]
    assert extract("<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>", None) == "\n\n".join(paragraphs)
    deep = "<div class='wrap-of-long-name-{0}'>" * 60 + "<h1>T</h1><p>{1}</p>"
    one, two = deep.format(1, W), deep.replace("long", "deep", 1).format(2, W)
    assert vote(one)[0] != vote(two)[0] and len(vote(one)[0]) > 1000
    assert extract(one, vote(one)[0]) == extract(one, vote(two)[0]) == f"T\n\n{W}"


def test_hard_tables(spark):
    rows = [(1, None, None), (1, "http://h/", ""), (None, "http://h/", f"<p>{W}</p>"), (2, "x", "<p>a</p>"), (2, "x", "<p>a</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    wide = pages.select("*", *(F.lit("x").alias(c) for c in ("host", "path", "text", "n_chars", "votes", "score")))
    due = sorted([(1, "", 0), (1, "", 0), (None, W, len(W)), (2, "a", 1), (2, "a", 1)], key=str)
    for frame in (pages, wide):
        for few in (0, 10):
            assert sorted(((r.page_id, r.text, r.n_chars) for r in extract_main_text(frame, most_hosts=few).collect()), key=str) == due
    assert extract_main_text(wide.limit(0)).collect() == []
