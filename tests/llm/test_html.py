"""Operator 2: labelling, DOM reading and the minimum cut against brute force."""

from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prefspark.llm import html_text as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><a href="/">Home of things</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, and you agree to that by reading on.</div>
<main><article><h1>A &amp; B</h1><p>First   paragraph,
with <b>bold</b> words &lt;here&gt;.<p>Second one.<ul><li>One<li>Two</ul>
<div class="ad">Buy this thing now, it is very good.</div><p>Short</p>
<form><label>Mail</label><input name="q"><button>Send</button></form><p>Last words of the text.</p></article></main>
<section id="comments"><p>I liked reading this very much, thank you.</p></section>
<aside class="sidebar"><p>Read more of our many other stories here today.</p></aside><footer>&copy; us</footer></body></html>"""


def test_article_of_a_page():
    assert h.main_text(PAGE).split("\n\n") == [
        "A & B", "First paragraph, with bold words <here>.", "Second one.", "One", "Two", "Short", "Last words of the text."
    ]


def test_broken_markup():
    assert h.main_text("<article><p><b>One.<br><p>Two.</p>Three.<br></article><footer>no</footer>") == "One.\n\nTwo.\n\nThree."
    assert h.main_text("<article><p>a < b and 3<4</p><!-- <p>no</p> --><p title='x>y'>c</p>") == "a < b and 3<4\n\nc"
    assert h.main_text("<article><p>kept<script>if (a<b) document.write('<p>no')") == "kept"
    assert h.main_text('<article><p class="x>unclosed</p><p>y</p></article>') is not None


def test_page_without_article_element():
    page = "<div id=top><a href=1>x</a> <a href=2>y</a></div>" + "".join(
        f"<div><p>This is a long enough paragraph of running text, number {i}.</p></div>" for i in range(3)
    ) + "<div class=footer>Imprint</div>"
    assert h.main_text(page).count("\n\n") == 2
    assert "Imprint" not in h.main_text(page) and "x" not in h.main_text(page).split()


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "</p></p>", "<html></html>", "\x00", "&", "<!--"])
def test_odd_pages(page):
    assert isinstance(h.main_text(page), str)


def test_deep_and_long_pages_are_linear():
    assert h.main_text("<article>" + "<div><b>" * 20_000 + "deep") == "deep"
    assert h.main_text("<article>" + "<p>word" * 20_000).count("word") == 20_000


def test_operator_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y")]
    got = h.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [len(r.text) > 0 for r in sorted(got, key=lambda r: r.page_id)] == [True, True, False]
    assert h.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0



@settings(max_examples=200, deadline=None)
@given(st.data())
def test_minimum_cut_is_minimal(data):
    n = data.draw(st.integers(1, 7))
    net = [data.draw(st.integers(-6, 6)) for _ in range(n)]
    pairs = [(a, b) for a in range(n) for b in range(a)]
    edges = [(a, b, data.draw(st.integers(0, 6))) for a, b in pairs if data.draw(st.booleans())]
    value = lambda s: sum(x for x, k in zip(net, s) if x > 0 and not k) + sum(-x for x, k in zip(net, s) if x < 0 and k) + sum(
        c for a, b, c in edges if s[a] != s[b])
    best = min(value(s) for s in product([False, True], repeat=n))
    assert value(h.minimum_cut(net, edges)) == best


def test_bad_words_of_frames_and_wrappers_leave_the_article():
    """Words on html, body, main and article, and on a wrapper outside of an article, do not drop its text."""
    from prefspark.llm.html_text import main_text

    text = "The long first paragraph of the story has many words, and it ends with a full stop."
    page = "<html{h}><body{b}><div{w}><main{m}><article{a}><p>" + text + "</p><div class='share'>Share this now</div></article></main></div></body></html>"
    none = dict.fromkeys("hbwma", "")
    for odd in ({}, {"h": " class='no-comments'"}, {"b": " class='has-sidebar'"}, {"b": " class='menu-closed'"}, {"b": " id='popup banner'"},
                {"a": " class='post category-legal'"}, {"m": " class='header'"}, {"w": " class='with-sidebar'"}):
        assert main_text(page.format(**none | odd)) == text, odd
    for hidden in (" hidden", " style='display:none'"):
        assert main_text(page.format(**none | {"w": hidden})) == ""
    assert main_text(f"<body><div class='sidebar'><p>{text}</p></div><article><p>{text}</p></article></body>") == text


LONG = "The long paragraph of the story has many words in it, and it ends with a full stop."


@pytest.mark.parametrize("markup", ["section class='legal'", "div class='form-of-government'", "ul class='social-history'", "div class='comment-on-law'",
                                    "div class='share-price-report'", "div id='search'", "div class='no-comments'"])
def test_article_text_with_a_class_that_names_its_subject_stays(markup):
    name = markup.split()[0]
    inner = f"<li>{LONG}</li>" if name == "ul" else f"<p>{LONG}</p>"
    assert h.main_text(f"<article><p>{LONG}</p><{markup}>{inner}</{name}><p>Last words.</p></article>") == f"{LONG}\n\n{LONG}\n\nLast words."


@pytest.mark.parametrize("markup", ["div class='ad-box'", "div class='site_footer'", "div class='x cookie-notice'", "div class='comments'", "div id='share-buttons'", "nav", "aside"])
def test_boilerplate_inside_of_an_article_goes(markup):
    assert h.main_text(f"<article><p>{LONG}</p><{markup}><p>{LONG} Not this.</p></{markup.split()[0]}></article>") == LONG


@pytest.mark.parametrize("page", [
    "<article><p>{0}</p></article><div class='reader-thread'><article><p>{0} I say.</p></article></div>",
    "<article><p>{0}</p><section class='comments'><article class='post'><p>{0} I say.</p></article></section></article>",
    "<article><h1>Title</h1><p>{0}</p><div class='below'><article><p>{0} I say.</p><article><p>{0} So do I.</p></article></article></div></article>",
])
def test_comments_marked_up_as_articles_go(page):
    assert "say" not in h.main_text(page.format(LONG)) and LONG in h.main_text(page.format(LONG))


def test_an_article_that_only_wraps_articles_keeps_them():
    page = f"<article class='page'><header><a href=1>Home</a></header><article><p>{LONG}</p></article></article>"
    assert h.main_text(page) == LONG


@pytest.mark.parametrize("piece", ['<a "', "<a ", "<a '", "<!x", "</", "<a \"'", '<a ">', "<a '\">", '<a " b=\'">x', "<", "&", "<b x='>\"", "<!--"])
@pytest.mark.parametrize("tail", ["", ">", '">', "' \">"])
def test_hostile_pages_are_linear(piece, tail):
    import time

    page = piece * (400_000 // len(piece)) + tail
    begin = time.perf_counter()
    assert isinstance(h.main_text(page), str)
    assert time.perf_counter() - begin < 5
