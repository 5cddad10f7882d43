"""Main text of pages: markup that breaks, side matter, and the article of all sample pages."""

import html
import re

import pytest

from oddsline.llm import html_text as H
from tests.conftest import DATA

PLAIN = H.Scores({})


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain  words\n here", "plain words here"),
    ("<p>One  two\n three<p>Four &lt;5&gt; &eacute;&#33;</p>", "One two three\nFour <5> é!"),
    ("<script>var a='<p>no</p>'</script><p>yes there</p><style>p{}</style>", "yes there"),
    ("<p>start<!-- <p>hidden</p> -->end</p><!-- open <p>lost", "startend"),
    ('<div class="top-menu">a b</div><div id="cookieNotice">c</div><p>text it is</p><div class=comments><p>nice</p></div>', "text it is"),
    ("<header>Site name here</header><article><header><h1>Title</h1></header><p>Body text</p></article>", "Title\nBody text"),
    ('<p title="a > b">quoted words</p><p title="open>more words here</p>', "quoted words\nmore words here"),
    ("<form>name <input> please</form><p>main words</p><aside>side words</aside>", "main words"),
    ("<p>a<br>b <b>c</b>d</p><p></p><p> </p>", "a b cd"),
    ("<textarea>never <p>this</p>", ""), ("<<p>>x", "<\n>x"), ("< p>5 < 6 words</p>", "< p>5 < 6 words"),
])
def test_pages(page, text):
    assert H.main_text(page, PLAIN) == text


def test_best_stretch_leaves_link_lists():
    links = "".join(f"<li><a href=x>go{i}</a></li>" for i in range(30))
    body = "".join(f"<p>{'word ' * 30}{i}</p>" for i in range(4))
    text = H.main_text(f"<ul>{links}</ul>{body}<ul>{links}</ul>", PLAIN)
    assert "go" not in text and text.count("\n") == 3


def test_long_broken_page_is_quick():
    assert H.main_text("<p title=\"" * 20000, PLAIN) == ""
    assert len(H.main_text("word " * 200000, PLAIN)) == 5 * 200000 - 1


def test_sample_pages(spark):
    pages = spark.read.parquet(f"{DATA}/sf0.01/pages.parquet")
    for r in H.extracted(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)[^>]*>", article))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_edge_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>x y"), (2, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS text", "1 AS n_chars")
    got = sorted(((r["page_id"] or 0), r["text"], r["n_chars"]) for r in H.extracted(pages).collect())
    assert got == [(0, "x y", 3), (1, "", 0), (1, "", 0), (2, "", 0)]
    assert H.extracted(pages.filter("false")).count() == 0


@pytest.mark.parametrize("wrapper", ['class="content has-sidebar"', "class=no-ads", 'class="with-comments"', 'id="search-results"',
                                     'class="main-with-sidebar"', 'data-id="form-1"', 'data-class=promo', 'title="id=menu"'])
def test_marked_wrappers_keep_their_article(wrapper):
    page = f"<div {wrapper}><article><h1>Title</h1><p>Body text here</p></article><div class=ads>buy</div></div>"
    assert H.main_text(page, PLAIN) == "Title\nBody text here"
    assert H.Reader(page).has_content
    assert H.main_text(f"<div {wrapper}><p>All words of this page are here</p></div>", PLAIN) == "All words of this page are here"


def test_marked_elements_stay_side_matter():
    main = "<article><p>the long article with most of the words</p></article>"
    side = '<div class="{}"><article><p>short teaser</p></article></div>'
    text = "the long article with most of the words"
    assert H.main_text(side.format("related") + f'<div class="search">{main}</div>' + side.format("comments"), PLAIN) == text
    assert H.main_text(main + "<div id=comments><p>" + "many words " * 40 + "</p></div>", PLAIN) == text
    assert H.main_text(f"<nav>{main}</nav>", PLAIN) == ""
    assert H.main_text("<h1>Site</h1><div id=search-results><p>" + "found " * 40 + "</p></div>", PLAIN).count("found") == 40


ARTICLE = "<p>" + "the article has these words " * 6 + "</p>"
ARTICLE_TEXT = ("the article has these words " * 6).strip()


def test_comments_are_never_the_article():
    reader = '<article class="comment"><p>' + "I liked it very much " * 60 + "</p></article>"
    for page in (f"<main>{ARTICLE}{reader}{reader}</main>", f"<article>{ARTICLE}</article>{reader}",
                 f'<main><h1>Title</h1>{ARTICLE}<section class="comments"><h2>Comments</h2><p>{"so true " * 200}</p></section></main>',
                 f'<section class="comments"><article><p>{"long reply " * 300}</p></article></section><article>{ARTICLE}</article>',
                 f'<article>{ARTICLE}</article><div id="user-comments-list"><article><h3>Me</h3><p>{"reply " * 300}</p></article></div>'):
        got = H.main_text(page, PLAIN)
        assert ARTICLE_TEXT in got and got.replace("Title\n", "") == ARTICLE_TEXT


def test_sections_about_a_marks_topic_stay():
    section = "<h2>Search engines</h2><p>" + "how engines find pages " * 5 + "</p>"
    for mark in ('id="search"', 'class="widget-quote"', 'class="share"', 'id="menu-history"', 'class="social-change"'):
        got = H.main_text(f"<article>{ARTICLE}<section {mark}>{section}</section>{ARTICLE}</article>", PLAIN)
        assert got.count("how engines find pages") == 5 and got.count(ARTICLE_TEXT) == 2, mark
    for box in ('<div id="search"><input> find it</div>', '<div class="share-bar">tell friends</div>',
                '<div class="ad-box"><h3>Buy</h3><p>cheap things</p></div>', '<div class="top-menu">one two</div>'):
        assert H.main_text(f"<article>{ARTICLE}{box}{ARTICLE}</article>", PLAIN) == ARTICLE_TEXT + "\n" + ARTICLE_TEXT


def test_weights_of_marks_are_learned(spark):
    site = '<article><h1>A title with a few words of its own</h1><div class="toolbar">{}</div></article><div class="comments">{}</div>'
    rows = [(i, "u", site.format("words of the article " * 20, "words of readers " * 20)) for i in range(40)]
    scores = H.learned(spark.createDataFrame(rows, "page_id long, url string, html string"))
    page = site.format("some words about tools " * 5, "nice " * 9)
    assert H.main_text(page, PLAIN) == "A title with a few words of its own"
    assert H.main_text(page, scores) == "A title with a few words of its own\n" + ("some words about tools " * 5).strip()
    assert scores.mark(frozenset(["comments"]), True, True) > 0 > scores.mark(frozenset(["toolbar"]), True, False)


def test_ties_take_the_first_stretch():
    block = "<p>one two three</p>"
    apart = "<ul>" + "<li><a href=x></a></li>" * 60 + "</ul>"
    assert H.main_text(block + apart + block, PLAIN) == "one two three"
