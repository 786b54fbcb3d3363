"""Main text of pages of several makes."""

import re

import pytest

from shiplog.llm import html_extract as H
from shiplog.llm.common import read_table

PARAGRAPHS = [f"This is paragraph {i}, which says a number of things, and says them at some length; it ends here." for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
TEXT = " ".join(PARAGRAPHS)
NAV = "<nav><ul>" + "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(9)) + "</ul></nav>"
COMMENTS = '<div class="comments"><h3>Comments</h3>' + "".join(f"<div class='comment'><p>I think, in truth, that number {i} is quite wrong, as I said.</p></div>" for i in range(3)) + "</div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body>{NAV}<article>{BODY}</article><footer>&copy; a site, all rights reserved.</footer></body></html>",
        f"<body><div id='header'><h1>Site</h1></div>{NAV}<div id='content'>{BODY}</div><div class='sidebar'><p>Aside text, for you.</p></div>{COMMENTS}</body>",
        f"<body>{NAV}<main>{BODY}{COMMENTS}<form><label>Name, please</label><input></form></main>",
        f"<div class='cookie-notice'>We use cookies, as you know, to make things better, and so on.</div><div>{NAV}<div><div class='ad'>Buy, buy!</div>{BODY}</div></div>",
        f"<body><div class='main-nav'>Home, about, and more.</div><div class='post-body has-sidebar'>{BODY}<div class='post-share'>Share it, please.</div></div>"
        f"<section id='articleComments'><article class='comment'><p>Well, I do not think so, and I never did.</p></article></section></body>",
        f"<body><article>{BODY}<script>var t='</p>';</script><style>p{{}}</style><!-- hidden <p>words</p> --></article>",
    ],
)
def test_article_only(page):
    assert H.extract(page) == TEXT


def test_names():
    for names in ("ad", "main-nav", "post-comments", "sidebar-content", "siteFooter", "comment post", "cookie_notice", "entry-footer", "reader-responses"):
        assert H.is_side(names), names
    for names in ("", "article", "main-content has-sidebar", "post-body", "content no-ads", "lead", "download", "headline", "shadow", "adagio"):
        assert not H.is_side(names), names


@pytest.mark.parametrize("paragraphs", [6, 60])
def test_nothing_but_side_text_is_dropped(paragraphs):
    body = BODY * (paragraphs // 6)
    text = " ".join([TEXT] * (paragraphs // 6))
    lead = "The lead says, in short, what all of this is about."
    page = f"<body>{NAV}<div id='content'><h1>A title</h1><p class='lead'>{lead}</p><div class='body'>{body}</div></div>{COMMENTS}</body>"
    assert H.extract(page) == f"A title {lead} {text}"
    halves = f"<article>{body}</article><article><h2>Part two</h2>{BODY[: len(BODY) // 6 * 5 - 5]}</article>"
    second = H.extract(f"<body>{BODY[: len(BODY) // 6 * 5 - 5]}</body>")
    assert H.extract(f"<body>{NAV}<div>{halves}</div></body>") == f"{text} Part two {second}"


@pytest.mark.parametrize(
    "inner",
    [
        "<p>As <math><mi>x</mi></math> says.</p>",
        "<p>A <label>labelled</label> word.</p>",
        '<div class="share-price"><p>The price rose, and rose, and then it fell; nobody knew why.</p></div>',
        '<p class="tags">Of tags, of labels and of names, one may say a number of things at some length.</p>',
        'Some <span class="hidden-gem">hidden gem</span> is here.',
        'One <span class="search-term">term of search</span> is here.',
        '<div class="reviews"><p>This is what the papers said, at length, and in their own words; it goes on, and on.</p></div>',
    ],
)
def test_names_do_not_overrule_high_ratios(inner):
    said = re.sub(r"<[^>]+>", "", inner)
    assert H.extract(f"<body>{NAV}<article>{BODY}{inner}</article></body>") == f"{TEXT} {said}"


def test_weak_names_of_low_ratio_are_dropped():
    links = "".join(f"<a href='/{i}'>Tag {i}</a> " for i in range(5))
    for inner in (f"<p class='tags'>{links}</p>", f"<div class='share'>{links}</div>", "<div class='share-buttons'>Share it, please, with all.</div>"):
        assert H.extract(f"<body>{NAV}<article>{BODY}{inner}</article></body>") == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<b>" * 5000 + "deep words, here", "deep words, here"),
        ("<b>x " * 50000, None),
        ('<a "' * 250000, None),
        ('<a "' * 250000 + ">", None),
        ("<a " * 250000 + '">"', None),
        ("<script>" + "</script" * 60000, ""),
        ("<!x" * 300000, None),
        ("<div>" * 20000 + "<p>a" * 20000 + "</b>" * 20000, None),
        ("<p>a &#" + "9" * 5000 + "; b &#x" + "0" * 5000 + "41; c</p>", "a \ufffd b A c"),
    ],
)
def test_broken_pages_take_linear_time(page, text):
    import time

    start = time.monotonic()
    got = H.extract(page)
    assert time.monotonic() - start < 10
    assert text is None or got == text


def test_unclosed_quote_is_text():
    assert H.extract('<p>one <a "two</p>') == 'one <a "two'
    assert H.extract("<p>it's < 3, and <b title='x>y'>four</b></p>") == "it's < 3, and four"


def test_text_rules():
    page = "<article><h1>A&amp;B&nbsp;&#8212; x</h1><p>one\n\n two<b>three</b> <br>four<p>five <i>six</i>, seven. And eight, and nine.</article>"
    assert H.extract(page) == "A&B — x one twothree four five six, seven. And eight, and nine."
    assert H.extract(None) == H.extract("") == H.extract("<div></div>") == H.extract("<script>x</script>") == ""
    assert H.extract("Only plain words, without any markup.") == "Only plain words, without any markup."
    assert H.extract("<p>a < b, and b > c") == "a < b, and b > c"


def test_given_pages(spark):
    """The given pages hold their text in one article element."""
    pages = read_table(spark, "/root/testdata/sf0.01", "pages")
    got = {x.page_id: x for x in H.extract_pages(pages).collect()}
    import html

    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html or "", re.S)
        plain = re.sub(r"</?(?:p|h1|br)[^>]*>", " ", inner[1] if inner else "")
        want = re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", plain))).strip()
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_odd_rows(spark, empty):
    rows = [(None, None, None, "x"), (1, None, "", "x"), (1, "u", "<p", "x"), (2, "u", "</div></p>" * 200, "x"), (3, "u", "<div>" * 300 + "deep words, here", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = H.extract_pages(df).collect()
    assert len(out) == 5
    assert next(x for x in out if x.page_id == 3).text == "deep words, here"
    assert H.extract_pages(df.limit(0)).count() == 0
