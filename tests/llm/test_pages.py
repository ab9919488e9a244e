"""Pages whose text must stay whole."""

from llm_helpers import prose

from readloom.llm import html_extract

LONG = ", ".join(prose(9, k) for k in range(40)) + "."


def lines(body):
    return html_extract.extract(f"<html><head><title>t</title></head><body>{body}</body></html>").split("\n")


def test_one_long_paragraph_is_not_the_page():
    assert lines(f"<nav>n</nav><div><h1>Title</h1><p>{LONG}</p><p>Short.</p></div>") == ["Title", LONG, "Short."]
    assert lines(f"<div><h1>Title</h1><p>{LONG}</p></div><div class='footer'>f</div>") == ["Title", LONG]
    assert lines(f"<div><h1>Title</h1><div><p>{LONG}</p></div></div>") == ["Title", LONG]
    assert html_extract.extract(f"<h1>Title</h1><p>{LONG}</p><p>Short.</p>").split("\n") == ["Title", LONG, "Short."]
    assert lines(f"<p>{LONG}</p>") == [LONG]


def test_content_blocks_beside_the_main_element_stay():
    body = "".join(f"<p>{LONG}</p>" for _ in range(12))
    assert lines(f"<div><p>{LONG}</p><h2>Between</h2><div>{body}</div></div>") == [LONG, "Between", *[LONG] * 12]


def test_class_names_are_matched_whole():
    for name in ("content has-sidebar", "no-sidebar", "page nav-open", "with-comments", "search-results"):
        assert lines(f"<div class='{name}'><h1>Title</h1><p>{LONG}</p></div>") == ["Title", LONG]
    for name in ("sidebar", "x ad banner", "site-footer", "main-nav", "comments-area", "header", "share-buttons"):
        assert lines(f"<div class='{name}'><p>gone</p></div><div><h1>Title</h1><p>{LONG}</p></div>") == ["Title", LONG]


def test_what_contains_an_article_is_not_skipped():
    body = f"<article><h1>Title</h1><p>{LONG}</p><div class='ad'>gone</div></article>"
    for around in ("div class='sidebar'", "div class='content has-sidebar'", "form", "div id='header'", "aside", "div role='search'"):
        assert lines(f"<nav>n</nav><{around}>{body}</{around.split()[0]}>") == ["Title", LONG]


def test_headers_of_articles_stay():
    for head in ("div class='entry-header'", "header class='article-header'", "div class='header'", "header id='masthead'"):
        assert lines(f"<header><p>Site</p></header><main><{head}><h1>Title</h1></{head.split()[0]}><p>{LONG}</p></main>") == ["Title", LONG]
