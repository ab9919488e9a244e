"""Extraction by path ratios: against a plain form of the ratios, hand-written pages, and hostile ones."""

import re
import time
from html.parser import HTMLParser

import pytest
from llm_helpers import prose

from readloom.llm import html_extract

ONE, TWO, THREE = (", ".join(prose(8, 60 + 9 * k + i) for i in range(6)) + "." for k in range(3))
AD = "<div class='ad'>Buy this, now.</div>"
ART = f"<h1>Title</h1><p>{ONE}</p><p>Short.</p><p>{TWO}</p>"
WANT = ["Title", ONE, "Short.", TWO]

#: Bodies of pages and the lines that a reader would call the article.
PAGES = [
    (f"<nav><ul><li><a href='/'>Home</a></li></ul></nav>{AD}<article>{ART}</article><footer>© us, all rights.</footer>", WANT),
    (f"<div><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two</a></li></ul></div><div>{ART}</div><div class='footer'>f</div>", WANT),
    (f"<main><article>{ART}</article><article><h2>Other</h2><p>Teaser.</p></article></main>", WANT),
    (f"<article>{ART}<article class='comment'><p>{THREE}</p></article></article>", WANT),
    (f"<article>{ART}<section id='comments'><div class='comment-12 comment'><p>{THREE}</p></div></section></article>", WANT),
    (f"<article>{ART}<ol class='commentlist'><li>{THREE}</li></ol></article>", WANT),
    (f"<article>{ART}<div class='recipe-notice'><p>{THREE}</p></div></article>", [*WANT, THREE]),
    (f"<article>{ART}<p class='side-by-side'>{THREE}</p></article>", [*WANT, THREE]),
    (f"<article>{ART}{AD}<p>{THREE}</p></article>", [*WANT, THREE]),
    (f"<article><header><h1>Title</h1></header><p>{ONE}</p><p>Short.</p><p>{TWO}</p></article><header><p>Site</p></header>", WANT),
    (f"<header><p>Site</p></header><div id='x'>{ART}</div><aside><p>{THREE}</p></aside>", WANT),
    (f"<form><input name=q>Search</form><div>{ART}<form>Send <textarea>t</textarea></form></div>", WANT),
    (f"<div class='cookie-banner'><p>We use cookies, accept.</p></div><div>{ART}</div>", WANT),
    (f"<div style='display: none'><p>{THREE}</p></div><div>{ART}</div>", WANT),
    (f"<article>{ART}<ul><li>a</li><li>b &amp; c</li></ul></article>", [*WANT, "a", "b & c"]),
    (f"<article><p>{ONE} <span hidden>not <b>this</b> one</span>and\n this.</p><p>{TWO}</p></article>", [f"{ONE} and this.", TWO]),
    (f"<article><p>Of.</p></article><div class='ad'>{ONE}</div>", ["Of."]),
    (f"<table><tr><td>{ONE}<td>{TWO}</table><div class='menu'>m</div>", [ONE, TWO]),
    (f"<p>{ONE}<p>{TWO}<br>{THREE}<script>var x = '<p>no</p>';</script><!-- <p>no</p> -->", [ONE, f"{TWO} {THREE}"]),
    (f"<div><h1 title='a > b'>Title</h1><p>{ONE}</p><p>1 < 2, &lt;b&gt;</p></div>", ["Title", ONE, "1 < 2, <b>"]),
]


@pytest.mark.parametrize("body,want", PAGES, ids=range(len(PAGES)))
def test_pages_of_many_kinds(body, want):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"
    assert html_extract.extract(page).split("\n") == want


class Plain(HTMLParser):
    """Blocks of a page that closes what it opens: (path, text, characters in links), all of it content."""

    def __init__(self, page):
        super().__init__()
        self.path, self.text, self.linked, self.link, self.found = [], "", 0, False, []
        self.feed(page)

    def flush(self):
        if self.text.strip():
            self.found.append(("/".join(self.path), " ".join(self.text.split()), self.linked))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.link = True
        else:
            self.flush()
            self.path.append(tag)

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = False
        else:
            self.flush()
            self.path.pop()

    def handle_data(self, data):
        self.text += data
        self.linked += len(data) * self.link


def plain_ratios(found):
    order = list(dict.fromkeys(p for p, _, _ in found))
    of = {p: [(t, n) for q, t, n in found if q == p] for p in order}
    length = [sum(len(t) for t, _ in of[p]) / len(of[p]) for p in order]
    marks = [sum(len(re.findall("[,.;:!?]", t)) for t, _ in of[p]) / len(of[p]) for p in order]
    smooth = lambda r: [(r[max(0, i - 1)] + 2 * r[i] + r[min(len(r) - 1, i + 1)]) / 4 for i in range(len(r))]
    free = [1 - sum(n for _, n in of[p]) / sum(len(t) for t, _ in of[p]) for p in order]
    fused = [a * (1 + b) * f for a, b, f in zip(smooth(length), smooth(marks), free)]
    mean = sum(fused) / len(fused)
    spread = (sum((f - mean) ** 2 for f in fused) / len(fused)) ** 0.5
    return {p for p, f in zip(order, fused) if f >= min(0.6 * spread, max(fused))}


def test_paths_equal_their_plain_form():
    import random

    r = random.Random(6)
    for _ in range(60):
        def some(depth):
            if depth == 3 or r.random() < 0.4:
                t = prose(r.randint(1, 40), r.randint(0, 999)) + r.choice(["", ".", ", so; it!"])
                return f"<a href='x'>{t}</a>" if r.random() < 0.2 else t
            return "".join(f"<{g}>{some(depth + 1)}</{g}>" for g in r.choices(["div", "section", "blockquote", "pre"], k=r.randint(1, 4)))

        page = f"<html><body>{some(0)}</body></html>"
        found, own = Plain(page).found, html_extract.Page(page)
        assert [(t, n) for _, _, t, n in own.blocks] == [(t, n) for _, t, n in found]
        paths, links = html_extract.content_paths([b[1:] for b in own.blocks])
        assert [p in paths for _, p, _, _ in own.blocks] == [p in plain_ratios(found) for p, _, _ in found]
        heavy = {p for p in {p for p, _, _ in found} if 2 * sum(n for q, _, n in found if q == p) >= sum(len(t) for q, t, _ in found if q == p)}
        assert [p in links for _, p, _, _ in own.blocks] == [p in heavy - plain_ratios(found) for p, _, _ in found]


HOSTILE = {
    "quotes": "<a href=\"" * 115_000, "single quotes and an end": "<b title='" * 100_000 + ">", "open tags": '<div a="b" ' * 95_000, "nesting": "<div>x" * 170_000, "paragraphs": "<p>x" * 250_000, "comments": "<!--" * 250_000, "scripts": "<script>" * 125_000,
    "ends": "<i>" * 100_000 + "</b>" * 170_000, "hidden": "<span hidden>" * 40_000 + "</b></i>" * 60_000, "angles": "<" * 1_000_000, "items": "<ul><li>" + "<div>" * 90_000 + "<li>x" * 90_000, "ampersands": "&" * 1_000_000, "blocks in hidden inline": "<span hidden>" + "<b>" * 100_000 + "<div></div>" * 60_000, "items in a deep list": "<li><ul>" + "<div>" * 80_000 + "<li></li>" * 60_000,
    "quotes that never close": "<b a=\"'>" * 60_000 + "<b a=\"'\"'>" * 40_000, "tags in quotes": "<b '>" * 100_001 + '"' + "<i '\">" * 60_001, "classes": f"<div class='{'ad ' * 300_000}'>x</div>",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_a_megabyte_of_anything_is_read_in_time(name):
    began = time.process_time()
    html_extract.extract(HOSTILE[name] + "<p>end")
    assert time.process_time() - began < 4


NOT_THE_ARTICLE = "advertisement ad-slot promo sponsored-content cookie-notice newsletter-signup related-articles share-tools social".split()
READERS = "user-comment comment-item comment__body reply-list discussion reviews comments-section user-review".split()


@pytest.mark.parametrize("name", NOT_THE_ARTICLE + READERS)
def test_long_blocks_with_a_name_go(name):
    for page in (f"<article>{ART}<div class='{name}'><p>{THREE * 5}</p></div><p>End.</p></article>", f"<div>{ART}<p class='x {name}'>{THREE * 5}</p><p>End.</p></div>"):
        assert html_extract.extract(page).split("\n") == [*WANT, "End."]


def test_a_page_of_named_blocks_alone_is_not_empty():
    assert html_extract.extract(f"<div class='promo'>{ART}</div>").split("\n") == WANT


def test_articles_open_to_comments_stay():
    assert html_extract.extract(f"<article class='post comments-open review'>{ART}</article>").split("\n") == WANT


def test_letters_that_grow_in_lower_case_shift_nothing():
    for tag in ("script", "STYLE"):
        page = f"<p>{'İstanbul ' * 40}</p><{tag}>var x = '<p>no</p>';</{tag.swapcase()} ><p>{ONE}</p><p>{TWO}</p>"
        assert html_extract.extract(page).split("\n") == [("İstanbul " * 40).strip(), ONE, TWO]


def test_quotes_hide_brackets_at_any_length():
    for n in (10, 100_000):
        assert html_extract.extract(f"<div>{ART}<p title='{'x' * n} > no'>{THREE}</p></div>").split("\n") == [*WANT, THREE]


def test_paths_of_links_go():
    menu = "<a href='/1'>Link one</a> <a href='/2'>Link two</a>"
    assert html_extract.extract(f"<html><body>{menu}<p>{ONE}</p><p>{TWO}</p></body></html>").split("\n") == [ONE, TWO]
    assert html_extract.extract(f"<article>{ART}<ul><li><a href='/1'>One</a></li><li><a href='/2'>Two</a></li></ul></article>").split("\n") == WANT
    assert html_extract.extract(f"<article>{ART}<p><a href='/1'>A linked line.</a></p></article>").split("\n") == [*WANT, "A linked line."]
