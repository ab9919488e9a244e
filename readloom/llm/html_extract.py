"""HTML extraction by tag-path ratios.

A page is cut into text blocks, each on the tag path from the root to its innermost block element. Text
length and punctuation are summed per path and divided by the path's blocks; both ratios are smoothed
over the order of the paths and fused; the share of a path's text in links lowers the fused ratio. Paths
above a threshold select the content nodes. What is in elements whose names say advert, notice and the like
takes part only where a page has nothing else; what readers wrote never does.

The article is the innermost article or main element with more than half of the content nodes' text;
without such an element, the smallest element around all content nodes. Of its other blocks, headings and
short lines are kept as well, and those go whose path holds mostly links.

A page is read once from left to right; elements are numbers with their parents' numbers, and paths are
numbers too, so that time and memory grow with the length of the page and not with its depth.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: What ends a tag, and what hides that.
MARK = re.compile(r"[>\"']")
ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
#: Elements whose content is no text of the page.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I | re.A) for tag in "script style noscript template textarea title iframe svg math canvas object".split()}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
#: Elements that a start tag closes, if they are open inside the nearest element given.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
#: Menus, footers, sidebars and forms by their element.
SKIP = frozenset("nav footer aside form button select menu dialog label input fieldset head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
#: Whole class names and ids of what is no article; those of headers count outside articles only.
NAMED = re.compile(
    r"(?:ads?|adsense|banner|nav[^\W_]*|menu[^\W_]*|sidebar[^\W_]*|side|aside|foot(?:er)?|copyright|notice[^\W_]*|alert|overlay|widget[^\W_]*|search[^\W_]*|pagination|pager|skip[^\W_]*|toolbar"
    r"|(?:site|main|top|bottom|global|primary|secondary)-(?:foot(?:er)?|nav[^\W_]*|menu)"
    r"|(?:ads?|advert[^\W_]*|breadcrumbs?|consent|cookies?[^\W_]*|gdpr|login|modal|newsletters?|popup|promo[^\W_]*|recommend[^\W_]*|related|shar(?:e|ing)|signup|social[^\W_]*|sponsor[^\W_]*|subscri[^\W_]*)"
    r"(?:[-_]+(?:area|articles?|banner|bar|block|body|box|buttons?|container|content|form|icons?|inner|items?|links?|list|media|message|nav|notice|panel|popup|posts?|section|signup|slot|space|stories|story|text|tools?|unit|widget|wrap(?:per)?|\d+))*)",
    re.I,
)
HEADER = re.compile(r"head(?:er)?|masthead|(?:site|main|top|global)-head(?:er)?", re.I)
#: Whole class names and ids of what readers wrote; names that say whether comments are open are none.
READERS = re.compile(
    r"(?:(?:blog|guest|post|reader|user|visitor)s?[-_]+)?(?:comments?|discussions?|repl(?:y|ies)|reviews)(?:[-_]*(?!(?:open|closed|on|off|enabled|disabled|allowed)$)[^\W_]+)*"
    r"|(?:guest|reader|user|visitor)s?[-_]+review|commentlist|disqus(?:_thread)?|respond",
    re.I,
)
PUNCTUATION = re.compile(r"[,.;:!?،。，、；：！？]")
SPACE = re.compile(r"\s+")
KERNEL = np.array([1, 2, 1]) / 4
#: Share of the fused ratios' standard deviation from which a path is content.
LAMBDA = 0.6
#: Share of links in a path's text from which its blocks go, where the path is not content.
LINKS = 0.5


class Page:
    """Elements and text blocks of a page, in page order.

    Of elements: parent, tag, whether the element is no content by its kind (``out``), is named as such
    (``named``) or was written by readers (``readers``). Of blocks: element, path, text, characters in links.
    """

    def __init__(self, page: str):
        self.parent, self.tag = [-1], [""]
        self.out, self.named, self.readers = [False], [False], [False]
        self.blocks: list[tuple[int, int, str, int]] = []
        self.paths: dict[tuple[int, str], int] = {}
        self.path = [0]
        # Open elements, and their places in the stack: of all block elements, and of each tag.
        self._stack, self._blocks, self._at = [0], [0], defaultdict(list)
        self._astray: set[int] = set()
        self._held: list[str] = []
        self._linked, self._in_link, self._articles, self._mute = 0, False, 0, 0
        self._read(page)
        self._settle()

    def _read(self, page: str) -> None:
        at, last = 0, page.rfind(">")
        while (lt := page.find("<", at)) >= 0 and lt < last:
            self._text(page[at:lt])
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                at = len(page) if end < 0 else end + 3
                continue
            m = OPEN.match(page, lt)
            if not m:
                if page.startswith(("<!", "<?"), lt):
                    at = page.find(">", lt) + 1
                else:
                    self._text("<")
                    at = lt + 1
                continue
            at = m.end() + 1 if page[m.end()] == ">" else self._tag_end(page, m.end())
            tag, attrs = m[2].lower(), page[m.end() : at - 1]
            if m[1]:
                self._end(tag)
            elif tag in RAW:
                if not attrs.endswith("/"):
                    close = RAW[tag].search(page, at)
                    at = (page.find(">", close.end()) + 1 or len(page)) if close else len(page)
            else:
                self._start(tag, attrs)
        self._text(page[at:])
        self._flush()

    def _tag_end(self, page: str, at: int) -> int:
        """Behind the bracket that ends a tag. Quotes hide brackets, unless the tag would then never end.

        Places from which no end was found are remembered, so that no stretch of a page is searched again and again.
        """
        passed, i = [], at
        while i not in self._astray:
            m = MARK.search(page, i)
            if m and m[0] == ">":
                return m.end()
            close = page.find(m[0], m.end()) if m else -1
            if close < 0:
                break
            i = close + 1
            passed.append(i)
        self._astray.update(passed)
        return page.find(">", at) + 1

    def _text(self, text: str) -> None:
        if text and not self._mute:
            self._held.append(text)
            self._linked += len(text) * self._in_link

    def _flush(self) -> None:
        self._in_link = False
        if self._held:
            text = SPACE.sub(" ", html.unescape("".join(self._held))).strip()
            if text:
                self.blocks.append((self._stack[-1], self.path[self._stack[-1]], text, min(self._linked, len(text))))
            self._held.clear()
        self._linked = 0

    def _pop(self, at: int) -> None:
        """Closes all elements from a place of the stack on."""
        for n in reversed(self._stack[at:]):
            tag = self.tag[n]
            self._at[tag].pop()
            if tag in BLOCK:
                self._blocks.pop()
            self._articles -= tag in ("article", "main")
            self._mute -= tag not in BLOCK
        del self._stack[at:]

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._in_link = False
        if tag in BLOCK:
            if self._at[tag]:
                self._flush()
                self._pop(self._at[tag][-1])
        elif self._last(tag) > self._blocks[-1]:
            self._pop(self._at[tag][-1])

    def _last(self, *tags: str) -> int:
        """Place in the stack of the innermost open element of some tags, or -1."""
        return max(self._at[t][-1] if self._at[t] else -1 for t in tags)

    def _start(self, tag: str, attrs: str) -> None:
        if tag not in BLOCK:
            if tag == "br":
                self._held.append(" ")
            elif tag == "a":
                self._in_link = True
            if tag in VOID or attrs.endswith("/"):
                return
            # Inline elements are of interest where their text is none of the page's; those inside are kept track of.
            if self._mute or (self._kind(tag, attrs)[0] if attrs else tag in SKIP):
                self._push(tag, True, False, False)
            return
        self._flush()
        if self.tag[self._stack[self._blocks[-1]]] == "p":  # a block ends an open paragraph
            self._pop(self._blocks[-1])
        if tag in CLOSES:
            own, within = CLOSES[tag]
            at = self._last(*own)
            if at > self._last(*within):
                self._pop(at)
        if tag not in VOID:
            self._push(tag, *(self._kind(tag, attrs) if attrs else (tag in SKIP or tag == "header" and not self._articles, False, False)))

    def _push(self, tag: str, out: bool, named: bool, readers: bool) -> None:
        above = self._stack[-1]
        self._at[tag].append(len(self._stack))
        if tag in BLOCK:
            self._blocks.append(len(self._stack))
        self._stack.append(len(self.parent))
        self._articles += tag in ("article", "main")
        self._mute += tag not in BLOCK
        self.parent.append(above)
        self.tag.append(tag)
        self.out.append(out)
        self.named.append(named)
        self.readers.append(readers)
        key = (self.path[above], tag)
        self.path.append(self.paths.setdefault(key, len(self.paths) + 1) if tag in BLOCK else self.path[above])

    def _kind(self, tag: str, attrs: str) -> tuple[bool, bool, bool]:
        out, named, readers = tag in SKIP or tag == "header" and not self._articles, False, False
        for name, a, b, c in ATTR.findall(attrs) if attrs.strip() else ():
            name, value = name.lower(), (a or b or c).strip()
            if name in ("class", "id") and tag not in ("html", "body"):
                for v in value.split():
                    readers = readers or bool(READERS.fullmatch(v))
                    named = named or tag not in ("article", "main") and bool(NAMED.fullmatch(v) or not self._articles and HEADER.fullmatch(v))
            elif name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                out = True
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                out = True
        return out, named, readers

    def _settle(self) -> None:
        """Kinds pass down to what is inside; an element around an article is none of them."""
        around = [False] * len(self.parent)
        for n in range(len(self.parent) - 1, 0, -1):
            around[self.parent[n]] = around[self.parent[n]] or around[n] or self.tag[n] in ("article", "main") and not self.readers[n]
        for n in range(1, len(self.parent)):
            up = self.parent[n]
            self.out[n] = self.out[up] or self.out[n] and not around[n]
            self.named[n] = self.named[up] or self.named[n] and not around[n]
            self.readers[n] = self.readers[up] or self.readers[n] and not around[n]


def content_paths(blocks: list[tuple[int, str, int]]) -> tuple[set[int], set[int]]:
    """Paths whose fused ratio of text and punctuation stands out, and of the others those of links; of blocks (path, text, characters in links)."""
    facts: dict[int, list[int]] = {}
    for path, text, linked in blocks:
        f = facts.setdefault(path, [0, 0, 0, 0])
        f[0] += len(text)
        f[1] += len(PUNCTUATION.findall(text))
        f[2] += 1
        f[3] += linked
    length, marks, nodes, linked = (np.array(c, float) for c in zip(*facts.values()))
    smooth = [np.convolve(np.pad(r, 1, "edge"), KERNEL, "valid") for r in (length / nodes, marks / nodes)]
    fused = smooth[0] * (1 + smooth[1]) * (1 - linked / length)
    content = fused >= min(LAMBDA * fused.std(), fused.max())
    return {p for p, c in zip(facts, content) if c}, {p for p, c, l in zip(facts, content, linked / length) if not c and l >= LINKS}


def _around(page: Page, nodes: list[int]) -> int:
    """The smallest element that holds all of some elements."""
    held = [0] * len(page.parent)
    for n in nodes:
        held[n] += 1
    for n in range(len(page.parent) - 1, 0, -1):  # children have larger numbers than their parents
        if held[n] == len(nodes):
            return n
        held[page.parent[n]] += held[n]
    return 0


def _article(page: Page, chosen: list[tuple[int, int]]) -> int | None:
    """The innermost article or main element with more than half of the chosen blocks' text; of (element, characters)."""
    total = sum(size for _, size in chosen)
    text = [0] * len(page.parent)
    for n, size in chosen:
        text[n] += size
    for n in range(len(page.parent) - 1, 0, -1):
        if 2 * text[n] > total and page.tag[n] in ("article", "main") and not page.readers[n]:
            return n
        text[page.parent[n]] += text[n]
    return None


def _inside(page: Page, root: int) -> list[bool]:
    inside = [n == root for n in range(len(page.parent))]
    for n in range(root + 1, len(page.parent)):
        inside[n] = inside[n] or inside[page.parent[n]]
    return inside


def extract(page: str | None) -> str:
    """Main text of a page; empty for null, empty and textless pages."""
    if not page:
        return ""
    p = Page(page)
    kept = [b for b in p.blocks if not p.out[b[0]] and not p.readers[b[0]]]
    kept = [b for b in kept if not p.named[b[0]]] or kept
    if not kept:
        return ""
    paths, links = content_paths([b[1:] for b in kept])
    chosen = [b for b in kept if b[1] in paths]
    stay = [b for b in kept if b[1] not in links]
    root = _article(p, [(b[0], len(b[2])) for b in chosen])
    if root is None:
        root = _around(p, [b[0] for b in chosen])
        below = [0] * len(p.parent)  # blocks that stay, by element
        for n, *_ in stay:
            below[n] += 1
        for n in range(len(p.parent) - 1, 0, -1):
            below[p.parent[n]] += below[n]
        while root and below[root] == 1 < len(stay):  # a single block is no article where the page has more
            root = p.parent[root]
    inside = _inside(p, root)
    return "\n".join(b[2] for b in stay if inside[b[0]])


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    Takes ``page_id``, ``url`` and ``html`` of ``pages``; other columns are ignored. A null html, or one
    without text, gives an empty text. Each row is judged by itself, so repeated rows give equal
    results; null ids and urls are passed on; an empty table gives no rows. Unclosed quotes, tags and
    elements are taken as they stand; what follows the last ``>`` is text.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = [extract(h.as_py()) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
