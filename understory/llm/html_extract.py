"""HTML extraction: main text from the parser's event stream by text-to-tag ratio.

The standard library's parser streams a page's events; block elements cut it into lines, each with its characters, its
tags and the characters that stand in links. What can never be main text is left out there (by tag, role, hidden style
or a whole class or id name). The text-to-tag ratios of the other lines are smoothed with a Gaussian and split into two
clusters by an iterated threshold. The lines of the upper cluster select the content region:

* Where they lie in article or main elements, the region is those outermost elements of the page that hold text of
  their own (an article of links alone is a teaser); all their lines are given, so no short paragraph or heading is lost.
* On other pages the region is the lines of the upper cluster, the lines beside them in the smallest element that holds
  them all, and the lines next to these without a break. A line of the lower cluster whose text is mostly links (a menu
  without a telling name) is no part of it and breaks it.

Defined results: a null, empty or text-free page gives the empty text; unclosed and crossed tags are tolerated; pages
are parsed whole, however long; lines of equal ratio fall on the same side of the threshold; repeated rows repeat; an
empty table gives an empty table; only ``id_col``, ``url_col`` and ``html_col`` are read.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts, table

#: Fixed sets of HTML: elements without an end tag, elements that break a line, elements that never hold main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
DROP = frozenset("script style noscript template iframe object embed svg canvas audio video head title nav footer aside form button select textarea menu dialog input".split())
SCOPE = frozenset("article main section div body html nav footer aside form header table ul ol dl blockquote figure".split())
#: A class or id names boilerplate if it is such a name as a whole, alone or with words of place and form around it
#: (main-nav, comment-list, footer__links). Any further word makes it another name: has-sidebar, cookie-recipes.
_NAME = r"ads?|adverts?|advertisements?|adsense|sponsored|sponsors?|promos?|promotions?|banners?|(?:top|side|sub|bottom|foot|head|site|main)?nav(?:bar|list|menu|links?)?|navigation|menus?|sidebars?|side[_-]?bar|footer|breadcrumbs?|comments?|disqus|replies|reply|respond|cookies?|cookie(?:bar|banner|consent|notice)|consent|gdpr|notices?|alerts?|popups?|modals?|overlay|newsletter|subscribe|subscription|signup|sign-?in|login|share|sharing|social|related|recommended|widgets?|toolbar|pagination|pager|skip-?link|contentinfo|complementary"
_HEADER = r"masthead|header|topbar"
_PLACE = r"(?:site|page|main|global|primary|secondary|top|bottom|left|right|upper|lower|inner|outer|mobile|desktop|sticky|fixed|list|lists|items?|links?|buttons?|icons?|area|box|block|container|wrapper|wrap|inner|bar|row|unit|slot|section|form|title|heading|text|message|thread|posts?|entry|articles?|stories|media|thumb|\d+)"
_NAMES = re.compile(rf"(?:{_PLACE}[_-]+)*(?:{_NAME})(?:[_-]+(?:{_NAME}|{_PLACE}))*", re.I)
_HEADERS = re.compile(rf"(?:(?:site|page|main|global|top)[_-]+)*(?:{_HEADER})(?:[_-]+(?:inner|outer|container|wrapper|wrap|bar|row|top|bottom))*", re.I)
#: Marks a tag among the events.
TAG = object()


class Link(str):
    """Text in a link."""


_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def named(value: str, names: re.Pattern) -> bool:
    return any(names.fullmatch(v) for v in value.split())


class Lines(HTMLParser):
    """Events outside dropped elements, in page order. Whether an element that only a class or id names is dropped is
    known at the page's end: not if it holds article, main or most of the page's text (beside an article or main
    with text, most doesn't count: that text is the page's). ``lines`` then gives
    (text, tags seen, element around it, characters in links) for each line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []  # tag, element number, dropped
        self.elements: list[tuple[str, int]] = []  # tag, parent's number
        self.named: set[int] = set()  # elements with a boilerplate class or id
        self.events: list[tuple[object, int]] = []  # text, TAG or None for a line's end; element

    def event(self, kind, always: bool = False) -> None:
        self.events.append((kind, -1 if always or not self.stack else self.stack[-1][1]))

    def dropped(self) -> bool:
        return bool(self.stack) and self.stack[-1][2]

    def lines(self) -> list[tuple[str, int, int, int]]:
        out = self.left_out()
        lines: list[tuple[str, int, int, int]] = []
        parts: list[str] = []
        tags = links = 0
        for kind, e in self.events:
            if e in out:
                continue
            if kind is TAG:
                tags += 1
            elif kind is not None:
                parts.append(kind)
                if type(kind) is Link:
                    links += sum(map(len, kind.split()))
            else:
                text = " ".join("".join(parts).split())
                if text:
                    lines.append((text, tags, e, links))
                    tags = links = 0
                parts.clear()
        return lines

    def left_out(self) -> set[int]:
        """Numbers of the elements in one that its name drops. A parent's number is smaller than its children's."""
        if not self.named:
            return set()
        n = len(self.elements)
        size, holds = [0] * n, [t in ("article", "main") for t, _ in self.elements]
        for kind, e in self.events:
            if e >= 0 and kind is not None and kind is not TAG:
                size[e] += len("".join(kind.split()))
        total = sum(size) + sum(len("".join(k.split())) for k, e in self.events if e < 0 and k is not None and k is not TAG)
        within = [t in ("article", "main") for t, _ in self.elements]  # article or main, or in one
        for e in range(n):
            within[e] |= self.elements[e][1] >= 0 and within[self.elements[e][1]]
        anywhere = not any(size[e] for e in range(n) if within[e])  # no article or main with text: it may be in any element
        for e in range(n - 1, -1, -1):
            if (up := self.elements[e][1]) >= 0:
                size[up] += size[e]
                holds[up] |= holds[e]
        out: set[int] = set()
        for e in range(n):
            if self.elements[e][1] in out or e in self.named and not holds[e] and not ((anywhere or within[e]) and 2 * size[e] > total):
                out.add(e)
        return out

    def boilerplate(self, tag: str, attrs: list) -> bool:
        """Dropped whatever it holds: by tag, role or because it is hidden. A class or id only marks the element."""
        if tag in DROP:
            return True
        inside = any(t in ("article", "main") for t, _, _ in self.stack)
        if tag == "header" and not inside:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        for k, v in attrs:
            if k == "hidden" or k == "aria-hidden" and v == "true":
                return True
            if v and (k == "role" and named(v, _NAMES) or k == "style" and _HIDDEN.search(v)):
                return True
        if any(v and k in ("class", "id") and (named(v, _NAMES) or not inside and named(v, _HEADERS)) for k, v in attrs):
            self.named.add(len(self.elements) - 1)
        return False

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            if not self.dropped():
                self.event(None)
            if tag != "hr" and any(t == "p" for t, _, _ in self.stack[-12:]):
                self.close("p")
        elif tag == "br":
            self.event(" ", always=True)
        if not self.dropped():
            self.event(TAG)
        if tag in VOID:
            return
        self.elements.append((tag, self.stack[-1][1] if self.stack else -1))
        self.stack.append((tag, len(self.elements) - 1, self.dropped() or self.boilerplate(tag, attrs)))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def close(self, tag=None):
        if tag is None:
            super().close()
            if not self.dropped():
                self.event(None)
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return
            if tag not in SCOPE and self.stack[i][0] in SCOPE:  # an end tag doesn't reach out of its section
                return

    def handle_endtag(self, tag):
        if not self.dropped():
            self.event(TAG)
            if tag in BLOCK:
                self.event(None)
        if tag not in VOID:
            self.close(tag)

    def handle_data(self, data):
        if not self.dropped():
            self.event(Link(data) if any(t == "a" for t, _, _ in self.stack[-4:]) else data)


def smooth(xs: list[float], sigma: float = 1.0) -> list[float]:
    """Gaussian smoothing with a window of two sigma either way, normalised at the borders."""
    r = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-r, r + 1)]
    out = []
    for i in range(len(xs)):
        lo, hi = max(0, i - r), min(len(xs), i + r + 1)
        w = kernel[lo - i + r : hi - i + r]
        out.append(sum(a * b for a, b in zip(w, xs[lo:hi])) / sum(w))
    return out


def threshold(xs: list[float]) -> float:
    """The border between two clusters: halfway between the means on its two sides, repeated until it stands."""
    t = sum(xs) / len(xs)
    for _ in range(50):
        low, high = [x for x in xs if x < t], [x for x in xs if x >= t]
        if not low or not high:
            break
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - t) < 1e-9:
            break
        t = new
    return t


def content(lines: list[tuple[str, int, int, int]], elements: list[tuple[str, int]], marked: set[int], dull: list[bool]) -> list[int]:
    """The lines of the region that the marked lines select. dull: those of links alone, which are no part of it."""

    def around(e: int) -> list[int]:
        out = []
        while e >= 0:
            out.append(e)
            e = elements[e][1]
        return out

    chains = [around(e) for _, _, e, _ in lines]
    for kind in ("article", "main"):
        outer = [next((e for e in reversed(c) if elements[e][0] == kind), -1) for c in chains]
        if any(outer[i] >= 0 for i in marked):
            roots = {e for i, e in enumerate(outer) if e >= 0 and not dull[i]}
            return [i for i, e in enumerate(outer) if e in roots]
    common = set.intersection(*(set(chains[i]) for i in marked))
    inner = next((e for e in chains[min(marked)] if e in common), -1)  # the smallest element around all marked lines
    keep = [i in marked or not dull[i] and (inner < 0 or inner in c) for i, c in enumerate(chains)]
    for order in (range(1, len(lines)), range(len(lines) - 2, -1, -1)):
        step = order.step
        for i in order:
            keep[i] |= keep[i - step] and not dull[i]
    return [i for i, k in enumerate(keep) if k]


def extract(html: str | None, sigma: float = 1.0, cluster: bool = True) -> str:
    """The main text. Without ``cluster`` every line counts as one of the upper cluster (for tests: what the method adds)."""
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    lines = parser.lines()
    if not lines:
        return ""
    raw = [len(t) / max(1, n) for t, n, _, _ in lines]
    ratios = smooth(raw, sigma)
    border = threshold(ratios)
    # smoothing lifts the links beside a paragraph: their own ratio tells them
    dull = [cluster and x < border and 2 * links > sum(map(len, t.split())) for x, (t, _, _, links) in zip(raw, lines)]
    marked = {i for i, x in enumerate(ratios) if (x >= border or not cluster) and not dull[i]}
    marked = marked or {i for i, d in enumerate(dull) if not d}  # the largest ratio is never under the border
    return "\n".join(lines[i][0] for i in content(lines, parser.elements, marked, dull))


def extract_main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sigma: float = 1.0) -> DataFrame:
    """One row for each page: its id and url, ``text`` and ``n_chars``. Narrow."""
    kinds = dict(df.dtypes)

    def run(batches):
        for b in batches:
            texts = [extract(h, sigma) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["id", "url", "text", "n_chars"])

    return map_texts(df.select(id_col, url_col, html_col), run, f"id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars bigint").withColumnsRenamed({"id": id_col, "url": url_col})


def op1_html_extraction(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"))
