"""Main text of HTML pages, by the ratio of text to tags.

Parser events cut a page into blocks, each in its element.  Blocks inside markup that is never
article text (menus, forms, scripts and the like) count for nothing.  The ratios of all blocks, in
page order, are smoothed with a Gaussian; a threshold splits them into content and the rest.
Elements weigh as much as the content inside them: the heaviest article or main part is the
text, or else the innermost element that holds nearly all content, with the page's headline.  It
is kept whole, so that a short paragraph between long ones stays.  Names of classes and ids only
hint at what is not text: a named element that holds the headline or most of an article stays.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.arrow import values

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
UNSEEN = frozenset("canvas datalist head iframe noscript object script select style svg template textarea title".split())
NEVER = frozenset("aside button dialog footer form menu nav".split())
REGION = frozenset("article blockquote body center div html main section table tbody td tr".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# fixed values: words that classes and ids have for what is not the text of a page
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "copyright discussion disqus feedback footer header legal login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification pager pagination popup promo promotion recommendations recommended related replies reply responses respond search share "
    "sharing sidebar signup skyscraper social sponsor sponsored subscribe talkback toolbar warning widget".split()
)
HEADERS = frozenset("banner header masthead".split())  # inside an article they hold its headline
# fixed values: words that make a name say something about an element's neighbours, or of a wrapper
WRAPPERS = frozenset(
    "active article body closed container content disabled enabled entry grid has hidden is layout main no not off on open page post story text visible "
    "with without wrap wrapper".split()
)
LISTS = frozenset("div dl ol section table ul".split())
_WORDS = re.compile("[^a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
KERNEL = np.exp(-0.5 * np.arange(-3, 4) ** 2)
KERNEL = KERNEL / KERNEL.sum()
FEED = 1 << 20


@dataclass
class _Node:
    """An open or closed element."""

    tag: str
    parent: int
    never: bool  # itself or around it: no text of the page
    named: bool  # its class or id says so
    article: bool  # itself or around it: an article


@dataclass
class _Line:
    node: int
    text: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0  # characters inside links


def named(names: str, inside: bool) -> bool:
    """Whether one of some class names or ids is that of something beside the text; ``inside`` an article."""
    for name in names.lower().split():
        words = [w for w in _WORDS.split(name) if w]
        if not words or words[0] in WRAPPERS and words[0] not in ("article", "content", "entry", "main", "page", "post", "story"):
            continue
        last = words[-1]
        found = last if last in NAMES else words[0] if words[0] in NAMES and last not in WRAPPERS else ""
        if found and not (inside and found in HEADERS):
            return True
    return False


class _Events(HTMLParser):
    """Collects the blocks of a page, and the elements that they are in, from the parser's events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [_Node("", -1, False, False, False)]
        self.lines = [_Line(0)]
        self.open = [0]
        self.links = self.unseen = 0

    def _new(self) -> None:
        if self.lines[-1].text:
            self.lines.append(_Line(self.open[-1]))
        else:
            self.lines[-1].node = self.open[-1]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            if tag == "p" and self._within("p", ()):  # a paragraph ends where the next begins
                self._close("p")
            if tag == "li" and self._within("li", ("ul", "ol")):
                self._close("li")
            self._new()
        self.lines[-1].tags += 1
        if tag in VOID:
            if tag == "br" and not self.unseen:
                self.lines[-1].text.append(" ")
            return
        self.links += tag == "a"
        self.unseen += tag in UNSEEN
        around = self.nodes[self.open[-1]]
        attrs = dict(attrs)
        inside = around.article or tag in ("article", "main")
        named_so = tag not in ("html", "body", "main") and (named(attrs.get("class") or "", inside) or named(attrs.get("id") or "", inside))
        never = around.never or self._never(tag, attrs, around.article) or named_so and tag not in BLOCK
        self.nodes.append(_Node(tag, self.open[-1], never, named_so, inside))
        self.open.append(len(self.nodes) - 1)
        if tag in BLOCK:
            self.lines[-1].node = self.open[-1]

    def _within(self, tag, bounds) -> bool:
        for i in reversed(self.open):
            if self.nodes[i].tag == tag:
                return True
            if self.nodes[i].tag in bounds:
                return False
        return False

    def _never(self, tag, attrs, article) -> bool:
        if tag in ("html", "body"):
            return False
        if tag in NEVER or (tag == "header" and not article):
            return True
        if (attrs.get("role") or "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        return bool(_HIDDEN.search(attrs.get("style") or ""))

    def handle_endtag(self, tag):
        self.lines[-1].tags += 1
        if tag not in VOID and self._within(tag, ()):
            self._close(tag)

    def _close(self, tag):
        block = False
        while len(self.open) > 1:
            t = self.nodes[self.open.pop()].tag
            block |= t in BLOCK
            self.links -= t == "a"
            self.unseen -= t in UNSEEN
            if t == tag:
                break
        if block:
            self._new()

    def handle_data(self, data):
        if self.unseen:
            return
        if self.nodes[self.lines[-1].node].never != self.nodes[self.open[-1]].never:  # an inline element that is never text
            return
        self.lines[-1].text.append(data)
        if self.links:
            self.lines[-1].linked += len(data)


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Which blocks are content: smoothed ratios over the threshold between the two clusters' means."""
    smooth = np.convolve(np.pad(ratios, 3), KERNEL, "valid")
    cut = smooth.mean()
    for _ in range(20):
        high, low = smooth[smooth > cut], smooth[smooth <= cut]
        if not len(high) or not len(low):
            break
        cut, before = (high.mean() + low.mean()) / 2, cut
        if abs(cut - before) < 1e-9:
            break
    # the means move with the longest blocks; the spread does not let them exclude ordinary ones
    return smooth >= min(cut, smooth.std()) if len(smooth) else np.zeros(0, bool)


class _Page:
    """The blocks of a page, the weights of its elements, and which of them are left out."""

    def __init__(self, events: _Events) -> None:
        self.nodes = events.nodes
        self.texts = [" ".join("".join(x.text).split()) for x in events.lines]
        self.node = [x.node for x in events.lines]
        self.linked = [min(x.linked, len(t)) for x, t in zip(events.lines, self.texts)]
        plain = np.array([0 if self.nodes[n].never else len(t) - k for n, t, k in zip(self.node, self.texts, self.linked)], float)
        content = content_lines(plain / np.array([max(1, x.tags) for x in events.lines])) & (plain > 0)
        if not content.any():
            content = (plain == plain.max()) & (plain > 0)
        heavy = np.where(content, plain, 0.0).tolist()
        self.out = self._left_out(self.sums(heavy))
        self.weight = self.sums([0.0 if self.out[n] else c for n, c in zip(self.node, heavy)])

    def sums(self, values: list[float]) -> list[float]:
        """The sum of the blocks inside each element."""
        total = [0.0] * len(self.nodes)
        for n, v in zip(self.node, values):
            total[n] += v
        for i in range(len(self.nodes) - 1, 0, -1):  # an element comes after the one around it
            total[self.nodes[i].parent] += total[i]
        return total

    def _left_out(self, weight: list[float]) -> list[bool]:
        """Elements that are no part of the text: by what they are, or by name unless they hold the page's text itself."""
        holds = [False] * len(self.nodes)  # the headline or main part, or an article with half of all content
        for i in range(len(self.nodes) - 1, 0, -1):
            n = self.nodes[i]
            heavy = n.tag == "article" and not n.named and weight[i] >= 0.5 * weight[0] > 0
            if not n.never and (holds[i] or n.tag in ("h1", "main") or heavy):
                holds[n.parent] = True
        out = [False] * len(self.nodes)
        for i, n in enumerate(self.nodes[1:], 1):
            out[i] = n.never or out[n.parent] or n.named and not holds[i]
        return out

    def inside(self, roots: set[int]) -> list[bool]:
        """Which elements are one of some, or inside one."""
        out = [i in roots for i in range(len(self.nodes))]
        for i, n in enumerate(self.nodes[1:], 1):
            out[i] = out[i] or out[n.parent]
        return out

    def chosen(self) -> list[bool]:
        """Which elements are the text."""
        articles = [i for i, n in enumerate(self.nodes) if n.tag in ("article", "main") and not self.out[i] and self.weight[i] > 0]
        if not articles:
            return self._innermost()
        around = self.inside(set(articles))
        outer = [i for i in articles if not around[self.nodes[i].parent]]
        most = max(self.weight[i] for i in outer)
        roots = {i for i in outer if self.weight[i] >= 0.5 * most}
        inner = [i for i in articles if self.nodes[i].tag == "article" and i not in roots]
        first = self.inside(set(inner))
        nested = sum(self.weight[i] for i in inner if not first[self.nodes[i].parent])
        most = max([sum(self.weight[i] for i in roots) - nested, *(self.weight[i] for i in inner)])
        # a lighter article beside or inside the text is a teaser or a comment
        aside = self.inside({i for i, n in enumerate(self.nodes) if n.tag == "article" and i not in roots and self.weight[i] < 0.5 * most})
        return [a and not b for a, b in zip(self.inside(roots), aside)]

    def _innermost(self) -> list[bool]:
        """The innermost element with nearly all content, without lists of links in it, and the headline."""
        children: dict[int, list[int]] = {}
        for i, n in enumerate(self.nodes[1:], 1):
            children.setdefault(n.parent, []).append(i)
        top = 0
        while heavy := [i for i in children.get(top, []) if self.nodes[i].tag in REGION and self.weight[i] >= 0.9 * self.weight[0] > 0]:
            top = heavy[0]
        size, linked = self.sums(list(map(len, self.texts))), self.sums(self.linked)
        links = {i for i, n in enumerate(self.nodes) if n.tag in LISTS and not self.weight[i] and linked[i] > 0.5 * size[i]}
        headline = {i for i, n in enumerate(self.nodes) if n.tag == "h1"}
        keep = self.inside({top} | (headline if len(headline) == 1 else set()))
        return [a and not b for a, b in zip(keep, self.inside(links))]


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in order, one per line, white space inside them as one space."""
    events = _Events()
    for at in range(0, len(html or ""), FEED):
        events.feed(html[at : at + FEED])
    events.close()
    page = _Page(events)
    keep = page.chosen()
    return "\n".join(t for t, n in zip(page.texts, page.node) if t and keep[n] and not page.out[n])


def extract(html: Column) -> Column:
    """The main text of each page; null has an empty one."""

    @F.arrow_udf("string")
    def of(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(h) for h in values(pages)], pa.string())

    return of(html)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    Null and empty pages have empty text.  Repeated rows come back as often as they occur,
    other columns are ignored.
    """
    rows = pages.select("page_id", "url", extract(F.col("html")).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
