"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's streaming parser turns a page into lines, one per block of text. A line's
text-to-tag ratio is its characters over the tags that opened since the line before, links weighing
more. The ratios are smoothed with a Gaussian window and split into two clusters by a threshold found
by iterated means; lines of the upper cluster that are not mostly
links vote for the containers they stand in. The
content is the innermost container that holds all of the upper cluster's text, and every article beside it; all its
lines belong to it, short ones too, except those inside parts that are no article: menus, headers, footers, sidebars,
notices, adverts, forms and comments, known by tag, role, id or class. A form, or a part known by id or class only,
counts as content where the measured text says so (``_overruled``). Time is linear in the page, however deep it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and words by which pages name their parts.
SILENT = frozenset(
    "script style noscript template iframe object embed svg math canvas audio video select option textarea button "
    "datalist head title".split()
)
APART = frozenset("nav footer aside menu dialog fieldset".split())
HEAD = frozenset("head title base basefont bgsound link meta style script noscript noframes template".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a new block start closes, as the HTML rules for omitted end tags say.
CLOSED_BY_BLOCK = "p"
CLOSED_BY_SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
NOT_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
NOT_CONTENT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar "
    "comment comments commentlist disqus reply replies respond share sharing social related recommended newsletter "
    "subscribe subscription signup login popup modal overlay widget toolbar pagination pager skip".split()
)
CONTENT_TAGS = frozenset({"article", "main"})
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())

_NAME_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


#: Words that may also name a wrapper around the article, or its own head.
LAYOUT_WORDS = frozenset("sidebar side rail header masthead menu nav navbar navigation widget overlay modal".split())

SOFT, LOOSE, FIRM, HARD = 1, 2, 3, 4
#: Characters of a line that is running text for sure.
RUNNING = 80


def _apart(tag: str, attrs: list[tuple[str, str | None]], inside_article: bool) -> int:
    """Whether an element is a part of the page that is no article: 0, SOFT (an article in it counts again), LOOSE
    (a class or id has a listed word in a name of other words too), FIRM (a whole name is listed) or HARD (tag, role, hidden)."""
    if tag in APART or (tag == "header" and not inside_article):
        return HARD
    if tag in ("html", "body"):
        return 0
    found = LOOSE if tag == "form" else 0  # some pages are one form
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return HARD
        if not value:
            continue
        if name == "role" and value.strip().lower() in NOT_CONTENT_ROLES:
            return HARD
        if name in ("class", "id"):
            for token in value.split():
                parts = set(_NAME_PARTS.findall(_CAMEL.sub(" ", token).lower()))
                words = parts & NOT_CONTENT_WORDS
                if tag in CONTENT_TAGS or inside_article:
                    words -= {"header", "masthead"}
                if tag in CONTENT_TAGS:
                    words -= LAYOUT_WORDS
                if words:
                    found = max(found, SOFT if words <= LAYOUT_WORDS else FIRM if parts <= NOT_CONTENT_WORDS else LOOSE)
    return found


def _comments(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether an id or class says that an element holds reader comments and nothing else."""
    for name, value in attrs:
        if name in ("class", "id") and value:
            for token in value.split():
                parts = set(_NAME_PARTS.findall(_CAMEL.sub(" ", token).lower()))
                if parts & COMMENT_WORDS and parts <= NOT_CONTENT_WORDS:
                    return True
    return False


@dataclass
class Line:
    text: str
    tags: int
    container: int
    apart: bool
    heading: bool
    named: int = 0  # the chain of parts around it that are no article by id or class
    linked: int = 0  # characters inside links
    article: bool = False


@dataclass(slots=True)
class _Open:
    tag: str
    container: int
    silent: bool
    apart: bool
    article: bool
    named: int  # the chain of all parts around it,
    firm: int  # and of those that an article within does not undo
    comments: bool
    block: int  # where the innermost block around it is open


@dataclass
class PageLines(HTMLParser):
    """Collects the lines of a page while it is parsed."""

    lines: list[Line] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [-1])

    def __post_init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack = [_Open("", 0, False, False, False, 0, 0, False, 0)]
        self.places: dict[str, list[int]] = {}  # where elements of each name are open
        self.kinds: list[int] = []  # SOFT, LOOSE or FIRM of each part known by id or class
        self.talk: set[int] = set()  # parts named after comments
        self.chains: list[tuple[int, int]] = [(-1, -1)]  # (part, chain around it); the first is of no parts
        self.content: set[int] = set()  # containers that are an article
        self.pieces: list[str] = []
        self.tags = self.linked = 0

    def updatepos(self, i: int, j: int) -> int:
        """Line and column of a tag are not asked for; counting lines would read every page once more."""
        return j

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            self.pieces = []
            if text:
                top = self.stack[-1]
                heading = bool(self.places.get("h1"))
                self.lines.append(Line(text, self.tags, top.container, top.apart, heading, top.named, self.linked, top.article))
                self.tags = 0
            self.linked = 0

    def _close(self, at: int) -> None:
        if self.stack[-1].block >= at:
            self._flush()
        for e in self.stack[at:]:
            self.places[e.tag].pop()
        del self.stack[at:]

    def _end_head(self) -> None:
        self._close(self.places["head"][-1])

    def _chain(self, part: int, around: int) -> int:
        self.chains.append((part, around))
        return len(self.chains) - 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 2 if tag == "a" else 1
        if self.places.get("head") and (tag == "body" or (tag not in HEAD and self.stack[-1].tag == "head")):
            self._end_head()
        if tag in BLOCKS:
            self._flush()
            self._implied_ends(tag)
        if tag in VOID:
            return
        top = self.stack[-1]
        container, named, firm = top.container, top.named, top.firm
        kind = _apart(tag, attrs, top.article)
        comments = top.comments or (kind == FIRM and _comments(attrs))
        is_content = tag in CONTENT_TAGS and not comments
        if tag in BLOCKS:
            self.parents.append(container)
            container = len(self.parents) - 1
            if is_content:
                self.content.add(container)
        if tag in CONTENT_TAGS:
            named = firm
        if 0 < kind < HARD:
            part = len(self.kinds)
            self.kinds.append(kind)
            if any(name in ("class", "id") and value and COMMENT_WORDS & set(_NAME_PARTS.findall(value.lower())) for name, value in attrs):
                self.talk.add(part)
            if named == firm and kind != SOFT:
                named = firm = self._chain(part, named)
            else:
                named = self._chain(part, named)
                firm = self._chain(part, firm) if kind != SOFT else firm
        silent, article = top.silent or tag in SILENT, (top.article or is_content) and not comments
        block = len(self.stack) if tag in BLOCKS else top.block
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(_Open(tag, container, silent, top.apart or kind == HARD, article, named, firm, comments, block))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _implied_ends(self, tag: str) -> None:
        """A block ends an open paragraph, even through inline elements left open; an item ends its sibling."""
        at = self.stack[-1].block
        name = self.stack[at].tag
        if (name == CLOSED_BY_BLOCK and tag != "br") or name in CLOSED_BY_SAME.get(tag, ()):
            self._close(at)

    def handle_endtag(self, tag: str) -> None:
        places = self.places.get(tag)
        # an inline end tag does not reach out of its block, unless it ends what is not shown
        if places and (tag in BLOCKS or tag in SILENT or places[-1] > self.stack[-1].block):
            self._close(places[-1])

    def handle_data(self, data: str) -> None:
        if self.stack[-1].tag == "head" and not data.isspace():
            self._end_head()
        if not self.stack[-1].silent:
            self.pieces.append(data)
            if self.places.get("a"):
                self.linked += len(data.strip())

    def finish(self) -> list[Line]:
        self.close()
        self._flush()
        return self.lines


def smoothed_ratios(lines: list[Line], sigma: float = 1.5) -> np.ndarray:
    """Characters per tag of each line, smoothed with a Gaussian window."""
    raw = np.array([len(x.text) / (1 + x.tags) for x in lines])
    reach = int(3 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(raw)), kernel)[reach : reach + len(raw)]
    return np.convolve(raw, kernel)[reach : reach + len(raw)] / weight


def cluster_threshold(values: np.ndarray) -> float:
    """Where two clusters part: the middle of the two means, iterated until it stays."""
    cut = float(values.mean())
    for _ in range(50):
        low, high = values[values <= cut], values[values > cut]
        if not len(low) or not len(high):
            return cut if len(high) else float(values.min()) - 1
        new = float((low.mean() + high.mean()) / 2)
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def _within(chains: list[tuple[int, int]], lifted: set[int]) -> list[bool]:
    """Whether all parts of each chain are lifted."""
    out = [True]
    for part, around in chains[1:]:
        out.append(out[around] and part in lifted)
    return out


def _held(chains: list[tuple[int, int]], n_parts: int, lines: list[Line]) -> list[int]:
    """Characters of lines that each part holds."""
    of_chain, out = [0] * len(chains), [0] * n_parts
    for x in lines:
        of_chain[x.named] += len(x.text)
    for c in range(len(chains) - 1, 0, -1):  # chains come after those around them
        part, around = chains[c]
        out[part] += of_chain[c]
        of_chain[around] += of_chain[c]
    return out


def _overruled(lines: list[Line], rich: np.ndarray, page: PageLines) -> set[int]:
    """Forms and parts known by id or class that are content nevertheless: no article lies outside such parts, and the
    part holds most of the articles' rich text; or the page has no article, and the part, whose name has other words
    too, holds most of the rich text. A part with a name of listed words only is content if nothing else is and it has
    running text. Parts named after comments are none where running text stands outside of all parts."""
    possible = [x for x, r in zip(lines, rich, strict=True) if r and not x.apart] or [x for x in lines if not x.apart]
    articles = [x for x in possible if x.article]
    if any(not x.named for x in articles):
        return set()
    counted = articles or possible
    total = sum(len(x.text) for x in counted)
    held = _held(page.chains, len(page.kinds), counted)
    out = {n for n, size in enumerate(held) if 2 * size > total and (articles or page.kinds[n] != FIRM)}
    if any(not x.apart and not x.named and len(x.text) >= RUNNING and 2 * x.linked < len(x.text) for x in lines):
        out -= page.talk
    within = _within(page.chains, out)
    if any(not x.apart and within[x.named] for x in lines):
        return out
    running = _held(page.chains, len(page.kinds), [x for x in possible if len(x.text) >= RUNNING])
    return out | {n for n, size in enumerate(running) if size and 2 * held[n] > total}


def main_text(html: str | None) -> str:
    """Text of the content region, one block per line of the result; empty for pages without any."""
    page = PageLines()
    page.feed(html or "")
    lines = page.finish()
    if not lines:
        return ""
    ratio = smoothed_ratios(lines)
    rich = ratio > cluster_threshold(ratio)
    if page.kinds:
        within = _within(page.chains, _overruled(lines, rich, page))
        for x in lines:
            x.apart = x.apart or not within[x.named]
    able = [x for x in lines if not x.apart]
    if not able:
        return ""
    size = len(page.parents)
    votes = [0] * size
    for x, r in zip(lines, rich, strict=True):
        if r and not x.apart and 2 * x.linked < len(x.text):
            votes[x.container] += len(x.text)
    if not any(votes):
        for x in able:
            votes[x.container] += len(x.text)
    # One upward pass: votes, lines that are not mostly links, and where a container's inner ones end, which are
    # numbered right after it. Children come after their parents.
    plain, end = [0] * size, list(range(1, size + 1))
    for x in able:
        plain[x.container] += 2 * x.linked < len(x.text)
    children: dict[int, list[int]] = {}
    for c in range(size - 1, 0, -1):
        parent = page.parents[c]
        votes[parent] += votes[c]
        plain[parent] += plain[c]
        end[parent] = max(end[parent], end[c])
        children.setdefault(parent, []).append(c)
    if any(votes[c] == votes[0] for c in page.content):
        # an article holds all votes: its lines, and those of every other article, from the outermost ones on
        inside, until = [False] * size, 0
        for c in sorted(page.content):
            if c >= until and (votes[c] == votes[0] or plain[c]):
                until = end[c]
                inside[c:until] = [True] * (until - c)
        return "\n".join(x.text for x in able if inside[x.container])
    # Innermost container with all the votes: descend while one child holds them, only past lines that are mostly links.
    at = 0
    while at in children:
        best = max(reversed(children[at]), key=lambda c: votes[c])
        if best not in children or votes[best] < votes[at] or plain[best] < plain[at]:
            break
        at = best
    return "\n".join(x.text for x in able if at <= x.container < end[at])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``, over whole pages.

    NULL or empty html gives an empty text; n_chars counts code points. Repeated rows give repeated
    results; other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h) for h in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url"), "html").mapInPandas(run, f"page_id {kind}, url string, text string, n_chars bigint")
