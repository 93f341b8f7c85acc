"""Main-text extraction from web pages by line-block distribution.

One pass over the tags turns a page into lines, one per block element, each with its
text, the characters of its links and the boilerplate it stands in. A line
counts with the characters that are neither link text nor boilerplate. Sums over sliding
windows of ``WINDOW`` lines show where text surges and where it dives: a region
begins at the line where a window fills up and ends where windows run empty, and every line between the
two is kept. Regions that never reach ``SURGE`` characters are kept only if no region does.
Where a page marks its article, all lines inside it that aren't boilerplate are the text, whatever their length and links.

Cases: null and empty pages give the empty text; a page without any text outside
boilerplate gives the empty text. Text of any length is kept whole. A tag ends at the first ``>`` outside a quoted
value, or with the page. Equal rows stay equal rows; only page_id,
url and html are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 3
SURGE = 60
LINK_SHARE = 0.6

# Elements by what they do to the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template svg math head iframe object canvas audio video map".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
FURNITURE = frozenset("nav footer aside form button select option textarea input menu dialog label fieldset datalist".split())
BLOCKS = frozenset(
    "address article aside blockquote body center caption dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
# A paragraph ends where one of these begins, as it has no end tag then.
ENDS_PARAGRAPH = BLOCKS - frozenset("html body td th tr tbody thead tfoot caption option optgroup legend".split())
ARTICLE = frozenset(["article", "main"])
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())

# Words of class, id and role that mark boilerplate.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager topbar toolbar "
    "footer foot bottombar copyright sidebar aside widget related recommended recommendations popular trending "
    "share sharing social follow subscribe subscription newsletter signup login register search searchbox "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay disclaimer paywall "
    "comment comments commentlist disqus reply replies respond reaction reactions feedback contentinfo complementary hidden".split()
)
# Marks of a page's own header; inside an article they are the article's.
PAGE_NOISE = frozenset("header masthead banner".split())
# A name like "with-sidebar" says what stands next to an element, not what it is.
ABOUT_OTHERS = frozenset("has with no without".split())
# A quote opens a value only behind "="; elsewhere it is part of a name. A quote that is never closed counts as an ordinary character.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]++)"""
_ATTRIBUTE = rf"(?:=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+{_VALUE}?+)?+"
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|{_ATTRIBUTE})*+)(?:>|\Z)", re.S)
MARKS = re.compile(r"""\b(class|id|role|aria-hidden|style|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORDS = re.compile(r"[A-Za-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SPACES = re.compile(r"\s+")


@dataclass
class Line:
    """One block's text, with what of it is link text, and where it stands."""

    parts: list[str] = field(default_factory=list)
    link_parts: list[str] = field(default_factory=list)
    noise: bool = False
    article: int = 0

    def text(self) -> str:
        return SPACES.sub(" ", "".join(self.parts)).strip()

    def linked(self) -> int:
        return len(SPACES.sub(" ", "".join(self.link_parts)).strip())


def is_noise(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is boilerplate by its name, its class, id or role, or because it is hidden."""
    if tag in FURNITURE or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    in_article = in_article or tag == "article"
    for match in MARKS.finditer(attributes):
        name, value = match[1].lower(), next((v for v in match.groups()[1:] if v is not None), "")
        if name == "hidden" and not value:
            return True
        if name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id", "role"):
            for token in value.split():
                words = [w.lower() for w in WORDS.findall(CAMEL.sub(" ", token))]
                if ABOUT_OTHERS.isdisjoint(words) and any(w in NOISE or (w in PAGE_NOISE and not in_article) for w in words):
                    return True
    return False


def lines(page: str) -> list[Line]:
    """The blocks of a page in order, empty ones left out."""
    out: list[Line] = []
    stack: list[tuple[str, bool, bool]] = []  # name, noise, hidden
    noise = hidden = links = article = articles = 0
    line = Line()

    def put(text: str) -> None:
        if text and not hidden:
            # Reference by reference within one run of text: tags between two runs don't make new ones.
            text = entities.unescape(text) if "&" in text else text
            line.parts.append(text)
            if links:
                line.link_parts.append(text)

    def cut() -> None:
        nonlocal line
        if any(not p.isspace() for p in line.parts):
            out.append(line)
        line = Line(noise=noise > 0, article=article)

    def pop() -> None:
        nonlocal noise, hidden, links, article
        name, was_noise, was_hidden = stack.pop()
        if name in BLOCKS or was_noise:
            cut()
        noise -= was_noise
        hidden -= was_hidden
        links -= name == "a"
        if name in ARTICLE and not any(s[0] in ARTICLE for s in stack):
            article = 0
        if name in BLOCKS or was_noise:
            line.noise, line.article = noise > 0, article

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            put(page[at:])
            break
        put(page[at:lt])
        match = TAG.match(page, lt)
        if match is None:  # a bare sign
            put("<")
            at = lt + 1
            continue
        at = match.end()
        if match[2] is None:
            continue
        name = match[2].lower()
        if match[1]:
            if name in VOID or not any(s[0] == name for s in stack):
                if name in ("br", "p"):
                    put(" ")
                continue
            while stack[-1][0] != name:
                pop()
            pop()
            continue
        attributes = match[3] or ""
        if name not in IN_HEAD and stack and stack[-1][0] == "head":
            pop()  # its end tag may be left out
        if name in VOID:
            if name == "hr":
                cut()
            else:
                put(" " if name in ("br", "wbr", "img", "input") and name != "wbr" else "")
            continue
        if name in ENDS_PARAGRAPH and any(s[0] == "p" for s in stack):
            scope = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in ("p", "td", "th", "button", "caption")), -1)
            if scope >= 0 and stack[scope][0] == "p":
                while len(stack) > scope:
                    pop()
        elif name in ("li", "dt", "dd", "td", "th", "tr", "option") and stack and stack[-1][0] == name:
            pop()
        own_noise, own_hidden = is_noise(name, attributes, article > 0), name in HIDDEN
        if name in BLOCKS or own_noise:
            cut()
        if attributes.endswith("/") and name not in BLOCKS:
            continue
        stack.append((name, own_noise, own_hidden))
        noise += own_noise
        hidden += own_hidden
        links += name == "a"
        if name in ARTICLE and not article and not noise:
            articles += 1
            article = articles
        if name in BLOCKS or own_noise:
            line.noise, line.article = noise > 0, article
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = close.start() if close else end
            put(page[at:stop])
            at = stop
    cut()
    return out


def regions(weights: np.ndarray) -> list[tuple[int, int]]:
    """Surge and dive points: stretches of lines that windows of ``WINDOW`` lines see as filled.

    A window that starts at a line with weight opens a region; the region goes on
    as long as the window at the next line still holds text, and ends behind its last line with weight.
    """
    n = len(weights)
    padded = np.concatenate([weights, np.zeros(WINDOW, weights.dtype)])
    sums = np.convolve(padded, np.ones(WINDOW, np.int64))[WINDOW - 1 : WINDOW - 1 + n]
    out, at = [], 0
    while at < n:
        if weights[at] <= 0:
            at += 1
            continue
        dive = at
        while dive < n and sums[dive] > 0:
            dive += 1
        last = at + int(np.flatnonzero(weights[at:dive])[-1])
        out.append((at, last + 1))
        at = dive
    return out


def main_text(page: str | None) -> str:
    """The text of the blocks between surge and dive points, one block a line."""
    if not page:
        return ""
    # Boilerplate cuts the distribution: what stands on its two sides is two stretches.
    stretches: list[list[tuple[str, int]]] = [[]]
    found = lines(page)
    if any(x.article and not x.noise for x in found):
        # A marked article is the content: nothing in it but boilerplate is left out, links and short blocks neither.
        return "\n".join(text for x in found if x.article and not x.noise and (text := x.text()))
    for x in found:
        text = x.text()
        if not text:
            continue
        if x.noise:
            stretches.append([])
        else:
            linked = x.linked()
            stretches[-1].append((text, 0 if linked > LINK_SHARE * len(text) else len(text) - linked))
    kept: list[tuple[int, list[str]]] = []
    for stretch in stretches:
        weights = np.array([w for _, w in stretch], np.int64)
        for surge, dive in regions(weights):
            kept.append((int(weights[surge:dive].sum()), [t for t, _ in stretch[surge:dive]]))
    strong = [x for x in kept if x[0] >= SURGE]
    return "\n".join(t for _, block in (strong or kept) for t in block)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
