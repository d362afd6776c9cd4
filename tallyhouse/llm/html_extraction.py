"""Main text of web pages: text-to-tag ratios over parser events, smoothed and clustered.

The standard library's parser gives a page as a stream of events. Text between two block elements is
a line; markup inside a line does not break it. A line's ratio is its characters outside links
divided by the tags since the line before it. The ratios are smoothed with a Gaussian, and lines at or
above the ratios' standard deviation form clusters. These decide where the content is:

* the ``article`` element, or else the ``main`` element, with the most clustered text, if it has at
  least ``LEAST_SHARE`` of the page's (the outermost, if they are nested);
* else the smallest element that holds nearly all clustered text, found from the body downwards by
  going into a child as long as it has ``SHARE`` of that text.

All lines of that region are the article, short ones too, as its paragraphs need not be long. Lines
in elements that are marked as something else are never content and have ratio 0: by element (menus,
footers, sidebars, forms, scripts, styles and so on), by role, by a word of class or id (adverts,
notices, comments and so on), or hidden. A ``header`` is marked unless it belongs to an article. On the
container of the article itself and above it, words of class or id do not count: pages name their
body ``with-sidebar``, too.

Markup is read as browsers do where it matters: void elements hold nothing, a block start ends an
open paragraph, an end tag closes what is open inside it, and one without a start is ignored.

Spark deals pages to tasks; a page is read alone, in time and memory that grow with its length.

Defined results: null and empty html, and pages without content, have the empty text; text that is
not closed by the end of the page counts; html without any tag is one line; every row is a page,
repeated ids and null ids included; of equally good regions the first is taken; an empty table gives
no rows. Other columns of the input are neither read nor required.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Lines over which ratios are smoothed (the Gaussian's standard deviation).
SIGMA = 1.0
# Share of the clustered text that makes a child element the region instead of its parent.
SHARE = 0.9
# Share of the clustered text that an ``article`` or ``main`` element needs to be the region.
LEAST_SHARE = 0.3

EXTRACTED_SCHEMA = "page_id BIGINT, url STRING, text STRING, n_chars BIGINT"

# Fixed values of HTML: elements that hold nothing, and elements that break a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
# An open element of the second kind ends where one of the first starts, up to an element of the third.
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "tbody": (frozenset("thead tbody tfoot tr td th".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot tr td th".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
# An end tag does not close these from inside, nor does a block end a paragraph around them.
PARAGRAPH = frozenset(["p"])
SCOPE = frozenset("html table td th caption button object template".split())

# Elements, roles and words of class or id that are not the article.
NOT_CONTENT = frozenset(
    "head nav footer aside form menu search dialog script style noscript template iframe object svg math "
    "canvas audio video map button select datalist textarea input label".split()
)
NOT_CONTENT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar "
    "form status tooltip".split()
)
NOT_CONTENT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adbanner "
    "sponsor sponsors sponsored promo promos promotion banner cookie cookies consent gdpr notice notices "
    "notification notifications newsletter subscribe subscription signup popup modal overlay paywall "
    "sidebar sidebars widget widgets menu menus nav navbar navigation topbar toolbar breadcrumb "
    "breadcrumbs pagination pager masthead footer header related recommended trending share sharing "
    "social comment comments commentlist disqus replies respond login search "
    "alert copyright skip-link".split()
)
# A class such as ``has-sidebar`` tells of a neighbour; ``post-header`` holds an article's title.
ABOUT_OTHERS = frozenset("has with no without".split())
ARTICLE_WORDS = frozenset("article post entry content story section".split())
_WORD = re.compile(r"[a-z0-9]+(?:-[a-z0-9]+)*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def named_aside(value: str | None, in_article: bool) -> bool:
    """Whether a class or id says that an element is not the article. Names are compared whole and
    in parts: ``siteSidebar`` and ``ad-box`` count."""
    if not value:
        return False
    for name in _WORD.findall(_CAMEL.sub("-", value).lower().replace("_", "-")):
        parts = name.split("-")
        if name in NOT_CONTENT_WORDS:
            found = {name}
        elif parts[0] in ABOUT_OTHERS:
            continue
        else:
            found = NOT_CONTENT_WORDS.intersection(parts)
        if found and not (found == {"header"} and (in_article or parts[0] in ARTICLE_WORDS)):
            return True
    return False


class Element:
    """An open or closed element. ``named`` is set if only words of class or id mark it."""

    __slots__ = ("tag", "parent", "marked", "named", "link", "text")

    def __init__(self, tag: str, parent: Element | None, marked: bool = False, named: bool = False) -> None:
        self.tag, self.parent, self.marked, self.named = tag, parent, marked, named
        self.link = tag == "a" or (parent.link if parent else False)
        self.text = 0  # clustered characters inside

    def chain(self) -> Iterator[Element]:
        here: Element | None = self
        while here is not None:
            yield here
            here = here.parent


class Line:
    __slots__ = ("text", "block", "plain", "tags")

    def __init__(self, text: str, block: Element, plain: int, tags: int) -> None:
        self.text, self.block, self.plain, self.tags = text, block, plain, tags


class Lines(HTMLParser):
    """The lines of a page from parser events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [Element("", None)]
        self.depth: dict[str, int] = {}
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = 0
        self.linked = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            block = next(e for e in reversed(self.open) if e.tag in BLOCK or not e.tag or e.marked or e.named)
            self.lines.append(Line(text, block, max(0, len(text) - self.linked), self.tags))
            self.tags = 0
        self.parts.clear()
        self.linked = 0

    def _push(self, element: Element) -> None:
        self.open.append(element)
        self.depth[element.tag] = self.depth.get(element.tag, 0) + 1

    def _pop(self) -> None:
        self.depth[self.open.pop().tag] -= 1

    def _close(self, tags: frozenset[str], barrier: frozenset[str]) -> None:
        """Close the outermost open element of ``tags`` inside the nearest barrier, if any."""
        if not any(self.depth.get(tag) for tag in tags):
            return
        found = 0
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                found = at
            elif self.open[at].tag in barrier:
                break
        while found and len(self.open) > found:
            self._pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        given = dict(attrs)
        marked, named = self._marks(tag, given)
        # An inline element that is marked stands apart from the text around it.
        if tag in BLOCK or marked or named:
            self._end_line()
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in BLOCK:
            self._close(PARAGRAPH, SCOPE)
        if tag in IMPLIED_END:
            self._close(*IMPLIED_END[tag])
        self._push(Element(tag, self.open[-1], marked, named))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self._end_line()
        if tag in VOID or not self.depth.get(tag):
            return
        while self.open[-1].tag != tag:
            self._leave()
        self._leave()

    def _leave(self) -> None:
        if self.open[-1].marked or self.open[-1].named or self.open[-1].tag in BLOCK:
            self._end_line()
        self._pop()

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.open[-1].link:
            self.linked += len(" ".join(data.split()))

    def _marks(self, tag: str, given: dict[str, str | None]) -> tuple[bool, bool]:
        """Whether an element's kind, role or hiding marks it, and whether its class or id does."""
        in_article = bool(self.depth.get("article"))
        if tag in NOT_CONTENT or (tag == "header" and not in_article):
            return True, False
        if not given:
            return False, False
        roles = set((given.get("role") or "").lower().split())
        if roles & NOT_CONTENT_ROLES:
            return True, False
        if "hidden" in given or _HIDDEN.search((given.get("style") or "").lower()):
            return True, False
        named = named_aside(given.get("class"), in_article) or named_aside(given.get("id"), in_article)
        return False, named and tag not in ("html", "body")


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Convolution with a Gaussian; beyond the ends the ratios go on as zeros."""
    reach = int(3 * sigma + 0.5)
    places = np.arange(-reach, reach + 1)
    kernel = np.exp(-0.5 * (places / sigma) ** 2)
    return np.convolve(ratios, kernel / kernel.sum())[reach : reach + len(ratios)]


def clustered(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Whether a line belongs to a cluster of content: its smoothed ratio reaches the threshold."""
    smoothed = smooth(ratios, sigma)
    return (smoothed >= smoothed.std()) & (ratios > 0)


def _region(lines: list[Line], inside: np.ndarray) -> Element | None:
    """The element whose lines are the article."""
    elements: dict[Element, list[Element]] = {}
    for line, yes in zip(lines, inside):
        if yes:
            for element in line.block.chain():
                elements.setdefault(element, [])
                element.text += line.plain
    for element in elements:
        if element.parent is not None:
            elements[element.parent].append(element)
    here = next((e for e in elements if e.parent is None), None)
    for kind in ("article", "main"):
        found = [e for e in elements if e.tag == kind and not any(x.tag == kind for x in e.parent.chain())]
        best = max(found, key=lambda e: e.text, default=None)
        if best is not None and best.text >= LEAST_SHARE * here.text:
            return best
    while here is not None:
        child = max(elements[here], key=lambda e: e.text, default=None)
        if child is None or child.text < SHARE * here.text:
            return here
        # A single paragraph is not a region: its neighbours belong to the same text.
        if child.tag not in ("html", "body", "div", "section", "table", "tbody", "tr", "td", "center"):
            return here
        here = child
    return None


def main_text(html: str | None) -> str:
    """The article of a page, a line per block."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.close()
    page._end_line()
    lines = page.lines
    if not lines:
        return ""

    def dropped(line: Line, region: Element | None) -> bool:
        """Words of class or id do not count from the region's element upwards."""
        below = True
        for element in line.block.chain():
            below = below and element is not region
            if element.marked or (element.named and below):
                return True
        return False

    plain = np.array([0 if dropped(x, None) else x.plain / max(1, x.tags) for x in lines], dtype=float)
    region = _region(lines, clustered(plain))
    if region is None:
        # All text stands in elements that only a class or id marks, perhaps around an article.
        inner = [x for x in lines if any(e.tag in ("article", "main") and not e.named for e in x.block.chain())]
        plain = np.array([x.plain / max(1, x.tags) if x in inner and not any(e.marked for e in x.block.chain()) else 0 for x in lines])
        region = _region(lines, clustered(plain)) if inner else None
        if region is None:
            return ""
    held = [x for x in lines if any(e is region for e in x.block.chain()) and not dropped(x, region)]
    return "\n".join(x.text for x in held)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            texts = [main_text(html) for html in part.column("html").to_pylist()]
            yield pa.record_batch(
                [
                    part.column("page_id").cast(pa.int64()),
                    part.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its article and how many characters that has."""
    return pages.select("page_id", "url", "html").mapInArrow(_extracted, EXTRACTED_SCHEMA)
