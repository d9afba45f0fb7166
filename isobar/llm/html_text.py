"""Main text of web pages by smoothed text-to-tag ratios.

Events of the standard library's streaming parser become lines, one per block of the
page, each with its text, its number of tags and the characters within links. A
line's text-to-tag ratio is smoothed by a Gaussian over its neighbours, so that a
short paragraph among long ones ranks with them and a long menu entry among short
ones does not. Lines at or above the threshold (a share of the page's standard
deviation, as the ratios of boilerplate crowd near zero) form clusters; ratios count up
to a bound, so that no paragraph, however long, makes its neighbours look like
boilerplate. Container elements whose own text lies mostly in clusters are the content
regions. All that is below a region is given, nested containers of any kind and size
included, in page order; only below a body as such, which holds the whole page,
containers made up of links are left out.

Elements that are no content by their kind or role (scripts, styles, navigation,
asides, forms, page headers and footers, hidden ones) or by the usual class and id
words (menus, adverts, notices, reader comments, ...) make no lines. Within an article or
main element such words are often those of its subject, so there only names that say
nothing else count (adverts, sharing, newsletters, comment lists, page menus). Where a page
marks article or main elements, the outermost of them are what regions are chosen from.

Defined results: a null or empty page, or one without content, gives an empty text;
markup that is broken or cut off is read as far as it goes; repeated pages are
treated alike; an empty table gives an empty result. Columns besides the ones named
are not read.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.base import arrow_map

SIGMA = 1.5
RADIUS = 4
THRESHOLD = 0.5
# Characters a tag beyond which a line is no more content than another; keeps the threshold at 25 at most.
RATIO = 100

# Elements of HTML by their role on a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
SKIPPED = frozenset(
    "script style noscript template head title nav aside footer form button select option textarea input label iframe "
    "object svg canvas audio video dialog menu".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
REGIONS = frozenset("article main".split())
CONTAINERS = frozenset("article main section div body table td html blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements a new one of the same kind ends: their end tags may be left out.
SELF_CLOSING = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
COMMENT_WORDS = frozenset("comment comments commentlist respond reply replies disqus".split())
BOILERPLATE_WORDS = COMMENT_WORDS | frozenset(
    "ad ads adbox advert adverts advertisement advertising alert banner breadcrumb breadcrumbs consent cookie cookies "
    "copyright disclaimer footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promoted promotion related recommended search share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
# Within a region a name counts if it has one of the first words, and besides them only of the second.
SURE_WORDS = COMMENT_WORDS | frozenset(
    "ad ads adbox advert adverts advertisement advertising breadcrumb breadcrumbs navbar newsletter pager pagination "
    "share sharing sidebar sponsored".split()
)
FILLERS = frozenset(
    "area article bar block body bottom box button buttons container content div dfp entry footer form google gpt header "
    "icons inline inner item left links list main meta page post reader right section side signup site slot social thread "
    "title tools top unit user widget wrap wrapper".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())

# Roles that parts of an article have too.
INNER_ROLES = frozenset("alert banner form".split())

_NAME = re.compile(r"[A-Za-z][a-z]+|[A-Z]+(?![a-z])|[a-z]+")


def _words(names: str) -> set[str]:
    return {w.lower() for w in _NAME.findall(names)}


def _sure(names: list[str], of: frozenset[str]) -> bool:
    """Whether one of the names says one of the words and nothing else."""
    return any((words := _words(x)) & of and words <= of | FILLERS for x in names)


class _Element:
    __slots__ = ("tag", "skip", "region", "container")

    def __init__(self, tag, skip, region, container):
        self.tag, self.skip, self.region, self.container = tag, skip, region, container


class Lines(HTMLParser):
    """The lines of a page: (text, tags, characters in links, container number, number of the outermost region or 0).

    `boxes` has the tag of each container and the number of the one around it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Element("", False, 0, 0)]
        self.lines: list[tuple[str, int, int, int, int]] = []
        self.boxes: list[tuple[str, int]] = [("", 0)]
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        top = self.stack[-1]
        if text:
            self.lines.append((text, self.tags, self.linked, top.container, top.region))
            self.tags = self.linked = 0
        self.parts = []

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "a":
            self.links += 1
        if tag == "br":
            self.parts.append(" ")
        if tag not in BLOCKS and tag not in SKIPPED or tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag in BLOCKS:
            self.flush()
            self.links = 0
        if tag in SELF_CLOSING or tag == "body":
            self._end_open(tag)
        top = self.stack[-1]
        given = dict(attrs)
        names = (given.get("class") or "").split()
        if not (top.region and tag in HEADINGS):
            # The identifier of an article's heading is made from its text.
            names += (given.get("id") or "").split()
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in (given.get("style") or "").replace(" ", "")
        if tag in REGIONS:
            comments = _sure(names, COMMENT_WORDS)
            skip = hidden or comments
            if not skip and top.skip and not any(e.skip == "comments" for e in self.stack):
                # A region within a menu or advert: the end tag of that one is missing.
                while len(self.stack) > 1 and self.stack[-1].skip:
                    self.stack.pop()
                top = self.stack[-1]
        elif top.region:
            comments = _sure(names, COMMENT_WORDS)
            skip = hidden or tag in SKIPPED or given.get("role") in ROLES - INNER_ROLES or _sure(names, SURE_WORDS)
        else:
            words = _words(" ".join(names))
            comments = bool(words & COMMENT_WORDS)
            skip = (
                hidden or tag in SKIPPED or given.get("role") in ROLES
                or tag not in ("body", "html") and bool(words & BOILERPLATE_WORDS)
                or tag == "header"
            )
        kind = "comments" if skip and comments else skip
        number = top.container
        if tag in CONTAINERS:
            number = len(self.boxes)
            self.boxes.append((tag, top.container))
        region = top.region or (number if tag in REGIONS and not skip else 0)
        self.stack.append(_Element(tag, top.skip or kind, region, number))

    def _end_open(self, tag: str) -> None:
        """A second p, li, ... ends the first, unless a container stands between."""
        for i in range(len(self.stack) - 1, 0, -1):
            open_ = self.stack[i].tag
            if open_ == tag:
                del self.stack[i:]
                return
            if tag == "body" and open_ == "head":
                del self.stack[i:]
                return
            if open_ in CONTAINERS or open_ in ("ul", "ol", "dl", "table"):
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in BLOCKS:
            self.flush()
            self.links = 0
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        if not self.stack[-1].skip:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())

    def close(self):
        super().close()
        self.flush()


def smoothed(ratios: np.ndarray) -> np.ndarray:
    x = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(x**2) / (2 * SIGMA**2))
    # At the ends of the page the kernel is that part of it which lies on the page.
    weight = np.convolve(np.ones(len(ratios)), kernel)[RADIUS : RADIUS + len(ratios)]
    return np.convolve(ratios, kernel)[RADIUS : RADIUS + len(ratios)] / weight


def content(lines: list[tuple[str, int, int, int, int]], boxes: list[tuple[str, int]]) -> list[str]:
    """The texts of the content regions' lines, in order."""
    within = [x for x in lines if x[4]]
    lines = within or lines
    if not lines:
        return []
    size = np.array([len(t) for t, *_ in lines], float)
    plain = size - np.minimum(size, [linked for _, _, linked, *_ in lines])
    level = smoothed(np.minimum(plain / np.maximum(1, [n for _, n, *_ in lines]), RATIO))
    high = level >= THRESHOLD * level.std()
    # What is chosen: marked regions as a whole, else containers by the lines of their own.
    units = [region or box for *_, box, region in lines]
    mass: dict[int, float] = {}
    whole: dict[int, float] = {}
    for unit, n, p, up in zip(units, size, plain, high):
        mass[unit] = mass.get(unit, 0.0) + (p if up else 0.0)
        whole[unit] = whole.get(unit, 0.0) + n
    chosen = {b for b, m in mass.items() if m > 0 and m >= 0.5 * whole[b]} or {max(mass, key=mass.get)}
    if not within:
        chosen |= _below(chosen, boxes, [box for *_, box, _ in lines], size, plain)
    return [t for (t, *_), unit in zip(lines, units) if unit in chosen]


def _below(chosen: set[int], boxes: list[tuple[str, int]], owner: list[int], size: np.ndarray, plain: np.ndarray) -> set[int]:
    """The containers given because one around them is."""
    total = [np.bincount(owner, x, minlength=len(boxes)) for x in (size, plain)]
    for b in range(len(boxes) - 1, 0, -1):
        for x in total:
            x[boxes[b][1]] += x[b]
    given, page = set(), set()
    for b, (tag, up) in enumerate(boxes):
        if tag in ("", "html", "body"):
            if b in chosen or b and up in page:
                page.add(b)
        elif b in chosen or up in given:
            given.add(b)
        elif up in page and (tag == "td" or 2 * total[1][b] >= total[0][b]):
            # Of what is below a body, links alone are a menu, but for cells of a table.
            page.add(b)
    return given | page


def main_text(html: str) -> str:
    page = Lines()
    page.feed(html)
    page.close()
    return "\n\n".join(content(page.lines, page.boxes))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches):
        for b in batches:
            texts = [main_text(h.as_py() or "") for h in b.column(2)]
            yield {"page_id": b.column(0), "url": b.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    source = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.col(f"`{html_col}`").cast("string").alias("html"),
    )
    return arrow_map(source, run, "page_id long, url string, text string, n_chars long")
