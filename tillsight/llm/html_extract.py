"""Main text of web pages by text-to-tag ratios.

The standard library's parser sends its events to a collector that cuts the page into block lines,
each with its text, its number of tags and the containers it stands in. A line's text-to-tag ratio
is smoothed over its neighbours with a Gaussian; the smoothed ratios are split into two clusters,
and the lines of the upper one are the cores of content regions, unless they are lifted there by their
neighbours alone. A region is the smallest article
or main element around a core or, outside of these, the innermost block container; all its lines
count, so that short paragraphs between long ones stay. A nested block without a core of its own
counts to the nearest container around it that has one, but the page's body takes in quotes and
table cells only. An article or main element without a core of its own does not count. Scripts, styles, forms, menus, headers,
footers, sidebars and elements named as adverts, notices, comments and the like never count.
"""

from __future__ import annotations

import collections
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.base import scratch

# Element names of HTML and common names of parts that are not content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg canvas math head title".split())
OUTSIDE = frozenset("nav footer aside form button select textarea dialog menu label fieldset".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary
table tbody td tfoot th thead tr ul""".split())
ROOT = frozenset("article main".split())
CLOSES_P = BLOCK - frozenset("option legend summary li dd dt td th tr tbody thead tfoot".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
OTHER_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs
comment comments commentlist consent cookie cookies disclaimer disqus footer gdpr hidden legal login masthead menu
menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted
promotion related recommended replies respond search share sharing sidebar signup social sponsor sponsored subscribe
toolbar topbar widget""".split())
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
WHITE = re.compile(r"[ \t-\r]+")
SIGMA = 1.0


def named_other(attributes: list) -> bool:
    """Whether an element's class, id, role or hidden attribute says that it is not content."""
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in OTHER_ROLES:
            return True
        if name in ("class", "id") and value:
            parts = [p.lower() for p in NAME_PARTS.findall(value)]
            if not OTHER_NAMES.isdisjoint(parts):
                return True
        if name == "style" and value and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return True
    return False


class Lines(HTMLParser):
    """Block lines of a page: text, tags, region, and whether the line can be content."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool]] = []  # element ("" once closed below an open block), region, shut out
        self.places: dict[str, list[int]] = collections.defaultdict(list)  # of each element's open ones in the stack
        self.blocks: list[int] = []  # places of the open block elements
        self.lines: list[tuple[str, int, int]] = []  # text, tags, region
        self.regions = 0
        self.rooted: set[int] = set()
        self.around = [0]  # by region, the one it stands in
        self.whole = {0}  # regions that are the page's body
        self.inset: set[int] = set()  # regions that are parts of a text
        self.parts: list[str] = []
        self.tags = 0

    def top(self) -> tuple[str, int, bool]:
        return self.stack[-1] if self.stack else ("", 0, False)

    def cut(self) -> None:
        """End the line that is being read."""
        text = WHITE.sub(" ", "".join(self.parts)).strip(" ")
        _, region, out = self.top()
        if text and not out:
            self.lines.append((text, self.tags, region))
        self.parts, self.tags = [], 0

    def handle_starttag(self, tag, attributes):
        if tag in BLOCK:
            if tag in CLOSES_P:
                self.close_open("p", BLOCK - {"p"})
            elif tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
                self.close_open(tag, frozenset("ul ol dl table select menu".split()))
            self.cut()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        _, region, out = self.top()
        rooted = region in self.rooted
        out = out or tag in RAW or tag in OUTSIDE or (tag == "header" and not rooted) or (
            tag not in ("html", "body") and tag not in ROOT and named_other(attributes))
        if tag in ROOT and not out:
            region = self.open_region(region)
            self.rooted.add(region)
        elif tag in ("body", "div", "section", "td", "blockquote") and not rooted:
            region = self.open_region(region)
            if tag == "body":
                self.whole.add(region)
            elif tag in ("td", "blockquote"):
                self.inset.add(region)
        self.places[tag].append(len(self.stack))
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, region, out))

    def drop(self, place: int) -> None:
        """Close the elements from a place of the stack on, and closed ones that come to stand on top."""
        while self.stack and (len(self.stack) > place or not self.stack[-1][0]):
            tag = self.stack.pop()[0]
            if tag:
                self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def open_region(self, around: int) -> int:
        self.regions += 1
        self.around.append(around)
        return self.regions

    def content_regions(self, cores: set[int]) -> list[bool]:
        """By region, whether it has a core or is a nested block of one that has."""
        counts: list[bool] = []
        for region, outer in enumerate(self.around):  # what a region stands in has a smaller number
            own = region in self.rooted or region in self.whole or outer in self.whole and region not in self.inset
            counts.append(region in cores or not own and counts[outer])
        return counts

    def close_open(self, tag: str, barrier: frozenset) -> None:
        """Close an element whose end tag may be left out, unless a barrier element stands between."""
        places = self.places.get(tag)
        if places and not any(self.places[other][-1] > places[-1] for other in barrier if self.places.get(other)):
            self.cut()
            self.drop(places[-1])

    def handle_endtag(self, tag):
        self.tags += 1
        places = self.places.get(tag)
        if tag in VOID or not places:
            if tag in BLOCK:
                self.cut()
            return
        place = places[-1]
        if tag not in BLOCK and self.blocks and self.blocks[-1] > place:
            # a misplaced end tag of a run-on element such as b: blocks above stay open
            places.pop()
            self.stack[place] = ("", *self.stack[place][1:])
            return
        if tag in BLOCK:
            self.cut()
        self.drop(place)

    def parse_marked_section(self, i, report=1):
        """A marked section of a kind the parser does not know is a comment."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def handle_data(self, data):
        if not self.top()[2]:
            self.parts.append(data)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Ratios averaged over their neighbours with Gaussian weights."""
    reach = int(3 * sigma)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(ratios, reach, mode="edge")
    return np.convolve(padded, weights / weights.sum(), mode="valid")


def upper_cluster(values: np.ndarray) -> np.ndarray:
    """Which values lie in the upper of two clusters, by moving the threshold between the two means."""
    if np.ptp(values) < 1e-9:
        return np.ones(len(values), bool)
    threshold = values.mean()
    for _ in range(50):
        upper = values >= threshold
        if upper.all():
            return upper
        following = (values[upper].mean() + values[~upper].mean()) / 2
        if abs(following - threshold) < 1e-9:
            break
        threshold = following
    return values >= threshold


def main_text(html: str | None) -> str:
    """The content of one page; nothing for null, empty and text-free pages."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.cut()
    if not parser.lines:
        return ""
    ratios = np.array([len(text) / max(1, tags) for text, tags, _ in parser.lines], float)
    smooth = smoothed(ratios)
    core = upper_cluster(smooth)
    core &= ratios >= smooth[core].min() - 1e-9
    cores = {region for (_, _, region), kept in zip(parser.lines, core, strict=True) if kept}
    counts = parser.content_regions(cores)
    return "\n".join(text for text, _, region in parser.lines if counts[region])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([main_text(html) for html in batch.column(0).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([texts, *batch.columns[1:]], ["text", *batch.schema.names[1:]])


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """The pages with ``text``, the main text, in place of the html column.

    Character references are decoded, white space (ASCII) inside a block becomes one space, blocks
    are trimmed and joined by newline in page order. A line break element counts as white space. Null and
    empty pages, and pages without content, have the empty text. Rows are read one by one: repeated
    rows repeat, very long pages are read whole, unclosed elements end with their container, and unknown
    marked sections are comments; the work is linear in the page however deep it nests. All
    other columns pass through; a column of the input named text is replaced. An empty table gives
    an empty one.
    """
    others = [c for c in pages.columns if c not in (html_column, "text")]
    fields = "".join(f", `{n}` {t}" for n, t in pages.select(*others).dtypes)
    return pages.select(F.col(html_column).alias(scratch("html")), *others).mapInArrow(_extract, f"text string{fields}")
