"""Main text of web pages from parser events, text-to-tag ratios and threshold clustering.

The standard library's parser yields events; blocks of text become lines with their number of characters and tags.
Elements whose role, name or label marks them as furniture contribute nothing. The ratio of text to tags of the lines is
smoothed with a Gaussian and split into two clusters; the smallest container outside of which no content is left is the
region to keep. Content is the upper cluster and, whatever their ratio, headings and prose.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Width of the Gaussian in lines, and how many widths its kernel reaches.
SIGMA, REACH = 1.5, 3
#: A line consists of links if so much of it is link text.
LINKED = 0.6
#: Links of a menu have fewer characters than this on average.
MENU = 25
#: Text that stands in no block of prose counts as prose from so many words on.
PROSE = 8

# Element names of HTML and words that label page furniture.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "applet aside audio button canvas dialog embed fieldset footer form head iframe map math menu nav noframes noscript object "
    "option script search select style svg template textarea title video".split()
)
REGIONS = frozenset("article body div main section table td".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
LABELS = frozenset(
    "ad ads adsense alert alerts advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disclaimer disqus footer gdpr header hidden masthead menu menus modal nav navbar navigation newsletter notice "
    "notices overlay pager pagination paywall popup promo promos promotion promotions recommended related reply replies respond "
    "share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription teaser toolbar widget widgets".split()
)
# A label such as "no-sidebar" tells of the layout; an article is only dropped for a label that is one of the last words alone.
LAYOUT = frozenset("has hide no with without".split())
ARTICLE_LABELS = frozenset("ad advert comment comments promo related reply sponsored teaser".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("blockquote caption dd dt figcaption li p pre".split())

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CUT_TAG = re.compile(r"<[A-Za-z/!][^<>]*\Z")


@dataclass
class Line:
    """A block: its text, the tags since the block before, links and characters inside them, its kind, and the regions around it."""

    parts: list[str] = field(default_factory=list)
    tags: int = 0
    links: int = 0
    linked: int = 0
    heading: bool = False
    paragraph: bool = False
    regions: tuple[int, ...] = ()
    text: str = ""

    @property
    def of_links(self) -> bool:
        return self.linked >= LINKED * len(self.text)

    @property
    def prose(self) -> bool:
        return not self.of_links and (self.paragraph or len(self.text.split()) >= PROSE)


def furniture(tag: str, attributes: dict[str, str | None], in_article: bool) -> bool:
    """Whether an element and all it holds is no part of the main text."""
    if tag in ("html", "body", "main"):
        return False
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if "hidden" in attributes or (attributes.get("aria-hidden") or "").lower() == "true":
        return True
    if "display:none" in (attributes.get("style") or "").lower().replace(" ", ""):
        return True
    if (attributes.get("role") or "").lower() in ROLES:
        return True
    for label in f"{attributes.get('class') or ''} {attributes.get('id') or ''}".split():
        words = [w.lower() for w in _WORDS.findall(label)]
        if not words or LAYOUT & set(words):
            continue
        if tag == "article" and not in_article:
            if len(words) == 1 and words[0] in ARTICLE_LABELS:
                return True
        elif words[0] in LABELS or words[-1] in LABELS:
            if not (in_article and "header" in (words[0], words[-1])):
                return True
    return False


class LineReader(HTMLParser):
    """Turns parser events into lines. Unclosed elements end with their parents or the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = [Line()]
        self.open: list[tuple[str, int | None, bool]] = []  # tag, region number, dropped from here on
        self.dropped = 0
        self.articles = 0
        self.links = 0
        self.header = 0
        self.headings = 0
        self.regions: list[tuple[str, int]] = [("body", -1)]
        self.inside: tuple[int, ...] = (0,)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("article", "main") and self.dropped and not self.articles:
            self._leave_dropped()
        if tag in BLOCKS or tag == "br":
            if tag == "br":
                self._text(" ")
            else:
                self._cut()
        self.lines[-1].tags += 1
        if tag in VOID:
            return
        if tag in ("p", "li", "td", "tr", "dd", "dt", "option") and self.open and self.open[-1][0] == tag:
            self._close(len(self.open) - 1)
        drop = bool(not self.dropped and furniture(tag, dict(attrs), bool(self.articles)))
        number = None
        if tag in REGIONS and not self.dropped and not drop:
            number = len(self.regions)
            self.regions.append((tag, self.inside[-1]))
            self.inside += (number,)
        self.open.append((tag, number, drop))
        self.dropped += drop
        self.articles += tag == "article"
        self.links += tag == "a"
        self.lines[-1].links += tag == "a"
        self.header += tag == "header"
        self.headings += tag in HEADINGS

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._cut()
        self.lines[-1].tags += 1
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._close(at)
                return
            if tag not in BLOCKS and self.open[at][0] in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        if not self.dropped and not (self.header and not self.headings):
            self._text(data)
            line = self.lines[-1]
            if data.strip():
                line.heading |= self.headings > 0
                line.paragraph |= next((tag for tag, _, _ in reversed(self.open) if tag in BLOCKS), "") in PARAGRAPHS
            if self.links:
                line.linked += len(data.strip())

    def _text(self, data: str) -> None:
        line = self.lines[-1]
        line.parts.append(data)
        line.regions = self.inside

    def _cut(self) -> None:
        if self.lines[-1].parts:
            self.lines.append(Line())

    def _close(self, at: int) -> None:
        for tag, number, drop in self.open[at:]:
            self.dropped -= drop
            self.articles -= tag == "article"
            self.links -= tag == "a"
            self.header -= tag == "header"
            self.headings -= tag in HEADINGS
            if number is not None:
                self.inside = self.inside[: self.inside.index(number)]
        del self.open[at:]

    def _leave_dropped(self) -> None:
        self._cut()
        self._close(next(k for k, (_, _, drop) in enumerate(self.open) if drop))


def read_lines(html: str) -> tuple[list[Line], list[tuple[str, int]]]:
    """Lines with text, and (tag, parent) of every region; region 0 is the page."""
    reader = LineReader()
    reader.feed(_CUT_TAG.sub("", html) if html.rfind("<") > html.rfind(">") else html)
    reader.close()
    lines = []
    tags = 0
    for line in reader.lines:
        line.text = " ".join("".join(line.parts).split())
        tags += line.tags
        if line.text:
            line.tags, tags = tags, 0
            lines.append(line)
    return lines, reader.regions


def smoothed(values: np.ndarray) -> np.ndarray:
    """Gaussian smoothing; the kernel is renormalised at both ends."""
    reach = int(np.ceil(REACH * SIGMA))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    middle = slice(reach, reach + len(values))
    return np.convolve(values, kernel)[middle] / np.convolve(np.ones(len(values)), kernel)[middle]


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """The upper of two clusters of the smoothed ratios; their threshold is the mean of the cluster means."""
    smooth = smoothed(ratios)
    threshold = float(smooth.mean())
    for _ in range(50):
        high = smooth >= threshold
        if high.all() or not high.any():
            break
        moved = (smooth[high].mean() + smooth[~high].mean()) / 2
        if abs(moved - threshold) < 1e-9:
            break
        threshold = moved
    return smooth >= threshold


def main_text(html: str | None) -> str:
    """The main text of a page; empty for null, for pages without text and for pages of furniture only."""
    lines, regions = read_lines(html or "")
    if not lines:
        return ""
    sizes = np.array([len(line.text) for line in lines], float)
    ratios = sizes / np.array([max(1, line.tags) for line in lines])
    weights = np.where(content_lines(ratios), sizes, 0.0)
    content = [line.heading or line.prose or (weight > 0 and not line.of_links) for line, weight in zip(lines, weights)]
    within: dict[int, float] = {}
    held: dict[int, int] = {}
    for line, weight, counts in zip(lines, weights, content):
        for region in line.regions:
            within[region] = within.get(region, 0.0) + weight
            held[region] = held.get(region, 0) + counts
    region = _region(regions, within, held)
    inside = [k for k, line in enumerate(lines) if region in line.regions]
    if not _semantic(regions, region):
        menus = _menus([lines[k] for k in inside], [content[k] for k in inside], regions)
        inside = [k for k, menu in zip(inside, menus) if not menu]
    return "\n".join(lines[k].text for k in inside)


def _menus(lines: list[Line], content: list[bool], regions: list[tuple[str, int]]) -> list[bool]:
    """Which lines are menus: blocks of links apart from content, and short links other than a single one within content.

    Headings and long links beside content, such as references, are none.
    """
    mixed = {line.regions[-1] for line in lines if line.heading or not line.of_links}
    beside = {line.regions[-1] for line, counts in zip(lines, content) if counts}
    out = []
    for k, line in enumerate(lines):
        region = line.regions[-1]
        if line.heading or not line.of_links:
            out.append(False)
        elif region not in mixed and regions[region][1] not in beside:
            out.append(True)
        else:
            single = line.links <= 1 and k > 0 and content[k - 1] and not (k + 1 < len(lines) and lines[k + 1].of_links)
            out.append(line.linked < MENU * max(1, line.links) and not single)
    return out


def _semantic(regions: list[tuple[str, int]], region: int) -> bool:
    while region >= 0:
        if regions[region][0] in ("article", "main"):
            return True
        region = regions[region][1]
    return False


def _region(regions: list[tuple[str, int]], within: dict[int, float], held: dict[int, int]) -> int:
    """The article or main element with most content, else the deepest region outside of which there is no content line."""
    articles = [k for k in within if regions[k][0] == "article" and not _semantic(regions, regions[k][1])]
    nested = [k for k in within if regions[k][0] == "article" and k not in articles]
    mains = [k for k in within if regions[k][0] == "main"]
    for group in (articles, mains):
        if group:
            best = max(group, key=lambda k: (within[k], -k))
            inner = [k for k in nested if _under(regions, k, best) and held[k] == held[best] > 0]
            return max(inner, key=lambda k: (within[k], -k)) if inner and regions[best][0] == "main" else best
    region = 0
    while True:
        parts = [k for k in within if regions[k][1] == region]
        best = max(parts, key=lambda k: (held[k], -k), default=None)
        if best is None or held[best] < held[region] or not held[region]:
            return region
        region = best


def _under(regions: list[tuple[str, int]], region: int, above: int) -> bool:
    while region > above:
        region = regions[region][1]
    return region == above


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in ``out`` and its code points in ``n_chars`` instead of ``html``.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one newline. Null,
    empty and broken pages give what can be read of them, at least the empty text. Columns named ``out`` or ``n_chars`` are
    replaced; repeated rows are extracted alike.
    """
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in (html, out, "n_chars")]

    @F.pandas_udf("string")
    def read(column: pd.Series) -> pd.Series:
        return column.map(main_text)

    return pages.select(*kept, read(F.col(html)).alias(out)).withColumn("n_chars", F.length(out).cast("long"))
