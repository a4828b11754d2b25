"""Main text of HTML pages from streaming parser events.

The events of the standard library's parser become lines, one for each block of
text, with the number of its characters and of the tags met since the line
before. The text-to-tag ratios of the lines, smoothed by a Gaussian, are
clustered by a threshold: lines above it are content, and the regions with
content are selected. Regions are the page's articles, else its main element,
else the innermost element that holds all of the content, with what stands
between it and a heading before it. In such an element lines below the threshold
that consist of links go where they are menus: several links in a line, or several
such lines one after another. All other text of the selected regions is kept,
short lines too, but for elements that are never part of an article (by name, or
by a word of their class, id or role). The header of an article belongs to it.

Rows: null or empty HTML gives an empty text. Tags may be unclosed, crossed or
cut off. Repeated rows stay, pages of any length are read whole, other columns
are not read, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrolake.llm.common import per_batch

#: Lines on each side that the smoothing reaches, and its standard deviation.
RADIUS, SIGMA = 2, 1.0
#: Lines are content if their smoothed ratio is above this share of the standard deviation of all ratios.
SHARE = 1.0
#: Fixed: headings.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

#: Fixed: elements whose text is never part of an article.
NEVER = frozenset(
    "aside button canvas datalist dialog footer form frame frameset head header iframe menu nav noembed noframes noscript "
    "object option script select style svg template textarea title audio video".split()
)
#: Fixed: words of class, id and role that mark such elements; WEAK ones do not inside an article, nor beside a word of OWN.
MARKS = frozenset(
    "ad ads adbox adsense advert advertisement advertising banner breadcrumb breadcrumbs byline-share captcha comment comments "
    "complementary consent contentinfo cookie cookies disqus footer header hidden login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices pager paginator pagination popup promo promoted promotion related reply replies respond "
    "search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription toolbar tooltip warning widget "
    "widgets alert gdpr overlay".split()
)
WEAK = frozenset("alert header hidden masthead related search share warning".split())
OWN = frozenset("article content entry headline post story title".split())
#: Fixed: elements that end a line.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
#: Fixed: elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Fixed: elements that may stand in a head; any other start tag ends it.
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
#: Fixed: start tags that close open elements whose end tag may be left out, and the open elements that they do not reach beyond.
_ROWS = frozenset("caption thead tbody tfoot tr td th".split())
_INLINE = frozenset("span div address".split())
CLOSES = {
    **{t: (frozenset({t}), None) for t in ("li", "option")},
    **{t: (frozenset({"dt", "dd"}), None) for t in ("dt", "dd")},
    **{t: (_ROWS - {"thead", "tbody", "tfoot", "tr"}, frozenset({"table", "template", "tr"})) for t in ("td", "th")},
    "tr": (_ROWS - {"thead", "tbody", "tfoot"}, frozenset({"table", "template", "thead", "tbody", "tfoot"})),
    **{t: (_ROWS, frozenset({"table", "template"})) for t in ("caption", "thead", "tbody", "tfoot")},
}
#: Elements that the stack of open elements holds; others only count as tags.
KEPT = (BLOCKS | NEVER | {"td", "th", "span"}) - VOID - {"p"}


def marked(attributes: list[tuple[str, str | None]], in_article: bool = False) -> bool:
    """Class, id, role or a hidden attribute says that this is no article text."""
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name in ("class", "id", "role") and value:
            for token in value.split():
                words = frozenset(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower()))
                found = MARKS & words
                if found and not (found <= WEAK and (in_article or OWN & words)):
                    return True
    return False


class Lines(HTMLParser):
    """Collects the lines of a page as the events come."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]  # name, element, never article text, in an article
        self.open: Counter[str] = Counter()  # names on the stack
        self.parents, self.names = [0], [""]
        self.texts: list[str] = []
        self.owners: list[int] = []
        self.tags: list[int] = []
        self.pieces: list[str] = []
        self.links: list[int] = []  # of lines that consist of links their number, else 0
        self.met = 0
        self.anchor = self.anchors = 0  # inside a link, links of the open line
        self.plain = False  # the open line has text outside links
        self.cell = (0, 0)  # links and line breaks of the open line when the open table cell began
        self.breaks = 0
        self.paragraph = 0  # open elements when the open paragraph began, 0 without one

    def close_from(self, i: int) -> None:
        """End the open elements from number ``i`` on."""
        self.open.subtract(entry[0] for entry in self.stack[i:])
        del self.stack[i:]
        if self.paragraph > i:
            self.paragraph = 0

    def close_paragraph(self) -> None:
        """End the open paragraph with what was opened inline in it."""
        if self.paragraph and all(entry[0] == "span" for entry in self.stack[self.paragraph :]):
            self.close_from(self.paragraph)
            self.paragraph = 0

    def close_before(self, tag: str) -> None:
        """End what a start tag ends without an end tag."""
        if tag == "body" and self.open["head"] and not self.open["template"]:
            self.close_from(next(i for i, entry in enumerate(self.stack) if entry[0] == "head"))
        elif tag not in IN_HEAD and self.in_head():
            self.close_from(len(self.stack) - (1 if self.stack[-1][0] == "head" else 2))
        if tag in BLOCKS:
            self.close_paragraph()
        if tag in CLOSES:
            closed, bounds = CLOSES[tag]
            lowest = 0
            for i in range(len(self.stack) - 1, 0, -1):
                name = self.stack[i][0]
                if name in closed:
                    lowest = i
                    if bounds is None:
                        break
                elif name in bounds if bounds is not None else name not in _INLINE:
                    break
            if lowest:
                self.close_from(lowest)

    def in_head(self) -> bool:
        """The innermost open element is a head, or a noscript element in one."""
        return self.stack[-1][0] == "head" or (self.stack[-1][0] == "noscript" and self.stack[-2][0] == "head")

    def end_line(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.texts.append(text)
                self.owners.append(self.stack[-1][1])
                self.tags.append(self.met)
                self.links.append(0 if self.plain else self.anchors)
                self.met = 0
            self.pieces = []
        self.anchors, self.plain, self.breaks, self.cell = int(self.anchor > 0), False, 0, (0, 0)

    def end_cell(self) -> None:
        """A cell that lists links, one to a line, is a line of its own; other cells of a row share one."""
        if not self.plain and not self.stack[-1][3] and self.anchors > self.cell[0] + 1 and self.breaks > self.cell[1]:
            self.end_line()
        self.pieces.append(" ")
        self.cell = (self.anchors, self.breaks)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.met += 1
        if tag in BLOCKS:
            self.end_line()
        elif tag in ("td", "th"):
            self.end_cell()
        elif tag in ("br", "img"):
            self.pieces.append(" ")
            self.breaks += tag == "br"
        elif tag == "a" and not self.stack[-1][2]:
            self.anchor, self.anchors = 1, self.anchors + 1
        self.close_before(tag)
        if tag == "p":
            self.paragraph = len(self.stack)
        if tag in KEPT:
            within = self.stack[-1][3] or tag in ("article", "main")
            never = self.stack[-1][2] or (tag in NEVER and not (tag == "header" and self.stack[-1][3]))
            never = never or (bool(attrs) and tag not in ("html", "body") and marked(attrs, within))
            if never and not self.stack[-1][2]:
                self.end_line() if tag in BLOCKS or tag in NEVER else None
            self.parents.append(self.stack[-1][1])
            self.names.append(tag)
            self.stack.append((tag, len(self.names) - 1, never, within))
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:  # as browsers do, the slash is ignored
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.met += 1
        if tag in BLOCKS:
            self.end_line()
        elif tag in ("td", "th"):
            self.end_cell()
        elif tag == "a":
            self.anchor = 0
        if tag == "p":
            self.close_paragraph()
        if tag in KEPT and self.open[tag]:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] == tag:
                    if self.stack[-1][2] and not self.stack[i - 1][2]:
                        self.pieces = [] if tag in NEVER else self.pieces
                    self.close_from(i)
                    break

    def handle_data(self, data: str) -> None:
        if self.stack[-1][0] == "head" and not data.isspace():
            self.close_from(len(self.stack) - 1)
        if not self.stack[-1][2]:
            self.pieces.append(data)
            self.plain = self.plain or (not self.anchor and any(map(str.isalnum, data)))


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """The ratios after a Gaussian, edges normalised."""
    kernel = np.exp(-(np.arange(-RADIUS, RADIUS + 1) ** 2) / (2 * SIGMA**2))
    full = np.convolve(ratios, kernel)[RADIUS:-RADIUS]
    return full / np.convolve(np.ones(len(ratios)), kernel)[RADIUS:-RADIUS]


def inside(lines: Lines, chosen: set[int]) -> list[bool]:
    """For each element whether it is chosen or lies in a chosen one."""
    out = [False] * len(lines.names)
    for i in range(len(out)):  # children have larger numbers
        out[i] = i in chosen or (i > 0 and out[lines.parents[i]])
    return out


def regions(lines: Lines) -> list[bool]:
    """For each line whether it is text of the article."""
    sizes = np.array([len(t) for t in lines.texts], float)
    ratios = sizes / np.maximum(1, lines.tags)
    content = smoothed(ratios) > SHARE * ratios.std()
    content = content if content.any() else np.ones(len(sizes), bool)
    held = np.zeros(len(lines.names), int)  # content lines in each element
    np.add.at(held, lines.owners, content)
    for i in range(len(held) - 1, 0, -1):
        held[lines.parents[i]] += held[i]
    for name in ("article", "main"):
        found = {i for i, n in enumerate(lines.names) if n == name and held[i] > 0}
        if found:
            within = inside(lines, found)
            return [within[owner] for owner in lines.owners]
    at = max(np.flatnonzero(held == held[0]).tolist())  # the elements with all content lie in each other
    within = inside(lines, {at})
    kept = [within[owner] for owner in lines.owners]
    path = {}  # the elements around the region, each with the one in it that leads there
    while at:
        path[lines.parents[at]] = at
        at = lines.parents[at]
    heads = {i for i, name in enumerate(lines.names) if name in HEADINGS and i < path.get(lines.parents[i], 0)}
    before = inside(lines, heads)
    first = next((n for n, owner in enumerate(lines.owners) if before[owner]), len(kept))
    first, start = min(first, kept.index(True)), kept.index(True)
    kept[first:start] = [True] * (start - first)
    listed = [n > 0 and not high for n, high in zip(lines.links, content)]
    for n, links in enumerate(lines.links):
        if listed[n] and (links > 1 or any(listed[max(0, n - 1) : n]) or any(listed[n + 1 : n + 2])):
            kept[n] = False
    return kept


def main_text(html: str) -> str:
    """The article of one page, blocks joined by an empty line."""
    lines = Lines()
    lines.feed(html)
    lines.close()
    lines.end_line()
    if not lines.texts:
        return ""
    return "\n\n".join(t for t, kept in zip(lines.texts, regions(lines)) if kept)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row for each page."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))

    def run(batch: pa.RecordBatch):
        texts = [main_text(x) for x in batch.column(2).to_pylist()]
        return [batch.column(0), batch.column(1), texts, [len(t) for t in texts]]

    return per_batch(rows, run, "page_id long, url string, text string, n_chars long")
