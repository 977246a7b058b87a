"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams tag and text events. Text between block tags makes a
line; each line knows how much text and link text it holds, how many tags it took, and the
container (article, section, table cell ...) around it. Lines in parts that announce
themselves as menus, headers, footers, sidebars, notices, adverts, forms or reader comments
never count. Over the rest the text-to-tag ratio per line is smoothed with a Gaussian and
split in two clusters; containers with a line in the upper cluster are the content, and
give all their lines in page order, short ones too.

Edge cases: null or empty html gives an empty text; repeated rows give repeated results;
unknown, unclosed and stray tags are read as browsers do in the common cases; columns other
than the named ones are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names and words in class, id and role that HTML pages use.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "head title script style noscript template iframe object svg canvas audio video map math "
    "nav footer aside form button select textarea menu dialog".split()
)
CONTAINERS = frozenset("article main section body div td th blockquote".split())
ENDS_PARAGRAPH = BLOCKS - {"option", "optgroup", "body", "html"}
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice notices alert popup modal overlay sidebar widget "
    "related recommended comment comments commentlist reply replies respond disqus share sharing social "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager footer masthead "
    "newsletter subscribe subscription signup login search toolbar skip contentinfo complementary "
    "hidden".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

SIGMA = 1.0
RADIUS = 2
LINK_SHARE = 0.7  # a line with more of its text in links is a list of links


def _announced(attrs: list[tuple[str, str | None]]) -> bool:
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name in ("class", "id", "role") and value:
            if not BOILERPLATE.isdisjoint(re.split(r"[^a-z0-9]+", value.lower())):
                return True
        if name == "style" and value and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


class Lines(HTMLParser):
    """Collects the page's lines as (text, link characters, tags, container number, heading)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self._open: list[tuple[str, bool, int]] = []  # name, skipped, container
        self._names: dict[str, int] = {}
        self._containers = 0
        self._text: list[str] = []
        self._links = 0
        self._tags = 0

    def _state(self) -> tuple[bool, int]:
        return self._open[-1][1:] if self._open else (False, 0)

    def _flush(self) -> None:
        skipped, container = self._state()
        if self._text:
            text = " ".join("".join(self._text).split())
            if text and not skipped:
                heading = any(x[0] in HEADINGS for x in self._open[-3:])
                self.lines.append((text, self._links, max(1, self._tags), container, heading))
        self._text, self._links, self._tags = [], 0, 0

    def _pop(self, name: str) -> None:
        """Close everything up to the innermost element of the name."""
        while self._open:
            top = self._open.pop()[0]
            self._names[top] -= 1
            if top == name:
                return

    def _within(self, name: str) -> bool:
        return self._names.get(name, 0) > 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if tag in BLOCKS:
            self._flush()
            if tag in ENDS_PARAGRAPH and self._within("p"):
                self._pop("p")
            if self._open and (tag == self._open[-1][0] == "li" or {tag, self._open[-1][0]} <= {"dd", "dt"}):
                self._pop(self._open[-1][0])
            if tag in ("td", "th", "tr") and self._open and self._open[-1][0] in ("td", "th"):
                self._pop(self._open[-1][0])
        elif tag == "br":
            self._text.append(" ")
        if tag in VOID:
            return
        if tag == "body" and self._within("head"):
            self._pop("head")
        skipped, container = self._state()
        if not skipped:
            inside = self._within("article") or self._within("main")
            skipped = tag in SKIPPED or (tag == "header" and not inside)
            skipped = skipped or (tag not in ("html", "body") and _announced(attrs))
        if skipped != self._state()[0]:
            self._flush()
        inner = self._within("article") or self._within("main")
        if tag == "article" or (tag in CONTAINERS and not inner):
            self._containers += 1
            container = self._containers
        self._open.append((tag, skipped, container))
        self._names[tag] = self._names.get(tag, 0) + 1

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag in BLOCKS or tag in SKIPPED:
            self._flush()
        if tag not in VOID and self._within(tag):
            self._pop(tag)

    def handle_data(self, data: str) -> None:
        self._text.append(data)
        if self._within("a"):
            self._links += len(data.strip())

    def close(self) -> None:
        if self.rawdata.startswith("<!--"):  # a comment that never ends
            self.rawdata = ""
        super().close()
        self._flush()


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing; weights beyond the first and last line are left out."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    total = np.convolve(ratios, kernel, "full")[RADIUS : RADIUS + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), kernel, "full")[RADIUS : RADIUS + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The lower bound of the upper of two clusters (2-means on a line)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        middle = (low + high) / 2
        upper = values >= middle
        new = (float(values[~upper].mean()) if (~upper).any() else low, float(values[upper].mean()))
        if new == (low, high):
            break
        low, high = new
    return min((low + high) / 2, float(values.max()))


def extract(html: str | None) -> str:
    """The main text of one page, one line per block."""
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    length = np.array([len(x[0]) for x in lines], float)
    links = np.minimum(np.array([x[1] for x in lines], float), length)
    ratio = smoothed((length - links) / np.array([x[2] for x in lines], float))
    content = ratio >= threshold(ratio)
    chosen = {x[3] for x, c, n, k in zip(lines, content, length, links) if c and k <= LINK_SHARE * n}
    kept = [
        text
        for (text, _, _, container, heading), n, k in zip(lines, length, links)
        if container in chosen and (heading or k <= LINK_SHARE * n)
    ]
    return "\n".join(kept)


def main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns of ``keep``, and ``text``: the main text of ``html``."""
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([extract(x.as_py()) for x in batch.column(len(keep))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], texts], [*keep, "text"])

    return pages.select(*keep, F.col(html).alias("_html")).mapInArrow(run, schema)
