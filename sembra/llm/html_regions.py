"""Main text of pages: parser events, text-to-tag ratios, smoothing and threshold clustering.

The standard library's streaming parser turns a page into lines, one for each block element, with
the length of its text and the tags met since the line before. Structure only vetoes: lines inside
elements that never hold an article (navigation, header, footer, aside, form, script ..., or a class,
id or role that says so) are left out, with the tags met there. What is an article is decided by the
ratios of text to tags of the lines that are left:

* the logarithms of the ratios are smoothed by a Gaussian along the lines of a container, so short
  lines between long ones count as theirs, and a box beside them does not;
* a threshold between the two clusters of smoothed ratios (two means in one dimension) marks the
  content lines;
* the content region is the innermost container that holds most of the text of the content lines. It
  is extended to its ends: all lines that stand in it directly are returned, short headings and
  endings too. Of the containers inside it those are returned that hold content lines; boxes below
  the threshold (menus, adverts, notices without any mark) are not. Headings right before a returned
  line are returned, wherever they stand.

Null and empty pages give an empty text, as do pages without a line outside boilerplate; of equal
containers the one that opens last is taken. Broken markup is read as the parser reads it; open
elements are closed by their ancestors. Whole pages are read, in time linear in their length
(containers are numbered and know their parent). Repeated rows are extracted each by itself.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from sembra.llm.common import map_columns

#: Fixed values of HTML: elements without an end tag, block elements, containers.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div td th center".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside blockquote caption dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr li menu nav ol p pre script style summary table tbody template textarea tfoot thead title"
    " tr ul".split()
)
HEADINGS = tuple("h1 h2 h3 h4 h5 h6".split())
HEAD = frozenset("head title meta link script style base noscript template".split())
BOILERPLATE = frozenset(
    "script style noscript template head title nav header footer aside form button select textarea iframe svg object"
    " dialog menu canvas audio video".split()
)
#: Words of a class, id or role that mark boilerplate.
MARKS = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary"
    " contentinfo cookie cookies disqus footer header menu modal nav navbar navigation newsletter notice notices"
    " notification pagination popup promo promoted promotion related search share sharing sidebar social sponsor"
    " sponsored subscribe toolbar widget".split()
)
UNMARKED = frozenset("html body main article".split())
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def marked(attributes: list) -> bool:
    """Whether class, id, role or a hiding attribute says boilerplate."""
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value or ""):
            return True
        if name in ("class", "id", "role"):
            for word in (value or "").split():
                parts = [p.lower() for p in NAME.findall(word)]
                if parts and parts[0] not in ("has", "with", "no", "without") and not MARKS.isdisjoint(parts):
                    return True
    return False


class PageLines(HTMLParser):
    """Collects ``lines``: (text, tags, number of the container, whether it is a heading).

    ``parents`` holds the parent of every container; number 0 is the page itself.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.parents: list[int] = [0]
        self.stack: list[tuple[str, bool]] = []
        self.open: dict[str, int] = {}
        self.container = 0
        self.bad = 0
        self.tags = 0
        self.tags_before = 0
        self.pieces: list[str] = []

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        if text:
            self.lines.append((text, max(1, self.tags), self.container, any(self.open.get(h) for h in HEADINGS)))
            self.tags = 0

    def push(self, tag: str, bad: bool) -> None:
        self.stack.append((tag, bad))
        self.open[tag] = self.open.get(tag, 0) + 1
        if bad and not self.bad:
            self.tags_before = self.tags
        self.bad += bad
        if tag in CONTAINERS:
            self.parents.append(self.container)
            self.container = len(self.parents) - 1

    def leave(self, bad: bool) -> None:
        """Count an element as closed; the tags met inside boilerplate belong to no line."""
        self.bad -= bad
        if bad and not self.bad:
            self.tags = self.tags_before

    def pop_to(self, tag: str) -> None:
        if not self.open.get(tag):
            return
        self.flush()
        while True:
            name, bad = self.stack.pop()
            self.open[name] -= 1
            self.leave(bad)
            if name in CONTAINERS:
                self.container = self.parents[self.container]
            if name == tag:
                return

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        elif tag == "br":
            self.pieces.append(" ")
        if tag not in HEAD and self.open.get("head"):
            self.pop_to("head")
        if tag in ("article", "main"):
            for name in ("nav", "p"):
                self.pop_to(name)
        if tag in BLOCKS and self.open.get("p"):
            self.pop_to("p")
        if tag not in VOID:
            self.push(tag, tag in BOILERPLATE or (tag not in UNMARKED and marked(attrs)))

    def handle_startendtag(self, tag, attrs):
        # HTML ignores the slash of elements that are not void.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        self.pop_to(tag) if tag in BLOCKS else self.close_inline(tag)

    def close_inline(self, tag: str) -> None:
        """Close an inline element if it is open inside the innermost block."""
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name == tag:
                for other, bad in self.stack[i:]:
                    self.open[other] -= 1
                    self.leave(bad)
                del self.stack[i:]
                return
            if name in BLOCKS:
                return

    def handle_data(self, data):
        if not self.bad:
            self.pieces.append(data)


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing over a radius of two sigma; lines beyond the ends count as the end ones."""
    radius = max(1, round(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def cluster_threshold(values: np.ndarray) -> float:
    """Midpoint of the two means in one dimension, started at zero (markup alone) and the largest.

    If no value is below half of the largest, all are content.
    """
    low, high = 0.0, float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        above = values >= cut
        if above.all():
            return float(values.min())
        new = float(values[~above].mean()), float(values[above].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def smoothed_lines(lines: list) -> np.ndarray:
    """Smoothed logarithms of the ratios; neighbours are lines that follow each other in one container."""
    values = np.log1p(np.array([len(text) / tags for text, tags, _, _ in lines]))
    held = np.array([container for _, _, container, _ in lines])
    order = np.argsort(held, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(held[order]) != 0])
    for start, end in zip(starts, np.r_[starts[1:], len(lines)]):
        values[order[start:end]] = smoothed(values[order[start:end]])
    return values


def region(lines: list, parents: list[int]) -> list[str]:
    """Texts of the lines in the region that the content lines select."""
    values = smoothed_lines(lines)
    content = values >= cluster_threshold(values)
    inside, direct = np.zeros(len(parents), np.int64), np.zeros(len(parents), np.int64)
    for (text, _, container, _), good in zip(lines, content):
        direct[container] += len(text) * bool(good)
    inside += direct
    for node in range(len(parents) - 1, 0, -1):  # a container opens after its parent
        inside[parents[node]] += inside[node]
    chosen = int(np.flatnonzero(inside * 2 > inside[0])[-1])
    # Containers of the region: the chosen one, and those below it that hold content.
    kept = np.zeros(len(parents), bool)
    kept[chosen] = True
    for node in range(chosen + 1, len(parents)):  # below a container without content there is none
        kept[node] = kept[parents[node]] and inside[node] > 0
    out: list[str] = []
    heading: list[str] = []
    for text, _, container, is_heading in lines:
        if kept[container]:
            out += heading + [text]
            heading = []
        elif is_heading:
            heading.append(text)
        else:
            heading = []
    return out


def extract_text(html: str | None) -> str:
    parser = PageLines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return "\n".join(region(parser.lines, parser.parents)) if parser.lines else ""


def extract_pages(pages: DataFrame, html: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """``key``, ``url``, text and n_chars, one row per row of ``pages``; a narrow job."""
    selected = pages.select(key, url, html)
    kinds = [f.dataType.simpleString() for f in selected.schema]

    def make():
        def run(keys, urls, pages_html):
            texts = [extract_text(h) for h in pages_html]
            return keys, urls, texts, [len(t) for t in texts]

        return run

    return map_columns(selected, f"`{key}` {kinds[0]}, `{url}` {kinds[1]}, text string, n_chars long", make)
