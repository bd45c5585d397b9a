"""Operator 6: main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams events; block-level tags cut the page into lines. Each
line has a ratio of text outside links to tags, smoothed over its neighbours with a Gaussian;
two-means clustering of the smoothed ratios gives a threshold, and the lines above it choose
the content regions. A region is the element that holds chosen lines: an article or main
element, else the innermost section; its other lines, headings and short ones, come along.
Elements that say what they are (menus, footers, adverts, forms ...) have ratio 0 and are no
content; but a name or form around nearly all of the page's text says nothing, nor do the
names of ``html`` and ``body``. Short lines between chosen ones stay. Reader comments that no
element marks begin at a heading that says so and end with the element around it. If a page
has article elements, lines outside them need far higher ratios.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loam.llm.shared import settings, stage

SIGMA, REACH = 1.0, 2
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text isn't shown, and elements that never hold the article's text.
UNREAD = frozenset("head title script style noscript template svg math iframe object canvas audio video select button textarea".split())
SILENT = UNREAD | frozenset("nav footer aside form dialog menu".split())
#: Words of class, id or role that mark boilerplate, if all other words of the name are in ``PLAIN``.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead contentinfo complementary cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription "
    "signup login comment comments disqus respond reply replies pagination pager".split()
)
#: Words that may mark boilerplate or a part of the text: here the ratio of each line decides.
SOFT = frozenset("alert share sharing social related recommended widget search".split())
PLAIN = frozenset(
    "area bar block body bottom box container content footer form group header inner item items left link links list main outer page post posts right row section "
    "site slot text thread title top unit wrap wrapper on".split()
)
HEADS = frozenset(("header", "topbar", "toolbar"))
CONTENT = frozenset(("article", "main"))
SECTIONS = frozenset("article main section div td body html center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: How much less a line outside article elements weighs, if the page has any.
OUTSIDE = 16
#: Least share of a section's text that lies in chosen lines, for the section to be a region.
SHARE = 0.3
#: Clusters whose means, as roots of ratios, are nearer than this are one.
APART = 0.5
#: So many lines of links only, one after the other, are a menu.
MENU = 3
#: So many times the text left without it, and a named element or form is the page itself.
WHOLE = 4
#: Elements around a line that are remembered.
AROUND = 64
_MARK = re.compile(r"[A-Za-z]+|[0-9]+")
#: Whole lines that open the readers' part.
_READERS = re.compile(r"(?:(?:\d+|no|one)\s+(?:reader\s+)?(?:comments?|responses?|replies|reply)(?:\s+(?:to|on)\s.*)?|(?:reader\s+)?(?:comments|responses)\s*(?:\(\d+\))?|leave\s+a\s+(?:reply|comment))\s*:?", re.IGNORECASE)


def _marks(attrs: list) -> tuple[bool, bool, bool]:
    """(marked as boilerplate, perhaps boilerplate, a page header) by class, id and role."""
    hard = soft = head = False
    for k, v in attrs:
        if k not in ("class", "id", "role") or not v:
            continue
        for name in v.lower().split():
            words = set(_MARK.findall(name))
            rest = {w for w in words - MARKS - SOFT - PLAIN if not w.isdigit()}
            if not rest:
                hard |= bool(words & MARKS)
                soft |= bool(words & SOFT)
            head |= bool(words & HEADS) and not rest - HEADS
    return hard, soft, head


@dataclass
class _Line:
    text: str
    tags: int
    linked: int  # characters inside links
    hushes: tuple[int, ...]  # elements around it that say they are no content; negative: for sure
    inside: tuple[int, ...]  # all elements around it, by number
    soft: bool
    article: int  # number of the outermost article element, 0: none
    section: int  # number of the innermost section
    heading: bool


class _Lines(HTMLParser):
    """Lines of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Open elements: name, hushes here, soft here, article here, section here, number.
        self.open: list[tuple[str, tuple[int, ...], bool, int, int, int]] = []
        self.names: Counter = Counter()
        self.lines: list[_Line] = []
        self.text: list[str] = []
        self.tags = self.linked = self.articles = self.sections = self.elements = 0
        self.heading = False

    def _now(self) -> tuple[tuple[int, ...], bool, int, int]:
        return self.open[-1][1:5] if self.open else ((), False, 0, 0)

    def cut(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            hushes, soft, article, section = self._now()
            # Only blocks near the line matter: the readers' part ends with one of the elements around its heading.
            inside = tuple(e[5] for e in self.open[-AROUND:])
            self.lines.append(_Line(text, self.tags, self.linked, hushes, inside, soft, article, section, self.heading))
        self.text.clear()
        self.tags = self.linked = 0
        self.heading = False

    def _pop(self, at: int) -> None:
        for element in self.open[at:]:
            self.names[element[0]] -= 1
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        hushes, soft, article, section = self._now()
        hard, maybe, head = _marks(attrs) if tag not in ("html", "body") else (False, False, False)
        content = tag in CONTENT and not hard and not article
        sure = not content and (tag in UNREAD or tag in SILENT and tag != "form")
        hush = sure or not content and (tag == "form" or hard or ((tag in HEADS or head) and not article))
        if tag in BLOCKS or hush != bool(hushes) and (hush or maybe):
            self.cut()
        elif tag in ("br", "td", "th"):
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag in ("p", "li") and self.open and self.open[-1][0] == tag:
            self._pop(len(self.open) - 1)
            hushes, soft, article, section = self._now()
        self.elements += 1
        if content:
            # A marked article is never inside boilerplate that someone forgot to close.
            self.articles += 1
            hushes, soft, article = (), False, self.articles
        if hush and len(hushes) < AROUND:
            hushes = (*hushes, -self.elements if sure else self.elements)
        if tag in SECTIONS:
            self.sections += 1
            section = self.sections
        if tag in HEADINGS:
            self.heading = True
        self.open.append((tag, hushes, soft or maybe, article, section, self.elements))
        self.names[tag] += 1

    def handle_endtag(self, tag: str) -> None:
        at = len(self.open) - 1
        if self.names[tag] > 0:
            while self.open[at][0] != tag:
                at -= 1
            outer = self.open[at - 1][1:3] if at else ((), False)
            if tag in BLOCKS or self._now()[:2] != outer:
                self.cut()
            self.tags += 1
            self._pop(at)
        else:
            if tag in BLOCKS:
                self.cut()
            self.tags += 1

    def handle_data(self, data: str) -> None:
        if self._now()[0] and self.open[-1][0] in UNREAD:
            return
        self.text.append(data)
        if self.names["a"] > 0:
            self.linked += len(data.strip())

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...>`` of any kind is a comment up to the next ``>``."""
        return self.rawdata.find(">", i) + 1 or -1


def smoothed(ratios: np.ndarray, sigma: float = SIGMA, reach: int = REACH) -> np.ndarray:
    """Gaussian smoothing with weights that are renormalised at both ends."""
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """Border between the two clusters of one-dimensional two-means, from the extremes."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        border = (low + high) / 2
        small, large = values[values < border], values[values >= border]
        new = (float(small.mean()) if len(small) else low), (float(large.mean()) if len(large) else high)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _menus(lines: list[_Line], chosen: np.ndarray) -> np.ndarray:
    """True for lines in runs of at least ``MENU`` lines that hold hardly anything but links."""
    out, run = np.zeros(len(lines), bool), []
    for k, line in enumerate(lines):
        if line.linked >= 0.8 * len(line.text) and not chosen[k] and not line.heading:
            run.append(k)
            continue
        if len(run) >= MENU:
            out[run] = True
        run = []
    if len(run) >= MENU:
        out[run] = True
    return out


def _silent(lines: list[_Line]) -> np.ndarray:
    """Lines in elements that are no content, but for elements that are the page itself."""
    size = Counter()
    for line in lines:
        for h in line.hushes:
            size[h] += len(line.text)
    heard = sum(len(x.text) for x in lines if not x.hushes)
    whole = set()
    # From the largest: what one element gives free counts as left for those inside it.
    for h, n in sorted(size.items(), key=lambda i: (-i[1], i[0])):
        if h > 0 and n > WHOLE * heard:
            whole.add(h)
            heard += sum(len(x.text) for x in lines if h in x.hushes and whole.issuperset(x.hushes))
    return np.array([not whole.issuperset(x.hushes) for x in lines], bool)


def _readers(lines: list[_Line]) -> np.ndarray:
    """Lines from a heading of reader comments to the end of the element around it."""
    out, around, article = np.zeros(len(lines), bool), None, 0
    for k, line in enumerate(lines):
        if around is not None and (around not in line.inside or line.article != article):
            around = None
        if around is None and k and line.article and _READERS.fullmatch(line.text):
            # The heading's own element and the one around it.
            around, article = (line.inside[-2] if len(line.inside) > 1 else None), line.article
        out[k] = around is not None
    return out


def extract(html: str | None) -> list[str]:
    """Blocks of the main text, in page order."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.cut()
    lines = parser.lines
    silent = _silent(lines)
    silent |= _readers(lines)
    if silent.all():
        return []
    article, section = np.array([x.article for x in lines]), np.array([x.section for x in lines])
    ratio = np.array([max(len(x.text) - x.linked, 0) / max(1, x.tags) for x in lines]) * ~silent
    level = smoothed(ratio) * ~silent
    if (article[~silent] > 0).any():
        level = np.where(article > 0, level, level / OUTSIDE)
    # Ratios of paragraphs differ by their lengths: clusters are found in the roots.
    level = np.sqrt(level)
    heard = level[~silent]
    border = threshold(heard) if heard.max() > heard.min() else heard.max()
    low, high = heard[heard < border], heard[heard >= border]
    if len(low) and low.mean() > APART * high.mean():
        border = heard.min()
    chosen = (level >= border) & ~silent & (ratio > 0)
    # Regions: article elements with chosen lines, and sections with a fair share of their text in such lines.
    region, size = np.where(article > 0, -article, section), np.array([len(x.text) for x in lines])
    _, at = np.unique(region, return_inverse=True)
    share = np.bincount(at, size * chosen) / np.maximum(np.bincount(at, size * ~silent), 1)
    keep = (share[at] >= np.where(article > 0, 1e-9, SHARE)) & ~silent
    soft = np.array([x.soft for x in lines], bool)
    keep &= (chosen | ~soft) & ~_menus(lines, chosen)
    # Short lines between chosen ones, not links, are part of the text around them.
    ends = np.flatnonzero(keep)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        between = lines[a + 1 : b]
        if between and article[a] == article[b] and all(not silent[a + 1 + j] and not x.soft and x.article == article[a] and 2 * x.linked < len(x.text) for j, x in enumerate(between)):
            keep[a + 1 : b] = True
    for k in range(len(lines) - 2, -1, -1):  # headings right in front of a region
        if not keep[k] and lines[k].heading and not silent[k] and not soft[k] and keep[k + 1]:
            keep[k] = (article[k] > 0) == (article[k + 1] > 0)
    return [x.text for k, x in enumerate(lines) if keep[k]]


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``.

    Null and empty pages, and pages without content, have an empty text. Elements named as
    boilerplate, and forms, are silent unless without them hardly any text is left; menus, page
    footers, asides, dialogs and what isn't shown always are. Rows that repeat
    are extracted alike; empty tables give no rows; other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(extract(h)) for h in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    with settings(pages.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="500"):
        return stage(pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long"), "extracted")
