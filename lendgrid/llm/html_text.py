"""Main text of web pages: text-to-tag ratios per line, smoothed and clustered."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Fixed values of HTML: elements without an end, elements whose text is never shown, elements that break lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title iframe svg object select option button textarea datalist".split())
BREAKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements, roles and names that mark what surrounds an article.
AROUND = frozenset("nav header footer aside form menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu menubar nav navbar navigation "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent gdpr notice notices disclaimer popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist disqus respond replies".split()
)
#: A name that starts with one of these says that something is there or not, not what the element is.
SAID = frozenset("has have no not with without non is hide show".split())
SCOPES = frozenset("article main".split())
#: Elements that hold a whole page are never surroundings by their name.
PAGES = frozenset("html body main".split())
SPACE = re.compile(r"\s+")
SIGMA, REACH = 1.0, 3
#: A line belongs to a region as long as its smoothed ratio is this part of the threshold, outside and inside an article or main.
EDGES = np.array([0.1, 0.003])


def surrounds(names: str) -> bool:
    """Whether a class or id has a name, such as ``comment``, ``cookie-notice`` or ``site_footer``, that marks surroundings by its first or last word."""
    for name in names.lower().split():
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        if words and words[0] not in SAID and (words[0] in NAMES or words[-1] in NAMES):
            return True
    return False


class Lines(HTMLParser):
    """Parser events -> lines: (text, tags, open marks, number of the article or main it is in).

    A line ends at each element that breaks lines, as a browser lays text out, so pages written on
    one physical line are read like others. Tags count for the next line that has text. Only elements that end are kept on the stack; an end tag
    closes what was left open inside it, and a paragraph also ends at the next element that breaks lines.
    A mark is an element that stands for surroundings: certain, by its kind, or likely, by its name.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...], int]] = []
        self.stack: list[tuple[str, tuple[int, ...], bool, int]] = []
        self.marks, self.unseen, self.scope, self.scopes = (), False, 0, 0
        #: For each mark whether it is certain, and whether an article or main lies inside.
        self.certain: list[bool] = []
        self.holds: list[bool] = []
        self.buffer: list[str] = []
        self.tags = 0

    def parse_marked_section(self, i, report=1):
        """``<![`` of any kind is passed over, up to the next ``>`` or the end; the library raises where the kind is unknown."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def unknown_decl(self, data):
        pass

    def flush(self):
        text = SPACE.sub(" ", "".join(self.buffer)).strip()
        if text:
            self.lines.append((text, self.tags, self.marks, self.scope))
            self.tags = 0
        self.buffer = []

    def close_to(self, k: int):
        _, self.marks, self.unseen, self.scope = self.stack[k]
        del self.stack[k:]

    def handle_starttag(self, tag, attrs):
        if tag in BREAKS:
            self.flush()
            if self.stack and self.stack[-1][0] == "p":
                self.close_to(len(self.stack) - 1)
        self.tags += 1
        if tag in VOID:
            return
        certain = tag in AROUND and tag != "form" and not (tag == "header" and self.scope)
        likely = tag == "form"
        for name, value in attrs:
            if name in ("class", "id") and value and tag not in PAGES:
                likely = likely or surrounds(value)
            elif name == "role" and value and value.lower() in ROLES:
                likely = True
            elif name == "hidden":
                certain = True
        here = (tag, self.marks, self.unseen, self.scope)
        if tag in SCOPES:
            for mark in self.marks:
                self.holds[mark] = True
            if not self.scope:
                self.scopes += 1
                self.scope = self.scopes
        if certain or likely:
            self.certain.append(certain)
            self.holds.append(False)
            self.marks = (*self.marks, len(self.certain) - 1)
        self.unseen = self.unseen or tag in UNSEEN
        self.stack.append(here)

    def handle_startendtag(self, tag, attrs):
        if tag in BREAKS:
            self.flush()
        self.tags += 1

    def handle_endtag(self, tag):
        if tag in BREAKS:
            self.flush()
        self.tags += 1
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self.close_to(k)
                break

    def handle_data(self, data):
        if not self.unseen:
            self.buffer.append(data)


def surroundings(p: Lines) -> list[bool]:
    """For each line whether it is in surroundings.

    A likely mark doesn't count if an article or main lies inside it or, on a page without these, if it holds more than
    half of the text outside certain ones: then it stands for the page.
    """
    size = [len(text) for text, *_ in p.lines]
    within, total = [0] * len(p.certain), 0
    for n, (_, _, marks, _) in zip(size, p.lines):
        if not any(p.certain[m] for m in marks):
            total += n
            for m in marks:
                within[m] += n
    counts = [sure or not (holds or not p.scopes and 2 * n > total) for sure, holds, n in zip(p.certain, p.holds, within)]
    return [any(counts[m] for m in marks) for *_, marks, _ in p.lines]


def smooth(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing with the kernel cut at ``REACH`` lines; edges count what is there."""
    kernel = np.exp(-(np.arange(-REACH, REACH + 1) ** 2) / (2 * SIGMA**2))
    full = lambda x: np.convolve(x, kernel)[REACH : REACH + len(x)]
    return full(ratios) / full(np.ones(len(ratios)))


def regions(smoothed: np.ndarray, scoped: np.ndarray) -> np.ndarray:
    """Which lines the content regions span, by two thresholds.

    The upper one is the standard deviation of the smoothed ratios, at most half the highest. A region is a run of lines
    that all reach ``EDGES`` of it and of which one reaches all of it, so the short lines of an article stay with the
    long ones near them, and a few lines of surroundings don't part it.
    """
    least = min(smoothed.std(), smoothed.max() / 2)
    inside = (smoothed >= EDGES[scoped.astype(int)] * least) & (smoothed > 0)
    run = np.cumsum(inside & ~np.concatenate(([False], inside[:-1])))
    return inside & np.isin(run, run[inside & (smoothed >= least)])


def main_text(html: str | None) -> str:
    """The text of the content regions of one page.

    Each line's ratio is its characters per tag; lines of surroundings count 0 and are never content, however they
    were smoothed. What the regions hold inside an ``article`` or ``main`` is taken if it is at least as much text as what
    they hold outside, else the latter.
    """
    p = Lines()
    p.feed(html or "")
    p.close()
    p.flush()
    away = surroundings(p)
    ratios = np.array([0.0 if a else len(text) / max(tags, 1) for (text, tags, *_), a in zip(p.lines, away)])
    if not ratios.any():
        return ""
    chosen = regions(smooth(ratios), np.array([scope > 0 for *_, scope in p.lines]))
    content = [(text, scope > 0) for (text, _, _, scope), a, take in zip(p.lines, away, chosen) if text and take and not a]
    mass = {side: sum(len(text) for text, inside in content if inside == side) for side in (False, True)}
    side = mass[True] > 0 and mass[True] >= mass[False]
    return " ".join(text for text, inside in content if inside == side)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for whole pages.

    Null, empty or markup-only html gives an empty text and 0; repeated rows and null ids stay one row
    each; other columns are not read.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
