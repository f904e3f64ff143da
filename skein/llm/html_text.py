"""Main text of HTML pages from streaming parser events and text-to-tag ratios.

The standard library's parser streams events; each block of a page becomes a line
with its text, the length of its text outside links, and the number of tags that
belong to it.  Lines under elements that are no article text by their role (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments) are
left out.  Such an element outside articles is no such part if it holds an article (or
main), as layout wrappers do; nor is a form or one marked by a class, id or role if the
page has no article text and it holds most of the text outside links.  The ratios of text to tags are smoothed with a Gaussian over
neighbouring lines, and lines at or above the threshold (the standard deviation of
the smoothed ratios, at most half their maximum) form the content clusters.

A cluster names its region: the outermost article (or main) element around it, else
the element that holds its lines.  The text of a page is all lines of the named
regions in page order, short ones too, without the lines under excluded elements; if articles hold at
least half of the text outside links, just their regions count.

A name of class, id or role marks a part if it, its first or its last piece between hyphens or
underscores is a cue (`site-footer`, `comments-area`), unless it begins like `no-` or `with-`.

Narrow: one pass over the pages, no shuffle; whole pages, each in time linear in its length.  Defined
cases: a null or empty page, and one without text, has an empty text; unclosed elements end with
their parent; a comment or tag that the page's end cuts off is markup, not text, and `<![..>` ends at the
next `>`; should the parser give up on a page, the text before that place counts; other columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts

#: Standard deviation and reach of the Gaussian, in lines.
SIGMA = 1.0
REACH = 2

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 head header hgroup html li main menu nav ol p pre section summary table tbody td tfoot "
                   "th thead title tr ul".split())
#: Elements that never hold article text, and those that do only as wrappers.
EXCLUDED = frozenset("script style noscript template iframe object svg canvas select button textarea head title".split())
WRAPPERS = frozenset("nav footer aside form dialog menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLES = frozenset(("article", "main"))
#: Whole names of class, id and role that mark such parts on other elements.
CUES = frozenset("nav navbar navigation menu breadcrumb breadcrumbs footer contentinfo sidebar aside complementary ad ads advert "
                 "adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice alert "
                 "popup modal newsletter subscribe subscription signup login search social share sharing related recommended "
                 "comment comments commentlist respond reply replies disqus widget pagination pager toolbar masthead".split())
ARTICLE_CUES = frozenset("ad ads advert advertisement sponsored promo related recommended comment comments reply teaser".split())
#: First pieces of names that tell of a part elsewhere (`with-sidebar`, `no-comments`).
ELSEWHERE = frozenset("no has with without hide show".split())
#: Markup that the end of the page cuts off.
CUT_OFF = re.compile(r"<[a-zA-Z/!?]")
#: A start tag of the key closes these open elements first (implied end tags).
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}


def _marked(value: str, cues: frozenset[str]) -> bool:
    """Does a class, id or role hold a name that is a cue, or whose first or last piece is one?"""
    for name in value.lower().split():
        pieces = name.replace("_", "-").split("-")
        if name in cues or (pieces[0] not in ELSEWHERE and (pieces[0] in cues or pieces[-1] in cues)):
            return True
    return False


class _Lines(HTMLParser):
    """Turns parser events into lines: (text, characters outside links, tags, region, innermost part, inside an article).

    A part is an element that may be no article text: (the part around it, holds an article, may be kept for its text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, int, bool]] = []
        # open elements: name, number of the region, excluded, inside an article, innermost part (0 for none)
        self.open: list[tuple[str, int, bool, bool, int]] = [("", 0, False, False, 0)]
        # how many elements of a name are open: what is not open is not looked for
        self.names: Counter[str] = Counter()
        self.around: list[list] = [[0, False, False]]
        self.made = 0
        self.parts: list[str] = []
        self.plain = 0
        self.tags = 0
        # number of open elements where the open link began, 0 for none
        self.link = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                _, region, _, inside, part = self.open[-1]
                self.lines.append((text, self.plain, self.tags, region, part, inside))
                self.tags = 0
            self.parts = []
        self.plain = 0

    def _out(self, tag: str, attrs, inside: bool) -> str:
        """"" for text, "never", "wrapper" or "cue"."""
        if tag in EXCLUDED:
            return "never"
        plain = tag in ("html", "body", "main")
        if attrs and not plain and any(n == "hidden" or (n == "aria-hidden" and v == "true") for n, v in attrs):
            return "never"
        if tag == "form":
            return "cue"
        if tag in WRAPPERS or (tag == "header" and not inside):
            return "wrapper"
        if not attrs or plain:
            return ""
        cues = ARTICLE_CUES if tag == "article" else CUES
        return "cue" if any(n in ("class", "id", "role") and v and _marked(v, cues) for n, v in attrs) else ""

    def _close(self, at: int) -> None:
        """Close the open elements from place `at` on."""
        self.flush()
        self.names.subtract(e[0] for e in self.open[at:])
        del self.open[at:]
        if self.link > len(self.open):
            self.link = 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        block = tag in BLOCKS
        if block:
            self.flush()
            if self.open[-1][0] in ("p", *HEADINGS):
                self._close(len(self.open) - 1)
            for name in _CLOSES.get(tag, ()):
                if self.open[-1][0] == name:
                    self._close(len(self.open) - 1)
        if tag == "body" and self.names["head"] > 0:
            for i, e in enumerate(self.open):
                if e[0] == "head":
                    self._close(i)
                    break
        if tag == "a":
            # an open link ends at the next; an anchor without an address is none
            self.link = len(self.open) if any(n == "href" for n, _ in attrs) else 0
        _, region, excluded, inside, part = self.open[-1]
        out = self._out(tag, attrs, inside)
        if not (block or out):
            return
        if self.parts:
            self.flush()
        self.made += 1
        # inside an article's own header only its headings are article text
        article_header = tag == "header" and inside
        in_header = inside and self.names["header"] > 0
        if in_header and block and tag not in HEADINGS:
            out = "never"
        elif article_header:
            out = ""
        # inside an article all lines are its own; lines of a paragraph belong to the element around it
        own_region = region if inside or tag == "p" or tag in HEADINGS else self.made
        if out in ("wrapper", "cue") and not excluded:
            self.around.append([part, False, out == "cue" and not inside])
            part = len(self.around) - 1
        begins = tag in ARTICLES and not excluded and not out
        if begins and not inside:
            p = part
            while p and not self.around[p][1]:
                self.around[p][1] = True
                p = self.around[p][0]
        self.open.append((tag, own_region, excluded or out == "never", inside or begins, part))
        self.names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.link = 0
        if self.names[tag] > 0:
            i = len(self.open) - 1
            while self.open[i][0] != tag:
                i -= 1
            self._close(i)
        elif tag in BLOCKS:
            self.flush()

    def parse_marked_section(self, i, report=1):
        """`<![..` is a comment up to the next `>` in HTML, whatever its keyword."""
        return self.rawdata.find(">", i + 3) + 1 or -1

    def read(self, html: str) -> None:
        """All events of a page; markup that its end cuts off is dropped."""
        try:
            self.feed(html)
            if CUT_OFF.match(self.rawdata):
                self.rawdata = ""
            self.close()
        except (AssertionError, ValueError):
            pass  # the parser gives up here: what came before counts
        self.flush()

    def handle_data(self, data):
        if self.open[-1][2]:
            return
        if not self.link:
            self.plain += len(data)
        self.parts.append(data)


def _kept(parser: _Lines) -> list[tuple[str, int, int, int, bool]]:
    """The lines (text, characters outside links, tags, region, inside an article) under no excluded part; a line takes
    on the tags of the excluded ones before it."""
    around, lines = parser.around, parser.lines
    plain = [0] * len(around)
    for line in lines:
        plain[line[4]] += line[1]
    for i in range(len(around) - 1, 0, -1):  # parts come after those around them
        plain[around[i][0]] += plain[i]
    total = sum(line[1] for line in lines)

    def excluded(most: bool) -> list[bool]:
        out = [False] * len(around)
        for i in range(1, len(around)):
            up, holds, may = around[i]
            out[i] = out[up] or not (holds or (most and may and 2 * plain[i] > total))
        return out

    out = excluded(False)
    if not any(inside and not out[part] and n for _, n, _, _, part, inside in lines):
        out = excluded(True)
    kept, tags = [], 0
    for text, n, t, region, part, inside in lines:
        tags += t
        if not out[part]:
            kept.append((text, n, tags, region, inside))
            tags = 0
    return kept


def _smoothed(ratios: np.ndarray) -> np.ndarray:
    offsets = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-offsets**2 / (2 * SIGMA**2))
    return np.convolve(ratios, kernel / kernel.sum(), mode="full")[REACH:REACH + len(ratios)]


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    parser = _Lines()
    parser.read(html)
    lines = _kept(parser)
    if not lines:
        return ""
    ratios = np.array([plain / max(1, tags) for _, plain, tags, _, _ in lines])
    smooth = _smoothed(ratios)
    limit = min(float(smooth.std()), float(smooth.max()) / 2)
    named = {line[3] for line, s, r in zip(lines, smooth, ratios) if r > 0 and s >= limit}
    # where articles hold most of the text, what stands beside them is none
    in_articles = sum(n for _, n, _, _, inside in lines if inside)
    alone = 2 * in_articles >= sum(n for _, n, _, _, _ in lines) > 0
    return " ".join([text for text, _, _, region, inside in lines if region in named and (inside or not alone)])


def extract(pages: DataFrame, html_col: str = "html", drop_html: bool = True) -> DataFrame:
    """`pages` with `text` and `n_chars` (its code points)."""
    def run(rows):
        texts = [main_text(r) for r in rows]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_texts(pages, html_col, run, "text string, n_chars long", drop_text=drop_html)
