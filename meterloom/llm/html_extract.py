"""Main text of HTML pages by text-to-tag ratios over parser events.

The standard library's parser streams through a page; block boundaries in its events end a line.
A line's text-to-tag ratio is its text outside links over its tags. The ratios are smoothed by a
Gaussian over neighbouring lines, and clustered by a threshold, their standard deviation: lines at or
above it are seeds of content. The region is the articles (or main parts) that hold the
seeds, where a page names them and they hold at least half of the seeds' text; else the smallest
container with most of the seeds' text. A region is kept whole, short paragraphs too, but for what
a page marks as something else: menus, headers, footers, sidebars, notices, adverts, forms,
comments. Such parts are known by element, role, or words of class and id; their lines have ratio
zero. Headings inside an article's header stay.

Text: character references are decoded, white space (a line break element too) becomes one space,
blocks are joined by line feeds. Whole pages are read; time and memory are linear in a page.

Defined results: null or empty html, or a page without text, gives an empty text; broken markup
(open elements, comments or tags at the end) is read as far as it goes; rows are handled one by one,
so repeated rows give equal rows, null ids and urls are passed through, and an empty table gives no
rows; only the named columns are read, so others may have any name."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import str_texts

# HTML elements by what they do.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
UNSEEN = frozenset(
    "audio button canvas datalist head iframe map math noscript object optgroup option script select "
    "style svg template textarea title video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CHROME = frozenset("aside dialog footer form header menu nav search".split())
CHROME_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
CHROME_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disqus footer gdpr header login masthead menu menubar "
    "modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup "
    "promo promotion reactions recommended related replies respond share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Words that turn the next one around, as in with-sidebar.
LAYOUT_WORDS = frozenset("has no with without".split())
COMMENT_HEADING = re.compile(
    r"\(?\d*\)?\s*(reader |user |leser)?"
    r"(comments?|kommentare?|commentaires?|comentarios?)\s*[:(]?\s*\d*\)?:?",
    re.IGNORECASE,
)
WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


@dataclass(frozen=True)
class Rules:
    """Gaussian over `reach` lines on both sides; a container is entered if it holds `share` of the
    seeds' text."""

    reach: int = 2
    sigma: float = 1.0
    share: float = 0.7


@dataclass
class Line:
    text: str
    linked: int
    tags: int
    path: tuple[int, ...]
    article: int
    chrome: bool


@dataclass
class Open:
    """An element that is open: hides its text, is no content, is (or lies in) an article."""

    tag: str
    number: int
    unseen: bool = False
    chrome: bool = False
    header: bool = False
    article: int = 0


@dataclass
class Piece:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    tags: int = 0


def is_chrome(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element says that it is no content."""
    if tag in CHROME or attrs.get("role", "").strip().lower() in CHROME_ROLES:
        return True
    if tag in ("html", "body", "main"):
        return False
    for value in (attrs.get("class", ""), attrs.get("id", "")):
        before = ""
        for word in map(str.lower, WORD.findall(value)):
            if word in CHROME_WORDS and before not in LAYOUT_WORDS:
                return True
            before = word
    return False


def is_hidden(attrs: dict[str, str]) -> bool:
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or "display:none" in style or "visibility:hidden" in style


class Lines(HTMLParser):
    """Collects the lines of a page from its events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Open] = []
        self.count = 0
        self.links = 0
        self.heading = ""
        self.piece = Piece()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """<![...> is a comment in HTML; the inherited method raises an error for unknown names."""
        return self.parse_bogus_comment(i)

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers of the source are not needed."""
        return j

    def _inside(self) -> Open | None:
        return self.open[-1] if self.open else None

    def _end_line(self) -> None:
        piece, self.piece = self.piece, Piece()
        text = " ".join("".join(piece.parts).split())
        if not text:
            self.piece.tags = piece.tags
            return
        here = self._inside() or Open("", 0)
        chrome = here.chrome or (here.header and not (self.heading and here.article))
        if self.heading and self.heading != "h1" and COMMENT_HEADING.fullmatch(text):
            here.chrome = chrome = True  # what follows in this container are comments
        path = tuple(o.number for o in self.open)
        self.lines.append(Line(text, piece.linked, piece.tags, path, here.article, chrome))

    def _push(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("article", "main"):  # what was left open before a page's main part ends here
            while self.open and self.open[-1].tag in ("nav", "header", "footer", "ul", "ol", "menu"):
                self.open.pop()
        outer = self._inside() or Open("", 0)
        self.count += 1
        new = Open(tag, self.count, outer.unseen, outer.chrome, outer.header, outer.article)
        new.unseen |= tag in UNSEEN or is_hidden(attrs)
        if tag == "header" and outer.article:
            new.header = True
        else:
            new.chrome |= is_chrome(tag, attrs)
        if not new.chrome and (tag == "article" or attrs.get("itemprop") == "articleBody"):
            new.article = outer.article or self.count
        elif tag == "main" or attrs.get("role") == "main":
            new.article = outer.article or -self.count
        self.open.append(new)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag in BLOCKS
        if block:
            self._end_line()
            self.heading = tag if tag in HEADINGS else ""
            here = self._inside()
            if here is not None and (here.tag == "p" or here.tag in HEADINGS or here.tag == tag in NO_CONTAINERS):
                self.open.pop()
        self.piece.tags += 1
        if tag == "br":
            self.piece.parts.append(" ")
        if tag == "a":
            self.links = 1
        # Paragraphs, list items and the like end without a tag of their own; they hold no state.
        if tag not in VOID and (tag in UNSEEN or block and tag not in NO_CONTAINERS or _marked(tag, attrs)):
            self._push(tag, {k: v or "" for k, v in reversed(attrs)})

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in UNSEEN:  # <script/> opens a script, but an empty shape of a drawing ends
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
            self.heading = ""
        self.piece.tags += 1
        if tag == "a":
            self.links = 0
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break
            if self.open[k].tag in ("article", "main", "body") and tag not in ("article", "main", "body", "html"):
                break  # a stray end tag does not close an article

    def handle_data(self, data: str) -> None:
        here = self._inside()
        if here is not None and here.unseen:
            return
        self.piece.parts.append(data)
        if self.links:
            self.piece.linked += len(data.strip())

    def close(self) -> None:
        super().close()
        self._end_line()


#: Blocks that often stay open; what follows them closes them, so they are no containers.
NO_CONTAINERS = frozenset("dd dt h1 h2 h3 h4 h5 h6 hr html li p td th tr".split())


def _marked(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether an element that is no container (a span or a paragraph) says that it is something
    else than content. Such elements must be closed, so they count only where that is usual."""
    if tag in BLOCKS and tag not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6") or not attrs:
        return False
    named = {k: v or "" for k, v in attrs}
    return is_hidden(named) or is_chrome(tag, named)


def whole(html: str) -> str:
    """A page without a comment or a tag that is open at its end. The parser would read the former as
    text, and would look for an end after each of many open ones."""
    at = html.rfind("<!--")
    while at >= 0 and html.find("-->", at + 2) < 0:
        script = html.rfind("<script", 0, at)
        if script >= 0 and html.find("</script", script, at) < 0:
            break  # a string in a script
        html = html[:at]
        at = html.rfind("<!--")
    end = html.rfind(">") + 1
    cut = re.compile(r"<[a-zA-Z/!?]").search(html, end)
    return html[: cut.start()] if cut else html


def smoothed(ratios: np.ndarray, rules: Rules) -> np.ndarray:
    """Weighted means over neighbouring lines; at the ends over those that are there."""
    steps = np.arange(-rules.reach, rules.reach + 1)
    weights = np.exp(-(steps**2) / (2 * rules.sigma**2))

    def summed(values: np.ndarray) -> np.ndarray:
        return np.convolve(values, weights)[rules.reach : rules.reach + len(values)]

    return summed(ratios) / summed(np.ones(len(ratios)))


def content(lines: list[Line], rules: Rules = Rules()) -> list[Line]:
    """The lines of the content region."""
    if not lines:
        return []
    chars = np.array([0 if x.chrome else max(0, len(x.text) - x.linked) for x in lines], float)
    scores = smoothed(chars / np.maximum(1, [x.tags for x in lines]), rules)
    seeds = (scores >= scores.std()) & ~np.array([x.chrome for x in lines])
    if not seeds.any():
        seeds = ~np.array([x.chrome for x in lines])
    weight = np.where(seeds, [len(x.text) for x in lines], 0)
    for named in (lambda x: x.article > 0, lambda x: x.article != 0):
        inside = np.array([named(x) for x in lines])
        if 2 * weight[inside].sum() >= weight.sum() > 0:
            held = {x.article for x, seed in zip(lines, seeds) if seed and x.article}
            return [x for x, i in zip(lines, inside) if i and not x.chrome and x.article in held]
    path: tuple[int, ...] = ()
    while True:
        sums: dict[int, int] = {}
        for x, w in zip(lines, weight):
            if len(x.path) > len(path) and x.path[: len(path)] == path:
                sums[x.path[len(path)]] = sums.get(x.path[len(path)], 0) + int(w)
        best = max(sums, key=sums.__getitem__, default=None)
        if best is None or sums[best] < max(1, rules.share * weight.sum()):
            break
        path = (*path, best)
    return [
        x
        for x, seed in zip(lines, seeds)
        if x.path[: len(path)] == path and not x.chrome and (seed or 2 * x.linked <= len(x.text))
    ]


def main_text(html: str, rules: Rules = Rules()) -> str:
    """The main text of a page, blocks joined by line feeds."""
    parser = Lines()
    parser.feed(whole(html))
    parser.close()
    return "\n".join(x.text for x in content(parser.lines, rules))


def extract(
    pages: DataFrame,
    rules: Rules = Rules(),
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """page_id, url, text, n_chars: one row per page."""
    slim = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    )
    kinds = ", ".join(f"{c} {slim.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t, rules) for t in str_texts(batch.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return slim.mapInArrow(read, f"{kinds}, text string, n_chars long")
