"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing, clustering."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements that start and end a line of text.
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody tfoot thead title tr ul".split()
)
# Elements whose text is never the article's.
_DROPPED = set(
    "aside button canvas datalist dialog embed footer form head iframe input menu meter nav noscript object optgroup "
    "option output progress script search select style svg template textarea title".split()
)
_EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
_ARTICLE = {"article", "main"}
_CELLS = {"td", "th"}
# Elements that may hold the whole article.
_CONTAINERS = {"html", "body", "article", "main", "div", "section", "td", "center", "table", "tbody", "tr"}
# A start tag that ends the open element of the same kind, and how far up it is looked for.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# Words in class, id and role that mark what is around an article.
_MARKS = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|adbox|adslot|adsense|adsbygoogle|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|"
    r"notification|alert|disclaimer|popup|modal|overlay|dialog|[a-z]*sidebar|side|complementary|related|recommend\w*|"
    r"trending|popular|teasers?|widget|share|sharing|social|newsletter|subscribe|subscription|signup|signin|login|"
    r"comments?|commentary|respond|replies|discussion|disqus|[a-z]*menu|menubar|"
    r"[a-z]*nav|nav(?:bar|igation|links?|list|menu)|breadcrumbs?|pagination|pager|[a-z]*footer|contentinfo|copyright|masthead|topbar|toolbar|searchform|searchbox|search|hidden|sr-only|"
    r"skip-link)(?![a-z])"
)
_HEADERS = re.compile(r"(?:^|[^a-z])header(?![a-z])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SIGMA = 1.0
_LINES = 3
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that are a block of text themselves: a mark on one says less than its text does.
_TEXTS = _HEADINGS | {"p", "blockquote", "pre", "li", "dt", "dd", "figcaption", "caption"}


class _Lines(HTMLParser):
    """Turns parser events into lines: text, characters in links, tags, element, out by kind, by mark, or
    perhaps by mark.

    No step looks through the open elements: the places of each name are kept, so the work is in
    proportion to the page, however deep and broken its markup is.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parents, self.names = [-1], ["#page"]
        # Open elements: number, name, whether its text is out by kind or by mark, inside an article.
        self.open = [(0, "#page", False, False, False, False)]
        # Places in that list by name, and those of blocks whose text is out.
        self.places: dict[str, list[int]] = {}
        self.out_blocks: list[int] = []
        self.lines: list[tuple] = []
        self.text: list[str] = []
        self.linked, self.tags, self.links = 0, 0, 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            _, _, dropped, marked, _, doubted = self.open[-1]
            self.lines.append((text, self.linked, max(1, self.tags), self.open[-1][0], dropped, marked, doubted))
            self.tags = 0
        self.text, self.linked = [], 0

    def close_to(self, depth: int) -> None:
        # A table's cells are one line, but for one that is out.
        if any(name in _BLOCKS or name in _CELLS and marked for _, name, _, marked, *_ in self.open[depth:]):
            self.flush()
        for _, name, *_ in self.open[depth:]:
            self.links -= name == "a"
            self.places[name].pop()
        del self.open[depth:]
        while self.out_blocks and self.out_blocks[-1] >= depth:
            self.out_blocks.pop()

    def last(self, names: Iterable[str]) -> int:
        """Where the innermost open element of these names is, 0 if there is none."""
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=0)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag == "br":
            self.text.append("\n")
        elif tag in _CELLS:
            self.text.append(" ")
        if tag in _EMPTY:
            if tag in _BLOCKS:
                self.flush()
            return
        if tag in _BLOCKS:
            if depth := self.last(("p",)):  # a paragraph ends where a block begins
                self.close_to(depth)
            self.flush()
        if tag in _SIBLINGS:
            same, stop = _SIBLINGS[tag]
            if (depth := self.last(same)) > self.last(stop):
                self.close_to(depth)
        if tag in _ARTICLE and not self.open[-1][4] and self.out_blocks:
            # An article does not begin inside a menu: that was left open.
            self.close_to(self.out_blocks[0])
        _, _, dropped, marked, inside, doubted = self.open[-1]
        outside = not marked
        here = dict(attrs)
        words = _CAMEL.sub("-", " ".join(here.get(key) or "" for key in ("class", "id", "role"))).lower()
        if tag in _ARTICLE and not inside:
            inside, marked = True, False
        elif tag not in ("html", "body"):
            here_marked = bool(_MARKS.search(words)) or (not inside and bool(_HEADERS.search(words)))
            if tag in _TEXTS and inside:
                doubted = doubted or here_marked
            else:
                marked = marked or here_marked
        gone = "hidden" in here or here.get("aria-hidden") == "true" or "display:none" in (here.get("style") or "").replace(" ", "")
        dropped = dropped or tag in _DROPPED or gone or (tag == "header" and not inside)
        if marked and outside and tag not in _BLOCKS:
            if tag in _CELLS:
                self.flush()
            else:
                dropped = True  # inside a line: the line goes on without it
        self.links += tag == "a"
        self.parents.append(self.open[-1][0])
        self.names.append(tag)
        self.places.setdefault(tag, []).append(len(self.open))
        if dropped and tag in _BLOCKS:
            self.out_blocks.append(len(self.open))
        self.open.append((len(self.names) - 1, tag, dropped, marked, inside, doubted))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if depth := self.last((tag,)):
            self.close_to(depth)
        elif tag == "p":
            self.flush()

    def handle_data(self, data: str) -> None:
        if self.open[-1][2]:
            return
        self.text.append(data)
        if self.links:
            self.linked += len(data)


def _smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(np.ceil(2 * sigma)))
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    weight = np.convolve(np.ones(len(values)), kernel)[reach:-reach]
    return np.convolve(values, kernel)[reach:-reach] / weight


def _threshold(values: np.ndarray) -> float:
    """The value between the two clusters of a list of numbers; their least if they do not differ."""
    low, high = float(values.min()), float(values.max())
    if high - low < 1e-9:
        return low
    while True:
        upper = values > (low + high) / 2
        new = float(values[~upper].mean()), float(values[upper].mean())
        if new == (low, high):
            return (low + high) / 2
        low, high = new


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The article of one page, a line per block; empty if there is none."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = [line for line in parser.lines if not line[4] and not line[5]]
    # Marks are only names: where they cover everything, they say nothing.
    lines = lines or [line for line in parser.lines if not line[4]]
    if not lines:
        return ""
    chars = np.array([len(text) - min(linked, len(text)) for text, linked, *_ in lines], dtype=float)
    tags = np.array([line[2] for line in lines], dtype=float)
    plain = np.log1p(chars / tags)
    ratio = _smoothed(plain, sigma)
    limit = _threshold(ratio)
    content = ratio >= limit
    # A line that its neighbours alone lift into the upper cluster does not stand for itself.
    alone = content & (plain >= limit)
    # The region: the article and main elements, if they hold most of the content's characters; else the
    # innermost container of several lines that does: a long paragraph is not a region.
    parents = parser.parents
    held, count = np.zeros(len(parser.names)), np.zeros(len(parser.names))
    elements = [line[3] for line in lines]
    np.add.at(held, elements, chars * content)
    np.add.at(count, elements, 1)
    for e in range(len(held) - 1, 0, -1):
        held[parents[e]] += held[e]
        count[parents[e]] += count[e]
    within = np.zeros(len(held), dtype=bool)
    for e in range(1, len(held)):
        within[e] = within[parents[e]] or parser.names[e] in _ARTICLE
    tops = [e for e in range(1, len(held)) if within[e] and not within[parents[e]]]
    article = bool(tops) and 2 * held[tops].sum() > held[0]
    regions = tops if article else [0]
    if not article:
        # Each holds more than half, so these are nested; inner ones come later.
        for e in range(1, len(held)):
            if 2 * held[e] > held[0] and count[e] >= _LINES and parser.names[e] in _CONTAINERS:
                regions = [e]
    inside = np.zeros(len(held), dtype=bool)
    inside[regions] = True
    for e in range(1, len(held)):
        inside[e] |= inside[parents[e]]
    own = np.array([inside[line[3]] for line in lines])
    if not article:
        # Outside the region the clusters decide, and headings go with what they stand above.
        own |= alone
        for k in range(len(lines) - 2, -1, -1):
            own[k] |= own[k + 1] and parser.names[lines[k][3]] in _HEADINGS
    own &= (plain >= limit) | ~np.array([line[6] for line in lines])
    # Lists of links are menus, named or not: lines of hardly anything but links, two or more in a
    # row, in a part of the page with little text.
    menu = (chars <= 0.1 * np.array([len(line[0]) for line in lines])) & ~content
    beside = np.concatenate([[False], menu, [False]])
    menu &= beside[:-2] | beside[2:]
    return "\n".join(line[0] for line, keep in zip(lines, own & ~menu) if keep)


def extract_pages(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", sigma: float = SIGMA
) -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars (code points).

    A page is read once, as a stream of parser events that makes one line of each block. Each line
    has a text-to-tag ratio (characters outside links, per tag); the ratios are smoothed with a
    Gaussian and parted into two clusters. The region is the article and main elements, if they hold
    most characters of the upper cluster, or else the innermost container of several lines that does. The
    text is that of all blocks of the region in page order, short ones too. Outside an article's region
    nothing is kept; outside a container's, lines that belong to the upper cluster by themselves, and
    headings above kept lines, are. Elements that
    are never an article's (menus, forms, ...) or that hold blocks and are named like them are left out,
    and so are runs of links. A paragraph of an article that is so named is left out if its own ratio is
    in the lower cluster.

    A null or empty page, and one without text, has an empty text. Very long and deeply nested or broken
    pages are read in time proportional to their length. Repeated rows give equal results. Other columns
    are ignored. An empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(x.as_py(), sigma) for x in part.column(2)]
                counts = pa.array([len(text) for text in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), counts],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
