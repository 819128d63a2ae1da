"""Main text of web pages: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks (block-level tags part them). Each block has
its word count and link density, those of the blocks before and after it, and marks of
where it stands. A decision tree trained on a labelled table decides which blocks are
main text; these are joined by two line feeds.

The tree is grown by ``grow`` (Gini impurity) when the operator is called. The default
table is a synthetic grid labelled by a written rule, not by readers. Pages are parsed map only, each on its own.

Edge cases: null html is empty and gives empty text with 0 characters; white space of
any kind inside a block becomes one space; character references are decoded; unclosed
tags, stray end tags, unclosed comments and quotes are read on to the end of the page;
a page without any main block gives empty text; repeated rows are read each; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*>|[^>]*(?:>|\Z))""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BLANK = re.compile(r"\s+")

BLOCK_TAGS = frozenset("""
address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul
""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT_TAGS = frozenset("script style noscript template textarea title select button option svg math iframe object head canvas audio video".split())
RAW_TAGS = frozenset("script style textarea title noscript template iframe".split())
BESIDE_TAGS = frozenset("nav footer aside form menu dialog".split())
MAIN_TAGS = frozenset("article main".split())
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Class names, ids and roles that mark what stands beside the main text, alone or as the
#: last word of a longer name, or as its first word before one of BESIDE_ENDS.
BESIDE_WORDS = frozenset("""
ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice
notification alert popup modal overlay sidebar sidenav widget menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer
masthead topbar comment comments disqus reply replies respond share sharing social related recommended newsletter subscribe signup login
search skip copyright complementary contentinfo
""".split())
BESIDE_ENDS = frozenset("list links link buttons button icons form posts articles items box bar block area slot unit inner top bottom left right".split())
#: Ids of sections inside the main text are anchors, but for these.
SECTION_IDS = frozenset("comments respond disqus sidebar footer newsletter".split())
#: Parts that show a wrapper around the whole page.
WRAPPER_WORDS = frozenset("with has no without wrapper container layout page".split())
#: Names of the main text, alone or as the last word of a longer name.
MAIN_WORDS = frozenset("main article post entry story content articlebody".split())
MAIN_ENDS = MAIN_WORDS | {"body", "text"}
#: Blocks of these tags in a row are measured together.
RUN_TAGS = frozenset("p li td th dd dt blockquote pre".split())
RUN_WORDS = 24
#: Scripts without spaces: two letters count as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "beside", "inside", "page_has_main", "heading")

#: The labelled table is synthetic: a grid of situations, labelled by the written rule
#: ``_label`` (no labelled pages are given). The tree can be no better than that rule;
#: pass ``extract`` a table of judged blocks to replace it.
_SIZES = (1, 3, 8, 16, 40, 150)
_NEAR = (0, 3, 16, 60)
_LINKS = (0.0, 0.3, 1.0)


def _label(words: int, links: float, before: int, links_before: float, after: int, links_after: float,
           beside: int, inside: int, page_has_main: int, heading: int) -> int:
    """The rule that labels the grid: 1 for main text."""
    if beside or page_has_main and not inside:
        return 0
    if inside:  # all of an article, its lists of links too
        return 1
    if links > 0.5:
        return 0
    full = words >= 12
    led_by, followed = before >= 12 and links_before < 0.5, after >= 12 and links_after < 0.5
    return int(followed if heading else full or led_by and followed)


@dataclass
class Node:
    """A test ``feature <= cut`` with two branches, or a leaf with a label."""
    feature: int = -1
    cut: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None
    label: int = 0


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the grid: 13,824 rows whatever the input."""
    places = [(1, 0, 0), (1, 0, 1), (1, 1, 1), (0, 1, 1), (0, 0, 1), (0, 0, 0)]
    rows = [(w, d, b, db, a, da, *place, h)
            for w in _SIZES for d in _LINKS for b in _NEAR for db in (0.0, 1.0) for a in _NEAR for da in (0.0, 1.0) for place in places for h in (0, 1)]
    return np.array(rows, float), np.array([_label(*r) for r in rows])


def grow(x: np.ndarray, y: np.ndarray, min_rows: int = 1) -> Node:
    """The tree whose every test lowers the Gini impurity most; ties by feature order,
    then by the lower cut; cuts lie midway between two values."""
    share = y.mean() if len(y) else 0.0
    best = None
    if 0 < share < 1:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= cut
                if min(low.sum(), (~low).sum()) < min_rows:
                    continue
                impurity = sum(m.sum() * y[m].mean() * (1 - y[m].mean()) for m in (low, ~low))
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, float(cut), low)
    if best is None:
        return Node(label=int(share >= 0.5))
    _, f, cut, low = best
    return Node(f, cut, grow(x[low], y[low], min_rows), grow(x[~low], y[~low], min_rows))


def classify(node: Node, features: tuple) -> int:
    while node.feature >= 0:
        node = node.low if features[node.feature] <= node.cut else node.high
    return node.label


def _size(text: str) -> int:
    """Words, and half the letters of scripts without spaces."""
    n = len(text.split())
    return n if text.isascii() else max(n, len(_UNSPACED.findall(text)) // 2)


def _is_beside(words: list[str]) -> bool:
    return words[-1] in BESIDE_WORDS or words[0] in BESIDE_WORDS and words[-1] in BESIDE_ENDS


def _marks(tag: str, attributes: str, within: bool) -> tuple[bool, bool]:
    """Does the element begin something beside the main text, or the main text? ``within``:
    it stands inside the main text."""
    beside, inside = tag in BESIDE_TAGS, tag in MAIN_TAGS
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id", "role") and tag not in ("body", "html"):
                for part in value.split():
                    words = [w for w in re.split(r"[-_]+", part) if w]
                    if not words or not WRAPPER_WORDS.isdisjoint(words):
                        continue
                    if tag in MAIN_TAGS:
                        beside = beside or part == "comment"
                    elif name == "id" and (tag in HEADING_TAGS or tag == "section" and within and part not in SECTION_IDS):
                        continue
                    elif _is_beside(words):
                        beside = True
                    elif tag in ("div", "section", "td") and (words[0] in MAIN_WORDS if len(words) == 1 else words[-1] in MAIN_ENDS and not MAIN_WORDS.isdisjoint(words)):
                        inside = True
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                beside = True
    return beside, inside


def blocks_of(page: str) -> list[tuple[str, int, int, bool, bool, bool, str]]:
    """(text, words, words in links, beside, inside, heading, tag of RUN_TAGS or "") of the page's blocks in order."""
    out: list[tuple[str, int, int, bool, bool, bool, str]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, beside, inside; with what they inherit
    text: list[str] = []
    link_words = 0
    links = silent = 0
    heading = False
    beside = inside = False

    def flush() -> None:
        nonlocal link_words
        if text:
            joined = _BLANK.sub(" ", "".join(text)).strip()
            if joined:
                n = _size(joined)
                tag = next((t for t, _, _ in reversed(stack) if t in BLOCK_TAGS), "")
                out.append((joined, n, min(link_words, n), beside, inside, heading, tag if tag in RUN_TAGS else ""))
            text.clear()
        link_words = 0

    def say(raw: str) -> None:
        nonlocal link_words
        if raw and not silent:
            raw = unescape(raw) if "&" in raw else raw
            text.append(raw)
            if links:
                link_words += _size(raw)

    at, end = 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:-3])
            continue
        tag, closes = m[2].lower(), bool(m[1])
        if tag in BLOCK_TAGS:
            flush()
        elif tag == "br" or tag == "img":
            say(" ")
        if closes:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if depth >= 0:
                for t, _, _ in stack[depth:]:
                    links -= t == "a"
                    silent -= t in SILENT_TAGS
                del stack[depth:]
                beside, inside = stack[-1][1:] if stack else (False, False)
                heading = any(t in HEADING_TAGS for t, _, _ in stack)
            continue
        if tag in VOID_TAGS or m[3].endswith("/>") and tag in ("svg", "path", "use"):
            continue
        if tag in RAW_TAGS:
            close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        if tag in ("p", "li") or tag in HEADING_TAGS:  # they end an open paragraph or item, and links left open in it
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ("ul", "ol") if tag == "li" else stack[i][0] in BLOCK_TAGS and stack[i][0] != "p":
                    break
                if stack[i][0] == ("li" if tag == "li" else "p"):
                    for t, _, _ in stack[i:]:
                        links -= t == "a"
                        silent -= t in SILENT_TAGS
                    del stack[i:]
                    break
            beside, inside = stack[-1][1:] if stack else (False, False)
        own_beside, own_inside = _marks(tag, m[3], inside)
        if tag == "header":
            own_beside = own_beside or not inside
        beside, inside = beside or own_beside, inside or own_inside
        stack.append((tag, beside, inside))
        links += tag == "a"
        silent += tag in SILENT_TAGS
        heading = tag in HEADING_TAGS or heading and tag not in BLOCK_TAGS
    flush()
    return out


def _measured(blocks: list[tuple]) -> list[tuple[int, float]]:
    """Words and link density of each block; short blocks of one tag in a row, none of them
    mostly links, have their words together where these are RUN_WORDS or more."""
    size = [(b[1], b[2] / max(b[1], 1)) for b in blocks]
    lo = 0
    while lo < len(blocks):
        hi = lo + 1
        if blocks[lo][6] and not blocks[lo][3] and size[lo][1] <= 0.5:
            while hi < len(blocks) and blocks[hi][3:] == blocks[lo][3:] and size[hi][1] <= 0.5:
                hi += 1
            total = sum(n for n, _ in size[lo:hi])
            if total >= RUN_WORDS:
                size[lo:hi] = [(total, d) for _, d in size[lo:hi]]
        lo = hi
    return size


def main_text(page: str, tree: Node) -> str:
    blocks = blocks_of(page)
    marked = sum(b[1] for b in blocks if b[4] and not b[3])
    has_main = marked > 0 and 2 * marked >= sum(b[1] for b in blocks if not b[3])
    size = [(0, 0.0), *_measured(blocks), (0, 0.0)]
    return "\n\n".join(b[0] for i, b in enumerate(blocks)
                       if classify(tree, (*size[i + 1], *size[i], *size[i + 2], b[3], b[4], has_main, b[5])))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            table: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page; n_chars counts code points.

    ``table`` is the labelled table as (features in the order of FEATURES, labels of 0
    and 1); it is held by the driver, so keep it small. By default the synthetic grid.
    """
    tree = grow(*(table or labelled()))
    schema = T.StructType([T.StructField("page_id", pages.schema[id_col].dataType), T.StructField("url", pages.schema[url_col].dataType),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = [main_text(h.as_py() or "", tree) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(run, schema)
