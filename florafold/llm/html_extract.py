"""HTML extraction: flat text blocks classified by a decision tree.

A page is cut at block-level tags into flat text blocks. A block's features are
its word count and link density, those of the blocks before and after it, and
what stands around it (an article or main element; a menu, header, footer,
sidebar or form; a class or id that names adverts, notices, comments and the
like; a heading tag). A decision tree, grown on the small labelled table below,
says which blocks are main text.

What stands around a block counts for everything in it, with these exceptions.
A name such as ``has-sidebar``, ``no-sidebar`` or ``page-with-menu`` says what an
element has, not what it is. A form around the page and names of a layout that are
part of a longer name (``sidebar-right``) end at an article or main element inside;
at a main element all menus, sidebars and the like around it end. Without such
elements, names of the second kind do not count where they stand around more than half of
the page's words. Adverts, comments and other parts that are never main text go on; an
inline element so named is cut out of its block.

Character references are decoded in each run of text between tags. In a tag, quotes
count where a value begins, as in ``x="a>b"``, and nowhere else.

One pass over each page, in the task that read it; no exchange.

Edge cases: null or empty html gives an empty text. Unclosed comments, scripts
and styles run to the end of the page; an unclosed tag is text. Repeated rows
get equal results. Other columns pass through; those named like an output column
are replaced.
"""

from __future__ import annotations

import html as _html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after",
            "article", "chrome", "hint", "heading")

#: Labelled blocks: the features in the order above, then 1 for main text.
TRAINING = """
  9 0    8 1    40 0   1 0 0 1  1
 48 0    9 0    61 0   1 0 0 0  1
  1 0   48 0     3 0   1 0 0 0  1
  2 0    1 0    90 0   1 0 0 0  1
 77 .05 30 0    20 0   1 0 0 0  1
 12 .6  70 0    65 0   1 0 0 0  1
  3 1   40 0    52 0   1 0 0 0  1
  5 0    0 0     0 0   1 0 0 0  1
  1 0    0 0     0 0   1 0 0 1  1
 33 0    6 1     7 0   1 0 0 0  1
 64 0    1 1     5 1   0 0 0 0  1
 30 0   12 0    44 .1  0 0 0 0  1
 18 .1  55 0    60 0   0 0 0 0  1
  7 0   40 0    52 0   0 0 0 0  1
  6 0    2 1    58 0   0 0 0 1  1
 95 0   25 0     4 1   0 0 0 0  1
 22 0   31 0     0 0   0 0 0 0  1
 11 0   60 0    30 0   0 0 0 0  1
  1 1    1 1     1 1   0 1 0 0  0
  1 1    0 0     1 1   0 1 0 0  0
  2 1    1 1     9 0   0 0 0 0  0
  1 1    1 1    30 0   0 0 0 0  0
  3 1    4 1     2 1   0 0 0 0  0
  4 .9   2 1     3 1   0 0 0 0  0
  9 0    1 1     8 0   0 0 1 0  0
 60 0    1 1     8 0   0 0 1 0  0
 25 .2  70 0    40 0   1 0 1 0  0
 40 0   50 0    40 0   1 0 1 0  0
  3 0   30 0    40 0   1 0 1 0  0
  5 0   30 0    40 0   1 0 1 1  0
 12 0   30 0     0 0   0 1 0 0  0
 45 0   30 0     0 0   0 1 0 0  0
 70 .1  30 0    12 0   0 1 0 0  0
  8 .5  60 0     0 0   0 1 0 0  0
 20 0   40 0    30 0   1 1 0 0  0
  2 0    3 0     4 0   1 1 0 0  0
  3 0    1 1     2 1   0 1 0 1  0
  4 0    0 0     3 0   0 1 1 0  0
  2 0    2 1     1 1   0 0 0 0  0
  3 0    0 0     1 1   0 0 0 0  0
  4 0    3 0     0 0   0 0 0 0  0
  2 0    3 0     2 0   0 0 0 0  0
  1 1    1 1    60 0   0 1 0 0  0
  3 0    2 0    70 0   0 1 0 0  0
  5 .4  60 0    50 0   0 1 0 0  0
 16 0   52 0    88 0   0 1 0 0  0
 20 .1  44 0    46 0   1 1 0 0  0
  4 0   10 0    75 0   0 1 0 1  0
 12 0    1 1    80 0   0 0 1 0  0
 14 0    6 0    55 0   0 0 1 0  0
 30 0   50 0    55 0   0 0 1 0  0
  6 0    3 0    90 0   1 0 1 0  0
 15 0   45 0    60 0   1 0 1 0  0
  2 1    5 0    66 0   0 1 1 0  0
  4 0    1 1     8 0   0 0 0 1  1
  7 0    2 1    12 0   0 0 0 1  1
  5 0    0 0     9 0   0 0 0 1  1
  3 0   30 0    29 0   0 0 0 1  1
  2 0   44 0     9 0   0 0 0 1  1
  4 0   30 0     1 1   0 0 0 0  1
  6 0   52 0     2 1   0 0 0 0  1
  1 0   29 0     4 0   0 0 0 0  1
  3 0   25 0    40 0   0 0 0 0  1
  5 0   70 0     3 0   0 0 0 0  1
  8 0    4 0    30 0   0 0 0 0  1
  8 0    5 0    50 0   0 0 0 0  1
 29 0    3 0     1 0   0 0 0 0  1
 40 0    5 0     2 0   0 0 0 0  1
 35 0    4 0     6 0   0 0 0 0  1
  2 0   20 0     3 1   0 0 0 1  0
  2 0    4 0     1 1   0 0 0 1  0
  2 0    1 1     1 1   0 0 0 1  0
  3 0    1 1     0 0   0 0 0 0  0
  6 0    2 1     0 0   0 0 0 0  0
  2 0    1 1     4 0   0 0 0 0  0
"""

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|select)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<attr>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>", re.S | re.I)
_BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody
td tfoot th thead title tr ul button""".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_CHROME = set("nav header footer aside form menu head title button dialog".split())
_NAMED = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))", re.I)
_HINT = re.compile(
    r"(?<![a-z])(?:(?P<layout>side|sidebar|menu|nav\w*|header|footer|masthead|toolbar|banner|search)|ads?|advert\w*|sponsor\w*|promo\w*|"
    r"cookies?|consent|notice|popup|modal|newsletter|subscribe|breadcrumbs?|comments?|commentlist|disqus|replies|reply|respond|"
    r"share|sharing|social|related|recommend\w*|widget|login|signup|contentinfo|complementary)(?![a-z])", re.I)
_HAS = re.compile(r"(?<![a-z])(?:has|no|with|without)(?![a-z])", re.I)

#: How far chrome and hints reach: up to an article or main element, up to main, or to all that is inside.
UP_TO_ARTICLE, UP_TO_MAIN, ALL = 1, 2, 3


def _hint(attr: str) -> int:
    """0, or how far the class, id, role or label of a tag makes its content something else than main text."""
    reach = 0
    for m in _NAMED.finditer(attr):
        for token in (m[1] or m[2] or m[3] or "").split():
            for h in _HINT.finditer(token):
                if not _HAS.search(token, 0, h.start()):
                    reach = max(reach, ALL if not h["layout"] else UP_TO_MAIN if h[0] == token else UP_TO_ARTICLE)
    return reach


@dataclass
class Block:
    text: str
    features: list[float]


@dataclass(frozen=True)
class Around:
    """What stands around a place: an article, chrome and hints with their reach, layout names, an inline part to be cut out."""

    article: bool = False
    chrome: int = 0
    hint: int = 0
    layouts: tuple[int, ...] = ()
    cut: bool = False


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page with their features."""
    raw: list[tuple[str, int, int, Around, bool]] = []  # text, words, words in links, what stands around, heading
    outside = Around()
    stack: list[tuple[str, Around]] = []
    around = outside
    heading = False
    parts: list[str] = []
    linked: list[str] = []
    in_link = 0
    layouts = 0

    def flush():
        text = " ".join("".join(parts).split())
        if text:
            raw.append((text, len(text.split()), len(" ".join(linked).split()), around, heading))
        parts.clear()
        linked.clear()

    def put(text: str):
        if text and not around.cut:
            text = _html.unescape(text)
            parts.append(text)
            if in_link:
                linked.append(text)

    at = 0
    for m in _TAG.finditer(page):
        put(page[at:m.start()])
        at = m.end()
        name = (m.group("name") or "").lower()
        if not name:
            continue
        if name == "br":
            put(" ")
            continue
        if name in _BLOCK:
            flush()
            heading = False
        if name == "a":
            in_link = 0 if m.group("close") else 1
        if m.group("close"):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        elif name not in _VOID and not (m.group("attr") or "").endswith("/"):
            hint = _hint(m.group("attr") or "")
            if name == "p" or name == "li":  # they end where the next one begins
                if stack and stack[-1][0] == name:
                    stack.pop()
            if name in _BLOCK or hint:
                above = stack[-1][1] if stack else outside
                article, chrome, hinted, inside = above.article, above.chrome, above.hint, above.layouts
                if name in ("article", "main"):
                    article, inside = True, ()
                    ends = UP_TO_ARTICLE if name == "article" else UP_TO_MAIN
                    chrome, hinted = (x if x > ends else 0 for x in (chrome, hinted))
                if name in ("body", "html", "article", "main"):
                    hint = 0  # these hold the page; their classes say nothing about parts
                if hint == UP_TO_ARTICLE:  # known by a number of its own until its share of the page is known
                    hint, inside, layouts = 0, (*inside, layouts), layouts + 1
                own = 0 if name not in _CHROME else UP_TO_ARTICLE if name == "form" else UP_TO_MAIN
                cut = above.cut or (hint == ALL and name not in _BLOCK)
                stack.append((name, Around(article, max(chrome, own), max(hinted, hint), inside, cut)))
            heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
        around = stack[-1][1] if stack else outside
    put(page[at:])
    flush()
    total, share = 0, [0] * layouts
    for _, words, _, r, _ in raw:
        if not r.chrome and not r.hint:
            total += words
            for k in r.layouts:
                share[k] += words
    size = [(float(w), k / w) for _, w, k, _, _ in raw]
    beside = [(0.0, 0.0), *size, (0.0, 0.0)]
    out = []
    for i, (text, _, _, r, h) in enumerate(raw):
        hint = bool(r.hint) or any(2 * share[k] <= total for k in r.layouts)
        out.append(Block(text, [*size[i], *beside[i], *beside[i + 2], *map(float, (r.article, bool(r.chrome), hint, h))]))
    return out


class Tree:
    """A binary decision tree grown by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.nodes: list[tuple] = []
        self._grow(x, y)

    def _grow(self, x: np.ndarray, y: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(("leaf", bool(y.mean() >= 0.5)))
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                impurity = sum(s.sum() * (p := y[s].mean()) * (1 - p) for s in (left, ~left))
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, cut, left)
        if best and 0 < y.mean() < 1 and best[0] < len(y) * y.mean() * (1 - y.mean()) - 1e-9:
            left = self._grow(x[best[3]], y[best[3]])
            right = self._grow(x[~best[3]], y[~best[3]])
            self.nodes[at] = ("split", best[1], best[2], left, right)
        return at

    def says(self, features: list[float]) -> bool:
        node = self.nodes[0]
        while node[0] == "split":
            node = self.nodes[node[3] if features[node[1]] <= node[2] else node[4]]
        return node[1]


def train_tree(table: str = TRAINING) -> Tree:
    rows = np.array([[float(v) for v in line.split()] for line in table.strip().splitlines()])
    return Tree(rows[:, :-1], rows[:, -1])


def main_text(page: str | None, tree: Tree) -> str:
    return "\n\n".join(b.text for b in blocks(page or "") if tree.says(b.features))


def extract_text(pages: DataFrame, html_col: str = "html", keep_html: bool = False) -> DataFrame:
    """``pages`` with text and n_chars (without the html unless ``keep_html``)."""
    kept = [f for f in pages.schema.fields if f.name not in ("text", "n_chars") and (keep_html or f.name != html_col)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", text string, n_chars bigint"
    pages = pages.select(*[f.name for f in kept if f.name != html_col], html_col)

    def extract(batches):
        tree = train_tree()
        for b in batches:
            texts = [main_text(h.as_py(), tree) for h in b.column(html_col)]
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name) for f in kept] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[f.name for f in kept] + ["text", "n_chars"])

    return pages.mapInArrow(extract, schema)
