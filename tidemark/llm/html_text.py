"""Main text of web pages from flat text blocks and a learned decision tree.

A page becomes a flat list of text blocks (block-level tags end a block,
inline tags don't).  Each block has its number of words and link density,
those of its neighbours, and marks of the elements around it.  A decision
tree, fitted at first use on the small labelled table ``LABELLED``, says which
blocks are main text.

Class, id and role words mark furniture, but a word that says how a page is
laid out (``right-sidebar`` on the element around the text) mustn't lose the
text: such an element is furniture only while it holds at most half of the
page's unlinked words (``_resolve``).  ``article`` and ``main`` are marked by
a whole word such as ``comment`` only.  Hidden elements give no text.

Inside a block white space is one space, ``<br>`` included; character
references are decoded; blocks are joined in page order by an empty line.
Null and empty pages, and pages without main text, give the empty string.
Broken markup (unclosed tags, quotes or comments, cut-off pages) never raises.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

_TAG = re.compile(r"""<(?:!--|(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^"'<>]++|"[^"]*+"|'[^']*+')*+)>|(/?)([A-Za-z][A-Za-z0-9:-]*+)([^<>]*+)>|[!?][^>]*+>)""")
_ATTR = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:\shidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true)""", re.I)

#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template textarea iframe svg title select button object canvas math".split())
#: Inline elements: they don't end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that hold page furniture.
CHROME = frozenset("nav footer aside menu dialog head".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Words of class, id and role that mark page furniture, whole or as the first or last part of a compound.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice alert popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets related recommended share sharing social "
    "comment comments commentlist respond replies disqus newsletter subscribe subscription signup login search pagination pager toolbar skip copyright".split()
)
#: Those of them that also name a layout, where they stand on the element around the text.
PLACES = frozenset("banner nav navbar navigation menu header masthead footer sidebar aside widget widgets overlay modal toolbar share sharing social search".split())
#: First parts of compounds that file a post under something.
FILED = frozenset("tag category type status format".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


@dataclass
class Block:
    text: str
    words: int
    linked: int
    chrome: bool
    article: bool
    heading: bool
    marks: tuple[int, ...] = ()  # the marked elements around it

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


#: How surely an element's words mark furniture.
NONE, LAYOUT, PLACE, SURE = range(4)


def _hint(attrs: str, article: bool = False) -> int:
    """``LAYOUT``: a place in a compound; ``PLACE``: a place alone; ``SURE``: any other marked word."""
    found = NONE
    for m in _ATTR.finditer(attrs):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = re.split(r"[-_]+", name)
            if parts[0] in FILED and len(parts) > 1 or parts[0] in ("comment", "comments") and parts[-1] in ("open", "closed", "off", "enabled", "disabled"):
                continue  # says where a post is filed, or whether it can be commented on
            if any(x in ("has", "with", "no", "without", "layout") for x in parts) or parts[-1] in ("header", "title") and parts[0] in ("post", "entry", "article", "story", "content"):
                continue  # says what is beside the element, or heads the article itself
            if article and len(parts) > 1 and parts[0] not in ("comment", "comments"):
                continue
            hits = [x for x in (name, parts[0], parts[-1]) if x in HINTS]
            if hits:
                found = max(found, SURE if any(x not in PLACES for x in hits) else LAYOUT if len(parts) > 1 else PLACE)
    return found


def _resolve(found: list[Block], marks: list[int]) -> None:
    """Blocks inside a marked element are furniture, unless the element is the page's layout: a ``LAYOUT`` element,
    or a ``PLACE`` one on a page without any other article text, that holds more than half of the unlinked words."""
    if not marks:
        return
    words = [0] * len(marks)
    total = article = 0
    for b in found:
        if not b.chrome and all(marks[m] != SURE for m in b.marks):
            n = b.words - b.linked
            total += n
            article += n if b.article and not b.marks else 0
            for m in b.marks:
                words[m] += n
    furniture = [kind == SURE or 2 * n <= total or kind == PLACE and article > 0 for kind, n in zip(marks, words, strict=True)]
    for b in found:
        b.chrome = b.chrome or any(furniture[m] for m in b.marks)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    # open elements: (tag, furniture, inside an article, marked elements around)
    stack: list[tuple[str, bool, bool, tuple[int, ...]]] = [("", False, False, ())]
    marks: list[int] = []
    hidden: list[str] = []  # open tags from a hidden inline element on
    pieces: list[str] = []
    linked: list[str] = []
    in_link = 0
    heading = False

    def close() -> None:
        nonlocal heading
        text = " ".join(html_lib.unescape("".join(pieces)).split())
        if text:
            n = text.count(" ") + 1
            link = len(html_lib.unescape(" ".join(linked)).split())
            out.append(Block(text, n, min(link, n), stack[-1][1], stack[-1][2], heading, stack[-1][3]))
        pieces.clear()
        linked.clear()
        hidden.clear()

    def emit(text: str) -> None:
        if text and not hidden:
            pieces.append(text)
            if in_link:
                linked.append(text)

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            emit(page[at:])
            break
        emit(page[at:lt])
        m = _TAG.match(page, lt)
        if not m:
            emit("<")
            at = lt + 1
            continue
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        attrs = m[3] or m[6] or ""
        if m[1] or m[4]:  # an end tag
            if tag == "a":
                in_link = 0
            if tag in INLINE or tag in VOID:
                if hidden and tag in hidden:
                    del hidden[len(hidden) - 1 - hidden[::-1].index(tag) :]
                continue
            close()
            if tag in HEADINGS:
                heading = False
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        elif tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>]|$)[^>]*>?", re.I).search(page, at)
            if not attrs.endswith("/"):
                at = end.end() if end else n
        elif tag in INLINE:
            if tag == "a":
                in_link = 1
            elif tag == "br":
                emit(" ")
            elif tag == "img" or tag == "wbr":
                continue
            if tag not in VOID and not attrs.endswith("/") and (hidden or attrs and _HIDDEN.search(attrs)):
                hidden.append(tag)
        else:
            close()
            if tag == "p" or tag in HEADINGS:
                in_link = 0  # a link left open ends here
            if tag in VOID or tag == "p":
                continue  # paragraphs end at the next block: they need no place among the open elements
            if tag in HEADINGS:
                heading = True
            if attrs.endswith("/"):
                continue
            _, chrome, article, around = stack[-1]
            chrome = chrome or bool(attrs and _HIDDEN.search(attrs))
            hint = _hint(attrs, tag in ("article", "main")) if attrs else NONE
            if tag == "main" or tag == "article" and hint != SURE and not any(x[0] == "article" for x in stack):
                stack.append((tag, chrome, True, ()))  # the marks around end here
            elif tag in ("body", "html"):
                stack.append((tag, False, False, ()))
            else:
                if tag == "form":
                    hint = max(hint, LAYOUT)  # some sites have the whole page in a form
                elif tag == "header" and not article:
                    hint = SURE
                if hint != NONE:
                    marks.append(hint)
                    around = (*around, len(marks) - 1)
                stack.append((tag, chrome or tag in CHROME, article, around))
            if tag in ("article", "main", "body"):
                in_link = 0
    close()
    _resolve(out, marks)
    return out


def features(found: list[Block]) -> np.ndarray:
    """A row per block: words, link density, the neighbours' words and densities, and the marks."""
    x = np.zeros((len(found), 9))
    for i, b in enumerate(found):
        x[i, :2] = b.words, b.density
        x[i, 6:] = b.chrome, b.article, b.heading
        if i:
            x[i, 2:4] = found[i - 1].words, found[i - 1].density
        if i + 1 < len(found):
            x[i, 4:6] = found[i + 1].words, found[i + 1].density
    return x


#: The labelled table: words, link density, words and density of the previous
#: and the next block, inside furniture, inside an article, heading; main text.
LABELLED = np.array([
    [1, 1, 0, 0, 1, 1, 1, 0, 0, 0], [2, 1, 1, 1, 1, 1, 1, 0, 0, 0], [1, 1, 1, 1, 9, 0, 1, 0, 0, 0], [9, 0, 1, 1, 11, 0, 1, 0, 0, 0], [40, 0, 1, 1, 60, 0, 1, 0, 0, 0],
    [12, 0, 80, 0, 0, 0, 1, 0, 0, 0], [25, 0.1, 60, 0, 3, 0, 1, 1, 0, 0], [60, 0, 50, 0, 30, 0, 1, 1, 0, 0], [8, 0, 90, 0, 70, 0, 1, 1, 0, 0], [3, 0, 60, 0, 15, 0, 1, 1, 1, 0],
    [4, 0, 12, 0, 6, 0, 1, 0, 1, 0], [120, 0.05, 8, 0, 20, 0, 1, 0, 0, 0], [1, 0, 30, 0, 30, 0, 1, 1, 0, 0], [15, 0.9, 70, 0, 8, 1, 1, 1, 0, 0], [30, 0, 30, 0, 0, 0, 1, 1, 0, 0],
    [11, 0, 9, 0, 22, 0, 0, 1, 1, 1], [3, 0, 9, 0, 40, 0, 0, 1, 1, 1], [1, 0, 4, 0, 1, 0, 0, 1, 1, 1], [22, 0, 11, 0, 30, 0, 0, 1, 0, 1], [80, 0, 22, 0, 1, 0, 0, 1, 0, 1],
    [1, 0, 80, 0, 60, 0, 0, 1, 0, 1], [2, 0, 1, 0, 1, 0, 0, 1, 0, 1], [60, 0.1, 1, 0, 5, 0, 0, 1, 0, 1], [5, 0, 60, 0, 12, 0, 0, 1, 0, 1], [150, 0.02, 5, 0, 40, 0, 0, 1, 0, 1],
    [1, 0, 150, 0, 12, 0, 0, 1, 0, 1], [30, 0.3, 10, 0, 25, 0.2, 0, 1, 0, 1], [3, 1, 40, 0, 50, 0, 0, 1, 0, 1], [1, 1, 60, 0, 30, 0, 0, 1, 0, 1], [12, 0.5, 40, 0, 60, 0, 0, 1, 0, 1],
    [10, 0, 1, 1, 80, 0, 0, 1, 0, 1], [7, 0.9, 3, 1, 4, 1, 0, 1, 0, 1], [2, 1, 3, 1, 5, 1, 0, 1, 0, 1], [6, 1, 2, 1, 3, 1, 0, 1, 0, 1], [4, 0, 0, 0, 0, 0, 0, 1, 0, 1],
    [3, 1, 5, 0, 20, 0, 0, 1, 0, 1], [8, 1, 2, 0, 9, 0, 0, 1, 0, 1], [2, 1, 1, 0, 1, 0, 0, 1, 0, 1], [1, 1, 12, 0, 2, 0, 0, 1, 0, 1], [15, 1, 18, 0, 30, 0, 0, 1, 0, 1],
    [2, 1, 15, 0, 11, 0, 0, 0, 0, 0], [4, 1, 9, 0, 3, 0, 0, 0, 0, 0], [3, 1, 2, 1, 2, 1, 0, 0, 0, 0], [1, 1, 0, 0, 1, 1, 0, 0, 0, 0], [2, 1, 3, 1, 14, 0, 0, 0, 0, 0], [6, 0.8, 8, 1, 5, 1, 0, 0, 0, 0], [14, 0.7, 4, 1, 12, 0.8, 0, 0, 0, 0],
    [20, 0.6, 4, 1, 3, 1, 0, 0, 0, 0], [3, 0, 2, 1, 2, 1, 0, 0, 0, 0], [4, 0, 1, 1, 3, 1, 0, 0, 0, 0], [2, 0, 0, 0, 3, 1, 0, 0, 0, 0], [5, 0, 3, 1, 4, 0.5, 0, 0, 0, 0],
    [40, 0, 6, 0, 60, 0, 0, 0, 0, 1], [90, 0.05, 40, 0, 30, 0, 0, 0, 0, 1], [22, 0.1, 2, 1, 50, 0, 0, 0, 0, 1], [16, 0, 60, 0, 2, 1, 0, 0, 0, 1], [18, 0, 4, 1, 3, 1, 0, 0, 0, 1],
    [4, 0, 60, 0, 50, 0, 0, 0, 0, 1], [8, 0, 30, 0, 25, 0, 0, 0, 0, 1], [6, 0, 2, 1, 45, 0, 0, 0, 1, 1], [5, 0, 40, 0, 60, 0, 0, 0, 1, 1], [3, 0, 35, 0, 28, 0.1, 0, 0, 0, 1],
    [3, 1, 2, 1, 2, 1, 0, 1, 0, 1], [6, 0.8, 8, 1, 5, 1, 0, 1, 0, 1], [14, 0.7, 4, 1, 12, 0.8, 0, 1, 0, 1], [20, 0.6, 4, 1, 3, 1, 0, 1, 0, 1], [3, 0, 2, 1, 2, 1, 0, 1, 0, 1],
    [4, 0, 1, 1, 3, 1, 0, 1, 0, 1], [2, 0, 0, 0, 3, 1, 0, 1, 0, 1], [5, 0, 3, 1, 4, 0.5, 0, 1, 0, 1], [2, 1, 15, 0, 11, 0, 0, 1, 0, 1], [4, 1, 9, 0, 3, 0, 0, 1, 0, 1],
    [2, 0, 1, 1, 12, 0, 0, 0, 1, 1], [3, 0, 2, 1, 30, 0, 0, 0, 1, 1], [1, 0, 0, 0, 20, 0, 0, 0, 1, 1], [1, 0, 2, 1, 12, 0, 0, 0, 0, 1], [2, 0, 13, 0, 12, 0, 0, 0, 0, 1], [4, 0, 10, 0, 14, 0.1, 0, 0, 0, 1],
    [12, 0, 2, 0, 2, 1, 0, 0, 0, 1], [11, 0.05, 30, 0, 1, 1, 0, 0, 0, 1], [13, 0, 3, 0, 4, 1, 0, 0, 0, 1], [10, 0, 12, 0, 3, 0.9, 0, 0, 0, 1],
    [60, 0.2, 25, 0, 12, 0, 0, 0, 0, 1], [35, 0.3, 30, 0, 20, 0, 0, 0, 0, 1], [200, 0, 0, 0, 0, 0, 0, 0, 0, 1], [20, 0, 0, 0, 0, 0, 0, 0, 0, 1], [13, 0, 0, 0, 30, 0, 0, 0, 0, 1],
])


def fit_tree(table: np.ndarray, depth: int = 8):
    """A CART tree (Gini) over the table's last column: nested ``(feature, threshold, left, right)`` or a class."""
    x, y = table[:, :-1], table[:, -1]

    def grow(rows: np.ndarray, left_depth: int):
        share = y[rows].mean()
        if left_depth == 0 or share in (0.0, 1.0):
            return bool(share >= 0.5)
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[rows, f])
            for t in (values[1:] + values[:-1]) / 2:
                low = x[rows, f] <= t
                a, b = y[rows][low], y[rows][~low]
                impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, float(t), low)
        if best is None:
            return bool(share >= 0.5)
        _, f, t, low = best
        return f, t, grow(rows[low], left_depth - 1), grow(rows[~low], left_depth - 1)

    return grow(np.arange(len(table)), depth)


def classify(tree, row) -> bool:
    while not isinstance(tree, bool):
        f, t, low, high = tree
        tree = low if row[f] <= t else high
    return tree


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    x = features(found)
    return "\n\n".join(b.text for b, row in zip(found, x, strict=True) if classify(tree, row))


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: key, url, ``text`` and ``n_chars``."""
    src = df.select(F.col(key).alias(key), F.col(url).alias(url), F.col(html).alias("_html"))
    tree = fit_tree(LABELLED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):  # bounds what is held at once
                part = b.slice(at, 256)
                texts = [main_text(t.as_py(), tree) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [key, url, "text", "n_chars"])

    types = {f.name: f.dataType.simpleString() for f in src.schema}
    return map_arrow(src, run, f"`{key}` {types[key]}, `{url}` {types[url]}, text string, n_chars bigint")
