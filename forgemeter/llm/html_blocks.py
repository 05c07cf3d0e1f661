"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks at its block-level tags. A block has a place (the
marked-up container it stands in), its number of words, the share of its words
inside links, and the same two numbers of the blocks before and after it. A
decision tree, grown on the small labelled table below, says which blocks are
main text. The place is one of its inputs: inside an article the links of a
block and of its neighbours tell lists of links and cards from text, outside all
known containers words and links decide alone.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tags of the HTML standard by what they mean here.
BREAKING = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset(
    "address article aside body details dialog div dl fieldset figure footer form header main menu nav ol search section "
    "table td tr ul".split()
)
UNSEEN = frozenset("script style title noscript template iframe object svg math textarea select button canvas".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
AROUND = frozenset("nav menu header footer aside form dialog search".split())
MAIN = frozenset("article main".split())
# Words in a class, id or role that mark what surrounds an article.
AROUND_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice pagination pager popup promo "
    "related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar "
    "widget consent contentinfo complementary".split()
)
MAIN_NAMES = frozenset("article content entry main post story".split())
# Tags and words whose containers hold articles of their own that are not the page's.
CLOSED = frozenset("aside dialog".split())
CLOSED_NAMES = frozenset("comment comments complementary dialog disqus replies reply respond".split())
# A name with one of these words says what a layout has or lacks, not what the container is.
LAYOUT_NAMES = frozenset("has no not with without hide show".split())

# A closed container is around the main text, and no <article> or <main> in it opens main text again.
ELSEWHERE, IN_MAIN, AROUND_MAIN, CLOSED_AROUND = 0, 1, 2, 3

FEATURES = ("place", "heading", "words", "links", "words before", "links before", "words after", "links after")

# The labelled table: the features above, then 1 for main text. Links are percent of words.
LABELLED = (
    (1, 1, 9, 0, 11, 0, 60, 0, 1), (1, 0, 60, 0, 9, 0, 44, 0, 1), (1, 0, 44, 0, 60, 0, 5, 0, 1),
    (1, 0, 5, 0, 44, 0, 31, 0, 1), (1, 0, 31, 0, 5, 0, 12, 0, 1), (1, 0, 1, 0, 31, 0, 12, 0, 1),
    (1, 0, 12, 100, 80, 0, 75, 0, 1), (1, 0, 25, 40, 12, 0, 30, 0, 1), (1, 0, 3, 0, 6, 100, 4, 100, 1),
    (1, 0, 3, 100, 30, 0, 45, 0, 1), (1, 1, 4, 100, 50, 3, 35, 0, 1), (1, 1, 9, 100, 0, 0, 60, 0, 1),
    (1, 0, 22, 55, 18, 10, 64, 0, 1), (1, 1, 5, 100, 28, 0, 44, 6, 1), (1, 0, 2, 50, 24, 0, 7, 0, 1),
    (1, 0, 31, 0, 44, 0, 0, 0, 1), (1, 0, 5, 0, 31, 0, 0, 0, 1), (1, 0, 12, 0, 40, 0, 2, 0, 1),
    (1, 0, 2, 0, 9, 0, 1, 0, 1), (1, 0, 50, 3, 60, 0, 0, 0, 1), (1, 0, 8, 0, 55, 0, 1, 100, 1),
    (1, 1, 3, 0, 40, 0, 2, 100, 1), (1, 0, 20, 0, 7, 0, 3, 0, 1), (1, 0, 1, 0, 2, 0, 1, 0, 1),
    (1, 0, 64, 8, 22, 0, 1, 100, 1), (1, 0, 4, 0, 3, 100, 2, 100, 1), (1, 0, 17, 30, 26, 0, 0, 0, 1),
    (1, 0, 6, 0, 1, 100, 0, 0, 1), (1, 0, 28, 45, 2, 100, 3, 0, 1), (1, 1, 2, 0, 1, 0, 3, 0, 1),
    (1, 0, 14, 90, 45, 0, 60, 0, 1), (1, 0, 10, 75, 66, 0, 48, 0, 1), (1, 0, 6, 100, 25, 0, 20, 0, 1),
    (1, 0, 5, 100, 12, 0, 11, 0, 1), (1, 1, 3, 100, 9, 0, 14, 0, 1), (1, 0, 18, 70, 40, 5, 16, 0, 1),
    (1, 0, 3, 0, 25, 0, 2, 0, 1), (1, 0, 90, 0, 2, 100, 2, 100, 1), (1, 0, 10, 20, 4, 50, 1, 0, 1),
    (1, 0, 2, 100, 50, 0, 2, 100, 0), (1, 0, 2, 100, 2, 100, 3, 100, 0), (1, 0, 3, 100, 2, 100, 0, 0, 0),
    (1, 0, 1, 100, 3, 0, 1, 100, 0), (1, 0, 1, 100, 1, 100, 1, 100, 0), (1, 0, 4, 100, 60, 0, 0, 0, 0),
    (1, 0, 2, 100, 41, 0, 0, 0, 0), (1, 1, 6, 100, 40, 0, 20, 100, 0), (1, 0, 20, 100, 6, 100, 7, 100, 0),
    (1, 1, 7, 100, 20, 100, 26, 100, 0), (1, 0, 26, 100, 7, 100, 0, 0, 0), (1, 0, 24, 90, 8, 100, 55, 0, 0),
    (1, 0, 3, 100, 4, 100, 70, 0, 0), (1, 0, 9, 85, 11, 90, 12, 80, 0), (1, 0, 15, 100, 35, 4, 14, 100, 0),
    (1, 0, 2, 0, 3, 0, 18, 0, 1), (1, 1, 3, 0, 70, 0, 55, 0, 1), (1, 0, 180, 2, 3, 0, 0, 0, 1),
    (1, 1, 12, 0, 1, 100, 3, 0, 1), (1, 0, 7, 0, 0, 0, 0, 0, 1), (1, 0, 40, 10, 2, 100, 8, 0, 1),
    (2, 0, 1, 100, 0, 0, 1, 100, 0), (2, 0, 2, 100, 1, 100, 1, 100, 0), (2, 0, 1, 100, 2, 100, 14, 0, 0),
    (2, 0, 14, 0, 1, 100, 9, 0, 0), (2, 0, 11, 0, 60, 0, 0, 0, 0), (2, 0, 45, 5, 70, 0, 3, 0, 0),
    (2, 1, 3, 0, 40, 0, 25, 0, 0), (2, 0, 25, 0, 3, 0, 33, 0, 0), (2, 0, 120, 0, 80, 0, 50, 0, 0),
    (2, 0, 8, 50, 20, 0, 1, 100, 0), (2, 1, 6, 0, 0, 0, 1, 100, 0), (2, 0, 16, 30, 12, 100, 0, 0, 0),
    (2, 0, 9, 0, 120, 0, 70, 0, 0), (2, 0, 5, 0, 0, 0, 200, 0, 0), (2, 0, 33, 0, 25, 0, 0, 0, 0),
    (0, 0, 70, 0, 8, 0, 66, 0, 1), (0, 0, 25, 4, 70, 0, 40, 0, 1), (0, 0, 20, 0, 2, 100, 45, 0, 1),
    (0, 0, 6, 0, 55, 0, 48, 0, 1), (0, 1, 7, 0, 1, 100, 50, 0, 1), (0, 1, 4, 0, 64, 0, 38, 0, 1),
    (0, 0, 90, 8, 0, 0, 0, 0, 1), (0, 0, 35, 0, 30, 0, 5, 100, 1), (0, 0, 8, 0, 40, 0, 36, 0, 1),
    (0, 0, 2, 100, 1, 100, 1, 100, 0), (0, 0, 3, 100, 50, 0, 2, 100, 0), (0, 0, 4, 0, 1, 100, 2, 100, 0),
    (0, 0, 7, 0, 50, 0, 1, 100, 0), (0, 0, 5, 0, 3, 0, 2, 0, 0), (0, 0, 12, 90, 40, 0, 10, 80, 0),
    (0, 0, 30, 80, 20, 70, 25, 90, 0), (0, 1, 2, 0, 1, 100, 2, 100, 0), (0, 0, 9, 0, 4, 0, 0, 0, 0),
    (0, 0, 8, 60, 70, 0, 60, 0, 0), (0, 1, 3, 0, 60, 0, 2, 100, 0), (0, 0, 6, 0, 0, 0, 3, 0, 0),
)

_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

_TARGET = re.compile(r"(?:^|\s)href\s*=", re.IGNORECASE)
_FORM_PARTS = re.compile(r"<(/?form|nav|header|footer|main|article|aside|section|h1)\b", re.IGNORECASE)


@dataclass
class Block:
    place: int
    heading: bool
    words: list[str]
    linked: int


# Blocks ---------------------------------------------------------------------


def _names(attributes: str) -> set[str]:
    """The words that class, id and role say of a container: of each name the first and the last, as in sidebar-left
    and cookie-notice; none of a name such as has-sidebar or main-nav-wrap."""
    out: set[str] = set()
    for found in _NAMES.finditer(attributes):
        for name in next(filter(None, found.groups()), "").lower().split():
            words = [word for word in re.split(r"[^a-z]+", name) if word]
            if words and not LAYOUT_NAMES.intersection(words) and not AROUND_NAMES.intersection(words[1:-1]):
                out |= {words[0], words[-1]}
    return out


def _meaning(tag: str, attributes: str, inside: int) -> int:
    """The place that a container opens in a place."""
    if inside == CLOSED_AROUND or tag in CLOSED:
        return CLOSED_AROUND
    names = _names(attributes) if attributes and tag not in ("body", "html") else set()
    if tag not in MAIN and names & CLOSED_NAMES:
        return CLOSED_AROUND
    if tag in MAIN:
        return IN_MAIN
    if inside == AROUND_MAIN:
        return AROUND_MAIN
    if (tag in AROUND or names & AROUND_NAMES) and not (tag == "header" and inside == IN_MAIN):
        return AROUND_MAIN
    return IN_MAIN if "main" in names or tag in ("div", "section") and names & MAIN_NAMES else inside


def _page_forms(page: str) -> set[int]:
    """Where the forms open that hold parts of a page (a landmark or a heading of first rank): no forms to fill in."""
    out: set[int] = set()
    opened: list[int] = []
    for found in _FORM_PARTS.finditer(page):
        tag = found[1].lower()
        if tag == "form":
            opened.append(found.start())
        elif tag == "/form":
            del opened[-1:]
        else:
            out.update(opened)
            opened.clear()
    return out


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in order. Character references are decoded.

    A link ends with its block, unless it was opened round blocks, before any text
    of its own: such a link goes on until it is closed, another opens, or the
    container that it stands in ends.
    """
    out: list[Block] = []
    open_tags: list[tuple[str, int]] = []
    times: dict[str, int] = {}
    place, heading, links = ELSEWHERE, False, 0
    # How many containers are open round a link that wraps blocks, and the parts before a link.
    wrapping, before = -1, 0
    parts: list[tuple[str, bool]] = []
    page_forms = _page_forms(page)

    def close() -> None:
        if parts:
            words = html.unescape("".join(text for text, _ in parts)).split()
            if words:
                inside = sum(len(html.unescape(text).split()) for text, linked in parts if linked)
                out.append(Block(min(place, AROUND_MAIN), heading, words, min(inside, len(words))))
            parts.clear()

    at, end = 0, len(page)
    while at < end:
        opening = page.find("<", at)
        if opening < 0:
            opening = end
        if opening > at:
            parts.append((page[at:opening], links > 0))
        if opening == end:
            break
        follows = page[opening + 1 : opening + 2]
        if page.startswith("<!--", opening):
            stop = page.find("-->", opening + 4)
            at = end if stop < 0 else stop + 3
            continue
        if follows in ("!", "?"):
            stop = page.find(">", opening)
            at = end if stop < 0 else stop + 1
            continue
        if not (follows.isalpha() or follows == "/") or follows == "":
            parts.append(("<", links > 0))
            at = opening + 1
            continue
        found = _TAG.match(page, opening)
        if found is None:
            # Unbalanced quotes, or a tag that the page's end cuts off.
            stop = page.find(">", opening)
            at = end if stop < 0 else stop + 1
            if follows == "/" or stop < 0:
                continue
            found = re.match(r"<([a-zA-Z][^\s/>]*)()", page[opening:stop])
            if found is None:
                continue
        else:
            at = found.end()
        tag, attributes, ending = found[1].lower(), found[2], follows == "/"
        if tag in UNSEEN and not ending and not attributes.endswith("/"):
            stop = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag == "a":
            links = int(not ending and bool(_TARGET.search(attributes)))
            wrapping, before = -1, len(parts)
        if tag not in BREAKING:
            if tag == "br":
                parts.append((" ", False))
            continue
        if links and wrapping < 0 and not ending and not any(text.strip() for text, _ in parts[before:]):
            wrapping = len(open_tags)
        close()
        links = int(wrapping >= 0)
        if tag in HEADINGS:
            heading = not ending
        elif not ending:
            heading = False
        if tag in CONTAINERS:
            if not ending:
                open_tags.append((tag, place))
                times[tag] = times.get(tag, 0) + 1
                if opening not in page_forms:
                    place = _meaning(tag, attributes, place)
            elif times.get(tag):
                while True:
                    name, place = open_tags.pop()
                    times[name] -= 1
                    if name == tag:
                        break
                if len(open_tags) < wrapping:
                    links, wrapping = 0, -1
    close()
    return out


# The tree -------------------------------------------------------------------


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8):
    """A binary decision tree on Gini impurity: (feature, threshold, below, above) or a label."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return int(share >= 0.5)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            below = rows[:, feature] <= threshold
            impurity = sum(len(side) * side.mean() * (1 - side.mean()) for side in (labels[below], labels[~below]))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, float(threshold), below
    if best is None:
        return int(share >= 0.5)
    _, feature, threshold, below = best
    return feature, threshold, grow(rows[below], labels[below], depth - 1), grow(rows[~below], labels[~below], depth - 1)


def labelled() -> np.ndarray:
    """The labelled table, and its blocks of main text in places that make them boilerplate.

    Around the main text that is any of them, outside all known containers a link.
    """
    main = [row for row in LABELLED if row[-1]]
    around = [(AROUND_MAIN, *row[1:-1], 0) for row in main]
    unplaced = [(ELSEWHERE, *row[1:-1], 0) for row in main if row[0] == IN_MAIN and row[3] > 50]
    return np.array([*LABELLED, *around, *unplaced], float)


@lru_cache(maxsize=1)
def tree():
    table = labelled()
    return grow(table[:, :-1], table[:, -1])


def decide(node, row) -> bool:
    while not isinstance(node, int):
        feature, threshold, below, above = node
        node = below if row[feature] <= threshold else above
    return bool(node)


# Operator -------------------------------------------------------------------


def main_text(page: str) -> str:
    """Blocks of main text, white space made single, one per line."""
    found = blocks(page)
    sizes = [(len(b.words), 100.0 * b.linked / len(b.words)) for b in found]
    around = [(0, 0.0), *sizes, (0, 0.0)]
    root = tree()
    return "\n".join(
        " ".join(block.words)
        for i, block in enumerate(found)
        if decide(root, (block.place, block.heading, *sizes[i], *around[i], *around[i + 2]))
    )


def main_text_column(page: Column) -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(page or "") for page in pages.to_pylist()], pa.string())

    return extract.asNondeterministic()(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points), one row per row of ``pages``.

    Null or empty html gives an empty text; markup that is cut off or badly
    nested is read as far as it goes. Repeated rows are repeated; extra columns
    are ignored; an empty table gives an empty result.
    """
    return pages.select("page_id", "url", main_text_column(F.col("html")).alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )
