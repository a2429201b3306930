"""Main text of web pages by differencing with the pages of the nearest URLs.

Pages are range-partitioned and sorted by host and path, so that a page's neighbours are the pages of its host with the
nearest paths; a host with many pages spreads over many ranges. A page's text lines (its blocks) are aligned with those
of each neighbour by their longest common subsequence. Lines that a page shares with a neighbour are furniture of the
site and deleted, unless the neighbour is a copy of the page (more than half of its lines outside marked furniture shared) or the line stands in
the article itself (``article`` or ``main`` element) and is not made of links. Furniture that differs from page to page
is told by its markup: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
by element or by words in class and id. If a page has an article element, only blocks inside it are kept.

Null html is empty; a page without text gives an empty string; broken or cut markup is read as far as it goes (an
unclosed tag at the end is dropped). Pages without a host are neighbours of each other. A page at the edge of a range
has one neighbour. Repeated pages are copies and keep their lines. Every row gives one row; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .urls import split

TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))|=\s*[^\s>"'][^\s>]*|=\s*(?=>|\Z)|[^>=])*)(?:>|\Z)|/?\Z)""", re.S)
NAMED = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]+)""", re.I)
RAW = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "button")}
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HOLDERS = frozenset("article main section div nav aside footer header form ul ol table figure dl blockquote fieldset details dialog body".split())
FURNITURE = frozenset("nav aside footer form dialog".split())
FURNITURE_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisements?|advertising|banner|sponsor(?:ed|s)?|promo(?:tion|s)?|menu|nav|navbar|navigation|breadcrumbs?|sidebar|footer|masthead|"
    r"site-?header|page-?header|topbar|toolbar|comments?|commentlist|respond|replies|disqus|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|"
    r"signup|login|share|sharing|social|related|recommended|widget|pagination|pager|skip-link|search)(?:$|[^a-z])"
)
MAIN_WORDS = re.compile(r"(?:^|[^a-z])(?:main|article-?body|post-?content|entry-?content)(?:$|[^a-z])")


class Line:
    """One block's text, whether it stands in the article, in furniture, and how much of it is links."""

    __slots__ = ("text", "article", "furniture", "linked")

    def __init__(self, text: str, article: bool, furniture: bool, linked: bool):
        self.text, self.article, self.furniture, self.linked = text, article, furniture, linked


def lines_of(page: str) -> tuple[list[Line], bool]:
    """Blocks with text in page order, and whether the page has an article element."""
    lines: list[Line] = []
    stack: list[tuple[str, bool, bool]] = []  # holder, in the article, in furniture
    parts: list[str] = []
    linked = total = 0
    anchors = 0
    has_article = False
    state = (False, False)

    def close() -> None:
        nonlocal linked, total
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                lines.append(Line(text, *state, total > 0 and linked * 5 >= total * 4))
            parts.clear()
        linked = total = 0

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        text = page[at : m.start() if m else size]
        if text:
            parts.append(text)
            weight = len(text) - text.count(" ")
            total += weight
            linked += weight if anchors else 0
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name == "a":
                anchors = max(0, anchors - 1)
            if name in BLOCKS:
                close()
            if name in HOLDERS and any(h[0] == name for h in stack):
                while stack.pop()[0] != name:
                    pass
                state = stack[-1][1:] if stack else (False, False)
            continue
        if name in RAW:
            end = RAW[name].search(page, at)
            at = end.end() if end else size
            continue
        if name == "a":
            anchors += 1
        if name in BLOCKS:
            close()
        if name in HOLDERS:
            said = " ".join(x.strip("\"'").lower() for x in NAMED.findall(m[3])) if m[3] else ""
            article = state[0] or name in ("article", "main") or bool(said and MAIN_WORDS.search(said))
            furniture = state[1] or name in FURNITURE or (name == "header" and not state[0]) or (name not in ("article", "main", "body") and bool(said and FURNITURE_WORDS.search(said)))
            has_article = has_article or (article and not furniture)
            stack.append((name, article, furniture))
            state = (article, furniture)
    close()
    return lines, has_article


def common_lines(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of ``a`` belong to a longest common subsequence with ``b``, by bit vectors over the lines of ``a``."""
    shared = [False] * len(a)
    # equal lines at both ends belong to a longest one: copies need no table
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    if low or high:
        inner = common_lines(a[low : len(a) - high], b[low : len(b) - high])
        return [True] * low + inner + [True] * high
    places: dict[str, int] = {}
    for i, line in enumerate(a):
        places[line] = places.get(line, 0) | 1 << i
    b = [x for x in b if x in places]
    if not b:
        return shared
    every = (1 << len(a)) - 1
    rows = [every]  # row j: bit i is 0 where the length grows at line i, for the first j lines of b
    for line in b:
        v = rows[-1]
        u = v & places[line]
        rows.append(((v + u) | (v - u)) & every)
    lengths = lambda row, i: i - (row & ((1 << i) - 1)).bit_count()  # noqa: E731  common length with the first i lines
    i, j = len(a), len(b)
    while i and j:
        here = lengths(rows[j], i)
        if lengths(rows[j], i - 1) == here:
            i -= 1
        elif lengths(rows[j - 1], i) == here:
            j -= 1
        else:
            shared[i - 1] = True
            i, j = i - 1, j - 1
    return shared


def main_text(lines: list[Line], has_article: bool, neighbours: list[list[Line]]) -> str:
    """Lines that are left, joined by newlines."""
    own = [x.text for x in lines]
    drop = [False] * len(lines)
    for other in neighbours:
        shared = common_lines(own, [x.text for x in other])
        told = [s for s, x in zip(shared, lines) if not x.furniture]
        if 2 * sum(told) > len(told):
            continue  # a copy says nothing about furniture
        for i, s in enumerate(shared):
            if s and (not lines[i].article or lines[i].linked):
                drop[i] = True
    return "\n".join(x.text for x, d in zip(lines, drop) if not d and not x.furniture and (x.article or not has_article))


def extract(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Rows (key, url, text, n_chars)."""
    rest = F.regexp_extract(F.coalesce("url", F.lit("")), r"^.*?://(.*)$", 1)
    rows = pages.select(key, "url", "html", F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)).alias("host"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"))
    kind = rows.schema[key].dataType.simpleString()
    ordered = rows.repartitionByRange("host", "path", key).sortWithinPartitions("host", "path", key).select(key, "url", "html")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = here = None  # (key, url, host, lines, has_article)
        out: list[tuple] = []

        def done(after) -> None:
            near = [x[3] for x in (before, after) if x and x[2] == here[2]]
            out.append((here[0], here[1], main_text(here[3], here[4], near)))

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([o[0] for o in out], rows_type), pa.array([o[1] for o in out], pa.string()),
                pa.array([o[2] for o in out], pa.string()), pa.array([len(o[2]) for o in out], pa.int64()),
            ], names=[key, "url", "text", "n_chars"])

        rows_type = None
        for batch in batches:
            rows_type = batch.column(0).type
            for k, url, page in zip(*(c.to_pylist() for c in batch.columns)):
                after = (k, url, split(url)[0], *lines_of(page or ""))
                if here:
                    done(after)
                before, here = here, after
            if out:
                yield batch_of()
                out = []
        if here:
            done(None)
            yield batch_of()

    return ordered.mapInArrow(make, f"{key} {kind}, url string, text string, n_chars long")
