"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element. Each line weighs as many characters as it has outside links;
lines inside menus, forms, adverts and the like are left out, and part nothing; an element that is only named like one is
believed unless hardly any text is left without it. The weights are summed over a sliding
window of lines: where the sums surge, main text begins, where they dive, it ends, and the lines between are the text.
Lines inside an article mark are one region, which weighs `MARK` times its characters: it is taken whole, without surge and
dive, and regions outside the mark join it if they weigh as much. A mark that is light beside them decides nothing.
"""

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.text import LONG, STRING, in_small_batches, pick, struct

WIDTH = 3
SURGE = 80
#: A region of text counts if it weighs at least this part of the heaviest one.
SHARE = 0.25
#: What a character inside a mark weighs.
MARK = 4

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|textarea|select|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-z][^>]*>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTR = re.compile(r"""([a-z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""\shidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)

#: Elements that do not break a line of text.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never main text.
_OUTSIDE = frozenset("nav footer aside button head dialog menu fieldset input".split())
_OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar status".split()
)
_MARKED = frozenset(("article", "main"))
#: Words of a class or id that mark something other than the article.
_OUTSIDE_WORDS = (
    "ad|ads|adv|advert|adverts|advertisement|advertising|adsbygoogle|banner|sponsor|sponsored|promo|promotion|cookie|"
    "cookies|consent|gdpr|notice|notification|alert|sidebar|sidenav|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|"
    "comment|comments|commentlist|reply|replies|respond|disqus|footer|masthead|share|sharing|social|related|newsletter|"
    "subscribe|subscription|signup|popup|modal|widget|widgets|toolbar|pagination|pager|login|search|copyright|legal|"
    "disclaimer|skip|topbar|header"
)
_OUTSIDE_CLASS = re.compile(
    rf"(?:^|\s)(?!(?:has|no|with|show|hide)[-_])(?:(?:{_OUTSIDE_WORDS})(?:[-_][\w-]*)?|[\w-]*[-_](?:{_OUTSIDE_WORDS}))(?=\s|$)",
    re.I,
)
_HEADERS = re.compile(r"(?:^|[\s_-])header(?:[\s_-]|$)", re.I)


#: Whether an element holds the article, holds something else, or is only named as if it did.
INSIDE, OUTSIDE, NAMED = 0, 1, 2


def _outside(name: str, attrs: str, in_mark: bool) -> int:
    """Whether an element holds something other than the article. A header inside the article belongs to it."""
    if name == "form":
        return NAMED
    if name in _OUTSIDE:
        return OUTSIDE
    if name == "header":
        return INSIDE if in_mark else OUTSIDE
    if not attrs or name in ("body", "html", "main"):
        return INSIDE
    if _HIDDEN.search(attrs):
        return OUTSIDE
    named = INSIDE
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "role" and value.lower() in _OUTSIDE_ROLES:
            return OUTSIDE
        if key in ("class", "id") and _OUTSIDE_CLASS.search(value):
            if not (in_mark and _HEADERS.search(value)):
                named = NAMED
    return named


def _cleared(weights: list[tuple[int, int]], parents: list[int]) -> list[bool]:
    """Which named elements hold the article after all. `weights`: of each line, the innermost named element it lies in (-1: none) and
    its weight; `parents`: of each named element, the one around it.

    A name is not believed if hardly any text would be left: while lines outside all names weigh less than `SURGE`, the heaviest
    outermost name that holds most of the text is cleared, so that layout wrappers give up their content, but not what is named
    inside them.
    """
    held, free = [0] * len(parents), 0
    for element, weight in weights:
        if element < 0:
            free += weight
        else:
            held[element] += weight
    own = held[:]
    for element in range(len(parents) - 1, -1, -1):  # inner elements come after those around them
        if parents[element] >= 0:
            held[parents[element]] += held[element]
    inner: dict[int, list[int]] = {}
    for element, parent in enumerate(parents):
        inner.setdefault(parent, []).append(element)
    cleared, outermost = [False] * len(parents), [(-held[e], e) for e in inner.get(-1, ())]
    heapq.heapify(outermost)
    rest = sum(held[e] for e in inner.get(-1, ()))
    while free < SURGE and outermost:
        weight, element = heapq.heappop(outermost)
        if -weight < SURGE or -weight * 2 <= rest + free:
            break
        cleared[element] = True
        free, rest = free + own[element], rest - own[element]
        for e in inner.get(element, ()):
            heapq.heappush(outermost, (-held[e], e))
    return cleared


def page_lines(html: str) -> list[tuple[str, int, bool, bool]]:
    """The lines of a page: text, characters outside links, whether inside a mark, whether main text is possible."""
    found: list[tuple[str, int, bool, bool, int]] = []
    parts: list[tuple[str, bool]] = []
    open_elements: list[tuple[str, int]] = []  # name and whether it lies outside main text
    open_names: Counter[str] = Counter()
    parents: list[int] = []  # of named elements
    within = [-1]  # the named elements around this place
    outside = marks = links = 0

    def end_line() -> None:
        text = " ".join("".join(p for p, _ in parts).split())
        if text:
            weight = sum(len("".join(p.split())) for p, linked in parts if not linked)
            found.append((text, 0 if outside else weight, marks > 0, not outside, within[-1]))
        parts.clear()

    def close() -> str:
        nonlocal outside, marks
        n, o = open_elements.pop()
        open_names[n] -= 1
        outside -= o == OUTSIDE
        marks -= n in _MARKED
        if o == NAMED:
            within.pop()
        return n

    at = 0
    for m in _MARKUP.finditer(html):
        if m.start() > at:
            parts.append((unescape(html[at:m.start()]), links > 0))
        at = m.end()
        if m["cdata"]:
            parts.append((m["cdata"], links > 0))
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name == "a":
            links = 0 if m["close"] else 1
        if name == "br":
            parts.append(("\n", False))
            continue
        inline = name in _INLINE
        if m["close"]:
            if open_names[name]:
                if not inline or any(o for _, o in open_elements[-1:]):
                    end_line()
                while close() != name:
                    pass
            elif not inline:
                end_line()
            continue
        out = _outside(name, m["attrs"] or "", marks > 0)
        if not inline:
            end_line()
            links = 0
        if name in _VOID or (inline and not out):
            continue
        if out and inline:
            end_line()
        top = open_elements[-1][0] if open_elements else ""
        if top == "p" and not inline or top == name == "li":  # end tags are optional
            close()
        open_elements.append((name, out))
        open_names[name] += 1
        outside += out == OUTSIDE
        marks += name in _MARKED
        if out == NAMED:
            parents.append(within[-1])
            within.append(len(parents) - 1)
    if at < len(html):
        parts.append((unescape(html[at:]), links > 0))
    end_line()
    cleared = _cleared([(line[4], line[1]) for line in found], parents)
    possible = []  # by named element, whether it and all around it are cleared
    for element, parent in enumerate(parents):
        possible.append(cleared[element] and (parent < 0 or possible[parent]))
    lines = []
    for text, weight, marked, fit, element in found:
        fit = fit and (element < 0 or possible[element])
        lines.append((text, weight if fit else 0, marked, fit))
    return lines


def regions(weights: np.ndarray, surge: int, width: int = WIDTH) -> list[tuple[int, int]]:
    """Line ranges between a surge of the window sums to at least `surge` and the dive to nothing."""
    sums = np.convolve(weights, np.ones(width, dtype=np.int64))[width - 1:] if len(weights) else weights
    found, start = [], None
    for i, total in enumerate(sums):
        if start is None and total >= surge and weights[i] > 0:
            start = i
        if start is not None and (total == 0 or i == len(sums) - 1):
            end = i if total == 0 else i + 1
            found.append((start, end))
            start = None
    return found


def _regions_of(lines: list[tuple[str, int, bool, bool]], among: list[int]) -> list[tuple[int, list[int]]]:
    """The regions of the lines `among`, as if there were no others: their weights and lines."""
    weights = np.array([lines[i][1] for i in among], dtype=np.int64)
    return [(int(weights[a:b].sum()), among[a:b]) for a, b in regions(weights, SURGE)]


def main_text(html: str | None) -> tuple[str, int, int]:
    """The main text of a page, and the first line and the line after the last of it."""
    lines = page_lines(html or "")
    fit = [i for i, line in enumerate(lines) if line[3]]
    marked = [i for i in fit if lines[i][2]]
    mark = MARK * sum(len(lines[i][0]) for i in marked)
    found = _regions_of(lines, [i for i in fit if not lines[i][2]])
    most = max((weight for weight, _ in found), default=0)
    chosen = []
    if marked and mark >= SHARE * most:
        chosen = marked
    else:  # by weight alone
        found, mark = _regions_of(lines, fit), 0
        most = max((weight for weight, _ in found), default=0)
    chosen = sorted([*chosen, *(i for weight, part in found if weight >= SHARE * max(most, mark) for i in part)])
    chosen = chosen or fit  # on pages without enough text every line counts
    text = " ".join(lines[i][0] for i in chosen)
    return (text, chosen[0], chosen[-1] + 1) if chosen else ("", 0, 0)


@F.pandas_udf(struct(text=STRING, first_line=LONG, end_line=LONG))
def _main(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in batches:
        yield pd.DataFrame([main_text(p) for p in pages], columns=["text", "first_line", "end_line"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: `page_id`, `url`, `text`, `n_chars` (code points) and the lines between which it lay.

    NULL, empty and text-free pages have an empty text, an empty table gives no rows. Unclosed elements end with the element around them. Pages are
    taken whole, repeated rows each for itself; other columns of `pages` are not read.
    """
    found = in_small_batches(pick(pages, id_col, url_col, html_col)).select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), _main(F.col(f"`{html_col}`")).alias("m")
    )
    return found.select(
        "page_id", "url", "m.text", F.length("m.text").cast("long").alias("n_chars"), "m.first_line", "m.end_line"
    )
