"""Main text of web pages by line-block distribution.

``page_lines`` strips the markup: every block of a page becomes a line, with its characters as weight. A line that is mostly links, or inside a menu,
page header, footer, sidebar, notice, advert, form or reader comment, weighs nothing. ``surge_and_dive`` sums weights over sliding windows of
lines: a region begins where the sum rises to the surge and its first line has weight (surge point), and ends with the last line of weight before
the sum falls to nothing (dive point); the lines between are text, those without weight included, but for lines in boilerplate.

If a page marks articles (``article``, ``main``, ``role=main``, ``itemprop=articleBody``), only their lines have weight. In the article with
most text any weight is a surge, so a short article stays whole; regions of other articles, and of pages without marks, need SURGE characters.
Without marks the heaviest region is kept with the other regions in the same containers. What the windows decide on a marked article: runs
of link lines at its beginning, its end, or as long as a window in between are no text; single ones inside the text are.

A marked paragraph or heading runs to its end tag or the next block, a marked list item to its end tag or the next item of its
list, and both end with their container; an article or main element is marked by full class names only.

Defined cases: null and empty html give an empty text; unclosed elements end where their container does, and an opening
article ends an unclosed menu or header; raw text (script, style, ...) without an end runs to the end of the page; comments and
doctypes are dropped; ``<`` before anything but a tag is text; a page whose quotes never close is read as if quotes meant nothing, so the
time is in proportion to the page; repeated rows are extracted one by one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 60
BATCH_BYTES = 8 << 20

_OTHER = re.compile(r"<!--(?:.*?-->|.*\Z)|<![^>]*>|<\?[^>]*>", re.S)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: The rest of a tag: with quoted values, and without.
_QUOTED = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_PLAIN = re.compile(r"([^>]*)>")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_TOKEN = re.compile(r"[a-z]+|\d+")

#: HTML element classes (fixed values of the HTML standard, grouped by use here).
RAW = frozenset("script style noscript template textarea title iframe svg object canvas audio video select datalist xmp noframes noembed".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog button fieldset head".split())
CONTAINERS = frozenset("html body div section article main nav header footer aside form menu dialog button fieldset ul ol dl table tbody thead tfoot tr td th blockquote figure details center head".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr address figcaption caption legend summary option".split())
#: Blocks that end at the next block, and list items, which end at the next item of their list.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 pre caption legend summary option".split())
ITEMS = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"])}
#: An end tag of an item, address or figcaption does not reach beyond these.
SCOPES = frozenset("html body ul ol menu dl table td th figure".split())
#: Words in class and id names, and roles, that mark what is not article text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "sidebar footer masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments commentlist disqus discussion replies reply respond widget toolbar pager pagination skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Marks that also occur joined to other words, e.g. "cookieconsent".
PREFIXES = ("advert", "sidebar", "cookie", "comment", "newsletter", "breadcrumb", "navbar", "sponsor")


@dataclass
class Line:
    text: str
    weight: int
    boiler: bool
    article: int
    parent: int


@dataclass
class _Open:
    name: str
    boiler: bool
    article: int
    number: int
    #: A marked paragraph, heading or item, or inside of one: its text makes no lines.
    dropped: bool = False


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


def _marked(attrs: dict[str, str], whole: bool = False) -> bool:
    """Whether the element is marked as no article text; whole: by a full class name or id, not by a word of one."""
    if attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    for value in (attrs.get("class", ""), attrs.get("id", "")):
        for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
            if name in MARKS if whole else any(t in MARKS or t.startswith(PREFIXES) for t in _TOKEN.findall(name)):
                return True
    return "display:none" in attrs.get("style", "").replace(" ", "").lower()


def _unclosed(stack: list[_Open]) -> int:
    """Where the menus and headers begin that an opening article ends; a marked item goes only with the menu around it."""
    first = at = len(stack)
    items = False
    while at > 1 and stack[at - 1].boiler and (stack[at - 1].name in ("nav", "header", "menu", "head", "ul", "form") or stack[at - 1].name in ITEMS):
        at -= 1
        items = items or stack[at].name in ITEMS
        if not items or stack[at].name in ("nav", "header", "menu", "head"):
            first, items = at, False
    return first


def page_lines(html: str) -> list[Line]:
    """The page's blocks in order; article numbers its article or main element (0: outside of any)."""
    lines: list[Line] = []
    stack = [_Open("", False, 0, 0)]
    chunks: list[str] = []
    linked = plain = 0
    in_link = False
    numbers = articles = 0
    at = 0

    def text(piece: str) -> None:
        nonlocal linked, plain
        if piece:
            piece = unescape(piece)
            chunks.append(piece)
            size = len(piece.strip())
            linked, plain = (linked + size, plain) if in_link else (linked, plain + size)

    def close(first: int) -> None:
        for x in stack[first:]:
            opened[x.name] -= 1
        del stack[first:]

    def flush() -> None:
        nonlocal linked, plain
        if chunks:
            body = _SPACE.sub(" ", "".join(chunks)).strip()
            if body and not stack[-1].dropped:
                top = stack[-1]
                lines.append(Line(body, 0 if top.boiler or linked > plain else plain, top.boiler, top.article, top.number))
            chunks.clear()
        linked = plain = 0

    quotes, opened = True, Counter()
    while True:
        lt = html.find("<", at)
        head = _NAME.match(html, lt) if lt >= 0 else None
        if lt < 0 or html.find(">", lt) < 0 and not html.startswith("<!--", lt):
            text(html[at:])
            break
        if head is None:
            other = _OTHER.match(html, lt)
            text(html[at : lt if other else lt + 1])
            at = other.end() if other else lt + 1
            continue
        text(html[at:lt])
        m = _QUOTED.match(html, head.end()) if quotes else None
        if m is None:
            # The quotes ran to the end of the page: from here on they mean nothing.
            quotes, m = False, _PLAIN.match(html, head.end())
        at = m.end()
        closing, name, raw = bool(head[1]), head[2].lower(), m[1]
        if name in RAW and not closing:
            if not raw.rstrip().endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if name == "a":
            in_link = not closing
            continue
        if name == "br":
            chunks.append(" ")
            continue
        if name not in BLOCKS:
            continue
        flush()
        in_link = False
        if stack[-1].dropped and stack[-1].name in LEAVES:
            # It ends here, by its own end tag or by the next block; a stray end tag of another name is as good as one.
            close(len(stack) - 1)
            if closing and name in LEAVES:
                continue
        if closing and not opened[name]:
            continue
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    close(i)
                    break
                if name not in CONTAINERS and stack[i].name in SCOPES:
                    break
            continue
        if name in ITEMS and any(opened[x] for x in ITEMS[name]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ITEMS[name]:
                    close(i)
                    break
                if stack[i].name in CONTAINERS and stack[i].name != "div":
                    break
        attrs = _attributes(raw) if raw.strip() else {}
        main = name in ("article", "main") or attrs.get("role") == "main" or attrs.get("itemprop") == "articleBody"
        marked = bool(attrs) and _marked(attrs, name in ("article", "main"))
        if main and not marked:
            close(_unclosed(stack))
        if name in CONTAINERS and not raw.rstrip().endswith("/"):
            top = stack[-1]
            boiler = top.boiler or name in BOILERPLATE or (name == "header" and not top.article) or (name not in ("html", "body") and marked)
            numbers += 1
            if main and not boiler and not top.article:
                articles += 1
                stack.append(_Open(name, False, articles, numbers))
                opened[name] += 1
            else:
                stack.append(_Open(name, boiler, top.article, numbers, top.dropped))
                opened[name] += 1
        elif name not in CONTAINERS and name != "hr" and marked and not raw.rstrip().endswith("/"):
            numbers += 1
            stack.append(_Open(name, True, stack[-1].article, numbers, True))
            opened[name] += 1
    flush()
    return lines


def surge_and_dive(weights: list[int], surge: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Regions [first, last] of lines: from a window sum of at least surge characters to the dive to nothing."""
    n = len(weights)
    sums, total = [0] * n, 0
    for i in range(n - 1, -1, -1):
        total += weights[i] - (weights[i + window] if i + window < n else 0)
        sums[i] = total
    regions, i = [], 0
    while i < n:
        if not weights[i] or sums[i] < surge:
            i += 1
            continue
        last = i
        while last + 1 < n and sums[last + 1] > 0:
            last += 1
        while not weights[last]:
            last -= 1
        regions.append((i, last))
        i = last + 1
    return regions


def main_text(html: str | None) -> str:
    """The blocks of the article, one per line."""
    lines = page_lines(html or "")
    mass: dict[int, int] = {}
    for x in lines:
        if x.article and not x.boiler:
            mass[x.article] = mass.get(x.article, 0) + len(x.text)
    keep: set[int] = set()
    if mass:
        best = max(mass, key=lambda k: (mass[k], -k))
        for article in mass:
            of = [i for i, x in enumerate(lines) if x.article == article]
            weights = [lines[i].weight for i in of]
            # An article of nothing but link lines is its text; there is no other to find.
            whole = article == best and not any(weights)
            regions = [(0, len(of) - 1)] if whole else surge_and_dive(weights, 1 if article == best else SURGE)
            keep |= {i for a, b in regions for i in of[a : b + 1] if not lines[i].boiler}
    else:
        regions = surge_and_dive([x.weight for x in lines], SURGE) or surge_and_dive([x.weight for x in lines], 1)
        if not regions:
            return ""
        first, last = max(regions, key=lambda r: (sum(x.weight for x in lines[r[0] : r[1] + 1]), -r[0]))
        homes = {lines[i].parent for i in range(first, last + 1) if lines[i].weight}
        keep = {i for i, x in enumerate(lines) if not x.boiler and (first <= i <= last or (x.parent in homes and x.weight))}
    return "\n".join(lines[i].text for i in sorted(keep))


def _extract(batches):
    for batch in batches:
        held: list[tuple] = []
        size = 0
        for key, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
            body = main_text(html)
            held.append((key, url, body, len(body)))
            size += len(body)
            if size >= BATCH_BYTES:
                yield _rows(held, batch)
                held, size = [], 0
        yield _rows(held, batch)


def _rows(held: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
    cols = list(zip(*held)) or [(), (), (), ()]
    kinds = [batch.schema.field("page_id").type, pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
