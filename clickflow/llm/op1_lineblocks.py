"""Main text of web pages by line-block distribution.

A page is split at its markup into lines, one per block element. A line's weight
is its text length without link text; lines in menus, headers, footers, sidebars,
notices, adverts, forms, hidden parts and reader comments weigh nothing, and if
the page marks its article (``article``, ``main``), so does what stands outside.
The weights are summed over sliding windows of ``K`` lines. Text starts where the
sum surges (reaches ``SURGE`` characters, or any in a marked article) and reaches
from the last line before it without text up to the dive, where a whole window is
empty. If nothing surges, the stretch with the most text is kept.

The text between surge and dive is kept whole: character references decoded,
white space inside a block turned into one space, blocks joined by one space.

End tags that authors may leave out (of paragraphs, list items, table cells and rows,
definitions) are implied, so a notice without one ends where the next block starts.

Defined results: a null or empty page, or one without any such text, gives the
empty text and n_chars 0; a page cut off in the middle is read as far as it goes; of
stretches with equally much text the first is kept; long pages are read whole, one at
a time; null keys pass through; repeated rows are extracted row by row; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

K, SURGE = 3, 80

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|</?[a-zA-Z](?:\"[^\"]*\"|'[^']*'|[^'\">])*+>|</?[a-zA-Z][^>]*+(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\s(hidden)(?=[\s>/])")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img picture source svg path".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup or no text of the page.
RAW = frozenset("script style noscript template textarea iframe object svg math title head select option canvas "
                "audio video".split()) - {"head"}
BOILER = frozenset("nav footer aside form button menu dialog fieldset".split())
MAIN = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
                  "toolbar".split())
#: Words of class and id names of parts that aren't the article.
NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
                  "navigation menu breadcrumb breadcrumbs footer sidebar widget cookie cookies consent gdpr notice "
                  "newsletter subscribe subscription popup modal overlay share sharing social related recommended "
                  "pagination pager login signup search toolbar copyright masthead skip".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
BESIDE = frozenset("has with without no".split())


#: Elements that an opening tag ends, though their end tag was left out: by the opening tag, the
#: elements it ends and those beyond which it doesn't reach.
_CELLS, _ROWS = frozenset(("td", "th")), frozenset(("tr", "td", "th"))
_GROUPS = frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"))
ENDS = {"li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
        **dict.fromkeys(("dt", "dd"), (frozenset(("dt", "dd")), frozenset(("dl",)))),
        **dict.fromkeys(("td", "th"), (_CELLS, frozenset(("tr", "table")))),
        "tr": (_ROWS, frozenset(("table", "thead", "tbody", "tfoot"))),
        **dict.fromkeys(("thead", "tbody", "tfoot"), (_GROUPS, frozenset(("table",))))}
#: Opening tags that end an open paragraph, and the elements inside which a paragraph outside stays open.
END_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_P = frozenset(("p",))
P_SCOPE = frozenset(("button", "td", "th", "caption", "table", "html", "object", "template"))


def _tokens(value: str) -> list[frozenset]:
    """The words of each token of a class or id; a token that tells what a part has beside it
    (``has-sidebar``) says nothing about the part."""
    words = (frozenset(w.lower() for w in _WORD.findall(t)) for t in value.split())
    return [w for w in words if not w & BESIDE]


def _excluded(name: str, tag: str, in_main: bool) -> bool:
    if name in BOILER:
        return True
    if name == "header" and not in_main:
        return True
    if "=" not in tag and "hidden" not in tag:
        return False
    attrs = {}
    for m in _ATTR.finditer(tag):
        key = (m[1] or m[5]).lower()
        attrs.setdefault(key, m[2] or m[3] or m[4] or "")
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    if name in ("html", "body"):
        return False
    found = frozenset().union(*_tokens(f"{attrs.get('class', '')} {attrs.get('id', '')}"))
    if found & COMMENTS:
        return True
    if name in MAIN:
        return False
    return bool(found & NAMES) or ("header" in found and not in_main)


def page_lines(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters in links, excluded, in a marked article) of every line with text."""
    out: list[tuple[str, int, bool, bool]] = []
    stack: list[tuple[str, bool]] = []
    count: dict[str, int] = {}
    shut = main = links = 0
    parts: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, min(linked, len(text)), shut > 0, main > 0))
            parts.clear()
        linked = 0

    def ended(names: frozenset, scope: frozenset):
        """End the open elements of ``names`` inside ``scope``, with what is open in them."""
        if any(count.get(n) for n in names):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in names:
                    while len(stack) > i:
                        pop()
                elif stack[i][0] in scope:
                    break

    def pop():
        nonlocal shut, main, links
        name, off = stack.pop()
        count[name] -= 1
        shut -= off
        main -= name in MAIN
        links -= name == "a"

    at = 0
    for m in iter(lambda: _MARKUP.search(page, at), None):
        if m.start() > at:
            text = html.unescape(page[at: m.start()])
            parts.append(text)
            linked += len(text.strip()) if links else 0
        at = m.end()
        tag = m[0]
        if tag[1] in "!?":
            continue
        name = _NAME.match(tag)[1].lower()
        if name not in INLINE:
            flush()
        if tag[1] == "/":
            if count.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in RAW and not tag.endswith("/>"):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in END_P:
            ended(_P, P_SCOPE)
        if name in ENDS:
            ended(*ENDS[name])
        if name in VOID or tag.endswith("/>"):
            continue
        off = _excluded(name, tag, main > 0)
        stack.append((name, off))
        count[name] = count.get(name, 0) + 1
        shut += off
        main += name in MAIN
        links += name == "a"
    if at < len(page):
        parts.append(html.unescape(page[at:]))
    flush()
    return out


def line_blocks(lines: list[tuple[str, int, bool, bool]], k: int = K, surge: int = SURGE) -> list[str]:
    """The lines between surge and dive points."""
    marked = any(inside and not shut for _, _, shut, inside in lines)
    if marked:
        weight = [len(t) if inside and not shut else 0 for t, _, shut, inside in lines]
        surge = 1
    else:
        weight = [0 if shut else max(len(t) - linked, 0) for t, linked, shut, _ in lines]
    n = len(weight)
    sums = [sum(weight[i: i + k]) for i in range(n)]
    regions, i = [], 0
    while i < n:
        if not weight[i]:
            i += 1
            continue
        end = i
        while end < n and sums[end]:
            end += 1
        regions.append((i, end))
        i = end
    kept = [r for r in regions if max(sums[r[0]: r[1]]) >= surge]
    if not kept and regions:
        kept = [max(regions, key=lambda r: (sum(weight[r[0]: r[1]]), -r[0]))]
    # a paragraph that is all link weighs nothing but belongs to the text around it
    return [t for a, b in kept for t, _, shut, inside in lines[a:b] if not shut and (inside or not marked)]


def main_text(page: str | None) -> str:
    return " ".join(line_blocks(page_lines(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    def run(batches):
        for batch in batches:
            text = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")
                        ).mapInArrow(run, "page_id BIGINT, url STRING, text STRING, n_chars BIGINT")
