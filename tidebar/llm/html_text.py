"""Main text of web pages by line-block distribution.

Edge cases: null html is empty; a page without text gives an empty string;
unclosed and stray tags are tolerated; an empty table gives no rows; repeated
rows each give a row; further columns of the input are ignored.
"""

from __future__ import annotations

import html as _html
import re

from pyspark.sql import DataFrame

from .common import map_texts, table

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?/][^>]*>", re.S)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "template", "svg", "math", "iframe", "object", "xmp", "noframes")}
_ATTR = re.compile(r"""([A-Za-z_:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose whole content is never article text.
_OFF = frozenset("nav footer aside form button select menu dialog head".split())
#: Words of class, id and role names of the same kind.
_OFF_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|sponsor(?:ed)?|promo(?:tion)?s?|nav(?:igation|bar)?|menus?|"
    r"breadcrumbs?|side-?bars?|footer|masthead|site-?header|page-?header|topbar|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|signup|login|comments?|comment-?list|disqus|replies|reply|respond|feedback|related|recommended|recommendations|"
    r"share|sharing|social|widgets?|pagination|pager|copyright|disclaimer|contentinfo|complementary|search|skip-?link|tags|toolbar|hidden)(?:$|[\s_-]|\d)",
    re.I,
)
_SPACE = re.compile(r"\s+")
#: Lines in a sliding window, and the summed length that marks a surge.
WINDOW = 3
SURGE = 60


def blocks(page: str) -> list[tuple[str, bool, bool, float]]:
    """(text, off, inside article or main, share of the text in links), in page order."""
    out: list[tuple[str, bool, bool, float]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, off, article
    parts: list[str] = []
    linked = in_a = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                off, art = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                out.append((text, off, art, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = _html.unescape(raw)
            parts.append(text)
            if in_a:
                linked += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, ends = m[2].lower(), bool(m[1])
        if tag in _RAW_END and not ends:
            if tag == "title":
                close()
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else n
            continue
        if tag == "a":
            in_a = 0 if ends else 1
        if tag in _BLOCK:
            close()
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        elif tag not in _VOID:
            off, art = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            if tag in _BLOCK:
                if tag in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == tag:
                    stack.pop()  # its end tag may be left out
                    off, art = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                attrs = {k.lower(): v1 or v2 or v3 for k, v1, v2, v3 in _ATTR.findall(m[3])} if "=" in m[3] else {}
                names = " ".join(attrs.get(k, "") for k in ("class", "id", "role"))
                off = off or tag in _OFF or (tag == "header" and not art)
                off = off or (tag not in ("body", "html", "article", "main") and bool(names and _OFF_NAME.search(names)))
                off = off or "hidden" in re.split(r"[\s=\"']+", m[3]) or "display:none" in attrs.get("style", "").replace(" ", "")
                art = art or tag in ("article", "main") or attrs.get("role") in ("main", "article")
                stack.append((tag, off, art))
        if tag in _BLOCK and not ends and tag in _VOID:
            continue
    close()
    return out


def stretches(size: list[float], window: int, surge: int) -> list[tuple[float, int, int]]:
    """(length, start, end) of each stretch from a surge to a dive of the sums over ``window`` lines."""
    sums = [sum(size[i : i + window]) for i in range(len(size))]
    out, i = [], 0
    while i < len(sums):
        if sums[i] < surge:
            i += 1
            continue
        start = i
        while start < len(size) and size[start] == 0:
            start += 1
        while i < len(sums) and sums[i] > 0:
            i += 1
        out.append((sum(size[start:i]), start, i))
    return out


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Text between the surge and the dive of the line-block distribution.

    Lines are the page's blocks; those of a menu, form, advert and the like are taken out
    first, the linked part of a block has length zero. The sum over each ``window`` lines
    rises over ``surge`` where the article starts, and falls to zero where it
    ends. The stretch with most text is the article, and so are others of a quarter of its text
    that have ``window`` surges' worth (a list of links may part an article). An article or main element
    is the article instead, all of it, unless a stretch outside holds more text than all such elements
    and ``window`` surges' worth: then these are cards, and the lines outside are the page.
    """
    lines = [(t, art, len(t) * (1 - share) if share < 0.8 else 0.0, share) for t, off, art, share in blocks(page or "") if not off]
    least = window * surge
    inside = [x for x in lines if x[1]]
    if inside:
        outside = [x for x in lines if not x[1]]
        most = max((n for n, *_ in stretches([x[2] for x in outside], window, surge)), default=0.0)
        if most < least or most <= sum(x[2] for x in inside):
            return "\n\n".join(x[0] for x in inside)
        lines = outside
    found = stretches([x[2] for x in lines], window, surge)
    best = max((n for n, *_ in found), default=0.0)
    if not best:  # no surge: a short page
        found = [(0.0, 0, len(lines))]
    kept = [x for n, i, j in found if n == best or n >= max(least, best / 4) for x in lines[i:j]]
    return "\n\n".join(x[0] for x in kept if x[3] < 0.8)


def extract(pages: DataFrame, columns: tuple = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """``columns`` with text and n_chars of each row."""

    def kernel(*cols):
        texts = [main_text(h) for h in cols[-1]]
        return [*cols[:-1], texts, [len(t) for t in texts]]

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in columns)
    return map_texts(pages, [*columns, html_col], kernel, f"{kinds}, text string, n_chars long")


def op7_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
