"""Main text of web pages by line-block distribution.

Markup is stripped first: every block element becomes one line, and a line
inside navigation, headers, footers, side bars, notices, adverts, forms or
reader comments, or outside the article where the page marks one, counts as
empty. The lengths of `window` neighbouring lines are then summed. Where that
sum rises above the surge level with text after it, a region begins; where it
falls back to zero, the region ends; the text between is kept.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyframe.llm.common import map_rows

# HTML element names by role.
_RAW = "script|style|noscript|template|textarea|title|svg|math|iframe|object|select|button|canvas|audio|video"
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SIDE = frozenset("nav header footer aside form menu dialog head search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words in class or id that name what is not the article.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner sidebar side nav "
    "navbar navigation menu breadcrumb breadcrumbs header masthead footer footnote-links copyright comment comments "
    "reply replies discussion disqus respond notice notices cookie cookies consent gdpr alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended pagination pager widget "
    "toolbar skip hidden".split()
)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\b[^>]*(?:>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _aside(tag: str, rest: str) -> bool:
    """True for an element whose content is not the article."""
    if tag in _SIDE:
        return True
    if not rest or tag in ("html", "body", "main"):
        return False
    for name, value in _ATTRIBUTE.findall(rest):
        value, name = value.strip("\"'"), name.lower()
        if name == "hidden" or name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id"):
            for word in value.split():
                if not _MARKS.isdisjoint(_PARTS.split(_CAMEL.sub("-", word).lower())):
                    return True
    return False


def page_lines(page: str) -> list[tuple[str, bool, bool, int]]:
    """(text, beside the article, inside a marked article, characters of link text) per line."""
    lines: list[tuple[str, bool, bool, int]] = []
    text: list[str] = []
    skip, depth, landmarks, link, linked, at = "", 0, 0, False, 0, 0

    def close() -> None:
        nonlocal linked
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            lines.append((line, bool(skip), landmarks > 0, linked))
        text.clear()
        linked = 0

    for token in _TOKEN.finditer(page):
        if token.start() > at:
            text.append(part := page[at : token.start()])
            linked += len(part) if link else 0
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        ends = bool(token["end"])
        if tag == "a":
            link = not ends
        if tag == "br":
            text.append(" ")
        if tag in ("article", "main"):
            close()
            if ends:
                landmarks = max(0, landmarks - 1)
            elif _aside(tag, token["rest"]) or skip and landmarks:  # a reader's comment, say
                pass
            else:  # an article ends any box left open before it
                landmarks, skip, depth = landmarks + 1, "", 0
                continue
        if skip:
            if tag == skip:
                depth += -1 if ends else 1
                if depth <= 0:
                    close()
                    skip = ""
                    continue
        elif not ends and tag not in _VOID and not token["rest"].endswith("/") and _aside(tag, token["rest"]):
            close()
            skip, depth = tag, 1
            continue
        if tag in _BLOCKS:
            close()
    if at < len(page):
        text.append(page[at:])
    close()
    return lines


def main_blocks(page: str, window: int = 3, surge: int = 80) -> list[str]:
    """The blocks between surge and dive points, in page order."""
    lines = page_lines(page)
    if not lines:
        return []
    marked = any(inside and not beside for _, beside, inside, _ in lines)
    sizes = np.array(
        [0 if beside or marked and not inside else max(0, len(t) - 2 * linked) for t, beside, inside, linked in lines]
    )
    if marked:  # the page says where its article is: any text in it is a surge
        sizes = np.where([inside and not beside for _, beside, inside, _ in lines], np.maximum(sizes, 1), 0)
    sums = np.convolve(sizes, np.ones(window, int))[window - 1 :]  # of each line and those after it
    level, keep, at = 0 if marked else surge, np.zeros(len(lines), bool), 0
    while at < len(lines):
        if sums[at] > level:  # surge
            end = at
            while end < len(lines) and sums[end] > 0:  # until the dive
                end += 1
            keep[at:end] = True
            at = end
        at += 1
    return [t for (t, beside, inside, _), k, size in zip(lines, keep, sizes, strict=True) if k and size > 0]


def extract_main_text(pages: DataFrame, window: int = 3, surge: int = 80) -> DataFrame:
    """page_id, url, text (blocks joined by an empty line), n_chars and n_blocks per row of pages(page_id, url, html).

    Null or empty html, and html without an article, give an empty text.
    Repeated rows give repeated results; null ids and urls pass through.
    """

    def work(ids: list, urls: list, pages: list) -> dict[str, pa.Array]:
        blocks = [main_blocks(p.decode("utf-8", "replace"), window, surge) if p else [] for p in pages]
        texts = ["\n\n".join(b) for b in blocks]
        return {
            "page_id": pa.array(ids, pa.int64()),
            "url": pa.array([u.decode("utf-8", "replace") if u is not None else None for u in urls], pa.string()),
            "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "n_blocks": pa.array([len(b) for b in blocks], pa.int64()),
        }

    return map_rows(
        pages,
        {"page_id": "bigint", "url": "string", "html": "string"},
        work,
        "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint",
    )
