"""Main text of web pages by classified text blocks (operator 7).

A page becomes a flat list of text blocks.  Each block has its words, its link
density, the same of the blocks before and after it, and two marks from its
surroundings (inside the article, inside a boilerplate part).  A decision tree
trained on a small labelled table of such blocks decides which are main text;
those are joined in page order.  Each page is handled on its own in one narrow
pass, so nothing is shuffled and one page is in memory at a time.

Defined results: null, empty and text-free html give ''.  Broken markup is read
as browsers do: unknown end tags are ignored, open elements end with their
parent, unclosed comments, scripts and styles run to the end of the page.
Repeated pages are extracted alike.  A null id or url is carried through.  Only
the three named columns are read.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidewater.llm.common import map_slices

# fixed values: element names and the words that name boilerplate parts
RAW = ("script", "style", "title", "textarea", "template", "iframe", "svg")
BREAKS = ("address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
          "section", "select", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul")
SPACES = ("br", "td", "th", "wbr", "img", "input")
NESTED = ("address", "article", "aside", "blockquote", "body", "details", "dialog", "div", "dl", "fieldset", "figure",
          "footer", "form", "header", "main", "menu", "nav", "ol", "section", "select", "button", "label", "table", "ul")
BOILER_TAGS = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "select", "button", "label", "fieldset")
MAIN_TAGS = ("article", "main")
BOILER_NAMES = ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "promo", "promotion", "sponsor",
                "sponsored", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside",
                "footer", "header", "masthead", "topbar", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
                "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
                "login", "search", "share", "sharing", "social", "related", "recommended", "recommendations", "comment",
                "comments", "commentlist", "reply", "replies", "respond", "disqus", "discussion", "feedback", "widget",
                "widgets", "toolbar", "pagination", "pager", "copyright", "legal", "disclaimer", "skip", "hidden",
                "toc", "form", "contentinfo", "complementary", "search-form", "outbrain", "taboola", "thread", "threads")
# pieces that stand beside such a word in a name without changing what the part is: comment-list, related-posts
PARTS = ("list", "box", "block", "wrap", "wrapper", "container", "inner", "outer", "area", "section", "bar", "strip", "link",
         "links", "item", "items", "button", "buttons", "icon", "icons", "body", "posts", "articles", "stories", "post", "article",
         "entry", "content", "text", "left", "right", "top", "bottom", "site", "main", "primary", "secondary", "global", "mobile",
         "desktop", "slot", "unit", "law", "info", "message", "panel", "group", "row", "column", "col", "id", "user", "reader",
         "my", "the", "page", "media", "dialog", "title", "heading", "thread", "results")
MAIN_NAMES = ("article", "content", "post", "entry", "story", "main", "article-body", "post-body")
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                  r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<!--|<[!?/][^>]*+>")
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PIECES = re.compile(r"[^a-z0-9]+")
_BOILER, _MAIN = frozenset(BOILER_NAMES), frozenset(MAIN_NAMES)
_PART = frozenset(PARTS)
_RAW, _BREAK, _SPACE, _NEST = frozenset(RAW), frozenset(BREAKS), frozenset(SPACES), frozenset(NESTED)
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}


def _names(attributes: str) -> list[str]:
    return [name for m in _NAMED.finditer(attributes) for name in (m[1] or m[2] or m[3] or "").lower().split()]


def _marks_boiler(names: list[str], main: bool) -> bool:
    """Does a name say boilerplate: by itself, or as a compound of such a word and nothing but parts of a page?

    ``comment-list`` and ``cookie-notice`` do; ``legal-background``, ``social-history`` and ``has-sidebar`` do not.
    An article's own header is no boilerplate.
    """
    for name in names:
        pieces = [x for x in _PIECES.split(name) if x and not x[0].isdigit()]
        words = [x for x in pieces if x in _BOILER and not (main and x == "header")]
        if words and (len(pieces) == 1 or all(x in _BOILER or x in _PART for x in pieces)):
            return True
    return False


def _marks_main(names: list[str]) -> bool:
    return any(name in _MAIN or not _MAIN.isdisjoint(_PIECES.split(name)) for name in names)


def blocks(page: str) -> list[tuple[str, int, int, bool, bool]]:
    """Text blocks of a page: (text, words, words in links, inside main part, inside boilerplate)."""
    out: list[tuple[str, int, int, bool, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []      # open containers: tag, main, boilerplate, this by an element
    parts: list[tuple[str, bool]] = []            # text of the block so far: piece, inside a link
    link, articles = False, 0

    def flush():
        nonlocal link
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                linked = sum(len(p.split()) for p, inside in parts if inside)
                _, main, boiler, _ = stack[-1] if stack else ("", False, False, False)
                n = len(text.split(" "))
                out.append((text, n, min(linked, n), main, boiler))
            parts.clear()

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            parts.append((html.unescape(page[at:stop]), link))
        if not m:
            break
        at = m.end()
        if m[0] == "<!--":
            close = page.find("-->", at)
            at = end if close < 0 else close + 3
            continue
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in _RAW:
            if not closing and not attributes.endswith("/"):
                close = _RAW_END[tag].search(page, at)
                at = close.end() if close else end
            continue
        if tag == "a":
            link = not closing
            continue
        if tag in _SPACE:
            parts.append((" ", link))
        if tag == "button" and parts and not attributes.endswith("/") and (closing or stack and stack[-1][1] and not stack[-1][2]):
            parts.append((" ", link))             # a button in a sentence of the article
            continue
        if tag in _BREAK or tag in _NEST:
            flush()
            link = False
        if tag not in _NEST:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in MAIN_TAGS:                      # an article does not stand in a menu or header: those were not closed
            while stack and stack[-1][0] in ("nav", "header", "menu", "ul", "ol"):
                stack.pop()
        _, main, boiler, firm = stack[-1] if stack else ("", False, False, False)
        if tag in MAIN_TAGS:
            # a wrapper's name does not make the page's first article boilerplate; later ones may be comments
            articles += 1
            marked = _marks_boiler(_names(attributes), main)
            if not main and not marked and articles == 1:
                boiler = firm
            boiler, main = boiler or marked, True
        elif tag in BOILER_TAGS and not (tag == "header" and main):
            boiler = firm = True
        elif tag != "body" and attributes:
            names = _names(attributes)
            boiler = boiler or _marks_boiler(names, main)
            main = main or _marks_main(names)
        if attributes and tag != "body" and _UNSEEN.search(attributes):
            boiler = firm = True
        if not attributes.endswith("/"):
            stack.append((tag, main, boiler, firm))
    flush()
    return out


#: Names of the features, in the order of the labelled table's columns.
FEATURES = ("words", "links", "before", "before_links", "after", "after_links", "main", "boiler", "page_has_main")
# The labelled table: features as above (link densities in percent), then 1 for main text.
LABELLED = (
    # inside an article: headings, paragraphs of all lengths, captions and quotes
    (8, 0, 8, 0, 60, 0, 1, 0, 1, 1), (1, 0, 40, 0, 55, 0, 1, 0, 1, 1), (2, 0, 3, 0, 2, 0, 1, 0, 1, 1),
    (45, 0, 9, 0, 80, 0, 1, 0, 1, 1), (120, 2, 45, 0, 30, 0, 1, 0, 1, 1), (300, 5, 120, 0, 12, 0, 1, 0, 1, 1),
    (30, 20, 60, 0, 50, 3, 1, 0, 1, 1), (12, 25, 40, 0, 40, 0, 1, 0, 1, 1), (60, 0, 30, 0, 8, 0, 1, 0, 1, 1),
    (5, 0, 70, 4, 90, 0, 1, 0, 1, 1), (18, 33, 60, 0, 25, 0, 1, 0, 1, 1), (1, 0, 6, 100, 9, 0, 1, 0, 1, 1),
    (10, 0, 6, 100, 1, 0, 1, 0, 1, 1), (4, 50, 90, 0, 75, 0, 1, 0, 1, 1), (3, 0, 0, 0, 0, 0, 1, 0, 1, 1),
    (7, 0, 2, 100, 0, 0, 1, 0, 1, 1), (22, 0, 14, 0, 11, 5, 1, 0, 1, 1), (40, 45, 80, 0, 60, 0, 1, 0, 1, 1),
    # link lists inside an article: tags, related reading
    (1, 100, 60, 0, 1, 100, 1, 0, 1, 0), (3, 100, 2, 100, 4, 100, 1, 0, 1, 0), (6, 100, 90, 0, 5, 100, 1, 0, 1, 0),
    (9, 100, 7, 100, 0, 0, 1, 0, 1, 0), (5, 80, 50, 0, 6, 90, 1, 0, 1, 0), (14, 93, 12, 100, 10, 100, 1, 0, 1, 0),
    # boilerplate parts, long or short, with or without links, also inside an article
    (1, 100, 0, 0, 1, 100, 0, 1, 1, 0), (2, 100, 1, 100, 2, 100, 0, 1, 1, 0), (8, 0, 1, 100, 8, 0, 0, 1, 1, 0),
    (25, 0, 1, 100, 9, 0, 0, 1, 1, 0), (14, 0, 60, 0, 0, 0, 0, 1, 1, 0), (60, 0, 90, 0, 5, 10, 0, 1, 1, 0),
    (35, 5, 40, 0, 30, 0, 1, 1, 1, 0), (110, 0, 60, 0, 80, 0, 1, 1, 1, 0), (4, 0, 50, 0, 45, 0, 1, 1, 1, 0),
    (50, 0, 12, 0, 70, 0, 0, 1, 0, 0), (3, 0, 20, 0, 5, 0, 0, 1, 0, 0), (200, 1, 10, 0, 8, 0, 0, 1, 0, 0),
    # outside the article of a page that has one: leftovers
    (6, 0, 1, 100, 9, 0, 0, 0, 1, 0), (20, 0, 2, 100, 8, 0, 0, 0, 1, 0), (3, 100, 2, 100, 2, 100, 0, 0, 1, 0),
    (40, 0, 70, 0, 10, 0, 0, 0, 1, 0), (9, 11, 30, 0, 0, 0, 0, 0, 1, 0), (90, 0, 8, 0, 50, 0, 0, 0, 1, 0),
    (15, 0, 90, 0, 80, 0, 0, 0, 1, 0), (60, 0, 0, 0, 70, 0, 0, 0, 1, 0), (120, 0, 1, 100, 30, 0, 0, 0, 1, 0),
    (7, 0, 60, 0, 90, 0, 0, 0, 1, 0), (30, 0, 5, 0, 3, 100, 0, 0, 1, 0), (2, 0, 80, 0, 45, 0, 0, 0, 1, 0),
    (55, 2, 45, 0, 0, 0, 0, 0, 1, 0), (18, 0, 3, 0, 4, 0, 0, 0, 1, 0), (250, 0, 40, 0, 60, 0, 0, 0, 1, 0),
    # pages without such a part: long blocks with few links, and what stands between them
    (80, 0, 3, 100, 60, 0, 0, 0, 0, 1), (45, 4, 80, 0, 90, 0, 0, 0, 0, 1), (150, 10, 7, 0, 6, 100, 0, 0, 0, 1),
    (25, 0, 50, 0, 40, 0, 0, 0, 0, 1), (16, 0, 9, 0, 70, 0, 0, 0, 0, 1), (12, 0, 60, 0, 3, 0, 0, 0, 0, 1),
    (6, 0, 70, 0, 85, 0, 0, 0, 0, 1), (3, 0, 45, 0, 50, 0, 0, 0, 0, 1), (9, 0, 30, 0, 40, 5, 0, 0, 0, 1),
    (3, 0, 2, 100, 80, 0, 0, 0, 0, 1), (70, 0, 2, 0, 1, 0, 0, 0, 0, 1), (90, 0, 3, 0, 0, 0, 0, 0, 0, 1),
    (7, 0, 2, 100, 60, 0, 0, 0, 0, 1), (1, 0, 40, 0, 38, 0, 0, 0, 0, 1), (20, 0, 0, 0, 0, 0, 0, 0, 0, 1),
    (2, 100, 0, 0, 3, 100, 0, 0, 0, 0), (4, 100, 3, 100, 60, 0, 0, 0, 0, 0), (12, 90, 80, 0, 9, 100, 0, 0, 0, 0),
    (30, 70, 6, 100, 8, 100, 0, 0, 0, 0), (3, 0, 2, 100, 2, 100, 0, 0, 0, 0), (5, 0, 4, 0, 3, 100, 0, 0, 0, 0),
    (4, 0, 3, 0, 2, 0, 0, 0, 0, 0), (6, 50, 4, 100, 5, 100, 0, 0, 0, 0), (2, 0, 1, 100, 4, 0, 0, 0, 0, 0),
)
# inside a marked part the neighbours do not matter: its examples are repeated with each pair of these (words, links)
NEIGHBOURS = ((0, 0), (1, 100), (2, 0), (6, 100), (12, 0), (40, 5), (90, 0), (250, 1), (30, 95))
DEPTH = 10


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH):
    """A decision tree by Gini impurity: (feature, bound, low, high), or the share of main text in a leaf."""
    if depth == 0 or y.min() == y.max():
        return float(y.mean())
    best = (np.inf, None, None)
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for bound in (values[1:] + values[:-1]) / 2:
            low = x[:, k] <= bound
            p, q = y[low].mean(), y[~low].mean()
            impurity = low.sum() * p * (1 - p) + (~low).sum() * q * (1 - q)
            if impurity < best[0] - 1e-12:
                best = (impurity, k, float(bound))
    _, k, bound = best
    if k is None:
        return float(y.mean())
    low = x[:, k] <= bound
    return (k, bound, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def classify(tree, row) -> bool:
    while not isinstance(tree, float):
        k, bound, low, high = tree
        tree = low if row[k] <= bound else high
    return tree >= 0.5


LISTED = 50      # percent of a neighbour's words in links that make it part of a list of links


def examples() -> np.ndarray:
    """The labelled table with the neighbours of marked blocks varied.

    In an article a block of links is main text where it stands in running text, between blocks that are
    no links; a neighbour full of links makes it part of a list.
    """
    rows = []
    for r in LABELLED:
        marked = r[6] or r[7]
        for before in NEIGHBOURS if marked else (r[2:4],):
            for after in NEIGHBOURS if marked else (r[4:6],):
                label = r[9]
                if r[6] and not r[7] and r[1] >= 80:
                    label = int(before[1] < LISTED and after[1] < LISTED)
                rows += [(*r[:2], *before, *after, *r[6:9], label)] * (1 if marked else 20)
    return np.array(rows, float)


def train():
    table = examples()
    return grow(table[:, :-1], table[:, -1])


def main_text(page: str | None, tree) -> str:
    """The main text of one page."""
    found = blocks(page or "")
    size = [b[1] for b in found]
    share = [100 * b[2] / b[1] for b in found]
    has_main = any(b[3] and not b[4] for b in found)
    kept = []
    for i, (text, _, _, main, boiler) in enumerate(found):
        before, after = (i - 1, i + 1)
        row = (size[i], share[i], size[before] if i else 0, share[before] if i else 0,
               size[after] if after < len(found) else 0, share[after] if after < len(found) else 0,
               main, boiler, has_main)
        if classify(tree, row):
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: ``id_col``, ``url``, text, n_chars."""
    tree = train()
    read = pages.select(pages[id_col].alias("page_id"), pages[url].alias("url"), pages[page].alias("_html"))
    kind = read.schema["page_id"].dataType.simpleString()

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        text = [main_text(h, tree) for h in frame["_html"]]
        return pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": text, "n_chars": [len(t) for t in text]})

    out = map_slices(read, lambda: one, f"page_id {kind}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"page_id": id_col, "url": url})
