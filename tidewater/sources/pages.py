"""Landed HTML pages -> tables.

Input is a DataFrame ``pages(page_id, url, html)``.  Parsing markup needs
Python (a small tokenizer of our own over one regular expression; no
third-party parser), so ``page_blocks`` parses each page once inside
``mapInArrow``, piece by piece, and drops the ``html`` there.  Every row that it emits carries
what the operators need: a table row has its table's header, width and length,
the headings before it, the card around it and the links inside it; a link row
its address and text; a page row all second-level headings.  So the operators
are filters and expressions over one parse, without joins.
"""

from __future__ import annotations

import codecs
import html as _html
import re
import sys
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.session import scratch_path
from tidewater.sources.resultsets import NON_WORD

# The parser runs in Python workers: ship this module's code with the task
# (pickled by value), so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("kind", T.StringType()),        # table | list | link | page | error | empty
    T.StructField("block_no", T.IntegerType()),   # 0-based per page and kind, in document order
    T.StructField("headings", T.ArrayType(T.StringType())),  # h2-h4 before the block, then before each part around it
    T.StructField("card", T.StringType()),        # title of the div.card around it ('' without one), null outside cards
    T.StructField("card_block", T.IntegerType()),  # number of the table within its card
    T.StructField("row_no", T.IntegerType()),     # 0-based; row 0 of a table is its header; links count from 1
    T.StructField("cells", T.ArrayType(T.StringType())),
    T.StructField("data_cells", T.ArrayType(T.StringType())),  # td cells only
    T.StructField("header", T.ArrayType(T.StringType())),      # cells of row 0
    T.StructField("n_cols", T.IntegerType()),     # widest row after the header
    T.StructField("n_rows", T.IntegerType()),     # rows of the table; of the first table on page and link rows
    T.StructField("spans", T.ArrayType(T.StringType())),       # spans of the page's first table head
    T.StructField("links", T.ArrayType(T.StringType())),       # addresses in the row
])

_HEADINGS = ("h2", "h3", "h4")
_VOID = frozenset(("br", "img", "meta", "link", "input", "hr", "col", "area", "base", "wbr", "source", "embed"))
# containers whose start is remembered, to find headings before the parts around a table
_PARTS = frozenset(("div", "section", "article", "main", "aside", "body", "form", "header", "footer", "fieldset", "center"))


def _clean(text: str) -> str:
    return " ".join(text.split()) if text else ""


# One pass over the markup: comments, declarations, tags (name + raw attributes), text.
_TOKEN = re.compile(r"<!--.*?-->|<!--|<![^>]*>|<\?[^>]*>"
                    r"|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                    r"|<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*+)>|([^<]+)|<", re.S)
# A whole table row, or one cell, that holds text only: the same tags as above, taken at once.
_PLAIN_ATTRS = r"(?:\s(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)?"
_PLAIN_CELL = re.compile(rf"<t([dh]){_PLAIN_ATTRS}>([^<]*+)</t[dh]>")
_PLAIN = re.compile(rf"(<tr{_PLAIN_ATTRS}>\s*+(?:<t[dh]{_PLAIN_ATTRS}>[^<]*+</t[dh]>\s*+)*+</tr>)|<t[dh]{_PLAIN_ATTRS}>[^<]*+</t[dh]>")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style")}
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")


def _attribute(attrs: str, name: str) -> str | None:
    """The value of an attribute, decoded (None without it)."""
    for m in _ATTRIBUTE.finditer(attrs):
        if m[1].lower() == name:
            return _html.unescape(next(g for g in m.groups()[1:] if g is not None))
    return None


class PageError(ValueError):
    """The page cannot be read to its end."""


class _Page:
    """Reads one page's markup, piece by piece, into tables, lists, links and headings."""

    def __init__(self):
        self.tables: list[dict] = []
        self.lists: list[dict] = []
        self.second: list[str] = []             # texts of the h2 headings
        self.spans: list[str] = []              # of the first table head
        self.heads = 0                          # table heads seen
        self.in_head = False
        self.open_tables: list[dict] = []
        self.open_lists: list[dict] = []
        self.parts: list[dict] = []             # open containers
        self.cell: dict | None = None           # open cell or item
        self.link: tuple[str, list[str]] | None = None
        self.heading: tuple[str, list[str]] | None = None
        self.span: list[str] | None = None
        self.last_heading = ""
        self.rest = ""                          # markup whose token may go on in the next piece
        self.links: list[tuple] = []            # links read since the last ``drain``
        self.n_links = 0                        # links drained
        self.fresh: dict[int, tuple] = {}       # blocks with rows since the last ``drain``

    def feed(self, piece: str, last: bool = True) -> None:
        """Read on; what a later piece could change (a token at the end, something unclosed) waits for it."""
        markup = self.rest + piece
        at, end = 0, len(markup)
        token, plain = _TOKEN.match, _PLAIN.match
        while at < end:
            if self.open_tables and markup.startswith("<t", at) and self.plain_place():
                m = plain(markup, at)
                if m is not None:
                    self.plain_cells(_PLAIN_CELL.findall(markup, at, m.end()), m[1] is not None)
                    at = m.end()
                    continue
            m = token(markup, at)
            tag = m[2]
            if not last and (m.end() == end or (tag is None and m[7] is None and (m[5] or m[0] in ("<", "<!--")))):
                break
            start, at = at, m.end()
            tag = tag or m[5]
            if tag is not None:
                tag = tag.lower()
                if m[1] or m[4]:
                    self.close(tag)
                elif tag in _RAW_END:
                    stop = _RAW_END[tag].search(markup, at)
                    if stop is None and not last:
                        at = start
                        break
                    at = end if stop is None else stop.end()
                elif tag not in _VOID:
                    self.start(tag, m[3] or m[6] or "")
            elif m[7] is not None:
                self.text(_html.unescape(m[7]) if "&" in m[7] else m[7])
            elif m[0] == "<":
                self.text("<")
            elif m[0] == "<!--":
                raise PageError("page ends inside a comment")
        self.rest = markup[at:]
        if last:
            self.close_cell()
            for t in self.open_tables:
                self.close_row(t)
            self.link = None

    # -- where a block stands --------------------------------------------
    def place(self) -> dict:
        before = dict.fromkeys(h for h in [self.last_heading, *[p["before"] for p in reversed(self.parts)]] if h)
        return {"headings": list(before), "card": next((p for p in reversed(self.parts) if p["card"]), None)}

    def plain_place(self) -> bool:
        """In a table, with nothing open that the text of a cell would also go to."""
        return self.cell is None and self.link is None and self.heading is None and self.span is None

    def plain_cells(self, found: list[tuple[str, str]], whole_row: bool) -> None:
        """Cells that hold text only, of a whole row or one of a row."""
        t = self.open_tables[-1]
        if whole_row:
            self.close_row(t)
        if t["row"] is None:
            t["row"] = ([], [], [])
        cells, data, _ = t["row"]
        for kind, text in found:
            text = " ".join((_html.unescape(text) if "&" in text else text).split())
            cells.append(text)
            if kind == "d":
                data.append(text)
        if whole_row:
            self.close_row(t)

    def start(self, tag: str, attrs: str) -> None:
        if tag in _PARTS:
            classes = (_attribute(attrs, "class") or "").split() if attrs else []
            self.parts.append({"tag": tag, "card": tag == "div" and "card" in classes, "title": None, "tables": 0,
                               "before": self.last_heading})
        elif tag in _HEADINGS:
            self.heading = (tag, [])
        elif tag == "table":
            t = {"no": len(self.tables), "rows": [], "row": None, "header": [], "wide": 0, "n": 0, **self.place()}
            t["card_block"] = t["card"]["tables"] if t["card"] else None
            if t["card"]:
                t["card"]["tables"] += 1
            self.tables.append(t)
            self.open_tables.append(t)
        elif tag == "thead":
            self.heads += 1
            self.in_head = self.heads == 1
        elif tag == "span" and self.in_head:
            self.span = []
        elif tag == "tr" and self.open_tables:
            self.close_row(self.open_tables[-1])
            self.open_tables[-1]["row"] = ([], [], [])
        elif tag in ("td", "th") and self.open_tables:
            self.close_cell()
            t = self.open_tables[-1]
            if t["row"] is None:
                t["row"] = ([], [], [])
            self.cell = {"text": [], "row": t["row"], "data": tag == "td"}
        elif tag in ("ul", "ol"):
            one = {"no": len(self.lists), "rows": [], "n": 0, **self.place()}
            self.lists.append(one)
            self.open_lists.append(one)
        elif tag == "li" and self.open_lists and not (self.open_tables and self.open_tables[-1]["row"] is not None):
            self.close_cell()
            item = ([], [], [])
            one = self.open_lists[-1]
            one["rows"].append(item)
            one["n"] += 1
            self.fresh[id(one)] = ("list", one)
            self.cell = {"text": [], "row": item, "data": False}
        elif tag == "a":
            href = _attribute(attrs, "href")
            self.link = None
            if href is not None:
                self.link = (href, [])
                self.links.append(self.link)
                row = self.cell["row"] if self.cell else (self.open_tables[-1]["row"] if self.open_tables else None)
                if row is not None:
                    row[2].append(href)

    def close(self, tag: str) -> None:
        if tag in _PARTS:
            for k in range(len(self.parts) - 1, -1, -1):
                if self.parts[k]["tag"] == tag:
                    del self.parts[k:]
                    break
        elif self.heading and self.heading[0] == tag:
            text = _clean("".join(self.heading[1]))
            self.heading = None
            if text:
                self.last_heading = text
            if tag == "h2":
                self.second.append(text)
            elif tag == "h3":
                card = next((p for p in reversed(self.parts) if p["card"]), None)
                if card is not None and card["title"] is None:
                    card["title"] = text
        elif tag in ("td", "th", "li"):
            self.close_cell()
        elif tag == "tr" and self.open_tables:
            self.close_row(self.open_tables[-1])
        elif tag == "thead":
            self.in_head = False
        elif tag == "span" and self.span is not None:
            self.spans.append(_clean("".join(self.span)))
            self.span = None
        elif tag == "table" and self.open_tables:
            self.close_row(self.open_tables.pop())
        elif tag in ("ul", "ol") and self.open_lists:
            self.close_cell()
            self.open_lists.pop()
        elif tag == "a":
            self.link = None

    def text(self, data: str) -> None:
        if self.heading is not None:
            self.heading[1].append(data)
        if self.cell is not None:
            self.cell["text"].append(data)
        if self.link is not None:
            self.link[1].append(data)
        if self.span is not None:
            self.span.append(data)

    def close_cell(self) -> None:
        if self.cell is not None:
            text = _clean("".join(self.cell["text"]))
            self.cell["row"][0].append(text)
            if self.cell["data"]:
                self.cell["row"][1].append(text)
            self.cell = None

    def close_row(self, table: dict) -> None:
        if table["row"] is not None:
            self.close_cell()
            row, table["row"] = table["row"], None
            table["rows"].append(row)
            if table["n"] == 0:
                table["header"] = row[0]
            elif len(row[0]) > table["wide"]:
                table["wide"] = len(row[0])
            table["n"] += 1
            self.fresh[id(table)] = ("table", table)

    # -- what was read ----------------------------------------------------
    def drain(self, whole: _Page, page_id: int | None, out: _Rows | None) -> None:
        """Hand the rows read since the last call to ``out`` (None: nobody) and forget them.

        ``whole`` has read the page to its end (it may be this one): it knows the length
        and width of tables, the titles of cards and the spans."""
        first = whole.tables[0]["n"] if whole.tables else 0
        done, self.fresh = self.fresh, {}
        for kind, b in done.values():
            rows, b["rows"] = b["rows"], []
            begin = b["n"] - len(rows)
            if kind == "list" and self.cell is not None and self.cell["row"] is rows[-1]:
                b["rows"] = [rows.pop()]               # the open item
                self.fresh[id(b)] = (kind, b)
            if out is None or kind not in out.kinds or not rows:
                continue
            card = (whole.tables if kind == "table" else whole.lists)[b["no"]]["card"]
            title = None if card is None else (card["title"] or "")
            if kind == "table":
                out.add(page_id, kind, b["no"], b["headings"], title, b["card_block"], begin, rows, b["header"],
                        whole.tables[b["no"]]["wide"], whole.tables[b["no"]]["n"], whole.spans)
            else:
                out.add(page_id, kind, b["no"], b["headings"], title, None, begin, rows, [], 1, whole.lists[b["no"]]["n"], [])
        links, self.links = self.links, []
        if self.link is not None:
            links.pop()
            self.links = [self.link]                   # the open one
        if out is not None and "link" in out.kinds and links:
            out.add(page_id, "link", 0, [], None, None, self.n_links + 1, [([_clean("".join(t))], [], [h]) for h, t in links],
                    [], 1, first, [])
        self.n_links += len(links)

    def about(self, page_id: int | None, out: _Rows) -> None:
        if "page" in out.kinds:
            out.add(page_id, "page", 0, [], None, None, 0, [(self.second, [], [])], [], 0,
                    self.tables[0]["n"] if self.tables else 0, self.spans)


class _Rows:
    """Rows of ``BLOCK_SCHEMA``, column by column, of the kinds that are asked for."""

    LISTS = ("headings", "cells", "data_cells", "header", "spans", "links")

    def __init__(self, kinds: Sequence[str], schema: pa.Schema):
        self.kinds, self.schema = frozenset(kinds), schema
        self.clear()

    def clear(self) -> None:
        self.columns: dict[str, list] = {name: [] for name in self.schema.names}
        self.flat: dict[str, list] = {name: [] for name in self.LISTS}
        self.held = 0

    def add(self, page_id, kind, block_no, headings, card, card_block, begin, rows, header, n_cols, n_rows, spans) -> None:
        """Rows of one block from row ``begin`` on; each is (cells, data cells, links)."""
        n, to, flat = len(rows), self.columns, self.flat
        for name, value in (("page_id", page_id), ("kind", kind), ("block_no", block_no), ("card", card), ("card_block", card_block),
                            ("n_cols", n_cols), ("n_rows", n_rows)):
            to[name] += [value] * n
        to["row_no"] += range(begin, begin + n)
        for name, values in (("headings", headings), ("header", header), ("spans", spans)):
            to[name] += [len(values)] * n
            flat[name] += values * n
        for name, k in (("cells", 0), ("data_cells", 1), ("links", 2)):
            size, values = to[name], flat[name]
            for row in rows:
                size.append(len(row[k]))
                values += row[k]
        self.held += n

    def batch(self) -> pa.RecordBatch:
        arrays = []
        for field in self.schema:
            values = self.columns[field.name]
            if field.name in self.flat:
                offsets = np.zeros(len(values) + 1, np.int32)
                np.cumsum(values, out=offsets[1:])
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.flat[field.name], pa.string()), type=field.type))
            else:
                arrays.append(pa.array(values, field.type))
        self.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


#: Kinds of rows; ``empty`` ones stand beside the others of pages without any markup but spaces.
KINDS = ("table", "list", "link", "page", "error")
PIECE = 4 << 20          # bytes of a page that are read at a time
HELD = 20_000            # rows after which a task hands on what it has


def _read_pieces(kinds: Sequence[str], schema: pa.Schema):
    """Rows of pages that come in pieces.  A page of one piece is read once; the pieces of a larger one come
    twice, first to learn what its rows say about the whole, then to make them, so no page is held."""

    def failed(out, page_id, e):
        if "error" in out.kinds:
            out.add(page_id, "error", 0, [], None, None, 0, [([str(e)], [], [])], [], 0, 0, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(kinds, schema)
        for batch in batches:
            columns = [batch.column(name) for name in ("page_id", "n", "i", "piece")]
            for k in range(batch.num_rows):
                page_id, n, i, piece = (c[k].as_py() for c in columns)
                if i == 0:
                    page, whole, blank, error = _Page(), None, True, None
                    decoder = codecs.getincrementaldecoder("utf-8")("replace")
                elif i == n:
                    page, whole = _Page(), page
                    decoder.reset()
                blank = blank and not piece.strip(b" ")
                last = i % n == n - 1
                if error is None:
                    try:
                        page.feed(decoder.decode(piece, last), last)
                    except PageError as e:
                        error = e
                        failed(out, page_id, e)
                    else:
                        if n == 1:
                            page.drain(page, page_id, out)
                        else:
                            page.drain(whole or page, page_id, out if whole else None)
                        if i == n - 1:
                            page.about(page_id, out)
                if i == n - 1 and blank and "empty" in out.kinds:
                    out.add(page_id, "empty", 0, [], None, None, 0, [([], [], [])], [], 0, 0, [])
                if out.held >= HELD:
                    yield out.batch()
        yield out.batch()

    return run


def page_blocks(pages: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """Every table row, list item, link and page of a batch (html dropped here), or the ``kinds`` of them asked for.

    A page that cannot be read to its end gives one ``error`` row with the reason and nothing else.
    """
    read = pages.select(F.col("page_id").cast("long"), F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    read = read.withColumn("n", F.greatest(F.lit(1), F.ceil(F.octet_length("html") / PIECE)).cast("int"))
    # the pieces of a page stay together, in order: nothing here moves rows between tasks
    each = read.select("page_id", "n", "html", F.explode(F.sequence(F.lit(0), F.when(F.col("n") > 1, 2 * F.col("n") - 1).otherwise(0))).alias("i"))
    pieces = each.select("page_id", "n", "i", F.substring("html", (F.col("i") % F.col("n")) * PIECE + 1, F.lit(PIECE)).alias("piece"))
    return pieces.mapInArrow(_read_pieces(kinds, to_arrow_schema(BLOCK_SCHEMA)), BLOCK_SCHEMA)


def table_rows(blocks: DataFrame, first_table_only: bool = False) -> DataFrame:
    """S5 table shape: header cells of row 0 beside each later row, ragged rows
    padded with '' to the widest row, extra names ``col_i`` (per table)."""
    t = blocks.filter((F.col("kind") == "table") & (F.col("row_no") > 0))
    if first_table_only:
        t = t.filter(F.col("block_no") == 0)
    # positions 0..n_cols-1 (empty when no row has a cell: sequence(0, -1) would count down)
    idx = F.when(F.col("n_cols") > 0, F.sequence(F.lit(0), F.col("n_cols") - 1)).otherwise(F.array().cast("array<int>"))
    padded = F.transform(idx, lambda i: F.coalesce(F.get(F.col("cells"), i), F.lit("")))
    names = F.transform(idx, lambda i: F.coalesce(F.get(F.col("header"), i), F.concat(F.lit("col_"), i.cast("string"))))
    return t.select("page_id", "block_no", F.get("headings", 0).alias("heading"), "card", "row_no", names.alias("header"),
                    padded.alias("cells"), "links")


# --------------------------------------------------------------------------
# S6 / S7 / S8 row filters over parsed tables
# --------------------------------------------------------------------------

# Header cells that mark a box-score table, first cells of total rows,
# and the length from which on a heading is no team name.
BOX_HEADER_MARKERS = ("MIN", "PTS", "REB", "FG", "FGM", "FGA")
TOTAL_ROW_MARKERS = ("TOTAL", "TOTALS", "TEAM")
TEAM_NAME_LIMIT = 80


def _is_total(cells: Column) -> Column:
    return F.upper(F.coalesce(F.get(cells, 0), F.lit(""))).isin(*TOTAL_ROW_MARKERS)


def _is_box_row() -> Column:
    markers = F.array(*[F.lit(m) for m in BOX_HEADER_MARKERS])
    return ((F.col("kind") == "table") & (F.col("row_no") > 0) & F.arrays_overlap(F.transform("header", lambda h: F.upper(h)), markers)
            & (F.size("cells") >= 2) & ~_is_total(F.col("cells")))


def box_score_rows(blocks: DataFrame) -> DataFrame:
    """Rows of tables whose header has a stat marker; rows with fewer than
    two cells and total rows are skipped; the team is the nearest heading that is
    short enough for a name (before the table, else before a part around it)."""
    named = F.filter("headings", lambda h: F.length(h) < TEAM_NAME_LIMIT)
    return (blocks.filter(_is_box_row())
            .select("page_id", "block_no", F.coalesce(F.get(named, 0), F.lit("")).alias("team_name"), "row_no",
                    header_keys(F.col("header"), name_empty=False).alias("header"), "cells"))


def header_keys(header: Column, name_empty: bool = True) -> Column:
    """Keys of header cells: non-word characters become spaces, spaces ``_``, lower case; a
    cell without a word character is ``col_i``, an empty one too or (``name_empty=False``) null."""
    def key(h, i):
        k = F.lower(F.replace(F.trim(F.regexp_replace(h, NON_WORD, " ")), F.lit(" "), F.lit("_")))
        named = F.when(k == "", F.concat(F.lit("col_"), i.cast("string"))).otherwise(k)
        return named if name_empty else F.when(h != "", named)

    return F.transform(header, key)


def stat_card_rows(blocks: DataFrame) -> DataFrame:
    """Rows of the first table in each ``div.card``, keyed by the card's h3 title;
    total rows are skipped, cells beyond the header are not kept."""
    t = blocks.filter((F.col("kind") == "table") & (F.col("row_no") > 0) & (F.col("card_block") == 0))
    return (t.filter(~_is_total(F.col("cells")))
            .select("page_id", "block_no", "row_no", F.col("card").alias("team"),
                    F.slice(header_keys(F.col("header")), F.lit(1), F.size("cells")).alias("header"),
                    F.slice("cells", F.lit(1), F.size("header")).alias("cells")))


def play_by_play_rows(blocks: DataFrame) -> DataFrame:
    """Rows of the page's first table with four data cells: time, description; the home
    and away team come from the spans of the page's first table head."""
    t = blocks.filter((F.col("kind") == "table") & (F.col("block_no") == 0) & (F.size("data_cells") == 4))
    return t.select("page_id", "row_no", F.get("spans", 0).alias("home_team"), F.get("spans", 1).alias("away_team"),
                    F.get("data_cells", 0).alias("time"), F.get("data_cells", 1).alias("description"))


def stat_columns(rows: DataFrame, names: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    """Header-keyed cells as columns (S6/S7 output shape), the value by header position.

    Cells stay text.  Only columns named in ``numbers`` are made double, text that is no
    number null; ``typed_cells`` gives columns the type that loses no cell (S14)."""
    at = {n: F.array_position("header", F.lit(n)) for n in names}
    cols = []
    for n in names:
        v = F.when(at[n] > 0, F.get(F.col("cells"), (at[n] - 1).cast("int")))
        cols.append((F.trim(v).try_cast("double") if n in numbers else v).alias(n))
    return rows.select(*[c for c in rows.columns if c not in ("header", "cells")], *cols)


def cell_kind(cell: Column) -> Column:
    """1 for whole numbers, 2 for numbers with a point, 3 for any other text, null for no cell."""
    return (F.when(cell.rlike(r"^\s*[+-]?\d{1,18}\s*$"), 1)
            .when(cell.rlike(r"^\s*[+-]?(\d+\.\d*|\.\d+)([eE][+-]?\d+)?\s*$"), 2)
            .when(cell.isNotNull(), 3))


def typed_cells(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text columns in the type that holds all their cells: bigint for whole numbers, double once one has a
    point, and unchanged text as soon as one cell is no number (``32:10``, ``-``, an empty one).

    The kinds come from one aggregate over the rows (a map-side maximum per column).
    """
    kinds = rows.agg(*[F.max(cell_kind(F.col(f"`{n}`"))).alias(n) for n in names]).first().asDict()
    as_type = {1: "bigint", 2: "double"}
    return rows.withColumns({n: F.trim(F.col(f"`{n}`")).cast(as_type[k]) for n, k in kinds.items() if k in as_type})


# --------------------------------------------------------------------------
# S9-S13 links and ids
# --------------------------------------------------------------------------


def page_links(pages: DataFrame, href_pattern: str | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """``(page_id, link_no, href, text)`` for every anchor with an address (1-based
    ``link_no`` in document order), optionally only addresses in which a regex is found."""
    found = (blocks if blocks is not None else page_blocks(pages)).filter(F.col("kind") == "link")
    out = found.select("page_id", F.col("row_no").alias("link_no"), F.get("links", 0).alias("href"),
                       F.get("cells", 0).alias("text"))
    return out.filter(F.col("href").rlike(href_pattern)) if href_pattern else out


def first_seen_ids(links: DataFrame, pattern: str, group: Sequence[str] = ("page_id",),
                   order: str = "link_no") -> DataFrame:
    """Unique ids captured by ``pattern`` from hrefs, with the position
    where each was first seen (an aggregate: hot pages combine map-side)."""
    return all_ids(links, pattern, group, order).groupBy(*group, "id").agg(F.min(order).alias("first_seen"))


def all_ids(links: DataFrame, pattern: str, group: Sequence[str] = ("page_id",), order: str = "link_no") -> DataFrame:
    """S10, schedule variant: every captured id with its position, repeats included."""
    return links.select(*group, order, F.regexp_extract("href", pattern, 1).alias("id")).filter(F.col("id") != "")


def id_from_url(url: Column, primary: str, fallback: str) -> Column:
    """The id captured by ``primary``, else by ``fallback`` (null if neither)."""
    a = F.nullif(F.regexp_extract(url, primary, 1), F.lit(""))
    b = F.nullif(F.regexp_extract(url, fallback, 1), F.lit(""))
    return F.coalesce(a, b)


# Fixed pattern: "Away 70, Home 65" after the date in "date - Away 70, Home 65" headings.
SCORE_PATTERN = r"([\w\s\.\'\-\&]+)\s+(\d+)\s*,\s*([\w\s\.\'\-\&]+)\s+(\d+)"
# Fixed patterns: a team id in a URL, its fallback, addresses of teams, and a contest's id.
TEAM_ID_PATTERN = r"org_id=(\d+)"
TEAM_ID_FALLBACK = r"/team/(\d+)"
TEAM_LINK_PATTERN = r"org_id=\d+|/team/\d+"
CONTEST_ID_PATTERN = r"/contests/(\d+)(?:/|$|\?)"
CONTEST_BOX_PATTERN = r"/contests/(\d+)/box_score"


def _score_fields(text: Column) -> dict[str, Column]:
    dash = F.instr(text, "-")
    rest = F.when(dash > 0, F.trim(F.substr(text, dash + 1))).otherwise(F.trim(text))
    # The first match begins where a run of name characters does, so no other place need be tried, and
    # a heading without a number before a comma holds none: the work grows with the heading, not its square.
    named = r"(?<![\w\s\.\'\-\&])" + SCORE_PATTERN
    scored = rest.rlike(r"\d\s*,")
    part = lambda i: F.when(scored, F.nullif(F.trim(F.regexp_extract(rest, named, i)), F.lit("")))
    return {"game_date": F.when(dash > 0, F.trim(F.substring_index(text, "-", 1))), "away_team": part(1),
            "away_score": part(2).try_cast("int"), "home_team": part(3), "home_score": part(4).try_cast("int")}


def parse_score_headings(df: DataFrame, col: str = "heading") -> DataFrame:
    """S12 over a column of heading text."""
    return df.select(*df.columns, *[c.alias(n) for n, c in _score_fields(F.col(col)).items()])


def game_info(blocks: DataFrame) -> DataFrame:
    """S12 per page: the second-level headings are walked until one holds a score; the date
    is that of the last heading with a dash up to there.  Pages without a score keep the date."""
    read = blocks.filter(F.col("kind") == "page").select(
        "page_id", F.transform("cells", lambda h: F.struct(*[c.alias(n) for n, c in _score_fields(h).items()])).alias("h"))
    scored = F.transform("h", lambda x: x["away_team"].isNotNull())
    m = read.withColumn("m", F.coalesce(F.nullif(F.array_position(scored, True), F.lit(0)), F.size("h")).cast("int"))
    dates = F.filter(F.transform(F.slice("h", F.lit(1), F.col("m")), lambda x: x["game_date"]), lambda d: d.isNotNull())
    hit = F.get("h", F.col("m") - 1)
    return m.select("page_id", F.get(dates, F.size(dates) - 1).alias("game_date"),
                    *[hit[n].alias(n) for n in ("away_team", "away_score", "home_team", "home_score")])


def attach_ids(rows: DataFrame, pattern: str) -> DataFrame:
    """Per row the id of the first link inside it that matches (null without one)."""
    ids = F.filter(F.transform("links", lambda h: F.regexp_extract(h, pattern, 1)), lambda i: i != "")
    return rows.withColumn("id", F.get(ids, 0))


# --------------------------------------------------------------------------
# S19-S21 composite page loaders
# --------------------------------------------------------------------------


def teams_from_pages(blocks: DataFrame, id_pattern: str = TEAM_ID_PATTERN, id_fallback: str = TEAM_ID_FALLBACK,
                     link_pattern: str = TEAM_LINK_PATTERN) -> DataFrame:
    """``(page_id, college, team_id, link)`` from the rows of each page's first table;
    pages whose first table has none fall back to their links to teams.

    The college is the column ``team_name``, else the first; the link is the column
    ``team_href``, else the row's first link to a team, else the second column.
    """
    in_table = (F.col("kind") == "table") & (F.col("block_no") == 0) & (F.col("row_no") > 0)
    in_links = (F.col("kind") == "link") & (F.col("n_rows") < 2) & F.get("links", 0).rlike(link_pattern)
    cell = lambda i: F.get(F.col("cells"), i)
    column = lambda n: cell((F.array_position("header", F.lit(n)) - 1).cast("int"))
    to_team = F.get(F.filter("links", lambda h: h.rlike(link_pattern)), 0)
    second = F.when(F.col("n_cols") > 1, F.coalesce(cell(F.lit(1)), F.lit(""))).otherwise(F.lit(""))
    college = F.when(F.array_contains("header", "team_name"), column("team_name")).otherwise(cell(F.lit(0)))
    link = F.when(F.array_contains("header", "team_href"), column("team_href")).otherwise(F.coalesce(to_team, second))
    both = blocks.filter(in_table | in_links)
    is_link = F.col("kind") == "link"
    got = both.select("page_id", F.when(is_link, cell(F.lit(0))).otherwise(college).alias("college"),
                      F.when(is_link, F.get("links", 0)).otherwise(link).alias("link"))
    return got.select("page_id", "college", id_from_url(F.col("link"), id_pattern, id_fallback).alias("team_id"), "link")


def load_box_scores(pages: DataFrame, season: str) -> dict[str, DataFrame]:
    """A batch of box-score pages as two tables and a quarantine, out of one parse.

    ``players``: rows (see ``box_score_rows``) with the season; ``games``: game info per
    page; ``quarantine``: pages that are empty or cannot be read, with the reason.  The pages
    are made and parsed once; what the three tables are made of is written to the shared folder.
    """
    spark = pages.sparkSession
    parsed = page_blocks(pages, kinds=("table", "page", "error", "empty"))
    path = scratch_path(spark, f"tidewater-pages-{uuid.uuid4().hex}")
    kept = parsed.filter((F.col("kind") != "table") | _is_box_row()).select(
        "page_id", "kind", "block_no", "headings", "row_no", "cells", "header")
    kept.write.parquet(path)
    blocks = spark.read.schema(kept.schema).parquet(path)
    empty = blocks.filter(F.col("kind") == "empty").select("page_id", F.lit("empty page").alias("error"))
    failed = blocks.filter(F.col("kind") == "error").select("page_id", F.get("cells", 0).alias("error"))
    season_col = F.lit(season).alias("season")
    games = game_info(blocks).join(empty.select("page_id"), "page_id", "left_anti")
    return {"players": box_score_rows(blocks).select("*", season_col), "games": games.select("*", season_col),
            "quarantine": empty.unionByName(failed)}


def game_list(blocks: DataFrame, season: str, division: str, sport_code: str,
              pattern: str = CONTEST_ID_PATTERN) -> DataFrame:
    """The rows of a scoreboard page's first table with their contest id and the
    season, division and sport that were asked for."""
    rows = attach_ids(table_rows(blocks, first_table_only=True), pattern).withColumnRenamed("id", "contest_id")
    return rows.select("page_id", "row_no", "header", "cells", "contest_id", F.lit(season).alias("season"),
                       F.lit(division).alias("division"), F.lit(sport_code).alias("sport_code"))


def game_ids_with_fallback(primary: DataFrame, fallback: DataFrame, key: Sequence[str]) -> DataFrame:
    """Ids from the primary source (scoreboard) per key; keys with none
    take the fallback's unique ids (all team pages)."""
    have = primary.select(*key).distinct()
    fb = fallback.join(have, list(key), "left_anti")
    cols = [*key, "id"]
    return primary.select(*cols).unionByName(fb.select(*cols)).distinct()
