"""HTML page parsing on inline fixtures (ragged, malformed, totals, cards, play-by-play)."""

from pyspark.sql import functions as F

from conftest import rows
from tidewater.sources import pages as P

BOX = """<html><body><h2>01/05/2026 - Gonzaga 70, Baylor 65</h2>
<h3>Gonzaga</h3><table><tr><th>Player</th><th>MIN</th><th>PTS</th></tr>
<tr><td>Smith</td><td>30</td><td>21</td></tr><tr><td>Jones</td><td>12</td></tr>
<tr><td>TOTALS</td><td>200</td><td>70</td></tr><tr><td>x</td></tr></table>
<h3>Notes</h3><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>
<div class="card"><h3>Baylor</h3><table><tr><th>Name</th><th>FG%</th></tr><tr><td>Lee</td><td>.500</td><td>extra</td></tr></table></div>
<table><tr><td>H</td><td>A</td><td>10:00</td><td>Jump ball &amp; tip</td></tr></table>
<ul><li><a href="/team/12">Team &amp; Co</a></li><li>Plain</li></ul></body></html>"""


def _pages(spark, items):
    return spark.createDataFrame(items, "page_id bigint, url string, html string")


def test_blocks_tables_lists_headings(spark):
    b = P.page_blocks(_pages(spark, [(1, "u", BOX)]))
    tables = b.filter(F.col("kind") == "table").collect()
    assert {r["block_no"] for r in tables} == {0, 1, 2, 3}
    first = sorted((r["row_no"], r["cells"]) for r in tables if r["block_no"] == 0)
    assert first[0][1] == ["Player", "MIN", "PTS"] and first[2][1] == ["Jones", "12"]
    assert {r["headings"][0] for r in tables if r["block_no"] == 0} == {"Gonzaga"}
    lists = rows(b.filter(F.col("kind") == "list").select("row_no", F.col("cells")[0]))
    assert lists == [(0, "Team & Co"), (1, "Plain")]


def test_table_rows_pad_ragged_and_name_extra_columns(spark):
    b = P.page_blocks(_pages(spark, [(1, "u", BOX)]))
    card = P.table_rows(b).filter(F.col("block_no") == 2).collect()[0]
    assert card["header"] == ["Name", "FG%", "col_2"] and card["cells"] == ["Lee", ".500", "extra"]
    smith = [r for r in P.table_rows(b).filter(F.col("block_no") == 0).collect() if r["row_no"] == 2][0]
    assert smith["cells"] == ["Jones", "12", ""]


def test_box_score_rows_skip_totals_and_short_rows(spark):
    b = P.page_blocks(_pages(spark, [(1, "u", BOX)]))
    got = P.box_score_rows(b).collect()
    assert sorted(r["cells"][0] for r in got) == ["Jones", "Smith"]
    assert {r["team_name"] for r in got} == {"Gonzaga"}
    wide = P.stat_columns(P.box_score_rows(b), ["player", "min", "pts"]).collect()
    assert sorted((r["player"], r["min"], r["pts"]) for r in wide) == [("Jones", "12", None), ("Smith", "30", "21")]


def test_stat_cards(spark):
    page = BOX.replace("<h3>Baylor</h3>", "") + '<div class="card x"><table><tr><th>A b%</th><th>%</th><th></th></tr><tr><td>Team</td></tr>' \
        "<tr><td>q</td><td>2</td><td>3</td></tr></table><table><tr><th>second</th></tr><tr><td>no</td></tr></table><h3>Late title</h3></div>"
    cards = sorted((r["team"], r["header"], r["cells"]) for r in P.stat_card_rows(P.page_blocks(_pages(spark, [(1, "u", page)]))).collect())
    assert cards == [("", ["name", "fg"], ["Lee", ".500"]), ("Late title", ["a_b", "col_1", "col_2"], ["q", "2", "3"])]


def test_play_by_play_takes_the_first_table(spark):
    page = """<table><thead><tr><th><span> Duke </span></th><th><span>Baylor</span></th></tr></thead>
    <tr><td>10:00</td><td>Jump ball &amp; tip</td><td>0</td><td>0</td></tr><tr><th>a</th><th>b</th><th>c</th><th>d</th></tr>
    <tr><td>9:00</td><td>short</td></tr></table><table><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr></table>"""
    got = P.play_by_play_rows(P.page_blocks(_pages(spark, [(1, "u", page)]))).collect()
    assert [tuple(r)[2:] for r in got] == [("Duke", "Baylor", "10:00", "Jump ball & tip")]


def test_long_headings_are_no_team_names(spark):
    long = "x" * 90
    page = f"<h2>Duke</h2><div><h3>{long}</h3><table><tr><th>MIN</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table></div>"
    b = P.page_blocks(_pages(spark, [(1, "u", page)]))
    assert [r["team_name"] for r in P.box_score_rows(b).collect()] == ["Duke"]
    assert b.filter("kind = 'table'").first()["headings"] == [long, "Duke"]


def test_numbers_are_coerced(spark):
    page = "<table><tr><th>Player</th><th>MIN</th><th>FG</th></tr><tr><td>a</td><td> 7.5</td><td>5-12</td></tr></table>"
    rows_ = P.box_score_rows(P.page_blocks(_pages(spark, [(1, "u", page)])))
    got = P.stat_columns(rows_, ["player", "min", "fg"], numbers=["min", "fg"]).first()
    assert (got["player"], got["min"], got["fg"]) == ("a", 7.5, None)


def test_no_table_empty_and_malformed_pages(spark):
    pages = _pages(spark, [(1, "u", "<p>no tables</p>"), (2, "u", "<table></table>"), (3, "u", None),
                           (4, "u", "<table><tr><td>a<td>b<tr><td>c"), (5, "u", "")])
    b = P.page_blocks(pages)
    got = rows(b.filter("kind = 'table'").select("page_id", "row_no", "cells"))
    assert got == [(4, 0, ["a", "b"]), (4, 1, ["c"])]
    broken = pages.unionByName(_pages(spark, [(6, "u", "<table><tr><td>x</td></tr></table><!-- broken off"), (7, "u", BOX)]))
    out = P.load_box_scores(broken, "2026")
    assert sorted(tuple(r) for r in out["quarantine"].collect()) == [(3, "empty page"), (5, "empty page"), (6, "page ends inside a comment")]
    assert {r["page_id"] for r in out["players"].collect()} == {7}
    games = {r["page_id"]: r["away_team"] for r in out["games"].collect()}
    assert games == {1: None, 2: None, 4: None, 7: "Gonzaga"}


ANCHORS = """<a href="/a">plain</a><A class=b HREF='/b?x=1&amp;y=2'>single <b>quoted</b></A><a
  href=/c>over
two lines &eacute;&nbsp;!</a><a name="no">no address</a><a title="a > b" href="/d"></a>"""


def test_all_ordinary_anchors_are_links(spark):
    links = P.page_links(_pages(spark, [(1, "u", ANCHORS)])).collect()
    assert [(r["link_no"], r["href"], r["text"]) for r in links] == [
        (1, "/a", "plain"), (2, "/b?x=1&y=2", "single quoted"), (3, "/c", "over two lines \u00e9 !"), (4, "/d", "")]
    assert P.page_links(_pages(spark, [(1, "u", ANCHORS)]), r"^/[bd]").count() == 2


def test_ids_come_from_links_inside_the_row(spark):
    page = """<a href="/contests/9">nav</a><table><tr><th>g</th></tr><tr><td><a href="/x">x</a><a href="/contests/11/box">y</a>
    <a href="/contests/12">z</a></td></tr><tr><td>no link</td></tr></table>"""
    rows_ = P.table_rows(P.page_blocks(_pages(spark, [(1, "u", page)])))
    assert [r["id"] for r in P.attach_ids(rows_, P.CONTEST_ID_PATTERN).orderBy("row_no").collect()] == ["11", None]


def test_game_info_walks_the_headings(spark):
    pages = _pages(spark, [(1, "u", "<h2>Nov 3 - Preview</h2><h2>Duke 70, Baylor 65</h2><h2>Later - A 1, B 2</h2>"),
                           (2, "u", "<h2>Dec 1 - no score</h2>"), (3, "u", "<h1>x</h1>")])
    got = [tuple(r) for r in P.game_info(P.page_blocks(pages)).orderBy("page_id").collect()]
    assert got == [(1, "Nov 3", "Duke", 70, "Baylor", 65), (2, "Dec 1", None, None, None, None), (3, None, None, None, None, None)]


def test_links_ids_and_headings(spark):
    pages = _pages(spark, [(1, "https://x/team/77?org_id=5", BOX)])
    links = P.page_links(pages).collect()
    assert [(r["link_no"], r["href"], r["text"]) for r in links] == [(1, "/team/12", "Team & Co")]
    assert P.first_seen_ids(P.page_links(pages), r"/team/(\d+)").collect()[0]["id"] == "12"
    ids = pages.select(P.id_from_url(F.col("url"), r"org_id=(\d+)", r"/team/(\d+)").alias("i"),
                       P.id_from_url(F.col("url"), r"nope=(\d+)", r"/team/(\d+)").alias("j")).collect()[0]
    assert (ids["i"], ids["j"]) == ("5", "77")
    h = spark.createDataFrame([("01/05/2026 - Gonzaga 70, Baylor 65",), ("Saint Mary's 55, BYU 60",), ("x",)], "heading string")
    got = [(r["game_date"], r["away_team"], r["away_score"], r["home_team"], r["home_score"])
           for r in P.parse_score_headings(h).collect()]
    assert got[0] == ("01/05/2026", "Gonzaga", 70, "Baylor", 65)
    assert got[1] == (None, "Saint Mary's", 55, "BYU", 60)
    assert got[2] == (None, None, None, None, None)


def test_teams_from_pages_rows_else_links(spark):
    with_table = "<table><tr><th>College</th><th>Link</th></tr><tr><td>Gonzaga</td><td>/team/3</td></tr>" \
        "<tr><td><a href='/team/7'>Duke</a></td></tr></table><a href='/team/1'>ignored</a>"
    named = "<table><tr><th>x</th><th>team_href</th><th>team_name</th></tr><tr><td>1</td><td>?org_id=5</td><td>UCLA</td></tr></table>"
    pages = _pages(spark, [(1, "u", with_table), (2, "u", '<a href="/team/9">Baylor</a><a href="/about">About</a>'), (3, "u", named)])
    got = rows(P.teams_from_pages(P.page_blocks(pages)))
    assert got == [(1, "Duke", "7", "/team/7"), (1, "Gonzaga", "3", "/team/3"), (2, "Baylor", "9", "/team/9"), (3, "UCLA", "5", "?org_id=5")]


def test_game_ids_with_fallback(spark):
    primary = spark.createDataFrame([("2026", "a"), ("2026", "b")], "season string, id string")
    fallback = spark.createDataFrame([("2026", "z"), ("2025", "c"), ("2025", "c"), ("2025", "d")],
                                     "season string, id string")
    got = rows(P.game_ids_with_fallback(primary, fallback, ["season"]))
    assert got == [("2025", "c"), ("2025", "d"), ("2026", "a"), ("2026", "b")]


def test_header_wider_than_rows_is_truncated(spark):
    page = "<table><tr><th>A</th><th>B</th><th>C</th><th>D</th></tr><tr><td>1</td><td>2</td></tr>" \
           "<tr><td>3</td></tr></table>"
    b = P.page_blocks(_pages(spark, [(1, "u", page)]))
    got = sorted((r["row_no"], r["header"], r["cells"]) for r in P.table_rows(b).collect())
    assert got == [(1, ["A", "B"], ["1", "2"]), (2, ["A", "B"], ["3", ""])]


def test_empty_rows_and_null_page_id(spark):
    pages = _pages(spark, [(1, "u", "<table><tr><th>A</th></tr><tr></tr></table>"), (None, "u", "<ul><li>x</li></ul>")])
    b = P.page_blocks(pages)
    assert rows(b.filter("kind in ('table', 'list')").select("kind", "page_id")) == [("list", None), ("table", 1), ("table", 1)]
    got = P.table_rows(b).collect()
    assert [(r["header"], r["cells"]) for r in got] == [([], [])]


def test_large_pages_are_read_in_pieces(spark, monkeypatch):
    """A page cut at every few bytes gives the rows of the page read at once, and no task holds its rows."""
    page = BOX.replace("Plain", "Plain &eacute; é <!-- no --> x") + "<table><tr><td>wide</td><td a='>'>b</td></tr></table><a href=/z>open &amp;"
    one = rows(P.page_blocks(_pages(spark, [(1, "u", page), (None, "u", ""), (2, "u", page + "<!-- broken")])))
    held = []
    monkeypatch.setattr(P, "PIECE", 11)
    drain = P._Page.drain
    monkeypatch.setattr(P._Page, "drain", lambda self, *a: (held.append(len(self.fresh)), drain(self, *a))[1])
    pieces = P._read_pieces(P.KINDS, P.to_arrow_schema(P.BLOCK_SCHEMA))
    data, n = page.encode(), -(-len(page.encode()) // 11)
    batch = P.pa.RecordBatch.from_pydict({"page_id": [1] * 2 * n, "n": [n] * 2 * n, "i": list(range(2 * n)),
                                          "piece": [data[k * 11:k * 11 + 11] for k in [*range(n), *range(n)]]})
    got = [r for b in pieces(iter([batch])) for r in b.to_pylist()]
    assert len(got) == len([r for r in one if r[0] == 1]) and len(held) == 2 * n and max(held) <= 2
    monkeypatch.undo()
    monkeypatch.setattr(P, "PIECE", 11)
    assert rows(P.page_blocks(_pages(spark, [(1, "u", page), (None, "u", ""), (2, "u", page + "<!-- broken")]))) == one


def test_only_the_kinds_asked_for(spark):
    pages = _pages(spark, [(1, "u", BOX), (2, "u", "  "), (3, "u", "<!-- cut")])
    assert rows(P.page_blocks(pages, ["page"])) == rows(P.page_blocks(pages).filter("kind = 'page'"))
    assert rows(P.page_blocks(pages, ["empty", "error"]).select("page_id", "kind")) == [(2, "empty"), (3, "error")]


def test_headings_cost_in_proportion_to_their_length(spark):
    """The square of 40,000 characters took minutes for each of the four fields."""
    import time
    names = "a heading without a score " * 1600
    pages = _pages(spark, [(1, "u", f"<h2>{names}</h2><h2>{names}, {names} 7</h2><h2>5 May - A. B 7 , C's 9</h2>")])
    began = time.time()
    got = P.game_info(P.page_blocks(pages, ["page"])).first()
    assert tuple(got) == (1, "5 May", "A. B", 7, "C's", 9) and time.time() - began < 20


def test_a_batch_is_made_and_parsed_once(spark):
    made = spark.sparkContext.accumulator(0)

    def make(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    pages = _pages(spark, [(1, "u", BOX), (2, "u", " "), (3, "u", "<!-- cut"), (None, "u", None)]).mapInArrow(make, "page_id long, url string, html string")
    got = P.load_box_scores(pages, "2026")
    assert rows(got["quarantine"]) == [(2, "empty page"), (3, "page ends inside a comment"), (None, "empty page")]
    assert sorted((r["page_id"] or 0) for r in got["games"].collect()) == [0, 1] and got["players"].count() == 2
    assert made.value == 4
