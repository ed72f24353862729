"""Ingest queries: JSON result sets (S2-S4, S22) and HTML pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.plans.registry import query
from tidewater.sources import pages as P
from tidewater.sources import resultsets as R
from tidewater.sources.tables import Tables

# --------------------------------------------------------------------------
# JSON result sets: events re-encoded as API responses, then decoded again
# --------------------------------------------------------------------------

EVENT_HEADERS = ("EVENT_ID", "TS", "USER_ID", "EVENT_TYPE", "VALUE", "PROPS")
EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"}
BATCH = 50


def event_payloads(t: Tables) -> DataFrame:
    """One response per batch of 50 consecutive event ids, cycling through
    the three payload shapes; batches whose first event is an error also get
    a truncated (malformed) copy.  Cells are mixed JSON numbers and strings."""
    ev = t.events
    props_json = F.expr("substr(to_json(array(props)), 2, length(to_json(array(props))) - 2)")
    row = F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit(',"'),
                   F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit('",'), F.col("user_id").cast("string"),
                   F.lit(',"'), F.col("event_type"), F.lit('",'), F.col("value").cast("string"), F.lit(","),
                   props_json, F.lit("]"))
    batches = (ev.select(F.floor(F.col("event_id") / BATCH).alias("batch"), "event_id", "event_type",
                         row.alias("row"))
               .groupBy("batch")
               .agg(F.array_join(F.collect_list("row"), ",").alias("rows"),
                    F.min_by("event_type", "event_id").alias("first_type")))
    headers = "[" + ",".join(f'"{h}"' for h in EVENT_HEADERS) + "]"
    body = F.concat(F.lit(f'"headers":{headers},"rowSet":['), F.col("rows"), F.lit("]"))
    shape = F.col("batch") % 3
    payload = (F.when(shape == 0, F.concat(F.lit('{"resultSets":[{"name":"Other","headers":["X"],"rowSet":[[1]]},'
                                                 '{"name":"Events",'), body, F.lit("}]}")))
               .when(shape == 1, F.concat(F.lit('{"resultSets":{'), body, F.lit("}}")))
               .otherwise(F.concat(F.lit('{"resultSet":{'), body, F.lit("}}"))))
    good = batches.select(F.col("batch").alias("payload_id"), payload.alias("payload"))
    bad = batches.filter(F.col("first_type") == "error").select(
        (-1 - F.col("batch")).alias("payload_id"), F.lit('{"resultSets": [{"name": "Events", "head').alias("payload"))
    return good.unionByName(bad)


@query("resultset_rows", "select event_id, ts, user_id, event_type, value, props from events")
def q_resultset_rows(t: Tables) -> DataFrame:
    """S2 + S3: decode every payload shape (named set with fallback), normalise
    header names, cast text cells; the result equals the source table."""
    rows, _ = R.decode_payloads(event_payloads(t), name="Events", columns=list(EVENT_TYPES))
    return R.cells_to_table(rows, list(EVENT_TYPES), EVENT_TYPES)


@query("resultset_all_columns", """
select cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, cast(user_id as varchar) as user_id,
       event_type from events
""")
def q_resultset_all_columns(t: Tables) -> DataFrame:
    """S2 + S3 with the output columns taken from the payloads' own headers (as text)."""
    rows, _ = R.decode_payloads(event_payloads(t), name="Events")
    return R.rows_to_table(rows).select("event_id", "ts", "user_id", "event_type")


@query("resultset_quarantine", f"""
with b as (select floor(event_id / {BATCH}) as batch, arg_min(event_type, event_id) as first_type
           from events group by 1)
select cast(-1 - batch as bigint) as payload_id, 'malformed json' as error from b where first_type = 'error'
""")
def q_resultset_quarantine(t: Tables) -> DataFrame:
    """Malformed responses are set aside, the rest load."""
    _, bad = R.decode_payloads(event_payloads(t), name="Events")
    return bad.select(F.col("payload_id").cast("bigint").alias("payload_id"), "error")


@query("resultset_lineage", f"""
select event_id, event_type, '2024' as season, '2023-24' as season_label, 'Regular Season' as season_type
from events
""")
def q_resultset_lineage(t: Tables) -> DataFrame:
    """Decoded rows tagged with season, season label and season type."""
    rows, _ = R.decode_payloads(event_payloads(t), name="Events")
    df = R.rows_to_table(rows, columns=["event_id", "event_type"], types=EVENT_TYPES)
    return R.tag_lineage(df, "2024", "Regular Season")


# --------------------------------------------------------------------------
# HTML pages
# --------------------------------------------------------------------------

_LINKS_SQL = r"""
with l as (
    select page_id,
           regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1) as hrefs,
           regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2) as texts
    from pages
),
u as (
    select page_id, unnest(range(1, len(hrefs) + 1)) as link_no, unnest(hrefs) as href, unnest(texts) as raw_text
    from l
)
select page_id, cast(link_no as integer) as link_no, href,
       trim(replace(replace(replace(replace(replace(regexp_replace(raw_text, '<[^>]*>', '', 'g'),
            '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) as text
from u
"""


@query("page_links", _LINKS_SQL)
def q_page_links(t: Tables) -> DataFrame:
    """Every anchor's href and text, numbered in document order."""
    return P.page_links(t.pages)


@query("page_all_ids", r"""
with links as (""" + _LINKS_SQL + r""")
select page_id, link_no, regexp_extract(href, '^/([A-Z][^/.,]*)', 1) as id from links
where regexp_extract(href, '^/([A-Z][^/.,]*)', 1) <> ''
""")
def q_page_all_ids(t: Tables) -> DataFrame:
    """S10, schedule variant: every id with its position, repeats included."""
    return P.all_ids(P.page_links(t.pages), r"^/([A-Z][^/.,]*)")


@query("page_first_ids", r"""
with links as (""" + _LINKS_SQL + r"""),
ids as (select page_id, link_no, regexp_extract(href, '^/([A-Z][^/.,]*)', 1) as id from links)
select page_id, id, cast(min(link_no) as integer) as first_seen from ids where id <> '' group by page_id, id
""")
def q_page_first_ids(t: Tables) -> DataFrame:
    """Unique ids from link targets per page with first-seen position."""
    return P.first_seen_ids(P.page_links(t.pages), r"^/([A-Z][^/.,]*)")


@query("page_url_ids", r"""
select page_id, coalesce(nullif(regexp_extract(url, 'page=(\d+)', 1), ''),
                         nullif(regexp_extract(url, '/(\d+)', 1), '')) as url_id
from pages
""")
def q_page_url_ids(t: Tables) -> DataFrame:
    """Id from the URL by a primary pattern, else a fallback pattern."""
    p = t.pages
    return p.select("page_id", P.id_from_url(F.col("url"), r"page=(\d+)", r"/(\d+)").alias("url_id"))


@query("page_list_rows", r"""
with l as (
    select page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) as items from pages
)
select page_id, 0 as block_no, cast(i - 1 as integer) as row_no,
       trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(items[i], '<[^>]*>', '', 'g'),
            '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) as item
from l, range(1, len(items) + 1) r(i)
""")
def q_page_list_rows(t: Tables) -> DataFrame:
    """S5 (list form): every list item of every page, parsed once per page in
    ``mapInPandas``; the pages carry lists, not tables."""
    b = P.page_blocks(t.pages)
    return b.filter(F.col("kind") == "list").select(
        "page_id", "block_no", "row_no", F.get(F.col("cells"), 0).alias("item"))


# --------------------------------------------------------------------------
# Box-score pages: lineitem encoded as HTML tables, then parsed back
# --------------------------------------------------------------------------

ORDERS_PER_PAGE = 20


def box_score_pages(t: Tables) -> DataFrame:
    """One page per 20 consecutive orders: second-level headings (one without a score, one
    with), navigation links, then per order a ``div.card`` with an h3 title and a stat table
    (header Player/MIN/PTS, one row per line, a TOTALS row, a one-cell row).  The first
    table of each page is a play-by-play: spans in its head, four data cells per line, a
    row of header cells, a three-cell row.  Attributes come in all quoting styles."""
    page = F.floor(F.col("l_orderkey") / ORDERS_PER_PAGE).alias("page_id")
    # one shuffle, of the plain columns: the lines of a page meet before they become text
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus", page) \
        .repartition("page_id")
    qty = F.col("l_quantity").cast("bigint").cast("string")
    num = F.col("l_linenumber").cast("string")
    stat_row = F.concat(F.lit("<tr><td>S"), F.col("l_suppkey").cast("string"), F.lit("</td><td>"), num, F.lit("</td><td>"), qty,
                        F.lit("</td></tr>"))
    event_row = F.concat(F.lit("<tr><td>"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("</td><td>line "), num,
                         F.lit(" &amp; more</td><td>"), F.col("l_returnflag"), F.lit("</td><td>"), F.col("l_linestatus"),
                         F.lit("</td></tr>"))
    per_order = li.groupBy("page_id", "l_orderkey").agg(
        F.array_join(F.collect_list(stat_row), "").alias("stats"),
        F.array_join(F.collect_list(event_row), "").alias("events"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"))
    key = F.col("l_orderkey").cast("string")
    long_heading = F.concat(F.lit("<h2>"), F.repeat(F.lit("a heading too long for a name "), 5), F.lit("</h2>"))
    card = F.concat(
        F.lit("<h3>Order "), key, F.lit("</h3><div class='wide card'><div>"), F.when(F.col("l_orderkey") % 2 == 0, long_heading).otherwise(""),
        F.lit("<table><tr><th>Player</th><th>MIN</th><th>PTS</th></tr>"), F.col("stats"),
        F.lit("<tr><td>Totals</td><td></td><td>"), F.col("total").cast("string"),
        F.lit("</td></tr><tr><td>x</td></tr></table><h3>Card "), key, F.lit("</h3></div></div>"))
    sort = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", c))),
                                              lambda x: x[c]), "")
    pages = (per_order.select("page_id", "l_orderkey", card.alias("card"), "events")
             .groupBy("page_id").agg(sort("card").alias("cards"), sort("events").alias("events"),
                                     F.min("l_orderkey").alias("first")))
    first = F.col("first").cast("string")
    top = F.concat(F.lit("<html><body><a href=/home>Home</a><h2>Box score</h2><h2>01/05/2026 - St. Away "), first,
                   F.lit(", Home&#39;s &amp; Co 7</h2><h2>Later - Not This 1, One 2</h2><h4></h4><table><thead><tr><th><span>Home "), first,
                   F.lit("</span></th><th><span>Away</span></th></tr></thead>"))
    return pages.select("page_id", F.lit("").alias("url"),
                        F.concat(top, F.col("events"), F.lit("<tr><th>a</th><th>b</th><th>c</th><th>d</th></tr>"
                                                             "<tr><td>1</td><td>2</td><td>3</td></tr></table>"),
                                 F.col("cards"), F.lit("</body></html>")).alias("html"))


_PAGE = f"cast(floor(l_orderkey / {ORDERS_PER_PAGE}) as bigint)"


@query("page_box_scores", f"""
select {_PAGE} as page_id, 'Order ' || l_orderkey as team_name, 'S' || l_suppkey as player,
       cast(l_linenumber as double) as min, cast(cast(l_quantity as bigint) as double) as pts
from lineitem
""")
def q_page_box_scores(t: Tables) -> DataFrame:
    """S5 + S6 + S14: stat tables found by their header markers, total and short rows
    skipped; the team is the nearest short heading (a long one stands before every other
    table); cells are keyed by header name and coerced to numbers."""
    rows = P.box_score_rows(P.page_blocks(box_score_pages(t), kinds=("table",)))
    return P.stat_columns(rows, ["player", "min", "pts"], numbers=["min", "pts"]).select("page_id", "team_name", "player", "min", "pts")


@query("page_stat_cards", f"""
select {_PAGE} as page_id, 'Card ' || l_orderkey as team,
       ['S' || l_suppkey, cast(l_linenumber as varchar), cast(cast(l_quantity as bigint) as varchar)] as cells
from lineitem
union all
select distinct {_PAGE}, 'Card ' || l_orderkey, ['x'] from lineitem
""")
def q_page_stat_cards(t: Tables) -> DataFrame:
    """Rows of the first table inside each ``div.card``, keyed by the card's title
    (which comes after the table here); total rows are skipped."""
    return P.stat_card_rows(P.page_blocks(box_score_pages(t), kinds=("table",))).select("page_id", "team", "cells")


@query("page_play_by_play", f"""
with firsts as (select {_PAGE} as page_id, min(l_orderkey) as first from lineitem group by 1)
select f.page_id, 'Home ' || f.first as home_team, 'Away' as away_team, strftime(l_shipdate, '%Y-%m-%d') as time,
       'line ' || l_linenumber || ' & more' as description
from lineitem l join firsts f on {_PAGE} = f.page_id
""")
def q_page_play_by_play(t: Tables) -> DataFrame:
    """Rows with four data cells of the first table; teams from its head's spans."""
    return P.play_by_play_rows(P.page_blocks(box_score_pages(t), kinds=("table",))).drop("row_no")


@query("page_headings", f"""
select {_PAGE} as page_id, '01/05/2026' as game_date, 'St. Away' as away_team, cast(min(l_orderkey) as integer) as away_score,
       'Home''s & Co' as home_team, 7 as home_score
from lineitem group by 1
""")
def q_page_headings(t: Tables) -> DataFrame:
    """The second-level headings are walked to the first one with a score."""
    return P.game_info(P.page_blocks(box_score_pages(t), kinds=("page",)))


@query("page_all_headings", r"""
select page_id, len(regexp_extract_all(html, '<h2>')) as n from pages
""")
def q_page_all_headings(t: Tables) -> DataFrame:
    """The second-level headings of every driver page (none of them has one)."""
    return P.page_blocks(t.pages, kinds=("page",)).filter(F.col("kind") == "page").select("page_id", F.size("cells").cast("long").alias("n"))


def team_pages(t: Tables) -> DataFrame:
    """Team list pages, one per nation.  Even nations list their suppliers in a table, whose
    odd rows link to the team while others name the address in the second column; odd
    nations have links only (quoted all ways, over two lines), a header table and other links."""
    s = t.supplier
    key, even = F.col("s_suppkey").cast("string"), F.col("s_nationkey") % 2 == 0
    by_row = F.when(F.col("s_suppkey") % 2 == 1, F.concat(
        F.lit('<tr><td><a\n class=x href="/team/'), key, F.lit('">'), F.col("s_name"), F.lit("</a></td><td><a href=/help>?</a></td></tr>"))) \
        .otherwise(F.concat(F.lit("<tr><td>"), F.col("s_name"), F.lit("</td><td>/x?org_id="), key, F.lit("&amp;y=1</td></tr>")))
    by_link = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("<a href='/team/"), key, F.lit("'>"))) \
        .when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit('<A HREF="/x?a=1&amp;org_id='), key, F.lit('">'))) \
        .otherwise(F.concat(F.lit("<a href=/team/"), key, F.lit(">")))
    link = F.concat(by_link, F.lit("Team\n  &quot;"), F.col("s_name"), F.lit("&quot; &eacute;</a><a href='/about'>no</a>"))
    body = F.array_join(F.array_sort(F.collect_list(F.when(even, by_row).otherwise(link))), "")
    page = F.when(even, F.concat(F.lit('<table><tr><th>Team</th><th>Info</th></tr>'), F.col("b"), F.lit("</table><a href='/team/0'>nav</a>"))) \
        .otherwise(F.concat(F.lit("<table><tr><th>Team</th></tr></table>"), F.col("b")))
    return (s.groupBy("s_nationkey").agg(body.alias("b"))
            .select(F.col("s_nationkey").cast("long").alias("page_id"), F.lit("").alias("url"), page.alias("html"), "s_nationkey"))


@query("page_teams", """
select cast(s_nationkey as bigint) as page_id,
       case when s_nationkey % 2 = 0 then s_name else 'Team "' || s_name || '" é' end as college,
       cast(s_suppkey as varchar) as team_id,
       case when s_nationkey % 2 = 0 then case when s_suppkey % 2 = 1 then '/team/' || s_suppkey else '/x?org_id=' || s_suppkey || '&y=1' end
            when s_suppkey % 3 = 1 then '/x?a=1&org_id=' || s_suppkey else '/team/' || s_suppkey end as link
from supplier
""")
def q_page_teams(t: Tables) -> DataFrame:
    """Team rows from each page's first table, with the link of the row or its second
    column; pages without table rows from their links to teams alone."""
    return P.teams_from_pages(P.page_blocks(team_pages(t)))


def scoreboard_pages(t: Tables) -> DataFrame:
    """Scoreboards, one per order year: a navigation link to a contest, then a table with a
    row per order; urgent orders have no link, others two (the second to another contest)."""
    o = t.orders
    key = F.col("o_orderkey").cast("string")
    link = F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(F.concat(
        F.lit('<a href="/players/1">p</a><a href="/contests/'), key, F.lit('/box_score">b</a><a href="/contests/7">x</a>')))
    row = F.concat(F.lit("<tr><td>"), key, F.lit("</td><td>"), link, F.lit("</td></tr>"))
    # in order by ranges: a page is put together from the texts of its ranges, not from its rows
    rows = (o.select(F.year("o_orderdate").cast("long").alias("page_id"), row.alias("row")).repartitionByRange("page_id", "row")
            .withColumn("part", F.spark_partition_id()))
    parts = rows.groupBy("page_id", "part").agg(F.array_join(F.array_sort(F.collect_list("row")), "").alias("text"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "")
    return (parts.groupBy("page_id").agg(body.alias("b"))
            .select("page_id", F.lit("").alias("url"),
                    F.concat(F.lit('<a href="/contests/1">top</a><table><tr><th>No</th><th>Link</th></tr>'), F.col("b"), F.lit("</table>")).alias("html")))


@query("page_rows_with_ids", """
select cast(year(o_orderdate) as bigint) as page_id, cast(o_orderkey as varchar) as no,
       case when o_orderpriority <> '1-URGENT' then cast(o_orderkey as varchar) end as contest_id,
       '2026' as season, '1' as division, 'MBB' as sport_code
from orders
""")
def q_page_rows_with_ids(t: Tables) -> DataFrame:
    """S11 + S21: each row gets the id of the first matching link inside it (none without
    one, whatever links stand elsewhere), and the season, division and sport asked for."""
    rows = P.game_list(P.page_blocks(scoreboard_pages(t), kinds=("table",)), "2026", "1", "MBB")
    return rows.select("page_id", F.get("cells", 0).alias("no"), "contest_id", "season", "division", "sport_code")


def _broken_box_scores(t: Tables) -> DataFrame:
    """Box-score pages of a batch in which some fetches came back empty (page number
    divisible by 5) and some broken off inside a comment (by 7)."""
    cut = F.concat(F.substring("html", 1, 60), F.lit("<!-- broken off"))
    return box_score_pages(t).withColumn("html", F.when(F.col("page_id") % 5 == 0, F.lit("  "))
                                         .when(F.col("page_id") % 7 == 0, cut).otherwise(F.col("html")))


@query("page_batch_players", f"""
select {_PAGE} as page_id, 'S' || l_suppkey as player, cast(cast(l_quantity as bigint) as double) as pts, '2026' as season
from lineitem where {_PAGE} % 5 <> 0 and {_PAGE} % 7 <> 0
""")
def q_page_batch_players(t: Tables) -> DataFrame:
    """The player rows of a batch with broken pages."""
    got = P.load_box_scores(_broken_box_scores(t), "2026")["players"]
    return P.stat_columns(got, ["player", "pts"], numbers=["pts"]).select("page_id", "player", "pts", "season")


@query("page_batch_games", f"""
select {_PAGE} as page_id, 'St. Away' as away_team, cast(min(l_orderkey) as integer) as away_score, '2026' as season
from lineitem where {_PAGE} % 5 <> 0 and {_PAGE} % 7 <> 0 group by 1
""")
def q_page_batch_games(t: Tables) -> DataFrame:
    """One game row per page that could be read, from the same parse."""
    return P.load_box_scores(_broken_box_scores(t), "2026")["games"].select("page_id", "away_team", "away_score", "season")


@query("page_quarantine", f"""
select distinct {_PAGE} as page_id, case when {_PAGE} % 5 = 0 then 'empty page' else 'page ends inside a comment' end as error
from lineitem where {_PAGE} % 5 = 0 or {_PAGE} % 7 = 0
""")
def q_page_quarantine(t: Tables) -> DataFrame:
    """The pages of the batch that gave nothing, with the reason."""
    return P.load_box_scores(_broken_box_scores(t), "2026")["quarantine"]


@query("game_ids_fallback", """
with primary_ids as (
    select distinct cast(year(o_orderdate) as varchar) as season, cast(o_orderkey as varchar) as id from orders
    where o_orderstatus = 'F' and o_orderpriority = '1-URGENT' and year(o_orderdate) < 1998
),
fallback_ids as (
    select distinct cast(year(o.o_orderdate) as varchar) as season, cast(l.l_orderkey as varchar) as id
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey
)
select * from primary_ids
union all
select * from fallback_ids f where f.season not in (select season from primary_ids)
""")
def q_game_ids_fallback(t: Tables) -> DataFrame:
    """Per season, the scoreboard's game ids when it has any, else the
    unique ids gathered from all team pages."""
    o = t.orders
    primary = (o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
                        & (F.year("o_orderdate") < 1998))
               .select(F.year("o_orderdate").cast("string").alias("season"), F.col("o_orderkey").cast("string").alias("id"))
               .distinct())
    fallback = (t.lineitem.select("l_orderkey").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
                .select(F.year("o_orderdate").cast("string").alias("season"), F.col("l_orderkey").cast("string").alias("id")))
    return P.game_ids_with_fallback(primary, fallback, ["season"]).select("season", "id")
