"""Relational queries: predicates, joins, set operations, windows, series, listagg."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.exprs import equals, season_label
from tidewater.operators import joins, reshape
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables


@query("ilike_distinct", """
select distinct p_brand, p_type from part
where p_name ilike '%RED%' and p_type not ilike '%small%'
""")
def q_ilike_distinct(t: Tables) -> DataFrame:
    """P9 + A7: case-insensitive pattern filter, group-by dedupe."""
    p = t.part
    return (p.filter(F.col("p_name").ilike("%RED%") & ~F.col("p_type").ilike("%small%"))
            .select("p_brand", "p_type").distinct())


@query("in_list_filter", """
select l_returnflag, cast(count(*) as bigint) as n from lineitem
where l_returnflag in ('A', 'R') and l_shipdate >= timestamp '1997-01-01' and l_shipdate < timestamp '1999-01-01'
group by l_returnflag
""")
def q_in_list_filter(t: Tables) -> DataFrame:
    """P8 + P10: IN list and a half-open range predicate (both pushed to the scan)."""
    li = t.lineitem
    keep = (F.col("l_returnflag").isin("A", "R")
            & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
            & (F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    return li.filter(keep).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("role_playing_dim", """
select sn.n_name as supp_nation, cn.n_name as cust_nation, cast(count(*) as bigint) as n_lines
from lineitem l
join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey
join supplier s on l.l_suppkey = s.s_suppkey
left join nation sn on s.s_nationkey = sn.n_nationkey
left join nation cn on c.c_nationkey = cn.n_nationkey
group by 1, 2
""")
def q_role_playing_dim(t: Tables) -> DataFrame:
    """One dimension (nation) joined twice under two roles."""
    li, o, c, s = t.lineitem, t.orders, t.customer, t.supplier
    nation = t.nation.select("n_nationkey", "n_name")
    sn = nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("supp_nation"))
    cn = nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cust_nation"))
    j = (li.select("l_orderkey", "l_suppkey")
         .join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .join(s.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(sn, F.col("s_nationkey") == F.col("sn_key"), "left")
         .join(cn, F.col("c_nationkey") == F.col("cn_key"), "left"))
    return j.groupBy("supp_nation", "cust_nation").agg(F.count(F.lit(1)).alias("n_lines"))


def _orders_in_year(t: Tables, year: int) -> DataFrame:
    return t.orders.filter(F.year("o_orderdate") == year)


@query("semi_join_keys", """
select c_custkey, c_name from customer c
where exists (select 1 from orders o where o.o_custkey = c.c_custkey and year(o.o_orderdate) = 1998)
""")
def q_semi_join_keys(t: Tables) -> DataFrame:
    """Keys present in another relation (left semi join)."""
    return t.customer.select("c_custkey", "c_name").join(
        _orders_in_year(t, 1998).select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


@query("anti_join_orphans", """
select c_custkey, c_name from customer c
where not exists (select 1 from orders o where o.o_custkey = c.c_custkey and year(o.o_orderdate) = 1998)
""")
def q_anti_join_orphans(t: Tables) -> DataFrame:
    """Keys missing from another relation (left anti join)."""
    return t.customer.select("c_custkey", "c_name").join(
        _orders_in_year(t, 1998).select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("null_safe_equals", """
with x as (
    select nullif(o_orderstatus, 'P') as a,
           case when o_orderpriority like '1%' then null else o_orderstatus end as b
    from orders
)
select (a is not distinct from b) as eq_nulls_equal, (a = b) as eq_plain, cast(count(*) as bigint) as n
from x group by 1, 2
""")
def q_null_safe_equals(t: Tables) -> DataFrame:
    """Equality with and without nulls comparing equal."""
    o = t.orders
    x = o.select(F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("a"),
                 F.when(~F.col("o_orderpriority").like("1%"), F.col("o_orderstatus")).alias("b"))
    return (x.select(equals("a", "b", True).alias("eq_nulls_equal"), equals("a", "b", False).alias("eq_plain"))
            .groupBy("eq_nulls_equal", "eq_plain").agg(F.count(F.lit(1)).alias("n")))


TOTAL_LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
                    "l_returnflag", "l_linestatus", "l_shipdate")


@query("top_scorers", """
select l_orderkey, l_linenumber, l_suppkey, l_extendedprice from lineitem
order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount,
         l_tax, l_returnflag, l_linestatus, l_shipdate
limit 10
""")
def q_top_scorers(t: Tables) -> DataFrame:
    """Top-k with a total tie-break order (k rows kept per task, then merged)."""
    order = [F.col("l_extendedprice").desc(), *[F.col(c).asc() for c in TOTAL_LINE_ORDER]]
    return reshape.top_k(t.lineitem, order, 10).select("l_orderkey", "l_linenumber", "l_suppkey",
                                                         "l_extendedprice")


@query("top_n_per_group", """
select l_suppkey, l_orderkey, l_linenumber, l_extendedprice, cast(rn as bigint) as rn from (
    select *, row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey,
        l_linenumber, l_partkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as rn
    from lineitem
) where rn <= 3
""")
def q_top_n_per_group(t: Tables) -> DataFrame:
    """W1 + W5: rank within a partition, keep the first three (salted, skew-safe)."""
    li = t.lineitem
    order = [F.col("l_extendedprice").desc(), *[F.col(c).asc() for c in TOTAL_LINE_ORDER if c != "l_suppkey"]]
    out = reshape.top_n_per_group(li, ["l_suppkey"], order, 3, rank_col="rn")
    return out.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice",
                      F.col("rn").cast("bigint").alias("rn"))


@query("ordered_distinct_head", """
select distinct o_custkey from orders where o_orderstatus = 'F' order by o_custkey limit 25
""")
def q_ordered_distinct_head(t: Tables) -> DataFrame:
    """Ordered distinct keys, first n (the limit is the feature)."""
    return (t.orders.filter(F.col("o_orderstatus") == "F").select("o_custkey").distinct()
            .orderBy("o_custkey").limit(25))


@query("dedupe_latest", """
select event_id, ts, user_id, event_type, value, props from (
    select *, row_number() over (partition by user_id, event_type
                                 order by ts desc, event_id desc, value desc, props desc) as rn
    from events
) where rn = 1
""")
def q_dedupe_latest(t: Tables) -> DataFrame:
    """Latest row per (user, type); an aggregate, so hot keys combine map-side."""
    ev = t.events.select("event_id", "ts", "user_id", "event_type", "value", "props")
    return reshape.keep_one_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"], latest=True)


def _cust_keys(t: Tables, year: int) -> DataFrame:
    return _orders_in_year(t, year).select(F.col("o_custkey").alias("custkey"))


@query("union_all", """
select custkey, cast(count(*) as bigint) as n from (
    select o_custkey as custkey from orders where year(o_orderdate) = 1996
    union all
    select o_custkey as custkey from orders where year(o_orderdate) = 1997
) group by custkey
""")
def q_union_all(t: Tables) -> DataFrame:
    """Bag union (no dedupe), then counted."""
    u = _cust_keys(t, 1996).unionByName(_cust_keys(t, 1997))
    return u.groupBy("custkey").agg(F.count(F.lit(1)).alias("n"))


@query("except_keys", """
select o_custkey as custkey from orders where year(o_orderdate) = 1996
except
select o_custkey as custkey from orders where year(o_orderdate) = 1997
""")
def q_except_keys(t: Tables) -> DataFrame:
    """Set difference (distinct)."""
    return _cust_keys(t, 1996).subtract(_cust_keys(t, 1997))


@query("intersect_keys", """
select o_custkey as custkey from orders where year(o_orderdate) = 1996
intersect
select o_custkey as custkey from orders where year(o_orderdate) = 1997
""")
def q_intersect_keys(t: Tables) -> DataFrame:
    """U4: set intersection (distinct)."""
    return _cust_keys(t, 1996).intersect(_cust_keys(t, 1997))


@query("ragged_union", """
select event_id, ts, user_id, cast(null as varchar) as event_type, cast(null as double) as value
from events where event_type = 'click'
union all
select event_id, cast(null as timestamp) as ts, cast(null as bigint) as user_id, event_type, value
from events where event_type <> 'click'
""")
def q_ragged_union(t: Tables) -> DataFrame:
    """Union by name of frames with different columns (missing -> null)."""
    ev = t.events
    a = ev.filter(F.col("event_type") == "click").select("event_id", "ts", "user_id")
    b = ev.filter(F.col("event_type") != "click").select("event_id", "event_type", "value")
    return a.unionByName(b, allowMissingColumns=True)


@query("unpivot_home_visitor", """
select l_orderkey, l_linenumber, side, value from (
    select l_orderkey, l_linenumber, 'part' as side, l_partkey as value from lineitem
    union all
    select l_orderkey, l_linenumber, 'supplier' as side, l_suppkey as value from lineitem
)
""")
def q_unpivot_home_visitor(t: Tables) -> DataFrame:
    """Two key columns into one row per (row, side)."""
    li = t.lineitem
    return reshape.unpivot_sides(li, ["l_orderkey", "l_linenumber"], {"part": "l_partkey", "supplier": "l_suppkey"})


@query("number_series", """
with s as (select generate_series as generated_number from generate_series(1, (select max(c_custkey) from customer)))
select s.generated_number, cast(count(o.o_orderkey) as bigint) as n_orders
from s left join orders o on o.o_custkey = s.generated_number
group by s.generated_number
""")
def q_number_series(t: Tables) -> DataFrame:
    """U6 + J8: a key series 1..max(key) as a spine, orders counted per key (0 kept)."""
    c, o = t.customer, t.orders
    series = reshape.number_series_to(c, F.max("c_custkey"))
    counts = o.groupBy(F.col("o_custkey").alias("generated_number")).agg(F.count(F.lit(1)).alias("_n"))
    return (series.join(counts, "generated_number", "left")
            .select("generated_number", F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("n_orders")))


@query("date_spine_counts", """
with b as (select cast(min(ts) as date) as s, cast(max(ts) as date) + 1 as e from events),
spine as (
    select cast(b.s + to_days(cast(k as integer)) as date) as date_day
    from b, range(0, (select datediff('day', s, e) from b)) r(k)
),
daily as (select cast(ts as date) as d, count(*) as n from events group by 1)
select spine.date_day, cast(coalesce(daily.n, 0) as bigint) as n_events
from spine left join daily on daily.d = spine.date_day
""")
def q_date_spine_counts(t: Tables) -> DataFrame:
    """A day spine over the events' span (end exclusive), daily counts, empty days kept."""
    ev = t.events
    bounds = ev.agg(F.to_date(F.min("ts")).alias("start"), F.date_add(F.to_date(F.max("ts")), 1).alias("end"))
    spine = reshape.date_spine_from(bounds, "day")
    daily = ev.groupBy(F.to_date("ts").alias("date_day")).agg(F.count(F.lit(1)).alias("_n"))
    return (spine.join(daily, "date_day", "left")
            .select("date_day", F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("n_events")))


@query("month_spine", """
with b as (select cast(date_trunc('month', min(l_shipdate)) as date) as s, cast(max(l_shipdate) as date) as e
           from lineitem),
spine as (
    select cast(b.s + to_months(cast(k as integer)) as date) as date_month
    from b, range(0, (select datediff('month', s, e) from b)) r(k)
)
select date_month from spine, b where date_month <= b.e
""")
def q_month_spine(t: Tables) -> DataFrame:
    """U7 with a month part: first-of-month periods up to (excluding) the last month boundary."""
    li = t.lineitem
    bounds = li.agg(F.to_date(F.date_trunc("month", F.min("l_shipdate"))).alias("start"),
                    F.to_date(F.max("l_shipdate")).alias("end"))
    return reshape.date_spine_from(bounds, "month")


@query("season_range", """
with y as (select year(o_orderdate) as y, count(*) as n from orders group by 1),
r as (select generate_series as y from generate_series((select min(y) from y), (select max(y) from y)))
select cast(r.y as varchar) as season,
       cast(r.y - 1 as varchar) || '-' || right(cast(r.y as varchar), 2) as season_label,
       cast(coalesce(y.n, 0) as bigint) as n_orders
from r left join y on y.y = r.y
""")
def q_season_range(t: Tables) -> DataFrame:
    """U9 + F20: inclusive season list between the data's first and last year, labelled."""
    o = t.orders
    per_year = o.groupBy(F.year("o_orderdate").cast("string").alias("season")).agg(F.count(F.lit(1)).alias("_n"))
    b = o.agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi")).first()
    seasons = reshape.season_range(o.sparkSession, int(b["lo"]), int(b["hi"]))
    return (seasons.join(per_year, "season", "left")
            .select("season", season_label("season").alias("season_label"),
                    F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("n_orders")))


@query("listagg_ordered", """
select r.r_name, string_agg(n.n_name, ', ' order by n.n_name) as nations
from nation n join region r on n.n_regionkey = r.r_regionkey group by r.r_name
""")
def q_listagg_ordered(t: Tables) -> DataFrame:
    """Ordered string aggregation per group."""
    j = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return reshape.listagg(j, ["r_name"], "n_name", ", ", order_by=["n_name"], name="nations")


@query("listagg_limited", """
select s_nationkey, list_aggr((array_agg(s_name order by s_acctbal desc, s_name))[1:3], 'string_agg', '|')
       as top_suppliers
from supplier group by s_nationkey
""")
def q_listagg_limited(t: Tables) -> DataFrame:
    """A11 with a limit: the three richest suppliers per nation, in order."""
    s = t.supplier
    top = reshape.top_n_per_group(s.select("s_nationkey", "s_name", "s_acctbal"), ["s_nationkey"],
                                  [F.col("s_acctbal").desc(), F.col("s_name").asc()], 3, rank_col="_r")
    return reshape.listagg(top, ["s_nationkey"], "s_name", "|", order_by=["_r"], name="top_suppliers")


@query("bool_or_flags", """
select user_id, bool_or(event_type = 'error') as any_error, bool_and(value >= 0) as all_non_negative
from events group by user_id
""")
def q_bool_or_flags(t: Tables) -> DataFrame:
    """A10: boolean aggregates per key."""
    ev = t.events
    return ev.groupBy("user_id").agg(F.bool_or(F.col("event_type") == "error").alias("any_error"),
                                     F.bool_and(F.col("value") >= 0).alias("all_non_negative"))


@query("count_distinct_having", """
select o_custkey, cast(count(distinct o_orderstatus) as bigint) as n_status, cast(count(*) as bigint) as n
from orders group by o_custkey having count(*) > 12
""")
def q_count_distinct_having(t: Tables) -> DataFrame:
    """A2 + A8: distinct count beside a count, filtered after grouping."""
    o = t.orders
    g = o.groupBy("o_custkey").agg(F.count_distinct("o_orderstatus").cast("bigint").alias("n_status"),
                                   F.count(F.lit(1)).alias("n"))
    return g.filter(F.col("n") > 12)


@query("collect_set_per_year", """
select distinct cast(year(o_orderdate) as varchar) as season, o_custkey as member from orders
""")
def q_collect_set_per_year(t: Tables) -> DataFrame:
    """The union of members per year, one row per member: an aggregate that is
    combined map-side, so no task holds a year's whole set."""
    o = t.orders
    return o.select(F.year("o_orderdate").cast("string").alias("season"), F.col("o_custkey").alias("member")).distinct()


@query("dates_in_range", """
with b as (select cast(min(o_orderdate) as date) as s, cast(max(o_orderdate) as date) as e from orders)
select strftime(d, '%Y%m%d') as day from b, generate_series(cast(b.s as timestamp), cast(b.e as timestamp), interval 1 day) g(d)
""")
def q_dates_in_range(t: Tables) -> DataFrame:
    """U8: inclusive formatted dates from the first to the last order date."""
    ends = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e")).first()
    return reshape.dates_in_range(t.spark, ends["s"], ends["e"]).toDF("day")


@query("sort_nulls_last", """
select o_orderkey, nullif(o_orderpriority, '1-URGENT') as priority,
       row_number() over (order by nullif(o_orderpriority, '1-URGENT') desc nulls last, o_orderkey asc) as position
from orders
""")
def q_sort_nulls_last(t: Tables) -> DataFrame:
    """Multi-key sort with NULLs last in both directions; every row with its place,
    range-partitioned, so no task sorts the table."""
    o = t.orders.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("priority"))
    return reshape.row_number_within(o, [], reshape.order_nulls_last([("priority", "desc"), "o_orderkey"]), "position")


@query("sort_nulls_last_asc", """
select o_orderkey, nullif(o_orderpriority, '5-LOW') as priority,
       row_number() over (order by nullif(o_orderpriority, '5-LOW') asc nulls last, o_orderkey desc) as position
from orders
""")
def q_sort_nulls_last_asc(t: Tables) -> DataFrame:
    """W4 ascending: Spark would put the NULLs first; the warehouse puts them last."""
    o = t.orders.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"))
    return reshape.row_number_within(o, [], reshape.order_nulls_last(["priority", ("o_orderkey", "desc")]), "position")


# Fixed values of the stand-in: order states by letter.
ORDER_STATES = {"F": "filled", "O": "open"}


@query("literal_map_join", """
select o_orderkey, o_orderstatus, state from orders join (values ('F', 'filled'), ('O', 'open')) m(s, state) on o_orderstatus = s
""")
def q_literal_map_join(t: Tables) -> DataFrame:
    """An inner join with a literal map; rows whose key the map lacks drop out."""
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return joins.join_small_literal(o, t.spark, ORDER_STATES, "o_orderstatus", "state").select("o_orderkey", "o_orderstatus", "state")
