"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import exprs as X
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables


@query("string_funcs", """
select p_partkey, p_name || '|' || p_brand as joined, length(p_name) as name_len,
       position('e' in p_name) as e_pos, replace(p_name, ' ', '_') as snake, right(p_brand, 2) as brand_tail,
       upper(p_type) as type_upper, trim(cast(p_partkey as varchar)) as id_text,
       right(p_name, -2) as name_tail
from part
""")
def q_string_funcs(t: Tables) -> DataFrame:
    """F1-F7 + F21: concat, length, position, replace, right, upper, id text clean."""
    p = t.part
    return p.select(
        "p_partkey",
        X.concat_fields([F.col("p_name"), F.lit("|"), F.col("p_brand")]).alias("joined"),
        F.length("p_name").cast("bigint").alias("name_len"),
        X.position("e", "p_name").alias("e_pos"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("snake"),
        X.right("p_brand", 2).alias("brand_tail"),
        F.upper("p_type").alias("type_upper"),
        F.trim(F.col("p_partkey").cast("string")).alias("id_text"),
        X.right("p_name", -2).alias("name_tail"),
    )


@query("split_part_neg", """
select page_id, string_split(url, '/')[3] as host, string_split(url, '/')[-1] as last_segment,
       string_split(url, '.')[-2] as second_last_dot, string_split(url, '/')[12] as out_of_range
from pages
""")
def q_split_part_neg(t: Tables) -> DataFrame:
    """split part with positive, negative and out-of-range indexes (null, not '')."""
    p = t.pages
    return p.select("page_id",
                    X.split_part("url", "/", 3).alias("host"),
                    X.split_part("url", "/", -1).alias("last_segment"),
                    X.split_part("url", ".", -2).alias("second_last_dot"),
                    X.split_part("url", "/", 12).alias("out_of_range"))


@query("date_arith", """
with d as (select distinct l_shipdate as d from lineitem)
select d,
       d + interval '1 month' as plus_month, d - interval '3 months' as minus_quarter,
       d + interval '14 days' as plus_2_weeks, d + interval '45 days' as plus_45_days,
       d - interval '1 year' as minus_year, d + interval '5 hours' as plus_5_hours,
       make_date(year(d), month(d), 1) as month_start,
       date_trunc('week', d) as week_start,
       date_trunc('quarter', d) as quarter_start
from d
""")
def q_date_arith(t: Tables) -> DataFrame:
    """make_date, date_trunc, dateadd (quarter = 3 months, week = 7 days).

    (45 days, not 30: the oracle engine treats ``interval 30 day`` and
    ``interval 1 month`` as the same constant within one query.)
    """
    d = t.lineitem.select(F.col("l_shipdate").alias("d")).distinct()
    return d.select(
        "d",
        X.dateadd("month", 1, "d").alias("plus_month"),
        X.dateadd("quarter", -1, "d").alias("minus_quarter"),
        X.dateadd("week", 2, "d").alias("plus_2_weeks"),
        X.dateadd("day", 45, "d").alias("plus_45_days"),
        X.dateadd("year", -1, "d").alias("minus_year"),
        X.dateadd("hour", 5, "d").alias("plus_5_hours"),
        X.make_date(F.year("d"), F.month("d"), F.lit(1)).alias("month_start"),
        X.date_trunc("week", "d").alias("week_start"),
        X.date_trunc("quarter", "d").alias("quarter_start"),
    )


@query("dateadd_column", """
select o_orderkey, o_orderdate + to_months(cast(o_custkey % 40 - 20 as integer)) as shifted
from orders
""")
def q_dateadd_column(t: Tables) -> DataFrame:
    """F15 with a per-row quantity (column interval, both signs, month-end clamping)."""
    o = t.orders
    return o.select("o_orderkey", X.dateadd("month", F.col("o_custkey") % 40 - 20, "o_orderdate").alias("shifted"))


_DIFF_PARTS = ("year", "quarter", "month", "week", "day")


@query("date_diff_parts", """
with p as (
    select distinct o.o_orderdate as a, l.l_shipdate as b
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey
)
, w as (
    select a, b, cast(floor(date_diff('day', date '1970-01-04', a) / 7.0) as bigint) as wa,
           cast(floor(date_diff('day', date '1970-01-04', b) / 7.0) as bigint) as wb, dayofweek(a) = dayofweek(b) as same_day
    from p
)
select a, b,
       date_diff('year', a, b) as d_year, date_diff('quarter', a, b) as d_quarter,
       date_diff('month', a, b) as d_month,
       wb - wa - case when b < a and same_day then 1 else 0 end as d_week,
       date_diff('day', a, b) as d_day,
       wa - wb - case when a < b and same_day then 1 else 0 end as d_week_back,
       date_diff('month', b, a) as d_month_back
from w
""")
def q_date_diff_parts(t: Tables) -> DataFrame:
    """F16: boundary-counting datediff for year..day, both directions."""
    li, o = t.lineitem, t.orders
    p = (li.join(o, li.l_orderkey == o.o_orderkey)
         .select(F.col("o_orderdate").alias("a"), F.col("l_shipdate").alias("b")).distinct())
    cols = [X.datediff("a", "b", part).alias(f"d_{part}") for part in _DIFF_PARTS]
    return p.select("a", "b", *cols, X.datediff("b", "a", "week").alias("d_week_back"),
                    X.datediff("b", "a", "month").alias("d_month_back"))


@query("time_diff_parts", """
select event_id, date_diff('hour', ts, timestamp '2024-01-15 12:34:56') as d_hour,
       date_diff('minute', ts, timestamp '2024-01-15 12:34:56') as d_minute
from events
""")
def q_time_diff_parts(t: Tables) -> DataFrame:
    """F16 for hours and minutes (truncate both ends, then count)."""
    ev = t.events
    ref = F.lit("2024-01-15 12:34:56").cast("timestamp_ntz")
    return ev.select("event_id", X.datediff("ts", ref, "hour").alias("d_hour"),
                     X.datediff("ts", ref, "minute").alias("d_minute"))


@query("last_day_parts", """
with d as (select distinct l_shipdate as d from lineitem)
select d,
       cast(date_trunc('month', d) + interval 1 month - interval 1 day as date) as ld_month,
       cast(date_trunc('quarter', d) + interval 3 month - interval 1 day as date) as ld_quarter,
       cast(date_trunc('year', d) + interval 1 year - interval 1 day as date) as ld_year,
       cast(date_trunc('week', d) + interval 7 day - interval 1 day as date) as ld_week
from d
""")
def q_last_day_parts(t: Tables) -> DataFrame:
    """last day of the month, quarter, year and (Monday-start) week."""
    d = t.lineitem.select(F.col("l_shipdate").alias("d")).distinct()
    return d.select("d", *[X.last_day("d", p).alias(f"ld_{p}") for p in ("month", "quarter", "year", "week")])


@query("safe_cast_values", """
with v as (
    select o_orderkey, split_part(o_orderpriority, '-', 1) as v1, o_orderpriority as v2,
           cast(o_custkey as varchar) || '.25' as v3, o_orderstatus || '.5' as v4,
           (o_orderstatus = 'F') as is_final
    from orders
)
select o_orderkey, try_cast(v1 as integer) as v1_int, try_cast(v2 as integer) as v2_int,
       try_cast(v3 as double) as v3_double,
       case when v is null or v = '' then 'string'
            when v like '%.%' and try_cast(v as double) is not null then 'double'
            when v not like '%.%' and try_cast(v as bigint) is not null then 'bigint'
            else 'string' end as kind
from v, unnest([v1, v2, v3, v4]) as u(v)
""")
def q_safe_cast_values(t: Tables) -> DataFrame:
    """F11 + S14: casts that give NULL instead of failing, and the numeric kind of text."""
    o = t.orders
    v = o.select("o_orderkey", X.split_part("o_orderpriority", "-", 1).alias("v1"),
                 F.col("o_orderpriority").alias("v2"),
                 F.concat(F.col("o_custkey").cast("string"), F.lit(".25")).alias("v3"),
                 F.concat(F.col("o_orderstatus"), F.lit(".5")).alias("v4"))
    long = v.select("o_orderkey", "v1", "v2", "v3",
                    F.explode(F.array("v1", "v2", "v3", "v4")).alias("v"))
    return long.select("o_orderkey", X.safe_cast("v1", "int").alias("v1_int"),
                       X.safe_cast("v2", "int").alias("v2_int"),
                       X.safe_cast("v3", "double").alias("v3_double"), X.numeric_kind("v").alias("kind"))


@query("array_funcs", """
select n.n_nationkey,
       array_to_string(list_append([n.n_name, r.r_name], 'x'), ',') as appended,
       array_to_string(list_concat([n.n_name], [r.r_name, 'y']), ',') as concatenated,
       len(list_concat([n.n_name], cast([] as varchar[]))) as n_items
from nation n join region r on n.n_regionkey = r.r_regionkey
""")
def q_array_funcs(t: Tables) -> DataFrame:
    """Array construct (incl. typed empty), append, concat; shown as text."""
    j = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    base = X.array_construct([F.col("n_name"), F.col("r_name")])
    return j.select(
        "n_nationkey",
        F.array_join(X.array_append(base, F.lit("x")), ",").alias("appended"),
        F.array_join(X.array_concat(X.array_construct([F.col("n_name")]),
                                    X.array_construct([F.col("r_name"), F.lit("y")])), ",").alias("concatenated"),
        F.size(X.array_concat(X.array_construct([F.col("n_name")]), X.array_construct([]))).cast("bigint")
        .alias("n_items"),
    )


@query("surrogate_key", """
select o_orderkey,
       md5(coalesce(cast(o_orderkey as varchar), '') || '|' || coalesce(cast(o_custkey as varchar), '') || '|'
           || coalesce(cast(nullif(o_orderstatus, 'P') as varchar), '')) as sk,
       md5(cast(o_orderpriority as varchar)) as priority_hash
from orders
""")
def q_surrogate_key(t: Tables) -> DataFrame:
    """F8 + H7: md5 surrogate key over int and text parts (nulls as '')."""
    o = t.orders
    return o.select("o_orderkey",
                    X.surrogate_key([F.col("o_orderkey"), F.col("o_custkey"),
                                     F.nullif(F.col("o_orderstatus"), F.lit("P"))]).alias("sk"),
                    X.hash_text("o_orderpriority").alias("priority_hash"))


@query("round_half", """
select o_orderkey, round(o_totalprice / 7, 1) as r1, round(o_totalprice / 7, 2) as r2,
       round(o_totalprice / 7, 3) as r3, round(1.0 * o_custkey / nullif(o_orderkey % 7, 0), 3) as ratio3
from orders
""")
def q_round_half(t: Tables) -> DataFrame:
    """F10 + F26: rounding of doubles (scale, half away from zero, unscale) and
    double division with a null-if-zero denominator."""
    o = t.orders
    x = F.col("o_totalprice") / F.lit(7.0)
    return o.select("o_orderkey", X.round_half_away(x, 1).alias("r1"), X.round_half_away(x, 2).alias("r2"),
                    X.round_half_away(x, 3).alias("r3"),
                    X.ratio("o_custkey", F.col("o_orderkey") % 7, 3).alias("ratio3"))


@query("api_date", """
select o_orderkey, case when o_orderstatus = 'P' then 'TBD' else strftime(o_orderdate, '%m/%d/%Y') end as api_date,
       strftime(o_orderdate, '%m/%d/%Y') as from_date
from orders
""")
def q_api_date(t: Tables) -> DataFrame:
    """dates and ISO date text as the API's ``MM/DD/YYYY``; other text kept."""
    o = t.orders
    raw = F.when(F.col("o_orderstatus") == "P", F.lit("TBD")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    v = o.select("o_orderkey", raw.alias("raw"), F.to_date("o_orderdate").alias("d"))
    return v.select("o_orderkey", X.api_date("raw").alias("api_date"), X.api_date("d").alias("from_date"))


@query("bool_text_cast", """
select o_orderstatus, cast(o_orderstatus = 'F' as varchar) as is_final_text, cast(count(*) as bigint) as n
from orders group by 1, 2
""")
def q_bool_text_cast(t: Tables) -> DataFrame:
    """F11 ``cast_bool_to_text``: booleans as 'true'/'false'."""
    o = t.orders
    return (o.select("o_orderstatus", X.cast_bool_to_text(F.col("o_orderstatus") == "F").alias("is_final_text"))
            .groupBy("o_orderstatus", "is_final_text").agg(F.count(F.lit(1)).alias("n")))
