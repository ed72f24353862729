"""Incremental strategy queries (I1-I18) on ``events`` and ``orders``.

Target = events before 2024-01-20, source = events from 2024-01-15 with a
changed ``value`` and ``props``: days 15-19 are updates, days 20-30 inserts.
Each query returns the new state of the target.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import incremental as I
from tidewater.operators.incremental import Clause
from tidewater.plans.registry import query
from tidewater.sources.tables import Tables

SPLIT_TARGET = "2024-01-20"
SPLIT_SOURCE = "2024-01-15"


def target_events(t: Tables) -> DataFrame:
    return t.events.filter(F.col("ts") < F.lit(SPLIT_TARGET).cast("timestamp_ntz"))


def source_events(t: Tables) -> DataFrame:
    ev = t.events.filter(F.col("ts") >= F.lit(SPLIT_SOURCE).cast("timestamp_ntz"))
    return ev.select("event_id", "ts", "user_id", "event_type", (F.col("value") + F.lit(1.0)).alias("value"),
                     F.concat(F.col("props"), F.lit("*")).alias("props"))


_CTE = f"""
with target as (select * from events where ts < timestamp '{SPLIT_TARGET}'),
source as (
    select event_id, ts, user_id, event_type, value + cast(1 as double) as value, props || '*' as props
    from events where ts >= timestamp '{SPLIT_SOURCE}'
)
"""


@query("inc_append", _CTE + "select * from target union all select * from source")
def q_inc_append(t: Tables) -> DataFrame:
    """Append."""
    return I.append(target_events(t), source_events(t))


@query("inc_delete_insert", _CTE + """
select * from target t where not exists (select 1 from source s where s.event_id = t.event_id)
union all select * from source
""")
def q_inc_delete_insert(t: Tables) -> DataFrame:
    """Delete target rows whose key is in the source, insert the source."""
    return I.delete_insert(target_events(t), source_events(t), "event_id")


@query("inc_delete_insert_predicate", _CTE + """
select * from target t
where not (exists (select 1 from source s where s.event_id = t.event_id) and t.event_type <> 'signup')
union all select * from source
""")
def q_inc_delete_insert_predicate(t: Tables) -> DataFrame:
    """I7 with an incremental predicate limiting which target rows may go."""
    return I.delete_insert(target_events(t), source_events(t), ["event_id"], predicates=["event_type <> 'signup'"])


@query("inc_merge", _CTE + """
select t.event_id,
       case when s.event_type <> 'view' then s.ts else t.ts end as ts,
       case when s.event_type <> 'view' then s.user_id else t.user_id end as user_id,
       case when s.event_type <> 'view' then s.event_type else t.event_type end as event_type,
       case when s.event_type <> 'view' then s.value else t.value end as value,
       case when s.event_type <> 'view' then s.props else t.props end as props
from target t join source s on t.event_id = s.event_id
union all
select * from target t where not exists (select 1 from source s where s.event_id = t.event_id)
union all
select * from source s where not exists (select 1 from target t where t.event_id = s.event_id)
""")
def q_inc_merge(t: Tables) -> DataFrame:
    """I8: merge on the key with an update condition; unmatched source rows inserted."""
    return I.merge(target_events(t), source_events(t), "event_id", update_condition="s.event_type <> 'view'")


@query("inc_merge_columns", _CTE + """
select t.event_id, t.ts, t.user_id, t.event_type, s.value, t.props || '#' as props
from target t join source s on t.event_id = s.event_id
union all
select * from target t where not exists (select 1 from source s where s.event_id = t.event_id)
union all
select * from source s where not exists (select 1 from target t where t.event_id = s.event_id)
""")
def q_inc_merge_columns(t: Tables) -> DataFrame:
    """I8 explicit update: only listed columns, plus a set expression."""
    return I.merge(target_events(t), source_events(t), "event_id", update_columns=["value", "props"],
                   set_expressions={"props": "concat(t.props, '#')"})


@query("inc_merge_exclude", _CTE + """
select t.event_id, s.ts, s.user_id, s.event_type, s.value, t.props
from target t join source s on t.event_id = s.event_id
union all
select * from target t where not exists (select 1 from source s where s.event_id = t.event_id)
union all
select * from source s where not exists (select 1 from target t where t.event_id = s.event_id)
""")
def q_inc_merge_exclude(t: Tables) -> DataFrame:
    """I8 explicit update: all columns except the excluded ones."""
    return I.merge(target_events(t), source_events(t), "event_id", exclude_columns=["props"])


MERGE_CLAUSES = [
    Clause("matched", "delete", "s.event_type = 'error'"),
    Clause("matched", "update", "s.user_id % 2 = 0", mode="explicit", include=("value",)),
    Clause("matched", "do_nothing"),
    Clause("not_matched", "insert", "s.event_type <> 'signup'"),
    Clause("not_matched_by_source", "delete", "t.ts < timestamp'2024-01-05 00:00:00'"),
    Clause("not_matched_by_source", "update", "t.event_type = 'purchase'", set={"value": "0.0"}),
]

_CLAUSES_SQL = _CTE + """
select t.event_id, t.ts, t.user_id, t.event_type,
       case when s.user_id % 2 = 0 then s.value else t.value end as value, t.props
from target t join source s on t.event_id = s.event_id
where s.event_type <> 'error'
union all
select * from source s
where not exists (select 1 from target t where t.event_id = s.event_id) and s.event_type <> 'signup'
union all
select t.event_id, t.ts, t.user_id, t.event_type,
       case when t.event_type = 'purchase' then cast(0 as double) else t.value end as value, t.props
from target t
where not exists (select 1 from source s where s.event_id = t.event_id)
  and not (t.ts < timestamp '2024-01-05 00:00:00')
"""


@query("inc_merge_clauses", _CLAUSES_SQL)
def q_inc_merge_clauses(t: Tables) -> DataFrame:
    """Ordered clause list (delete / conditional update / do nothing /
    conditional insert / delete and update by source)."""
    return I.merge(target_events(t), source_events(t), "event_id", clauses=MERGE_CLAUSES)


@query("inc_merge_returning", _CTE + """
select t.event_id, t.ts, t.user_id, t.event_type, t.value, t.props, 'delete' as merge_action
from target t join source s on t.event_id = s.event_id where s.event_type = 'error'
union all
select t.event_id, t.ts, t.user_id, t.event_type, s.value, t.props, 'update'
from target t join source s on t.event_id = s.event_id where s.event_type <> 'error' and s.user_id % 2 = 0
union all
select *, 'insert' from source s
where not exists (select 1 from target t where t.event_id = s.event_id) and s.event_type <> 'signup'
union all
select t.*, 'delete' from target t
where not exists (select 1 from source s where s.event_id = t.event_id) and t.ts < timestamp '2024-01-05 00:00:00'
union all
select t.event_id, t.ts, t.user_id, t.event_type, cast(0 as double), t.props, 'update' from target t
where not exists (select 1 from source s where s.event_id = t.event_id)
  and not (t.ts < timestamp '2024-01-05 00:00:00') and t.event_type = 'purchase'
""")
def q_inc_merge_returning(t: Tables) -> DataFrame:
    """The rows a merge affects, with their action (new values for updates)."""
    return I.merge(target_events(t), source_events(t), "event_id", clauses=MERGE_CLAUSES, returning=True)


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.to_date("ts"))


@query("inc_insert_overwrite", _CTE + """
, td as (select *, cast(ts as date) as day from target), sd as (select *, cast(ts as date) as day from source)
select * from td where day not in (select distinct day from sd)
union all select * from sd
""")
def q_inc_insert_overwrite(t: Tables) -> DataFrame:
    """Partitions (days) present in the source replace the target's."""
    return I.insert_overwrite(_with_day(target_events(t)), _with_day(source_events(t)), partition_by=["day"])


@query("inc_insert_overwrite_predicate", _CTE + """
select * from target where not (user_id < 50) union all select * from source
""")
def q_inc_insert_overwrite_predicate(t: Tables) -> DataFrame:
    """I12 with a predicate: delete target rows matching it, insert the source."""
    return I.insert_overwrite(target_events(t), source_events(t), predicates=["user_id < 50"])


@query("inc_microbatch", _CTE + """
select * from target where not (ts >= timestamp '2024-01-16' and ts < timestamp '2024-01-18')
union all
select * from source where ts >= timestamp '2024-01-16' and ts < timestamp '2024-01-18'
""")
def q_inc_microbatch(t: Tables) -> DataFrame:
    """Replace the ``[start, end)`` slice of event time."""
    return I.microbatch(target_events(t), source_events(t), "ts", dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 18))


@query("inc_microbatches", _CTE + """
select * from target where not ((ts >= timestamp '2024-01-16' and ts < timestamp '2024-01-17')
                                 or (ts >= timestamp '2024-01-18' and ts < timestamp '2024-01-19'))
union all
select * from source where (ts >= timestamp '2024-01-16' and ts < timestamp '2024-01-17')
                        or (ts >= timestamp '2024-01-18' and ts < timestamp '2024-01-19')
""")
def q_inc_microbatches(t: Tables) -> DataFrame:
    """I13 with several batches in one plan."""
    b = [(dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 17)), (dt.datetime(2024, 1, 18), dt.datetime(2024, 1, 19))]
    return I.microbatches(target_events(t), source_events(t), "ts", b)


@query("upsert_partition", """
with target as (select *, cast(cast(ts as date) as varchar) as season from events where ts < timestamp '2024-01-21'),
source as (
    select event_id, ts, user_id, event_type, value + cast(1 as double) as value, props,
           cast(cast(ts as date) as varchar) as season
    from events where ts >= timestamp '2024-01-18'
)
select * from target where season not in (select distinct season from source)
union all select * from source
""")
def q_upsert_partition(t: Tables) -> DataFrame:
    """The source's seasons (here: days) replace the target's; others kept."""
    ev = t.events.withColumn("season", F.to_date("ts").cast("string"))
    target = ev.filter(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"))
    source = (ev.filter(F.col("ts") >= F.lit("2024-01-18").cast("timestamp_ntz"))
              .withColumn("value", F.col("value") + F.lit(1.0)))
    return I.partition_upsert(target, source, keys=("season", "season_type"))


def _orders_target(t: Tables) -> DataFrame:
    return (t.orders.filter(F.year("o_orderdate") <= 1998)
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))


def _orders_source(t: Tables) -> DataFrame:
    return (t.orders.filter(F.year("o_orderdate") >= 1998)
            .select("o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("o_totalprice"),
                    "o_orderpriority"))


_ORDERS_CTE = """
with target as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where year(o_orderdate) <= 1998),
source as (select o_orderkey, o_custkey, o_totalprice * 2 as o_totalprice, o_orderpriority
           from orders where year(o_orderdate) >= 1998)
"""


@query("schema_append", _ORDERS_CTE + """
select t.o_orderkey, s.o_custkey, t.o_orderstatus, s.o_totalprice, s.o_orderpriority
from target t join source s on t.o_orderkey = s.o_orderkey
union all
select t.*, cast(null as varchar) from target t where not exists (select 1 from source s where s.o_orderkey = t.o_orderkey)
union all
select s.o_orderkey, s.o_custkey, cast(null as varchar), s.o_totalprice, s.o_orderpriority from source s
where not exists (select 1 from target t where t.o_orderkey = s.o_orderkey)
""")
def q_schema_append(t: Tables) -> DataFrame:
    """I15/I16 ``append_new_columns`` then merge: the target gains the new column;
    columns the source lacks keep their target value on update."""
    return I.incremental(_orders_target(t), _orders_source(t), "merge", unique_key="o_orderkey",
                         on_schema_change_mode="append_new_columns")


@query("schema_sync", _ORDERS_CTE + """
select t.o_orderkey, t.o_custkey, t.o_totalprice, cast(null as varchar) as o_orderpriority from target t
where not exists (select 1 from source s where s.o_orderkey = t.o_orderkey)
union all select * from source
""")
def q_schema_sync(t: Tables) -> DataFrame:
    """I16 ``sync_all_columns`` then delete+insert: removed columns dropped, new ones added."""
    return I.incremental(_orders_target(t), _orders_source(t), "delete+insert", unique_key="o_orderkey",
                         on_schema_change_mode="sync_all_columns")


@query("widen_types", """
with target as (select o_orderkey, cast(o_custkey as integer) as o_custkey from orders where year(o_orderdate) <= 1996),
source as (select o_orderkey, o_totalprice as o_custkey from orders where year(o_orderdate) >= 1996)
select o_orderkey, cast(o_custkey as double) as o_custkey from target t
where not exists (select 1 from source s where s.o_orderkey = t.o_orderkey)
union all select * from source
""")
def q_widen_types(t: Tables) -> DataFrame:
    """An int target column meets double source values; the load widens the
    target, so no value is cut."""
    o = t.orders
    target = o.filter(F.year("o_orderdate") <= 1996).select("o_orderkey", F.col("o_custkey").cast("int"))
    source = o.filter(F.year("o_orderdate") >= 1996).select("o_orderkey", F.col("o_totalprice").alias("o_custkey"))
    return I.incremental(target, source, "delete+insert", "o_orderkey")


@query("schema_retype", """
select o_orderkey, cast(o_custkey as varchar) as o_custkey from orders
""")
def q_schema_retype(t: Tables) -> DataFrame:
    """``sync_all_columns`` retypes a column of the target to the source's type."""
    o = t.orders
    target = o.filter(F.year("o_orderdate") <= 1996).select("o_orderkey", "o_custkey")
    source = o.filter(F.year("o_orderdate") >= 1996).select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"))
    return I.incremental(target, source, "delete+insert", "o_orderkey", on_schema_change_mode="sync_all_columns")


@query("inc_merge_by_position", _CTE + """
select s.event_id, s.ts, s.user_id, s.props as event_type, s.value, s.event_type as props from source s
union all
select * from target t where not exists (select 1 from source s where s.event_id = t.event_id)
""")
def q_inc_merge_by_position(t: Tables) -> DataFrame:
    """I9 ``by_position``: the target's columns take the source's in order, whatever their names."""
    s = source_events(t).select("event_id", "ts", "user_id", F.col("props").alias("x"), "value", F.col("event_type").alias("y"))
    return I.merge(target_events(t), s, "event_id",
                   clauses=[Clause("matched", "update", mode="by_position"), Clause("not_matched", "insert", mode="by_position")])


@query("inc_merge_no_key", _CTE + """
select * from target where not (event_type = 'error')
union all
select * from source where event_type <> 'signup' and user_id % 2 = 0
""")
def q_inc_merge_no_key(t: Tables) -> DataFrame:
    """I9 without a key: nothing matches, so the plan has no join; two conditions must
    both hold for an insert, and by-source clauses see every target row."""
    return I.merge(target_events(t), source_events(t), None,
                   clauses=[Clause("not_matched", "insert", ["s.event_type <> 'signup'", "s.user_id % 2 = 0"]),
                            Clause("not_matched_by_source", "delete", "t.event_type = 'error'")])


@query("inc_merge_returning_columns", _CTE + """
select s.event_id, s.value, case when t.event_id is null then 'insert' else 'update' end as merge_action
from source s left join target t on s.event_id = t.event_id
""")
def q_inc_merge_returning_columns(t: Tables) -> DataFrame:
    """I10 with a column list."""
    return I.merge(target_events(t), source_events(t), "event_id", returning=["event_id", "value"])


@query("inc_merge_repeated_key", _CTE + """
select t.event_id, s.ts, s.user_id, s.event_type, s.value, s.props
from target t join source s on t.event_id = s.event_id
union all
select * from target t where not exists (select 1 from source s where s.event_id = t.event_id)
union all
select * from source s where not exists (select 1 from target t where s.event_id = t.event_id)
union all
select event_id, ts, -1 - user_id, event_type, value, props from source
""")
def q_inc_merge_repeated_key(t: Tables) -> DataFrame:
    """The source repeats every key, a predicate leaves one match per target row (no
    error); rows that the predicate keeps from matching are inserted."""
    s = source_events(t)
    twice = s.unionByName(s.withColumn("user_id", -1 - F.col("user_id")))
    return I.merge(target_events(t), twice, "event_id", predicates=["s.user_id >= 0"])


@query("inc_merge_predicates", _CTE + """
select t.event_id, s.ts, s.user_id, s.event_type, s.value, s.props
from target t join source s
  on t.event_id = s.event_id and t.user_id = s.user_id and t.ts >= timestamp '2024-01-17'
union all
select * from target t where not exists (
    select 1 from source s where t.event_id = s.event_id and t.user_id = s.user_id and t.ts >= timestamp '2024-01-17')
union all
select * from source s where not exists (
    select 1 from target t where t.event_id = s.event_id and t.user_id = s.user_id and t.ts >= timestamp '2024-01-17')
""")
def q_inc_merge_predicates(t: Tables) -> DataFrame:
    """J9 + I9: composite-key merge whose ON clause carries an extra predicate
    (target rows outside it do not match: they stay, and the source row is
    inserted beside them)."""
    return I.merge(target_events(t), source_events(t), ["event_id", "user_id"],
                   predicates=["t.ts >= timestamp'2024-01-17 00:00:00'"])


@query("incremental_first_run", _CTE + "select * from source")
def q_incremental_first_run(t: Tables) -> DataFrame:
    """With no target yet (or a full refresh) the model is built from the source."""
    return I.incremental(None, source_events(t), "merge", unique_key="event_id")
