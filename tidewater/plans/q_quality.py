"""Data-quality queries (T1-T13) on the driver's tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import quality as Q
from tidewater.plans.registry import query
from tidewater.session import scratch_path
from tidewater.sources.tables import Tables


def _lineitem_with_nulls(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select("l_orderkey", "l_linenumber",
                     F.nullif(F.col("l_returnflag"), F.lit("N")).alias("returnflag"),
                     F.nullif(F.col("l_linestatus"), F.lit("O")).alias("linestatus"),
                     F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
                     "l_quantity")


_LI_NULLS_SQL = """
select l_orderkey, l_linenumber, nullif(l_returnflag, 'N') as returnflag, nullif(l_linestatus, 'O') as linestatus,
       nullif(l_discount, 0.0) as discount, l_quantity
from lineitem
"""


@query("dq_not_null", f"""
select * from ({_LI_NULLS_SQL}) where returnflag is null
""")
def q_dq_not_null(t: Tables) -> DataFrame:
    """Rows failing not_null."""
    return Q.not_null(_lineitem_with_nulls(t), "returnflag")


@query("dq_unique", """
select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as unique_field,
       cast(count(*) as bigint) as n_records
from lineitem group by 1 having count(*) > 1
""")
def q_dq_unique(t: Tables) -> DataFrame:
    """Repeated (order, line) pairs (a real failure in the driver data)."""
    li = t.lineitem
    key = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return Q.unique(li, key)


@query("dq_accepted_values", """
select o_orderpriority as value_field, cast(count(*) as bigint) as n_records from orders
group by 1 having o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM')
""")
def q_dq_accepted_values(t: Tables) -> DataFrame:
    """Values outside an accepted list, with counts."""
    return Q.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query("dq_relationships", """
select o.o_custkey as from_field from orders o
left join (select c_custkey from customer where c_nationkey < 20) p on o.o_custkey = p.c_custkey
where o.o_custkey is not null and p.c_custkey is null
""")
def q_dq_relationships(t: Tables) -> DataFrame:
    """T4: child keys without a parent (parent = customers of nations 0-19)."""
    parent = t.customer.filter(F.col("c_nationkey") < 20)
    return Q.relationships(t.orders, "o_custkey", parent, "c_custkey")


@query("dq_aggregated", f"""
with x as ({_LI_NULLS_SQL}),
rows_ as (
    select 'returnflag' as column_name from x where returnflag is null
    union all select 'linestatus' from x where linestatus is null
    union all select 'discount' from x where discount is null
    union all select 'l_quantity' from x where l_quantity is null
)
select column_name, cast(count(*) as bigint) as failures, count(*) > 0 as should_warn, count(*) > 0 as should_error
from rows_ group by column_name
""")
def q_dq_aggregated(t: Tables) -> DataFrame:
    """T5: not-null over many columns in one scan, one verdict per failing column."""
    return Q.aggregated_not_null(_lineitem_with_nulls(t), ["returnflag", "linestatus", "discount", "l_quantity"])


@query("dq_aggregated_unique", """
select 'c_name' as column_name, cast(c_name as varchar) as unique_field, cast(count(*) as bigint) as n_records
from customer where c_name is not null group by c_name having count(*) > 1
union all
select 'c_nationkey', cast(c_nationkey as varchar), cast(count(*) as bigint)
from customer where c_nationkey is not null group by c_nationkey having count(*) > 1
union all
select 'c_mktsegment', cast(c_mktsegment as varchar), cast(count(*) as bigint)
from customer where c_mktsegment is not null group by c_mktsegment having count(*) > 1
""")
def q_dq_aggregated_unique(t: Tables) -> DataFrame:
    """Repeated values per column, all columns in one scan and one shuffle."""
    return Q.aggregated_unique(t.customer, ["c_name", "c_nationkey", "c_mktsegment"])


@query("dq_verdict", """
with f as (
    select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as k, count(*) as n
    from lineitem group by 1 having count(*) > 1
)
select cast(count(*) as bigint) as failures, count(*) > 100 as should_warn, count(*) > 20000 as should_error
from f
""")
def q_dq_verdict(t: Tables) -> DataFrame:
    """Failures with separate warn and error thresholds."""
    li = t.lineitem
    key = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return Q.verdict(Q.unique(li, key), "count(*)", warn_if="> 100", error_if="> 20000")


@query("dq_verdict_sum", """
select cast(coalesce(sum(n_records), 0) as bigint) as failures, coalesce(sum(n_records), 0) <> 0 as should_warn,
       coalesce(sum(n_records), 0) > 1000000 as should_error
from (select o_orderpriority, count(*) as n_records from orders group by 1
      having o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM'))
""")
def q_dq_verdict_sum(t: Tables) -> DataFrame:
    """T7 with a custom ``fail_calc`` (rows affected, not distinct values)."""
    fails = Q.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])
    return Q.verdict(fails, "sum(n_records)", warn_if="!= 0", error_if="> 1000000")


@query("actual_vs_expected", """
with a as (select c_nationkey as nationkey, cast(count(*) as bigint) as n from customer group by 1),
e as (select s_nationkey as nationkey, cast(count(*) * 15 as bigint) as n from supplier group by 1),
only_a as (select * from a except all select * from e),
only_e as (select * from e except all select * from a)
select nationkey, n, 'actual' as actual_or_expected from only_a
union all
select nationkey, n, 'expected' from only_e
""")
def q_actual_vs_expected(t: Tables) -> DataFrame:
    """Rows that differ between an actual and an expected aggregate, tagged."""
    a = t.customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n"))
    e = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg((F.count(F.lit(1)) * 15).alias("n"))
    return Q.diff(a, e)


@query("freshness", """
select max(ts) as max_loaded_at, timestamp '2024-02-01 00:00:00' as snapshotted_at,
       (epoch_us(timestamp '2024-02-01 00:00:00') - epoch_us(max(ts))) / 1000000.0 as age_seconds,
       case when (epoch_us(timestamp '2024-02-01 00:00:00') - epoch_us(max(ts))) / 1000000.0 > 259200 then 'error'
            when (epoch_us(timestamp '2024-02-01 00:00:00') - epoch_us(max(ts))) / 1000000.0 > 86400 then 'warn'
            else 'pass' end as status
from events where event_type = 'purchase'
""")
def q_freshness(t: Tables) -> DataFrame:
    """Newest load time against a fixed clock, with warn/error ages and a filter."""
    return Q.freshness(t.events, "ts", dt.datetime(2024, 2, 1), warn_after=dt.timedelta(days=1),
                       error_after=dt.timedelta(days=3), where="event_type = 'purchase'")


_PROFILE_COLS = (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string"))

COLUMN_PROFILE_SQL = "\nunion all\n".join(
    f"select 'customer' as table_name, '{c}' as column_name, '{ty}' as data_type, "
    f"cast(count(*) as bigint) as n_rows, cast(count(*) filter (where {c} is null) as bigint) as n_nulls, "
    f"cast(count(distinct {c}) as bigint) as n_distinct, cast(min({c}) as varchar) as min_value, "
    f"cast(max({c}) as varchar) as max_value from customer"
    for c, ty in _PROFILE_COLS)


@query("column_profile", COLUMN_PROFILE_SQL)
def q_column_profile(t: Tables) -> DataFrame:
    """Per-column type, rows, nulls, distinct, min, max in one pass."""
    return Q.column_profile(t.customer, "customer", exact_distinct=True)


@query("schema_probe", """
select o_orderkey, o_custkey, o_orderstatus from orders where false limit 0
""")
def q_schema_probe(t: Tables) -> DataFrame:
    """A schema-only query (no rows; ``df.schema`` itself needs no job)."""
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus").limit(0)


@query("dq_where", """
select cast(count(*) as bigint) as failures, count(*) <> 0 as should_warn, count(*) <> 0 as should_error
from (select * from lineitem where l_linestatus = 'F') x
where nullif(l_returnflag, 'N') is null
""")
def q_dq_where(t: Tables) -> DataFrame:
    """P13 + T1 + T7: a not-null test over a filtered sub-relation (the test's ``where``)."""
    scoped = _lineitem_with_nulls(t).filter("linestatus = 'F'")
    return Q.verdict(Q.not_null(scoped, "returnflag"))


@query("dq_store_failures", """
select cast(count(*) as bigint) as failures, count(*) > 100 as should_warn, count(*) > 20000 as should_error
from (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1)
""")
def q_dq_store_failures(t: Tables) -> DataFrame:
    """Failing rows are written to the audit folder, the verdict is read from them."""
    li = t.lineitem
    key = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    stored = Q.store_failures(Q.unique(li, key), scratch_path(t.spark, f"tidewater-q/audit-{uuid.uuid4().hex[:10]}"))
    return Q.verdict(stored, warn_if="> 100", error_if="> 20000")


@query("tagged_union", """
select c_nationkey as nationkey, cast(count(*) as bigint) as n, 'actual' as actual_or_expected from customer group by 1
union all
select s_nationkey, cast(count(*) as bigint), 'expected' from supplier group by 1
""")
def q_tagged_union(t: Tables) -> DataFrame:
    """The tagged union of an actual and an expected aggregate itself."""
    a = t.customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("n"))
    e = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("n"))
    return Q.actual_vs_expected(a, e, ["nationkey", "n"])
