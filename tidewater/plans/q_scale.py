"""Hot keys in full outer joins (J1, D3, H2), profiles that add up (T13, A2), checks while writing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import joins as J
from tidewater.operators import quality as Q
from tidewater.operators import writers as W
from tidewater.plans.registry import query
from tidewater.session import scratch_path
from tidewater.sources.tables import Tables


def _scratch(t: Tables, name: str) -> str:
    return scratch_path(t.spark, f"tidewater-q/{name}-{uuid.uuid4().hex[:10]}")


@query("full_join_hot_key", """
with l as (select case when l_orderkey % 3 = 0 then 7 when l_orderkey % 50 = 1 then null else l_partkey end as part, l_orderkey, l_linenumber
           from lineitem),
r as (select case when p_partkey % 40 = 1 then null else p_partkey end as p_part, p_name from part where p_partkey % 5 <> 0)
select part, l_orderkey, l_linenumber, p_part, p_name from l full join r on part = p_part
""")
def q_full_join_hot_key(t: Tables) -> DataFrame:
    """A third of the rows has one key.  A sketch of frequent keys finds it, its rows are dealt to parts, and rows
    with a null key are not shuffled at all; every other row takes the plain full outer join."""
    part = F.when(F.col("l_orderkey") % 3 == 0, 7).when(F.col("l_orderkey") % 50 == 1, None).otherwise(F.col("l_partkey"))
    left = t.lineitem.select(part.alias("part"), "l_orderkey", "l_linenumber")
    right = t.part.where("p_partkey % 5 <> 0").select(
        F.when(F.col("p_partkey") % 40 != 1, F.col("p_partkey")).alias("p_part"), "p_name")
    return J.full_join(left, right, [("part", "p_part")], share=0.05, look_from=0)


@query("merge_prefer_hot_key", """
with l as (select case when o_orderkey % 3 = 0 then 1 else o_custkey end as custkey, o_orderpriority as label, o_totalprice as amount from orders),
r as (select c_custkey as custkey, c_mktsegment as label from customer where c_custkey % 3 <> 2)
select coalesce(r.custkey, l.custkey) as custkey, coalesce(r.label, l.label) as label, l.amount
from l full join r on l.custkey = r.custkey
""")
def q_merge_prefer_hot_key(t: Tables) -> DataFrame:
    """Prefer-merge of two sources where one key holds a third of the left rows."""
    left = t.orders.select(F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("o_custkey")).alias("custkey"),
                           F.col("o_orderpriority").alias("label"), F.col("o_totalprice").alias("amount"))
    right = t.customer.where("c_custkey % 3 <> 2").select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("label"))
    return J.merge_prefer(left, right, "custkey", ["label", "amount"], share=0.05, look_from=0)


@query("profile_incremental", """
with long as (
  select 'o_orderkey' as column_name, count(*) as n_rows, count(*) - count(o_orderkey) as n_nulls, min(o_orderkey)::varchar as min_value,
         max(o_orderkey)::varchar as max_value from orders
  union all select 'o_custkey', count(*), count(*) - count(o_custkey), min(o_custkey)::varchar, max(o_custkey)::varchar from orders
  union all select 'o_orderstatus', count(*), count(*) - count(o_orderstatus), min(o_orderstatus), max(o_orderstatus) from orders
  union all select 'high', count(*), count(*) - count(case when o_totalprice > 200000 then o_orderpriority end),
         min(case when o_totalprice > 200000 then o_orderpriority end), max(case when o_totalprice > 200000 then o_orderpriority end) from orders)
select *, true as distinct_ok, case when column_name in ('o_orderkey', 'o_custkey') then true end as median_ok, true as old_states_kept from long
""")
def q_profile_incremental(t: Tables) -> DataFrame:
    """States of the years up to 1996 are stored, later years come as a second load and cost their own scan only;
    the merged profile is that of the whole table.  Distinct counts and medians are held against exact ones here: within
    3 % and between the 45th and 55th percentile."""
    path, keys = _scratch(t, "profile"), ["season"]
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.when(F.col("o_totalprice") > 200000, F.col("o_orderpriority")).alias("high"),
                        F.year("o_orderdate").cast("string").alias("season"))
    W.upsert_partitions(t.spark, Q.profile_state(o.where("season <= '1996'"), keys), path, keys)
    first = set(W.C.data_files(t.spark, path))
    W.upsert_partitions(t.spark, Q.profile_state(o.where("season > '1996'"), keys), path, keys)
    kept = first <= set(W.C.data_files(t.spark, path))
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "high"]
    got = Q.merged_profile(W.read_table(t.spark, path), "orders")
    medians = got.agg(*[F.max(F.when(F.col("column_name") == n, F.col("median"))).alias(n) for n in names[:2]])
    exact = o.agg(*[F.count_distinct(n).alias(f"d_{n}") for n in names]).crossJoin(
        Q.within_percentiles(o, medians, 0.45, 0.55).select(*[F.col(n).alias(f"m_{n}") for n in names[:2]]))
    facts = exact.select(F.explode(F.array(*[F.struct(
        F.lit(n).alias("column_name"), F.col(f"d_{n}").alias("d"),
        (F.col(f"m_{n}") if n in names[:2] else F.lit(None).cast("boolean")).alias("median_ok")) for n in names])).alias("f")).select("f.*")
    return got.join(facts, "column_name").select(
        "column_name", "n_rows", "n_nulls", "min_value", "max_value",
        (F.abs(F.col("n_distinct") - F.col("d")) <= 0.03 * F.col("d")).alias("distinct_ok"), "median_ok",
        F.lit(kept).alias("old_states_kept"))


@query("checked_load", """
select o_orderkey, o_custkey, o_totalprice, o_orderstatus, 'loaded' as place, '' as failed_checks from orders
where o_totalprice >= 50000 and o_orderstatus in ('F', 'O')
union all
select o_orderkey, o_custkey, o_totalprice, o_orderstatus, 'quarantine',
       concat_ws(',', case when o_totalprice < 50000 then 'large enough' end, case when o_orderstatus not in ('F', 'O') then 'known status' end)
from orders where not (o_totalprice >= 50000 and o_orderstatus in ('F', 'O'))
""")
def q_checked_load(t: Tables) -> DataFrame:
    """A load whose rows are checked by the job that writes them, against a declared schema.  First it refuses
    all of them and leaves no table, then rows that fail go to the quarantine with the names of their checks."""
    base = _scratch(t, "checked")
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    checks = {"large enough": "o_totalprice >= 50000", "known status": "o_orderstatus in ('F', 'O')"}
    try:
        W.checked_load(o, f"{base}/orders", checks, contract=o.schema)
        raise AssertionError("the load was not refused")
    except W.ChecksFailed:
        assert not W.path_exists(t.spark, f"{base}/orders")
    W.checked_load(o, f"{base}/orders", checks, contract=o.schema, quarantine=f"{base}/orders_quarantine")
    good = W.read_table(t.spark, f"{base}/orders").withColumn("place", F.lit("loaded")).withColumn(W.FAILED, F.lit(""))
    bad = W.read_table(t.spark, f"{base}/orders_quarantine").withColumn(W.FAILED, F.concat_ws(",", W.FAILED)).withColumn("place", F.lit("quarantine"))
    return good.unionByName(bad)
