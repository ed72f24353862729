"""Recoverable loads on disk (I1, I2, I7, I8, H3, X1) and the typing rules beside them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import exprs as X
from tidewater.operators import commits as C
from tidewater.operators import incremental as I
from tidewater.operators import writers as W
from tidewater.operators.snapshot import SnapshotConfig, apply_snapshot, clock, read_snapshot
from tidewater.plans.registry import query
from tidewater.session import scratch_path
from tidewater.sources import pages as P
from tidewater.sources.tables import Tables
from tidewater.streaming.upsert_stream import stream_upsert


def _scratch(t: Tables, name: str) -> str:
    return scratch_path(t.spark, f"tidewater-q/{name}-{uuid.uuid4().hex[:10]}")


@query("commit_recovered", """
select o_orderkey, o_totalprice + cast(case when o_orderstatus = 'F' then 1 else 0 end as double) as o_totalprice, o_orderstatus
from orders where o_orderstatus <> 'P'
union all
select -o_orderkey, o_totalprice, o_orderstatus from orders where o_orderstatus = 'P'
""")
def q_commit_recovered(t: Tables) -> DataFrame:
    """A writer stops with all its files staged but nothing published, another one right after
    publishing changes of two partitions, before a file has moved.  The first has changed nothing; the next load
    finishes the second and works on its rows, and is no first run."""
    path = _scratch(t, "recovered") + "/orders"
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    W.replace_table(o, path, partition_by=["o_orderstatus"])
    staged = C.Commit(t.spark, path)
    o.limit(0).write.parquet(staged.staging)                       # stops here: no journal
    published = C.Commit(t.spark, path)
    new = o.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1.0) \
        .unionByName(o.where("o_orderstatus = 'P'").withColumn("o_orderkey", -F.col("o_orderkey")))
    new.write.partitionBy("o_orderstatus").parquet(published.staging)
    come = C.data_files(t.spark, published.staging)
    gone = [f for f in C.data_files(t.spark, path) if f.split("/")[0] in {c.split("/")[0] for c in come}]
    C.swap_files(published, gone, come)
    published.publish()                                            # stops here: nothing moved
    again = o.where("o_orderstatus = 'O'")
    W.apply_incremental(t.spark, path, again, "delete+insert", "o_orderkey", ["o_orderstatus"])
    return W.read_table(t.spark, path)


@query("stream_append_once", "select event_id, ts, user_id, event_type, value, props from events")
def q_stream_append_once(t: Tables) -> DataFrame:
    """X1 with ``append``: four micro-batches, then the stream's checkpoint is lost and all of them are handed
    over again; the table knows their numbers and no row comes twice."""
    base = _scratch(t, "stream_append")
    t.events.repartitionByRange(4, "event_id").write.parquet(f"{base}/landing")
    for attempt in ("first", "again"):
        stream_upsert(t.spark, f"{base}/landing", t.events.schema, f"{base}/events", f"{base}/checkpoint-{attempt}", None,
                      "append", stream="events")
    return W.read_table(t.spark, f"{base}/events").select("event_id", "ts", "user_id", "event_type", "value", "props")


FILES = 16
_FEW = "o_orderkey % 256 = 33 and o_orderkey < 2048"


@query("merge_few_files", f"""
with touched as (select count(distinct o_orderkey % {FILES}) as n from orders where {_FEW})
select o_orderkey, case when {_FEW} then o_totalprice * 2 else o_totalprice end as o_totalprice,
       cast(n as bigint) as files_replaced, cast({FILES} - n as bigint) as files_kept
from orders, touched
""")
def q_merge_few_files(t: Tables) -> DataFrame:
    """I8 on an unpartitioned table of many files: a merge of a few keys finds them by the files' Bloom filters and
    replaces the files that hold them; all others are the same files afterwards (counted in the result)."""
    path = _scratch(t, "few_files") + "/orders"
    o = t.orders.select("o_orderkey", "o_totalprice")
    W.replace_table(o.repartitionById(FILES, F.pmod("o_orderkey", F.lit(FILES)).cast("int")), path, keys=["o_orderkey"])
    before = set(C.data_files(t.spark, path))
    W.apply_incremental(t.spark, path, o.where(_FEW).withColumn("o_totalprice", F.col("o_totalprice") * 2), "merge", "o_orderkey")
    kept = len(before & set(C.data_files(t.spark, path)))
    return W.read_table(t.spark, path).select("*", F.lit(len(before) - kept).cast("long").alias("files_replaced"),
                                              F.lit(kept).cast("long").alias("files_kept"))


@query("upsert_widened", """
select o_orderkey, case when year(o_orderdate) = 1998 then o_totalprice else cast(o_custkey as double) end as measure,
       cast(year(o_orderdate) as varchar) as season
from orders
""")
def q_upsert_widened(t: Tables) -> DataFrame:
    """An integer column meets fractions in a later load of one season; the table takes the wider type and no
    value is cut."""
    path = _scratch(t, "widened") + "/orders"
    season = F.year("o_orderdate").cast("string").alias("season")
    W.upsert_partitions(t.spark, t.orders.select("o_orderkey", F.col("o_custkey").cast("int").alias("measure"), season), path)
    late = t.orders.where("year(o_orderdate) = 1998").select("o_orderkey", F.col("o_totalprice").alias("measure"), season)
    W.upsert_partitions(t.spark, late, path)
    return W.read_table(t.spark, path)


@query("append_widened", """
select o_orderkey, cast(o_custkey as double) as measure from orders where o_orderkey % 2 = 0
union all select o_orderkey, o_totalprice from orders where o_orderkey % 2 = 1
""")
def q_append_widened(t: Tables) -> DataFrame:
    """I6 called directly: fractions appended to an integer column are kept."""
    o = t.orders
    target = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_custkey").cast("int").alias("measure"))
    return I.append(target, o.where("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_totalprice").alias("measure")))


@query("snapshot_recovered", """
with old as (select c_custkey, c_mktsegment as run from customer),
new as (select c_custkey, case when c_custkey % 7 = 0 then 'MOVED' else c_mktsegment end as run from customer where c_custkey % 5 <> 0)
select o.c_custkey, o.run, n.c_custkey is null or n.run <> o.run as closed from old o left join new n using (c_custkey)
union all
select n.c_custkey, n.run, false from new n join old o using (c_custkey) where n.run <> o.run
""")
def q_snapshot_recovered(t: Tables) -> DataFrame:
    """H3: a snapshot stops after its commit is published; the next reader puts both its tables in place, so no
    version is there twice or lost.  A data column is named ``run`` like the folders.  F18: times are the session's."""
    cfg = SnapshotConfig("c_custkey", "check", check_cols="all", hard_deletes="invalidate")
    path = _scratch(t, "snapshot")
    old = t.customer.select("c_custkey", F.col("c_mktsegment").alias("run"))
    new = old.where("c_custkey % 5 <> 0").withColumn("run", F.when(F.col("c_custkey") % 7 == 0, "MOVED").otherwise(F.col("run")))
    apply_snapshot(t.spark, path, old, cfg)
    apply_snapshot(t.spark, path, new, cfg)
    # the second run's commit again, as a stop after publishing leaves it: journal written, nothing moved
    held = C.Commit(t.spark, path)
    C.write_text(t.spark, f"{held.staging}/_held", "")
    for rel, to in (("open", None), ("closed", "closed/copy")):
        C.rename(t.spark, f"{path}/{rel}", f"{held.staging}/{rel}")
        held.put(rel, to)
    held.publish()
    return read_snapshot(t.spark, path).select("c_custkey", "run", F.col("dbt_valid_to").isNotNull().alias("closed"))


@query("snapshot_clock", "select c_custkey, true as in_run, true as is_open from customer")
def q_snapshot_clock(t: Tables) -> DataFrame:
    """without a given time a snapshot is taken at the session's current timestamp."""
    path = _scratch(t, "clock")
    before = clock(t.spark)
    apply_snapshot(t.spark, path, t.customer.select("c_custkey"), SnapshotConfig("c_custkey", "check"))
    after = clock(t.spark)
    in_run = F.col("dbt_valid_from").between(F.lit(before).cast("timestamp_ntz"), F.lit(after).cast("timestamp_ntz"))
    return read_snapshot(t.spark, path).select("c_custkey", in_run.alias("in_run"), F.col("dbt_valid_to").isNull().alias("is_open"))


@query("typed_cells", """
select l_orderkey, l_linenumber, cast(l_quantity as bigint) as pts, cast(l_discount as double) as pct,
       case when l_tax = 0 then '-' else cast(cast(l_quantity as bigint) as varchar) || ':' || lpad(cast(l_linenumber as varchar), 2, '0') end as min,
       case when l_linenumber = 1 then cast(cast(l_quantity as bigint) as varchar) end as gs_text,
       case when l_returnflag = 'R' then '' else cast(cast(l_quantity as bigint) as varchar) end as reb
from lineitem
""")
def q_typed_cells(t: Tables) -> DataFrame:
    """Cells of a stat table as text get the type that loses none of them: whole numbers, numbers with a point,
    and text where one cell is ``32:10``, ``-`` or empty.  Missing cells decide nothing."""
    whole = F.col("l_quantity").cast("bigint").cast("string")
    cells = t.lineitem.select(
        "l_orderkey", "l_linenumber", whole.alias("pts"), F.col("l_discount").cast("string").alias("pct"),
        F.when(F.col("l_tax") == 0, "-").otherwise(F.concat(whole, F.lit(":"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0"))).alias("min"),
        F.when(F.col("l_linenumber") == 1, whole).alias("gs"),
        F.when(F.col("l_returnflag") == "R", "").otherwise(whole).alias("reb"))
    typed = P.typed_cells(cells, ["pts", "pct", "min", "gs", "reb"])
    return typed.select("l_orderkey", "l_linenumber", "pts", "pct", "min", F.col("gs").cast("string").alias("gs_text"), "reb")


@query("type_names", """
select o_orderkey, cast(o_orderkey as varchar) as as_string, cast(o_orderdate as timestamp) as as_timestamp,
       cast(o_totalprice as float) as as_float, cast(o_orderkey as decimal(28,6)) as as_numeric,
       cast(o_custkey as bigint) as as_bigint, cast(o_custkey as integer) as as_int, cast(o_custkey % 2 as boolean) as as_boolean,
       'string timestamp_ntz float decimal(28,6) bigint int boolean' as names
from orders
""")
def q_type_names(t: Tables) -> DataFrame:
    """every portable type label as a cast and by the name of the type that comes out."""
    from_cols = {"string": "o_orderkey", "timestamp": "o_orderdate", "float": "o_totalprice", "numeric": "o_orderkey",
                 "bigint": "o_custkey", "int": "o_custkey", "boolean": F.col("o_custkey") % 2}
    cast = {label: (F.col(c) if isinstance(c, str) else c).cast(X.type_name(label)) for label, c in from_cols.items()}
    return t.orders.select("o_orderkey", *[c.alias(f"as_{label}") for label, c in cast.items()],
                           F.concat_ws(" ", *[F.call_function("typeof", c) for c in cast.values()]).alias("names"))
