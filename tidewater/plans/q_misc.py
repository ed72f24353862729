"""Write-path, streaming and SQL-function queries (S15-S18, I1/I4/I5 writers, X1, Y1-Y4).

Queries that persist data write below the shared checkpoint folder
(``spark.checkpoint.dir``) into a fresh sub-folder per run, then return the
table read back, so the check covers the round trip.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import sqlfuncs as Y
from tidewater.operators import writers as W
from tidewater.operators.incremental import Clause
from tidewater.plans.registry import query
from tidewater.session import scratch_path
from tidewater.sources import files as S
from tidewater.sources.tables import Tables
from tidewater.streaming.upsert_stream import stream_upsert


def _scratch(t: Tables, name: str) -> str:
    return scratch_path(t.spark, f"tidewater-q/{name}-{uuid.uuid4().hex[:10]}")


@query("stream_upsert", "select event_id, ts, user_id, event_type, value, props from events")
def q_stream_upsert(t: Tables) -> DataFrame:
    """A target that holds stale copies of the first 19 days, one day early and so
    in the wrong partition, is brought up to date by streaming ``events`` (four files,
    a micro-batch each) through ``foreachBatch`` delete+insert on ``event_id``; every
    key moves to another day's partition and the result equals the source."""
    spark = t.spark
    base = _scratch(t, "stream_upsert")
    target, landing = f"{base}/target", f"{base}/landing"
    ev = t.events
    ev.repartition(4, "event_id").write.parquet(landing)
    day = F.to_date("ts").cast("string")
    stale = (ev.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
             .withColumn("value", F.col("value") - F.lit(1.0))
             .withColumn("ts", (F.col("ts") - F.expr("interval 1 day")).cast("timestamp_ntz")).withColumn("day", day))
    W.replace_table(stale, target, partition_by=["day"])
    stream_upsert(spark, landing, ev.schema, target, f"{base}/checkpoint", unique_key="event_id",
                  partition_by=["day"], derive={"day": day})
    return W.read_table(spark, target).select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("upsert_partition_write", """
select o_orderkey, o_custkey, o_orderstatus,
       case when year(o_orderdate) in (1997, 1998) then o_totalprice + cast(1 as double) else o_totalprice end
       as o_totalprice, cast(year(o_orderdate) as varchar) as season, 'Regular Season' as season_type
from orders
""")
def q_upsert_partition_write(t: Tables) -> DataFrame:
    """I1 + I4 on disk: load every season, then reload two seasons with new
    values (plus an unexpected extra column, dropped) and an empty frame."""
    spark = t.spark
    base = _scratch(t, "upsert")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                        F.year("o_orderdate").cast("string").alias("season"),
                        F.lit("Regular Season").alias("season_type"))
    W.write_table_set(spark, {"orders": o}, base)
    again = (o.filter(F.col("season").isin("1997", "1998"))
             .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)).withColumn("extra", F.lit(1)))
    W.write_table_set(spark, {"orders": again, "empty": o.limit(0)}, base)
    back = W.read_table(spark, f"{base}/orders")
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "season", "season_type")


@query("seed_roundtrip", "select n_nationkey, n_name, cast(n_regionkey as bigint) as n_regionkey from nation")
def q_seed_roundtrip(t: Tables) -> DataFrame:
    """S15 + S18: a table written as a header CSV seed (``|`` delimited) and
    loaded back with a type override."""
    path = _scratch(t, "seed") + "/nation.csv"
    S.write_seed(t.nation, path, delimiter="|")
    return S.load_seed(t.spark, path, {"n_nationkey": "int", "n_regionkey": "bigint"}, delimiter="|")


@query("export_roundtrip", """
select 'customer' as tbl, c_custkey as id, c_name as name, c_acctbal as balance from customer
union all select 'supplier', s_suppkey, s_name, s_acctbal from supplier
""")
def q_export_roundtrip(t: Tables) -> DataFrame:
    """Each table exported as its own parquet file set; the contents read back."""
    spark = t.spark
    paths = S.export_tables({"customer": t.customer, "supplier": t.supplier}, _scratch(t, "export"))
    names = {"customer": ("c_custkey", "c_name", "c_acctbal"), "supplier": ("s_suppkey", "s_name", "s_acctbal")}
    back = []
    for path in paths:
        tbl = path.rsplit("/", 1)[1].split(".")[0]
        i, n, b = names[tbl]
        back.append(spark.read.parquet(path).select(F.lit(tbl).alias("tbl"), F.col(i).alias("id"), F.col(n).alias("name"),
                                                    F.col(b).alias("balance")))
    return back[0].unionByName(back[1])


@query("external_roundtrip", """
select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders
""")
def q_external_roundtrip(t: Tables) -> DataFrame:
    """An external parquet location partitioned by a column, read back
    with schema merging (the partition column returns as a column)."""
    loc = _scratch(t, "external") + "/orders.parquet"
    S.write_external(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), loc,
                     partition_by=["o_orderstatus"])
    back = S.read_external(t.spark, loc)
    return back.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query("external_rerun", """
select o_orderkey, o_totalprice, o_orderstatus from orders where o_orderstatus <> 'P'
""")
def q_external_rerun(t: Tables) -> DataFrame:
    """A rerun with fewer partitions leaves none of the earlier ones."""
    loc = _scratch(t, "external") + "/orders.parquet"
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    S.write_external(o, loc, partition_by=["o_orderstatus"])
    S.write_external(o.filter(F.col("o_orderstatus") != "P"), loc, partition_by=["o_orderstatus"])
    return S.read_external(t.spark, loc).select(*o.columns)


# --------------------------------------------------------------------------
# Incremental runs on partitioned tables, read back from disk
# --------------------------------------------------------------------------

ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _orders_on_disk(t: Tables, name: str, partition_by: str) -> tuple[str, DataFrame]:
    path = _scratch(t, name) + "/orders"
    o = t.orders.select(*ORDER_COLS)
    W.apply_incremental(t.spark, path, o, partition_by=[partition_by])
    return path, o


_MOVED_SQL = """
select o_orderkey, o_custkey, o_orderstatus,
       case when o_orderkey % 10 = 0 then o_totalprice + cast(1 as double) else o_totalprice end as o_totalprice,
       case when o_orderkey % 10 = 0 then '9-NEW' else o_orderpriority end as o_orderpriority
from orders
"""


def _moved(o: DataFrame) -> DataFrame:
    return (o.filter(F.col("o_orderkey") % 10 == 0).withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0))
            .withColumn("o_orderpriority", F.lit("9-NEW")))


@query("inc_disk_moved_key", _MOVED_SQL)
def q_inc_disk_moved_key(t: Tables) -> DataFrame:
    """I7 on disk: every tenth key moves to another partition and leaves its old one."""
    path, o = _orders_on_disk(t, "moved", "o_orderpriority")
    W.apply_incremental(t.spark, path, _moved(o), "delete+insert", "o_orderkey", ["o_orderpriority"])
    return W.read_table(t.spark, path).select(*ORDER_COLS)


@query("inc_disk_merge_moved_key", _MOVED_SQL)
def q_inc_disk_merge_moved_key(t: Tables) -> DataFrame:
    """I8 on disk: the same by merge, applied twice (the rerun changes nothing)."""
    path, o = _orders_on_disk(t, "merge_moved", "o_orderpriority")
    for _ in range(2):
        W.apply_incremental(t.spark, path, _moved(o), "merge", "o_orderkey", ["o_orderpriority"])
    return W.read_table(t.spark, path).select(*ORDER_COLS)


@query("inc_disk_merge_empties", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority "
                                  "from orders where o_orderstatus <> 'P'")
def q_inc_disk_merge_empties(t: Tables) -> DataFrame:
    """I9 on disk: a merge that deletes every row of a partition removes it."""
    path, o = _orders_on_disk(t, "empties", "o_orderstatus")
    W.apply_incremental(t.spark, path, o.filter(F.col("o_orderstatus") == "P"), "merge", "o_orderkey", ["o_orderstatus"],
                        clauses=[Clause("matched", "delete")])
    return W.read_table(t.spark, path).select(*ORDER_COLS)


@query("inc_disk_by_source", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders
where o_orderpriority = '1-URGENT' or o_totalprice >= 100000
""")
def q_inc_disk_by_source(t: Tables) -> DataFrame:
    """I9 on disk: rows that the source lacks are deleted in partitions that it never names."""
    path, o = _orders_on_disk(t, "by_source", "o_orderpriority")
    W.apply_incremental(t.spark, path, o.filter(F.col("o_orderpriority") == "1-URGENT"), "merge", "o_orderkey",
                        ["o_orderpriority"],
                        clauses=[Clause("matched", "do_nothing"),
                                 Clause("not_matched_by_source", "delete", "t.o_totalprice < 100000")])
    return W.read_table(t.spark, path).select(*ORDER_COLS)


@query("inc_disk_microbatch", """
select event_id, ts, user_id, event_type, value, props from events
where not (ts >= timestamp '2024-01-16' and ts < timestamp '2024-01-17')
""")
def q_inc_disk_microbatch(t: Tables) -> DataFrame:
    """I13 on disk: the slice holds two days, the source has rows for one; the other day's rows go."""
    path = _scratch(t, "microbatch") + "/events"
    ev = t.events.withColumn("day", F.to_date("ts"))
    W.apply_incremental(t.spark, path, ev, partition_by=["day"])
    again = ev.filter(F.col("ts") >= F.lit("2024-01-17").cast("timestamp_ntz"))
    W.apply_incremental(t.spark, path, again, "microbatch", None, ["day"], event_time="ts",
                        start=dt.datetime(2024, 1, 16), end=dt.datetime(2024, 1, 18))
    return W.read_table(t.spark, path).drop("day")


@query("inc_disk_full_refresh", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority "
                                 "from orders where o_orderstatus = 'F'")
def q_inc_disk_full_refresh(t: Tables) -> DataFrame:
    """I14 on disk: a full refresh keeps no partition of the old table."""
    path, o = _orders_on_disk(t, "refresh", "o_orderstatus")
    W.apply_incremental(t.spark, path, o.filter(F.col("o_orderstatus") == "F"), "merge", "o_orderkey", ["o_orderstatus"],
                        full_refresh=True)
    return W.read_table(t.spark, path).select(*ORDER_COLS)


@query("inc_disk_new_column", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       case when o_orderstatus = 'F' then o_custkey * 2 end as score
from orders
""")
def q_inc_disk_new_column(t: Tables) -> DataFrame:
    """I16 on disk: ``append_new_columns`` on a partitioned table; all partitions have the column."""
    path, o = _orders_on_disk(t, "new_column", "o_orderstatus")
    more = o.filter(F.col("o_orderstatus") == "F").withColumn("score", F.col("o_custkey") * 2)
    W.apply_incremental(t.spark, path, more, "merge", "o_orderkey", ["o_orderstatus"],
                        on_schema_change_mode="append_new_columns")
    return W.read_table(t.spark, path).select(*ORDER_COLS, "score")


@query("inc_disk_overwrite_append", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders where o_orderstatus <> 'F'
union all
select o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2, o_orderpriority from orders
where o_orderstatus = 'F' and o_orderkey % 2 = 0
union all
select -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders where o_orderstatus = 'O'
""")
def q_inc_disk_overwrite_append(t: Tables) -> DataFrame:
    """I12 + I6 on disk: one partition replaced by fewer rows, then rows appended to another."""
    path, o = _orders_on_disk(t, "overwrite", "o_orderstatus")
    part = ["o_orderstatus"]
    half = o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 2 == 0))
    W.apply_incremental(t.spark, path, half.withColumn("o_totalprice", F.col("o_totalprice") * 2), "insert_overwrite", None, part)
    more = o.filter(F.col("o_orderstatus") == "O").withColumn("o_orderkey", -F.col("o_orderkey"))
    W.apply_incremental(t.spark, path, more, "append", None, part)
    return W.read_table(t.spark, path).select(*ORDER_COLS)


@query("python_model", """
select o_custkey, cast(count(*) as bigint) as n_orders, max(o_totalprice) as top_price from orders
where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING') group by 1
""")
def q_python_model(t: Tables) -> DataFrame:
    """A model written in Python that reads two upstream models by name, one of
    them a table on disk, and is persisted."""
    base = _scratch(t, "python_model")
    W.replace_table(t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey"), f"{base}/builders")

    def model(ref, spark):
        orders = ref("orders").join(ref("builders"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        return orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("top_price"))

    return W.python_model(t.spark, model, {"orders": t.orders, "builders": f"{base}/builders"}, f"{base}/model")


@query("materialize_table", """
select c_mktsegment, cast(count(*) as bigint) as n, max(c_acctbal) as top from customer group by 1
""")
def q_materialize_table(t: Tables) -> DataFrame:
    """A model rebuilt as a stored table, twice, and read back."""
    path = _scratch(t, "table") + "/segments"
    model = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.max("c_acctbal").alias("top"))
    W.replace_table(model.limit(1), path)
    W.replace_table(model, path)
    return W.read_table(t.spark, path)


@query("materialize_view", """
select c_mktsegment, cast(count(*) as bigint) as n from customer group by 1
""")
def q_materialize_view(t: Tables) -> DataFrame:
    """A model registered as a lazy view and queried by name."""
    name = f"tw_segments_{uuid.uuid4().hex[:8]}"
    W.materialize_as(t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), name, "view")
    return t.spark.table(name)


def _lineitem_view(t: Tables) -> str:
    name = f"tw_lineitem_{uuid.uuid4().hex[:8]}"
    t.lineitem.createOrReplaceTempView(name)
    return name


@query("table_function", """
select l_linenumber, cast(count(*) as bigint) as n, cast(sum(l_quantity) as bigint) as qty
from lineitem where l_quantity >= 45 group by 1
""")
def q_table_function(t: Tables) -> DataFrame:
    """A parameterised view (SQL table function); the call is inlined, so
    the parameter's filter reaches the scan."""
    view = _lineitem_view(t)
    fn = f"tw_big_lines_{uuid.uuid4().hex[:8]}"
    Y.create_table_function(t.spark, fn, [("min_qty", "DOUBLE")],
                            [("l_orderkey", "BIGINT"), ("l_linenumber", "INT"), ("l_quantity", "DOUBLE")],
                            f"SELECT l_orderkey, l_linenumber, l_quantity FROM {view} WHERE l_quantity >= min_qty")
    return t.spark.sql(f"SELECT l_linenumber, count(*) AS n, cast(sum(l_quantity) AS BIGINT) AS qty "
                       f"FROM {fn}(45) GROUP BY l_linenumber")


@query("scalar_sql_function", """
select l_returnflag,
       cast(sum(cast(round(l_extendedprice * (1 - l_discount) * 100) as bigint)) as bigint) as net_cents
from lineitem group by 1
""")
def q_scalar_sql_function(t: Tables) -> DataFrame:
    """Y2: a deterministic SQL scalar function used inside an aggregate."""
    view = _lineitem_view(t)
    fn = f"tw_net_price_{uuid.uuid4().hex[:8]}"
    Y.create_scalar_function(t.spark, fn, [("p", "DOUBLE"), ("d", "DOUBLE")], "DOUBLE", "p * (1 - d)")
    return t.spark.sql(f"SELECT l_returnflag, sum(cast(round({fn}(l_extendedprice, l_discount) * 100) AS BIGINT)) "
                       f"AS net_cents FROM {view} GROUP BY l_returnflag")


@query("agg_function", """
select l_returnflag, sum(l_quantity * l_linenumber) / nullif(cast(sum(l_linenumber) as double), 0) as wavg_qty
from lineitem group by 1
""")
def q_agg_function(t: Tables) -> DataFrame:
    """A user aggregate as a macro of built-in aggregates (partial
    aggregation intact); integer-valued products keep the sums exact."""
    li = t.lineitem
    return li.groupBy("l_returnflag").agg(Y.weighted_average("l_quantity", "l_linenumber").alias("wavg_qty"))


@query("agg_function_user", """
select l_shipmode_like as line_kind, max(l_quantity) - min(l_quantity) as spread, cast(sum(l_linenumber) as double) / count(*) as mean_no
from (select *, l_returnflag || l_linestatus as l_shipmode_like from lineitem) group by 1
""")
def q_agg_function_user(t: Tables) -> DataFrame:
    """Two aggregates that a user registers from SQL text, called by name."""
    Y.create_aggregate_function("spread", ["x"], "max(x) - min(x)")
    Y.create_aggregate_function("mean_of", ["x"], "cast(sum(x) as double) / count(x)")
    li = t.lineitem.withColumn("line_kind", F.concat("l_returnflag", "l_linestatus"))
    return li.groupBy("line_kind").agg(Y.aggregate("spread")("l_quantity").alias("spread"),
                                       Y.aggregate("mean_of")("l_linenumber").alias("mean_no"))


@query("full_replace", """
select c_custkey, c_name, c_mktsegment from customer where c_mktsegment <> 'MACHINERY'
""")
def q_full_replace(t: Tables) -> DataFrame:
    """A table rebuilt from a frame that reads the table itself (written to a
    staging path, then swapped in; the old files go only after the swap)."""
    spark = t.spark
    path = _scratch(t, "replace") + "/customers"
    W.replace_table(t.customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    current = spark.read.parquet(path)
    W.replace_table(current.filter(F.col("c_mktsegment") != "MACHINERY"), path)
    return spark.read.parquet(path)
