"""Incremental strategies: properties, errors and writers."""

import uuid

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import incremental as I
from tidewater.operators import writers as W
from tidewater.operators.incremental import Clause
from tidewater.session import scratch_path

SCHEMA = "id bigint, v string, n bigint"


def _t(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_delete_insert_twice_equals_once(spark):
    target = _t(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3)])
    source = _t(spark, [(2, "B", 20), (4, "D", 40)])
    once = I.delete_insert(target, source, "id")
    twice = I.delete_insert(once, source, "id")
    assert rows(once) == rows(twice) == [(1, "a", 1), (2, "B", 20), (3, "c", 3), (4, "D", 40)]


def test_merge_equals_delete_insert_for_unique_keys(spark):
    target = _t(spark, [(1, "a", 1), (2, "b", 2), (3, None, 3)])
    source = _t(spark, [(2, "B", None), (3, "C", 30), (5, "E", 50)])
    assert rows(I.merge(target, source, "id")) == rows(I.delete_insert(target, source, "id"))


def test_merge_null_key_source_row_is_inserted(spark):
    target = _t(spark, [(1, "a", 1)])
    source = _t(spark, [(None, "x", 9), (1, "A", 10)])
    assert rows(I.merge(target, source, "id")) == [(1, "A", 10), (None, "x", 9)]


def test_merge_duplicate_source_key_raises(spark):
    target = _t(spark, [(1, "a", 1)])
    source = _t(spark, [(1, "x", 2), (1, "y", 3)])
    with pytest.raises(PySparkException):
        I.merge(target, source, "id").collect()


def test_merge_without_key_inserts_only(spark):
    target = _t(spark, [(1, "a", 1)])
    source = _t(spark, [(1, "b", 2)])
    assert rows(I.merge(target, source, None)) == [(1, "a", 1), (1, "b", 2)]


def test_merge_update_condition_false_keeps_target(spark):
    target = _t(spark, [(1, "a", 5)])
    source = _t(spark, [(1, "b", 1)])
    assert rows(I.merge(target, source, "id", update_condition="s.n > t.n")) == [(1, "a", 5)]


def test_merge_clauses_delete_by_source_and_error(spark):
    target = _t(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3)])
    source = _t(spark, [(1, "A", 10), (4, "D", 40)])
    clauses = [Clause("matched", "update", mode="explicit", include=("n",)),
               Clause("not_matched", "insert"),
               Clause("not_matched_by_source", "delete", "t.id = 2"),
               Clause("not_matched_by_source", "update", set={"v": "upper(t.v)"})]
    assert rows(I.merge(target, source, "id", clauses=clauses)) == [(1, "a", 10), (3, "C", 3), (4, "D", 40)]
    err = [Clause("matched", "error", error_message="no updates allowed")]
    with pytest.raises(PySparkException, match="no updates allowed"):
        I.merge(target, source, "id", clauses=err).collect()


def test_merge_validation_reports_all_errors(spark):
    target = _t(spark, [(1, "a", 1)])
    with pytest.raises(ValueError) as e:
        I.merge(target, target, "id", update_columns=["v"], exclude_columns=["n"],
                clauses=[Clause("matched", "insert"), Clause("sideways", "update"),
                         Clause("matched", "update", mode="explicit", include=("nope",))])
    msg = str(e.value)
    assert "cannot both be set" in msg and "not allowed" in msg and "unknown kind" in msg and "'nope'" in msg


def test_merge_returning(spark):
    target = _t(spark, [(1, "a", 1), (2, "b", 2)])
    source = _t(spark, [(2, "B", 20), (3, "C", 30)])
    got = rows(I.merge(target, source, "id", returning=True))
    assert got == [(2, "B", 20, "update"), (3, "C", 30, "insert")]


def test_insert_overwrite_partitions_and_microbatch(spark):
    target = spark.createDataFrame([(1, "d1"), (2, "d2"), (3, "d3")], "id bigint, day string")
    source = spark.createDataFrame([(20, "d2"), (40, "d4")], "id bigint, day string")
    assert rows(I.insert_overwrite(target, source, ["day"])) == [(1, "d1"), (3, "d3"), (20, "d2"), (40, "d4")]
    ev_t = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "id bigint, ts timestamp_ntz")
    ev_s = spark.createDataFrame([(9, dt.datetime(2024, 1, 2, 5)), (8, dt.datetime(2024, 1, 3))], "id bigint, ts timestamp_ntz")
    got = rows(I.microbatch(ev_t, ev_s, "ts", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)))
    assert [r[0] for r in got] == [1, 9]
    with pytest.raises(ValueError):
        I.microbatch(ev_t, ev_s, "ts", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), unique_key="id")
    with pytest.raises(ValueError):
        I.microbatch(ev_t, ev_s, None, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))


def test_schema_change_modes(spark):
    target = spark.createDataFrame([(1, "a")], "id bigint, old string")
    source = spark.createDataFrame([(1, 2.5)], "id bigint, new double")
    t2, s2 = I.on_schema_change(target, source, "append_new_columns")
    assert t2.columns == ["id", "old", "new"] and s2.columns == ["id", "old", "new"]
    t3, _ = I.on_schema_change(target, source, "sync_all_columns")
    assert t3.columns == ["id", "new"]
    with pytest.raises(ValueError):
        I.on_schema_change(target, source, "fail")
    assert I.wider_type(*[f.dataType for f in spark.createDataFrame([(1, 1.0)], "a int, b double").schema]).simpleString() == "double"


def test_partition_upsert_rerun_extra_missing_and_empty(spark):
    path = scratch_path(spark, f"tests/upsert_orders-{uuid.uuid4().hex[:8]}")
    first = spark.createDataFrame([(1, "x", "2025", "RS"), (2, "y", "2026", "RS")],
                                  "id bigint, v string, season string, season_type string")
    W.upsert_partitions(spark, first, path)
    again = spark.createDataFrame([(3, "2026", "RS", 1)], "id bigint, season string, season_type string, extra int")
    W.upsert_partitions(spark, again, path)
    W.upsert_partitions(spark, again, path)                      # rerun: same result
    W.upsert_partitions(spark, again.limit(0), path)             # empty: no-op
    got = rows(W.read_table(spark, path).select("id", "v", "season", "season_type"))
    assert got == [(1, "x", "2025", "RS"), (3, None, "2026", "RS")]


def test_apply_incremental_rewrites_in_place(spark):
    path = scratch_path(spark, f"tests/apply_inc-{uuid.uuid4().hex[:8]}")
    W.apply_incremental(spark, path, _t(spark, [(1, "a", 1), (2, "b", 2)]), "delete+insert", "id")
    W.apply_incremental(spark, path, _t(spark, [(2, "B", 20)]), "merge", "id")
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "B", 20)]
    ppath = scratch_path(spark, f"tests/apply_inc_part-{uuid.uuid4().hex[:8]}")
    src = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2")], "id bigint, v string, day string")
    W.apply_incremental(spark, ppath, src, "delete+insert", "id", partition_by=["day"])
    W.apply_incremental(spark, ppath, spark.createDataFrame([(2, "B", "d2")], "id bigint, v string, day string"),
                        "delete+insert", "id", partition_by=["day"])
    assert rows(W.read_table(spark, ppath)) == [(1, "a", "d1"), (2, "B", "d2")]
    moved = spark.createDataFrame([(1, "A", "d2")], "id bigint, v string, day string")
    for strategy in ("delete+insert", "merge"):
        W.apply_incremental(spark, ppath, moved, strategy, "id", partition_by=["day"])
        assert rows(W.read_table(spark, ppath)) == [(1, "A", "d2"), (2, "B", "d2")]
    assert W.read_table(spark, ppath).filter("day = 'd1'").count() == 0


def test_partitioned_runs_with_odd_partition_values(spark):
    path = scratch_path(spark, f"tests/apply_odd-{uuid.uuid4().hex[:8]}")
    sch = "id bigint, v string, p string, n int"
    data = [(1, "a", None, 1), (2, "b", "x/y z=%", 2), (3, "c", "", 2), (4, "d", "2026", None), (5, "e", "keep", 7)]
    W.apply_incremental(spark, path, spark.createDataFrame(data, sch), partition_by=["p", "n"])
    src = spark.createDataFrame([(1, "A", "x/y z=%", 2), (2, "B", None, 1), (4, "D", "2026", 5)], sch)
    W.apply_incremental(spark, path, src, "merge", "id", partition_by=["p", "n"])
    got = rows(W.read_table(spark, path).select("id", "v", F.coalesce("p", F.lit("")).alias("p"), "n"))
    assert got == [(1, "A", "x/y z=%", 2), (2, "B", "", 1), (3, "c", "", 2), (4, "D", "2026", 5), (5, "e", "keep", 7)]


def test_widening_keeps_values(spark):
    from pyspark.sql import types as T
    w = lambda a, b: I.wider_type(T._parse_datatype_string(a), T._parse_datatype_string(b)).simpleString()
    assert w("bigint", "decimal(10,2)") == "decimal(21,2)" and w("int", "decimal(12,4)") == "decimal(14,4)"
    assert w("bigint", "float") == "double" and w("smallint", "float") == "float" and w("int", "bigint") == "bigint"
    assert w("decimal(38,10)", "bigint") == "decimal(38,10)" and w("decimal(38,30)", "bigint") == "double"
    assert w("float", "decimal(5,2)") == "double" and w("date", "timestamp_ntz") == "timestamp_ntz" and w("int", "string") == "string"
    path = scratch_path(spark, f"tests/widen-{uuid.uuid4().hex[:8]}")
    W.apply_incremental(spark, path, spark.createDataFrame([(1, 1, "x")], "id bigint, n int, p string"), partition_by=["p"])
    W.apply_incremental(spark, path, spark.createDataFrame([(2, 1.75, "y")], "id bigint, n double, p string"),
                        "delete+insert", "id", partition_by=["p"])
    assert rows(W.read_table(spark, path)) == [(1, 1.0, "x"), (2, 1.75, "y")]


def test_merge_options_conflict_and_position(spark):
    target = _t(spark, [(1, "a", 1)])
    with pytest.raises(ValueError, match="remove update_condition"):
        I.merge(target, target, "id", clauses=[Clause("matched", "delete")], update_condition="true")
    with pytest.raises(ValueError, match="at least one clause"):
        I.merge(target, target, "id", clauses=[])
    swapped = spark.createDataFrame([(1, "X", "Y")], "id bigint, w string, v string")
    t2 = spark.createDataFrame([(1, "v", "w")], "id bigint, v string, w string")
    got = rows(I.merge(t2, swapped, "id", clauses=[Clause("matched", "update", mode="by_position")]))
    assert got == [(1, "X", "Y")]


def test_merge_predicate_decides_between_repeated_keys(spark):
    target = _t(spark, [(1, "a", 1), (2, "b", 2)])
    source = _t(spark, [(1, "x", 5), (1, "y", -5), (2, "z", 7)])
    got = rows(I.merge(target, source, "id", predicates=["s.n > 0"]))
    assert got == [(1, "x", 5), (1, "y", -5), (2, "z", 7)]
    with pytest.raises(PySparkException, match="more than one source row"):
        I.merge(target, source, "id", predicates=["s.n <> 0"]).collect()


def test_contract_check_and_first_run(spark):
    from pyspark.sql import types as T

    from tidewater.operators import quality as Q
    df = spark.createDataFrame([(1, "a")], "id bigint, v string")
    ok = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    assert Q.check_contract(df, ok) == []
    bad = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("w", T.StringType())])
    errs = Q.check_contract(df, bad)
    assert any("missing column w" in e for e in errs) and any("unexpected column v" in e for e in errs) \
        and any("column id is bigint" in e for e in errs)
    assert rows(I.incremental(None, df, "merge", unique_key="id")) == [(1, "a")]
    assert rows(I.incremental(df, _t(spark, [(9, "z", 1)]).select("id", "v"), "append", full_refresh=True)) == [(9, "z")]


def test_merge_using_columns_and_explicit_insert(spark):
    target = _t(spark, [(1, "a", 1), (2, "b", 2)])
    source = _t(spark, [(2, "B", 20), (3, "C", 30)])
    clauses = [Clause("matched", "update", mode="explicit", include=("v",)),
               Clause("not_matched", "insert", mode="explicit", insert_columns=("id", "v", "n"),
                      insert_values=("s.id", "concat('new-', s.v)", "0"))]
    got = rows(I.merge(target, source, using=["id"], clauses=clauses))
    assert got == [(1, "a", 1), (2, "B", 2), (3, "new-C", 0)]
    # an ON predicate beside USING keys: target rows outside it do not match
    got2 = rows(I.merge(target, source, using=["id"], predicates=["t.n > 5"]))
    assert got2 == [(1, "a", 1), (2, "B", 20), (2, "b", 2), (3, "C", 30)]


def test_fixture_frame_missing_and_unknown_columns(spark):
    from tidewater.operators import quality as Q
    df = Q.fixture_frame(spark, [{"id": 1, "v": "a"}, {"id": 2}], "id bigint, v string, n bigint")
    assert rows(df) == [(1, "a", None), (2, None, None)]
    with pytest.raises(ValueError, match="nope"):
        Q.fixture_frame(spark, [{"id": 1, "nope": 2}], "id bigint")


def test_failed_rewrite_leaves_the_table_intact(spark):
    path = scratch_path(spark, f"tests/replace_fail-{uuid.uuid4().hex[:8]}")
    W.replace_table(_t(spark, [(1, "a", 1), (2, "b", 2)]), path)
    current = spark.read.parquet(path)
    broken = current.withColumn("n", F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("n")))
    with pytest.raises(Exception):
        W.replace_table(broken, path)
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "b", 2)]
    # a failing incremental run leaves it intact as well
    bad_src = _t(spark, [(3, "c", 3)]).withColumn("n", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception):
        W.apply_incremental(spark, path, bad_src, "delete+insert", "id")
    assert rows(spark.read.parquet(path)) == [(1, "a", 1), (2, "b", 2)]
