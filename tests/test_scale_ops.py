"""Skew-safe full joins, profiles that add up, checks while writing."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import joins as J
from tidewater.operators import quality as Q
from tidewater.operators import writers as W
from tidewater.session import scratch_path


def fresh(spark, name):
    return scratch_path(spark, f"tests/{name}-{uuid.uuid4().hex[:8]}")


def sides(spark):
    left = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
                                    .otherwise(F.col("id") % 900).alias("lk"), F.col("id").alias("lv"))
    right = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 40 == 1, None)
                                     .otherwise(F.col("id") % 1200).alias("rk"), F.col("id").alias("rv"))
    return left, right


def test_full_join_with_hot_and_null_keys_equals_the_plain_join(spark):
    left, right = sides(spark)
    want = rows(left.join(right, left.lk == right.rk, "full"))
    assert len(J.hot_hashes(left, ["lk"], 0.05)) == 1 and J.hot_hashes(left.where("lk <> 7"), ["lk"], 0.05) == []
    assert rows(J.full_join(left, right, [("lk", "rk")], 0.05, 0)) == want           # hot on each side, one of them matched
    assert rows(J.full_join(left, right, [("lk", "rk")])) == want                    # small: the plain join
    assert rows(J.full_join(left, right.where("rk <> 7 or rk is null"), [("lk", "rk")], 0.05, 0)) == \
        rows(left.join(right.where("rk <> 7 or rk is null"), left.lk == right.rk, "full"))
    two = J.full_join(left.withColumn("lm", F.col("lk") % 2), right.withColumn("rm", F.col("rk") % 2), [("lk", "rk"), ("lm", "rm")], 0.05, 0)
    assert rows(two.select("lk", "lv", "rk", "rv")) == want


def test_no_task_holds_a_hot_key(spark):
    """A third of the rows on one key: the joined rows of the plain join lie in one partition, here in many."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(60_000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("lk"),
                                                           F.md5(F.col("id").cast("string")).alias("lv"))
        right = spark.range(20_000, numPartitions=4).select(F.col("id").alias("rk"), F.lit("r").alias("rv"))

        def largest(df):
            placed = df.select("lk", F.spark_partition_id().alias("p"))      # the filter stays above the join
            return placed.where("lk = 7").groupBy("p").count().agg(F.max("count")).first()[0]

        assert largest(left.join(right, left.lk == right.rk, "full")) == 20_001       # 7 itself is an id, too
        assert largest(J.full_join(left, right, [("lk", "rk")], look_from=0)) < 10_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_profile_of_parts_is_the_profile_of_the_whole(spark):
    path = fresh(spark, "profile")
    df = spark.range(20_000).select((F.col("id") % 4).cast("string").alias("season"), F.when(F.col("id") % 10 > 0, F.col("id") * 3).alias("n"),
                                    F.concat(F.lit("v"), F.col("id") % 700).alias("v"), F.array("id").alias("a"), F.lit(None).cast("double").alias("e"))
    keys = ["season"]
    W.upsert_partitions(spark, Q.profile_state(df.where("season < '3'"), keys), path, keys)
    first = {f for f in W.C.data_files(spark, path)}
    W.upsert_partitions(spark, Q.profile_state(df.where("season = '3'"), keys), path, keys)
    assert first <= set(W.C.data_files(spark, path))                 # older partitions' states stay the same files
    for _ in range(2):                                               # loading a partition again changes nothing
        got = {r.column_name: r for r in Q.merged_profile(W.read_table(spark, path), "t").collect()}
        W.upsert_partitions(spark, Q.profile_state(df.where("season = '3'"), keys), path, keys)
    n, v, a, e = (got[c] for c in ("n", "v", "a", "e"))
    assert (n.n_rows, n.n_nulls, n.min_value, n.max_value, n.data_type) == (20_000, 2000, "3", "59997", "bigint")
    assert abs(n.n_distinct - 18_000) < 400 and abs(n.median - 30_000) < 1200 and abs(v.n_distinct - 700) < 15
    assert (v.min_value, v.max_value, v.median) == ("v0", "v99", None) and a.min_value is None and abs(a.n_distinct - 20_000) < 450
    assert (e.n_nulls, e.n_distinct, e.min_value, e.median) == (20_000, 0, None, None)


DATA = [(1, "a", 5), (2, None, 6), (3, "c", -1), (4, None, None)]
CHECKS = {"has name": "name is not null", "positive": "n > 0"}


def test_a_failing_load_is_refused_or_quarantined(spark):
    schema = "id bigint, name string, n int"
    path, aside = fresh(spark, "checked"), fresh(spark, "aside")
    df = spark.createDataFrame(DATA, schema)
    assert W.checked_load(df.where("id = 1"), path, CHECKS) == {}
    with pytest.raises(W.ChecksFailed) as failed:
        W.checked_load(df, path, CHECKS)
    assert failed.value.failures == {"has name": 2, "positive": 2}
    assert rows(W.read_table(spark, path)) == [(1, "a", 5)]                                    # as it was
    assert W.checked_load(df, path, CHECKS, quarantine=aside, append=True) == {"has name": 2, "positive": 2}
    assert rows(W.read_table(spark, path)) == [(1, "a", 5), (1, "a", 5)]
    left = {r.id: r[W.FAILED] for r in W.read_table(spark, aside).collect()}
    assert left == {2: ["has name"], 3: ["positive"], 4: ["has name", "positive"]}
    W.checked_load(df, path, CHECKS, quarantine=aside)                                         # replaces the table, adds to the quarantine
    assert rows(W.read_table(spark, path)) == [(1, "a", 5)] and W.read_table(spark, aside).count() == 6
    parts, bad = fresh(spark, "checked-parts"), fresh(spark, "aside-parts")
    for _ in range(2):
        W.checked_load(df, parts, CHECKS, quarantine=bad, partition_by=["name"], append=True)
    assert W.read_table(spark, parts).count() == 2 and rows(W.read_table(spark, bad).groupBy("name").count()) == [("c", 2), (None, 4)]
    with pytest.raises(ValueError, match="contract not met.*missing column id"):
        W.checked_load(df.drop("id"), path, CHECKS, contract=df.schema)
    assert W.checked_load(df.limit(0), path, CHECKS, append=True) == {} and W.read_table(spark, path).count() == 1


def test_checks_cost_no_second_scan(spark):
    """The load reads its input once: the accumulator in a Python function sees every row one time."""
    seen = spark.sparkContext.accumulator(0)

    def look(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    df = spark.createDataFrame(DATA, "id bigint, name string, n int").mapInPandas(look, "id bigint, name string, n int")
    W.checked_load(df, fresh(spark, "once"), CHECKS, quarantine=fresh(spark, "once-aside"))
    assert seen.value == len(DATA)


def test_percentiles_are_compared_without_collecting_the_values(spark):
    from itertools import product
    for column, value in product(([1], [1, 2], [1, 2, 2, 3, 10], list(range(21)), [5, None, 5, 7], [None], []), (None, 0.5, 1.0, 1.45, 1.5, 2.0, 9.0, 10.9, 11, 12)):
        df = spark.createDataFrame([(x,) for x in column], "x long")
        values = spark.createDataFrame([(None if value is None else float(value),)], "x double")
        lo, hi = df.agg(F.percentile("x", F.lit(0.45)), F.percentile("x", F.lit(0.55))).first()
        want = None if lo is None or value is None else lo <= value <= hi
        assert Q.within_percentiles(df, values, 0.45, 0.55).first().x == want, (column, value)
    plan = Q.within_percentiles(df, values, 0.45, 0.55)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan and "collect_list" not in plan
