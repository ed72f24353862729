"""Scalar expressions against brute-force Python definitions."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from tidewater.functions import exprs as X
from tidewater.operators import reshape


def _duck_week_diff(a: dt.date, b: dt.date) -> int:
    days = (b - a).days
    q = int(days / 7) if days >= 0 else -((-days) // 7)
    dow = lambda d: (d.weekday() + 1) % 7  # noqa: E731  Sunday = 0
    if dow(a) <= dow(b):
        return q + (0 if a <= b else -1)
    return q + (1 if a <= b else 0)


def test_datediff_parts_against_python(spark):
    rnd = random.Random(3)
    base = dt.date(1995, 1, 1)
    pairs = [(base + dt.timedelta(rnd.randint(0, 4000)), base + dt.timedelta(rnd.randint(0, 4000))) for _ in range(400)]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select("a", "b", *[X.datediff("a", "b", p).alias(p) for p in ("year", "quarter", "month", "week", "day")]).collect()
    for r in got:
        a, b = r["a"], r["b"]
        assert r["year"] == b.year - a.year
        assert r["quarter"] == (b.year * 4 + (b.month - 1) // 3) - (a.year * 4 + (a.month - 1) // 3)
        assert r["month"] == (b.year * 12 + b.month) - (a.year * 12 + a.month)
        assert r["day"] == (b - a).days
        assert r["week"] == _duck_week_diff(a, b)


def test_round_half_away_and_ratio(spark):
    vals = [0.285, 2.5, -2.5, 0.125, 1.005, -0.0049999, 123456.785]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double")
           .select(X.round_half_away("x", 2)).collect()]
    want = [math.copysign(math.floor(abs(v) * 100 + 0.5), v) / 100 if abs(v * 100) % 1 != 0.5 else
            math.copysign(math.floor(abs(v * 100)) + 1, v) / 100 for v in vals]
    assert got == [round(w, 10) for w in want] or got == want
    assert got[0] == 0.28          # scale, round, unscale (not the decimal text 0.285)
    r = spark.createDataFrame([(1, 0), (2, 3), (None, 3)], "a int, b int").select(X.ratio("a", "b", 3)).collect()
    assert [x[0] for x in r] == [None, 0.667, None]


def test_split_part_last_day_dateadd(spark):
    df = spark.createDataFrame([("a.b.c", dt.date(2024, 1, 31))], "s string, d date")
    r = df.select(X.split_part("s", ".", 1).alias("p1"), X.split_part("s", ".", -1).alias("pm1"),
                  X.split_part("s", ".", 9).alias("p9"), X.last_day("d", "quarter").alias("lq"),
                  X.last_day("d", "week").alias("lw"), X.dateadd("month", 1, "d").alias("m1"),
                  X.dateadd("quarter", -1, "d").alias("q1"), X.season_label(F.lit("2026")).alias("sl")).collect()[0]
    assert (r["p1"], r["pm1"], r["p9"]) == ("a", "c", None)
    assert r["lq"] == dt.date(2024, 3, 31) and r["lw"] == dt.date(2024, 2, 4)
    assert r["m1"] == dt.datetime(2024, 2, 29) and r["q1"] == dt.datetime(2023, 10, 31)
    assert r["sl"] == "2025-26"


def test_surrogate_key_matches_python_md5(spark):
    import hashlib
    r = spark.createDataFrame([(1, None, "x")], "a int, b string, c string") \
        .select(X.surrogate_key(["a", "b", "c"])).collect()[0][0]
    assert r == hashlib.md5(b"1||x").hexdigest()


def test_date_spine_end_exclusive_and_ranges(spark):
    days = [r[0] for r in reshape.date_spine(spark, "day", dt.date(2024, 1, 1), dt.date(2024, 1, 4)).collect()]
    assert days == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert reshape.date_spine(spark, "day", dt.date(2024, 1, 4), dt.date(2024, 1, 1)).count() == 0
    assert reshape.date_spine(spark, "day", dt.date(2024, 1, 4), dt.date(2024, 1, 4)).count() == 0
    months = reshape.date_spine(spark, "month", dt.date(2024, 1, 1), dt.date(2024, 4, 1)).count()
    assert months == 3
    assert [r[0] for r in reshape.dates_in_range(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1)).collect()] == \
        ["20240228", "20240229", "20240301"]
    import pytest
    with pytest.raises(ValueError):
        reshape.season_range(spark, 2026, 2020)


def test_keep_one_and_top_n_against_python(spark):
    rnd = random.Random(5)
    data = [(rnd.choice([1, 1, 1, 2, 3]), rnd.randint(0, 20), i) for i in range(2000)]  # key 1 is hot
    df = spark.createDataFrame(data, "k int, ts int, id int")
    latest = {r["k"]: (r["ts"], r["id"]) for r in reshape.keep_one_per_key(df, ["k"], ["ts", "id"]).collect()}
    for k in {d[0] for d in data}:
        assert latest[k] == max((t, i) for kk, t, i in data if kk == k)
    order = [F.col("ts").desc(), F.col("id").asc()]
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    old = spark.conf.get(key)
    try:
        for threshold in (old, "2"):                      # "2": forces the salted two-stage path
            spark.conf.set(key, threshold)
            top = reshape.top_n_per_group(df, ["k"], order, 5, salt_buckets=8).collect()
            for k in {d[0] for d in data}:
                want = sorted([(t, i) for kk, t, i in data if kk == k], key=lambda x: (-x[0], x[1]))[:5]
                assert sorted([(r["ts"], r["id"]) for r in top if r["k"] == k], key=lambda x: (-x[0], x[1])) == want
    finally:
        spark.conf.set(key, old)
    whole = reshape.top_n_per_group(df, [], order, 3, rank_col="r").collect()
    assert [(r["ts"], r["id"], r["r"]) for r in whole] == \
        [(t, i, n) for n, (_, t, i) in enumerate(sorted(data, key=lambda x: (-x[1], x[2]))[:3], 1)]


def test_date_functions_against_duckdb_on_random_timestamps(spark):
    import duckdb
    rnd = random.Random(11)
    base = dt.datetime(1999, 12, 25)
    pairs = [(base + dt.timedelta(seconds=rnd.randint(-10**8, 10**8)),
              base + dt.timedelta(seconds=rnd.randint(-10**8, 10**8))) for _ in range(600)]
    pairs += [(dt.datetime(2024, 1, 31, 23, 59), dt.datetime(2024, 2, 29, 0, 1)),
              (dt.datetime(2023, 3, 31), dt.datetime(2023, 3, 31))]
    ns = [rnd.randint(-30, 30) for _ in pairs]
    df = spark.createDataFrame([(a, b, n) for (a, b), n in zip(pairs, ns)], "a timestamp_ntz, b timestamp_ntz, n int")
    parts = ("year", "quarter", "month", "week", "day", "hour", "minute")
    got = df.select(*[X.datediff("a", "b", p).alias(p) for p in parts],
                    *[X.dateadd(p, F.col("n"), "a").alias(f"add_{p}")
                      for p in ("year", "quarter", "month", "week", "day", "hour")],
                    *[X.last_day("a", p).alias(f"ld_{p}") for p in ("month", "quarter", "year", "week")],
                    X.day_of_week("a").alias("dow")).collect()
    con = duckdb.connect()
    con.execute("create table p (a timestamp, b timestamp, n bigint)")
    con.executemany("insert into p values (?, ?, ?)", [(a, b, n) for (a, b), n in zip(pairs, ns)])
    week = ("(date_diff('day', a, b) // 7 + case when date_part('dow', a) <= date_part('dow', b) "
            "then case when a <= b then 0 else -1 end else case when a <= b then 1 else 0 end end)")
    diffs = ", ".join(week if p == "week" else f"date_diff('{p}', a, b)" for p in parts)
    adds = ", ".join([f"a + n * interval 1 {u}" for u in ("year",)] + ["a + (n * 3) * interval 1 month",
                     "a + n * interval 1 month", "a + (n * 7) * interval 1 day", "a + n * interval 1 day",
                     "a + n * interval 1 hour"])
    lds = ", ".join(f"cast(date_trunc('{u}', a) + interval {k} - interval 1 day as date)"
                    for u, k in (("month", "1 month"), ("quarter", "3 month"), ("year", "1 year"), ("week", "7 day")))
    want = con.execute(f"select {diffs}, {adds}, {lds}, date_part('dow', a) from p").fetchall()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_rounding_split_part_and_md5_against_duckdb(spark):
    import duckdb
    rnd = random.Random(12)
    vals = [rnd.uniform(-1e5, 1e5) for _ in range(3000)] + [rnd.randint(-10**5, 10**5) / 1000 + 0.0005
                                                            for _ in range(2000)] + [0.285, 1.005, -2.675, 0.125]
    texts = ["a.b.c", "", "x", "a..b", ".lead", "trail.", "no-dots-here", "1.2.3.4.5"]
    rows = [(v, texts[i % len(texts)], i if i % 7 else None) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "x double, s string, k int")
    got = df.select(*[X.round_half_away("x", d) for d in (0, 1, 2, 3)],
                    *[X.split_part("s", ".", p) for p in (1, 2, -1, -2, 5)],
                    X.surrogate_key(["k", "s"])).collect()
    con = duckdb.connect()
    con.execute("create table t (x double, s varchar, k integer)")
    con.executemany("insert into t values (?, ?, ?)", rows)
    sql = ("select round(x, 0), round(x, 1), round(x, 2), round(x, 3), "
           + ", ".join(f"string_split(s, '.')[{p}]" for p in (1, 2, -1, -2, 5))
           + ", md5(coalesce(cast(k as varchar), '') || '|' || coalesce(cast(s as varchar), '')) from t")
    want = con.execute(sql).fetchall()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_keep_one_with_map_payload(spark):
    df = spark.createDataFrame([(1, 5, {"a": 1}), (1, 7, {"b": 2}), (2, 1, None)], "k int, ts int, m map<string,int>")
    got = {r["k"]: (r["ts"], r["m"]) for r in reshape.keep_one_per_key(df, ["k"], ["ts"]).collect()}
    assert got == {1: (7, {"b": 2}), 2: (1, None)}
    first = {r["k"]: r["ts"] for r in reshape.keep_one_per_key(df, ["k"], ["ts"], latest=False).collect()}
    assert first == {1: 5, 2: 1}


def test_row_number_within_matches_window_on_a_hot_group(spark):
    from pyspark.sql import Window
    rnd = random.Random(3)
    data = [(rnd.choice(["hot"] * 6 + ["a", "b", None]), rnd.randint(0, 50), i) for i in range(6000)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = reshape.row_number_within(df, ["g"], order, "rn", partitions=12)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
    key = lambda r: (r[0] or "", r[1], r[2], r[3])
    assert sorted(map(tuple, got.select("g", "v", "id", "rn").collect()), key=key) == \
        sorted(map(tuple, want.collect()), key=key)


def test_literal_helpers_and_failure_rollup(spark):
    from tidewater.operators import quality as Q
    from tidewater.operators import writers as W
    assert X.escape_single_quotes("it's") == "it''s"
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "column_name string")
    assert spark.range(1).select(X.string_literal("x'y")).first()[0] == "x'y"
    got = sorted(tuple(r) for r in Q.aggregated_failures(df).collect())
    assert got == [("a", 2, True, True), ("b", 1, True, True)]
    import uuid

    from tidewater.session import scratch_path
    path = scratch_path(spark, f"tests/model-{uuid.uuid4().hex[:8]}")
    model = lambda ref, s: ref("src").filter("column_name = 'a'")
    assert W.python_model(spark, model, {"src": df}, path).count() == 2


def test_partition_range_text(spark):
    import pytest
    got = [r[0] for r in reshape.partition_range(spark, "20240228,20240301").collect()]
    assert got == ["20240228", "20240229", "20240301"]
    assert [r[0] for r in reshape.partition_range(spark, " 20240105 ").collect()] == ["20240105"]
    assert [r[0] for r in reshape.dates_in_range(spark, "2024-01-01", "2024-01-02", fmt="yyyy-MM-dd",
                                                  in_fmt="%Y-%m-%d").collect()] == ["2024-01-01", "2024-01-02"]
    for bad in ("20240105,20240101", "2024-01-05", "1,2,3"):
        with pytest.raises(ValueError):
            reshape.partition_range(spark, bad)
