"""SCD2 snapshots: properties and multi-step histories."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators.snapshot import SnapshotConfig, snapshot

T = [dt.datetime(2024, 1, d) for d in range(1, 6)]
SCHEMA = "id bigint, v string"


def _src(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def _no_overlap(hist, keys=("id",)):
    by = {}
    for r in hist.collect():
        by.setdefault(tuple(r[k] for k in keys), []).append((r["dbt_valid_from"], r["dbt_valid_to"]))
    for spans in by.values():
        spans.sort()
        opened = [s for s in spans if s[1] is None]
        assert len(opened) <= 1
        for (a0, a1), (b0, _) in zip(spans, spans[1:]):
            assert a1 is not None and a1 <= b0


def test_unchanged_source_adds_nothing(spark):
    cfg = SnapshotConfig("id", "check", check_cols="all", hard_deletes="invalidate")
    s = _src(spark, [(1, "a"), (2, None)])
    h1 = snapshot(None, s, cfg, T[0])
    h2 = snapshot(h1, s, cfg, T[1])
    assert sorted(map(tuple, h1.collect())) == sorted(map(tuple, h2.collect()))


def test_new_record_delete_and_reappear(spark):
    cfg = SnapshotConfig("id", "check", check_cols=["v"], hard_deletes="new_record")
    h = snapshot(None, _src(spark, [(1, "a"), (2, "b")]), cfg, T[0])
    h = snapshot(h, _src(spark, [(1, "a")]), cfg, T[1])            # 2 deleted
    h = snapshot(h, _src(spark, [(1, "a")]), cfg, T[2])            # still deleted: nothing new
    h = snapshot(h, _src(spark, [(1, "a"), (2, "b2")]), cfg, T[3])  # 2 re-appears
    rows2 = sorted([(r["dbt_valid_from"], r["dbt_valid_to"], r["v"], r["dbt_is_deleted"])
                    for r in h.filter(F.col("id") == 2).collect()])
    assert rows2 == [(T[0], T[1], "b", "False"), (T[1], T[3], "b", "True"), (T[3], None, "b2", "False")]
    assert h.filter(F.col("id") == 1).count() == 1
    _no_overlap(h)


def test_null_to_value_and_back_is_a_change(spark):
    cfg = SnapshotConfig("id", "check", check_cols=["v"])
    h = snapshot(None, _src(spark, [(1, None)]), cfg, T[0])
    h = snapshot(h, _src(spark, [(1, "x")]), cfg, T[1])
    h = snapshot(h, _src(spark, [(1, None)]), cfg, T[2])
    assert h.count() == 3
    _no_overlap(h)


def test_composite_key_and_new_column(spark):
    cfg = SnapshotConfig(["a", "b"], "check", check_cols="all")
    h = snapshot(None, _src(spark, [(1, 1, "x"), (1, 2, "y")], "a bigint, b bigint, v string"), cfg, T[0])
    s2 = _src(spark, [(1, 1, "x", 5), (1, 2, "y", 6)], "a bigint, b bigint, v string, extra bigint")
    h2 = snapshot(h, s2, cfg, T[1])
    assert "extra" in h2.columns
    # a new source column marks every row changed (check_cols='all')
    assert h2.filter(F.col("dbt_valid_to").isNull()).count() == 2 and h2.count() == 4
    _no_overlap(h2, keys=("a", "b"))


def test_timestamp_strategy_only_newer_rows_change(spark):
    cfg = SnapshotConfig("id", "timestamp", updated_at="u")
    sch = "id bigint, v string, u timestamp_ntz"
    h = snapshot(None, _src(spark, [(1, "a", T[0]), (2, "b", T[0])], sch), cfg, T[0])
    h = snapshot(h, _src(spark, [(1, "a2", T[2]), (2, "b-late-edit", T[0])], sch), cfg, T[3])
    got = sorted((r["id"], r["v"], r["dbt_valid_from"], r["dbt_valid_to"]) for r in h.collect())
    assert got == [(1, "a", T[0], T[2]), (1, "a2", T[2], None), (2, "b", T[0], None)]


def test_valid_to_current_marker(spark):
    cfg = SnapshotConfig("id", "check", check_cols=["v"], valid_to_current="timestamp'9999-12-31 00:00:00'")
    h = snapshot(None, _src(spark, [(1, "a")]), cfg, T[0])
    h = snapshot(h, _src(spark, [(1, "b")]), cfg, T[1])
    got = sorted((r["v"], r["dbt_valid_to"]) for r in h.collect())
    assert got == [("a", T[1]), ("b", dt.datetime(9999, 12, 31))]


def test_renamed_meta_columns(spark):
    names = {"dbt_valid_from": "valid_from", "dbt_valid_to": "valid_to", "dbt_scd_id": "scd_id",
             "dbt_updated_at": "updated_at"}
    cfg = SnapshotConfig("id", "check", check_cols=["v"], hard_deletes="invalidate", column_names=names)
    h = snapshot(None, _src(spark, [(1, "a"), (2, "b")]), cfg, T[0])
    assert h.columns == ["id", "v", "scd_id", "updated_at", "valid_from", "valid_to"]
    h = snapshot(h, _src(spark, [(1, "a2")]), cfg, T[1])
    got = sorted((r["id"], r["v"], r["valid_from"], r["valid_to"]) for r in h.collect())
    assert got == [(1, "a", T[0], T[1]), (1, "a2", T[1], None), (2, "b", T[0], T[1])]


def test_listed_new_column_marks_all_and_own_time(spark):
    cfg = SnapshotConfig("id", "check", check_cols=["v", "extra"], updated_at="u")
    h = snapshot(None, _src(spark, [(1, "a", T[0])], "id bigint, v string, u timestamp_ntz"), cfg, T[1])
    assert [r["dbt_valid_from"] for r in h.collect()] == [T[0]]
    h = snapshot(h, _src(spark, [(1, "a", T[2], None)], "id bigint, v string, u timestamp_ntz, extra string"), cfg, T[3])
    got = sorted((r["dbt_valid_from"], r["dbt_valid_to"]) for r in h.collect())
    assert got == [(T[0], T[2]), (T[2], None)]


def test_apply_snapshot_never_rewrites_closed_versions(spark):
    import glob
    import os
    import uuid

    from tidewater.operators.snapshot import apply_snapshot, read_snapshot
    from tidewater.session import scratch_path
    cfg = SnapshotConfig("id", "check", check_cols="all", hard_deletes="new_record")
    path = scratch_path(spark, f"tests/snap-{uuid.uuid4().hex[:8]}")
    runs = [[(1, "a"), (2, "b")], [(1, "a2"), (2, "b")], [(1, "a2")], [(1, "a3"), (2, "c")]]
    pure, seen = None, {}
    for now, data in zip(T, runs):
        apply_snapshot(spark, path, _src(spark, data), cfg, now)
        pure = snapshot(pure, _src(spark, data), cfg, now)
        files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/closed/run=*/part-*")}
        assert all(files.get(f) == m for f, m in seen.items())
        seen = files
    assert seen
    order = lambda d: sorted(map(str, d.select(*pure.columns).collect()))
    assert order(read_snapshot(spark, path)) == order(pure)
