"""Commits: a run stopped after any step leaves all old or all new rows to the next reader and writer."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.operators import commits as C
from tidewater.operators import incremental as I
from tidewater.operators import writers as W
from tidewater.operators.snapshot import SnapshotConfig, apply_snapshot, read_snapshot, snapshot
from tidewater.session import scratch_path
from tidewater.streaming.upsert_stream import stream_upsert

SCHEMA = "id bigint, v string, p string"


class Stop(BaseException):
    """The process ends here: nothing below catches it."""


def table(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def fresh(spark, name):
    return scratch_path(spark, f"tests/{name}-{uuid.uuid4().hex[:8]}")


def stopping(monkeypatch, after):
    """Every change of names and every small file counts as a step; the one after ``after`` stops the process."""
    steps = {"n": 0}

    def counted(fn):
        def call(*a, **k):
            if steps["n"] == after:
                raise Stop
            steps["n"] += 1
            return fn(*a, **k)
        return call

    for name in ("rename", "delete", "write_text"):
        monkeypatch.setattr(C, name, counted(getattr(C, name)))
    return steps


def every_stop(monkeypatch, prepare, run, check):
    """Stop ``run`` after each of its steps in turn; ``check(path, done)`` looks at what is left."""
    after = 0
    while True:
        path = prepare()
        with monkeypatch.context() as patch:
            steps = stopping(patch, after)
            try:
                run(path)
                done = True
            except Stop:
                done = False
        check(path, done)
        if done:
            assert steps["n"] == after
            return after
        after += 1


OLD = [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]


def test_replace_table_at_every_step(spark, monkeypatch):
    def prepare():
        path = fresh(spark, "swap")
        W.replace_table(table(spark, OLD), path)
        return path

    seen = set()

    def check(path, done):
        got = rows(W.read_table(spark, path))
        assert got in (OLD, [(9, "n", "x")]) and (not done or got != OLD)
        seen.add(len(got))
        W.apply_incremental(spark, path, table(spark, [(3, "C", "z")]), "delete+insert", "id")    # no first run
        assert rows(W.read_table(spark, path)) == sorted([r for r in got if r[0] != 3] + [(3, "C", "z")])

    steps = every_stop(monkeypatch, prepare, lambda p: W.replace_table(table(spark, [(9, "n", "x")]), p), check)
    assert steps >= 6 and seen == {1, 3}


@pytest.mark.parametrize("strategy,opts", [
    ("merge", {"unique_key": "id"}), ("insert_overwrite", {}),
    ("microbatch", {"event_time": "id", "start": 1, "end": 3}), ("append", {})])
def test_many_partitions_are_one_commit(spark, monkeypatch, strategy, opts):
    source = [(1, "A", "x"), (2, "B", "w")]
    opts = dict(opts)
    key = opts.pop("unique_key", None)

    def prepare():
        path = fresh(spark, "parts")
        W.replace_table(table(spark, OLD), path, partition_by=["p"])
        return path

    pure = {**opts, "partition_by": ["p"]} if strategy == "insert_overwrite" else opts
    new = rows(I.incremental(table(spark, OLD), table(spark, source), strategy, key, **pure))

    def check(path, done):
        got = rows(W.read_table(spark, path))
        assert got == new if done else got in (OLD, new)
        if strategy != "append":                       # a load that was broken off is simply run again
            W.apply_incremental(spark, path, table(spark, source), strategy, key, partition_by=["p"], **opts)
            assert rows(W.read_table(spark, path)) == new

    every_stop(monkeypatch, prepare, lambda p: W.apply_incremental(
        spark, p, table(spark, source), strategy, key, partition_by=["p"], **opts), check)


def test_recovery_can_be_stopped_itself(spark, monkeypatch):
    path = fresh(spark, "twice")
    W.replace_table(table(spark, OLD), path, partition_by=["p"])
    with monkeypatch.context() as patch:
        stopping(patch, 3)                              # draft and journal are written, one file has left
        with pytest.raises(Stop):
            W.overwrite_partitions(table(spark, [(1, "A", "x"), (2, "B", "y")]), path, ["p"])
    for after in (0, 1, 2):
        with monkeypatch.context() as patch:
            stopping(patch, after)
            with pytest.raises(Stop):
                W.read_table(spark, path)
    assert rows(W.read_table(spark, path)) == [(1, "A", "x"), (2, "B", "y"), (3, "c", "z")]
    assert not C.exists(spark, f"{path}.__commit")


def test_snapshot_commits_both_tables(spark, monkeypatch):
    import datetime as dt
    cfg = SnapshotConfig("id", "check", check_cols="all", hard_deletes="invalidate")
    times = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    data = [table(spark, d, "id bigint, run string") for d in ([(1, "a"), (2, "b")], [(1, "A"), (2, "b")], [(2, "B")])]
    pure = [snapshot(None, data[0], cfg, times[0])]
    for d, t in zip(data[1:], times[1:]):
        pure.append(snapshot(pure[-1], d, cfg, t))
    text = lambda df: sorted(map(str, df.select(*pure[0].columns).collect()))
    want = [text(p) for p in pure]

    def prepare():
        path = fresh(spark, "snap")
        for d, t in zip(data[:2], times[:2]):
            apply_snapshot(spark, path, d, cfg, t)
        return path

    def check(path, done):
        got = text(read_snapshot(spark, path))
        assert got == want[2] if done else got in want[1:]
        apply_snapshot(spark, path, data[2], cfg, times[2])
        assert text(read_snapshot(spark, path)) == want[2]

    every_stop(monkeypatch, prepare, lambda p: apply_snapshot(spark, p, data[2], cfg, times[2]), check)


def test_a_batch_is_applied_once(spark, monkeypatch):
    path = fresh(spark, "once")
    W.replace_table(table(spark, OLD), path)
    batches = [table(spark, [(10 + i, "s", "x")]) for i in range(3)]
    for i in (0, 0, 1, 0, 2, 2):
        W.apply_incremental(spark, path, batches[i], "append", batch=("s", i))
    W.apply_incremental(spark, path, batches[0], "append", batch=("other", 0))
    assert [r[0] for r in rows(W.read_table(spark, path))] == [1, 2, 3, 10, 10, 11, 12]
    W.replace_table(W.read_table(spark, path).where("id < 12"), path)      # the record outlives a rewrite
    assert W.apply_incremental(spark, path, batches[2], "append", batch=("s", 2)).skipped
    assert C.applied(spark, path) == {"s": 2, "other": 0}


def test_a_stream_stopped_between_two_commits(spark, monkeypatch):
    """The table has the batch, the stream's checkpoint does not know it: Spark hands it over again."""
    base = fresh(spark, "stream")
    for i in range(3):
        table(spark, [(i, "s", "x")]).coalesce(1).write.mode("append").parquet(f"{base}/in")
    from tidewater.streaming import upsert_stream as U
    real = U.apply_incremental
    fails = iter([False, True, False, False])

    def then_stop(*a, **k):
        real(*a, **k)
        if next(fails):
            raise RuntimeError("stopped after the table's commit")

    monkeypatch.setattr(U, "apply_incremental", then_stop)
    run = lambda: stream_upsert(spark, f"{base}/in", table(spark, []).schema, f"{base}/t", f"{base}/ck", None, "append")
    with pytest.raises(Exception, match="stopped after"):
        run()
    run()
    assert [r[0] for r in rows(W.read_table(spark, f"{base}/t"))] == [0, 1, 2]
    [(name, last)] = C.applied(spark, f"{base}/t").items()
    assert last == 2 and len(name) == 36


def test_second_writer_is_refused_and_lost_tables_are_named(spark):
    path = fresh(spark, "two")
    W.replace_table(table(spark, OLD), path)
    late = C.Commit(spark, path)
    table(spark, [(5, "l", "x")]).write.parquet(late.staging)
    C.write_text(spark, f"{path}.__commit", json.dumps({"moves": [], "drop": []}))
    late.remove()
    late.put()
    with pytest.raises(RuntimeError, match="being committed"):
        late.run()
    assert rows(W.read_table(spark, path)) == OLD and not C.exists(spark, f"{path}.__commit")
    C.rename(spark, path, f"{path}.__old_abc")             # as an older writer left it when it was stopped
    for call in (lambda: W.read_table(spark, path), lambda: W.apply_incremental(spark, path, table(spark, OLD), "merge", "id")):
        with pytest.raises(C.LostTable):
            call()
    C.rename(spark, f"{path}.__old_abc", path)
    C.write_text(spark, f"{path}.__staging_x/part", "x")
    assert len(C.vacuum(spark, path)) >= 1 and rows(W.read_table(spark, path)) == OLD


def test_only_files_with_the_keys_are_replaced(spark):
    path = fresh(spark, "files")
    data = spark.range(2000).select("id", F.concat(F.lit("v"), "id").alias("v"), F.lit("x").alias("p"))
    W.replace_table(data.repartition(20, "id"), path, keys=["id"])
    before = set(C.data_files(spark, path))
    source = table(spark, [(7, "new", "x"), (5000, "ins", "y")])
    done = W.apply_incremental(spark, path, source, "merge", "id")
    after = set(C.data_files(spark, path))
    assert done.removed == 1 and len(before & after) == 19
    got = W.read_table(spark, path)
    assert got.count() == 2001 and rows(got.where("id in (7, 5000)")) == [(7, "new", "x"), (5000, "ins", "y")]
    # more keys than are looked up one by one: joined
    many = data.where("id < 100").withColumn("v", F.lit("m"))
    W.apply_incremental(spark, path, many, "delete+insert", "id")
    assert W.read_table(spark, path).where("v = 'm'").count() == 100 and W.read_table(spark, path).count() == 2001
    # composite keys, one of them null
    done = W.apply_incremental(spark, path, table(spark, [(None, "n", "x"), (9, "q", "x")]), "merge", ["id", "p"])
    assert W.read_table(spark, path).count() == 2002 and rows(W.read_table(spark, path).where("id = 9")) == [(9, "q", "x")]


def test_direct_calls_widen_too(spark):
    target = spark.createDataFrame([(1, 1, "x")], "id bigint, n int, p string")
    source = spark.createDataFrame([(2, 1.75, "y")], "id bigint, n double, p string")
    for got in (I.append(target, source), I.delete_insert(target, source, "id"), I.insert_overwrite(target, source, ["p"]),
                I.partition_upsert(target, source, ["p"]), I.microbatch(target, source, "id", 2, 3),
                I.microbatches(target, source, "id", [(2, 3)])):
        assert rows(got) == [(1, 1.0, "x"), (2, 1.75, "y")]
    path = fresh(spark, "wide")
    W.upsert_partitions(spark, target, path, ["p"])
    W.upsert_partitions(spark, source, path, ["p"])
    W.upsert_partitions(spark, target.withColumn("n", F.lit(3)), path, ["p"])
    assert rows(W.read_table(spark, path)) == [(1, 3.0, "x"), (2, 1.75, "y")]
