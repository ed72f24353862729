"""Randomised checks of merge and snapshot against plain-Python models."""

import datetime as dt
import random

import pytest

from tidewater.operators import incremental as I
from tidewater.operators.incremental import Clause
from tidewater.operators.snapshot import SnapshotConfig, snapshot

SCHEMA = "id bigint, g string, n bigint"

# (Spark clause, Python predicate over (t, s), Python action result)
CLAUSES = [
    (Clause("matched", "delete", "s.g = 'x'"), lambda t, s: s["g"] == "x", "delete"),
    (Clause("matched", "update", "s.n > t.n", mode="explicit", include=("n",)),
     lambda t, s: s["n"] is not None and t["n"] is not None and s["n"] > t["n"], "update_n"),
    (Clause("matched", "update", "t.g = 'y'"), lambda t, s: t["g"] == "y", "update_all"),
    (Clause("not_matched", "insert", "s.n is null or s.n % 3 <> 0"),
     lambda t, s: s["n"] is None or s["n"] % 3 != 0, "insert"),
    (Clause("not_matched_by_source", "delete", "t.n < 5"), lambda t, s: t["n"] is not None and t["n"] < 5, "delete"),
    (Clause("not_matched_by_source", "update", "t.g = 'z'", set={"n": "t.n + 100"}),
     lambda t, s: t["g"] == "z", "plus100"),
]


def py_merge(target, source):
    out = []
    by_id = {s["id"]: s for s in source if s["id"] is not None}
    target_ids = {t["id"] for t in target if t["id"] is not None}
    for t in target:
        s = by_id.get(t["id"]) if t["id"] is not None else None
        kind = "matched" if s is not None else "not_matched_by_source"
        act = next((a for c, p, a in CLAUSES if c.kind == kind and p(t, s)), None)
        if act is None:
            out.append(dict(t))
        elif act == "update_n":
            out.append(dict(t, n=s["n"]))
        elif act == "update_all":
            out.append(dict(s))
        elif act == "plus100":
            out.append(dict(t, n=None if t["n"] is None else t["n"] + 100))
    for s in source:
        if s["id"] is None or s["id"] not in target_ids:
            if next((a for c, p, a in CLAUSES if c.kind == "not_matched" and p(None, s)), None) == "insert":
                out.append(dict(s))
    return sorted((r["id"] if r["id"] is not None else -1, r["g"] or "", r["n"] if r["n"] is not None else -1)
                  for r in out)


def _rows(rnd, ids, nulls=True):
    return [{"id": i, "g": rnd.choice(["x", "y", "z", "w", None] if nulls else ["x", "y", "z", "w"]),
             "n": rnd.choice([None, *range(12)]) if nulls else rnd.randrange(12)} for i in ids]


@pytest.mark.parametrize("seed", range(4))
def test_merge_matches_python_model(spark, seed):
    rnd = random.Random(seed)
    target = _rows(rnd, rnd.sample(range(60), 40))
    source = _rows(rnd, rnd.sample(range(30, 90), 30)) + _rows(rnd, [None])
    tdf = spark.createDataFrame([(r["id"], r["g"], r["n"]) for r in target], SCHEMA)
    sdf = spark.createDataFrame([(r["id"], r["g"], r["n"]) for r in source], SCHEMA)
    got = sorted((r[0] if r[0] is not None else -1, r[1] or "", r[2] if r[2] is not None else -1)
                 for r in I.merge(tdf, sdf, "id", clauses=[c for c, _, _ in CLAUSES]).collect())
    assert got == py_merge(target, source)


def py_snapshot(history, source, now, check, deletes):
    """One check-strategy snapshot run over dict rows (valid_to None = open)."""
    out = [dict(h) for h in history]
    open_by_id = {h["id"]: h for h in out if h["valid_to"] is None}
    src_ids = set()
    for s in source:
        src_ids.add(s["id"])
        h = open_by_id.get(s["id"])
        if h is None or any(h[c] != s[c] for c in check):
            if h is not None:
                h["valid_to"] = now
            out.append(dict(s, valid_from=now, valid_to=None))
    if deletes == "invalidate":
        for i, h in open_by_id.items():
            if i not in src_ids:
                h["valid_to"] = now
    return out


@pytest.mark.parametrize("seed", range(3))
def test_snapshot_matches_python_model(spark, seed):
    rnd = random.Random(100 + seed)
    cfg = SnapshotConfig("id", "check", check_cols=["g", "n"], hard_deletes="invalidate")
    times = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    model, hist = [], None
    for now in times:
        src = _rows(rnd, rnd.sample(range(25), 15))
        sdf = spark.createDataFrame([(r["id"], r["g"], r["n"]) for r in src], SCHEMA)
        hist = snapshot(hist, sdf, cfg, now)
        model = py_snapshot(model, src, now, ["g", "n"], "invalidate")
    key = lambda r: (r["id"], r["valid_from"], str(r["valid_to"]), r["g"] or "", -1 if r["n"] is None else r["n"])
    got = sorted((r["id"], r["dbt_valid_from"], str(r["dbt_valid_to"]), r["g"] or "",
                  -1 if r["n"] is None else r["n"]) for r in hist.collect())
    assert got == sorted(key(r) for r in model)


@pytest.mark.parametrize("seed", range(3))
def test_pruned_merge_matches_python_model(spark, seed):
    """Without by-source clauses the merge splits the target by the source's
    key range; the result must not change."""
    global CLAUSES
    saved = CLAUSES
    CLAUSES = [c for c in saved if c[0].kind != "not_matched_by_source"]
    try:
        rnd = random.Random(50 + seed)
        target = _rows(rnd, rnd.sample(range(200), 120)) + _rows(rnd, [None])
        source = _rows(rnd, rnd.sample(range(80, 120), 25))
        tdf = spark.createDataFrame([(r["id"], r["g"], r["n"]) for r in target], SCHEMA)
        sdf = spark.createDataFrame([(r["id"], r["g"], r["n"]) for r in source], SCHEMA)
        merged = I.merge(tdf, sdf, "id", clauses=[c for c, _, _ in CLAUSES], prune_by_key_range=True)
        got = sorted((r[0] if r[0] is not None else -1, r[1] or "", r[2] if r[2] is not None else -1)
                     for r in merged.collect())
        assert got == py_merge(target, source)
        di = sorted(tuple(x if x is not None else -1 for x in r) for r in I.delete_insert(tdf, sdf, "id", prune_by_key_range=True).collect())
        keep = [r for r in target if r["id"] not in {s["id"] for s in source}] + source
        assert di == sorted((r["id"] if r["id"] is not None else -1, r["g"] if r["g"] is not None else -1,
                             r["n"] if r["n"] is not None else -1) for r in keep)
    finally:
        CLAUSES = saved


@pytest.mark.parametrize("seed", range(3))
def test_snapshot_ignore_mode_with_partial_sources(spark, seed):
    """Sources cover shifting key ranges; versions outside a run's range bypass the join."""
    rnd = random.Random(200 + seed)
    cfg = SnapshotConfig("id", "check", check_cols=["g", "n"], hard_deletes="ignore")
    times = [dt.datetime(2024, 2, d) for d in (1, 2, 3, 4)]
    model, hist = [], None
    for i, now in enumerate(times):
        lo = rnd.randrange(0, 20)
        src = _rows(rnd, rnd.sample(range(lo, lo + 15), 10))
        sdf = spark.createDataFrame([(r["id"], r["g"], r["n"]) for r in src], SCHEMA)
        hist = snapshot(hist, sdf, cfg, now)
        model = py_snapshot(model, src, now, ["g", "n"], "ignore")
    key = lambda r: (r["id"], r["valid_from"], str(r["valid_to"]), r["g"] or "", -1 if r["n"] is None else r["n"])
    got = sorted((r["id"], r["dbt_valid_from"], str(r["dbt_valid_to"]), r["g"] or "",
                  -1 if r["n"] is None else r["n"]) for r in hist.collect())
    assert got == sorted(key(r) for r in model)


@pytest.mark.parametrize("seed", range(3))
def test_merge_with_null_keys_on_both_sides(spark, seed):
    """Rows with a null key never match; source ones are inserted, target ones are by-source rows."""
    rnd = random.Random(300 + seed)
    target = _rows(rnd, rnd.sample(range(80), 50)) + _rows(rnd, [None])
    source = _rows(rnd, rnd.sample(range(40, 120), 30)) + _rows(rnd, [None])
    tdf = spark.createDataFrame([(r["id"], r["g"], r["n"]) for r in target], SCHEMA)
    sdf = spark.createDataFrame([(r["id"], r["g"], r["n"]) for r in source], SCHEMA)
    merged = I.merge(tdf, sdf, "id", clauses=[c for c, _, _ in CLAUSES])
    got = sorted((r[0] if r[0] is not None else -1, r[1] or "", r[2] if r[2] is not None else -1)
                 for r in merged.collect())
    assert got == py_merge(target, source)
