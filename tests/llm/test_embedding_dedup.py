"""Embedding near-duplicates: brute force, recall, estimates and bounds, odd vectors."""

import math

import numpy as np
import pytest

from tidewater.llm import embedding_dedup as e


def vectors(n=500, dim=64, seed=4):
    rng = np.random.default_rng(seed)
    out, i = [], 0
    while len(out) < n:
        base = rng.standard_normal(dim)
        base /= np.linalg.norm(base)
        label = int(rng.integers(0, 3))
        for _ in range(int(rng.choice([1, 1, 1, 2, 5, 40], p=[.3, .2, .2, .15, .13, .02]))):
            noise = rng.standard_normal(dim)
            noise -= base * (noise @ base)
            noise /= np.linalg.norm(noise)
            angle = math.acos(rng.choice([0.999, 0.985, 0.972, 0.96]))
            v = (base * math.cos(angle) + noise * math.sin(angle)) * rng.uniform(0.5, 3)
            out.append((i, [float(np.float32(a)) for a in v], label))
            i += 1
    return out


def brute(rows):
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(a is not None and math.isfinite(a) for a in r[1])
          and any(r[1])]
    links, up = {}, {r[0]: r[0] for r in ok}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    unit = [np.array(r[1]) / np.linalg.norm(r[1]) for r in ok]
    for a in range(len(ok)):
        for b in range(a):
            if ok[a][2] == ok[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= e.THRESHOLD:
                for x in (ok[a][0], ok[b][0]):
                    links[x] = links.get(x, 0) + 1
                x, y = sorted((root(ok[a][0]), root(ok[b][0])))
                up[y] = x
    return {r[0]: (links.get(r[0], 0), root(r[0]) if r[0] in up else r[0]) for r in rows}


@pytest.mark.parametrize("block", [1024, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(e, "BLOCK", block)
    rows = vectors() + [(9001, None, 1), (9002, [], 1), (9003, [0.0] * 64, 1), (9004, [float("nan")] * 64, 1), (9005, [1.0, 2.0], 1),
                        (9006, [1.0, 2.0], 1), (9007, [2.0, 4.0], 1), (9008, [1.0, 2.0], None), (9009, [1.0, None], 1),
                        (9010, [float("inf"), 1.0], 1), (9011, [1.0, 2.0], 2)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<float>, label int, home string, weight int").repartition(3)
    got = {r.vec_id: r for r in e.near_duplicates(df).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    found, there = sum(r.n_links for r in got.values()), sum(n for n, _ in want.values())
    assert there > 200 and found >= 0.98 * there
    assert all(r.n_links <= want[i][0] for i, r in got.items())           # none below the threshold
    assert np.mean([r.component_id == want[i][1] for i, r in got.items()]) > 0.99
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in e.near_duplicates(df).collect())
    assert got == [(0, 0, None, False), (1, 1, 1, True), (1, 1, 1, True)]
    assert e.near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centre = x.mean(axis=0)
    o, bits, r, f = e.encode(x, centre, e.rotation(64))
    cos, width = e.estimate(o[:50], r[:50], bits, r, f, x[:50] @ centre, x @ centre, centre @ centre)
    error = cos - x[:50] @ x.T
    assert abs(error.mean()) < 0.003 and (np.abs(error) <= width).mean() > 0.999


def test_double_vectors_and_labels_as_they_are(spark):
    """Doubles are not rounded to floats; labels that are text or fractions keep their groups."""
    tiny = [1.0, 1e-9, 0.0, 0.0]
    rows = [(1, [1.0, 0.0, 0.0, 0.0], "a"), (2, tiny, "a"), (3, tiny, "a"), (4, tiny, "b"), (5, tiny, None)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near(spark, rows, "string", 1.0 - 1e-15)}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5)}
    halves = [(1, tiny, 0.25), (2, tiny, 0.75), (3, tiny, 0.75)]
    assert {r.vec_id: r.component_id for r in near(spark, halves, "double", 0.93)} == {1: 1, 2: 2, 3: 2}
    a, b = [1e-60, 0.0], [0.0, 1e-60]                    # zero as floats
    assert {r.vec_id: r.component_id for r in near(spark, [(1, a, "x"), (2, a, "x"), (3, b, "x")], "string", 0.93)} == {1: 1, 2: 1, 3: 3}


def near(spark, rows, label, threshold):
    return e.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {label}"), threshold).collect()


def test_huge_and_tiny_vectors_link_like_ordinary_ones(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(8)
    rows = [(i, [float(v) for v in base * s * (1 + 0.01 * i)], 1) for i, s in enumerate((1.0, 1.0, 1e200, -1e200, 1e-200, 3e-200))]
    rows += [(10, [1e308] * 8, 2), (11, [1e-310] * 8, 2), (12, [5e-324] + [0.0] * 7, 3)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in e.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert {got[i] for i in (0, 1, 2, 4, 5)} == {(4, 0)} and got[3] == (0, 3)
    assert got[10] == got[11] == (1, 10) and got[12] == (0, 12)
