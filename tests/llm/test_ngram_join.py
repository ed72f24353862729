"""N-gram join against brute force, with copies, near copies, shared passages and odd rows."""

import random
import re

import numpy as np
import pytest

from tidewater.llm import ngram_join as j

TR = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TR))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    ids = sorted({i for i, _ in rows if i is not None})
    sets = {i: shingles(t) for i, t in rows if i is not None}
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = sorted((root(a), root(b)))
                    up[y] = x
    return [(i, len(shingles(t)), root(i) if i is not None else None) for i, t in rows]


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage = text(60)
    rows, i = [], 10
    for n in (3, 4, 5, 6, 9, 30, 80, 200):
        base = text(n)
        for k in range(6):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, max(1, n // 25), max(1, n // 20)])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((i, " ".join(w).upper() if k == 0 else " ".join(w)))
            i += 1
        rows += [(i, "\n".join(base)), (i + 1, " ".join(base))]
        i += 2
    for k in range(25):                       # a passage that many documents share, with other text around it
        rows.append((i, " ".join(text(rng.choice([5, 10, 15, 20, 25, 200])) + passage)))
        i += 1
    group = text(120)
    for k in range(30):                       # a large group of near copies
        w = list(group)
        for _ in range(rng.choice([1, 2, 4, 6])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
        i += 1
    return rows + [(1, None), (2, ""), (3, " \t\n "), (None, "a b c d e f g"), (4, "ÀÉ word"), (5, "àé word")]


@pytest.mark.parametrize("block, hot", [(384, 7), (7, 3)])
def test_matches_brute_force(spark, monkeypatch, block, hot):
    monkeypatch.setattr(j, "BLOCK", block)
    monkeypatch.setattr(j, "HOT", hot)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, gram string").repartition(3)
    got = [tuple(r) for r in j.similarity_classes(docs).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (9, "a b c d e f")], "doc_id long, text string")
    assert sorted(tuple(r) for r in j.similarity_classes(docs).collect()) == [(7, 2, 7), (7, 2, 7), (9, 2, 7)]
    assert j.similarity_classes(docs.limit(0)).count() == 0


def test_block_links_accumulates_over_column_blocks(monkeypatch):
    monkeypatch.setattr(j, "COLUMNS", 5)
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1000, 60))
    sets = [np.unique(np.r_[base[rng.random(len(base)) < p], rng.integers(1000, 2000, 3)]) for p in (1, .97, .9, .8, .5, 1, .95)]
    want = set()
    for a in range(len(sets)):
        for b in range(a):
            n = len(np.intersect1d(sets[a], sets[b]))
            if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                want.add((b, a))
    up = list(range(len(sets)))
    for a, b in sorted(want):
        up = [up[a] if u == up[b] else u for u in up]
    forest = j.block_links(np.arange(len(sets)), sets)
    got = list(range(len(sets)))
    for a, b in forest:
        got = [got[a] if u == got[b] else u for u in got]
    same = lambda p: [[p[x] == p[y] for y in range(len(p))] for x in range(len(p))]
    assert same(got) == same(up) and len(forest) < len(sets)


def test_scan_counts_a_chunk_in_little_memory(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    monkeypatch.setattr(j, "CHUNK", 1 << 19)
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(-(1 << 63), j._BOUND, 1 << 13)) for _ in range(62)]
    sets += [sets[0], sets[0][:5]]                           # columns met two and three times, all others once
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sets)), pa.int64()), pa.array([[0]] * len(sets), pa.list_(pa.int64()))], names=["id", "h"])
    monkeypatch.setattr(j, "_sets", lambda batch: enumerate(sets))
    list(j._scan([batch]))
    tracemalloc.start()
    try:
        out = list(j._scan([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    got = {}
    for b in out[1:]:
        got |= dict(zip(b.column("slots")[0].as_py(), b.column("counts")[0].as_py()))
    want = {}
    for v in sets[0]:
        want[int(v) & (j.SLOTS - 1)] = want.get(int(v) & (j.SLOTS - 1), 0) + 2 + int(v in sets[0][:5])
    assert got == want
    assert peak < 8 * j.SLOTS + 24 * j.CHUNK                 # the table, and less than three arrays of a chunk


def short_texts_with_common_lines(seed=5):
    """Short texts, two thirds of each its own and the rest one of a few lines, that overlap by chains; two near copies."""
    rng = random.Random(seed)
    lines = [[f"l{k}x{m}" for m in range(12)] for k in range(6)]
    rows = []
    for i in range(120):
        own = [f"d{i}x{m}" for m in range(22)]
        rows.append((i, " ".join(own[:11] + rng.choice(lines) + own[11:] + (rng.choice(lines) if i % 4 == 0 else []))))
    return rows + [(500, rows[7][1] + " tail"), (501, rows[30][1] + " end")]


def written(monkeypatch, counts):
    """From now on ``counts`` gets the rows of each table that the join writes."""
    keep = j.materialize

    def count(df, name):
        out = keep(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(j, "materialize", count)


def test_common_lines_do_not_run_short_texts_together(spark, monkeypatch):
    counts = {}
    written(monkeypatch, counts)
    rows = short_texts_with_common_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in j.similarity_classes(docs).collect())
    assert got == sorted(brute(rows))
    assert sum(i != c for i, _, c in got) == 2
    assert counts["ngram-cells"] == 4                        # the two pairs of near copies, nothing else is multiplied


def test_fuller_counters_do_not_make_columns_hot():
    assert j.hot_bits(0) == j.hot_bits(3 * j.SLOTS) == j.HOT
    for mean in (37, 500, 10_000):
        assert j.hot_bits(mean * j.SLOTS) > np.log2(4 * mean + 1)


def test_whole_sets_are_handed_on_in_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(j, "PIECE", 10)
    rng = np.random.default_rng(2)
    words = [rng.integers(0, 1 << 31, n).astype(np.int32) for n in (3, 0, 40, 9, 7)]
    batch = pa.RecordBatch.from_arrays([pa.array([4, 5, 6, 7, 8], pa.int64()), pa.array(words, pa.list_(pa.int32()))], names=["id", "h"])
    out = list(j._whole([batch]))
    assert len(out) > 1
    got = [r for b in out for r in zip(b["gram"].to_pylist(), b["id"].to_pylist(), b["slack"].to_pylist())]
    assert got == [(int(g), i, j.prefix_length(len(s)) - len(s)) for i, s in zip((4, 5, 6, 7, 8), map(j.gram_set, words)) for g in s]
