"""Sharding: differencing, law, slots, groups, edges."""

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd

from tidewater.llm import sharding as s


def test_difference_keeps_sums_and_beats_greedy():
    rng = np.random.default_rng(0)
    for n, k in ((1, 3), (7, 3), (200, 5), (3000, 40)):
        sizes = (rng.lognormal(7, 1, n)).astype(np.int64) + 16
        vectors = np.zeros((n, k), np.int64)
        vectors[:, 0] = sizes
        sums, where = s.difference(vectors)
        got = np.bincount(where[:, 0], weights=sizes, minlength=k).astype(np.int64)
        assert (got == sums).all() and sums.sum() == sizes.sum()
        greedy = np.zeros(k, np.int64)
        for x in np.sort(sizes)[::-1]:
            greedy[greedy.argmin()] += x
        assert np.ptp(sums) <= max(np.ptp(greedy), sizes.max() if n < 10 * k else 0)
    several = np.array([[5, 3, 0], [4, 4, 1], [9, 0, 0]])
    sums, where = s.difference(several)
    got = np.zeros(3, np.int64)
    for row, to in zip(several, where):
        got[to] += row
    assert (got == sums).all()


def laws(rows, got, shards):
    assert len(got) == len(rows)
    size, slots, places = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    text = {i: (t or "") for i, t in rows}
    for r in got:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        places[raw].add(r.shard)
    return size, places


def test_bytes_near_equal_and_groups_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "x" * int(rng.integers(0, 3000)) + str(i)) for i in range(900)]
    rows += [(1000 + k, "same text " * 30) for k in range(40)] + [(2000 + k, None if k % 2 else "") for k in range(9)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, size int, shard string").repartition(4)
    size, places = laws(rows, s.shard(docs, shards=8).collect(), 8)
    assert max(size.values()) - min(size.values()) <= 64
    assert all(len(p) == 1 for p in places.values())


def test_outsized_group_is_dealt_out(spark):
    rows = [(i, "copy " * 20) for i in range(500)] + [(1000 + i, f"other {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    size, places = laws(rows, s.shard(docs, shards=5).collect(), 5)
    assert max(size.values()) - min(size.values()) <= 0.05 * sum(size.values()) / 5 + 116
    assert all(len(p) == 1 for t, p in places.items() if not t.startswith(b"copy"))


def test_edges(spark):
    docs = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id long, text string")
    got = s.shard(docs).collect()
    assert len(got) == 3 and sorted(r.doc_id or 0 for r in got) == [0, 1, 1]
    assert s.shard(docs.limit(0)).count() == 0
    assert len(s.shard_plan(pd.DataFrame({"item": [], "bytes": []}), 4)) == 0
