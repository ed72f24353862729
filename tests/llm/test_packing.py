"""Packing: plan validity and quality, pieces against the tokenizer file, gapless sequences, edges."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewater.llm import packing as p


def check_plan(histogram, capacity):
    plan = p.plan(histogram, capacity)
    for n, c in histogram.items():
        own = plan[plan["length"] == n].sort_values("lo")
        assert own["lo"].tolist() == [0, *own["hi"].tolist()[:-1]] and own["hi"].iloc[-1] == c
    spans = [(s + k, o, n) for n, lo, hi, s, o in plan.itertuples(index=False) for k in range(hi - lo)]
    content = defaultdict(list)
    for s, o, n in spans:
        content[s].append((o, n))
    assert sorted(content) == list(range(len(content)))
    for parts in content.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(content)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=25))
def test_any_histogram(histogram):
    used = check_plan(histogram, 40)
    tokens = sum(n * c for n, c in histogram.items())
    assert used <= max(1, 2 * -(-tokens // 40)) or not histogram


def test_near_the_lower_bound():
    rng = np.random.default_rng(0)
    lengths = np.minimum(1024, rng.lognormal(6, 1, 20000).astype(int) + 2)
    histogram = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    tokens = int(lengths.sum())
    assert check_plan(histogram, 1024) <= 1.002 * tokens / 1024 + 1


def test_fit_counts_is_least_squares():
    left = np.zeros(11, np.int64)
    left[[3, 4, 6, 7]] = [10, 20, 20, 10]
    assert p.fit_counts([(7, 3), (6, 4)], left) == pytest.approx([10, 20], abs=0.05)


TEXTS = [(1, "Hello world, this is a text."), (2, None), (3, ""), (4, "word " * 3000), (5, "<|endoftext|> in a text"), (6, "né\x00ü \U0001f600 " * 50),
         (None, "no id"), (7, "same text"), (7, "same text"), (8, " " * 5000), (9, "x" * 20000)]


def test_pieces_and_sequences(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in TEXTS], "doc_id long, text string, piece string, rank int").repartition(3)
    got = p.pack(docs, capacity=64).collect()
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    exact.encode_special_tokens = True
    want = []
    for i, t in TEXTS:
        ids = np.array(exact.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        for k, (start, n) in enumerate(p.cut(len(ids), 64)):
            want.append((i, k, start, n, zlib.crc32(ids[start:start + n].tobytes())))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(want, key=key)
    content = defaultdict(list)
    for r in got:
        content[r.sequence_id].append((r.offset, r.length))
    for parts in content.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    tokens = sum(r.length for r in got)
    assert len(content) <= -(-tokens // 64) + 2
    assert p.pack(docs.limit(0)).count() == 0


def test_cut():
    assert p.cut(3, 4) == [(0, 3)] and p.cut(4, 4) == [(0, 4)] and p.cut(10, 4) == [(0, 2), (2, 4), (6, 4)]
