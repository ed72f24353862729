"""Collocations: counts and ranks against a plain version at any chunk and range size; exact scores; edges."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import collocations as m

LOWER = {c: c + 32 for c in range(65, 91)}
COLUMNS = "text string, lang string"


def plain_pieces(text):
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
        yield [w for w in re.split("[ \t]+", piece) if w]


def plain_counts(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for ws in plain_pieces(text):
            n[lang or "und"] += len(ws)
            for k in (1, 2, 3):
                f.update((lang or "und", *ws[i:i + k]) for i in range(len(ws) - k + 1))
    return f, n


def plain(rows, min_count, top):
    f, n = plain_counts(rows)
    found = {}
    for g, a in f.items():
        if len(g) < 3 or a < min_count:
            continue
        lang, ws = g[0], g[1:]
        if len(ws) == 2 and any(len(h) == 4 and h[0] == lang and ws in (h[1:3], h[2:4]) and c >= min_count and 100 * c >= 50 * a
                                for h, c in f.items()):
            continue
        cuts = [(1000000 * a * a // (f[(lang, *ws[:k])] * f[(lang, *ws[k:])]), k, f[(lang, *ws[:k])], f[(lang, *ws[k:])])
                for k in range(1, len(ws))]
        s, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-s, -a, " ".join(ws).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, x in found.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(x)[:top]))


def made(seed, docs, langs=("en", "de", None, "und")):
    rng, vocabulary = random.Random(seed), ["the", "The", "of", "a", "xé", "zz", "|", "É", "aa", "a\x00", "日本"]
    out = []
    for _ in range(docs):
        words = [rng.choice(vocabulary[:rng.randint(2, len(vocabulary))]) for _ in range(rng.randint(0, 60))]
        out.append(("".join(w + rng.choice([" ", " ", " ", "\t ", ", ", "\n", ".", " ! "]) for w in words), rng.choice(langs)))
    return out


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [1, 3, 20, 500, 1 << 20])
def test_windows_at_any_chunk_size(size):
    texts = [t for t, _ in made(3, 30)] + ["", "one", "a b", "x" * 300 + " y " + "z" * 200, "a b c d e f g h"]
    want = Counter()
    for t in texts:
        for ws in plain_pieces(t):
            want.update(tuple([*ws, "", ""][i:i + 3]) for i in range(len(ws)))
    found = Counter()
    for words, packed, bits in m.windows(pa.array(texts), size):
        names = ["", *[w.decode() for w in words.to_pylist()]]
        found.update(tuple(names[i] for i in w) for w in zip(*m.parts(packed, bits)))
    assert found == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é.\n\t!B"), max_size=40), min_size=1, max_size=6), st.integers(1, 50),
       st.lists(st.tuples(*[st.sampled_from([b"", b"a", b"ab", b"b", b"ba", "é".encode()])] * 3), max_size=4), st.integers(1, 3))
def test_runs_cut_and_merged(texts, size, cuts, min_count):
    rows = []
    for words, packed, bits in m.windows(pa.array(texts), size):
        rows += m.run_rows("en", words, *m.counted(packed), bits, sorted({(b"en", *c) for c in cuts}))
    found = Counter()
    names = [c.split()[0] for c in m.RUN.split(", ")]
    for k in {r[0] for r in rows}:
        table = pa.table({c: [r[i] for r in rows if r[0] == k] for i, c in enumerate(names)})
        for r in m.merge_runs(table, min_count).to_pylist():
            found[(r["w1"], r["w2"], r["w3"])] += r["n"]
    f, n = plain_counts([(t, "en") for t in texts])
    want = {(*g[1:], "", "")[:3]: c for g, c in f.items() if c >= min_count}
    assert {g: c for g, c in found.items() if g[0] and c >= min_count} == want
    assert found[("", "", "")] == n["en"]


def test_many_words_need_no_packing(monkeypatch):
    texts = [t for t, _ in made(5, 20)]
    rows = [r for words, packed, bits in m.windows(pa.array(texts)) for r in m.run_rows("en", words, *m.counted(packed), bits, [])] * 2
    names = [c.split()[0] for c in m.RUN.split(", ")]
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(names)})
    before = m.merge_runs(table, 2)
    monkeypatch.setattr(m, "packing", lambda n: None)
    assert m.merge_runs(table, 2) == before


@pytest.mark.parametrize("range_windows", [1_500_000, 300])
def test_table_against_the_plain_version(spark, range_windows):
    rows = made(1, 120) + [(None, "en"), ("", "de"), ("hot hot " * 400, "en"), ("x y " * 3000, "en")] + [("same text here", "fr")] * 12
    docs = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'q' as phrase", "1 as n", "2 as rank", "'w' as w1").repartition(5)
    assert got(m.collocations(docs, 3, 40, range_windows=range_windows)) == plain(rows, 3, 40)
    if range_windows == 300:
        assert len(m.cuts_of(docs.selectExpr("text", "coalesce(lang, 'und') as lang").where("text is not null"), 300)) > 5


def test_ties_are_in_byte_order_and_empty_tables(spark):
    rows = [("zé a. z\U0001f600 a. z￿ a. zz a", "en")] * 10
    out = got(m.collocations(spark.createDataFrame(rows, COLUMNS)))
    assert out == plain(rows, 10, 2000) and len(out) == 4
    assert m.collocations(spark.createDataFrame([], COLUMNS)).collect() == []
    assert m.collocations(spark.createDataFrame([(None, "en"), (" . ", None)], COLUMNS)).collect() == []


def test_scores_are_exact(spark):
    cases = [(10**15, 10**15, 10**15), (999_999_999_999_999, 10**15, 10**15), (3_037_000_500, 3_037_000_501, 3_037_000_502),
             (10, 1_000_003, 999_983), (10, 10, 10)]
    df = spark.createDataFrame(cases, "a long, l long, r long")
    s = [r.s for r in df.select(m.score(df.a, df.l, df.r).alias("s")).collect()]
    assert s == [1000000 * a * a // (l * r) for a, l, r in cases]


def test_memory_of_a_run_and_of_a_merge():
    """numpy's peak for a chunk's windows and for a range's merge, by byte of text and by window."""
    import tracemalloc
    rng = np.random.default_rng(5)
    names = np.array([f"word{k}" for k in range(20_000)])
    texts = pa.array([" ".join(rng.choice(names, 400)) for _ in range(1200)])
    tracemalloc.start()
    try:
        words, packed, bits = next(m.windows(texts, m.CHUNK))
        window_peak = tracemalloc.get_traced_memory()[1]
        runs = m.run_rows("en", words, *m.counted(packed), bits, []) * 2
        columns = list(zip(*runs))
        table = pa.table([pa.array(c) for c in columns], names=[c.split()[0] for c in m.RUN.split(", ")])
        here = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
        m.merge_runs(table, 10)
        merge_peak = tracemalloc.get_traced_memory()[1] - here
    finally:
        tracemalloc.stop()
    assert window_peak < 10 * m.CHUNK and merge_peak < 80 * 2 * len(packed)


def test_a_large_batch_is_dealt_out_a_few_texts_at_a_time():
    texts, langs = ["word " * 2000] * 4000, ["en", "de", "fr", "es"] * 1000       # 40 MB
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts), "lang": pa.array(langs)})
    given = [own for _, own in m.by_language([batch])]
    assert sum(len(own) for own in given) == 4000
    assert max(own.nbytes for own in given) < 2 * m.CHUNK         # a language's texts of the whole batch came at once
