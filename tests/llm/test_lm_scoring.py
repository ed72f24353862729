"""LM scores: base by brute force, windows, causality, probabilities, gradients by training, edges."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import lm_scoring as m

TR = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COMMITTED = m.STEPS              # the tests on Spark train shorter
BANK = "river bank money water stream loan credit flow the a of and is was near over under green".split()


# plain versions of what the query gets from joins (``Counted``)


def inner_scores(model: dict | None, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Per word, log10 of p(id | class, id before it in the word) over its ids, by tables at hand (``_unseen`` joins them)."""
    if model is None or not len(ids):
        return np.zeros(len(length))
    single, klass = model["single"][ids], model["klass"][ids]
    before = np.r_[m.END_ID, ids[:-1]].astype(np.int64)
    pair = lookup(model["pairs"], before * m.IDS + ids)
    follow = lookup(model["follows"], before * m.CLASSES + klass)
    first = np.zeros(len(ids), bool)
    first[np.cumsum(length) - length] = True
    pair[first] = follow[first] = 0
    return np.add.reduceat(np.log10((pair + m.BACKING * single) / (follow + m.BACKING)), np.cumsum(length) - length)


def with_shapes(model: dict, ids: np.ndarray, length: np.ndarray, times: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Word scores where words with a count (``times`` > 0) take their share of their class
    sequence, and the other words of such a sequence what is left of it."""
    keys = m.shapes_of(model["klass"], ids, length)
    total, kept = lookup(model["totals"], keys), lookup(model["kept"], keys)
    rest = inner + np.log10((total - kept + 1) / (total + 1))
    return np.where(times > 0, np.log10(np.maximum(times, 1) / (total + 1)), rest)


def lookup(table: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> np.ndarray:
    """Counts of codes in a table (sorted codes, counts); 0 where there is none."""
    known, counts = table
    if not len(known):
        return np.zeros(len(codes))
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return np.where(known[at] == codes, counts[at], 0.0)


def second_factor(counts: np.ndarray, klass: np.ndarray, codes: np.ndarray, times: np.ndarray) -> dict:
    """Tables of the second factor: single ids by class, pairs (before * m.IDS + id), and their sums by class."""
    order = np.argsort(codes)
    codes, times = codes[order], times[order].astype(np.float64)
    by_class, place = np.unique(codes // m.IDS * m.CLASSES + klass[codes % m.IDS], return_inverse=True)
    return {"single": m.single_shares(counts, klass), "pairs": (codes, times),
            "follows": (by_class, np.bincount(place, weights=times, minlength=len(by_class)))}


def rows(n=160):
    rng = np.random.default_rng(3)
    out = [(i, " ".join(rng.choice(BANK, int(rng.integers(1, 60)))) + (f" Rare{i % 9}x" if i % 4 == 0 else "")) for i in range(n)]
    return out + [(1000, None), (1001, ""), (1002, "unseen " * 3 + "Ünïcode\xa0x"), (1003, "the river " * 4000)]


@pytest.fixture(scope="module")
def small():
    old = m.STEPS
    m.STEPS = 60
    yield
    m.STEPS = old


def test_base_and_model(spark, small):
    data = rows()
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t in data], "doc_id long, text string, h string, score double").repartition(3)
    got = {r.doc_id: r for r in m.score(docs).collect()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(TR)) for i, t in data}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in words}
    c, ends = Counter(), 0
    for i, w in words.items():
        if not held[i]:
            c.update(w)
            ends += 1
    n = sum(c.values()) + ends
    z = n + 0.1 * (len(c) + 2)
    for i, w in words.items():
        r = got[i]
        base = sum(math.log10((c[x] + 0.1) / z) for x in w) + math.log10((ends + 0.1) / z)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w) + 1, sum(x in c for x in w) + 1, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    assert len(got) == len(data) and 0 < sum(held.values()) < len(held)


def test_repeats_nulls_and_empty(spark, small):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "a b"), (2, "a b c")], "doc_id long, text string")
    got = m.score(docs).collect()
    assert len(got) == 5
    twice = [r for r in got if r.doc_id == 1 and r.n_tokens == 3]
    assert len(twice) == 2 and twice[0] == twice[1]
    one = next(r for r in got if r.doc_id == 1 and r.n_tokens == 2)
    assert one.n_known <= 2 and next(r for r in got if r.doc_id is None).held_out
    assert m.score(docs.limit(0)).count() == 0


def model(seed=0, n_texts=40):
    rng = np.random.default_rng(seed)
    n = rng.integers(1, 5 * m.WINDOW, n_texts)
    klass = rng.integers(0, m.CLASSES, int(n.sum()))
    p = m.untrained(3)
    for k in ("U", "B"):
        p[k] = rng.standard_normal(p[k].shape).astype(np.float32)
    return p, klass, n


def test_windows_score_each_subword_once():
    n = np.array([1, m.WINDOW, m.WINDOW + 1, 5 * m.WINDOW, 2])
    text, first, is_first = m.windows(n)
    seen = Counter()
    for t, f, whole in zip(text, first, is_first):
        last = m.WINDOW if whole else m.STRIDE
        seen.update((t, k) for k in range(f + m.WINDOW - last, f + m.WINDOW) if k < n[t])
    assert seen == Counter({(t, k): 1 for t in range(len(n)) for k in range(n[t])})


def test_causal_and_normalised():
    p, klass, n = model()
    base = m.log10_scores(p, klass, n)
    changed = klass.copy()
    ends = np.cumsum(n) - 1
    changed[ends] = (changed[ends] + 1) % m.CLASSES          # the last subword of each text
    other = m.log10_scores(p, changed, n)
    before = np.ones(len(klass), bool)
    before[ends] = False
    assert np.allclose(base[before], other[before], atol=1e-5)
    first = np.zeros(m.CLASSES)
    for c in range(m.CLASSES):
        first[c] = m.log10_scores(p, np.array([c]), np.array([1]))[0]
    assert (10 ** first).sum() == pytest.approx(1, abs=1e-4)
    assert np.allclose(base, m.log10_scores(p, klass, n, block=3), atol=1e-5)


def test_training_learns_what_pairs_cannot(monkeypatch):
    monkeypatch.setattr(m, "STEPS", COMMITTED)
    rng = np.random.default_rng(1)
    texts = []
    for _ in range(400):                       # the class after 9 repeats the one before it
        t = []
        for _ in range(12):
            a = int(rng.integers(0, 6))
            t += [a, 9, a]
        texts.append(np.array(t))
    klass, n = np.concatenate(texts), np.full(400, 36)
    p = m.train(klass, n, 3)
    score = m.log10_scores(p, klass, n).reshape(400, 36)
    assert (10 ** score[:, 2::3]).mean() > 0.9 and (10 ** score[:, 0::3]).mean() < 0.35


def test_scoring_tables_give_the_trained_model():
    """The class model as ``forward`` and a plain softmax in two levels have it, place by place."""
    p, klass, n = model(2, 6)
    p["Us"], p["Bs"] = (np.random.default_rng(4).standard_normal(p[k].shape).astype(np.float32) for k in ("Us", "Bs"))
    is_first, x, target = m._laid_out(klass, n, p["end"])
    h, _ = m.forward(p, x, m.WINDOW)
    before = x.reshape(-1)
    share = lambda a: np.exp(a) / np.exp(a).sum(axis=-1, keepdims=True)
    whole = (share(h @ p["Us"] + p["Bs"][before])[:, :, None]
             * share((h @ p["U"] + p["B"][before]).reshape(-1, m.SETS, m.PER))).reshape(-1, m.CLASSES)
    assert np.allclose(whole.sum(axis=1), 1, atol=1e-4)
    want = np.full(len(klass), np.nan)
    for k, t in enumerate(target.reshape(-1).tolist()):
        late = k % m.WINDOW >= m.WINDOW - m.STRIDE or is_first[k // m.WINDOW]
        if t >= 0 and late:
            want[t] = math.log10(whole[k, klass[t]])
    assert np.allclose(m.log10_scores(p, klass, n), want, atol=1e-4)


def test_gradients_by_differences():
    """Every parameter's gradient against the difference quotient of the loss along it."""
    rng = np.random.default_rng(8)
    klass, n = rng.integers(0, m.CLASSES, 70), np.array([40, 30])
    p = {k: v if k == "end" else (rng.standard_normal(v.shape) * 0.3).astype(np.float64) for k, v in m.untrained(3).items()}
    _, x, target = m._laid_out(klass, n, 3)
    target = target.reshape(-1)

    def loss(q):
        h, _ = m.forward(q, x, m.WINDOW)
        before, use = x.reshape(-1), target >= 0
        share = lambda a: a - np.log(np.exp(a).sum(axis=-1, keepdims=True))
        whole = (share(h @ q["Us"] + q["Bs"][before])[:, :, None]
                 + share((h @ q["U"] + q["B"][before]).reshape(-1, m.SETS, m.PER))).reshape(-1, m.CLASSES)
        return -whole[use, klass[target[use]]].mean()

    found = m.gradients(p, x, target, klass)
    for k in (k for k in p if k != "end"):
        along = rng.standard_normal(p[k].shape)
        up, down = ({**p, k: p[k] + e * along} for e in (1e-3, -1e-3))
        assert (found[k] * along).sum() == pytest.approx((loss(up) - loss(down)) / 2e-3, rel=0.02, abs=2e-4), k


def test_groups_never_mix_starts_and_inner_ids():
    rng = np.random.default_rng(0)
    starts = m.starting_ids("byte_bpe_50k.tiktoken")
    encode = m.word_encoder("byte_bpe_50k.tiktoken")
    words = [f"{a}{b}ness".encode() for a in BANK for b in ("", "xq", "über", "'s", "99")]
    spelled = [encode(w) for w in words]
    assert all(starts[w[0]] and not starts[w[1:]].any() for w in spelled)
    ids = np.concatenate([spelled[k] for k in rng.integers(0, len(words), 3000)])
    klass = m.classes_of(np.bincount(ids, minlength=m.IDS).astype(float), ids, starts)
    for k in range(m.CLASSES):
        assert len(set(starts[klass == k])) <= 1
    assert (klass == klass[m.END_ID]).sum() == 1


def test_all_texts_of_a_tiny_vocabulary_sum_to_at_most_one(spark, monkeypatch):
    """Class model and second factor together, over every text of up to three of some words and their readings."""
    import itertools
    kept = {}
    train = m.train
    monkeypatch.setattr(m, "STEPS", 30)
    monkeypatch.setattr(m, "train", lambda *a: kept.setdefault("p", train(*a)))
    vocabulary = ["a", "ab", "abc", "bc", "cab", "b", "c", "zq", "qz", "zqzq"]
    rng = np.random.default_rng(1)
    learned = [(i, " ".join(rng.choice(vocabulary[:7], int(rng.integers(1, 4))))) for i in range(400)]
    learned = [(i, t) for i, t in learned if zlib.crc32(str(i).encode()) % 10]
    texts = [" ".join(w) for k in range(4) for w in itertools.product(vocabulary, repeat=k)]
    held = [i for i in range(10_000, 40_000) if zlib.crc32(str(i).encode()) % 10 == 0][:len(texts)]
    docs = spark.createDataFrame(learned + list(zip(held, texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.score for r in m.score(docs).collect() if r.held_out}
    total = sum(10 ** got[i] for i in held)
    assert len(got) == len(texts) == 1111 and 0.3 < total <= 1 + 1e-4


def test_second_factor_is_a_distribution():
    counts = np.zeros(m.IDS)
    counts[:50] = np.arange(50, 0, -1)
    klass = m.classes_of(counts, np.arange(50).repeat(3))
    codes = np.array([1 * m.IDS + k for k in range(40)] + [2 * m.IDS + 7])
    tables = {"klass": klass, **second_factor(counts, klass, codes, np.arange(1, 42))}
    k = klass[30000]
    members = np.flatnonzero(klass == k)
    ids = np.stack([np.full(len(members), 1), members], axis=1).reshape(-1)
    total = 10 ** inner_scores(tables, ids, np.full(len(members), 2))
    single = 10 ** inner_scores(tables, np.array([1]), np.array([1]))
    assert (total / single).sum() == pytest.approx(1, abs=1e-6)


def test_words_of_a_class_sequence_share_its_probability():
    counts = np.zeros(m.IDS)
    counts[:200] = np.arange(200, 0, -1)
    klass = m.classes_of(counts, np.arange(200).repeat(2))
    group = np.flatnonzero(klass == klass[30000])[:40]
    ids = np.array([g for i in range(6) for j in range(6) for g in (group[i], group[j])])
    length = np.full(36, 2)
    keys = m.shapes_of(klass, ids, length)
    assert len(set(keys.tolist())) == 1 and m.shapes_of(klass, ids[:1], np.array([1]))[0] != keys[0]
    flipped = m.shapes_of(klass, np.array([group[0], 1, 1, group[0]]), np.array([2, 2]))
    assert flipped[0] != flipped[1]
    model = {"klass": klass, "totals": (keys[:1], np.array([100.0])), "kept": (keys[:1], np.array([60.0]))}
    times = np.zeros(36)
    times[:2] = 40, 20
    got = 10 ** with_shapes(model, ids, length, times, np.full(36, math.log10(1 / 36)))
    assert got[0] == pytest.approx(40 / 101) and got[1] == pytest.approx(20 / 101)
    assert got[2:].sum() <= 41 / 101 and got.sum() <= 1


def test_second_factor_uses_every_count(spark, monkeypatch):
    """Whole words and pairs of any count, also when hardly a word travels with the model."""
    kept = {}
    classes, untrained = m.classes_of, m.untrained
    monkeypatch.setattr(m, "FREQUENT", 12)
    monkeypatch.setattr(m, "classes_of", lambda *a: kept.setdefault("klass", classes(*a)))
    monkeypatch.setattr(m, "train", lambda klass, n, end: kept.setdefault("p", untrained(end)))
    data = [*rows(120), *[(5000 + i, f"seldom{i}word unusual{i}ly riverbank{i % 3}") for i in range(40)]]
    got = {r.doc_id: r.score for r in m.score(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    klass, encode = kept["klass"], m.word_encoder("byte_bpe_50k.tiktoken")
    learned = [t or "" for i, t in data if zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in learned for w in m.words_of_text(t))
    shape = lambda x: int(m.shapes_of(klass, x, np.array([len(x)]))[0])
    single, pair, total, kinds = np.zeros(m.IDS), Counter(), Counter(), Counter()
    for w, k in c.items():
        x = np.array(encode(w))
        np.add.at(single, x, k)
        for a, b in zip(x[:-1].tolist(), x[1:].tolist()):
            pair[a * m.IDS + b] += k
        total[shape(x)] += k
        kinds[shape(x)] += 1
    single[m.END_ID] += len(learned)
    tables = {"klass": klass, **second_factor(single, klass, np.array(list(pair)), np.array(list(pair.values())))}
    new = 0
    for i, t in data:
        spelled = [(w, np.array(encode(w))) for w in m.words_of_text(t or "")]
        inner = math.log10(tables["single"][m.END_ID])
        for w, x in spelled:
            n, d = total[shape(x)], kinds[shape(x)]
            left = math.log10(d / (n + d)) if n else 0.0
            inner += math.log10(c[w] / (n + d)) if w in c else inner_scores(tables, x, np.array([len(x)]))[0] + left
            new += w not in c
        stream = np.concatenate([*[x for _, x in spelled], [m.END_ID]]).astype(np.int64)
        assert got[i] == pytest.approx(m.log10_scores(kept["p"], klass[stream], np.array([len(stream)])).sum() + inner, rel=1e-6)
    assert new > 3


def test_later_windows_see_context():
    assert m.WINDOW - m.STRIDE >= 8 and m.CLASSES >= 144     # subwords before the first one that a later window scores


def test_every_training_document_trains_the_model(spark, monkeypatch):
    """The pass over all documents: counts around ids, and a model that fits what its start has not seen."""
    kept = {}
    classes, train, around = m.classes_of, m.train, m.neighbours
    monkeypatch.setattr(m, "SAMPLE", 3)
    monkeypatch.setattr(m, "STEPS", 5)
    monkeypatch.setattr(m, "BATCH", 8)
    monkeypatch.setattr(m, "PIECE", 700)
    monkeypatch.setattr(m, "neighbours", lambda *a: kept.setdefault("around", around(*a)))
    monkeypatch.setattr(m, "classes_of", lambda *a: kept.setdefault("klass", classes(*a)))

    def start(*a):
        kept["p"] = p = train(*a)
        kept["start"] = dict(p)
        return p

    monkeypatch.setattr(m, "train", start)
    rng = np.random.default_rng(2)
    pairs = [(i, " ".join(f"{a} the {a}" for a in rng.choice(BANK[:8], 12))) for i in range(400)] + [(900, "bank " * 900), (901, None)]
    m.score(spark.createDataFrame(pairs, "doc_id long, text string").repartition(2)).count()
    learned = [t or "" for i, t in pairs if zlib.crc32(str(i).encode()) % 10]
    ids, n, *_ = m.Words("byte_bpe_50k.tiktoken").stream(learned)
    own = m.own_classes(np.bincount(ids, minlength=m.IDS).astype(float))
    first = np.cumsum(n) - n
    before = np.r_[m.END_ID, ids[:-1]]
    before[first] = m.END_ID
    codes, times = np.unique(m.neighbour_codes(own, before, ids), return_counts=True)
    assert sorted(zip(*kept["around"])) == list(zip(codes, times))
    klass = kept["klass"]
    fit = [m.log10_scores(p, klass[ids], n).mean() for p in (kept["start"], kept["p"])]
    assert fit[1] > fit[0] + 0.02


def test_streams_are_whole_texts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(m, "PIECE", 10)
    texts = [np.arange(k) for k in (1, 4, 30, 1, 1, 9, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array([x.astype("<u2").tobytes() for x in texts])], names=["ids"])
    for lo in range(3):
        got = [x for ids, n in m.streams_of([batch.slice(lo)]) for x in np.split(ids, np.cumsum(n)[:-1])]
        assert [x.tolist() for x in got] == [x.tolist() for x in texts[lo:]]
