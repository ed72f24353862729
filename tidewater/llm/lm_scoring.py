"""Language-model scores by causal self-attention over subword ids (operator 1).

The model gives log10 probabilities of a text's lower-cased words and its end:

* Subwords are the ids of a public byte-level BPE for each word with a leading
  space.  Every id belongs to one of ``CLASSES`` classes: frequent ids have one of
  their own, the others are grouped by the classes they follow.  No group holds both
  ids that begin a word and ids that go on inside one, so a sequence of classes has one
  reading as words, and the probabilities of all texts sum to at most 1.
* p(id | before) = p(class | before) * p(id | class, the id before it in the word).
  The second factor comes from the counts of all training documents and depends on
  the word alone: a word of the training documents takes its share of all words of its
  class sequence; as much as that sequence has distinct words is left to words that were
  not seen, by pairs of ids within words, backed by single ids.  Every word and every
  pair counts.  The first factor is a causal self-attention model:
  class and position embeddings, one masked head, a hidden layer, and a table of
  direct successor weights; it gives a set of ``PER`` classes, then a class of that set
  (a softmax in two levels).  It is trained in numpy with Adam on all training
  documents: a start from at most ``SAMPLE`` of them (smallest hashes of the id, whole
  texts) on the driver, then one pass over every subword of every training document, in
  tasks that go on from that start; the model is the mean of what the tasks end with, by
  their numbers of subwords.  Classes come from counts of all training documents, of ids
  and of the classes around them.  The mean depends a little on how the rows are dealt.
* Scoring cuts each text into windows of ``WINDOW`` subwords that overlap; each
  window after the first scores its last ``STRIDE`` subwords, so every subword is
  scored once, with earlier ones as context.  Windows run in batches with one
  masked attention product.

Base and second factor need the counts of all training documents; these stay Spark
tables.  The at most ``FREQUENT`` most frequent words travel with the model, and the
scoring pass sums them; all others are joined by a shuffle, so no hot word meets one
task.  Both ways give a word the same values.

Defined results: a null or empty text is scored as its end alone.  A null id counts
as held out (its checksum is that of the empty text).  Repeated rows are scored
alike, and each counts while learning.  Without training documents the base is 0
per token and the model uniform.  Only the id and the text are read.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.byte_words import byte_set, chunks, column_bytes, spans, word_array
from tidewater.llm.common import map_slices, materialize, mix64

END_ID = 50256
IDS = 50257
CLASSES, GROUPS = 144, 32        # classes in all; of them groups of less frequent ids
SETS, PER = 12, 12               # sets of classes, classes of a set
WINDOW, STRIDE = 32, 24
WIDTH, HIDDEN = 16, 32
SAMPLE = 2500                    # documents that the pass over all documents starts from, at most
STEPS, BATCH, RATE = 1600, 320, 8e-3
LATER = 2e-3                     # rate of the pass over all documents; it falls with the square root of the steps
PIECE = 1 << 19                  # subwords that a task lays out as windows at a time, at least one document
MEANS = 32                       # parts in which the tasks' models are summed before the driver sees them
SEED = 5
FREQUENT = 200_000               # words over 1 / FREQUENT of all tokens: their number has this bound
BACKING = 5.0                    # weight of single ids against pairs
SMOOTH = 0.1
CACHE = 400_000                  # words whose ids a task remembers
CHARS = 1 << 21                  # characters (bytes) of text that a task holds split


def words_of_text(text: str) -> list[bytes]:
    """Lower-cased (A-Z only) words: on bytes, lower() and split() know ASCII alone."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_encoder(vocabulary: str):
    """``word -> ids`` of the word (UTF-8 bytes) with a leading space."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda word: own.encode_ordinary(" " + word.decode("utf-8", "replace"))


class Words:
    """Subword streams of texts; remembers the ids of words it has seen, up to CACHE of them."""

    def __init__(self, vocabulary: str, model: dict | None = None):
        self.encode, self.model = word_encoder(vocabulary), model
        self.clear()

    def clear(self):
        self.place: dict[bytes, int] = {}
        self.names: list[bytes] = [b""]
        self.ids, self.length, self.start = np.array([END_ID]), np.ones(1, np.int64), np.zeros(1, np.int64)
        self.inner = np.log10(self.model["single"][self.ids]) if self.model else np.zeros(1)
        self.base = np.zeros(1)                    # of frequent words; nan marks a word that is joined later

    def _remember(self, words: list[bytes], new: list[list[int]]):
        self.names += words
        times = inner = np.zeros(len(words))
        if self.model:
            times, inner = np.array([self.model["frequent"].get(w, (0, 0.0)) for w in words], float).T
        z = self.model["z"] if self.model else 1.0
        self.base = np.r_[self.base, np.where(times > 0, np.log10((times + SMOOTH) / z), np.nan)]
        self.inner = np.r_[self.inner, inner]
        length = np.array([len(x) for x in new])
        ids = np.array([i for x in new for i in x])
        self.start = np.r_[self.start, len(self.ids) + np.cumsum(length) - length]
        self.ids, self.length = np.r_[self.ids, ids], np.r_[self.length, length]

    def stream(self, texts: list[str]):
        """(ids of all texts, each closed by the end id; subwords per text; words per text with its end;
        log10 of the second factor and base of the frequent words per text; the other words per text)."""
        if len(self.place) > CACHE:
            self.clear()
        place, at, n_words, new, names = self.place, [], [], [], []
        for text in texts:
            words = words_of_text(text)
            found = np.zeros(len(words) + 1, np.int64)              # closed by the end, word 0
            found[:-1] = np.fromiter(map(place.get, words, repeat(-1)), np.int64, len(words))
            for i in np.flatnonzero(found < 0).tolist():
                w = words[i]
                k = place.get(w)
                if k is None:
                    place[w] = k = len(self.length) + len(new)
                    new.append(self.encode(w))
                    names.append(w)
                found[i] = k
            at.append(found)
            n_words.append(len(found))
        if new:
            self._remember(names, new)
        at, n_words = np.concatenate(at), np.array(n_words)
        n = self.length.take(at)
        ends = np.cumsum(n)
        places = np.repeat(self.start.take(at) - ends + n, n)
        places += np.arange(len(places))
        ids = self.ids.take(places)
        texts_at = np.cumsum(n_words) - n_words
        base = self.base.take(at)
        other = np.flatnonzero(np.isnan(base))
        base[other] = 0.0
        names, cuts = self.names, np.searchsorted(other, np.r_[texts_at, len(at)])
        left = [names[k] for k in at[other].tolist()]
        return (ids, np.add.reduceat(n, texts_at), n_words, np.add.reduceat(self.inner.take(at), texts_at),
                np.add.reduceat(base, texts_at), [left[a:b] for a, b in zip(cuts, cuts[1:])])


def shapes_of(klass: np.ndarray, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 61-bit key of each word's class sequence."""
    start = np.cumsum(length) - length
    at = np.arange(len(ids)) - np.repeat(start, length)
    each = mix64(klass[ids].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at.astype(np.uint64) + np.uint64(1))
    total = np.add.reduceat(each, start) + length.astype(np.uint64)
    return (mix64(total) >> np.uint64(3)).astype(np.int64)


def starting_ids(vocabulary: str) -> np.ndarray:
    """Which ids begin a word: those whose bytes begin with its space; the end of a text counts as a word."""
    import base64

    import public_tokenizers

    out = np.zeros(IDS, bool)
    out[END_ID] = True
    with open(public_tokenizers.path(vocabulary), "rb") as f:
        for text, rank in map(bytes.split, f):
            out[int(rank)] = base64.b64decode(text).startswith(b" ")
    return out


def grouped(x: np.ndarray, groups: int) -> np.ndarray:
    """Spherical k-means over counts of neighbours: a group of each row; the last one for rows with few counts."""
    group = np.full(len(x), groups - 1)
    known = np.flatnonzero(x.sum(axis=1) >= 4)
    if len(known) > groups:
        x = np.sqrt(x[known])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        rng = np.random.default_rng(SEED)
        at = x[rng.choice(len(x), groups - 1, replace=False)]
        for _ in range(12):
            best = (x @ at.T).argmax(axis=1)
            for g in range(groups - 1):
                if (best == g).any():
                    at[g] = x[best == g].mean(axis=0)
            at /= np.maximum(np.linalg.norm(at, axis=1, keepdims=True), 1e-9)
        group[known] = (x @ at.T).argmax(axis=1)
    return group


def own_classes(counts: np.ndarray) -> np.ndarray:
    """The classes of the most frequent ids and of the end; -1 for all other ids."""
    order = np.argsort(-counts, kind="stable")
    own = CLASSES - GROUPS
    klass = np.full(IDS, -1)
    klass[order[:own]] = np.arange(own)
    if klass[END_ID] < 0:                                    # the end has a class of its own
        klass[order[own - 1]], klass[END_ID] = -1, own - 1
    return klass


def neighbour_codes(klass: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """For neighbours of which one has a class of its own: the other's id and that class, behind or (from
    ``CLASSES - GROUPS`` on) ahead of it, as one number."""
    own = CLASSES - GROUPS
    behind, ahead = klass[before], klass[after]
    seen, follow = (ahead < 0) & (behind >= 0), (behind < 0) & (ahead >= 0)
    return np.r_[after[seen] * (2 * own) + behind[seen], before[follow] * (2 * own) + own + ahead[follow]]


def classes_of(counts: np.ndarray, around, starts: np.ndarray | None = None) -> np.ndarray:
    """A class for every id: the most frequent have their own, others are grouped by the classes around them.

    ``around``: the neighbours' codes and their counts, or ids laid end to end.  With ``starts``
    no group holds ids of both kinds.  Classes are numbered by kind, then by frequency, so a set
    of ``PER`` classes holds like ones.
    """
    starts = np.ones(IDS, bool) if starts is None else starts
    own = CLASSES - GROUPS
    klass = own_classes(counts)
    rest = np.flatnonzero(klass < 0)
    row = np.full(IDS, -1)
    row[rest] = np.arange(len(rest))
    codes, times = around if isinstance(around, tuple) else np.unique(
        neighbour_codes(klass, around[:-1].astype(np.int64), around[1:].astype(np.int64)), return_counts=True)
    both = np.zeros((len(rest), 2 * own), np.float32)
    both[row[codes // (2 * own)], codes % (2 * own)] = times
    kinds = [k for k in (np.flatnonzero(starts[rest]), np.flatnonzero(~starts[rest])) if len(k)]
    mass = [(both[k].sum(axis=1) >= 4).sum() + 1 for k in kinds]
    first = GROUPS if len(kinds) == 1 else int(np.clip(round(GROUPS * mass[0] / sum(mass)), 2, GROUPS - 2))
    for k, base, groups in zip(kinds, (own, own + first), (first, GROUPS - first)):
        klass[rest[k]] = base + grouped(both[k], groups)
    weight = np.bincount(klass, weights=counts, minlength=CLASSES)
    inner = np.bincount(klass, weights=~starts, minlength=CLASSES) > 0
    number = np.empty(CLASSES, np.int64)
    number[np.lexsort((-weight, inner))] = np.arange(CLASSES)
    return number[klass]


def single_shares(counts: np.ndarray, klass: np.ndarray) -> np.ndarray:
    """Every id's smoothed share of its class."""
    return (counts + SMOOTH) / np.bincount(klass, weights=counts + SMOOTH, minlength=CLASSES)[klass]


def windows(n: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of n subwords laid end to end: (text, first position within the text, whether it is the text's first)."""
    per = 1 + np.maximum(0, -(-(n - WINDOW) // stride))
    text = np.repeat(np.arange(len(n)), per)
    k = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    return text, k * stride, k == 0


_SEEN = np.tril(np.ones((WINDOW, WINDOW), np.float32))     # what each place of a window may look at


def forward(p: dict, x_class: np.ndarray, last: int):
    """The hidden layer at the last ``last`` places of each window (rows of classes), and what training needs."""
    e = p["E"].take(x_class, axis=0)
    e += p["P"]
    tail = e[:, WINDOW - last:]
    q, k = tail @ p["Wq"], e @ p["Wk"]
    v = np.empty((*x_class.shape, WIDTH + 1), np.float32)
    np.matmul(e, p["Wv"], out=v[..., :WIDTH])
    v[..., WIDTH] = 1                              # sums the weights along with the values
    s = q @ k.transpose(0, 2, 1)
    np.minimum(s, 60, out=s)
    np.exp(s, out=s)
    s *= _SEEN[WINDOW - last:]
    a = s @ v
    total = a[..., WIDTH:].copy()
    z = np.empty((len(x_class), last, 2 * WIDTH), np.float32)
    z[..., :WIDTH] = tail
    np.divide(a[..., :WIDTH], total, out=z[..., WIDTH:])
    z = z.reshape(-1, 2 * WIDTH)
    h = z @ p["W1"]
    h += p["b1"]
    np.maximum(h, 0, out=h)
    return h, (e, q, k, v[..., :WIDTH], s, total, z)


def scoring_tables(p: dict) -> dict:
    """The model with everything that depends on a class or a place alone worked out."""
    w = np.concatenate([p["Wq"], p["Wk"], p["Wv"], np.zeros((WIDTH, 1), np.float32)], axis=1)
    place = p["P"] @ w
    place[:, -1] = 1                               # sums the weights along with the values
    return {"seen": p["E"] @ w, "place": place, "e1": p["E"] @ p["W1"][:WIDTH], "p1": p["P"] @ p["W1"][:WIDTH] + p["b1"],
            "w1": p["W1"][WIDTH:], "us": p["Us"], "bs": p["Bs"],
            "u": np.ascontiguousarray(p["U"].reshape(HIDDEN, SETS, PER).transpose(1, 0, 2)),
            "b": np.ascontiguousarray(p["B"].reshape(CLASSES, SETS, PER).transpose(1, 0, 2))}


def hidden(t: dict, x: np.ndarray, last: int) -> np.ndarray:
    """The hidden layer at the last ``last`` places of each window, as ``forward`` gives it, from the tables."""
    lo = WINDOW - last
    qkv = t["seen"].take(x, axis=0)
    qkv += t["place"]
    s = qkv[:, lo:, :WIDTH] @ qkv[:, :, WIDTH:2 * WIDTH].transpose(0, 2, 1)
    np.minimum(s, 60, out=s)
    np.exp(s, out=s)
    s *= _SEEN[lo:]
    a = s @ qkv[:, :, 2 * WIDTH:]
    h = np.divide(a[..., :WIDTH], a[..., WIDTH:]).reshape(-1, WIDTH) @ t["w1"]
    h += t["e1"].take(x[:, lo:].reshape(-1), axis=0)
    h.reshape(len(x), last, HIDDEN)[...] += t["p1"][lo:]
    return np.maximum(h, 0, out=h)


def _log_share(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """ln of the softmax at one place of each row; overwrites the logits."""
    want = logits.reshape(-1).take(np.arange(len(logits)) * logits.shape[1] + chosen)
    np.minimum(logits, 80, out=logits)
    np.exp(logits, out=logits)
    want -= np.log(logits.sum(axis=1))
    return want


def class_scores(t: dict, h: np.ndarray, before: np.ndarray, target: np.ndarray) -> np.ndarray:
    """ln p(class): its set among the sets, then itself in the set."""
    in_set = target // PER
    sets = h @ t["us"]
    sets += t["bs"].take(before, axis=0)
    out = _log_share(sets, in_set)
    order = np.argsort(in_set.astype(np.uint8), kind="stable")        # set by set: only its own classes are worked out
    edges = np.searchsorted(in_set[order], np.arange(SETS + 1)).tolist()
    h, before, place = h.take(order, axis=0), before[order], (target - in_set * PER)[order]
    inside = np.empty(len(out), out.dtype)
    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if lo < hi:
            own = h[lo:hi] @ t["u"][k]
            own += t["b"][k].take(before[lo:hi], axis=0)
            inside[lo:hi] = _log_share(own, place[lo:hi])
    out[order] += inside
    return out


def _laid_out(klass: np.ndarray, n: np.ndarray, end: int, stride: int = STRIDE):
    """Windows of inputs (classes, the end's before a text begins) and of target places (-1 behind the text)."""
    text, first, is_first = windows(n, stride)
    begin = (np.cumsum(n) - n)[text] + first
    left = n[text] - first                                  # subwords from the window's start to the text's end
    steps = np.arange(WINDOW)
    at = begin[:, None] + steps
    before = np.r_[np.array([end], klass.dtype), klass]
    x = before.take(np.minimum(at, len(klass)))
    x[is_first, 0] = end
    at[steps >= left[:, None]] = -1
    return is_first, x, at


def log10_scores(p: dict, klass: np.ndarray, n: np.ndarray, block: int = 256) -> np.ndarray:
    """log10 p(class | before) of every subword of texts laid end to end; each is scored once."""
    klass = klass.astype(np.intp)
    out = np.empty(len(klass), np.float64)
    is_first, x, target = _laid_out(klass, n, p["end"])
    tables = scoring_tables(p)
    for chosen, last in ((is_first, WINDOW), (~is_first, STRIDE)):
        xs, ts = x[chosen], target[chosen][:, WINDOW - last:]
        for lo in range(0, len(xs), block):
            xb, t = xs[lo:lo + block], ts[lo:lo + block].reshape(-1)
            h, before = hidden(tables, xb, last), xb[:, WINDOW - last:].reshape(-1)
            if t.min() < 0:                        # places behind a text
                use = np.flatnonzero(t >= 0)
                h, before, t = h[use], before[use], t[use]
            out[t] = class_scores(tables, h, before, klass.take(t))
    out /= math.log(10)
    return out


def untrained(end: int) -> dict:
    rng = np.random.default_rng(SEED)
    g = lambda *s: (rng.standard_normal(s) * 0.3 / math.sqrt(s[0])).astype(np.float32)
    return {"E": (rng.standard_normal((CLASSES, WIDTH)) * 0.3).astype(np.float32), "P": g(WINDOW, WIDTH),
            "Wq": g(WIDTH, WIDTH), "Wk": g(WIDTH, WIDTH), "Wv": g(WIDTH, WIDTH), "W1": g(2 * WIDTH, HIDDEN),
            "b1": np.zeros(HIDDEN, np.float32), "U": np.zeros((HIDDEN, CLASSES), np.float32),
            "B": np.zeros((CLASSES, CLASSES), np.float32), "Us": np.zeros((HIDDEN, SETS), np.float32),
            "Bs": np.zeros((CLASSES, SETS), np.float32), "end": end}


def _less_chosen(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The softmax of each row, less 1 at its chosen place; overwrites the logits."""
    np.minimum(logits, 80, out=logits)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    logits[np.arange(len(logits)), chosen] -= 1
    return logits


def _summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows that have the same place of ``n``."""
    width = rows.shape[1]
    places = (at * width)[:, None] + np.arange(width)
    return np.bincount(places.reshape(-1), weights=rows.reshape(-1), minlength=n * width).reshape(n, width).astype(rows.dtype)


def gradients(p: dict, xb: np.ndarray, tb: np.ndarray, klass: np.ndarray) -> dict:
    """Gradients of the mean of -ln p over the target places ``tb`` (-1: none) of windows ``xb``."""
    h, (e, q, k, v, s, total, z) = forward(p, xb, WINDOW)
    s /= total
    use, before = tb >= 0, xb.reshape(-1)
    c = klass[np.maximum(tb, 0)]
    each = (use / max(1, use.sum())).astype(h.dtype)[:, None]
    in_set = c // PER
    gs = _less_chosen(h @ p["Us"] + p["Bs"].take(before, axis=0), in_set) * each
    d = {"Us": h.T @ gs, "Bs": _summed(before, gs, CLASSES), "U": np.zeros_like(p["U"])}
    dh = gs @ p["Us"].T
    order = np.argsort(in_set.astype(np.uint8), kind="stable")        # set by set: only its own classes are worked out
    edges = np.searchsorted(in_set[order], np.arange(SETS + 1)).tolist()
    hs, bs, places, each = h.take(order, axis=0), before[order], (c - in_set * PER)[order], each[order]
    g, back = np.empty((len(tb), PER), h.dtype), np.empty_like(hs)
    for k_set, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if lo < hi:
            cols = slice(k_set * PER, (k_set + 1) * PER)
            own = _less_chosen(hs[lo:hi] @ p["U"][:, cols] + p["B"][:, cols].take(bs[lo:hi], axis=0), places[lo:hi])
            own *= each[lo:hi]
            g[lo:hi], d["U"][:, cols], back[lo:hi] = own, hs[lo:hi].T @ own, own @ p["U"][:, cols].T
    d["B"] = _summed(bs * SETS + in_set[order], g, CLASSES * SETS).reshape(CLASSES, CLASSES)
    dh[order] += back
    dh *= h > 0
    d["W1"], d["b1"] = z.T @ dh, dh.sum(axis=0)
    dz = (dh @ p["W1"].T).reshape(len(xb), WINDOW, 2 * WIDTH)
    de, da = dz[..., :WIDTH].copy(), dz[..., WIDTH:]
    dv = s.transpose(0, 2, 1) @ da
    ds = da @ v.transpose(0, 2, 1)
    ds = s * (ds - (ds * s).sum(axis=2, keepdims=True))
    dq, dk = ds @ k, ds.transpose(0, 2, 1) @ q
    flat = lambda a: a.reshape(-1, a.shape[-1])
    for w, grad in (("Wq", dq), ("Wk", dk), ("Wv", dv)):
        d[w] = flat(e).T @ flat(grad)
        de += grad @ p[w].T
    d["P"], d["E"] = de.sum(axis=0), _summed(before, flat(de), CLASSES)
    return d


def train(klass: np.ndarray, n: np.ndarray, end: int) -> dict:
    """Fit the class model on texts laid end to end (classes, subwords per text)."""
    p = untrained(end)
    if not len(klass):
        return p
    _, x, target = _laid_out(klass, n, end)
    pairs = np.zeros((CLASSES, CLASSES))
    before = np.r_[end, klass[:-1]]
    before[np.cumsum(n)[:-1]] = end
    np.add.at(pairs, (before, klass), 1)
    share = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * CLASSES)
    share = (pairs + 5 * share) / (pairs.sum(axis=1, keepdims=True) + 5)
    p["B"] = np.log(share).astype(np.float32)
    p["Bs"] = np.log(share.reshape(CLASSES, SETS, PER).sum(axis=2)).astype(np.float32)
    adam = Adam(p)
    rng = np.random.default_rng(SEED)
    for step in range(1, STEPS + 1):
        pick = rng.integers(0, len(x), BATCH)
        d = gradients(p, x[pick], target[pick].reshape(-1), klass)
        adam.step(d, RATE * min(1.0, step / 50) * (0.5 + 0.5 * math.cos(math.pi * step / STEPS)))
    return p


class Adam:
    def __init__(self, p: dict):
        self.p, self.taken = p, 0
        self.m1, self.m2 = ({k: np.zeros_like(p[k]) for k in weights(p)} for _ in range(2))

    def step(self, d: dict, rate: float):
        self.taken += 1
        for w, m1 in self.m1.items():
            self.m1[w] = m1 = 0.9 * m1 + 0.1 * d[w]
            self.m2[w] = m2 = 0.99 * self.m2[w] + 0.01 * d[w] ** 2
            self.p[w] = self.p[w] - (rate * m1 / (1 - 0.9 ** self.taken)
                                     / (np.sqrt(m2 / (1 - 0.99 ** self.taken)) + 1e-8)).astype(np.float32)


def weights(p: dict) -> list[str]:
    return [k for k in p if k != "end"]


def packed(p: dict) -> np.ndarray:
    return np.concatenate([p[k].reshape(-1) for k in weights(p)])


def train_on(adam: Adam, klass: np.ndarray, n: np.ndarray):
    """Go on training on texts laid end to end; every subword is a target once."""
    _, x, target = _laid_out(klass, n, adam.p["end"], WINDOW)
    order = np.random.default_rng(SEED + adam.taken).permutation(len(x))
    for lo in range(0, len(x), BATCH):
        pick = order[lo:lo + BATCH]
        d = gradients(adam.p, x[pick], target[pick].reshape(-1), klass)
        step = adam.taken + 1
        adam.step(d, LATER * len(pick) / BATCH * min(1.0, step / 50) / math.sqrt(1 + step / 400))


def streams_of(batches):
    """Pieces (ids, subwords per text) of whole texts out of batches with a text's ids (two bytes each, the end last)."""
    for batch in batches:
        data, offsets = column_bytes(batch.column(0))
        ids, at = np.frombuffer(data, "<u2"), offsets // 2
        lo = 0
        while lo < len(batch):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + PIECE, "right")) - 1)
            yield ids[at[lo]:at[hi]].astype(np.int64), np.diff(at[lo:hi + 1])
            lo = hi


def neighbours(streams: DataFrame, klass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the neighbours in all texts; a task adds them up in one array, bounded by the vocabulary."""
    def run(batches):
        total = np.zeros(IDS * 2 * (CLASSES - GROUPS), np.int64)
        for ids, _ in streams_of(batches):
            np.add.at(total, neighbour_codes(klass, np.r_[END_ID, ids[:-1]], ids), 1)
        codes = np.flatnonzero(total)
        for lo in range(0, len(codes), 200_000):
            own = codes[lo:lo + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(total[own])], names=["code", "c"])

    found = (streams.mapInArrow(run, "code int, c long").groupBy("code").agg(F.sum("c").cast("float").alias("c")).toArrow())
    return found.column("code").to_numpy().astype(np.int64), found.column("c").to_numpy()


def train_on_all(streams: DataFrame, p: dict, klass: np.ndarray):
    """Train ``p`` further, in place, on all texts: tasks go on from it, and their mean by subwords takes its place."""
    start = streams.sparkSession.sparkContext.broadcast((p, klass))

    def run(batches):
        from pyspark import TaskContext

        own, klass = start.value
        own, seen = {k: v if k == "end" else v.copy() for k, v in own.items()}, 0
        adam = Adam(own)
        for ids, n in streams_of(batches):
            train_on(adam, klass.take(ids), n)
            seen += len(ids)
        if seen:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "seen": [seen],
                                              "sums": [(packed(own).astype(np.float64) * seen).tobytes()]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        total = np.zeros(len(packed(start.value[0])))
        for v in frame["sums"]:
            total += np.frombuffer(v)
        return pd.DataFrame({"part": [int(frame["part"].iloc[0])], "seen": [int(frame["seen"].sum())], "sums": [total.tobytes()]})

    schema = "part long, seen long, sums binary"
    trained = materialize(streams.mapInArrow(run, schema), "lm-models")          # never trained twice
    rows = sorted(trained.groupBy(F.col("part") % MEANS).applyInPandas(add, schema).collect())
    if rows:
        mean = sum(np.frombuffer(r.sums) for r in rows) / sum(r.seen for r in rows)
        cuts = np.cumsum([p[k].size for k in weights(p)])[:-1]
        p.update({k: v.reshape(p[k].shape).astype(np.float32) for k, v in zip(weights(p), np.split(mean, cuts))})


def text_scores(model: dict, words: Words, texts: list[str]):
    """(words with the end, log10 probability, base of the frequent words, other words) of texts;
    the probability is without the second factor of the other words."""
    ids, n, n_words, inner, base, others = words.stream(texts)
    token = log10_scores(model["p"], model["klass"].take(ids), n)
    return n_words, np.add.reduceat(token, np.cumsum(n) - n) + inner, base, others


def _count_words(batches):
    """Counts of the words in column ``t``, chunk by chunk of its bytes."""
    white, lower = byte_set(b" \t\n\x0b\x0c\r"), np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    for batch in batches:
        data, offsets = column_bytes(batch.column(batch.schema.get_field_index("t")))
        for lo, hi in chunks(data, offsets, white, CHARS):
            starts, ends = spans(data, offsets, white, lo, hi)
            if len(starts):
                found = word_array(lower[data[lo:hi]], starts - lo, ends - lo).value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.binary()), found.field("counts")], names=["word", "c"])


def _spelled(words, encode) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words laid end to end, and ids per word."""
    got = [encode(w.encode()) for w in words]
    return np.array([i for g in got for i in g], np.int64), np.array([len(g) for g in got], np.int64)


def _with_ids(vocabulary: str):
    """A table (word, c) with each word's ids."""
    def run(frames):
        encode = word_encoder(vocabulary)
        for frame in frames:
            if not len(frame):
                continue
            ids, n = _spelled(frame["word"], encode)
            yield pd.DataFrame({"word": frame["word"].to_numpy(), "c": frame["c"].to_numpy(),
                                "ids": np.split(ids.astype(np.int32), np.cumsum(n)[:-1])})
    return run


def _shaped(klass: np.ndarray):
    """A table (word, c, ids) with the key of each word's class sequence in place of its ids."""
    def run(frames):
        for frame in frames:
            if not len(frame):
                continue
            n = frame["ids"].map(len).to_numpy()
            ids = np.concatenate(frame["ids"].to_list()).astype(np.int64)
            yield pd.DataFrame({"word": frame["word"].to_numpy(), "c": frame["c"].to_numpy(), "shape": shapes_of(klass, ids, n)})
    return run


def _id_statistics(frames):
    """Sums over a table (c, ids) of words, by code: single ids (-1 - id) and pairs of neighbouring
    ids within words (before * IDS + id)."""
    for frame in frames:
        if not len(frame):
            continue
        n = frame["ids"].map(len).to_numpy()
        ids = np.concatenate(frame["ids"].to_list()).astype(np.int64)
        each = np.repeat(frame["c"].to_numpy(np.float64), n)
        inside = np.ones(len(ids), bool)
        inside[np.cumsum(n) - n] = False
        codes = np.r_[-1 - ids, (np.r_[0, ids[:-1]] * IDS + ids)[inside]]
        codes, place = np.unique(codes, return_inverse=True)
        sums = np.bincount(place, weights=np.r_[each, each[inside]], minlength=len(codes))
        yield pd.DataFrame({"code": codes, "c": sums.astype(np.int64)})


def _by_class(klass: np.ndarray):
    """Pairs of ids (code, c) as pairs of an id and the class behind it (follow, c)."""
    def run(frames):
        for frame in frames:
            code = frame["code"].to_numpy(np.int64)
            yield pd.DataFrame({"follow": code // IDS * CLASSES + klass[code % IDS], "c": frame["c"]})
    return run


def _places(vocabulary: str, klass: np.ndarray, single: np.ndarray):
    """The ids of words, one row each, with the codes to look up; a word's first id has codes that no table holds."""
    def run(frames):
        encode = word_encoder(vocabulary)
        for frame in frames:
            if not len(frame):
                continue
            ids, n = _spelled(frame["word"], encode)
            first = np.zeros(len(ids), bool)
            first[np.cumsum(n) - n] = True
            before, none = np.r_[0, ids[:-1]], -1 - np.arange(len(ids))
            yield pd.DataFrame({"word": np.repeat(frame["word"].to_numpy(), n), "shape": np.repeat(shapes_of(klass, ids, n), n),
                                "single": single[ids], "code": np.where(first, none, before * IDS + ids),
                                "follow": np.where(first, none, before * CLASSES + klass[ids])})
    return run


class Counted:
    """What all training documents say of words, as Spark tables (the single ids, at most IDS, are an array)."""

    def __init__(self, counts: DataFrame, ends: int, vocabulary: str):
        self.vocabulary = vocabulary
        self.words = materialize(counts.mapInPandas(_with_ids(vocabulary), "word string, c long, ids array<int>"), "lm-words")
        self.found = materialize(self.words.select("c", "ids").mapInPandas(_id_statistics, "code long, c long")
                                 .groupBy("code").agg(F.sum("c").alias("c")), "lm-statistics")
        one = self.found.where("code < 0").toPandas().astype("int64")
        self.total = np.zeros(IDS)
        self.total[-1 - one["code"]] = one["c"]
        self.total[END_ID] += ends

    def classify(self, klass: np.ndarray):
        """Everything that depends on the classes of the ids."""
        self.klass, found = klass, self.found
        self.single = single_shares(self.total, klass)
        self.pairs = found.where("code >= 0").select("code", F.col("c").alias("pair"))
        self.follows = (found.where("code >= 0").mapInPandas(_by_class(klass), "follow long, c long")
                        .groupBy("follow").agg(F.sum("c").alias("followed")))
        words = materialize(self.words.mapInPandas(_shaped(klass), "word string, c long, shape long"), "lm-shaped")
        self.shapes = materialize(words.groupBy("shape").agg(F.sum("c").alias("total"), F.count("*").alias("distinct")), "lm-shapes")
        # (word, c, inner): every word of the training documents with its share of its class sequence
        self.known = materialize(words.select("word", "c", "shape").join(self.shapes, "shape").select(
            "word", "c", F.log10(F.col("c") / (F.col("total") + F.col("distinct"))).alias("inner")), "lm-known")

    def unseen(self, words: DataFrame) -> DataFrame:
        """(word, c = 0, inner) of distinct words that no training document has."""
        share = (F.coalesce("pair", F.lit(0)) + F.lit(BACKING) * F.col("single")) / (F.coalesce("followed", F.lit(0)) + F.lit(BACKING))
        left = F.coalesce(F.col("distinct") / (F.col("total") + F.col("distinct")), F.lit(1.0))
        return (words.mapInPandas(_places(self.vocabulary, self.klass, self.single),
                                  "word string, shape long, single double, code long, follow long")
                .join(self.pairs, "code", "left").join(self.follows, "follow", "left")
                .groupBy("word", "shape").agg(F.sum(F.log10(share)).alias("s")).join(self.shapes, "shape", "left")
                .select("word", F.lit(0).cast("long").alias("c"), (F.col("s") + F.log10(left)).alias("inner")))


def _few(texts: list[str]):
    """The texts in runs of about ``CHARS`` characters."""
    size = np.cumsum([len(t) for t in texts])
    cuts = [0, *(np.flatnonzero(np.diff(size // CHARS)) + 1).tolist(), len(texts)]
    yield from (texts[a:b] for a, b in zip(cuts, cuts[1:]) if b > a)


def _id_streams(vocabulary: str):
    """The ids of each text, two bytes each."""
    def make():
        words = Words(vocabulary)

        def one(frame: pd.DataFrame) -> pd.DataFrame:
            out = []
            for texts in _few(frame["t"].to_list()):
                ids, n, *_ = words.stream(texts)
                out += [x.tobytes() for x in np.split(ids.astype("<u2"), np.cumsum(n)[:-1])]
            return pd.DataFrame({"ids": out})

        return one

    return make


_SCORED = "id long, held_out boolean, n_tokens long, score double, common_base double, others array<binary>"


def score(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    key = F.coalesce(docs[id_col].cast("string"), F.lit("")).cast("binary")
    read = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text], F.lit("")).alias("t"),
                       (F.crc32(key) % 10 == 0).alias("held_out"))
    learned = read.where("not held_out")
    counts = materialize(learned.select("t").mapInArrow(_count_words, "word binary, c long")
                         .groupBy(F.col("word").cast("string").alias("word")).agg(F.sum("c").alias("c")), "lm-counts")
    ends = learned.select("held_out").count()
    facts = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = (facts.n or 0) + ends, facts.v + (1 if ends else 0)

    z = tokens + SMOOTH * (distinct + 1)

    # rows with the smallest hashes; the bound on the hash keeps all but about twice the sample out of the sort
    bound = -(1 << 63) + min((1 << 64) - 1, (1 << 64) * 2 * SAMPLE // max(1, ends))
    sample = [r.t for r in learned.where(F.coalesce(F.xxhash64("id"), F.lit(0)) <= F.lit(bound))
              .orderBy(F.xxhash64("id"), "id", F.xxhash64("t"), "t").limit(SAMPLE).select("t").collect()]
    ids, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if sample:
        ids, n, *_ = Words(vocabulary).stream(sample)
    counted = Counted(counts, ends, vocabulary)
    streams = materialize(map_slices(learned.select("t"), _id_streams(vocabulary), "ids binary"), "lm-ids")
    klass = classes_of(counted.total, neighbours(streams, own_classes(counted.total)), starting_ids(vocabulary))
    counted.classify(klass)
    p = train(klass[ids], n, int(klass[END_ID]))
    train_on_all(streams, p, klass)
    frequent = counted.known.where(F.col("c") * FREQUENT > tokens)          # fewer than FREQUENT words
    model = spark.sparkContext.broadcast({
        "p": p, "klass": klass, "single": counted.single, "z": z,
        "frequent": {r.word.encode(): (r.c, r.inner) for r in frequent.collect()}})

    def make():
        words = Words(vocabulary, model.value)

        def one(frame: pd.DataFrame) -> pd.DataFrame:
            got = [text_scores(model.value, words, texts) for texts in _few(frame["t"].to_list())]
            return pd.DataFrame({"id": frame["id"], "held_out": frame["held_out"],
                                 **{name: np.concatenate([g[k] for g in got]) for k, name in
                                    enumerate(("n_tokens", "score", "common_base"))},
                                 "others": [words for g in got for words in g[3]]})

        return one

    scored = materialize(map_slices(read.select("id", "t", "held_out"), make, _SCORED)
                         .withColumn("row", F.monotonically_increasing_id()), "lm-scores")

    # base and second factor of all other words: by a shuffle, against a hash table of each partition's words;
    # only held-out documents have words that were not counted
    each = scored.select("row", F.explode(F.col("others").cast("array<string>")).alias("word"))
    new = (scored.where("held_out").select(F.explode(F.col("others").cast("array<string>")).alias("word")).distinct()
           .join(counted.known.select("word"), "word", "left_anti"))
    lexicon = counted.known.unionByName(materialize(counted.unseen(new), "lm-unseen"))
    sums = (each.join(lexicon.hint("shuffle_hash"), "word", "left").groupBy("row")
            .agg(F.sum(F.log10((F.col("c") + SMOOTH) / F.lit(z))).alias("s"), F.sum("inner").alias("inner"),
                 F.sum((F.col("c") > 0).cast("long")).alias("known")))
    end = math.log10((ends + SMOOTH) / z) if z else 0.0
    common = F.col("n_tokens") - 1 - F.size("others")
    zero = F.lit(0.0)
    return (scored.withColumn("common", common).drop("others").join(sums, "row", "left")
            .select(F.col("id").alias(id_col), "held_out", "n_tokens",
                    (F.coalesce(F.col("known"), F.lit(0)) + F.col("common") + (1 if ends else 0)).cast("long").alias("n_known"),
                    F.lit(tokens).cast("long").alias("train_tokens"),
                    (F.coalesce(F.col("s"), zero) + F.col("common_base") + F.lit(end)).alias("base_score"),
                    (F.col("score") + F.coalesce(F.col("inner"), zero)).alias("score")))
