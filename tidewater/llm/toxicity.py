"""Toxicity by a classifier chain (operator 4).

Categories are predicted one after the other; each later linear model sees the
words of a text (and their beginnings) and the probabilities of the earlier categories.  While training,
those probabilities are out-of-fold predictions (``FOLDS`` folds by a hash of the
id), so a later model learns how far to trust an earlier one on unseen texts.

* Labels give toxic 0 / 1.  The categories before it in the chain are kinds of
  abuse: a toxic text that holds a name for a person, or a demeaning word.  The
  last category is the label itself, in every language.
* Models are fitted on a bounded, documented sample: at most ``SAMPLE`` toxic and
  ``SAMPLE`` other labelled documents, those with the smallest hashes of the id.
  Their whole texts are reduced to distinct words in tasks; Spark counts on how
  many texts of either side each word occurs (copies of a text count once), and
  the words that stand out are the vocabulary.  Only hits on it reach the driver.
* Scoring reads all documents in one narrow pass without a shuffle.

Defined results: null, empty and word-free texts get the models' base rates and
are not toxic.  A document labelled twice counts with its largest label.  Without
labels of both kinds there is nothing to learn: probabilities are 0.  Repeated
rows are scored alike.  A null id is carried through.  Only the id and the text
of the documents and the id and ``toxic`` of the labels are read.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_slices, materialize

SAMPLE = 3000            # labelled documents of either side, at most
FOLDS = 5
VOCABULARY = 1500        # features, at most
PREFIXES = (4, 5, 6)     # first letters of words that are features beside the words themselves
MIN_SHARE = 0.006        # of the toxic sample must hold a feature of the vocabulary (and MIN_DOCS documents)
MIN_DOCS = 3
MIN_Z = 4.0              # standard deviations of the log odds
MIN_ODDS = 2.0           # log odds
RIDGE, STEPS = 0.3, 200
CUT = 0.5
# fixed word lists that name the kinds of abuse
KINDS = (("insult", ("idiot", "moron", "clown", "loser", "scum", "fool", "imbecile", "jerk")),
         ("demeaning", ("pathetic", "worthless", "disgusting", "stupid", "trash", "useless", "garbage", "dumb")))
CATEGORIES = tuple(k for k, _ in KINDS) + ("toxic",)

_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    """Distinct words of a text, and their beginnings (written with a dash)."""
    found = set(_LETTERS.findall((text or "").lower()))
    for k in PREFIXES:
        found |= {w[:k] + "-" for w in found if len(w) > k and w[-1] != "-"}
    return found


def choose_vocabulary(bags: DataFrame) -> list[str]:
    """Words whose log odds between toxic and other texts stand out, strongest first.  ``bags``: id, toxic, bag."""
    unlike = bags.groupBy(F.xxhash64("bag"), F.size("bag"), "toxic").agg(F.first("bag").alias("bag"))
    sides = unlike.agg(F.sum("toxic").alias("n1"), F.count("*").alias("n")).first()
    n1, n0 = float(sides.n1 or 0), float(sides.n - (sides.n1 or 0))
    if not n1 or not n0:
        return []
    counts = (unlike.select("toxic", F.explode("bag").alias("word")).groupBy("word")
              .agg(F.sum("toxic").cast("double").alias("c1"), F.sum(1 - F.col("toxic")).cast("double").alias("c0")))
    odds = F.log((F.col("c1") + 0.5) / (n1 + 0.5 - F.col("c1"))) - F.log((F.col("c0") + 0.5) / (n0 + 0.5 - F.col("c0")))
    z = F.col("odds") / F.sqrt(1 / (F.col("c1") + 0.5) + 1 / (F.col("c0") + 0.5))
    seeds = [x for _, ws in KINDS for x in ws]
    found = (counts.where(F.col("c1") >= max(MIN_DOCS, math.ceil(MIN_SHARE * n1)))
             .withColumn("odds", odds).withColumn("z", z)
             .where((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_ODDS) | F.col("word").isin(seeds))
             .orderBy(F.desc("z"), "word").limit(VOCABULARY).collect())
    return [r.word for r in found]


def logistic(rows: np.ndarray, cols: np.ndarray, dense: np.ndarray, y: np.ndarray, width: int):
    """Ridge logistic regression on sparse 0 / 1 columns (rows[i] holds cols[i]) and dense columns."""
    n, k = len(y), dense.shape[1]
    w, v, b = np.zeros(width), np.zeros(k), 0.0
    if n == 0 or y.min() == y.max():
        rate = float(y.mean()) if n else 0.0
        return w, v, math.log((rate * n + 0.01) / ((1 - rate) * n + 0.01)) if n else -20.0
    weight = np.sqrt(np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())))     # the rarer side weighs more
    mw, mv, mb = w, v, b
    sparse_size = np.bincount(rows, minlength=n).max() if len(rows) else 0
    step = 4.0 / (sparse_size + (dense ** 2).sum(axis=1).max(initial=0) + 1 + RIDGE / n)
    step /= max(1.0, weight.max() / 4)
    t = 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, weights=mw[cols], minlength=n) + dense @ mv + mb, -40, 40)))
        g = (p - y) * weight
        nw = mw - step * (np.bincount(cols, weights=g[rows], minlength=width) / n + RIDGE / n * mw)
        nv = mv - step * (dense.T @ g / n + RIDGE / n * mv)
        nb = mb - step * g.mean()
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        a = (t - 1) / t2
        mw, mv, mb = nw + a * (nw - w), nv + a * (nv - v), nb + a * (nb - b)
        w, v, b, t = nw, nv, nb, t2
    return w, v, b


def fit_chain(ids: list, bags: list[set[str]], toxic: np.ndarray, vocabulary: list[str]):
    """(word weights, chain weights, bias) per category, from the texts' words (at least those of the vocabulary)."""
    place = {w: k for k, w in enumerate(vocabulary)}
    rows = np.array([i for i, bag in enumerate(bags) for w in bag if w in place], np.int64)
    cols = np.array([place[w] for bag in bags for w in bag if w in place], np.int64)
    fold = np.array([zlib.crc32(str(i).encode()) % FOLDS for i in ids], np.int64)
    labels = [np.array([float(t and not bag.isdisjoint(seeds)) for bag, t in zip(bags, toxic)]) for _, seeds in KINDS]
    labels.append(toxic.astype(float))
    chain, earlier = [], np.zeros((len(bags), 0))
    for y in labels:
        chain.append(logistic(rows, cols, earlier, y, len(vocabulary)))
        out = np.zeros(len(bags))
        for f in range(FOLDS):
            use = fold != f
            new = np.cumsum(use) - 1
            mine = use[rows] if len(rows) else np.zeros(0, bool)
            w, v, b = logistic(new[rows[mine]], cols[mine], earlier[use], y[use], len(vocabulary))
            raw = np.bincount(rows, weights=w[cols], minlength=len(bags)) + earlier @ v + b if len(rows) else earlier @ v + b
            out[~use] = 1 / (1 + np.exp(-np.clip(raw, -40, 40)))[~use]
        earlier = np.column_stack([earlier, out])
    return chain


def score(bag: set[str], place: dict[str, int], chain) -> list[float]:
    """Probabilities of all categories for one text's words."""
    hits = [place[w] for w in bag if w in place]
    out: list[float] = []
    for w, v, b in chain:
        raw = sum(w[k] for k in hits) + sum(x * y for x, y in zip(v, out)) + b
        out.append(1 / (1 + math.exp(-max(-40.0, min(40.0, raw)))))
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text"):
    """(vocabulary, chain) fitted on the bounded sample; hits of 2 * SAMPLE texts at most reach the driver."""
    per_doc = (labels.where(labels[id_col].isNotNull() & labels["toxic"].isNotNull())
               .groupBy(labels[id_col].cast("long").alias("id")).agg(F.max("toxic").alias("toxic")))
    sides = [per_doc.where(F.col("toxic") > 0), per_doc.where(F.col("toxic") <= 0)]
    ids = [s.orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for s in sides]
    chosen = ids[0].unionByName(ids[1])

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": frame["id"], "toxic": frame["toxic"], "bag": [sorted(words(t)) for t in frame["t"]]})

    read = docs.select(docs[id_col].cast("long").alias("id"), docs[text].alias("t"))
    picked = read.join(F.broadcast(chosen), "id").select("id", F.col("toxic").cast("long").alias("toxic"), "t")   # at most 2 * SAMPLE ids
    bags = materialize(map_slices(picked, lambda: one, "id long, toxic long, bag array<string>").dropDuplicates(["id"]),
                       "toxicity-bags")
    vocabulary = choose_vocabulary(bags)
    known = F.array(*[F.lit(w) for w in [*vocabulary, *[x for _, ws in KINDS for x in ws]]])
    got = bags.select("id", "toxic", F.array_intersect("bag", known).alias("hits")).orderBy("id").toPandas()
    return vocabulary, fit_chain(got["id"].to_list(), [set(b) for b in got["hits"]],
                                 (got["toxic"].to_numpy() > 0).astype(np.int64), vocabulary)


def predict(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id_col``, one probability per category, toxic."""
    vocabulary, chain = train(docs, labels, id_col, text)
    place = {w: k for k, w in enumerate(vocabulary)}
    chain = [(w.tolist(), v.tolist(), float(b)) for w, v, b in chain]
    names = [f"p_{c}" for c in CATEGORIES]
    read = docs.select(docs[id_col].alias("doc_id"), docs[text].alias("t"))
    kind = read.schema["doc_id"].dataType.simpleString()

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        p = np.array([score(words(t), place, chain) for t in frame["t"]]).reshape(len(frame), len(names))
        return pd.DataFrame({"doc_id": frame["doc_id"], **{n: p[:, k].round(6) for k, n in enumerate(names)},
                             "toxic": p[:, -1] >= CUT})

    out = map_slices(read, lambda: one, f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names) + ", toxic boolean")
    return out.withColumnRenamed("doc_id", id_col)
