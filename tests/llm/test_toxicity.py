"""Toxicity chain: held-out accuracy, chain features, edges."""

import random

import numpy as np

from tidewater.llm import toxicity as x


def texts(n, seed=1):
    rng = random.Random(seed)
    plain = [f"w{chr(97 + a)}{chr(97 + b)}{chr(97 + c)}" for a in range(6) for b in range(6) for c in range(6)]
    out = []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.choice([8, 40, 150]))]
        toxic = rng.random() < 0.25
        if toxic:
            for k in range(rng.choice([1, 2, 4])):
                bad = rng.choice(["idiot", "moron", "pathetic", "trash", "zorb" + rng.choice(["al", "en", "ik", "os"])])
                w.insert(rng.randrange(len(w)), bad.upper() + "!!" if k else bad)
        out.append((i, " ".join(w), int(toxic)))
    return out


def test_held_out_accuracy(spark):
    rows = texts(1600)
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, p_toxic double").repartition(4)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i < 1000], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in x.predict(docs, labels).collect()}
    held = [(got[i].toxic, bool(y)) for i, _, y in rows if i >= 1000]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert sum(a and not b for a, b in held) <= 3
    name = [r for r in got.values() if "idiot" in x.words(rows[r.doc_id][1])]
    assert np.mean([r.p_insult > 0.5 for r in name]) > 0.9


def test_later_models_see_earlier_probabilities(spark):
    rows = texts(400, seed=2)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    vocabulary, chain = x.train(docs, labels)
    assert [len(v) for _, v, _ in chain] == [0, 1, 2] and "idiot" in vocabulary and "zorb-" in vocabulary


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "you idiot"), (3, "idiot " * 30000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    got = x.predict(docs, labels).collect()
    assert len(got) == 5 and not any(r.toxic for r in got) and all(r.p_toxic < 0.01 for r in got)
    assert x.predict(docs.limit(0), labels.limit(0)).count() == 0
