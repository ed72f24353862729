"""The pipeline on a small folder, against the stages done by brute force."""

import zlib

import numpy as np
import pytest

import corpus_pipeline as cp
from test_ngram_join import brute as classes, short_texts_with_common_lines, written
from tidewater.llm import mixing, packing, quality_rules, secret_scan

HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


def documents():
    rng = np.random.default_rng(8)
    bank = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(60):
        w = rng.choice(bank, int(rng.integers(15, 120)))
        rows.append((i, " ".join(w) + "." + (f' token = "{HEX}" end' if i % 6 == 0 else ""), ["en", "fr"][i % 2], f"s{i % 3}"))
    rows += [(100 + k, rows[k][1], "en", "s0") for k in range(10)]                               # copies
    rows += [(200 + k, rows[40 + k][1] + " tail", "en", "s1") for k in range(10)]               # near copies
    rows += [(300, None, "en", "s0"), (301, "", None, None), (302, "Home | About | Help | " * 5, "en", "s0"), (303, "short", "en", "s1"),
             (None, "a document without an id that has enough words to stay in the corpus", "en", "s2")]
    return [(*r, len(r[1] or ""), "extra") for r in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(documents(), SCHEMA).repartition(3).write.parquet(f"{base}/documents.parquet")
    return base


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one = cp.quality(spark, docs, folder)
    assert one.columns == docs.columns
    judged = {r[0]: quality_rules.judge(r[1]) for r in documents()}
    kept = {r.doc_id: r for r in one.collect()}
    assert set(kept) == {i for i, j in judged.items() if j[6]}
    assert all(r.text == judged[i][-1] and r.n_chars == len(r.text) and r.kept == "extra" for i, r in kept.items())
    two = cp.ngrams(spark, spark.createDataFrame(one.collect(), one.schema), folder)
    stay = {i for i, _, c in classes([(i, r.text) for i, r in kept.items()]) if c == i}
    assert {r.doc_id for r in two.collect()} == stay and len(stay) < len(kept)
    three = cp.secrets(spark, spark.createDataFrame(two.collect(), two.schema), folder).collect()
    assert len(three) == len(stay) and all(r.text == kept[r.doc_id].text.replace(HEX, secret_scan.MARK) for r in three)
    assert any(secret_scan.MARK in r.text for r in three)
    frame = spark.createDataFrame(three, two.schema)
    four = {r.doc_id for r in cp.mix(spark, frame, folder).collect()}
    assert four == {r.doc_id for r in mixing.mix(frame).where("sampled").collect()} and four <= stay


def test_run_packs_what_the_stages_leave(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    encode = packing.encoder("byte_bpe_50k.json")
    want = []
    for r in docs.collect():
        ids = np.append(encode(r.text), np.uint32(2)).astype("<u4")
        want += [(r.doc_id, k, start, n, zlib.crc32(ids[start:start + n].tobytes())) for k, (start, n) in enumerate(packing.cut(len(ids), 1024))]
    key = lambda r: (r[0] is None, r)
    assert sorted([tuple(r)[:5] for r in cp.run(spark, folder).collect()], key=key) == sorted(want, key=key)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("stage", [cp.quality, cp.ngrams, cp.pack])
def test_stages_hand_small_batches_to_python(spark, folder, stage):
    rows = spark.conf.get(cp._BATCH)
    try:
        stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        many = spark.range(0, 4000, 1, 1).mapInArrow(lambda batches: batches, "id long")
        sizes = many.mapInPandas(lambda frames: (f.head(1).assign(id=len(f)) for f in frames), "id long").collect()
        assert sum(r.id for r in sizes) == 4000 and max(r.id for r in sizes) <= cp.BATCH_ROWS
        spark.conf.set(cp._BATCH, 100)                  # smaller ones stay
        cp._bound_batches(spark)
        assert spark.conf.get(cp._BATCH) == "100"
    finally:
        spark.conf.set(cp._BATCH, rows)


def test_run_puts_the_sessions_batches_back(spark, folder):
    rows = spark.conf.get(cp._BATCH)
    cp.run(spark, folder)
    assert spark.conf.get(cp._BATCH) == rows


def test_common_lines_do_not_run_short_texts_together(spark, folder, monkeypatch):
    counts, rows = {}, spark.conf.get(cp._BATCH)
    written(monkeypatch, counts)
    texts = short_texts_with_common_lines()
    try:
        left = cp.ngrams(spark, spark.createDataFrame([(i, t, "en", "s0", len(t), "extra") for i, t in texts], SCHEMA), folder)
        assert {r.doc_id for r in left.collect()} == {i for i, _ in texts} - {500, 501}
    finally:
        spark.conf.set(cp._BATCH, rows)
    assert counts["ngram-cells"] == 4
