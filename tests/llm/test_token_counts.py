"""Token counts: against the library on whole texts, at every boundary, for every kind of vocabulary."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewater.llm import byte_words as b
from tidewater.llm import token_counts as m

WORDS = Tokenizer.from_file(public_tokenizers.path(m.VOCABULARY))
LENGTHS = m.batch_lengths(public_tokenizers.path(m.VOCABULARY))
ODD = ["", " ", "\t\n\x0b\x0c\r ", "don't can 't I'LL we 'Ve", "a<|endoftext|>b <|startoftext|> <|END", "é ́x à́ ̇",
       "İstanbul ΣΣ ẞ", "x y z\u0085w　v​u﻿", "12 345,6.78 --- ...!?", "\U0001f600\U0001f468‍\U0001f469 가가",
       "\x00\x1c\x1d\x1e\x1f a\x1cb", "word " * 3000, "x" * 20000, "中文" * 300, None]


def whole(texts):
    return [len(WORDS.encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_odd_texts_at_any_chunk_size(size):
    got = m.counts_by_words(pa.array(ODD, pa.string()), m.WordLengths(LENGTHS), size)
    assert got.tolist() == whole(ODD)


PIECE = st.sampled_from([" ", "\t", "\n", "\x0b", "\x0c", "\r", " ", "\u0085", "'", "'s", "'LL", "a", "Ab", "1", "́", "̇", "İ",
                         "Σ", "<|endoftext|>", "<|", "!", " ", "ß", "가", "ᆨ", "\x1c", "᠎", "​"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECE, st.characters(exclude_categories=["Cs"])), max_size=30).map("".join), st.integers(1, 12))
def test_white_space_is_a_safe_boundary(text, size):
    got = m.counts_by_words(pa.array([text, "x", text], pa.string()), m.WordLengths(LENGTHS), size)
    assert got.tolist() == whole([text, "x", text])


def test_a_slice_of_a_column_and_a_full_store():
    column = pa.array(ODD * 2, pa.string()).slice(3, 15)
    got = m.counts_by_words(column, m.WordLengths(LENGTHS, known=3), 50)
    assert got.tolist() == whole((ODD * 2)[3:18])


def test_chunks_cover_all_bytes_and_cut_no_word():
    texts = ["aa bb", "", "c" * 100, "d d d d d d"]
    data, offsets = b.column_bytes(pa.array(texts))
    for size in range(1, 120):
        cuts = list(b.chunks(data, offsets, b.byte_set(b" "), size))
        assert [lo for lo, _ in cuts] == [0, *[hi for _, hi in cuts[:-1]]] and cuts[-1][1] == len(data)
        words = [w for lo, hi in cuts for w in b.word_array(data, *b.spans(data, offsets, b.byte_set(b" "), lo, hi)).to_pylist()]
        assert words == [w.encode() for t in texts for w in t.split()]


def test_which_vocabularies_have_a_safe_boundary():
    names = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]
    assert [m.drops_white_space(public_tokenizers.path(n)) for n in names] == [True, False, False]


@pytest.mark.parametrize("vocabulary", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_table(spark, vocabulary):
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)] + [(None, "no id", "x", 1), (3, ODD[3], "x", 2), (3, ODD[3], "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_tokens string, t int")
    got = m.count_tokens(docs, vocabulary, limit=100, carry=("t",)).collect()
    path = public_tokenizers.path(vocabulary)
    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        each = {t: len(model.encode(t or "")) for _, t, _, _ in rows}
    else:
        model = Tokenizer.from_file(path)
        each = {t: len(model.encode(t or "", add_special_tokens=False).ids) for _, t, _, _ in rows}
    want = [(i, len((t or "").encode()), each[t], each[t] > 100, k) for i, t, _, k in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[4])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_given_documents_and_an_empty_table(spark):
    from tidewater.llm.queries import queries

    out = queries()["op11_token_counts"](spark, "/root/testdata/sf0.001")
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in out.collect()}
    assert got == dict(zip(texts, whole(texts.values())))
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert m.count_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert np.all([r.over_limit == (r.n_tokens > 2048) for r in out.collect()])
