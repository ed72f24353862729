"""Token counts by batch encoding in Arrow functions (operator 11).

Only lengths leave the task.  The texts of an Arrow batch are taken in chunks balanced by
bytes (``CHUNK``), not by rows, so a task's memory does not depend on how long a text is;
a text over that size is split at a safe boundary.

A boundary is safe when the library counts the two sides as it counts the whole.  The word
vocabularies drop white space before they look for words, and none of their patterns
takes white space in, so a run of ASCII white space is one.  There every word is a piece
of its own, a chunk's different words are encoded in one batch, and a text's count is the
sum over its words.  Counts of words that a task has seen are kept up to ``KNOWN`` words.
Vocabularies whose tokens take the space in (byte level, sentence pieces) have no such
boundary; their texts are encoded whole, in batches of about ``CHUNK`` bytes.

Defined results: a null text counts as empty and has no bytes and no tokens.  Bytes that
are no UTF-8 are encoded as the replacement character.  Special strings inside a text are
what the library makes of them by default.  Repeated rows and null ids are counted like
any other.  An empty table gives an empty result.  Only the id and the text are read, and
the columns named in ``carry``.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.byte_words import byte_set, chunks, column_bytes, spans, word_array

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 4 << 20          # bytes of text that are split or encoded at once
KNOWN = 400_000          # different words whose counts a task keeps
WHITE = b" \t\n\x0b\x0c\r"


def drops_white_space(path: str) -> bool:
    """Does the vocabulary file keep only matches of a word pattern, all white space left out?"""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        rule = json.load(f).get("pre_tokenizer") or {}
    first = (rule.get("pretokenizers") or [rule])[0]
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True


def batch_lengths(path: str):
    """``texts -> number of tokens of each`` by the library of the vocabulary file."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: np.fromiter(map(len, model.encode(texts, num_threads=1)), np.int64, len(texts))
    os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark runs a task per core already
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: np.fromiter(
        map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False)), np.int64, len(texts))


def _decoded(values: pa.Array) -> list[str]:
    return [v.decode("utf-8", "replace") for v in values.to_pylist()]


class WordLengths:
    """Token counts of words; those seen before are looked up, new ones encoded in one batch."""

    def __init__(self, lengths, known: int = KNOWN):
        self.lengths, self.most = lengths, known
        self._forget()

    def _forget(self):
        self.words, self.counts = pa.array([], pa.large_binary()), np.empty(0, np.int64)

    def __call__(self, words: pa.Array) -> np.ndarray:
        place = pc.index_in(words, value_set=self.words)
        new = words.filter(place.is_null())
        if len(new):
            if len(self.words) + len(new) > self.most:
                self._forget()
                new = words
            self.words = pa.concat_arrays([self.words, new])
            self.counts = np.concatenate([self.counts, self.lengths(_decoded(new))])
            place = pc.index_in(words, value_set=self.words)
        return self.counts[place.to_numpy()]


def counts_by_words(column: pa.Array, lengths: WordLengths, size: int = CHUNK) -> np.ndarray:
    """Tokens of each text, summed over its words."""
    data, offsets = column_bytes(column)
    white, total = byte_set(WHITE), np.zeros(len(column), np.int64)
    for lo, hi in chunks(data, offsets, white, size):
        starts, ends = spans(data, offsets, white, lo, hi)
        if not len(starts):
            continue
        coded = word_array(data, starts, ends).dictionary_encode()
        each = lengths(coded.dictionary)[coded.indices.to_numpy()]
        before = np.concatenate([[0], np.cumsum(each)])
        first = np.searchsorted(offsets, starts[0], "right") - 1      # text of the first word
        edge = np.searchsorted(starts, offsets[first:np.searchsorted(offsets, hi, "left") + 1])
        edge[-1] = len(starts)
        total[first:first + len(edge) - 1] += np.diff(before[edge])
    return total


def counts_by_texts(column: pa.Array, lengths, size: int = CHUNK) -> np.ndarray:
    """Tokens of each text, encoded whole in batches of about ``size`` bytes."""
    data, offsets = column_bytes(column)
    total, lo = np.zeros(len(column), np.int64), 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        total[lo:hi] = lengths([data[a:b].tobytes().decode("utf-8", "replace")
                                for a, b in zip(offsets[lo:hi], offsets[lo + 1:hi + 1])])
        lo = hi
    return total


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, id_col: str = "doc_id",
                 text: str = "text", carry: tuple[str, ...] = (), by_words: bool | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit, then the columns in ``carry``.

    ``by_words`` says whether white space is a safe boundary of the vocabulary; by
    default its file decides.
    """
    results = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    if set(carry) & set(results):
        raise ValueError(f"carried columns are named like results: {sorted(set(carry) & set(results))}")
    read = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text].alias("_text"),
                       *[docs[c].alias(f"_carry_{i}") for i, c in enumerate(carry)])
    kept = [f for f in read.schema.fields if f.name != "_text"]
    schema = T.StructType([kept[0], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), *kept[1:]])

    def run(batches):
        import public_tokenizers

        path = public_tokenizers.path(vocabulary)
        lengths, count = batch_lengths(path), counts_by_texts
        if drops_white_space(path) if by_words is None else by_words:
            lengths, count = WordLengths(lengths), counts_by_words
        for batch in batches:
            offsets = column_bytes(batch.column(1))[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(count(batch.column(1), lengths)),
                 *batch.columns[2:]], names=schema.names)

    counted = read.mapInArrow(run, schema)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
                          *[F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)])
