"""Best-fit packing of token sequences by length patterns (operator 5).

1. Tokenise every text once, in tasks; cut documents longer than the capacity
   (the first piece takes the remainder); keep one small row per piece.
2. The histogram of piece lengths (at most ``capacity`` rows) goes to the driver.
3. Pattern packing: patterns of one to three documents whose lengths fill a
   sequence are enumerated; non-negative least squares fits how often each
   pattern repeats so that together they use the histogram; counts are rounded
   down and never exceed what is left.  The residual lengths are packed best-fit
   decreasing, still by length and count, never by document.
4. The plan is a table of (length, first rank, last rank, sequence, offset) spans
   whose size is bounded by the capacity; pieces get a rank within their length
   (counted in two levels, so a hot length is spread) and join the plan.

Defined results: a null text is packed like an empty one, its only id is the end
id.  Repeated rows are packed repeatedly.  An empty table gives an empty result.
A null id is carried through.  Only the id and the text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_slices, materialize, numbered

CAPACITY = 1024
END_ID = 2
MAX_PATTERNS = 6000      # patterns that the least squares choose from (all lengths take part in some)
NNLS_STEPS = 300
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def encoder(vocabulary: str):
    """``text -> uint32 ids`` of a byte-level BPE vocabulary file (``*_50k.json`` of the public tokenizers).

    The same vocabulary's rank file gives the same ids several times faster; a
    text that it cannot take is encoded by the tokenizer file itself.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = public_tokenizers.path(vocabulary)
    exact = Tokenizer.from_file(path)
    exact.encode_special_tokens = True       # their strings in a text are ordinary text
    with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        try:
            return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), np.uint32)
        except BaseException as e:           # the rank encoder's panics are no Exceptions
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
            return np.asarray(exact.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole capacity each, but the first takes the remainder."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per piece of each document; the ids themselves stay in the task, their checksum is kept."""
    def make():
        encode = encoder(vocabulary)

        def one(frame: pd.DataFrame) -> pd.DataFrame:
            out = []
            for who, t in zip(frame["doc_id"], frame["t"]):
                ids = np.append(encode(t), np.uint32(END_ID)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    out.append((who, k, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            got = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            got["doc_id"] = pd.array(got["doc_id"], dtype="Int64")
            return got

        return one

    read = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("t"))
    return map_slices(read, make, PIECES)


def patterns(left: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Few-document patterns (lengths, descending) that fill a sequence, from the lengths that occur.

    Exact pairs first; then for each length the exact triples whose two smaller
    parts are spread evenly; where neither exists, the fullest pair.
    """
    have = np.flatnonzero(left)
    have = have[have < capacity]
    present = np.zeros(capacity + 1, bool)
    present[have] = True
    found: dict[tuple[int, ...], None] = {}
    per_length = max(4, MAX_PATTERNS // max(1, len(have)))
    for a in have[::-1]:
        rest = capacity - a
        if present[rest]:
            found[tuple(sorted((int(a), int(rest)), reverse=True))] = None
        seconds = have[(have <= a) & (have < rest) & (have >= rest - have)]
        seconds = seconds[present[rest - seconds]]
        if len(seconds):
            for b in seconds[np.linspace(0, len(seconds) - 1, min(per_length, len(seconds))).astype(int)]:
                found[tuple(sorted((int(a), int(b), int(rest - b)), reverse=True))] = None
        elif not present[rest]:
            below = have[have <= rest]
            if len(below):
                found[tuple(sorted((int(a), int(below[-1])), reverse=True))] = None
    return list(found)


def fit_counts(pats: list[tuple[int, ...]], left: np.ndarray) -> np.ndarray:
    """How often each pattern repeats: min ||A x - histogram|| over x >= 0.

    Accelerated projected gradient on the normal equations; columns are sparse
    (three entries at most), so a step costs a few additions per pattern.
    """
    if not pats:
        return np.zeros(0)
    rows = np.array([n for p in pats for n in p])
    cols = np.array([k for k, p in enumerate(pats) for _ in p])
    want = left.astype(float)
    step = 1.0 / (np.bincount(rows, minlength=len(left)).max() * 3.0)
    x = np.zeros(len(pats))
    y, t = x, 1.0
    for _ in range(NNLS_STEPS):
        miss = np.bincount(rows, weights=y[cols], minlength=len(left)) - want
        new = np.maximum(0.0, y - step * np.bincount(cols, weights=miss[rows], minlength=len(pats)))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Spans (length, lo, hi, first_sequence, offset): ranks lo..hi-1 of a length go to consecutive sequences."""
    left = np.zeros(capacity + 1, np.int64)
    for n, c in histogram.items():
        left[n] = c
    used = np.zeros(capacity + 1, np.int64)
    spans, sequence = [], 0

    def place(lengths, times):
        nonlocal sequence
        offset = 0
        for n in lengths:
            spans.append((n, used[n], used[n] + times, sequence, offset))
            used[n] += times
            left[n] -= times
            offset += n
        sequence += times

    def times_left(lengths):
        need = np.bincount(lengths)
        return int(min(left[n] // need[n] for n in set(lengths)))

    if left[capacity]:
        place((capacity,), int(left[capacity]))
    pats = patterns(left, capacity)
    counts = np.floor(fit_counts(pats, left) + 1e-6).astype(np.int64)
    full = [sum(p) == capacity for p in pats]
    for k in sorted(range(len(pats)), key=lambda k: (not full[k], -counts[k])):
        times = min(int(counts[k]), times_left(pats[k])) if full[k] else 0
        if times > 0:
            place(pats[k], times)
    # residual: best fit by length; the largest length left opens a sequence, the largest that fits joins it
    while left.any():
        lengths, room = [], capacity
        spare = left.copy()
        while True:
            fits = np.flatnonzero(spare[:room + 1])
            if not len(fits):
                break
            n = _best(spare, fits, room)
            lengths.append(n)
            spare[n] -= 1
            room -= n
        place(tuple(lengths), max(1, times_left(lengths)))
    return pd.DataFrame(spans, columns=["length", "lo", "hi", "sequence", "offset"]).astype("int64")


def _best(spare: np.ndarray, fits: np.ndarray, room: int) -> int:
    """The largest length that fits, unless two lengths fill the room exactly and it does not."""
    top = int(fits[-1])
    if top == room or room == len(spare) - 1:
        return top
    pair = fits[(fits * 2 >= room) & (spare[room - fits] > 0)]
    for n in pair[::-1]:
        if n * 2 != room or spare[n] > 1:
            return int(n)
    return top


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY,
         id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut_up = materialize(pieces(docs, vocabulary, capacity, id_col, text)
                         .withColumn("key", F.struct("doc_id", "piece", F.monotonically_increasing_id().alias("row"))),
                         "packing-pieces")
    histogram = {r.length: r.c for r in cut_up.groupBy("length").agg(F.count("*").alias("c")).collect()}
    spans = spark.createDataFrame(plan(histogram, capacity),
                                  "length long, lo long, hi long, sequence long, offset long")
    ranked = numbered(cut_up, "length", "key", "rank")
    s = F.broadcast(spans.withColumnRenamed("length", "span_length"))   # bounded by the capacity, not by the data
    return (ranked.join(s, (F.col("length") == F.col("span_length")) & (F.col("rank") >= F.col("lo"))
                        & (F.col("rank") < F.col("hi")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("sequence") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset"))
