"""Phrase collocations from count streams in prefix and suffix order (operator 12).

1. A task takes texts of one language up to ``CHUNK`` bytes and finds words and pieces on
   the bytes.  Each word opens a window: itself and the next two words of its piece.  The
   windows are sorted and equal ones counted, which makes a sorted run in prefix order.
2. Runs are cut at places that split all windows into ranges of about ``RANGE_WINDOWS``
   (from the sorted windows of some texts, like a range partitioning), and a range's
   slices of all runs meet in one task, which merges them.  Windows in prefix order hold
   the counts of every order: those of a word or a pair are the sum over the windows that
   begin with it.  The first and last word and pair of a range may go on in another one,
   so their counts are partial, kept in any case and added up by Spark.
3. The counts of at least ``min_count`` are written as streams of each order.  They are
   sorted by their first words (prefix order) to find what precedes a cut and how often
   the phrase goes on to the right, and by their last words (suffix order) for what
   follows a cut and extensions to the left.  All of these are merge joins of two sorted
   streams, hinted as such; Spark splits a stream where one word is hot.

Nothing is pruned before its count is complete, and no vocabulary, table of counts or
list of phrases is held for the whole corpus in one place.  What is broadcast is the list
of cuts: ``MAX_RANGES`` at most, beyond which ranges grow instead.

Defined results: a null text is empty and has no words; a null language is ``und``.  Extra
columns are not read.  Repeated rows count repeatedly.  Equal scores are ordered by count,
then by the phrase's bytes.  An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.byte_words import byte_set, column_bytes, next_cut, spans, word_array
from tidewater.llm.common import in_order, materialize

MIN_COUNT = 10
TOP = 2000
CHUNK = 2 << 20              # bytes of one language that are counted as one run
HELD = 3 * CHUNK             # bytes of all languages that a task gathers before the largest is counted
TAKEN = 512                  # texts of a batch that a task deals out to their languages at a time
RANGE_WINDOWS = 250_000      # windows of a range, all runs together, before equal ones are added up
MAX_RANGES = 1_000_000
SAMPLE_TEXTS = 4000          # texts that the cuts are taken from, or a thousandth of all if that is more
PER_CUT = 64                 # sampled windows for each cut
SALTS = 64                   # parts of a language that are ranked first
SPACES, ENDS = b" \t", b".,;:!?\n\x0b\x0c\r"
RUN = ("range int, lang string, words binary, lengths binary, first binary, second binary, third binary, n binary")
COUNTS = "lang string, w1 string, w2 string, w3 string, n long"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- windows of one chunk, in a task ---------------------------------------


def packing(words: int) -> int | None:
    """Bits of a word's number (and of the number after the last) if three of them fit 63 bits."""
    bits = (int(words) + 1).bit_length()
    return bits if 3 * bits <= 63 else None


def coded(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(different words in byte order, each word's place among them, from 1)."""
    found = words.dictionary_encode()
    order = pc.array_sort_indices(found.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    return found.dictionary.take(pa.array(order)), rank[found.indices.to_numpy()]


def windows(texts: pa.Array, size: int = CHUNK):
    """Chunk by chunk: (words in byte order, packed windows unsorted, bits).

    A window is three numbers of words, 0 where the piece has ended.  Where a chunk ends
    inside a text, its last two words open their windows in the next chunk.
    """
    data, offsets = column_bytes(texts)
    ends_table, all_table = byte_set(ENDS), byte_set(SPACES + ENDS)
    lo, want = int(offsets[0]), size
    while lo < offsets[-1]:
        hi = next_cut(data, offsets, all_table, lo, want)
        starts, ends = spans(data, offsets, all_table, lo, hi)
        begin = offsets[np.searchsorted(offsets, hi, "right") - 1]     # of the text at hi, or hi itself
        later = min(2, len(starts) - int(np.searchsorted(starts, begin))) if begin < hi else 0
        here = len(starts) - later
        if later and not here:
            want *= 2                        # a few very long words: take more of them
            continue
        words, number = coded(word_array(_LOWER[data[lo:hi]], starts - lo, ends - lo))
        bits = packing(len(words))
        if bits is None:
            want //= 2
            continue
        own = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)]
        breaks = np.sort(np.concatenate([np.flatnonzero(ends_table[data[lo:hi]]) + lo, own]))
        piece = np.searchsorted(breaks, starts, "right")
        second, third = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        second[:-1] = np.where(piece[1:] == piece[:-1], number[1:], 0)
        third[:-2] = np.where(piece[2:] == piece[:-2], number[2:], 0)
        if here:
            yield words, ((number << 2 * bits) | (second << bits) | third)[:here], bits
        lo, want = (int(starts[here]) if later else hi), size


def by_language(batches):
    """(language, texts) of about ``CHUNK`` bytes from a task's batches; holds ``HELD`` bytes at most plus ``TAKEN`` texts."""
    held: dict[str, list] = {}
    sizes: dict[str, int] = {}

    def flush(lang):
        del sizes[lang]
        return lang, pa.chunked_array(held.pop(lang), pa.large_binary()).combine_chunks()

    for batch in (whole.slice(lo, TAKEN) for whole in batches for lo in range(0, whole.num_rows, TAKEN)):
        texts, langs = batch.column(0).cast(pa.large_binary()), batch.column(1).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            own = texts.filter(pc.equal(langs.indices, k))
            held.setdefault(lang, []).append(own)
            sizes[lang] = sizes.get(lang, 0) + own.nbytes
            if sizes[lang] >= CHUNK:
                yield flush(lang)
        while sum(sizes.values()) > HELD:
            yield flush(max(sizes, key=sizes.get))
    for lang in list(held):
        yield flush(lang)


def as_text(values: pa.Array) -> pa.Array:
    return pc.cast(values.cast(pa.binary()), options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))


def parts(packed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mask = (1 << bits) - 1
    return packed >> 2 * bits, (packed >> bits) & mask, packed & mask


def place_of(cut: tuple[bytes, bytes, bytes], words: list[bytes], bits: int) -> int:
    """The smallest packed window that is not before ``cut`` (words, empty where a piece has ended)."""
    out = 0
    for k, word in enumerate(cut):
        at = bisect_left(words, word) if word else -1
        out |= (at + 1) << (2 - k) * bits
        if word and (at == len(words) or words[at] != word):
            break                            # any window with that number is after the cut already
    return out


def run_rows(lang: str, words: pa.Array, packed: np.ndarray, n: np.ndarray, bits: int, cuts: list[tuple]) -> list[tuple]:
    """The sorted run's slices, one row for each range that it touches."""
    key = lang.encode()
    first, last = bisect_left(cuts, (key,)), bisect_left(cuts, (key + b"\x00",))
    listed = words.to_pylist() if last > first else []
    at = np.searchsorted(packed, np.array([place_of(c[1:], listed, bits) for c in cuts[first:last]], np.int64))
    edges = [0, *at.tolist(), len(packed)]
    out = []
    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if lo == hi:
            continue
        three = np.stack(parts(packed[lo:hi], bits))
        mark = np.zeros(len(words) + 1, bool)
        mark[0] = mark[three] = True
        data, offsets = column_bytes(words.take(pa.array(np.flatnonzero(mark)[1:] - 1)))
        low = (np.cumsum(mark) - 1).astype("<u4")[three]        # the slice's own numbers, 0 stays 0
        out.append((first + k, lang, data[offsets[0]:offsets[-1]].tobytes(), np.diff(offsets).astype("<u4").tobytes(),
                    *[x.tobytes() for x in low], n[lo:hi].astype("<u4").tobytes()))
    return out


def counted(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    packed = np.sort(packed)
    first = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    return packed[first], np.diff(np.append(first, len(packed)))


# -- merging the runs of a range -------------------------------------------


def _numbers(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(v, "<u4") for v in column.to_pylist()]


def merge_runs(table: pa.Table, min_count: int) -> pa.Table:
    """Counts (w1, w2, w3, n) of a range's phrases of one language, missing words empty; without any word: all.

    Left out are counts below ``min_count`` that are complete.
    """
    lengths = _numbers(table.column("lengths"))
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths), dtype=np.int64)])
    pool = b"".join(table.column("words").to_pylist())
    words, number = coded(pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(pool)]))
    base = np.cumsum([0, *[len(x) for x in lengths]])
    number, none = number.astype(np.uint32), np.zeros(1, np.uint32)
    three = []
    for name in ("first", "second", "third"):
        runs = [np.concatenate([none, number[lo:hi]])[own] for lo, hi, own in zip(base, base[1:], _numbers(table.column(name)))]
        three.append(np.concatenate(runs))
    n = np.concatenate(_numbers(table.column("n")))
    bits = packing(len(words))
    if bits is not None:                     # runs are sorted already: a stable sort merges them
        key = three[0].astype(np.int64)
        for x in three[1:]:
            key <<= bits
            key |= x
        order = np.argsort(key, kind="stable")
        del key
    else:
        order = np.lexsort(three[::-1])
    a, b, c = (x[order] for x in three)
    total = np.concatenate([[0], np.cumsum(n[order], dtype=np.int64)])
    del three, order, n
    rows = [(0, 0, 0, int(total[-1]))]
    change = np.ones(len(a) + 1, bool)       # does a new word, pair, triple begin here?
    found = []
    for k, x in enumerate((a, b, c)):
        change[1:-1] = (x[1:] != x[:-1]) | (change[1:-1] if k else False)
        begins = np.flatnonzero(change)
        count = np.diff(total[begins])
        begins = begins[:-1]
        keep = count >= min_count
        if k < 2:
            keep[[0, -1]] = True             # may go on in the range before or after
        keep &= x[begins] > 0                # the piece ended before: a shorter phrase, counted already
        at = begins[keep]
        none = np.zeros(len(at), np.int64)
        found.append(np.stack([a[at], b[at] if k > 0 else none, c[at] if k > 1 else none, count[keep]]))
    cells = np.concatenate([np.array(rows).T, *found], axis=1)
    named = pa.concat_arrays([pa.array([b""], pa.large_binary()), words])
    text = [as_text(named.take(pa.array(x))) for x in cells[:3]]
    return pa.table([pa.array([table.column("lang")[0].as_py()] * cells.shape[1], pa.string()), *text, pa.array(cells[3])],
                    names=["lang", "w1", "w2", "w3", "n"])


# -- the job ---------------------------------------------------------------


def cuts_of(texts: DataFrame, range_windows: int = RANGE_WINDOWS) -> list[tuple[bytes, ...]]:
    """Windows (language, three words) that split all windows into ranges of near equal size.

    They only deal the work out: any list gives the same counts.
    """
    rows = texts.count()
    share = min(1.0, max(0.001, SAMPLE_TEXTS / max(1, rows)))
    step = max(1, int(share * range_windows / PER_CUT))

    def some(batches):
        for lang, own in by_language(batches):
            for words, packed, bits in windows(own):
                named = pa.concat_arrays([pa.array([b""], pa.large_binary()), words])
                three = parts(np.sort(packed)[step // 2::step], bits)
                cols = [as_text(named.take(pa.array(x))) for x in three]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(three[0]), pa.string()), *cols],
                                                 names=["lang", "w1", "w2", "w3"])

    picked = texts.sample(share, seed=7).mapInArrow(some, "lang string, w1 string, w2 string, w3 string")
    picked = materialize(picked.withColumn("group", F.lit("")), "phrase-sample")
    every = max(PER_CUT, -(-picked.count() // MAX_RANGES))
    placed = in_order(picked, ["lang", "w1", "w2", "w3"], "phrase-order")
    chosen = placed.where((F.col("place") % every == 0) & (F.col("place") > 0)).select("lang", "w1", "w2", "w3").distinct()
    return sorted(tuple(v.encode() for v in r) for r in chosen.collect())


def count_phrases(docs: DataFrame, min_count: int = MIN_COUNT, text: str = "text", lang: str = "lang",
                  range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """Counts (lang, w1, w2, w3, n) of all phrases of one to three words with n >= ``min_count``, missing words
    empty; the row without words counts all words of the language."""
    texts = docs.select(docs[text].alias("text"), F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang")) \
        .where("text is not null")
    cuts = cuts_of(texts, range_windows)

    def runs(batches):
        for own_lang, own in by_language(batches):
            for words, packed, bits in windows(own):
                rows = run_rows(own_lang, words, *counted(packed), bits, cuts)
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()),
                     *[pa.array(c, pa.binary()) for c in columns[2:]]], names=[c.split()[0] for c in RUN.split(", ")])

    def merged(table: pa.Table) -> pa.Table:
        return merge_runs(table, min_count)

    counts = texts.mapInArrow(runs, RUN).groupBy("range", "lang").applyInArrow(merged, COUNTS)
    whole = counts.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))
    return whole.where((F.col("n") >= min_count) | (F.col("w1") == ""))


def phrase(*words: str) -> Column:
    return F.concat_ws(" ", *words)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers; counts below 10^16."""
    a, left, right = (x.cast("decimal(16,0)") for x in (a, left, right))
    return F.call_function("div", (a * a).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, text: str = "text", lang: str = "lang",
                 range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    counts = materialize(count_phrases(docs, min_count, text, lang, range_windows), "phrase-counts")
    words = counts.where("w1 <> '' and w2 = ''").select("lang", F.col("w1").alias("x"), F.col("n").alias("f"))
    pairs = counts.where("w2 <> '' and w3 = ''").select("lang", "w1", "w2", F.col("n").alias("a"))
    triples = counts.where("w3 <> ''").select("lang", "w1", "w2", "w3", F.col("n").alias("a"))

    def follow(stream: DataFrame, on: list[str], counted_as: str) -> DataFrame:
        """Add the count of the words ``on`` of each phrase: two streams in that order, merged."""
        if len(on) == 1:
            side = words.select(F.col("lang").alias("_g"), F.col("x").alias("_x"), F.col("f").alias(counted_as))
            same = (F.col("lang") == F.col("_g")) & (F.col(on[0]) == F.col("_x"))
        else:
            side = pairs.select(F.col("lang").alias("_g"), F.col("w1").alias("_x"), F.col("w2").alias("_y"),
                                F.col("a").alias(counted_as))
            same = (F.col("lang") == F.col("_g")) & (F.col(on[0]) == F.col("_x")) & (F.col(on[1]) == F.col("_y"))
        return stream.join(side.hint("merge"), same).drop("_g", "_x", "_y")

    # triples: prefix order for what stands left of a cut, suffix order for what stands right of it
    three = follow(follow(triples, ["w1", "w2"], "l2"), ["w1"], "l1")
    three = follow(follow(three, ["w2", "w3"], "r1"), ["w3"], "r2")
    s1, s2 = score(F.col("a"), F.col("l1"), F.col("r1")), score(F.col("a"), F.col("l2"), F.col("r2"))
    three = three.withColumn("s1", s1).withColumn("s2", s2).select(
        "lang", phrase("w1", "w2", "w3").alias("phrase"), "a",
        F.when(F.col("s1") <= F.col("s2"), F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(F.col("s1") <= F.col("s2"), F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"))
    # pairs, with their largest extension to the right (prefix order) and to the left (suffix order)
    to_right = triples.groupBy("lang", "w1", "w2").agg(F.max("a").alias("e"))
    to_left = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("e"))
    longer = to_right.unionByName(to_left).where("e is not null").groupBy("lang", "w1", "w2").agg(F.max("e").alias("e"))
    kept = (pairs.join(longer.hint("merge"), ["lang", "w1", "w2"], "left")
            .where("e is null or 100 * e < 50 * a"))
    two = follow(follow(kept, ["w1"], "l"), ["w2"], "r")
    two = two.select("lang", phrase("w1", "w2").alias("phrase"), "a", "l", "r",
                     score(F.col("a"), F.col("l"), F.col("r")).alias("score"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = three.unionByName(two).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for by in (("lang", "_salt"), ("lang",)):            # a language is ranked in parts first
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("w1 = ''").select(F.col("lang").alias("_g"), F.col("n"))
    return (salted.join(totals, F.col("lang") == F.col("_g"))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
