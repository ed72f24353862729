"""N-gram Jaccard join of documents (operator 9).

Method: a blocked sparse matrix product.  Documents are rows, word 5-grams are
columns; the product of the incidence matrix with its transpose holds the
overlap counts.  Only pairs that can reach the similarity are multiplied:

1. Texts with the same set of n-grams form a class; the smallest id stands for it.
2. Two sets with Jaccard >= t must share one of their first ``n - ceil(t n) + 1``
   columns (n: the set's size) in any one global order of all columns.  The order
   used here puts rare columns first: columns whose hash lies in the lowest
   ``SHARE`` of all hashes come first, by their exact document frequency; all other
   columns follow by hash; columns that a frequency sketch of fixed size calls hot
   (common passages) come last.  Only the first part is counted, in one shuffle; a
   document whose first columns are all its own leaves here.  Documents that share
   such a column are connected through the column's smallest id (stars, never all
   pairs; a hot column is reduced to one row per task's chunk before the shuffle).
3. What the stars hold is a small part of the corpus, but a part of the columns tells
   little of a short document: one shared line is enough to stay, and such lines run
   the stars together to one family that grows faster than the corpus.  So the same
   bound is applied again among these documents, now with all their columns in the
   order of their exact frequency.  The components of the stars that are left are
   families, and every link lies within one.
4. A family is cut into blocks by size band and hash.  Each pair of blocks whose
   bands allow the similarity is one small matrix product in one task: overlap
   counts accumulate over column blocks, and the block is given up as soon as
   no pair can still reach its bound.  Only a spanning forest of the block's
   links is emitted (fewer rows than documents), which loses no component.
5. Components of the forests, with the classes, give the result.

No step emits all pairs of a group, nothing is collected but the sketch of fixed
size, and hot columns or families are spread over (band, block, block) keys.

Defined results: null, empty and blank texts have an empty set and link with
nothing; fewer than five words make one n-gram of the whole sequence.  N-grams
are compared by 64-bit hashes.  A null id cannot be linked or named: such rows
come back with their own size and a null component.  Repeated rows (equal id
and text) come back repeatedly.  Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import components, lower_word, materialize, mix64, paired_blocks, runs, words_of

N = 5                      # words in an n-gram
T_NUM, T_DEN = 75, 100     # Jaccard threshold as a fraction
SHARE = 0.33               # of the hash range: columns that are ordered by exact frequency
SLOTS = 1 << 20            # counters of the frequency sketch
HOT = 7                    # bits of a count in the sketch from which on a column is hot, at least
CROWD = 8                  # a hot column's count is at least so many times the counters' mean
CHUNK = 1 << 21            # n-grams that a task holds while it counts
PIECE = 1 << 18            # rows that a task hands on at a time
BLOCK = 384                # documents in a block of a family
COLUMNS = 8192             # columns multiplied at a time
BROADCAST_BYTES = 32 << 20  # rows of integers are broadcast up to this size, beyond it joined by a shuffle

_BOUND = np.int64(-(1 << 63) + int(SHARE * (1 << 64)))
_ALWAYS, _EDGE = (1 << 31) - 1, -(1 << 31)     # marks in the column ``slack`` (see _index)

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                 0x85EBCA77C2B2AE63], dtype=np.uint64)


def gram_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct n-gram hashes (int64) of one text's word hashes."""
    w = words.astype(np.int64).view(np.uint64)
    if not len(w):
        return np.empty(0, np.int64)
    k = min(N, len(w))
    total = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        total += mix64(w[i:len(w) - k + 1 + i]) * _ODD[i]
    return np.unique(mix64(total).view(np.int64))


def _word_hashes(docs: DataFrame, id_col: str, text: str, narrow: bool = False) -> DataFrame:
    """(id, h): the hashes of a text's words; ``narrow`` ones have 31 bits, still 155 for five words."""
    own = lambda x: F.xxhash64(lower_word(x))
    if narrow:
        own = lambda x: F.xxhash64(lower_word(x)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    return docs.select(docs[id_col].cast("long").alias("id"), words_of(docs[text]).alias("w")).select("id", F.transform("w", own).alias("h"))


def _sets(batch: pa.RecordBatch):
    """(index, set) of each row of a batch with a column ``h`` of word hashes."""
    col = batch.column("h")
    flat, offs = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
    for i in range(len(col)):
        yield i, gram_set(flat[offs[i]:offs[i + 1]])


_SCAN = "id long, n long, k1 long, k2 long, slots array<int>, counts array<long>"


def _scan(batches):
    """Per document its set's size and 128-bit key; at the end of a task, the sketch's non-zero counters."""
    table, held, size = np.zeros(SLOTS, np.int64), [], 0

    def count():
        values = np.concatenate(held)
        held.clear()
        values.sort()
        again = np.zeros(len(values) + 1, np.int8)             # 1 where a value equals the one before it
        again[1:-1] = values[1:] == values[:-1]
        first, last = np.flatnonzero(np.diff(again)).reshape(-1, 2).T
        np.add.at(table, values[first] & (SLOTS - 1), last - first + 1)

    for batch in batches:
        n, k1, k2 = [], [], []
        for _, s in _sets(batch):
            key = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
            n.append(len(s)), k1.append(int(key[0])), k2.append(int(key[1]))
            first = s[:np.searchsorted(s, _BOUND)]
            held.append(first)
            size += len(first)
            if size >= CHUNK:
                count()
                size = 0
        none = pa.nulls(len(n))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
             none.cast(pa.list_(pa.int32())), none.cast(pa.list_(pa.int64()))],
            names=["id", "n", "k1", "k2", "slots", "counts"])
    if size:
        count()
    used = np.flatnonzero(table)
    for lo in range(0, len(used), 1 << 16):
        part = used[lo:lo + (1 << 16)]
        empty = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [empty, empty, empty, empty, pa.array([part.astype(np.int32)], pa.list_(pa.int32())),
             pa.array([table[part]], pa.list_(pa.int64()))], names=["id", "n", "k1", "k2", "slots", "counts"])


def _levels(scan: DataFrame) -> tuple[np.ndarray, int]:
    """The sketch as one byte per slot: the bit length of its count (at most SLOTS rows reach the driver),
    and the bits from which on a column is hot."""
    counted = (scan.where("slots is not null").select(F.explode(F.arrays_zip("slots", "counts")).alias("e"))
               .groupBy(F.col("e.slots").alias("slot")).agg(F.sum("e.counts").alias("c"))).toPandas()
    levels, counts = np.zeros(SLOTS, np.uint8), counted["c"].to_numpy(np.float64)
    levels[counted["slot"].to_numpy(np.int64)] = _bits(counts)
    return levels, hot_bits(counts.sum())


def _bits(counts):
    return np.ceil(np.log2(counts + 1))


def hot_bits(total: float) -> int:
    """Bits of a hot column's count, where all counters sum up to ``total``.

    Columns share counters, so with the corpus every counter grows; one that is merely
    as full as the others says nothing about its columns.
    """
    return max(HOT, int(_bits(CROWD * total / SLOTS)))


def prefix_length(n: int) -> int:
    """Columns of a set of size n that any similar set must meet."""
    return n - -(-T_NUM * n // T_DEN) + 1


_INDEX = "gram long, id long, slack int"


def _rows(gram, who, slack) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(gram, pa.int64()), pa.array(who, pa.int64()), pa.array(slack, pa.int32())],
                                      names=["gram", "id", "slack"])


def _local_stars(grams: np.ndarray, who: np.ndarray) -> pa.RecordBatch:
    """One row (column, smallest id) per column of a chunk, and star edges (b as column, a as id) within the chunk."""
    at = np.lexsort((who, grams))
    grams, who = grams[at], who[at]
    new = np.r_[True, grams[1:] != grams[:-1]]
    low = who[new][np.cumsum(new) - 1]
    far = who != low
    pairs = np.unique(np.stack([low[far], who[far]], axis=1), axis=0)
    return _rows(np.r_[grams[new], pairs[:, 1]], np.r_[who[new], pairs[:, 0]],
                 np.r_[np.full(int(new.sum()), _ALWAYS), np.full(len(pairs), _EDGE)])


def _index(levels, least: int):
    """Columns of each document for the shuffle; those of ``least`` bits in the sketch are hot.

    ``slack`` of a column of the first part: how many columns the document needs
    beyond its first part (negative: how many it can do without).  A document that
    needs more adds its next columns; those are certain to be needed (_ALWAYS) and
    leave the chunk as stars.
    """
    def run(batches):
        level, grams, who, size = levels.value, [], [], 0
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            out: list[tuple] = []
            for i, s in _sets(batch):
                if not len(s):
                    continue
                cut = np.searchsorted(s, _BOUND)
                first, heat = s[:cut], level[s[:cut] & (SLOTS - 1)]
                hot = heat >= least
                first, late = first[~hot], first[hot][np.argsort(heat[hot], kind="stable")]
                slack = prefix_length(len(s)) - len(first)
                out.append((first, ids[i], slack))
                if slack > 0:
                    more = np.r_[s[cut:], late][:slack]
                    grams.append(more)
                    who.append(np.full(len(more), ids[i], np.int64))
                    size += len(more)
            if out:
                n = [len(g) for g, _, _ in out]
                yield _rows(np.concatenate([g for g, _, _ in out]), np.repeat([w for _, w, _ in out], n),
                            np.repeat([k for _, _, k in out], n))
            if size >= CHUNK:
                yield _local_stars(np.concatenate(grams), np.concatenate(who))
                grams, who, size = [], [], 0
        if size:
            yield _local_stars(np.concatenate(grams), np.concatenate(who))
    return run


def _whole(batches):
    """All columns of each document, with ``slack`` as in _index; about PIECE rows at a time."""
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        held, who, size = [], [], 0
        for i, s in _sets(batch):
            held.append(s)
            who.append(ids[i])
            size += len(s)
            if size >= PIECE or i + 1 == len(ids):
                n = np.array([len(s) for s in held])
                slack = [prefix_length(k) - k for k in n.tolist()]
                yield _rows(np.concatenate(held), np.repeat(who, n), np.repeat(slack, n))
                held, who, size = [], [], 0


def _first(counted: DataFrame) -> DataFrame:
    """(gram, id): each document's shared columns (rows of _INDEX with ``df``) that lie in its prefix, rare ones first."""
    mine = Window.partitionBy("id")
    return (counted.withColumn("shared", F.count("*").over(mine))
            .withColumn("rank", F.row_number().over(mine.orderBy("df", "gram")))
            .where("rank <= slack + shared").select("gram", "id"))


def _stars(first: DataFrame) -> DataFrame:
    """(a, b): each document (b) of a column with the column's smallest id (a)."""
    return (first.withColumn("low", F.min("id").over(Window.partitionBy("gram")))
            .where("low <> id").select(F.col("low").alias("a"), F.col("id").alias("b")))


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df``, which is materialised, marked for a broadcast if its rows are few enough."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def block_links(ids: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``: overlap counts by products of column blocks."""
    m = len(ids)
    size = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    rows = np.repeat(np.arange(m), size)
    at = np.argsort(values, kind="stable")
    values, rows = values[at], rows[at]
    new = np.r_[True, values[1:] != values[:-1]]
    col = np.cumsum(new) - 1
    shared = np.bincount(col) > 1                 # a column of one row adds nothing
    use = shared[col]
    rows, col = rows[use], (np.cumsum(shared) - 1)[col[use]]
    left = np.bincount(rows, minlength=m)         # shared columns of each row still to come
    both = T_NUM * (size[:, None] + size[None, :])
    scale = T_NUM + T_DEN
    fits = (T_DEN * np.minimum(size[:, None], size[None, :]) >= T_NUM * np.maximum(size[:, None], size[None, :]))
    fits &= ~np.eye(m, dtype=bool)
    overlap = np.zeros((m, m), np.int64)
    n_cols = int(col[-1]) + 1 if len(col) else 0
    cuts = np.searchsorted(col, np.arange(0, n_cols + COLUMNS, COLUMNS))
    for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        possible = scale * (overlap + np.minimum(left[:, None], left[None, :])) >= both
        if not (possible & fits).any():
            return []
        part = np.zeros((m, COLUMNS), np.float32)
        part[rows[lo:hi], col[lo:hi] - k * COLUMNS] = 1
        overlap += (part @ part.T).astype(np.int64)
        left = left - np.bincount(rows[lo:hi], minlength=m)
    linked = fits & (scale * overlap >= both)
    forest, todo = [], np.ones(m, bool)
    for root in range(m):
        if not todo[root]:
            continue
        todo[root] = False
        front = np.array([root])
        while len(front):
            reach = np.flatnonzero(linked[front].any(axis=0) & todo)
            todo[reach] = False
            forest += [(int(ids[root]), int(ids[r])) for r in reach]
            front = reach
    return forest


def _products(frames):
    for block in runs(frames, ["family", "ci", "bi", "cj", "bj"]):
        sets = [gram_set(np.asarray(h)) for h in block["h"]]
        found = block_links(block["id"].to_numpy(), sets)
        if found:
            yield pd.DataFrame(found, columns=["a", "b"])


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id."""
    spark = docs.sparkSession
    hashes = _word_hashes(docs, id_col, text)
    scan = materialize(hashes.mapInArrow(_scan, _SCAN), "ngram-scan")
    facts = scan.where("slots is null").select("id", "n", "k1", "k2")
    sketch, least = _levels(scan)
    levels = spark.sparkContext.broadcast(sketch)

    # classes of equal sets; the smallest id stands for each
    classes = materialize(facts.where("n > 0 and id is not null").groupBy("k1", "k2")
                          .agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.max("n").alias("n")),
                          "ngram-classes")
    copies = classes.where("copies > 1").select("k1", "k2", "rep")
    others = (facts.join(copies, ["k1", "k2"]).where("id <> rep").select("id", "rep"))

    # candidates through shared prefix columns, of which the first part is counted
    edge = F.col("slack") == _EDGE
    same = Window.partitionBy("gram", "edge")
    met = materialize(
        hashes.where("id is not null").mapInArrow(_index(levels, least), _INDEX).repartition("gram").withColumn("edge", edge)
        .withColumn("df", F.count("*").over(same)).withColumn("low", F.min("id").over(same))
        .where("edge or df > 1"), "ngram-met")
    counted = met.where(F.col("slack") < _ALWAYS).where("not edge")
    stars = (_stars(_first(counted))
             .unionByName(met.where(F.col("slack") == _ALWAYS).where("low <> id").select(F.col("low").alias("a"), F.col("id").alias("b")))
             .unionByName(met.where("edge").select(F.col("id").alias("a"), F.col("gram").alias("b"))).distinct())
    stars = materialize(stars, "ngram-stars")
    # copies of one text meet in every column: only their class goes on
    alias = others.select(F.col("id").alias("x"), F.col("rep").alias("r"))
    for side in ("a", "b"):
        stars = (stars.join(alias, stars[side] == alias.x, "left")
                 .withColumn(side, F.coalesce("r", side)).drop("x", "r"))
    met_ids = materialize(stars.where("a <> b").select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ngram-met-ids")

    # families: the same bound among these documents, by all their columns
    texts = (docs.select(docs[id_col].cast("long").alias("id"), docs[text].alias("t"))
             .join(_small(met_ids, 32), "id", "left_semi"))
    sets = materialize(_word_hashes(texts, "id", "t", narrow=True), "ngram-sets")
    counted = (sets.mapInArrow(_whole, _INDEX)
               .withColumn("df", F.count("*").over(Window.partitionBy("gram"))).where("df > 1"))
    stars = materialize(_stars(_first(counted)).distinct(), "ngram-stars")
    families = materialize(components(stars, "ngram-families"), "ngram-family")

    # block products within families
    reps = classes.select(F.col("rep").alias("id"), "n")
    base = math.log(T_DEN / T_NUM)
    member = (families.join(reps, "id")
              .withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(base)).cast("int")))
    counts = (member.groupBy("component", "band").agg(F.count("*").alias("c"))
              .withColumn("blocks", F.ceil(F.col("c") / F.lit(BLOCK)).cast("int")))
    bands = counts.select(F.col("component").alias("family"), F.col("band").alias("g"), "blocks")
    member = member.select("id", F.col("component").alias("family"), "band")
    # a document of band g meets band g (all block pairs) and, being the larger or smaller, bands g - 1 and g + 1
    placed = materialize(
        member.join(bands, (member.family == bands.family) & (member.band == bands.g)).drop(bands.family)
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .select("id", member.family, "band", "block", "blocks"), "ngram-blocks")
    within = (paired_blocks(placed, "block", "blocks")
              .select("id", "family", F.col("band").alias("ci"), "bi", F.col("band").alias("cj"), "bj"))
    nxt = bands.select(F.col("family").alias("f"), F.col("g"), F.col("blocks").alias("there"))
    up = (placed.join(nxt, (placed.family == nxt.f) & (placed.band + 1 == nxt.g))
          .select("id", "family", F.col("band").alias("ci"), F.col("block").alias("bi"), F.col("g").alias("cj"),
                  F.explode(F.sequence(F.lit(0), F.col("there") - 1)).alias("bj")))
    down = (placed.join(nxt, (placed.family == nxt.f) & (placed.band - 1 == nxt.g))
            .select("id", "family", F.col("g").alias("ci"),
                    F.explode(F.sequence(F.lit(0), F.col("there") - 1)).alias("bi"), F.col("band").alias("cj"),
                    F.col("block").alias("bj")))
    cells = within.unionByName(up).unionByName(down)
    keys = ["family", "ci", "bi", "cj", "bj"]
    cells = _small(materialize(cells, "ngram-cells"), 64)          # six integers a row
    links = (sets.join(cells, "id").select("id", *keys, "h").repartition(*keys).sortWithinPartitions(*keys)
             .mapInPandas(_products, "a long, b long"))
    joined = components(links, "ngram-links")

    # one row per document
    names = (classes.select("k1", "k2", "rep").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
             .select("k1", "k2", F.coalesce("component", "rep").alias("component")))
    return (facts.join(names, ["k1", "k2"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(),
                           F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))).alias("component_id")))
