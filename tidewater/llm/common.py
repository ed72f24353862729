"""Helpers that several operators of this subpackage share.

Everything here works on DataFrames of any size: intermediate states go to the
shared folder named in ``spark.checkpoint.dir``, ranks are counted in two
levels, and components are found by shuffles, so nothing grows on the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from tidewater.session import scratch_path

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table below the shared checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint, but columns stay prunable, and
    a lost executor costs a re-read, never a recomputation with other values.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SLICE = 512     # rows that a task turns into Python values at a time


def map_slices(df: DataFrame, make, schema: str | T.StructType) -> DataFrame:
    """``df`` through a function from frame to frame, a few rows at a time.

    ``make()`` is called once per task and returns the function, so it can keep state.
    An Arrow batch stays as it came; only a slice of it is turned into Python values,
    which bounds a task's memory by the texts of ``SLICE`` rows.
    """
    result = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(result)

    def run(batches):
        each = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                out = each(batch.slice(lo, SLICE).to_pandas(integer_object_nulls=True))
                yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    return df.mapInArrow(run, result)


def free_prefix(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, longer by underscores until no column's name begins with it (names differ by more than case)."""
    while any(c.lower().startswith(wanted.lower()) for c in columns):
        wanted += "_"
    return wanted


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection on unsigned 64-bit words that spreads all bits (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else (no locale, no non-ASCII letters)."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text, in order; null gives an empty array.

    The six white-space characters become spaces first: plain replacements and a split
    on one character cost a fraction of a split by pattern.
    """
    flat = F.coalesce(text, F.lit(""))
    for space in "\t\n\x0b\x0c\r":
        flat = F.replace(flat, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(flat, " "), "")


def lower_word(word: Column) -> Column:
    """``lower_ascii`` of a word, character by character only for words that have capitals at all."""
    return F.when(F.lower(word) == word, word).otherwise(lower_ascii(word))


def numbered(df: DataFrame, group: str, order: str, out: str, chunk: int = 50_000) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in no task more than about ``chunk`` rows of one group.

    Rows are dealt to salts by a hash of ``order`` (a unique column); a count per
    (group, salt) gives each salt its first number, and a window inside the salt
    the rest.  ``df`` is read twice: pass a materialised frame.
    """
    n = df.agg(F.count("*").alias("n")).first().n
    salts = max(1, -(-n // chunk))
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)).cast("int"))
    counts = dealt.groupBy(group, "_salt").agg(F.count("*").alias("_c"))
    before = Window.partitionBy(group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_g"), F.col("_salt").alias("_s"),
                           F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_first"))
    inner = Window.partitionBy(group, "_salt").orderBy(order)
    return (dealt.withColumn("_rn", F.row_number().over(inner) - 1)
            .join(starts, (F.col(group) == F.col("_g")) & (F.col("_salt") == F.col("_s")))
            .withColumn(out, (F.col("_first") + F.col("_rn")).cast("long"))
            .drop("_salt", "_rn", "_g", "_s", "_first"))


def in_order(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` (group, ...) with ``place``: from 0 in each group, by ``order``, nulls first.

    Rows are range-partitioned and sorted by (group, order); a row's place is its place in the
    partition plus the counts of the partitions before, so no group is sorted in one task.
    """
    keys = [F.asc("group"), *[F.asc_nulls_first(c) for c in order]]
    run = materialize(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), name)
    counts = run.groupBy("group", "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy("group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("group", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    return (run.join(starts, ["group", "_part"])
            .withColumn("place", (F.col("_start") + F.col("_row")).cast("long")).drop("_part", "_row", "_start"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (columns a, b): rows (id, component), component = smallest id.

    Alternates the large-star and small-star steps until nothing changes; each
    step is one aggregate and one join, whose hot stars AQE can split, and each
    round is written to the shared folder.  Only ids that occur in an edge come back.
    """
    cur = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a <> b").distinct(), name)
    seen = None
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("k")).agg(F.least(F.min("b"), F.col("k")).alias("m"))
        large = (both.join(low, both.a == low.k).where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low2 = large.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        small = large.join(low2, large.a == low2.k)
        nxt = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(low2.select(F.col("k").alias("a"), F.col("m").alias("b")))
               .where("a <> b").distinct())
        cur = materialize(nxt, name)
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = cur.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return cur.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def paired_blocks(df: DataFrame, block: str, blocks: str) -> DataFrame:
    """Copy each row to every pair of blocks (bi <= bj) that its block is part of; blocks are numbered below ``blocks``."""
    other = F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)).alias("_other")
    return (df.select("*", other)
            .withColumn("bi", F.least(F.col(block), F.col("_other")))
            .withColumn("bj", F.greatest(F.col(block), F.col("_other"))).drop("_other"))


def runs(frames, keys: list[str]):
    """Complete groups out of a stream of frames that is sorted by ``keys``; holds one group at a time."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        step = (frame[keys].to_numpy()[1:] != frame[keys].to_numpy()[:-1]).any(axis=1).nonzero()[0] + 1
        cuts = [0, *step.tolist(), len(frame)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = frame.iloc[lo:hi]
            if held and lo == 0 and tuple(held[-1][keys].iloc[-1]) == tuple(part[keys].iloc[0]):
                held.append(part)
                continue
            if held:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
            held = [part]
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
