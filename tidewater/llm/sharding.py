"""Byte-balanced shards by Karmarkar-Karp differencing (operator 8).

Law ``bytes``: the shards' sizes are near equal; equal texts stay together.

A partial partition is a vector of as many sums as there are shards.  Two of
them are combined by adding the largest sums of one to the smallest of the
other (opposite order), which keeps the spread small; always the two partial
partitions with the largest spread are combined next.

* Rows are grouped by text (digest and size), so a group of copies is one row.
* Groups larger than ``1 / BUNDLES`` of all bytes are items of their own (there are
  at most ``BUNDLES``); all others are dealt to ``BUNDLES`` bundles by a hash and
  each bundle is one item.  So differencing sees at most twice ``BUNDLES`` items at
  any size of the corpus, and with that many small items it ends within bytes.
* The plan (item, shard) is bounded the same way and is broadcast; rows find their
  shard by it, and slots are numbered in two levels.

A group larger than a shard's whole fair share cannot stay in one place without
breaking the law, so it alone is dealt out in parts of a quarter of that share
(equal texts are interchangeable); every other group is indivisible.

Defined results: a null text has no bytes and the checksum of the empty text, and
counts as one group with empty texts.  Repeated rows are placed repeatedly.  An
empty table gives an empty result.  Only the id and the text are read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, numbered

ROW_BYTES = 16          # added to each text's size
BUNDLES = 16_384        # bundles of small groups; groups over this share of the bytes go alone
PARTS = 4               # a group over the fair share is dealt out in parts of 1 / PARTS of it


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (rows of sums) into one.

    Returns the sums, descending, and for each row and column the place in the
    result that this column's content went to.
    """
    m, k = vectors.shape
    order = np.argsort(-vectors, axis=1, kind="stable")
    sums = np.take_along_axis(vectors, order, axis=1)
    spread = sums[:, 0] - sums[:, -1]
    heap = [(-int(d), i) for i, d in enumerate(spread)]
    heapq.heapify(heap)
    held = {i: sums[i] for i in range(m)}
    merged = []                       # (first, second, sorting permutation of the combined sums)
    nxt = m
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = held.pop(a) + held.pop(b)[::-1]
        perm = np.argsort(-total, kind="stable")
        total = total[perm]
        merged.append((a, b, perm))
        held[nxt] = total
        heapq.heappush(heap, (-int(total[0] - total[-1]), nxt))
        nxt += 1
    # walk back: where does place p of each partial partition end up?
    place = {nxt - 1: np.arange(k)}
    for i in range(len(merged) - 1, -1, -1):
        a, b, perm = merged[i]
        own = place.pop(m + i)
        to = np.empty(k, np.int64)
        to[perm] = own                # before sorting, sum q sat at q; it is now at the place of perm^-1(q)
        place[a], place[b] = to, to[::-1]
    where = np.empty((m, k), np.int64)
    for i in range(m):
        where[i, order[i]] = place[i]
    return held[nxt - 1], where


def shard_plan(items: pd.DataFrame, shards: int) -> pd.DataFrame:
    """(item, shard) for items with their bytes, by differencing."""
    vectors = np.zeros((len(items), shards), np.int64)
    vectors[:, 0] = items["bytes"]
    where = difference(vectors)[1][:, 0] if len(items) else np.empty(0, np.int64)
    return pd.DataFrame({"item": items["item"].astype(str), "shard": where.astype(np.int32)})


def shard_groups(groups: DataFrame, shards: int, total: int) -> DataFrame:
    """``groups`` (unit, bytes) with a column ``shard``; units are indivisible."""
    bundle = F.concat(F.lit("bundle-"), F.pmod(F.xxhash64("unit"), F.lit(BUNDLES)).cast("string"))
    item = F.when(F.col("bytes") > total // BUNDLES, F.col("unit")).otherwise(bundle)
    dealt = groups.withColumn("item", item)
    items = dealt.groupBy("item").agg(F.sum("bytes").alias("bytes")).orderBy("item").toPandas()
    plan = groups.sparkSession.createDataFrame(shard_plan(items, shards), "item string, shard int")
    return dealt.join(F.broadcast(plan), "item").select("unit", "shard")   # at most 2 * BUNDLES rows


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    raw = F.encode(F.coalesce(docs[text], F.lit("")), "UTF-8")
    sized = materialize(
        docs.select(docs[id_col].cast("long").alias("doc_id"), raw.alias("b"))
        .select("doc_id", (F.octet_length("b") + ROW_BYTES).cast("long").alias("size"),
                F.crc32("b").alias("text_crc32"), F.sha2("b", 256).alias("digest"),
                F.monotonically_increasing_id().alias("row")), "shard-sizes")
    total = sized.agg(F.sum("size").alias("s")).first().s or 0
    share = total // shards
    part = max(1, share // PARTS)
    copies = sized.groupBy("digest", "size").agg(F.count("*").alias("n"))
    # parts of an outsized group; every other group is one unit
    per_unit = F.when(F.col("n") * F.col("size") > share, F.greatest(F.lit(1), F.floor(F.lit(part) / F.col("size")))) \
        .otherwise(F.col("n"))
    copies = materialize(copies.withColumn("per_unit", per_unit.cast("long"))
                         .withColumn("units", F.ceil(F.col("n") / F.col("per_unit")).cast("long")), "shard-groups")
    unit = F.concat_ws("-", "digest", F.col("u").cast("string"))
    units = (copies.withColumn("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("units") - 1)))
             .select(unit.alias("unit"), (F.least(F.col("per_unit"), F.col("n") - F.col("u") * F.col("per_unit"))
                                          * F.col("size")).alias("bytes")))
    placed = shard_groups(units, shards, total)

    # rows of whole groups take unit 0; rows of outsized groups are numbered and dealt to its parts
    split = copies.where("units > 1").select(F.col("digest").alias("d"), "per_unit")
    whole = sized.join(split, sized.digest == split.d, "left_anti").withColumn("u", F.lit(0).cast("long"))
    outsized = materialize(sized.join(split, sized.digest == split.d).drop("d"), "shard-outsized")
    parts = (numbered(outsized, "digest", "row", "r").withColumn("u", F.floor(F.col("r") / F.col("per_unit")))
             .select(*whole.columns))
    rows = whole.unionByName(parts).withColumn("unit", unit)
    named = materialize(rows.join(placed, "unit").select("doc_id", "size", "text_crc32", "shard", "row"), "shard-rows")
    return (numbered(named, "shard", "row", "slot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
