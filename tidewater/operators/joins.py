"""Join helpers: full outer joins that hot keys cannot stop, prefer-merge of two sources, literal maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOOK_FROM = 1 << 30      # estimated bytes of a side from which on its keys are looked at
HOT_SHARE = 0.005        # share of a side's rows that makes a key hot
TRACKED = 4000           # keys that the sketch of frequent ones keeps per task, so its error is rows / TRACKED
SALTS = 32               # parts that a hot key's rows are dealt to


def literal_frame(spark: SparkSession, mapping: Mapping, key: str, value: str,
                  key_type: str = "string", value_type: str = "string") -> DataFrame:
    """A small literal map (like ``VALUES (...)``) as a DataFrame."""
    rows = [(k, v) for k, v in mapping.items()]
    return spark.createDataFrame(rows, f"`{key}` {key_type}, `{value}` {value_type}")


def join_small_literal(df: DataFrame, spark: SparkSession, mapping: Mapping, key: str, value: str,
                       key_type: str = "string", how: str = "inner") -> DataFrame:
    """Join with a literal map; the map's size is known, so it is broadcast."""
    lit_df = literal_frame(spark, mapping, key, value, key_type=key_type)
    return df.join(F.broadcast(lit_df), on=key, how=how)


def _size(df: DataFrame) -> int:
    """The planner's estimate of a frame's bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_hashes(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows with a key: ``1 / share`` of them at most.

    One pass over the key columns with a bounded sketch of frequent items, nothing shuffled but sketches.
    """
    present = df.where(_present(keys))
    found = present.agg(F.count("*").alias("n"), F.call_function(
        "approx_top_k", F.xxhash64(*keys), F.lit(int(1 / share) + 1), F.lit(TRACKED)).alias("top")).first()
    return [t["item"] for t in found["top"] or () if t["count"] > share * found["n"]]


def _present(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def _salted_join(hot: DataFrame, other: DataFrame, same: Sequence[Column]) -> DataFrame:
    """Inner join of hot keys' rows, dealt to ``SALTS`` parts, with the other side's rows, copied to each part.

    A row's part depends on its values and the partition that it comes from, so a task that is run again
    deals alike, and equal rows do not all meet in one part either.
    """
    part = F.pmod(F.xxhash64(*hot.columns) + F.spark_partition_id(), F.lit(SALTS)).cast("int")
    dealt = hot.withColumn("_part", part)
    copied = other.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copied, on=[*same, F.col("_part") == F.col("_copy")]).drop("_part", "_copy")


def full_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], share: float = HOT_SHARE,
              look_from: int = LOOK_FROM) -> DataFrame:
    """Full outer join on pairs of columns (left name, right name; all names differ), whatever a key's rows.

    Spark cannot split the partitions of a full outer join, so all rows of one key meet in
    one task.  Where a side is large, its hot keys are found first: their rows are dealt to
    parts that the other side's rows are copied to, and rows without a match come from
    anti joins against the other side's keys among the hot ones (few, so broadcast).
    Rows without a key match nothing and are not shuffled.  All other rows take the plain join.
    """
    lk, rk = [a for a, _ in on], [b for _, b in on]
    same = [F.col(a) == F.col(b) for a, b in on]
    l_top, r_top = (set(hot_hashes(df, keys, share)) if _size(df) >= look_from else set() for df, keys in ((left, lk), (right, rk)))
    if not l_top | r_top:
        return left.join(right, on=same, how="full")
    r_top -= l_top
    among = lambda df, keys, top: df.where(_present(keys) & F.xxhash64(*keys).isin(*top))
    rest = lambda df, keys: df.where(_present(keys) & ~F.xxhash64(*keys).isin(*(l_top | r_top)))
    none = lambda other: [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields]
    out = rest(left, lk).join(rest(right, rk), on=same, how="full")
    if l_top:
        out = out.unionByName(_salted_join(among(left, lk, l_top), among(right, rk, l_top), same))
    if r_top:
        out = out.unionByName(_salted_join(among(right, rk, r_top), among(left, lk, r_top), same))
    l_hot, r_hot = among(left, lk, l_top | r_top), among(right, rk, l_top | r_top)
    l_only = l_hot.join(F.broadcast(r_hot.select(*rk).distinct()), on=same, how="left_anti").unionByName(left.where(~_present(lk)))
    r_only = r_hot.join(F.broadcast(l_hot.select(*lk).distinct()), on=same, how="left_anti").unionByName(right.where(~_present(rk)))
    return out.unionByName(l_only.select("*", *none(right))).unionByName(r_only.select(*none(left), "*"))


def merge_prefer(left: DataFrame, right: DataFrame, key: str | Sequence[str], columns: Sequence[str],
                 prefer: str = "right", share: float = HOT_SHARE, look_from: int = LOOK_FROM) -> DataFrame:
    """Full outer join of two sources of one entity; per column take the
    preferred side's value, falling back to the other (``coalesce``).  Hot keys: ``full_join``."""
    keys = [key] if isinstance(key, str) else list(key)
    lcols = [c for c in columns if c in left.columns]
    rcols = [c for c in columns if c in right.columns]
    lsel = left.select(*[F.col(k).alias(f"_l_{k}") for k in keys], *[F.col(c).alias(f"_l_{c}") for c in lcols])
    rsel = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[F.col(c).alias(f"_r_{c}") for c in rcols])
    j = full_join(lsel, rsel, [(f"_l_{k}", f"_r_{k}") for k in keys], share, look_from)
    first, second = ("_r_", "_l_") if prefer == "right" else ("_l_", "_r_")
    out = []
    for c in [*keys, *columns]:
        parts = [F.col(f"{p}{c}") for p in (first, second) if (c in keys) or
                 (c in (rcols if p == "_r_" else lcols))]
        out.append((F.coalesce(*parts) if len(parts) > 1 else parts[0]).alias(c))
    return j.select(*out)
