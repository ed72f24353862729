"""Reshaping operators: dedupe, top-n per group, unpivot, series, spines, listagg."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.exprs import datediff as _datediff

# --------------------------------------------------------------------------
# W3 keep one row per key
# --------------------------------------------------------------------------


def keep_one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], latest: bool = True) -> DataFrame:
    """Keep one row per key: the one with the greatest (``latest``) or least
    ``order_by`` tuple, the remaining orderable columns breaking ties
    (deterministic).

    Expressed as ``max_by``/``min_by`` over a struct, i.e. an aggregate with
    a map-side partial step: a key holding a third of all rows is reduced
    inside each input task before the shuffle, never sorted in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    unordered = (T.MapType, T.BinaryType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType, T.BinaryType)
    tie_break = [c for c in rest if not isinstance(types[c], unordered)]
    row = F.struct(*[F.col(c) for c in [*order_by, *rest]])
    rank = F.struct(*[F.col(c) for c in [*order_by, *tie_break]])
    agg = F.max_by(row, rank) if latest else F.min_by(row, rank)
    out = df.groupBy(*keys).agg(agg.alias("_keep"))
    return out.select(*keys, *[F.col(f"_keep.{c}").alias(c) for c in [*order_by, *rest]]).select(*df.columns)


# --------------------------------------------------------------------------
# top-n per group (skew-safe)
# --------------------------------------------------------------------------


def _group_limit_threshold(spark) -> int:
    try:
        return int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    except Exception:  # noqa: BLE001
        return 1000


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    salt_buckets: int = 64, rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group under a total ``order``.

    No task ever sorts a whole hot group.  For ``n`` up to the optimizer's
    window-group-limit threshold, ``row_number() <= n`` is planned with a
    map-side ``WindowGroupLimit``: every input task keeps only its first
    ``n`` per group before the shuffle.  Above the threshold the same bound
    is built by hand in two stages: rows are spread over ``salt_buckets``
    sub-groups by a hash of the row, each keeps its first ``n``, then at most
    ``salt_buckets * n`` candidates per group are ranked again.  Both are
    exact: a group's top ``n`` lies within the union of partial top ``n``s.
    """
    group = list(group)
    if not group:
        # one group: a distributed top-k (k rows kept per task), ranked after the cut
        ranked = top_k(df, order, n).withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
        return ranked.withColumnRenamed("_rn", rank_col) if rank_col else ranked.drop("_rn")
    cand = df
    if n > _group_limit_threshold(df.sparkSession):
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets)))
        w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
        cand = salted.withColumn("_rn", F.row_number().over(w1)).filter(F.col("_rn") <= n).drop("_rn", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    ranked = cand.withColumn("_rn", F.row_number().over(w2)).filter(F.col("_rn") <= n)
    if rank_col:
        return ranked.withColumnRenamed("_rn", rank_col)
    return ranked.drop("_rn")


def order_nulls_last(spec: Sequence[str | tuple[str, str]]) -> list[Column]:
    """Sort keys with NULLs last in both directions (the warehouse's default;
    Spark's own ascending default puts NULLs first).  ``spec`` items are a
    column name (ascending) or ``(name, 'asc' | 'desc')``."""
    out = []
    for item in spec:
        name, direction = (item, "asc") if isinstance(item, str) else item
        c = F.col(name)
        out.append(c.desc_nulls_last() if direction.lower() == "desc" else c.asc_nulls_last())
    return out


def row_number_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by group order by order)`` for any
    group size, with no task holding a whole group.

    Rows are range-partitioned and sorted on (group, order): the sampled
    range bounds split even a group holding a third of all rows over many
    tasks.  Each row's position inside its partition is fixed by a reliable
    checkpoint (so every consumer sees the same positions); per (group,
    partition) counts, summed over earlier partitions in a small window,
    give each partition's offset inside the group.  ``order`` must be a
    total order (end it with a unique key).
    """
    from tidewater.operators.writers import materialize

    group = list(group)
    keys = [*[F.col(g).asc() for g in group], *order]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    pid = F.spark_partition_id()
    tagged = materialize(ranged.withColumn("_pid", pid)
                         .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)))
    parts = tagged.groupBy(*group, "_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    parts = parts.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_pid").alias("_g_pid"),
                         "_first", "_before")
    # null-safe on the group columns: a NULL group is a group too
    cond = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col("_pid") == F.col("_g_pid")]
    joined = tagged.join(parts, on=cond, how="inner")
    rank = (F.col("_before") + F.col("_pos") - F.col("_first") + F.lit(1)).cast("bigint")
    return (joined.withColumn(name, rank)
            .drop("_pid", "_pos", "_first", "_before", "_g_pid", *[f"_g_{g}" for g in group]))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (distributed TakeOrderedAndProject: k rows kept per task)."""
    return df.orderBy(*order).limit(k)


# --------------------------------------------------------------------------
# U5 unpivot
# --------------------------------------------------------------------------


def unpivot_sides(df: DataFrame, ids: Sequence[str], sides: dict[str, str], side_col: str = "side",
                  value_col: str = "value") -> DataFrame:
    """One row per id and side: ``{'home': 'home_team_id', ...}`` -> (ids, side, value).

    A narrow transformation (``Expand``): no shuffle.
    """
    renamed = df.select(*ids, *[F.col(src).alias(name) for name, src in sides.items()])
    return renamed.unpivot(list(ids), list(sides), side_col, value_col)


# --------------------------------------------------------------------------
# U6 / U7 / U8 / U9 series and spines
# --------------------------------------------------------------------------


def number_series(spark: SparkSession, n: int, name: str = "generated_number") -> DataFrame:
    """1..n as a distributed range (no single-partition window)."""
    return spark.range(1, int(n) + 1).withColumnRenamed("id", name)


def number_series_to(df: DataFrame, upper: Column, name: str = "generated_number",
                     lower: Column | None = None) -> DataFrame:
    """``lower``..``upper`` where the bound is an aggregate of ``df``.

    The bound is fetched as a single scalar, then the range is generated in
    parallel with ``spark.range``.
    """
    lo = lower if lower is not None else F.lit(1)
    row = df.agg(lo.cast("bigint").alias("lo"), upper.cast("bigint").alias("hi")).first()
    if row is None or row["hi"] is None:
        return df.sparkSession.range(0).withColumnRenamed("id", name)
    return df.sparkSession.range(int(row["lo"]), int(row["hi"]) + 1).withColumnRenamed("id", name)


_STEP = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH",
         "quarter": "INTERVAL 3 MONTH", "year": "INTERVAL 1 YEAR"}


def date_spine_from(bounds: DataFrame, part: str, start: str = "start", end: str = "end",
                    name: str | None = None) -> DataFrame:
    """Periods ``start + k units`` for ``k < boundaries(start, end)`` and ``<= end``.

    ``bounds`` holds one row per spine (e.g. one aggregate row of a table);
    the end is effectively exclusive.  Spines are calendars (days, months):
    small by nature, generated by ``sequence`` inside one row each.
    """
    part = part.lower()
    name = name or f"date_{part}"
    n = _datediff(F.col(start), F.col(end), part)
    # end before start: no periods (a sequence with a positive step would raise)
    seq = F.when(F.to_date(end) >= F.to_date(start),
                 F.sequence(F.to_date(start), F.to_date(end), F.expr(_STEP[part]))).otherwise(F.array().cast("array<date>"))
    spine = bounds.select(F.to_date(start).alias("_s"), F.to_date(end).alias("_e"), n.alias("_n"),
                          F.posexplode(seq).alias("_k", name))
    return spine.filter((F.col("_k") < F.col("_n")) & (F.col(name) <= F.col("_e"))) \
        .select(F.col(name).cast("date").alias(name))


def date_spine(spark: SparkSession, part: str, start: dt.date, end: dt.date) -> DataFrame:
    bounds = spark.createDataFrame([(start, end)], "start date, end date")
    return date_spine_from(bounds, part)


def _as_date(value, in_fmt: str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    try:
        return dt.datetime.strptime(str(value).strip(), in_fmt).date()
    except ValueError as e:
        raise ValueError(f"partition date {value!r} does not follow the format {in_fmt!r}") from e


def dates_in_range(spark: SparkSession, start, end=None, fmt: str = "yyyyMMdd",
                   in_fmt: str = "%Y%m%d") -> DataFrame:
    """Inclusive list of dates as text in ``fmt`` (a Spark pattern).

    ``start`` / ``end`` are dates or text in ``in_fmt``; ``end`` defaults to
    ``start``; start after end is an error."""
    start = _as_date(start, in_fmt)
    end = start if end is None else _as_date(end, in_fmt)
    if start > end:
        raise ValueError(f"date range {start}..{end} is empty: the first date comes after the last")
    bounds = spark.createDataFrame([(start, end)], "start date, end date")
    d = bounds.select(F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return d.select(F.date_format("d", fmt).alias("date_str"))


def partition_range(spark: SparkSession, spec: str, in_fmt: str = "%Y%m%d", fmt: str = "yyyyMMdd") -> DataFrame:
    """``"start[,end]"`` partition text -> the inclusive dates between."""
    parts = str(spec).split(",")
    if len(parts) not in (1, 2):
        raise ValueError(f"partition range must be 'start' or 'start,end', got {spec!r}")
    return dates_in_range(spark, parts[0], parts[1] if len(parts) == 2 else None, fmt=fmt, in_fmt=in_fmt)


def season_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Inclusive season years ``start..end`` as strings; start > end is an error."""
    if start > end:
        raise ValueError(f"season range {start}..{end} is empty: the first season comes after the last")
    return spark.range(start, end + 1).select(F.col("id").cast("string").alias("season"))


# --------------------------------------------------------------------------
# A11 listagg
# --------------------------------------------------------------------------


def listagg(df: DataFrame, group: Sequence[str], measure: str, delimiter: str = ",",
            order_by: Sequence[str] | None = None, limit: int | None = None, name: str = "listagg",
            descending: bool = False) -> DataFrame:
    """Ordered string aggregation per group, optionally of the first ``limit``.

    With a limit the candidates are first cut to ``limit`` per group by the
    skew-safe ``top_n_per_group``; the final string is assembled from a
    sorted ``collect_list`` of (order, measure) pairs.
    """
    group = list(group)
    order_by = list(order_by or [measure])
    src = df.select(*group, *[F.col(c) for c in dict.fromkeys([*order_by, measure])])
    if limit is not None:
        sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order_by]
        sort.append(F.col(measure).asc())
        src = top_n_per_group(src, group, sort, limit)
    pairs = F.collect_list(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_by)],
                                    F.col(measure).cast("string").alias("v")))
    sorted_pairs = F.array_sort(pairs)
    if descending:
        sorted_pairs = F.reverse(sorted_pairs)
    text = F.array_join(F.transform(sorted_pairs, lambda x: x["v"]), delimiter)
    return src.groupBy(*group).agg(text.alias(name))
