"""Data-quality checks.

Every check returns a DataFrame of *failures* (empty = pass); ``verdict``
turns failures into ``failures / should_warn / should_error``.  Multi-column
checks read the table once (conditional aggregates + unpivot) instead of one
query per column, and every grouping is an aggregate with a map-side partial
step, so a hot value never lands whole in one task.
"""

from __future__ import annotations

import datetime as dt
import operator
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# T1-T4 generic tests
# --------------------------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is null."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str | Column) -> DataFrame:
    """Values that occur more than once: ``(unique_field, n_records)`` (nulls ignored)."""
    c = F.col(column) if isinstance(column, str) else column
    return (df.select(c.alias("unique_field")).filter(F.col("unique_field").isNotNull())
            .groupBy("unique_field").agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the accepted list: ``(value_field, n_records)``; nulls pass."""
    g = df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return g.filter(~F.col("value_field").isin(list(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys with no parent row: ``from_field`` (an anti join)."""
    c = child.select(F.col(column).alias("from_field")).filter(F.col("from_field").isNotNull())
    p = parent.select(F.col(field).alias("from_field"))
    return c.join(p, "from_field", "left_anti")


# --------------------------------------------------------------------------
# T5 / T6 aggregated tests (one scan for many columns)
# --------------------------------------------------------------------------


def aggregated_not_null(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """Per column with nulls: ``(column_name, failures, should_warn, should_error)``."""
    cols = [c for c in columns if c not in skip]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column_name string, failures bigint, should_warn boolean, should_error boolean")
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    stacked = counts.unpivot([], cols, "column_name", "failures")
    return (stacked.filter(F.col("failures") > 0)
            .select("column_name", "failures", (F.col("failures") > 0).alias("should_warn"),
                    (F.col("failures") > 0).alias("should_error")))


def aggregated_unique(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """Repeated values of each column: ``(column_name, unique_field, n_records)``."""
    cols = [c for c in columns if c not in skip]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, unique_field string, n_records bigint")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                         F.col(c).try_cast("string").alias("unique_field"),
                                         F.col(c).isNotNull().alias("present")) for c in cols]))
    long = df.select(pairs.alias("p")).select("p.*").filter(F.col("present"))
    return (long.groupBy("column_name", "unique_field").agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def aggregated_failures(failure_rows: DataFrame) -> DataFrame:
    """Roll failure rows that carry a ``column_name`` into one verdict per column."""
    return (failure_rows.groupBy("column_name").agg(F.count(F.lit(1)).alias("failures"))
            .select("column_name", "failures", (F.col("failures") > 0).alias("should_warn"),
                    (F.col("failures") > 0).alias("should_error")))


# --------------------------------------------------------------------------
# T7 verdict
# --------------------------------------------------------------------------

_OPS = {"!=": operator.ne, "<>": operator.ne, "=": operator.eq, "==": operator.eq, ">": operator.gt,
        ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def _condition(value: Column, cond: str) -> Column:
    m = re.fullmatch(r"\s*(!=|<>|==|=|>=|<=|>|<)\s*(-?\d+)\s*", cond)
    if not m:
        raise ValueError(f"unsupported threshold {cond!r}")
    return _OPS[m.group(1)](value, F.lit(int(m.group(2))))


def verdict(failures: DataFrame, fail_calc: str = "count(*)", warn_if: str = "!= 0", error_if: str = "!= 0",
            limit: int | None = None) -> DataFrame:
    """``failures, should_warn, should_error`` from a failure set.

    ``fail_calc`` is an aggregate SQL expression over the failure rows;
    ``limit`` caps the failure rows read (the feature of the check).
    """
    src = failures.limit(limit) if limit is not None else failures
    calc = F.expr(fail_calc)
    agg = src.agg(F.coalesce(calc, F.lit(0)).cast("bigint").alias("failures"))
    return agg.select("failures", _condition(F.col("failures"), warn_if).alias("should_warn"),
                      _condition(F.col("failures"), error_if).alias("should_error"))


# --------------------------------------------------------------------------
# T8 store failures, T9 actual vs expected
# --------------------------------------------------------------------------


def store_failures(failures: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write the failing rows (replacing the previous run) and return them read back."""
    failures.write.mode("overwrite").format(fmt).save(path)
    return failures.sparkSession.read.format(fmt).load(path)


def actual_vs_expected(actual: DataFrame, expected: DataFrame, columns: Sequence[str] | None = None,
                       tag: str = "actual_or_expected") -> DataFrame:
    """Both sides in one frame, tagged ``'actual'`` / ``'expected'``."""
    cols = list(columns or expected.columns)
    a = actual.select(*cols, F.lit("actual").alias(tag))
    e = expected.select(*cols, F.lit("expected").alias(tag))
    return a.unionByName(e)


def diff(actual: DataFrame, expected: DataFrame, columns: Sequence[str] | None = None,
         tag: str = "actual_or_expected") -> DataFrame:
    """Rows in one side but not the other (bag semantics: duplicates count)."""
    cols = list(columns or expected.columns)
    a, e = actual.select(*cols), expected.select(*cols)
    return (a.exceptAll(e).withColumn(tag, F.lit("actual"))
            .unionByName(e.exceptAll(a).withColumn(tag, F.lit("expected"))))


# --------------------------------------------------------------------------
# T11 contract, T12 freshness, T13 profile
# --------------------------------------------------------------------------


def check_contract(df: DataFrame, expected: T.StructType, check_types: bool = True) -> list[str]:
    """Differences between a frame's schema and a declared contract (empty = ok)."""
    errs = []
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    if len(got) != len(want):
        errs.append(f"column count {len(got)} != {len(want)}")
    gnames, wnames = [n for n, _ in got], [n for n, _ in want]
    for n in wnames:
        if n not in gnames:
            errs.append(f"missing column {n}")
    for n in gnames:
        if n not in wnames:
            errs.append(f"unexpected column {n}")
    if check_types:
        gt = dict(got)
        for n, t in want:
            if n in gt and gt[n] != t:
                errs.append(f"column {n} is {gt[n].simpleString()}, expected {t.simpleString()}")
    return errs


def freshness(df: DataFrame, loaded_at: str, now: dt.datetime, warn_after: dt.timedelta | None = None,
              error_after: dt.timedelta | None = None, where: str | None = None) -> DataFrame:
    """``max_loaded_at, snapshotted_at, age_seconds, status`` with an injected clock."""
    src = df.filter(F.expr(where)) if where else df
    now_lit = F.lit(now).cast("timestamp_ntz")
    agg = src.agg(F.max(F.col(loaded_at)).cast("timestamp_ntz").alias("max_loaded_at"))
    age = (F.unix_micros(now_lit.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp")))
    age_s = (age / F.lit(1_000_000.0))
    status = F.lit("pass")
    if warn_after is not None:
        status = F.when(age_s > warn_after.total_seconds(), F.lit("warn")).otherwise(status)
    if error_after is not None:
        status = F.when(age_s > error_after.total_seconds(), F.lit("error")).otherwise(status)
    return agg.select("max_loaded_at", now_lit.alias("snapshotted_at"), age_s.alias("age_seconds"),
                      status.alias("status"))


def column_profile(df: DataFrame, table_name: str = "table", exact_distinct: bool = False) -> DataFrame:
    """One row per column: ``table_name, column_name, data_type, n_rows, n_nulls,
    n_distinct, min_value, max_value`` (text), from one aggregate pass.

    Distinct counts are sketches (``approx_count_distinct``).  With ``exact_distinct``
    a second pass turns each row into (column, value) pairs, keeps each pair once per
    task and then once, and counts them: one shuffle of distinct values, whatever the
    number of columns.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    fields = df.schema.fields
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        orderable = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
        aggs += [F.count_if(c.isNull()).alias(f"__nulls{i}"),
                 (F.min(c).cast("string") if orderable else F.lit(None).cast("string")).alias(f"__min{i}"),
                 (F.max(c).cast("string") if orderable else F.lit(None).cast("string")).alias(f"__max{i}")]
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"__distinct{i}"))
    rows = F.explode(F.array(*[F.struct(
        F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
        F.col(f"__nulls{i}").cast("bigint").alias("n_nulls"),
        (F.lit(0) if exact_distinct else F.col(f"__distinct{i}")).cast("bigint").alias("n_distinct"),
        F.col(f"__min{i}").alias("min_value"), F.col(f"__max{i}").alias("max_value"),
    ) for i, f in enumerate(fields)]))
    one = df.agg(*aggs).select(F.col("__rows").cast("bigint").alias("n_rows"), rows.alias("r")).select("n_rows", "r.*")
    if exact_distinct:
        pairs = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").cast("string").alias("v")) for f in fields])
        values = df.select(F.explode(pairs).alias("p")).select("p.*").where("v is not null").distinct()
        counted = values.groupBy("column_name").agg(F.count("*").alias("_d"))
        one = one.join(counted, "column_name", "left").withColumn("n_distinct", F.coalesce("_d", F.lit(0)).cast("bigint"))
    return one.select(F.lit(table_name).alias("table_name"), "column_name", "data_type", "n_rows", "n_nulls", "n_distinct",
                      "min_value", "max_value")


# --------------------------------------------------------------------------
# Profiles that add up
# --------------------------------------------------------------------------

HLL_BITS = 14            # distinct counts within about 1 %
_NUMBERS = (T.NumericType,)


def _orderable(f: T.StructField) -> bool:
    return not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))


def profile_state(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """One row per partition that profiles can be made of: row and null counts, bounds, and mergeable sketches of
    every other column's distinct values (HLL) and, for numbers, of its distribution (KLL).

    Stored beside a table, partition by partition (``upsert_partitions``), the profile of
    the whole costs a new partition's own scan only.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for f in df.schema.fields:
        if f.name in partition_by:
            continue
        c = F.col(f"`{f.name}`")
        aggs += [F.count_if(c.isNull()).alias(f"{f.name}__nulls"),
                 F.hll_sketch_agg(c.cast("string"), HLL_BITS).alias(f"{f.name}__hll")]
        if _orderable(f):
            aggs += [F.min(c).alias(f"{f.name}__min"), F.max(c).alias(f"{f.name}__max")]
        if isinstance(f.dataType, _NUMBERS):
            aggs.append(F.kll_sketch_agg_double(c.cast("double")).alias(f"{f.name}__kll"))
    return df.groupBy(*partition_by).agg(*aggs)


def merged_profile(states: DataFrame, table_name: str = "table") -> DataFrame:
    """The profile of all partitions whose states are given: ``column_profile``'s columns and ``median``."""
    names = [c.removesuffix("__nulls") for c in states.columns if c.endswith("__nulls")]
    have, aggs, cells = set(states.columns), [F.sum("n_rows").alias("n_rows")], []
    for i, n in enumerate(names):
        aggs += [F.sum(f"`{n}__nulls`").alias(f"nulls{i}"), F.hll_sketch_estimate(F.hll_union_agg(f"`{n}__hll`")).alias(f"distinct{i}")]
        bounds = f"{n}__min" in have
        if bounds:
            aggs += [F.min(f"`{n}__min`").alias(f"min{i}"), F.max(f"`{n}__max`").alias(f"max{i}")]
        if f"{n}__kll" in have:
            aggs.append(F.kll_merge_agg_double(f"`{n}__kll`").alias(f"kll{i}"))
        text = lambda c, there: F.col(c).cast("string") if there else F.lit(None).cast("string")
        median = F.when(F.col(f"n_rows") > F.col(f"nulls{i}"), F.kll_sketch_get_quantile_double(f"kll{i}", F.lit(0.5))) \
            if f"{n}__kll" in have else F.lit(None)
        kind = states.schema[f"{n}__min"].dataType.simpleString() if bounds else None
        cells.append(F.struct(F.lit(n).alias("column_name"), F.lit(kind).cast("string").alias("data_type"),
                              F.col(f"nulls{i}").cast("long").alias("n_nulls"), F.col(f"distinct{i}").cast("long").alias("n_distinct"),
                              text(f"min{i}", bounds).alias("min_value"), text(f"max{i}", bounds).alias("max_value"),
                              median.cast("double").alias("median")))
    one = states.agg(*aggs).select(F.col("n_rows").cast("long").alias("n_rows"), F.explode(F.array(*cells)).alias("c"))
    return one.select(F.lit(table_name).alias("table_name"), "c.column_name", "c.data_type", "n_rows", "c.n_nulls", "c.n_distinct",
                      "c.min_value", "c.max_value", "c.median")


def within_percentiles(df: DataFrame, values: DataFrame, low: float, high: float) -> DataFrame:
    """One row of booleans: whether each column's value in ``values`` (one row) lies between the exact percentiles ``low``
    and ``high`` (interpolated, as ``percentile`` gives them) of the column of that name.  Null without a value.

    Counts on both sides of the value and its neighbours decide that, so no task gets the column's values.
    """
    held = values.select(*[F.col(f"`{n}`").cast("double").alias(f"_v{i}") for i, n in enumerate(values.columns)])
    aggs, out = [], []
    for i, n in enumerate(values.columns):
        x, v = F.col(f"`{n}`").cast("double"), F.col(f"_v{i}")
        aggs += [F.max(v).alias(f"v{i}"), F.count(x).alias(f"n{i}"), F.count_if(x <= v).alias(f"le{i}"), F.count_if(x < v).alias(f"lt{i}"),
                 F.max(F.when(x <= v, x)).alias(f"at_most{i}"), F.min(F.when(x > v, x)).alias(f"above{i}"),
                 F.max(F.when(x < v, x)).alias(f"below{i}"), F.min(F.when(x >= v, x)).alias(f"at_least{i}")]

        def place(q, before, after):
            at = (F.col(f"n{i}") - 1) * F.lit(float(q))
            down, up = F.floor(at), F.ceil(at)
            return down, up, (up - at) * F.col(before) + (at - down) * F.col(after)

        v = F.col(f"v{i}")
        down, up, mid = place(low, f"at_most{i}", f"above{i}")
        reaches = F.when(F.col(f"le{i}") > up, True).when(F.col(f"le{i}") <= down, False).otherwise(mid <= v)
        down, up, mid = place(high, f"below{i}", f"at_least{i}")
        stays = F.when(F.col(f"lt{i}") <= down, True).when(F.col(f"lt{i}") > up, False).otherwise(v <= mid)
        out.append(F.when(v.isNotNull() & (F.col(f"n{i}") > 0), reaches & stays).alias(n))
    return df.crossJoin(F.broadcast(held)).agg(*aggs).select(*out)


def fixture_frame(spark, rows: Sequence[dict], schema: T.StructType | str) -> DataFrame:
    """Unit-test fixture rows (dicts) as a typed frame.

    Columns a row leaves out are NULL; a key that is not a column of the
    schema is an error (reported for all rows at once).
    """
    st = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    names = [f.name for f in st.fields]
    unknown = sorted({k for r in rows for k in r} - set(names))
    if unknown:
        raise ValueError(f"fixture columns not in the schema: {', '.join(unknown)}")
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], st)
