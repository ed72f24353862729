"""Incremental load strategies as pure functions ``(target, source, ...) -> new target``.

Parquet tables cannot be updated in place, so every strategy returns the
complete new state of the target as a lazy DataFrame; ``writers`` persists it
(staging path + swap, or dynamic partition overwrite).  Returning a
DataFrame keeps each strategy checkable against a SQL oracle and lets the
same code run per micro-batch from ``foreachBatch``.

Scale notes: every strategy joins on the unique key only (one shuffle of each
side on the key, or a broadcast of the increment when the planner measures its
bytes as small); no side is forced into a broadcast.  The source's key
multiplicity is computed with an aggregate (map-side combine).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# --------------------------------------------------------------------------
# schema alignment and evolution
# --------------------------------------------------------------------------


def align_to(df: DataFrame, schema: T.StructType, warn=None) -> DataFrame:
    """Project ``df`` onto a target schema: missing columns become typed NULLs,
    extra columns are dropped (reported through ``warn``), order follows the target."""
    have = set(df.columns)
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    if extra and warn is not None:
        warn(f"columns not in the target are left out ({len(extra)}): {', '.join(extra)}")
    cols = [(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields]
    return df.select(*cols)


def without_extra(df: DataFrame, schema: T.StructType, warn=None) -> DataFrame:
    """``df`` without columns that the schema lacks (reported through ``warn``)."""
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    if extra and warn is not None:
        warn(f"columns not in the target are left out ({len(extra)}): {', '.join(extra)}")
    return df.drop(*extra)


@dataclass
class SchemaDiff:
    added: list[T.StructField] = field(default_factory=list)      # in source, not in target
    removed: list[T.StructField] = field(default_factory=list)    # in target, not in source
    retyped: list[tuple[str, T.DataType, T.DataType]] = field(default_factory=list)  # (name, target, source)

    @property
    def changed(self) -> bool:
        return bool(self.added or self.removed or self.retyped)


def schema_diff(target: T.StructType, source: T.StructType) -> SchemaDiff:
    tmap = {f.name: f for f in target.fields}
    smap = {f.name: f for f in source.fields}
    d = SchemaDiff()
    d.added = [f for f in source.fields if f.name not in tmap]
    d.removed = [f for f in target.fields if f.name not in smap]
    d.retyped = [(n, tmap[n].dataType, smap[n].dataType) for n in tmap
                 if n in smap and tmap[n].dataType != smap[n].dataType]
    return d


# Decimal digits that hold every value of an integer type.
_INTEGER_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_EXACT_IN_FLOAT = (T.ByteType, T.ShortType)


def _as_decimal(t: T.DataType) -> T.DecimalType | None:
    if isinstance(t, T.DecimalType):
        return t
    digits = _INTEGER_DIGITS.get(type(t))
    return T.DecimalType(digits, 0) if digits else None


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type both values fit in: integers by size, decimals by digits before and
    after the point, binary fractions as double (float only where it is exact),
    dates as timestamps, everything else as text."""
    if a == b:
        return a
    da, db = _as_decimal(a), _as_decimal(b)
    if da and db:
        if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
            scale = max(da.scale, db.scale)
            whole = max(da.precision - da.scale, db.precision - db.scale)
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
        return a if da.precision >= db.precision else b
    fractions = (T.FloatType, T.DoubleType)
    if isinstance(a, fractions + (T.NumericType,)) and isinstance(b, fractions + (T.NumericType,)):
        if {type(a), type(b)} <= {T.FloatType, *_EXACT_IN_FLOAT}:
            return T.FloatType()
        return T.DoubleType()
    if isinstance(a, T.DateType) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
        return b
    if isinstance(b, T.DateType) and isinstance(a, (T.TimestampType, T.TimestampNTZType)):
        return a
    return T.StringType()


def widen_target(target: DataFrame, source: DataFrame, to_text: bool = True) -> tuple[DataFrame, DataFrame]:
    """Cast both sides of shared columns to their wider type (I18); with
    ``to_text=False`` only where that is a number or a time."""
    smap = {f.name: f.dataType for f in source.schema.fields}
    tcols, scasts = [], {}
    for f in target.schema.fields:
        w = wider_type(f.dataType, smap[f.name]) if f.name in smap else f.dataType
        if f.name in smap and smap[f.name] != f.dataType and (to_text or not isinstance(w, T.StringType)):
            tcols.append(F.col(f.name).cast(w).alias(f.name))
            scasts[f.name] = w
        else:
            tcols.append(F.col(f.name))
    s = source.select(*[(F.col(c).cast(scasts[c]) if c in scasts else F.col(c)).alias(c) for c in source.columns])
    return target.select(*tcols), s


def reconcile(target: DataFrame, source: DataFrame, mode: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """Types, then columns: shared columns are widened so that no value of the source is
    cut (not for ``sync_all_columns``, which takes the source's types, nor for ``fail``),
    then ``on_schema_change`` settles the column sets."""
    if mode in ("ignore", "append_new_columns"):
        target, source = widen_target(target, source, to_text=False)
    return on_schema_change(target, source, mode)


def on_schema_change(target: DataFrame, source: DataFrame, mode: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """Reconcile target and source schemas before a strategy runs (I16).

    ``ignore``: source is aligned to the target (new columns dropped);
    ``append_new_columns``: target gains the source's new columns (NULL);
    ``sync_all_columns``: target takes the source's column set (removed
    columns dropped, retyped columns cast); ``fail``: raise on any difference.
    """
    d = schema_diff(target.schema, source.schema)
    if mode == "ignore" or not d.changed:
        return target, align_to(source, target.schema)
    if mode == "fail":
        raise ValueError(
            "on_schema_change='fail' and the schemas differ: "
            f"added={[f.name for f in d.added]} removed={[f.name for f in d.removed]} "
            f"retyped={[n for n, _, _ in d.retyped]}")
    if mode == "append_new_columns":
        new_schema = T.StructType(list(target.schema.fields) + d.added)
        return align_to(target, new_schema), align_to(source, new_schema)
    if mode == "sync_all_columns":
        smap = {f.name: f for f in source.schema.fields}
        kept = [T.StructField(f.name, smap[f.name].dataType, True) for f in target.schema.fields if f.name in smap]
        new_schema = T.StructType(kept + d.added)
        return align_to(target, new_schema), align_to(source, new_schema)
    raise ValueError(f"invalid on_schema_change value {mode!r}")


def restrict_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep only ``df``'s columns that the schema has, cast to its types
    (missing columns are *not* added: a by-name update leaves them alone)."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) for c in df.columns if c in types])


def key_list(unique_key: str | Sequence[str] | None) -> list[str]:
    if unique_key is None:
        return []
    return [unique_key] if isinstance(unique_key, str) else list(unique_key)


def all_of(conditions: str | Column | Sequence[str | Column] | None) -> Column:
    """All of one or several conditions hold (an unknown one does not)."""
    if conditions is None:
        return F.lit(True)
    if isinstance(conditions, (str, Column)):
        conditions = [conditions]
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(_expr(c), F.lit(False))
    return out


def in_slice(event_time: str, start, end) -> Column:
    """``[start, end)`` of event time."""
    s, e = F.lit(start), F.lit(end)
    if isinstance(start, dt.datetime):
        s, e = s.cast("timestamp_ntz"), e.cast("timestamp_ntz")
    return (F.col(event_time) >= s) & (F.col(event_time) < e)


def key_range_split(target: DataFrame, source: DataFrame, key: str) -> tuple[DataFrame, DataFrame] | None:
    """Split the target by the source's ``[min, max]`` on ``key``.

    Target rows outside the range (or with a NULL key) cannot match any
    source row, so they bypass the join; the range predicates are pushed into
    the target's scan, so with an increment of recent keys only a thin slice
    of the target is shuffled.  Returns ``(outside, inside)``, or ``None``
    when the key type has no order.  One small aggregate of the source is
    run to fetch the two bounds, so this is for callers who know that keys grow
    with time: with random keys the range spans the table and the outside
    branch is a second scan for nothing.
    """
    dtype = source.schema[key].dataType
    if isinstance(dtype, (T.MapType, T.ArrayType, T.StructType, T.BinaryType)):
        return None
    lo, hi = source.agg(F.min(key), F.max(key)).first()
    if lo is None:
        return target, target.limit(0)
    inside = F.col(key).between(F.lit(lo).cast(dtype), F.lit(hi).cast(dtype))
    return target.filter(~F.coalesce(inside, F.lit(False))), target.filter(inside)


# --------------------------------------------------------------------------
# I6 append, I7 delete+insert, I12 insert overwrite, I13 microbatch, I1 partition upsert
# --------------------------------------------------------------------------


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    """Insert all source rows (aligned to the target's columns, types widened where a value would be cut)."""
    target, src = reconcile(target, source)
    return target.unionByName(src)


def delete_insert(target: DataFrame, source: DataFrame, unique_key: str | Sequence[str] | None,
                  predicates: Sequence[Column | str] = (), prune_by_key_range: bool = False) -> DataFrame:
    """Delete target rows whose key occurs in the source (and that satisfy all
    ``predicates``, written over target columns), then insert the source.

    Without a key it is an append.  The source's distinct keys are a partial
    aggregate; the delete is a left join on the key (skewed partitions are
    split by AQE), and with ``prune_by_key_range`` only target rows inside
    the source's key range take part in it.
    """
    keys = key_list(unique_key)
    target, src = reconcile(target, source)
    if not keys:
        return target.unionByName(src)
    if prune_by_key_range:
        split = key_range_split(target, source, keys[0])
        if split is not None:
            outside, inside = split
            return outside.unionByName(delete_insert(inside, source, keys, predicates, prune_by_key_range=False))
    hit = source.select(*keys).groupBy(*keys).agg(F.lit(True).alias("_hit"))
    marked = target.join(hit, on=keys, how="left")
    delete = F.coalesce(F.col("_hit"), F.lit(False)) & all_of(predicates)
    kept = marked.filter(~delete).select(*target.columns)
    return kept.unionByName(src)


def insert_overwrite(target: DataFrame, source: DataFrame, partition_by: Sequence[str] = (),
                     predicates: Sequence[Column | str] = ()) -> DataFrame:
    """Replace target data with the source.

    With ``partition_by`` only partitions present in the source are replaced
    (dynamic overwrite); with ``predicates`` target rows matching all of them
    are deleted; with neither the whole target is replaced.
    """
    target, src = reconcile(target, source)
    if partition_by:
        parts = source.select(*partition_by).groupBy(*partition_by).agg(F.lit(True).alias("_p"))
        kept = target.join(parts, on=list(partition_by), how="left_anti").select(*target.columns)
        return kept.unionByName(src)
    if predicates:
        return target.filter(~all_of(predicates)).unionByName(src)
    return src


def microbatch(target: DataFrame, source: DataFrame, event_time: str | None, start, end,
               unique_key: str | Sequence[str] | None = None,
               predicates: Sequence[Column | str] = ()) -> DataFrame:
    """Replace one ``[start, end)`` slice of event time: delete the target's
    rows in the slice (and matching ``predicates``), insert the source's rows
    in the slice.  A key is rejected: batches are replaced, not upserted."""
    if not event_time:
        raise ValueError("microbatch needs the event-time column that defines the batches")
    if key_list(unique_key):
        raise ValueError("microbatch replaces whole time slices; a unique key has no meaning here")
    if start is None or end is None:
        raise ValueError("microbatch needs both batch bounds (start inclusive, end exclusive)")
    target, source = reconcile(target, source)
    in_batch = in_slice(event_time, start, end)
    delete = in_batch & all_of(predicates)
    kept = target.filter(~F.coalesce(delete, F.lit(False)))
    return kept.unionByName(source.filter(in_batch))


def microbatches(target: DataFrame, source: DataFrame, event_time: str, bounds: Sequence[tuple]) -> DataFrame:
    """Many ``[start, end)`` batches in one plan (one job, not one per batch)."""
    target, source = reconcile(target, source)
    cond = F.lit(False)
    for s, e in bounds:
        cond = cond | in_slice(event_time, s, e)
    kept = target.filter(~F.coalesce(cond, F.lit(False)))
    return kept.unionByName(source.filter(cond))


def partition_upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str] = ("season", "season_type"),
                     mode: str = "upsert", warn=None) -> DataFrame:
    """Replace the partitions (e.g. ``season``, ``season_type``) the source
    carries; other partitions are kept.  The first load creates the table;
    an empty source is a no-op.  Keys absent from the target fall back to the
    first available subset; with none at all an explicit ``mode='append'``
    is required (reruns would duplicate rows).
    """
    if target is None:
        return source
    target, src = reconcile(target, without_extra(source, target.schema, warn))
    present = [k for k in keys if k in target.columns]
    if not present:
        if mode != "append":
            raise ValueError("target has no partition key column; pass mode='append' to append")
        return target.unionByName(src)
    parts = source.select(*present).groupBy(*present).agg(F.lit(True).alias("_p"))
    kept = target.join(parts, on=present, how="left_anti").select(*target.columns)
    return kept.unionByName(src)


# --------------------------------------------------------------------------
# I8-I11 merge
# --------------------------------------------------------------------------

_MATCHED_ACTIONS = {"update", "delete", "do_nothing", "error"}
_NOT_MATCHED_ACTIONS = {"insert", "do_nothing", "error"}
_BY_SOURCE_ACTIONS = {"update", "delete", "do_nothing", "error"}


@dataclass
class Clause:
    """One ``WHEN`` clause.

    ``kind``: ``matched`` | ``not_matched`` (by target) | ``not_matched_by_source``.
    ``condition``: SQL over aliases ``s`` (source) and ``t`` (target) or a Column, or a
    list of them that must all hold.
    ``action``: update / insert / delete / do_nothing / error.
    ``mode`` for update/insert: ``by_name`` (all shared columns), ``by_position`` (the
    target's columns take the source's in order) or ``explicit``.
    ``include`` / ``exclude``: update column lists; ``set``: column -> SQL expression.
    ``insert_columns`` / ``insert_values``: explicit insert.
    """

    kind: str
    action: str
    condition: str | Column | Sequence[str | Column] | None = None
    mode: str = "by_name"
    include: Sequence[str] = ()
    exclude: Sequence[str] = ()
    set: Mapping[str, str | Column] = field(default_factory=dict)
    insert_columns: Sequence[str] = ()
    insert_values: Sequence[str | Column] = ()
    error_message: str = ""


def validate_merge(clauses: Sequence[Clause] | None, target_columns: Sequence[str], source_columns: Sequence[str],
                   basic: Mapping[str, object]) -> None:
    """All option problems at once (I11).  ``basic``: the options of the short form by name."""
    errs = []
    given = [name for name, value in basic.items() if value]
    if basic.get("update_columns") and basic.get("exclude_columns"):
        errs.append("update_columns and exclude_columns cannot both be set")
    for name in ("update_columns", "exclude_columns", "set_expressions"):
        errs += [f"{name}: column {c!r} not in target" for c in basic.get(name) or () if c not in target_columns]
    if clauses is not None:
        if not clauses:
            errs.append("clauses must hold at least one clause")
        if given:
            errs.append(f"clauses replace the basic options; remove {', '.join(given)}")
    for i, c in enumerate(clauses or ()):
        allowed = {"matched": _MATCHED_ACTIONS, "not_matched": _NOT_MATCHED_ACTIONS,
                   "not_matched_by_source": _BY_SOURCE_ACTIONS}.get(c.kind)
        if allowed is None:
            errs.append(f"clause {i}: unknown kind {c.kind!r}")
            continue
        if c.action not in allowed:
            errs.append(f"clause {i}: action {c.action!r} not allowed for {c.kind}")
        if c.mode not in ("by_name", "explicit", "star", "by_position"):
            errs.append(f"clause {i}: unknown mode {c.mode!r}")
        if c.mode == "by_position" and len(source_columns) != len(target_columns):
            errs.append(f"clause {i}: by_position needs {len(target_columns)} source columns, found {len(source_columns)}")
        if c.action == "update" and c.mode == "explicit" and not (c.include or c.exclude or c.set):
            errs.append(f"clause {i}: an explicit update names columns or expressions")
        if c.action == "insert" and c.mode == "explicit" and not c.insert_columns:
            errs.append(f"clause {i}: an explicit insert names its columns")
        if not isinstance(c.condition, (str, Column, type(None))) and not list(c.condition):
            errs.append(f"clause {i}: an empty list of conditions")
        for col in [*c.include, *c.exclude, *c.set, *c.insert_columns]:
            if col not in target_columns:
                errs.append(f"clause {i}: column {col!r} not in target")
        if c.insert_columns and len(c.insert_columns) != len(c.insert_values):
            errs.append(f"clause {i}: insert columns and values differ in length")
        if c.kind == "not_matched_by_source" and c.action == "update" and not c.set:
            errs.append(f"clause {i}: update by source needs set expressions")
    if errs:
        raise ValueError("Invalid merge configuration:\n  " + "\n  ".join(errs))


def _expr(e: str | Column) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def default_clauses(update_columns: Sequence[str] = (), exclude_columns: Sequence[str] = (),
                    set_expressions: Mapping[str, str] | None = None, update_condition: str | None = None,
                    insert_condition: str | None = None) -> list[Clause]:
    explicit = bool(update_columns or exclude_columns or set_expressions)
    return [
        Clause("matched", "update", update_condition, mode="explicit" if explicit else "by_name",
               include=tuple(update_columns), exclude=tuple(exclude_columns), set=dict(set_expressions or {})),
        Clause("not_matched", "insert", insert_condition, mode="by_name"),
    ]


def merge(target: DataFrame, source: DataFrame, unique_key: str | Sequence[str] | None = None,
          clauses: Sequence[Clause] | None = None, update_columns: Sequence[str] = (),
          exclude_columns: Sequence[str] = (), set_expressions: Mapping[str, str] | None = None,
          update_condition: str | Sequence[str] | None = None, insert_condition: str | Sequence[str] | None = None,
          using: Sequence[str] = (), predicates: Sequence[str | Column] = (),
          returning: bool | Sequence[str] = False, prune_by_key_range: bool = False) -> DataFrame:
    """MERGE as a DataFrame: new target state (or, with ``returning``, the affected rows,
    all columns or those named).

    Matching is ``keys equal AND predicates``.  Clauses are tried in order
    per row; the first whose condition holds decides the row's action.  A
    target row that matches two source rows raises, like MERGE does.  Without a
    key and without ``using`` nothing matches.

    Plan: the target's rows are left-joined to the source (AQE splits skewed keys,
    and broadcasts a side whose measured bytes allow it), and the source's rows
    that match nothing are found by an anti join against the target's key columns
    alone.  Without a key there is no join at all.  ``prune_by_key_range`` lets
    target rows outside the source's key range skip the join (see
    ``key_range_split``).
    """
    keys = list(using) or key_list(unique_key)
    tcols, scols = list(target.columns), list(source.columns)
    validate_merge(clauses, tcols, scols, {
        "update_columns": update_columns, "exclude_columns": exclude_columns, "set_expressions": set_expressions,
        "update_condition": update_condition, "insert_condition": insert_condition})
    clauses = list(clauses) if clauses is not None else default_clauses(
        update_columns, exclude_columns, set_expressions, update_condition, insert_condition)
    # Target rows outside the source's key range can only be "not matched by
    # source": with no clause for those they are unchanged and skip the join.
    if prune_by_key_range and keys and not any(c.kind == "not_matched_by_source" for c in clauses):
        split = key_range_split(target, source, keys[0])
        if split is not None:
            outside, inside = split
            merged = merge(inside, source, unique_key, clauses, using=using, predicates=predicates, returning=returning)
            return merged if returning else outside.unionByName(merged)

    rows = lambda j, **sides: _merge_rows(j, clauses, tcols, scols, target.schema, returning, **sides)
    t = target.withColumn("_t_here", F.lit(True))
    if not keys:
        by_source = rows(t.alias("t"), has_source=False)
        return by_source.unionByName(rows(source.withColumn("_s_here", F.lit(True)).alias("s"), has_target=False))
    counts = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_src_n"))
    # left: source rows with a null key never match but are still inserted
    s = source.join(counts, on=keys, how="left").select(*scols, "_src_n").withColumn("_s_here", F.lit(True)).alias("s")
    if predicates:
        # keys repeat in the source: only a predicate can still leave one match per target row
        t = t.withColumn("_t_id", F.monotonically_increasing_id())
    t = t.alias("t")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    for p in predicates:
        cond = cond & _expr(p)
    left = t.join(s, on=cond, how="left")
    if predicates:
        # counted only where a key repeats; other rows are alone in their window
        own = F.when(F.col("s._src_n") > 1, F.col("t._t_id"))
        matches = F.count("*").over(Window.partitionBy("t._t_id", own))
        left = left.withColumn("_twice", (F.col("s._src_n") > 1) & (matches > 1))
    else:
        left = left.withColumn("_twice", F.col("s._src_n") > 1)
    unmatched = s.join(target.alias("t"), on=cond, how="left_anti")
    return rows(left).unionByName(rows(unmatched, has_target=False))


def _merge_rows(j: DataFrame, clauses: Sequence[Clause], tcols: Sequence[str], scols: Sequence[str],
                schema: T.StructType, returning: bool | Sequence[str], has_target: bool = True,
                has_source: bool = True) -> DataFrame:
    """Clause evaluation over joined rows (``t`` / ``s`` aliases): the new target
    rows, or with ``returning`` the affected rows and their action.  Without a
    target side every row is a source row that matched nothing, without a source
    side every row is a target row that matched nothing."""
    clauses = [c if (has_target or c.kind == "not_matched") and (has_source or c.kind == "not_matched_by_source") else None
               for c in clauses]
    s_here = F.coalesce(F.col("s._s_here"), F.lit(False)) if has_source else F.lit(False)
    t_here = F.coalesce(F.col("t._t_here"), F.lit(False)) if has_target else F.lit(False)
    matched, only_s, only_t = t_here & s_here, s_here & ~t_here, t_here & ~s_here
    kinds = {"matched": matched, "not_matched": only_s, "not_matched_by_source": only_t}

    # clause id per row: first applicable clause; -1 = no clause applies
    cid = F.lit(-1)
    for i in reversed(range(len(clauses))):
        c = clauses[i]
        if c is None:
            continue
        applies = kinds[c.kind] & all_of(c.condition)
        cid = F.when(applies, F.lit(i)).otherwise(cid)
    j = j.withColumn("_cid", cid)

    values: dict[str, Column] = {}
    for col in tcols:
        v = F.col(f"t.{col}") if has_target else F.lit(None)
        for i, c in enumerate(clauses):
            if c is None:
                continue
            nv = _clause_value(c, col, scols, tcols)
            if nv is not None:
                v = F.when(F.col("_cid") == i, nv).otherwise(v)
        values[col] = v.cast(schema[col].dataType)

    action = F.lit("keep")
    for i, c in enumerate(clauses):
        if c is not None:
            action = F.when(F.col("_cid") == i, F.lit(c.action)).otherwise(action)
    action = F.when((F.col("_cid") == -1) & only_s, F.lit("skip")).otherwise(action)
    j = j.withColumn("_action", action)

    check = F.lit(None).cast("boolean")
    if has_target and has_source:
        check = F.when(matched & F.coalesce(F.col("_twice"), F.lit(False)),
                       F.raise_error(F.lit("MERGE: a target row matches more than one source row")).cast("boolean"))
    for i, c in enumerate(clauses):
        if c is not None and c.action == "error":
            msg = c.error_message or f"MERGE: error clause {i} fired"
            check = F.when(F.col("_cid") == i, F.raise_error(F.lit(msg)).cast("boolean")).otherwise(check)
    j = j.filter(F.coalesce(check, F.lit(True)))

    if returning:
        shown = tcols if returning is True else list(returning)
        return (j.filter(~F.col("_action").isin("keep", "skip", "do_nothing"))
                .select(*[values[c].alias(c) for c in shown], F.col("_action").alias("merge_action")))
    out = j.filter(~F.col("_action").isin("delete", "skip") &
                   ~((F.col("_action") == "do_nothing") & only_s))
    return out.select(*[values[c].alias(c) for c in tcols])


def _clause_value(c: Clause, col: str, scols: Sequence[str], tcols: Sequence[str]) -> Column | None:
    """New value of target column ``col`` under clause ``c`` (None = unchanged)."""
    by_place = F.col(f"s.{scols[list(tcols).index(col)]}") if c.mode == "by_position" else None
    if c.action == "update":
        if col in c.set:
            return _expr(c.set[col])
        if c.kind == "not_matched_by_source":
            return None
        if by_place is not None:
            return by_place
        if c.mode == "explicit":
            chosen = list(c.include) if c.include else [x for x in tcols if x not in c.exclude]
            if col not in chosen:
                return None
        return F.col(f"s.{col}") if col in scols else None
    if c.action == "insert":
        if by_place is not None:
            return by_place
        if c.mode == "explicit" and c.insert_columns:
            if col in c.insert_columns:
                return _expr(c.insert_values[list(c.insert_columns).index(col)])
            return F.lit(None)
        return F.col(f"s.{col}") if col in scols else F.lit(None)
    return None


# --------------------------------------------------------------------------
# I14 dispatcher
# --------------------------------------------------------------------------


def incremental(target: DataFrame | None, source: DataFrame, strategy: str = "delete+insert",
                unique_key=None, on_schema_change_mode: str = "ignore", full_refresh: bool = False,
                **opts) -> DataFrame:
    """First run / full refresh builds from the source; otherwise reconcile
    schemas and apply the strategy."""
    if target is None or full_refresh:
        return source
    raw_source = source
    target, source = reconcile(target, source, on_schema_change_mode)
    if strategy == "append":
        return append(target, source)
    if strategy in ("delete+insert", "delete_insert"):
        return delete_insert(target, source, unique_key, opts.get("predicates", ()))
    if strategy == "merge":
        by_place = any(c.mode == "by_position" for c in opts.get("clauses") or ())
        return merge(target, raw_source if by_place else restrict_to(raw_source, target.schema), unique_key, **opts)
    if strategy == "insert_overwrite":
        return insert_overwrite(target, source, opts.get("partition_by", ()), opts.get("predicates", ()))
    if strategy == "microbatch":
        return microbatch(target, source, opts.get("event_time"), opts.get("start"), opts.get("end"),
                          unique_key, opts.get("predicates", ()))
    raise ValueError(f"unknown incremental strategy {strategy!r}")
