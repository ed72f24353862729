"""Type-2 history snapshots (H1-H9) as pure functions.

``snapshot(history, source, cfg, now)`` returns the complete new history.
All of it comes from one plan over one read of the history: the open rows
are full-outer-joined with the source once on the unique key; every joined
row then yields at most two output rows (the old version, possibly closed,
and a new version) through ``inline``.  Closed history rows pass through
untouched.  There is one shuffle on the key and no window.

``apply_snapshot`` keeps open and closed versions of a table apart on disk, so a
run reads and rewrites the open ones only and adds the versions it closes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.exprs import is_distinct_from, surrogate_key
from tidewater.operators import commits as C
from tidewater.operators import writers as W
from tidewater.operators.joins import full_join


@dataclass
class SnapshotConfig:
    unique_key: str | Sequence[str]
    strategy: str = "check"                 # "check" | "timestamp"
    updated_at: str | None = None           # source column with the row's own time (timestamp strategy: required)
    check_cols: str | Sequence[str] = "all"  # check strategy: "all" or column list
    hard_deletes: str = "ignore"            # "ignore" | "invalidate" | "new_record"
    valid_to_current: str | None = None     # SQL literal marking open rows (default NULL)
    column_names: dict = field(default_factory=dict)

    def name(self, meta: str) -> str:
        return self.column_names.get(meta, meta)

    @property
    def keys(self) -> list[str]:
        return [self.unique_key] if isinstance(self.unique_key, str) else list(self.unique_key)

    def validate(self) -> None:
        if self.strategy not in ("check", "timestamp"):
            raise ValueError(f"unknown snapshot strategy {self.strategy!r}")
        if self.strategy == "timestamp" and not self.updated_at:
            raise ValueError("timestamp strategy needs updated_at")
        if self.hard_deletes not in ("ignore", "invalidate", "new_record"):
            raise ValueError(f"invalid hard_deletes {self.hard_deletes!r}")


# The history's meta column names (renamable through ``column_names``),
# plus ``dbt_is_deleted`` ('True' / 'False') for hard_deletes='new_record'.
META = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def clock(spark: SparkSession) -> dt.datetime:
    """The session's time now (F18), one value for a whole run: the default time of a snapshot."""
    return spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").alias("t")).first().t


def _now(now: dt.datetime) -> Column:
    return F.lit(now).cast("timestamp_ntz")


def _updated_at(cfg: SnapshotConfig, now: dt.datetime, prefix: str = "") -> Column:
    if cfg.updated_at:
        return F.col(f"{prefix}{cfg.updated_at}").cast("timestamp_ntz")
    return _now(now)


def _current(cfg: SnapshotConfig) -> Column:
    if cfg.valid_to_current is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.expr(cfg.valid_to_current).cast("timestamp_ntz")


def _is_open(cfg: SnapshotConfig, valid_to: Column) -> Column:
    if cfg.valid_to_current is None:
        return valid_to.isNull()
    return valid_to.isNull() | (valid_to == F.expr(cfg.valid_to_current).cast("timestamp_ntz"))


def snapshot_initial(source: DataFrame, cfg: SnapshotConfig, now: dt.datetime) -> DataFrame:
    """First run (H1): every source row opens a version."""
    cfg.validate()
    upd = _updated_at(cfg, now)
    cols = [F.col(c) for c in source.columns] + [
        surrogate_key([*[F.col(k) for k in cfg.keys], upd]).alias(cfg.name("dbt_scd_id")),
        upd.alias(cfg.name("dbt_updated_at")),
        upd.alias(cfg.name("dbt_valid_from")),
        _current(cfg).alias(cfg.name("dbt_valid_to")),
    ]
    if cfg.hard_deletes == "new_record":
        cols.append(F.lit("False").alias(cfg.name("dbt_is_deleted")))
    return source.select(*cols)


CHANGE = "dbt_change_type"     # fixed value: the tag of the staged change set


def snapshot(history: DataFrame | None, source: DataFrame, cfg: SnapshotConfig, now: dt.datetime,
             prune_by_key_range: bool = False) -> DataFrame:
    """New history after taking a snapshot of ``source`` at ``now`` (H2-H9).

    With ``prune_by_key_range`` (for keys that grow with time) and
    ``hard_deletes='ignore'``, versions whose key lies outside the source's key
    range, which cannot change, bypass the join like closed rows do.
    """
    cfg.validate()
    if history is None:
        return snapshot_initial(source, cfg, now)
    if (prune_by_key_range and cfg.hard_deletes == "ignore"
            and not [c for c in source.columns if c not in history.columns]):
        from tidewater.operators.incremental import key_range_split
        split = key_range_split(history, source, cfg.keys[0])
        if split is not None:
            outside, inside = split
            return outside.unionByName(snapshot(inside, source, cfg, now))
    closed, versions = _versions(history, source, cfg, now)
    return closed.unionByName(versions.drop(CHANGE))


def _versions(history: DataFrame, source: DataFrame, cfg: SnapshotConfig, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(closed rows of the history, all other rows after the run tagged with their change).

    The tag is null for an open version that stays as it is, ``insert`` for a new
    version (deletion records included), ``update`` for a version closed by a
    change and ``delete`` for one closed because its key left the source.
    """
    keys = cfg.keys
    n_scd, n_upd, n_from, n_to = (cfg.name(m) for m in META)
    n_del = cfg.name("dbt_is_deleted")
    meta_names = [n_scd, n_upd, n_from, n_to] + ([n_del] if n_del in history.columns else [])
    data_cols = [c for c in history.columns if c not in meta_names]
    new_cols = [c for c in source.columns if c not in history.columns]
    out_data = data_cols + new_cols                       # history gains new source columns (H9)
    out_cols = out_data + [n_scd, n_upd, n_from, n_to] + ([n_del] if cfg.hard_deletes == "new_record" else [])
    if cfg.hard_deletes == "new_record" and n_del not in history.columns:
        history = history.withColumn(n_del, F.lit("False"))
    for c in new_cols:
        history = history.withColumn(c, F.lit(None).cast(source.schema[c].dataType))

    is_open = _is_open(cfg, F.col(n_to))
    closed = history.filter(~F.coalesce(is_open, F.lit(False))).select(*out_cols)
    open_rows = history.filter(F.coalesce(is_open, F.lit(False)))

    h = open_rows.select(*[F.col(c).alias(f"h_{c}") for c in open_rows.columns], F.lit(True).alias("_h"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("_s"))
    j = full_join(h, s, [(f"h_{k}", f"s_{k}") for k in keys])
    h_here = F.coalesce(F.col("_h"), F.lit(False))
    s_here = F.coalesce(F.col("_s"), F.lit(False))

    # change detection
    if cfg.strategy == "timestamp":
        changed = F.col(f"h_{n_from}") < F.col(f"s_{cfg.updated_at}").cast("timestamp_ntz")
    else:
        if cfg.check_cols == "all":
            if new_cols:
                changed = F.lit(True)                   # a new source column marks every row changed
            else:
                cols = [c for c in source.columns if c in data_cols]
                changed = _any_distinct(cols)
        elif any(c not in data_cols for c in cfg.check_cols):
            changed = F.lit(True)                       # a listed column that the history lacks: every row changed
        else:
            changed = _any_distinct(list(cfg.check_cols))
    changed = F.coalesce(changed, F.lit(False))
    if cfg.hard_deletes == "new_record":
        changed = changed | F.coalesce(F.col(f"h_{n_del}") == "True", F.lit(False))
    matched_changed = h_here & s_here & changed
    upd = _updated_at(cfg, now, prefix="s_")
    now_c = _now(now)

    # row 1: the open version, closed when changed or (hard) deleted
    deleting = h_here & ~s_here
    if cfg.hard_deletes == "new_record":
        deleting = deleting & ~F.coalesce(F.col(f"h_{n_del}") == "True", F.lit(False))
    close_at = F.when(matched_changed, upd)
    if cfg.hard_deletes in ("invalidate", "new_record"):
        close_at = close_at.when(deleting, now_c)
    old_vals = {c: F.col(f"h_{c}") for c in out_cols}
    old_vals[n_to] = F.coalesce(close_at, F.col(f"h_{n_to}"))
    closed_by = F.when(matched_changed, F.lit("update"))
    if cfg.hard_deletes in ("invalidate", "new_record"):
        closed_by = closed_by.when(deleting, F.lit("delete"))
    old_row = F.struct(h_here.alias("_emit"), closed_by.alias(CHANGE), *[old_vals[c].alias(c) for c in out_cols])

    # row 2: a new version from the source (new key, or changed)
    new_vals = {c: (F.col(f"s_{c}") if c in source.columns else F.lit(None)).cast(history.schema[c].dataType
                if c in history.columns else source.schema[c].dataType) for c in out_data}
    new_vals[n_scd] = surrogate_key([*[F.col(f"s_{k}") for k in keys], upd])
    new_vals[n_upd] = upd
    new_vals[n_from] = upd
    new_vals[n_to] = _current(cfg)
    if cfg.hard_deletes == "new_record":
        new_vals[n_del] = F.lit("False")
    emit_new = s_here & (~h_here | matched_changed)
    if cfg.hard_deletes == "new_record":
        # a deletion record for a key missing from the source
        del_vals = {c: F.col(f"h_{c}") for c in out_data}
        del_vals[n_scd] = surrogate_key([F.col(f"h_{n_scd}"), now_c])
        del_vals[n_upd] = now_c
        del_vals[n_from] = now_c
        del_vals[n_to] = F.col(f"h_{n_to}")
        del_vals[n_del] = F.lit("True")
        new_vals = {c: F.when(deleting, del_vals[c]).otherwise(new_vals[c]) for c in out_cols}
        emit_new = emit_new | deleting
    new_row = F.struct(emit_new.alias("_emit"), F.lit("insert").alias(CHANGE), *[new_vals[c].alias(c) for c in out_cols])

    return closed, j.select(F.inline(F.array(old_row, new_row))).filter(F.col("_emit")).select(*out_cols, CHANGE)


def _any_distinct(cols: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | is_distinct_from(F.col(f"h_{c}"), F.col(f"s_{c}"))
    return out


def snapshot_changes(history: DataFrame, source: DataFrame, cfg: SnapshotConfig, now: dt.datetime) -> DataFrame:
    """The staged change set (H2), straight out of the one join: new versions as
    ``insert``, versions closed by a change as ``update``, by a hard delete as ``delete``."""
    cfg.validate()
    return _versions(history, source, cfg, now)[1].filter(F.col(CHANGE).isNotNull())


def apply_snapshot(spark: SparkSession, path: str, source: DataFrame, cfg: SnapshotConfig,
                   now: dt.datetime | None = None) -> None:
    """Take a snapshot into the table at ``path`` (H1, H3), by default at the session's time.

    Open versions are one table (``path/open``), closed ones another with a folder per
    run (``path/closed/run=...``).  A run joins the open versions with the source once
    and writes the new open table and its closed versions; one commit puts both in place.
    Closed versions of earlier runs are neither read nor written.  A run that was broken
    off has happened or has not; repeating one adds nothing.
    """
    cfg.validate()
    now = now or clock(spark)
    first = not C.table_exists(spark, path)
    commit = C.Commit(spark, path)
    if first:
        current, closed = snapshot_initial(source, cfg, now), None
    else:
        _, versions = _versions(W.read_table(spark, f"{commit.root}/open"), source, cfg, now)
        staged = W.materialize(versions)
        stays = F.col(CHANGE).isNull() | (F.col(CHANGE) == "insert")
        current, closed = staged.filter(stays).drop(CHANGE), staged.filter(~stays).drop(CHANGE)
        commit.remove("open")
    write_open(commit, current)
    if closed is not None:
        closed.write.parquet(f"{commit.staging}/closed")
        commit.put("closed", f"closed/run={now:%Y%m%dT%H%M%S%f}-{commit.id}")
    commit.run()


def write_open(commit: C.Commit, current: DataFrame) -> None:
    """The open versions of a snapshot, staged."""
    current.write.parquet(f"{commit.staging}/open")
    C.write_text(commit.spark, f"{commit.staging}/open/{W.SCHEMA_FILE}", W.schema_text(current.schema))
    commit.put("open")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The whole history of a table written by ``apply_snapshot``."""
    base = path.rstrip("/")
    C.table_exists(spark, base)
    current = W.read_table(spark, f"{base}/open")
    if not C.exists(spark, f"{base}/closed"):
        return current
    # folders are only folders: their names are no column, so a data column may have any name
    closed = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(f"{base}/closed")
    return current.unionByName(closed, allowMissingColumns=True).select(*current.columns)
