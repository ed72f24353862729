"""Safe writers for the pure strategies (I1, I2, I4-I14 persistence, I16).

Parquet files cannot be rewritten while they are read, so new files are written to a
staging folder next to the table and become part of it by one commit (``commits``):

* ``replace_table``: the whole table.
* ``replace_files``: an explicit list of files, in whatever partitions they are; all
  others stay as they are.  A run first finds the files that hold rows it can change.

A table's schema is stored beside its files (``_table_schema.json``, which Spark's
readers skip), so partition columns keep their types and a table without rows
can be read.  An increment is fixed once in the shared folder named by
``spark.checkpoint.dir`` before a strategy uses it, so every step of a run sees
the same rows, also after the loss of an executor.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import commits as C
from tidewater.operators import incremental as I
from tidewater.session import checkpoint_dir

POINT_KEYS = 64      # so many different keys of an increment are looked up one by one


@dataclass(frozen=True)
class Written:
    """Data files that a run replaced and added, and whether it was skipped as applied before."""

    removed: int = 0
    added: int = 0
    skipped: bool = False


def path_exists(spark: SparkSession, path: str) -> bool:
    return C.exists(spark, path)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SCHEMA_FILE = "_table_schema.json"


def schema_text(schema: T.StructType) -> str:
    return _nullable(schema).json()


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema a table was written with (None for files of other writers)."""
    text = C.read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written here, with the column types and order it was written with.

    A commit to it that was broken off is finished first.
    """
    C.table_exists(spark, path)
    schema = stored_schema(spark, path)
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*[f"`{f.name}`" for f in schema.fields])


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _write(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
           options: Mapping[str, str] | None = None, keys: Sequence[str] = ()) -> None:
    """Files of ``df``; parquet files get a Bloom filter for each of ``keys``, so single keys are found without reading."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "parquet":
        for k in keys:
            w = w.option(f"parquet.bloom.filter.enabled#{k}", "true")
        if keys:
            w = w.option("parquet.bloom.filter.adaptive.enabled", "true")
    w = w.options(**dict(options or {}))
    (w.partitionBy(*partition_by) if partition_by else w).save(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                  options: Mapping[str, str] | None = None, keys: Sequence[str] = (),
                  batch: tuple[str, int] | None = None) -> Written:
    """Write ``df`` as the new content of ``path`` and swap it in by one commit.

    Safe when ``df`` reads ``path`` itself: the data are fully written to staging before
    the old files leave.  ``batch`` is noted as applied with the same commit.
    """
    spark = df.sparkSession
    commit = C.Commit(spark, path)
    had_old = C.exists(spark, commit.root)
    known = C.with_batch(C.applied(spark, commit.root) if had_old else {}, batch)
    _write(df, commit.staging, partition_by, fmt, options, keys)
    C.write_text(spark, f"{commit.staging}/{SCHEMA_FILE}", schema_text(df.schema))
    if known:
        C.write_text(spark, f"{commit.staging}/{C.APPLIED_FILE}", json.dumps(known))
    out = Written(len(C.data_files(spark, commit.root)), len(C.data_files(spark, commit.staging)))
    if had_old:
        commit.remove()
    commit.put()
    commit.run()
    return out


def replace_files(new: DataFrame | None, path: str, gone: Sequence[str], partition_by: Sequence[str] = (),
                  keys: Sequence[str] = (), batch: tuple[str, int] | None = None, spark: SparkSession | None = None) -> Written:
    """Take the files ``gone`` (relative paths) out of the table and put the rows of ``new`` in, by one commit.

    Partitions are only folders here: one that loses its last file has no rows left.
    """
    spark = spark or new.sparkSession
    commit = C.Commit(spark, path)
    if new is not None:
        _write(new, commit.staging, partition_by, keys=keys)
    come = C.data_files(spark, commit.staging)
    C.swap_files(commit, gone, come)
    if batch is not None:
        commit.put_text(C.APPLIED_FILE, json.dumps(C.with_batch(C.applied(spark, commit.root), batch)))
    commit.run()
    return Written(len(gone), len(come))


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> Written:
    """Replace only the partitions present in ``df``, all of them by one commit.

    The files that leave are those in the folders that the new files go to: the table's
    rows are not read.
    """
    spark = df.sparkSession
    commit = C.Commit(spark, path)
    _write(df, commit.staging, partition_by)
    come = C.data_files(spark, commit.staging)
    folders = {f.rpartition("/")[0] for f in come}
    gone = [f for f in C.data_files(spark, commit.root) if f.rpartition("/")[0] in folders]
    C.swap_files(commit, gone, come)
    commit.run()
    return Written(len(gone), len(come))


FILE = "_file_path"


def files_of(rows: DataFrame, path: str) -> list[str]:
    """The files (relative to ``path``) in ``rows``' column ``FILE``; one name per file reaches the driver."""
    spark = rows.sparkSession
    fs, root = C.fs_of(spark, path.rstrip("/"))
    base = fs.makeQualified(root).toString().rstrip("/")
    to_path, uri = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jvm.java.net.URI
    found = rows.select(FILE).distinct().collect()
    return sorted(fs.makeQualified(to_path(uri(r[0]))).toString()[len(base):].lstrip("/") for r in found)


def upsert_partitions(spark: SparkSession, source: DataFrame, path: str,
                      keys: Sequence[str] = ("season", "season_type"), mode: str = "upsert",
                      full_replace: bool = False, warn=None) -> Written:
    """Create on first load; later loads replace the source's
    partitions and keep the others; an empty source is a no-op.

    The source is aligned to the existing table's columns (new ones dropped
    with a warning, missing ones NULL) before the partitions are replaced.  Where a
    column of the source is of a wider type, the table is rewritten with that type:
    no value is cut.
    """
    if source.isEmpty():
        return Written()
    present = [k for k in keys if k in source.columns]
    if full_replace or not C.table_exists(spark, path):
        return replace_table(source, path, partition_by=present)
    target = read_table(spark, path)
    part_keys = [k for k in keys if k in target.columns]
    if not part_keys and mode != "append":
        raise ValueError("target has no partition key column; pass mode='append' to append")
    wide, aligned = I.reconcile(target, I.without_extra(source, target.schema, warn))
    if _nullable(wide.schema) != _nullable(target.schema):
        source = materialize(aligned)
        new = I.partition_upsert(wide, source, part_keys, mode) if part_keys else wide.unionByName(source)
        return replace_table(new, path, partition_by=part_keys)
    if not part_keys:
        return replace_files(aligned, path, [])
    return overwrite_partitions(aligned, path, part_keys)


def write_table_set(spark: SparkSession, tables: Mapping[str, DataFrame], base: str,
                    keys: Sequence[str] = ("season", "season_type")) -> list[str]:
    """I4: upsert a dict of tables (one season's load) under ``base/<name>``."""
    written = []
    for name, df in tables.items():
        upsert_partitions(spark, df, f"{base.rstrip('/')}/{name}", keys)
        written.append(name)
    return written


def apply_incremental(spark: SparkSession, path: str, source: DataFrame, strategy: str = "delete+insert",
                      unique_key=None, partition_by: Sequence[str] = (), full_refresh: bool = False,
                      on_schema_change_mode: str = "ignore", batch: tuple[str, int] | None = None, **opts) -> Written:
    """Run a strategy against the table at ``path`` and persist the new state by one commit.

    The source is fixed first.  Only the files that hold rows which the run can change are
    read whole, recomputed and replaced: those with the source's keys (wherever a key
    moves to), of the source's partitions for an overwrite, of a microbatch's slice or of
    delete predicates.  Runs that can change any row (by-source clauses, a full refresh,
    a changed schema) rewrite the table.  ``batch`` (stream, number) is noted with the
    commit, and a batch that was noted before is skipped.
    """
    parts, keys = list(partition_by), list(opts.get("using") or ()) or I.key_list(unique_key)
    there = C.table_exists(spark, path)
    if there and C.is_applied(C.applied(spark, path), batch):
        return Written(skipped=True)
    source = materialize(source)
    if full_refresh or not there:
        return replace_table(source, path, partition_by=parts, keys=keys, batch=batch)
    target = read_table(spark, path)
    if strategy == "insert_overwrite" and not opts.get("predicates"):
        opts.setdefault("partition_by", parts)
    schema = I.reconcile(target, source, on_schema_change_mode)[0].schema
    kept = _nullable(schema) == _nullable(target.schema)
    if strategy == "append" and kept:
        return replace_files(I.align_to(source, target.schema), path, [], parts, keys, batch)
    rows = touched_rows(target, source, strategy, unique_key, opts) if kept else None
    if rows is None:
        return replace_table(I.incremental(target, source, strategy, unique_key, on_schema_change_mode, **opts), path,
                             partition_by=parts, keys=keys, batch=batch)
    gone = files_of(rows, path)
    scoped = target.where(F.col("_metadata.file_path").isin(_file_paths(spark, path, gone)))    # the scan lists no others
    new = I.incremental(scoped, source, strategy, unique_key, on_schema_change_mode, **opts)
    return replace_files(new, path, gone, parts, keys, batch)


def _file_paths(spark: SparkSession, path: str, found: Sequence[str]) -> list[str]:
    """Relative file names as scans name them."""
    fs, root = C.fs_of(spark, path.rstrip("/"))
    base, to_path = fs.makeQualified(root).toString().rstrip("/"), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return [to_path(f"{base}/{f}").toUri().toString() for f in found]


def touched_rows(target: DataFrame, source: DataFrame, strategy: str, unique_key=None,
                 opts: Mapping | None = None) -> DataFrame | None:
    """Rows of the target that a run can change, with their file (``FILE``), or None when it can change any.

    A scan for them reads the columns of the key, the event time or the predicates only.  A
    few different keys are pushed into the scan as single values, for which row groups are
    skipped by their Bloom filters; more of them are joined.
    """
    opts = dict(opts or {})
    keys = list(opts.get("using") or ()) or I.key_list(unique_key)
    if any(c.kind == "not_matched_by_source" for c in opts.get("clauses") or ()):
        return None
    target = target.withColumn(FILE, F.col("_metadata.file_path"))
    if strategy == "microbatch":
        return target.where(I.in_slice(opts.get("event_time"), opts.get("start"), opts.get("end")))
    if strategy == "insert_overwrite":
        if opts.get("predicates") and not opts.get("partition_by"):
            return target.where(I.all_of(opts["predicates"]))
        if not opts.get("partition_by"):
            return None
        keys = list(opts["partition_by"])
    if not keys:
        return target.where(F.lit(False))
    found = source.select(*keys).distinct()
    few = found.limit(POINT_KEYS + 1).collect()
    if len(few) <= POINT_KEYS:
        target = target.where(any_of([F.col(f"`{keys[0]}`") == F.lit(v) for v in {r[0] for r in few} if v is not None]))
        if len(keys) == 1:
            return target
    return target.join(found, keys, "left_semi")


def any_of(conditions: Sequence[Column]) -> Column:
    """Their disjunction as a balanced tree."""
    if len(conditions) <= 1:
        return conditions[0] if conditions else F.lit(False)
    half = len(conditions) // 2
    return any_of(conditions[:half]) | any_of(conditions[half:])


def touched_partitions(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The target's rows in the source's partitions, by a semi join that Spark turns
    into dynamic partition pruning (only those partitions' files are read)."""
    touched = source.select(*partition_by).distinct()
    return target.join(touched, list(partition_by), "left_semi").select(*target.columns)


class ChecksFailed(ValueError):
    """Rows fail checks of a load that refuses them; ``failures`` counts them by check."""

    def __init__(self, failures: Mapping[str, int]):
        self.failures = dict(failures)
        super().__init__("checks failed: " + ", ".join(f"{n}: {c} rows" for n, c in self.failures.items()))


FAILED = "failed_checks"


def checked_load(df: DataFrame, path: str, checks: Mapping[str, str | Column], contract: T.StructType | None = None,
                 quarantine: str | None = None, partition_by: Sequence[str] = (), append: bool = False) -> dict[str, int]:
    """T1-T8, T11 while writing: load ``df`` into the table at ``path`` and check every row in the same scan.

    ``checks`` name predicates that must hold for a row (an unknown one does not); ``contract`` is the
    schema that the load must have, looked at before anything runs.  The checks are counted by the
    job that writes the files (``Dataset.observe``).  Without ``quarantine`` a single failing row
    refuses the load: nothing is committed and the table stays as it was.  With it the rows
    that fail go to the table there, with the names of their checks in ``FAILED``, and
    the others are loaded.  Returns the failing rows by check.
    """
    from pyspark.sql import Observation

    from tidewater.operators.quality import check_contract
    spark = df.sparkSession
    if contract is not None:
        errors = check_contract(df, contract)
        if errors:
            raise ValueError("contract not met: " + "; ".join(errors))
    if {FAILED, "_passed"} & set(df.columns):
        raise ValueError(f"columns {FAILED} and _passed are reserved for the checks")
    held = {n: F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(False)) for n, c in checks.items()}
    seen = Observation(f"checks-{C.uuid.uuid4().hex[:8]}")
    names = list(held)
    watched = df.observe(seen, F.count(F.lit(1)).alias("_rows"), *[F.count_if(~held[n]).alias(f"c{i}") for i, n in enumerate(names)])
    failed = F.filter(F.array(*[F.when(~held[n], F.lit(n)) for n in names]), lambda x: x.isNotNull())
    commit = C.Commit(spark, path)
    there = C.exists(spark, commit.root)
    staged = watched.withColumn(FAILED, failed).withColumn("_passed", F.size(FAILED) == 0)
    _write(staged, commit.staging, ["_passed", *partition_by])
    counts = seen.get
    failures = {n: counts[f"c{i}"] for i, n in enumerate(names) if counts[f"c{i}"]}
    if failures and quarantine is None:
        C.delete(spark, commit.staging)
        raise ChecksFailed(failures)
    bad = [f for f in C.data_files(spark, commit.staging) if f.startswith("_passed=false/")]
    good = [f for f in C.data_files(spark, commit.staging) if f.startswith("_passed=true/")]
    if bad:
        aside = C.Commit(spark, quarantine)
        for f in bad:
            commit.steps.append((f"{commit.staging}/{f}", f"{aside.root}/{f.split('/', 1)[1]}"))
        if not C.exists(spark, f"{aside.root}/{SCHEMA_FILE}"):
            commit.steps.append((f"{commit.staging}/_quarantine_schema", f"{aside.root}/{SCHEMA_FILE}"))
            C.write_text(spark, f"{commit.staging}/_quarantine_schema", schema_text(staged.drop("_passed").schema))
    if there and not append:
        commit.remove()
    for f in good:
        commit.put(f, f.split("/", 1)[1])
    if not there or not append:
        C.write_text(spark, f"{commit.staging}/{SCHEMA_FILE}", schema_text(df.schema))
        commit.put(SCHEMA_FILE)
    commit.run()
    return failures


def materialize_as(df: DataFrame, name: str, kind: str = "view") -> DataFrame:
    """A model as a lazy temp view, or a table rebuilt then swapped in."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind == "table":
        df.write.mode("overwrite").saveAsTable(name)
        return df.sparkSession.table(name)
    raise ValueError(f"unknown materialization {kind!r}")


def python_model(spark: SparkSession, fn: Callable[..., DataFrame], refs: Mapping[str, str | DataFrame],
                 path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Run a model written in Python and persist it like any other table.

    ``fn(ref, spark)`` gets a function that reads an upstream model by name (a table
    path or a DataFrame in ``refs``; unknown names are an error) and returns the
    model's DataFrame, which replaces the table at ``path``.
    """
    def ref(name: str) -> DataFrame:
        if name not in refs:
            raise KeyError(f"model refers to an unknown table {name!r}")
        found = refs[name]
        return found if isinstance(found, DataFrame) else read_table(spark, found)

    out = fn(ref, spark)
    if not isinstance(out, DataFrame):
        raise TypeError("a Python model returns a DataFrame")
    replace_table(out, path, partition_by=partition_by)
    return read_table(spark, path)
