"""File sources and sinks (S15-S18): CSV seeds, parquet export, external tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".ndjson": "json", ".orc": "orc"}


def format_from_location(location: str, default: str = "parquet") -> str:
    """``.csv`` / ``.parquet`` / ``.json`` suffix decides the format."""
    loc = location.lower().rstrip("/")
    for ext, fmt in _FORMATS.items():
        if loc.endswith(ext):
            return fmt
    return default


def load_seed(spark: SparkSession, path: str, column_types: Mapping[str, str] | None = None,
              delimiter: str = ",", infer: bool = True, schema: str | None = None) -> DataFrame:
    """A header CSV as a table; ``column_types`` overrides inferred types.

    With ``schema`` (DDL) the file is read once, with those types; inference reads it twice.
    """
    reader = spark.read.option("header", True).option("sep", delimiter)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", infer).csv(path)
    types = dict(column_types or {})
    return df.select(*[(F.col(c).cast(types[c]) if c in types else F.col(c)).alias(c) for c in df.columns])


def write_seed(df: DataFrame, path: str, delimiter: str = ",") -> None:
    """Header CSV; a rerun replaces the previous content."""
    df.write.mode("overwrite").option("header", True).option("sep", delimiter).csv(path)


def export_tables(tables: Mapping[str, DataFrame], base: str, schema: str = "main") -> list[str]:
    """One parquet file set per table at ``base/schema/table.parquet``."""
    out = []
    for name, df in tables.items():
        path = f"{base.rstrip('/')}/{schema}/{name}.parquet"
        df.write.mode("overwrite").parquet(path)
        out.append(path)
    return out


def write_external(df: DataFrame, location: str, fmt: str | None = None, partition_by: Sequence[str] = (),
                   options: Mapping[str, str] | None = None) -> None:
    """Write a model's result as files (format from the location's suffix).

    The location holds exactly this result afterwards: partitions of an earlier
    run that have no rows any more are removed (static overwrite, said per write).
    """
    fmt = fmt or format_from_location(location)
    w = (df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "static")
         .options(**dict(options or {})))
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(location)


def read_external(spark: SparkSession, location: str, fmt: str | None = None,
                  options: Mapping[str, str] | None = None, union_by_name: bool = True) -> DataFrame:
    """S17 read-back; ``union_by_name`` merges differing file schemas by name."""
    fmt = fmt or format_from_location(location)
    r = spark.read.format(fmt).options(**dict(options or {}))
    if fmt == "csv":
        r = r.option("header", True).option("inferSchema", True)
    if union_by_name and fmt in ("parquet", "orc"):
        r = r.option("mergeSchema", True)
    return r.load(location)
