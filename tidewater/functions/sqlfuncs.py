"""User-defined functions (Y1-Y3) as Spark SQL functions.

SQL-bodied functions are inlined by the analyzer, so filters and column
pruning reach through them and they run in whole-stage codegen; that is the
reason to prefer them over Python UDFs.  Aggregates are expression macros of
built-in aggregates (partial aggregation keeps working).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def create_scalar_function(spark: SparkSession, name: str, args: Sequence[tuple[str, str]], returns: str,
                           body: str, deterministic: bool = True, replace: bool = True) -> None:
    """Y2: ``CREATE TEMPORARY FUNCTION name(args) RETURNS type RETURN body``."""
    arglist = ", ".join(f"{a} {t}" for a, t in args)
    det = "DETERMINISTIC" if deterministic else "NOT DETERMINISTIC"
    verb = "CREATE OR REPLACE TEMPORARY FUNCTION" if replace else "CREATE TEMPORARY FUNCTION"
    spark.sql(f"{verb} {name}({arglist}) RETURNS {returns} {det} RETURN {body}")


def create_table_function(spark: SparkSession, name: str, args: Sequence[tuple[str, str]],
                          columns: Sequence[tuple[str, str]], body: str, replace: bool = True) -> None:
    """A parameterised view, ``RETURNS TABLE (...) RETURN SELECT ...``."""
    arglist = ", ".join(f"{a} {t}" for a, t in args)
    cols = ", ".join(f"{c} {t}" for c, t in columns)
    verb = "CREATE OR REPLACE TEMPORARY FUNCTION" if replace else "CREATE TEMPORARY FUNCTION"
    spark.sql(f"{verb} {name}({arglist}) RETURNS TABLE ({cols}) RETURN {body}")


def weighted_average(value: Column | str, weight: Column | str) -> Column:
    """``sum(v * w) / sum(w)`` as an aggregate expression (null when the
    weights sum to 0)."""
    v = F.col(value) if isinstance(value, str) else value
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.sum(v * w) / F.nullif(F.sum(w).cast("double"), F.lit(0.0))



_AGGREGATES: dict[str, Callable[..., Column]] = {}


def create_aggregate_function(name: str, args: Sequence[str], body: str, replace: bool = True) -> Callable[..., Column]:
    """A user's aggregate as a macro: ``body`` is SQL over the argument names, made of
    built-in aggregates.  Returns the function; ``aggregate(name)`` finds it again.
    Arguments are columns, column names or SQL text."""
    if not re.fullmatch(r"[A-Za-z_]\w*", name) or not all(re.fullmatch(r"[A-Za-z_]\w*", a) for a in args):
        raise ValueError("names of functions and arguments are identifiers")
    if name in _AGGREGATES and not replace:
        raise ValueError(f"aggregate {name!r} exists")

    def call(*values: str) -> Column:
        if len(values) != len(args):
            raise TypeError(f"{name} takes {len(args)} arguments, got {len(values)}")
        by_name = {a: f"({v})" for a, v in zip(args, values)}
        return F.expr(re.sub(r"[A-Za-z_]\w*", lambda m: by_name.get(m[0], m[0]), body))

    _AGGREGATES[name] = call
    return call


def aggregate(name: str) -> Callable[..., Column]:
    """A registered aggregate by name."""
    return _AGGREGATES[name]
