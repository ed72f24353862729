"""Registry of named queries over the driver's tables, each with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewater.sources.tables import Tables


@dataclass(frozen=True)
class Registered:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


_REGISTRY: dict[str, Registered] = {}


def query(name: str, sql: str | None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its oracle SQL."""

    def deco(fn: Callable[[Tables], DataFrame]):
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Registered(name, fn, sql)
        return fn

    return deco


def registered() -> dict[str, Registered]:
    # importing the modules fills the registry
    from tidewater.plans import (  # noqa: F401
        q_marts, q_relational, q_functions, q_quality, q_incremental, q_snapshot, q_ingest, q_misc, q_commits, q_scale,
    )
    return dict(_REGISTRY)


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    reg = registered()[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reg.build(Tables(spark, sf_dir))

    run.__name__ = f"q_{name}"
    return run
