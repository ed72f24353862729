"""Spark-native warehouse operators: marts, incremental loads, snapshots, checks.

Modules (imported on first use):

* ``tidewater.plans.marts`` / ``tidewater.plans.warehouse``: staging, dimensions, facts
* ``tidewater.operators.incremental`` / ``.writers``: load strategies and safe writers
* ``tidewater.operators.snapshot``: type-2 history
* ``tidewater.operators.quality``: data-quality checks and profiles
* ``tidewater.operators.reshape`` / ``.joins``: dedupe, top-n, spines, listagg, joins
* ``tidewater.sources``: tables, JSON result sets, HTML pages, files
* ``tidewater.functions``: portable expressions and SQL functions
* ``tidewater.streaming``: stream-fed upserts
"""

import importlib

__version__ = "0.1.0"

_MODULES = {
    "marts": "tidewater.plans.marts",
    "warehouse": "tidewater.plans.warehouse",
    "incremental": "tidewater.operators.incremental",
    "writers": "tidewater.operators.writers",
    "snapshot": "tidewater.operators.snapshot",
    "quality": "tidewater.operators.quality",
    "reshape": "tidewater.operators.reshape",
    "joins": "tidewater.operators.joins",
    "exprs": "tidewater.functions.exprs",
}


def __getattr__(name: str):
    if name in _MODULES:
        return importlib.import_module(_MODULES[name])
    raise AttributeError(f"module 'tidewater' has no attribute {name!r}")


__all__ = sorted(_MODULES)
