"""Registered queries: each key maps to a Spark implementation built from the
library operators and to an equivalent DuckDB SQL text (the oracle).

The queries run the library's operators over the driver's TPC-H-style
tables (zones = ``nation``, districts = ``region``, see
:mod:`zonage.sources.lattice`).  Column names and types are aligned between
both sides; doubles are rounded in decimal arithmetic on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir)`` under ``key`` with its oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key!r}")
        REGISTRY[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that the registry is complete."""
    from . import scores, aggregates, temporal, loads, cleaning, spatial, serving, network  # noqa: F401
    from .network import _network_sql
    if "network_score" not in ORACLES:
        ORACLES["network_score"] = _network_sql().strip()
    from .serving import register_late_oracles
    register_late_oracles()
