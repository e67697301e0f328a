"""Registry of named queries over the driver tables, each with an optional
DuckDB oracle. Modules under ``crowdpulse.plans`` register into it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Parameters of the test-data mapping: the driver tables hold ~10k events
# over 30 days at sf0.01, so windows are hours and the marker span two hours.
WINDOW = "1 hour"
SPAN = "2 hours"


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco
