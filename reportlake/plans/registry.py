"""Registry of named queries: a Spark builder and, where SQL can express it, a DuckDB oracle.

``register(name, oracle)`` decorates a ``(spark, sf_dir) -> DataFrame``
function. The oracle is plain SQL over the driver's tables (pre-registered
views), independent of the library code it checks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco
