"""All queries of the engine's core, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.operators import compile_queries, journal_queries, nested_queries, session_queries

_MODULES = (session_queries, compile_queries, journal_queries, nested_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in _MODULES for name, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.oracle_sql().items()}
