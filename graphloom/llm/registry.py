"""Queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Build] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function `(spark, folder) -> DataFrame`, and equivalent SQL where there is any."""

    def register(build: Build) -> Build:
        if name in _QUERIES:
            raise ValueError(f"query '{name}' exists already")
        _QUERIES[name] = build
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def queries() -> dict[str, Build]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
