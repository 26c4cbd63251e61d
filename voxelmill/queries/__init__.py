"""Queries over the supplied tables, each an application of this library's operators, with their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ("geometry", "inventory", "pyramids", "annotations", "metadata", "formats", "regions", "conversions", "beside")
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the DuckDB SQL that gives the same rows."""

    def register(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return register


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
