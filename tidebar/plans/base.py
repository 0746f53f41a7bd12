"""A register of queries by id, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

QUERIES: dict[str, Callable[..., DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Registers ``f(spark, sf_dir)`` under ``key`` with its DuckDB SQL."""

    def keep(f):
        QUERIES[key] = f
        if sql is not None:
            ORACLE[key] = sql
        return f

    return keep
