"""Every operator as a query over the given tables, next to its SQL.

A query without SQL is one that plain SQL cannot state (trained centroids, random
projections); the tests hold those against exact search instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name, with the SQL it must equal."""

    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
