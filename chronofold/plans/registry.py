"""Registered queries of the interval engine and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a (spark, sf_dir) -> DataFrame function, and its SQL where there is one."""

    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLE_SQL[name] = sql
        return function

    return add


def load() -> None:
    """Imports every module that registers queries."""
    from chronofold.plans import chain_queries, interval_queries, peak_queries, signal_queries  # noqa: F401
