"""Registered queries: name -> (function of the market views, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Market, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers f(market) under a name; sql may use the market views by name."""

    def register(f: Callable[[Market], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Market(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = oracle(sql)
        return f

    return register
