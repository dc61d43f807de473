"""Registered queries: a Spark function and the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a `(spark, folder) -> DataFrame` under a name."""

    def register(fn):
        if name in SPARK:
            raise ValueError(f"duplicate query {name}")
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
