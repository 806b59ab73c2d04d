"""Where queries and their SQL twins are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the equivalent SQL."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, as it is now."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
