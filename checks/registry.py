"""Queries and the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows can be checked."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round doubles for comparison; adding zero removes negative zero."""
    names = names or tuple(f.name for f in df.schema.fields if f.dataType.typeName() == "double")
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in names})
