"""Registry of queries and helpers to make results comparable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """``df`` with the given columns rounded, all other columns as they are."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
