"""A registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import guard

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name."""

    def add(f: Query) -> Query:
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(guard(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
