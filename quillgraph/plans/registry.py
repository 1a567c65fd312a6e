"""The register of queries: name -> Spark callable, and name -> the same in SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillgraph.session import shipped

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name; ``sql`` is its DuckDB twin, if SQL can express it."""

    def add(f: Query) -> Query:
        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            shipped(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
