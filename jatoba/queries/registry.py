"""The query table, filled by the :func:`query` decorator."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from jatoba.queries.folders import ensure_work_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name unless one is given, with the equivalent SQL."""

    def register(function: Query) -> Query:
        key = name or function.__name__

        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_work_folder(spark)
            return function(spark, sf_dir)

        QUERIES[key] = run
        SQL[key] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PART_ROWS = 50_000
"""Rows of a table that one task takes where it makes many rows of each."""


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt by key to tasks of about PART_ROWS rows, for what makes many rows of each and sorts them: a file's split
    holds millions of rows of a well-packed table. ``rows`` should be cheap to count."""
    parts = -(-rows.count() // PART_ROWS)
    return rows.repartition(parts, key) if parts > 1 else rows


def plain_names(df: DataFrame) -> DataFrame:
    """Dotted column names with underscores, for readers that take a dot for a field access."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])
