"""The registered queries: each a Spark callable with, where SQL can say it, its check in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its check."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if check is not None:
            CHECKS[build.__name__] = check
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text(c: str | Column) -> Column:
    """A column as text."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def scratch_schema(spark: SparkSession) -> str:
    """A schema whose tables live in the shared scratch folder."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS rosterflow_scratch LOCATION '{scratch_path(spark, 'schema')}'")
    return "rosterflow_scratch"
