"""SQL text and catalog tables as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from rosterflow.functions.text import blank_nulls


def read_sql(spark: SparkSession, sql: str, named: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a query. ``named`` fills ``:name`` markers with typed values; identifiers go in ``IDENTIFIER(:name)``."""
    return spark.sql(sql, args=dict(named)) if named else spark.sql(sql)


def execute(spark: SparkSession, sql: str) -> None:
    """Run a statement for its effect, such as CREATE or DROP."""
    spark.sql(sql)


def read_sql_file(
    spark: SparkSession,
    path: str,
    parameters: Mapping[str, Any] | None = None,
    named: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run the query in a file on any storage Spark reads.

    ``parameters`` replace ``{name}`` fields in the text as they are, for existing templates;
    values that come from outside belong in ``named``, which never changes the query's shape. A
    path that holds no file or several is an error.
    """
    found = spark.read.text(path, wholetext=True).take(2)
    if len(found) != 1:
        raise ValueError(f"{path} must hold exactly one query file")
    sql = found[0][0]
    if parameters:
        sql = sql.format(**parameters)
    return read_sql(spark, sql, named)


def read_sql_files(spark: SparkSession, queries: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Stack several query files by column name, all as text with blanks for nulls.

    Each query is a mapping with ``path`` and, optionally, ``parameters`` and ``named``.
    """
    frames = [read_sql_file(spark, q["path"], q.get("parameters"), q.get("named")) for q in queries]
    return blank_nulls(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames))


def read_table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """A table or view; a name that already has a dot wins over ``schema``."""
    return spark.table(f"{schema}.{name}" if schema and "." not in name else name)


class SchemaTables:
    """Every table and view of a schema as an attribute: ``SchemaTables(spark, "public").customer``."""

    def __init__(self, spark: SparkSession, schema: str):
        self._spark = spark
        self._schema = schema

    def __dir__(self) -> list[str]:
        return [t.name for t in self._spark.catalog.listTables(self._schema) if not t.isTemporary]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or not self._spark.catalog.tableExists(f"{self._schema}.{name}"):
            raise AttributeError(f"no table or view {name} in schema {self._schema}")
        return self._spark.table(f"{self._schema}.{name}")


def describe(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")
