"""Load frames and files into tables, and publish reports."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rosterflow.functions.names import column
from rosterflow.operators.columns import all_strings, clean_columns, fit_to_schema
from rosterflow.operators.ordering import row_range
from rosterflow.sources.delimited import read_csv
from rosterflow.sources.grid import grid_to_frame


def append_frame(
    df: DataFrame,
    table: str,
    start: int = 0,
    end: int | None = None,
    key: str | None = None,
    force_string: bool = False,
    lossy: Sequence[str] = (),
    figures: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Append to a table by column name, creating it if needed; names are cleaned first.

    Returns what the load itself counted, in the tasks that wrote: ``rows``, and one value per aggregate of ``figures``, whose columns
    are the table's. Nothing is read a second time (``reconcile_load`` holds them against expected ones).

    An existing table's types count: values are converted to them, and one that does not convert or would change
    fails the load, unless its column is named in ``lossy`` (see ``fit_to_schema``). Its columns that the frame lacks become null; a column
    that the table lacks is an error.

    ``start`` and ``end`` pick rows by position in the order of ``key``, a unique column, to
    load a large frame in steps. Write tasks are the batches: each commits its files once, and
    a lost task is run again.
    """
    if start or end is not None:
        if key is None:
            raise ValueError("start and end need a key that orders the rows")
        df = row_range(df, key, start, end)
    df = clean_columns(all_strings(df) if force_string else df)
    if df.sparkSession.catalog.tableExists(table):
        df = fit_to_schema(df, df.sparkSession.table(table).schema, lossy)
    # The aggregates stand right below the write, in its own stage, so a task that is run again counts once.
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[f.alias(n) for n, f in (figures or {}).items()]).write.mode("append").saveAsTable(table)
    return seen.get


def reconcile_load(spark: SparkSession, table: str, expected: Mapping[str, Any], observed: Mapping[str, Any]) -> DataFrame:
    """Expected against observed figures of a load, a row per figure: ``table_name``, ``figure``, ``expected``, ``observed``, ``status``.

    ``status`` is ``ok``, ``empty`` (nothing, or nothing but zero, was expected) or ``mismatch``; a figure that only one side has is a mismatch.
    """
    rows = []
    for figure in sorted({*expected, *observed}):
        want, got = expected.get(figure), observed.get(figure)
        status = "mismatch" if want != got else "ok" if want else "empty"
        rows.append((table, figure, None if want is None else str(want), None if got is None else str(got), status))
    return spark.createDataFrame(rows, "table_name string, figure string, expected string, observed string, status string")


def upload_csv(
    spark: SparkSession,
    path: str,
    table: str,
    sep: str = ",",
    encoding: str = "UTF-8",
    force_string: bool = False,
    start: int = 0,
    end: int | None = None,
    key: str | None = None,
    lossy: Sequence[str] = (),
    figures: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Append delimited files, from any storage Spark reads, to a table.

    An existing table gives the types, so the files are read once, as text, and nothing is guessed.
    """
    as_text = force_string or spark.catalog.tableExists(table)
    return append_frame(read_csv(spark, path, sep, encoding, as_text), table, start, end, key, lossy=lossy, figures=figures)


def upload_grid(
    grid: DataFrame,
    table: str,
    header_row: int = 1,
    force_string: bool = False,
    start: int = 0,
    end: int | None = None,
    key: str | None = None,
    lossy: Sequence[str] = (),
    figures: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Append a grid to a table, with its types if it exists, else with guessed ones unless all text is asked for."""
    typed = not force_string and not grid.sparkSession.catalog.tableExists(table)
    return append_frame(grid_to_frame(grid, header_row, typed=typed), table, start, end, key, lossy=lossy, figures=figures)


def publish_report(
    df: DataFrame,
    report: str,
    max_columns: int | None = None,
    keep: int = 2,
    derived: Sequence[str] = (),
    row_no: str | None = None,
) -> str:
    """Replace a report and return the table that now backs it.

    The rows go to a new versioned table and the view ``report`` is then pointed at it, so the
    old version may be read by the plan that is written, readers never see half a report, and a
    failed write changes nothing, not even for the next try, since no version's name is used twice.
    A frame with more columns than ``max_columns``, or by default than the report has now, is
    refused before anything is written; ``derived`` columns do not count. The ``keep`` newest
    versions stay.

    ``row_no`` names a column that numbers the rows in the order of the frame, so that a sorted
    report can be read in its order: numbers grow, with gaps between write tasks
    (``report_grid`` closes them). It costs no further pass over the rows.
    """
    spark = df.sparkSession
    schema, _, name = report.rpartition(".")
    exists = spark.catalog.tableExists(report)
    own = [c for c in df.columns if c not in {*derived, row_no}]
    if max_columns is None and exists:
        max_columns = len([c for c in spark.table(report).columns if c not in {*derived, row_no}])
    if max_columns is not None and len(own) > max_columns:
        raise ValueError(f"{report} has room for {max_columns} columns, got {len(own)}: {', '.join(own)}")
    versions = _versions(spark, schema, name)
    prefix = f"{schema}." if schema else ""
    newest = max((number for number, _ in versions), default=0)
    table = f"{prefix}{name}__v{newest + 1}_{uuid.uuid4().hex[:12]}"
    if row_no is not None:
        df = df.drop(row_no).select((F.monotonically_increasing_id() + 1).alias(row_no), "*")
    df.write.saveAsTable(table)
    spark.sql(f"CREATE OR REPLACE VIEW {report} AS SELECT * FROM {table}")
    for _, old in sorted(versions, reverse=True)[max(keep, 1) - 1 :]:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{old}")
    return table


def _versions(spark: SparkSession, schema: str, name: str) -> list[tuple[int, str]]:
    """Number and name of each version table of a report."""
    tables = [t.name.lower() for t in spark.catalog.listTables(schema or None) if not t.isTemporary]
    found = [re.fullmatch(rf"{re.escape(name.lower())}__v(\d+)(?:_[0-9a-f]+)?", t) for t in tables]
    return [(int(m.group(1)), m.group(0)) for m in found if m]


def report_grid(report: DataFrame, row_no: str, headers: DataFrame) -> DataFrame:
    """A published report as a grid below the rows of ``headers`` (``row_no``, ``cells``), which stay as they are.

    ``row_no`` is the column that ``publish_report`` numbered the rows with; in the grid they are numbered
    without gaps. Only the number of header rows and one count per write task leave the rows' tasks.
    """
    first = headers.agg(F.max("row_no")).first()[0] or 0
    names = [c for c in report.columns if c != row_no]
    rows = without_gaps(report, row_no).select(
        (column(row_no) + first).alias("row_no"), F.array(*[F.coalesce(column(c).cast("string"), F.lit("")) for c in names]).alias("cells")
    )
    return headers.select("row_no", "cells").unionByName(rows)


def without_gaps(report: DataFrame, row_no: str) -> DataFrame:
    """A published report with the numbers of ``publish_report`` closed up, from 1; one count per write task is summed up."""
    # The upper bits of a number tell the task that wrote the row, the lower 33 its place there.
    task = F.shiftright(column(row_no) - 1, 33)
    counts = report.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "_task", F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)).alias("_before")
    )
    place = (column(row_no) - 1).bitwiseAND((1 << 33) - 1)
    closed = report.withColumn("_task", task).join(before, "_task").withColumn(row_no, place + F.coalesce("_before", F.lit(0)) + 1)
    return closed.select([column(c) for c in report.columns])
