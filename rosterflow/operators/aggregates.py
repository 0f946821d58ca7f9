"""Counts and extremes. All are grouped aggregates that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.names import column
from rosterflow.functions.text import thousands
from rosterflow.operators.ordering import union_by_name


def max_per_group(df: DataFrame, by: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """Largest value per group."""
    return df.groupBy(*[column(c) for c in by]).agg(F.max(column(value)).alias(alias or value))


def row_count(df: DataFrame, what: str = "data") -> DataFrame:
    """The number of rows as one row; running the plan fails if there are none."""
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    empty = F.raise_error(F.lit(f"{what}: no row where at least one is needed"))
    return counted.select(F.when(F.col("row_count") > 0, F.col("row_count")).otherwise(empty.cast("bigint")).alias("row_count"))


def require_rows(df: DataFrame, what: str = "data") -> DataFrame:
    """The frame itself; raises now if it has no rows. Reads one row at most."""
    if df.isEmpty():
        raise ValueError(f"{what}: no row where at least one is needed")
    return df


def last_value(df: DataFrame, value: str, seq: str, by: Sequence[str] = ()) -> DataFrame:
    """The value in the last row by an explicit sequence column, per group if asked for."""
    return df.groupBy(*[column(c) for c in by]).agg(F.max_by(column(value), column(seq)).alias(value))


def _counts(frames: Mapping[str, DataFrame], by: Sequence[str], alias: str) -> DataFrame:
    """Rows per table and group."""
    counted = [
        df.groupBy(*[column(c) for c in by]).agg(F.count(F.lit(1)).alias(alias)).withColumn("table_name", F.lit(name))
        for name, df in frames.items()
    ]
    return union_by_name(*counted)


def reconcile(
    expected: Mapping[str, DataFrame], imported: Mapping[str, DataFrame], by: Sequence[str] = ()
) -> DataFrame:
    """Expected against imported row counts per table, and per group if asked for.

    ``status`` is ``ok``, ``empty`` (nothing expected) or ``mismatch``; ``message`` states the
    imported count with thousands separators. A null in ``by`` is a group like any other. Both
    sides' counts are stacked and summed; nothing is joined.
    """
    keys = ["table_name", *by]
    both = _counts(expected, by, "expected_rows").unionByName(_counts(imported, by, "imported_rows"), allowMissingColumns=True)
    summed = both.groupBy(*[column(c) for c in keys]).agg(
        F.sum("expected_rows").alias("expected_rows"), F.sum("imported_rows").alias("imported_rows")
    )
    want = F.coalesce("expected_rows", F.lit(0)).cast("bigint")
    got = F.coalesce("imported_rows", F.lit(0)).cast("bigint")
    return summed.select(
        *[column(c) for c in keys],
        want.alias("expected_rows"),
        got.alias("imported_rows"),
        F.when(want == 0, "empty").when(want == got, "ok").otherwise("mismatch").alias("status"),
        F.concat(F.lit("Imported: "), thousands(got)).alias("message"),
    )


def require_reconciled(reconciled: DataFrame) -> DataFrame:
    """The reconciliation itself; raises now, naming one of them, if any table does not agree."""
    bad = reconciled.filter("status <> 'ok'").first()
    if bad is not None:
        raise ValueError(
            f"{bad['table_name']}: expected {bad['expected_rows']:,} rows, imported {bad['imported_rows']:,}"
        )
    return reconciled


def count_findings(pages: Sequence[DataFrame], code: str, drop: Sequence[str] = ()) -> DataFrame:
    """Findings per code over all result pages, stacked by column name without the dropped columns."""
    return union_by_name(*pages).drop(*drop).groupBy(column(code)).agg(F.count(F.lit(1)).alias("finding_count"))
