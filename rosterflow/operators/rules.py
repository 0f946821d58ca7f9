"""Value rules, prefix labels and derived columns of a report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.names import column


def rule_violations(
    df: DataFrame, rules: Iterable[tuple[str, Sequence[str]]], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per cell outside its column's allowed values: ``keep`` columns, column name, value.

    Empty cells are allowed. A later rule for a column replaces an earlier one. All rules are
    checked in one scan.
    """
    allowed = dict(rules)
    cells = []
    for name, values in allowed.items():
        value = column(name).cast("string")
        cell = F.struct(F.lit(name).alias("column_name"), value.alias("value"))
        cells.append(F.when(~value.isin([str(v) for v in values]) & (value != ""), cell))
    broken = F.filter(F.array(*cells), lambda cell: cell.isNotNull())
    return df.select(*[column(c) for c in keep], F.explode(broken).alias("cell")).select(
        *[column(c) for c in keep], "cell.column_name", "cell.value"
    )


def count_violations(df: DataFrame, rules: Iterable[tuple[str, Sequence[str]]]) -> DataFrame:
    """Rows per column and value outside the allowed values."""
    return rule_violations(df, rules).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))


def prefix_labels(df: DataFrame, labels: Mapping[str, Sequence[tuple[str, str, str]]]) -> DataFrame:
    """Add ``<column>_label`` to the columns that prefix rules cover; columns of those names are replaced.

    ``labels`` maps a label to ``(prefix, first column, last column)`` rules; the columns lie
    between both, inclusive. Of several rules that fit a cell the first one given wins.
    """
    rules: dict[str, list[tuple[str, str]]] = {}
    for label, entries in labels.items():
        for prefix, first, last in entries:
            for name in df.columns[df.columns.index(first) : df.columns.index(last) + 1]:
                rules.setdefault(name, []).append((prefix, label))

    def label_of(name: str) -> Column:
        cases = [(column(name).startswith(prefix), F.lit(label)) for prefix, label in rules[name]]
        (condition, label), *others = cases
        return reduce(lambda chain, case: chain.when(*case), others, F.when(condition, label))

    added = {f"{c}_label": label_of(c) for c in df.columns if c in rules}
    kept = [column(c) for c in df.columns if c not in added]
    return df.select(*kept, *[value.alias(name) for name, value in added.items()])


def label_columns(columns: Sequence[str], labels: Mapping[str, Sequence[tuple[str, str, str]]]) -> list[str]:
    """Names of the columns that ``prefix_labels`` adds to these."""
    covered = {
        name
        for entries in labels.values()
        for _, first, last in entries
        for name in columns[columns.index(first) : columns.index(last) + 1]
    }
    return [f"{c}_label" for c in columns if c in covered]


def add_formulas(df: DataFrame, formulas: Mapping[str, str]) -> DataFrame:
    """Set columns from SQL expressions over the row, replacing columns of the same name.

    A formula sees the results of the ones before it.
    """
    for name, sql in formulas.items():
        df = df.withColumn(name, F.expr(sql))
    return df
