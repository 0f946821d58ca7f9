"""Refresh a report from new query results while keeping the notes people added.

A report is a table of text: the columns of a query on the left, columns filled in by people on
the right. A refresh takes the query's new rows and carries the notes over, matching on a
primary identifier and, where that fails, on a secondary one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.names import column
from rosterflow.functions.text import NOT_APPLICABLE, NOT_ASSIGNED, blank_nulls, blank_sentinel, number_key
from rosterflow.operators.columns import keep_right_of, rename_present
from rosterflow.operators.matching import fallback_match
from rosterflow.operators.ordering import distinct_rows, sort_rows
from rosterflow.operators.rules import add_formulas, label_columns, prefix_labels, rule_violations
from rosterflow.sources.grid import grid_to_frame
from rosterflow.sources.sql import read_sql_files

_FIRST, _SECOND, _MATCHED = "_first_key", "_second_key", "_matched_on"


def refresh_report(
    query: DataFrame,
    report: DataFrame,
    primary: str,
    secondary: str | None = None,
    query_columns: int | None = None,
    report_query_columns: int | None = None,
    sort_by: Sequence[str] = (),
    ascending: Sequence[bool] | bool = True,
    blank_keys_match: bool = False,
    derived: Sequence[str] = (),
) -> DataFrame:
    """New query rows with the notes of the existing report.

    ``report`` starts with ``report_query_columns`` columns that came from the query (default:
    ``query_columns``, which defaults to the width of the query); the columns right of them are
    notes. Every query row stays. A row whose key has several different notes comes out once
    per note; notes whose row left the query go. ``secondary`` is used only if the report has
    that column.

    With ``blank_keys_match`` empty identifiers count as equal to each other, so every row
    without one gets the notes of every other; off by default.

    ``derived`` columns of the report, such as formulas, labels and row numbers of the last refresh,
    are no notes and do not come back; whoever derived them does so again.

    Both sides lose exact copies before they meet, which makes the result free of copies
    without a pass over its full width and keeps copies of a frequent key from multiplying.
    """
    report = report.drop(*derived)
    width = len(query.columns) if query_columns is None else query_columns
    notes = report.columns[width if report_query_columns is None else report_query_columns :]
    _check_columns(query, report, notes, primary, secondary)
    use_secondary = bool(secondary) and secondary in report.columns

    identifiers = [primary, secondary] if use_secondary else [primary]
    fresh = distinct_rows(blank_nulls(query))
    kept = blank_nulls(keep_right_of(report, identifiers, len(report.columns) - len(notes)))
    kept = kept.withColumn(primary, blank_sentinel(column(primary)))

    keys = {_FIRST: _primary_key(column(primary), blank_keys_match)}
    if use_secondary:
        keys[_SECOND] = F.when(
            column(secondary) != NOT_APPLICABLE, _secondary_key(column(secondary), blank_keys_match)
        )
    offers = kept.select(*[key.alias(k) for k, key in keys.items()], *[column(c) for c in notes])

    combined = fallback_match(fresh.withColumns(keys), offers, list(keys), _MATCHED, distinct=True)
    if width < len(query.columns):
        # Rows matched on the primary identifier keep all query columns, the others the first ones.
        by_primary = F.col(_MATCHED).eqNullSafe(F.lit(_FIRST))
        cut = {c: F.when(by_primary, column(c)) for c in query.columns[width:]}
        combined = distinct_rows(combined.withColumns(cut))
    refreshed = blank_nulls(combined.select([column(c) for c in [*query.columns, *notes]]))
    return sort_rows(refreshed, sort_by, ascending) if sort_by else refreshed


def _primary_key(text: Column, blank_keys_match: bool) -> Column:
    """Key to match on, null where the row must not match."""
    usable = text != NOT_ASSIGNED
    return F.when(usable if blank_keys_match else usable & (text != ""), text)


def _secondary_key(text: Column, blank_keys_match: bool) -> Column:
    number = number_key(text)
    return F.when(text == "", F.lit("")).otherwise(number) if blank_keys_match else number


def _check_columns(
    query: DataFrame, report: DataFrame, notes: Sequence[str], primary: str, secondary: str | None
) -> None:
    for name, frame in (("query", query), ("report", report)):
        if primary not in frame.columns:
            raise ValueError(f"the {name} lacks the primary identifier {primary}")
        repeated = sorted({c for c in frame.columns if frame.columns.count(c) > 1})
        if repeated:
            raise ValueError(f"the {name} repeats columns: {', '.join(repeated)}")
    if secondary and secondary in report.columns and secondary not in query.columns:
        raise ValueError(f"the query lacks the secondary identifier {secondary}")
    shared = [c for c in notes if c in query.columns]
    if shared:
        raise ValueError(f"note columns share names with query columns: {', '.join(shared)}")


@dataclass(frozen=True)
class ReportSpec:
    """How one report of a set is refreshed.

    ``report`` is the existing grid (``row_no``, ``cells``). A report that takes its notes from
    another grid gives that one, with its own ``header_rows``, ``report_query_columns`` and
    ``renames``.
    """

    query_path: str
    report: DataFrame
    query_columns: int
    header_rows: int = 1
    report_query_columns: int | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    sort_by: Sequence[str] = ()
    ascending: Sequence[bool] | bool = True
    formulas: Mapping[str, str] = field(default_factory=dict)
    labels: Mapping[str, Sequence[tuple[str, str, str]]] = field(default_factory=dict)
    rules: Sequence[tuple[str, Sequence[str]]] = ()
    named: Mapping[str, Any] | None = None


def refresh_reports(
    spark: SparkSession,
    specs: Mapping[str, ReportSpec],
    primary: str,
    secondary: str | None = None,
    parameters: Mapping[str, Any] | None = None,
    more_parameters: Mapping[str, Any] | None = None,
) -> dict[str, DataFrame]:
    """One lazy refresh per spec. Of parameters given twice, ``more_parameters`` win.

    The report may be the result of an earlier refresh: its formula and label columns are derived anew.
    """
    merged = {**(parameters or {}), **(more_parameters or {})}
    refreshed = {}
    for name, spec in specs.items():
        query = read_sql_files(spark, [{"path": spec.query_path, "parameters": merged, "named": spec.named}])
        report = rename_present(grid_to_frame(spec.report, spec.header_rows), spec.renames)
        df = refresh_report(
            query,
            report,
            primary,
            secondary,
            spec.query_columns,
            spec.report_query_columns,
            spec.sort_by,
            spec.ascending,
            derived=[*spec.formulas, *label_columns([*query.columns, *report.columns], spec.labels)],
        )
        refreshed[name] = prefix_labels(add_formulas(df, spec.formulas), spec.labels)
    return refreshed


def check_reports(
    refreshed: Mapping[str, DataFrame], specs: Mapping[str, ReportSpec], identifier: str | None = None
) -> dict[str, DataFrame]:
    """Cells outside the allowed values, for each report with rules.

    Each row has the identifier (by default the first column), the column and the value.
    """
    return {
        name: rule_violations(df, specs[name].rules, [identifier or df.columns[0]])
        for name, df in refreshed.items()
        if specs[name].rules
    }
