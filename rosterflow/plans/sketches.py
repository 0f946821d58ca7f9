"""Distinct counts from sketches that each load stores and that are merged on read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.names import column

# Two to this power registers: a relative standard error of about 1.04 / sqrt(2 ** 12), or 1.6 %.
REGISTERS = 12


def store_sketches(df: DataFrame, table: str, load: int, day: str, by: Sequence[str], value: str, registers: int = REGISTERS) -> None:
    """Append a sketch of the different values per day and group, with the number of rows.

    ``load`` numbers the loads: of several sketches of a day and group the one of the latest load counts, so a day that is loaded anew
    replaces itself, and a load that comes twice changes nothing. Null values are not counted; a null day is an error.
    Sketches are some KB each and are built before rows are shuffled.
    """
    days = F.coalesce(column(day).cast("date"), F.raise_error(F.lit(f"column {day} has nulls")).cast("date"))
    grouped = df.groupBy(*[column(c) for c in by], days.alias("load_day"))
    sketches = grouped.agg(F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(column(value), F.lit(registers)).alias("sketch"))
    sketches.withColumn("load", F.lit(load).cast("long")).write.mode("append").saveAsTable(table)


def current_sketches(stored: DataFrame) -> DataFrame:
    """The sketches that count: of each day and group those of its latest load."""
    keys = [c for c in stored.columns if c not in ("n_rows", "sketch", "load")]
    newest = stored.groupBy(*[column(c) for c in keys]).agg(F.max_by(F.struct("n_rows", "sketch"), "load").alias("_newest"))
    return newest.select(*[column(c) for c in keys], "_newest.*")


def distinct_estimates(stored: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Estimated numbers of different values per group, merged over days, and the numbers of rows."""
    groups = [column(c) if isinstance(c, str) else c for c in by]
    merged = current_sketches(stored).groupBy(*groups).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("_merged"))
    return merged.withColumn("estimate", F.hll_sketch_estimate("_merged")).drop("_merged")
