"""Keep the newest rows of each group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.functions.names import column


def latest_rows(df: DataFrame, by: Sequence[str], period: str) -> DataFrame:
    """Every row of the newest period of its group, ties kept; rows without a period drop out.

    The newest period per group is an aggregate that combines before the shuffle, and the rows
    are then kept by a semi-join that adaptive execution can split. A window would sort all
    tied rows of a group in one task.
    """
    newest = df.groupBy(*[column(c).alias(f"_by_{i}") for i, c in enumerate(by)]).agg(
        F.max(column(period)).alias("_newest")
    )
    same = [column(c).eqNullSafe(F.col(f"_by_{i}")) for i, c in enumerate(by)]
    return df.join(newest, reduce(Column.__and__, same, column(period) == F.col("_newest")), "left_semi")


def latest_record(df: DataFrame, by: Sequence[str], moment: str, tie_break: str) -> DataFrame:
    """One newest row per group; of rows at the same moment the one with the largest tie-break.

    Spark applies the limit of one row per group before the shuffle as well, so each task sends
    at most one row of a group, however frequent the group is.
    """
    newest_first = Window.partitionBy(*[column(c) for c in by]).orderBy(
        column(moment).desc_nulls_last(), column(tie_break).desc_nulls_last()
    )
    return df.withColumn("_position", F.row_number().over(newest_first)).filter("_position = 1").drop("_position")
