"""Spreadsheet grids: rows of text cells, numbered from 1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.names import column
from rosterflow.operators.columns import type_text_columns


def grid_to_frame(
    grid: DataFrame, header_row: int = 1, typed: bool = False, row_no: str = "row_no", cells: str = "cells"
) -> DataFrame:
    """Table whose column names stand in the header row and whose data stands below it.

    Only the header row comes to the driver. Cells missing at the end of a row are empty text.
    All columns are text unless ``typed``.
    """
    header = grid.filter(F.col(row_no) == header_row).select(cells).first()
    if header is None:
        raise ValueError(f"the grid has no row {header_row}")
    df = grid.filter(F.col(row_no) > header_row).select(
        [F.coalesce(F.get(cells, F.lit(i)), F.lit("")).alias(f"cell_{i}") for i in range(len(header[0]))]
    )
    return (type_text_columns(df) if typed else df).toDF(*header[0])


def frame_to_grid(df: DataFrame, row_no: str, header_row: int = 1) -> DataFrame:
    """Grid with the column names in the header row and each row below it.

    ``row_no`` names a column that numbers the rows from 1; it does not become a cell.
    """
    names = [c for c in df.columns if c != row_no]
    header = df.sparkSession.range(1).select(
        F.lit(header_row).cast("bigint").alias("row_no"), F.array(*[F.lit(c) for c in names]).alias("cells")
    )
    rows = df.select(
        (F.col(row_no) + header_row).cast("bigint").alias("row_no"),
        F.array(*[F.coalesce(column(c).cast("string"), F.lit("")) for c in names]).alias("cells"),
    )
    return header.unionByName(rows)
